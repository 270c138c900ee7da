"""Readers and writers for files, tables and manifests."""
