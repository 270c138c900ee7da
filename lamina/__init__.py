"""Layered (raw, cleaned, business) table analytics written for Spark."""
