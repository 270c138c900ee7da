"""Document text: page records, per-document text and totals, previews."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import fixed

# Pages merged in one step, which bounds the rows that one group collects, and steps before the last: enough for any INT.
BLOCK, LEVELS = 1024, 3


def decode_documents(
    spark: SparkSession, path: str, decoder: Callable[[bytes], list[str]], pattern: str = "*"
) -> DataFrame:
    """Pages (source_file, page_number, text, error) of the files below ``path`` whose names match ``pattern``.

    ``decoder`` turns the bytes of a file into page texts, one file at a time inside tasks. The key of a document is its
    whole path, so files of one name in different folders stay apart. A file that fails gives one row with its error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["source_file"], batch["content"]):
                try:
                    pages = list(decoder(bytes(content)))
                    yield pd.DataFrame({
                        "source_file": name, "page_number": range(1, len(pages) + 1), "text": pages, "error": None,
                    })
                except Exception as error:  # one bad file must not stop the others
                    yield pd.DataFrame({
                        "source_file": [name], "page_number": [None], "text": [None], "error": [str(error)],
                    })

    files = (
        spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(path)
        .select(F.col("path").alias("source_file"), "content")
    )
    return files.mapInPandas(run, "source_file string, page_number int, text string, error string")


def decoded_pages(decoded: DataFrame) -> DataFrame:
    """The pages of the files that could be decoded."""
    return decoded.filter(F.col("error").isNull()).drop("error")


def page_records(
    pages: DataFrame, max_pages: int | None = None,
    doc: str = "source_file", number: str = "page_number", text: str = "text",
) -> DataFrame:
    """Pages up to ``max_pages``, missing text as empty, with the number of characters."""
    if max_pages is not None:
        pages = pages.filter(F.col(number) <= max_pages)
    content = F.coalesce(F.col(text), F.lit(""))
    return pages.select(
        F.col(doc).alias("source_file"), F.col(number).cast("long").alias("page_number"),
        content.alias("text"), F.length(content).alias("char_count"),
    )


def document_text(records: DataFrame, max_chars: int | None = None) -> DataFrame:
    """One row per document: pages, characters, the joined text (its first ``max_chars`` characters if given) and a preview.

    Pages are joined in blocks of 1,024, then blocks of blocks, until one row per document is left, so no group collects
    more than 1,024 rows however long a document is. The number of steps is fixed. With ``max_chars`` the pages are dealt by block, so a
    document of any length is shared among tasks, and only heads of blocks are dealt again; without, all steps follow one shuffle by document, whose
    whole text has to come together in one row anyway. Of rows with the same page number of a document the one with the smallest text counts.
    """
    placed = records.withColumn("block", F.floor(F.col("page_number") / BLOCK))
    placed = placed.repartition("source_file") if max_chars is None else placed.repartition("source_file", "block")
    pages = placed.groupBy("source_file", "block", "page_number").agg(F.min(F.struct("text", "char_count")).alias("page"))
    level = pages.select(
        "source_file", "block", F.col("page_number").alias("position"), F.lit(1).cast("long").alias("pages"),
        F.col("page.char_count").cast("long").alias("characters"), _head(F.col("page.text"), max_chars).alias("head"),
    )
    level = _merge(level, ["source_file", "block"], max_chars).withColumnRenamed("block", "position")
    for _ in range(LEVELS - 1):
        level = _merge(level, ["source_file", F.floor(F.col("position") / BLOCK).alias("position")], max_chars)
    level = _merge(level, ["source_file"], max_chars)
    return level.select(
        "source_file", F.col("pages").alias("total_pages"), F.col("characters").alias("total_characters"),
        F.col("head").alias("full_text"), F.substring("head", 1, fixed.PREVIEW_CHARS).alias("text_preview"),
    )


def _head(text: Column, max_chars: int | None) -> Column:
    return text if max_chars is None else F.substring(text, 1, max_chars)


def _merge(level: DataFrame, keys: list, max_chars: int | None) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("position", "head")))
    joined = F.array_join(F.transform(ordered, lambda x: x["head"]), fixed.PAGE_SEPARATOR)
    return level.groupBy(*keys).agg(
        F.sum("pages").alias("pages"), F.sum("characters").alias("characters"),
        _head(joined, max_chars).alias("head"),
    )
