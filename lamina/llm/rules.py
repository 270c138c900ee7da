"""Quality rules: numbers of a document's own text, and lines that many documents of a host share.

Lines are normalised (white space runs to one space, A-Z to lower case, ends trimmed) and hashed together with the host
(``source``). A line is above the limit if more than ``line_limit`` distinct documents of the host hold it: rows that share an id
are one document, rows without an id are one per text, and copies of a text under several ids are several documents, so near and exact
copies are best removed before. Lines above the limit are removed, and a document is rejected if too little is left. Everything is DataFrame functions: counts combine before their shuffle, only hashes and
small numbers are shuffled, and the set of common lines is joined, not broadcast by request.

Null and empty texts have no words and fail the base rule. A null source is a host of its own, the empty one. Rows are told apart by
a hash of id, source and text; repeated rows share one verdict, and null ids are allowed. Very long texts are one row like others.
Other columns, whatever their names, are not looked at; ``apply_rules`` returns them as they were. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import SPACE, stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = "#*$%&|<>"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _covered(hashes: Column, size: int) -> Column:
    """Words under windows whose hash occurs at two or more places."""
    places = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(at: Column) -> Column:
        n = F.size(at)
        same = F.filter(at, lambda x, k: ((k > 0) & (F.get(at, k - 1)["h"] == x["h"])) | ((k < n - 1) & (F.get(at, k + 1)["h"] == x["h"])))
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    def total(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - p, F.lit(size))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(_let(places, repeated), total)).otherwise(0)


def own_numbers(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, rid and the numbers of each document's own text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", _rid().alias("rid"), text.alias("text")).select("*", _words(F.col("text")).alias("words"))
    n = F.size("words")
    window = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*(F.get(F.col("words"), i + k) for k in range(size))))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id", "rid", n.cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.when(n >= size, window).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    rows = rows.withColumn("n_repeat_words", _covered(F.col("windows"), size).cast("long")).drop("windows")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _rid() -> Column:
    return F.xxhash64("doc_id", "source", "text", F.col("doc_id").isNull(), F.col("source").isNull(), F.col("text").isNull())


def line_table(docs: DataFrame) -> DataFrame:
    """rid, doc (the id, or a hash of the text), pos, line (a hash of host and normalised line) and n, its words, for every line with a word."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        _rid().alias("rid"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("doc"), F.coalesce(F.col("source"), F.lit("")).alias("host"), F.posexplode(F.split(text, "\n")).alias("pos", "raw"),
    )
    rows = rows.withColumn("plain", F.trim(F.regexp_replace(F.translate("raw", UPPER, LOWER), SPACE, " "))).where("plain <> ''")
    n = F.length("plain") - F.length(F.translate("plain", " ", "")) + 1
    return rows.select("rid", "doc", "pos", F.xxhash64("host", "plain").alias("line"), n.cast("long").alias("n"))


def common_lines(lines: DataFrame, line_limit: int) -> DataFrame:
    """The lines that more than ``line_limit`` distinct documents of their host hold."""
    return lines.groupBy("line").agg(F.countDistinct("doc").alias("docs")).where(F.col("docs") > line_limit).select("line")


def removed_lines(docs: DataFrame, line_limit: int = 10) -> DataFrame:
    """rid, pos and n of the lines to be removed."""
    lines = stored(line_table(docs), "lines")
    common = stored(common_lines(lines, line_limit), "common-lines")
    return lines.join(common, "line").select("rid", "pos", "n").distinct()


def verdicts(docs: DataFrame, line_limit: int = 10, least_share: float = 0.3, least_words: int = 10) -> DataFrame:
    """own_numbers with n_removed, the words in removed lines, and kept."""
    removed = removed_lines(docs, line_limit).groupBy("rid").agg(F.sum("n").alias("n_removed"))
    rows = own_numbers(docs).join(removed, "rid", "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long")))
    left = F.col("n_words") - F.col("n_removed")
    depleted = (F.col("n_removed") > 0) & ((left < least_words) | (left < least_share * F.col("n_words")))
    return rows.withColumn("kept", ~F.col("base_failed") & ~depleted)


def apply_rules(docs: DataFrame, line_limit: int = 10, least_share: float = 0.3, least_words: int = 10) -> DataFrame:
    """The documents that are kept, with their own columns, and without the lines above the limit."""
    removed = removed_lines(docs, line_limit).groupBy("rid").agg(F.collect_list("pos").alias("_gone"), F.sum("n").alias("n_removed"))
    numbers = own_numbers(docs).dropDuplicates(["rid"]).join(removed, "rid", "left")
    left = F.col("n_words") - F.coalesce("n_removed", F.lit(0))
    good = numbers.where(~F.col("base_failed") & (F.col("n_removed").isNull() | ((left >= least_words) & (left >= least_share * F.col("n_words")))))
    rows = docs.withColumn("_rid", _rid()).join(good.select(F.col("rid").alias("_rid"), "_gone"), "_rid")
    rest = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    return rows.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(rest)).select(*docs.columns)


def op8_rules(spark, sf_dir: str) -> DataFrame:
    found = verdicts(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP8_SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host FROM documents),
words AS (SELECT r, doc_id, t, host, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM rows),
places AS (SELECT r, unnest(range(0, len(w) - 4)) AS i, w FROM words WHERE len(w) >= 5),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w[i + 1 : i + 5], ' ')) AS n FROM places),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM windows WHERE n > 1) GROUP BY r),
raw AS (SELECT r, doc_id, host, t, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM rows),
lines AS (SELECT *, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain FROM raw),
full_lines AS (SELECT * FROM lines WHERE plain <> ''),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY r),
common AS (SELECT host, plain FROM full_lines GROUP BY host, plain HAVING count(DISTINCT coalesce('d' || doc_id, 't' || t)) > 10),
removed AS (SELECT r, sum(len(string_split(plain, ' '))) AS n FROM full_lines SEMI JOIN common USING (host, plain) GROUP BY r),
numbers AS (
  SELECT words.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(removed.n, 0) AS gone
  FROM words LEFT JOIN covered USING (r) LEFT JOIN dups USING (r) LEFT JOIN removed USING (r)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM numbers)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (gone > 0 AND (n_words - gone < 10 OR n_words - gone < 0.3 * n_words)) AS kept
FROM judged
"""
