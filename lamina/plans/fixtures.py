"""Views over the test tables that have the shape of raw health reports, manifests, pages and run logs.

The SQL is valid for Spark and DuckDB alike; ``{name}`` stands for a table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators.cleaning import clean
from lamina.session import spread

# The state of a nation: the codes in the order of the full table.
_CODE = "CASE n.n_nationkey " + " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(list(fixed.STATE_NAMES)[:20])) + " END"

CASES_RAW = f"""
SELECT o.o_orderkey AS rec_id,
  CASE WHEN n.n_nationkey >= 20 THEN n.n_name
       WHEN o.o_orderkey % 3 = 0 THEN lower({_CODE})
       ELSE {_CODE} END AS state,
  CASE o.o_orderkey % 4
       WHEN 0 THEN o.ds || 'T00:00:00.000'
       WHEN 1 THEN o.ds
       WHEN 2 THEN substr(o.ds, 6, 2) || '/' || substr(o.ds, 9, 2) || '/' || substr(o.ds, 1, 4)
       ELSE CASE WHEN o.o_orderkey % 20 = 3 THEN 'bad' ELSE o.ds END END AS end_date,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL WHEN o.o_orderkey % 13 = 0 THEN 'n/a'
       ELSE CAST(CAST(floor(o.o_totalprice / 100) AS BIGINT) - 200 AS STRING) END AS new_cases,
  CAST(CAST(floor(o.o_totalprice / 10) AS BIGINT) AS STRING) AS tot_cases,
  CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_custkey % 50 AS STRING) END AS new_deaths,
  CAST(o.o_custkey AS STRING) AS tot_deaths
FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS ds FROM {{orders}}) o
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
"""

VACCINATIONS_RAW = f"""
SELECT CASE WHEN n.n_nationkey = 24 THEN 'US' WHEN n.n_nationkey >= 20 THEN n.n_name
            ELSE {_CODE} END AS location,
  CAST(CAST(l.l_shipdate AS DATE) AS STRING) AS date,
  CAST(CAST(l.l_quantity AS BIGINT) * 100 AS STRING) AS administered,
  CAST(CAST(l.l_quantity AS BIGINT) * 10 * l.l_linenumber AS STRING) AS series_complete_yes
FROM {{lineitem}} l JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey JOIN {{nation}} n ON s.s_nationkey = n.n_nationkey
"""

RESPIRATORY_RAW = f"""
SELECT CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS week_ending_date,
  CASE WHEN n.n_nationkey >= 20 THEN n.n_name ELSE {_CODE} END AS jurisdiction,
  o.o_orderpriority AS age_group,
  CASE WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE CAST(o.o_custkey % 90 - 5 AS STRING) END AS covid_19_deaths,
  CAST(o.o_custkey % 70 AS STRING) AS pneumonia_deaths,
  CAST(o.o_orderkey % 30 AS STRING) AS influenza_deaths
FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
"""

FLU_RAW = """
SELECT CAST(2010 + p_partkey % 9 AS STRING) AS year_season, CAST(p_size % 12 + 1 AS STRING) AS month,
  p_brand AS geography, p_type AS dimension,
  CASE WHEN p_partkey % 25 = 0 THEN 'NR' ELSE CAST(p_size * 2 + 1 AS STRING) END AS coverage_estimate
FROM {part}
"""

MANIFEST_FILES = """
SELECT o_orderkey AS position,
  CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE 'ds_' || CAST(o_custkey % 40 AS STRING) END AS dataset_key,
  CASE WHEN o_orderkey % 10 = 3 THEN 'txt' WHEN o_orderkey % 4 = 1 THEN 'csv' WHEN o_orderkey % 4 = 2 THEN 'pdf'
       ELSE 'json' END AS format,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS file_size,
  'file_' || CAST(o_orderkey AS STRING) AS filename,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'table://' || o_orderpriority END AS source,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'success' END AS status,
  CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T06:30:00Z' AS ingestion_time,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'report' END AS category
FROM {orders}
"""

PAGES = """
SELECT CAST(conv_id AS STRING) AS source_file, CAST(turn AS INT) + 1 AS page_number,
  CASE WHEN (conv_id + turn) % 9 = 0 THEN NULL ELSE text END AS text
FROM {conversations}
"""

LONG_PAGES = """
SELECT lang AS source_file, doc_id + 1 AS page_number, text FROM {documents}
"""

RUN_LOG = """
SELECT ts, event_type AS layer, 'job_' || CAST(user_id % 5 AS STRING) AS job_name,
  'ds_' || CAST(user_id % 4 AS STRING) AS dataset,
  CASE event_id % 3 WHEN 0 THEN 'csv' WHEN 1 THEN 'json' ELSE 'pdf' END AS format,
  CASE WHEN event_id % 10 = 0 THEN 'error' ELSE 'success' END AS status,
  CASE event_id % 2 WHEN 0 THEN 'read' ELSE 'write' END AS direction,
  CASE event_id % 4 WHEN 0 THEN 'quality' WHEN 1 THEN 'schema' ELSE 'duplicate' END AS reason,
  CASE event_id % 3 WHEN 0 THEN 'exception' ELSE 'unknown' END AS error_type,
  CASE CAST(floor(event_id / 2) AS BIGINT) % 6 WHEN 0 THEN 'files_read' WHEN 1 THEN 'rows_inserted'
       WHEN 2 THEN 'rows_rejected' WHEN 3 THEN 'job_duration' WHEN 4 THEN 'errors' ELSE 'bytes_processed' END AS metric,
  value
FROM {events}
"""


class Tables:
    """The test tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def sql(self, text: str, fact: str, *others: str, shared: bool = False) -> DataFrame:
        """``shared`` spreads the fact table, where its test file would keep one task busy with much work."""
        table = spread(self[fact]) if shared else self[fact]
        return self.spark.sql(text, **{fact: table}, **{n: self[n] for n in others})

    def cases_raw(self) -> DataFrame:
        return self.sql(CASES_RAW, "orders", "customer", "nation", shared=True)

    def vaccinations_raw(self) -> DataFrame:
        return self.sql(VACCINATIONS_RAW, "lineitem", "supplier", "nation", shared=True)

    def respiratory_raw(self) -> DataFrame:
        return self.sql(RESPIRATORY_RAW, "orders", "customer", "nation", shared=True)

    def flu_raw(self) -> DataFrame:
        return self.sql(FLU_RAW, "part")

    def manifest_files(self) -> DataFrame:
        return self.sql(MANIFEST_FILES, "orders")

    def pages(self) -> DataFrame:
        return self.sql(PAGES, "conversations")

    def long_pages(self) -> DataFrame:
        """One document per language with a page per text; its page numbers have gaps."""
        return self.sql(LONG_PAGES, "documents")

    def run_log(self) -> DataFrame:
        return self.sql(RUN_LOG, "events")

    def cases(self) -> DataFrame:
        return clean(self.cases_raw(), fixed.CASES)

    def vaccinations(self) -> DataFrame:
        return clean(self.vaccinations_raw(), fixed.VACCINATIONS)


def rounded(df: DataFrame, decimals: int = 4) -> DataFrame:
    """Doubles rounded, so that sums taken in another order compare equal."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), decimals).alias(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
        for f in df.schema
    ])
