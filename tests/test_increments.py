"""Extraction that goes on, loads of what is new, and merges into stored tables."""

import glob
import os
import random
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators import keyset, lineage, paging
from lamina.operators.cleaning import clean
from lamina.plans import increments
from lamina.plans.increments import BUCKET, FILE_ID
from lamina.plans.medallion import Medallion, Source
from lamina.sources import files
from lamina.sources.extracts import KeysetExtract
from lamina.sources.tables import Lake

ROWS = "k int, tie string, v int"


def tied(seed, n=40):
    rng = random.Random(seed)
    return [(rng.choice([None, None, 1, 2, 2, 3, 5]), rng.choice([None, "a", "b", "é"]), i) for i in range(n)]


def by_key(rows, width=2):
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r[:width]])


@pytest.mark.parametrize("keys", [["k"], ["k", "tie"], ["k", "tie", "v"]])
@pytest.mark.parametrize("size", [7, 100])
def test_every_row_is_in_one_page(spark, keys, size):
    rows = tied(1)
    pages = [(p, [tuple(r) for r in page.collect()]) for p, page in paging.keyset_walk(spark.createDataFrame(rows, ROWS), keys, size)]
    assert sorted(map(str, (r for _, page in pages for r in page))) == sorted(map(str, rows))
    groups = [{r[: len(keys)] for r in page} for _, page in pages]
    assert all(not a & b for i, a in enumerate(groups) for b in groups[i + 1 :])
    assert [p for p, _ in pages] == sorted({p for p, _ in pages})
    ordered = [r[: len(keys)] for _, page in pages for r in by_key(page, len(keys))]
    assert ordered == [r[: len(keys)] for r in by_key(rows, len(keys))]
    if len(keys) == 3:
        assert all(len(page) == size for _, page in pages[:-1])


def test_bounds_of_all_types(spark):
    df = spark.sql("""SELECT CAST(i AS TINYINT) a, i / 3 AS b, CAST(i / 7 AS DECIMAL(20, 9)) c, timestamp_micros(1600000000000000 + i) d, date_add(DATE '2020-01-01', i) e,
        to_binary(hex(i)) f, timestamp_ntz '2020-01-01 00:00:00.123456' + make_dt_interval(i) g, CAST(i / 3 AS FLOAT) h, i % 2 = 0 AS j FROM (SELECT CAST(id AS INT) i FROM range(4))""")
    for c in df.columns:
        for r in df.select(c, keyset.as_text(F.col(c), df.schema[c].dataType).alias("t")).collect():
            same = df.filter(F.col(c) == keyset.from_text(r["t"], df.schema[c].dataType)).count()
            assert same == df.filter(keyset.between(df, [c], None, [r["t"]]) & ~keyset.below(df, [c], [r["t"]], False)).count() == (2 if c == "j" else 1)
    with pytest.raises(TypeError):
        keyset.as_text(F.array(F.lit(1)), spark.sql("SELECT array(1) AS x").schema["x"].dataType)


def test_range_reaches_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id AS k", "CAST(id AS STRING) AS tie", "id AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = df.filter(keyset.between(df, ["k", "tie"], ["10", "10"], ["20", "20"]))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(k,10)" in plan and "LessThanOrEqual(k,20)" in plan


def test_keys_of_a_range_are_made_few_times(spark):
    df = spark.range(100).selectExpr("CAST(date_add(DATE '2020-01-01', CAST(id AS INT)) AS STRING) AS d", "CAST(id % 7 AS STRING) AS t", "id")
    found = df.filter(keyset.between(df, ["d", "t"], ["2020-01-10", "3"], ["2020-01-20", None]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan[plan.index("Filter") :].count("date_add") <= 5  # two bounds for the scan, two comparisons, not null
    assert sorted(r.id for r in found.collect()) == list(range(10, 19))


def pages_of(extract):
    return {m["page"]: sorted(map(str, (tuple(r)[:3] for r in files.route_csv(extract.spark, extract.page_path(m["page"]), ROWS + ", w int", null_mark=files.NULL_MARK).good.collect()))) for m in extract.marks()}


def test_extract_goes_on(spark, tmp_path):
    rows = tied(2, 60)
    table = spark.createDataFrame(rows, ROWS)
    narrow = KeysetExtract(spark, str(tmp_path / "x"), ["k", "tie", "w"], 10)
    third = by_key(rows, 3)[25][2]
    gone = F.when(F.col("w") == third, F.raise_error(F.lit("gone")).cast("int")).otherwise(F.col("w"))
    with pytest.raises(Exception, match="gone"):
        narrow.run(table.withColumnRenamed("v", "w").withColumn("v", gone).select("k", "tie", "v", "w"))
    assert [m["page"] for m in narrow.marks()] == [1, 2]
    whole = table.withColumn("w", F.col("v"))
    assert narrow.run(whole) == [3, 4, 5, 6]
    assert narrow.run(whole) == []
    more = [(0, "new", 1000), (9, "z", 1001), (None, None, 1002)]
    grown = whole.union(spark.createDataFrame([(*r, r[2]) for r in more], ROWS + ", w int"))
    written = narrow.run(grown)
    assert written[-1] == 7 and 1 in written and len(written) <= 3
    found = [r for page in pages_of(narrow).values() for r in page]
    assert sorted(found) == sorted(map(str, rows + more))
    assert narrow.run(grown.filter("w <> 1001")) == [7] and not pages_of(narrow)[7]
    assert narrow.run(grown, fresh=True) == [1, 2, 3, 4, 5, 6, 7]


def test_empty_source_and_first_rows(spark, tmp_path):
    extract = KeysetExtract(spark, str(tmp_path / "x"), ["k", "tie"], 10)
    nothing = spark.createDataFrame([], ROWS)
    assert extract.run(nothing) == [1] and extract.run(nothing) == []
    assert extract.run(spark.createDataFrame([(None, None, 1), (1, "a", 2)], ROWS)) == [1, 2]
    assert sum(m["rows"] for m in extract.marks()) == 2


def test_hashes_tell_contents_apart(spark, tmp_path):
    made = []
    for n, rows in enumerate([[(1, "a", 1), (2, "b", 2)], [(2, "b", 2), (1, "a", 1)], [(1, "a", 1), (2, "b", 3)]]):
        extract = KeysetExtract(spark, str(tmp_path / f"x{n}"), ["k"], 10)
        extract.run(spark.createDataFrame(rows, ROWS).repartition(2))
        made.append(extract.marks()[0]["content_hash"])
    assert made[0] == made[1] != made[2]


def test_new_files(spark):
    kind = "dataset_key string, local_path string, file_size long, content_hash string"
    log = spark.createDataFrame([("a", "/1", 5, "x", 1), ("a", "/1", 6, "y", 2), ("a", "/2", 5, None, 1), ("b", "/3", None, None, 1)], kind + ", loaded_at int")
    listed = spark.createDataFrame([("a", "/1", 5, "x"), ("a", "/2", 5, None), ("b", "/3", None, None), ("b", "/4", 1, "z"), ("a", "/2", 5, "h")], kind)
    # /1 has its first content again, which is not that of its last load
    assert sorted((r["local_path"], r["content_hash"]) for r in lineage.new_files(listed, lineage.latest_loads(log)).collect()) == [("/1", "x"), ("/2", "h"), ("/4", "z")]


CASES = "rec_id int, start_date string, end_date string, state string, tot_cases string, new_cases string, tot_deaths string, new_deaths string"


def case_rows(ids, shift=0):
    return [(i, f"2021-01-{1 + i % 20:02d}", f"2021-02-{1 + i % 20:02d}", ["CA", "ca", "TX", None][i % 4], str(i), str(i % 7 - 1 + shift), "5", None) for i in ids]


def stored_files(job, layer, name):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(job.lake.path(layer, name) + "/*/*.parquet")}


def load(job, spark, ids, shift=0):
    job.extract({fixed.CASES: Source(spark.createDataFrame(case_rows(ids, shift), CASES), "rec_id")})
    found = job.load_bronze()
    result = job.transform_dataset(fixed.CASES)
    assert found["status"] == "success" and result["status"] == "success", (found, result)
    return found


def same_as_a_rebuild(job):
    """Silver holds what cleaning all of bronze gives."""
    drop = ["_silver_processed_at", BUCKET]
    want = clean(job.lake.read("bronze", fixed.CASES), fixed.CASES).drop(*drop)
    found = job.lake.read("silver", fixed.CASES).select(*want.columns)
    return sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def incremental(spark, path, buckets=16):
    return Medallion(Lake(spark, str(path)), datasets=[fixed.CASES], incremental=True, page_rows=20, silver_buckets=buckets)


def test_loads_touch_what_is_new(spark, tmp_path):
    job = incremental(spark, tmp_path)
    assert load(job, spark, range(40))["loaded_files"] == 2
    bronze, silver = stored_files(job, "bronze", fixed.CASES), stored_files(job, "silver", fixed.CASES)
    assert load(job, spark, range(40))["loaded_files"] == 0
    assert stored_files(job, "bronze", fixed.CASES) == bronze and stored_files(job, "silver", fixed.CASES) == silver
    assert load(job, spark, range(42))["loaded_files"] == 1
    now = stored_files(job, "bronze", fixed.CASES)
    assert {f: t for f, t in now.items() if f in bronze} == bronze and len(now) > len(bronze)
    assert same_as_a_rebuild(job)
    left = {f: t for f, t in stored_files(job, "silver", fixed.CASES).items() if f in silver}
    assert left and all(silver[f] == t for f, t in left.items()) and len(left) >= len(silver) - 4  # two rows, two buckets


def test_old_files_are_not_read_again(spark, tmp_path):
    job = incremental(spark, tmp_path)
    load(job, spark, range(40))
    for f in glob.glob(str(tmp_path) + f"/raw/csv/{fixed.CASES}/page=0000000[12]/part-*"):
        with open(f, "w") as broken:
            broken.write("no,such\ncontent,1\n")
    assert load(job, spark, range(45))["loaded_files"] == 1
    assert job.lake.read("bronze", fixed.CASES).count() == 45 and same_as_a_rebuild(job)


def test_a_changed_file_replaces_its_rows(spark, tmp_path):
    job = incremental(spark, tmp_path)
    load(job, spark, range(0, 80, 2))
    assert load(job, spark, [*range(0, 40, 2), 1, *range(40, 80, 2)])["loaded_files"] == 1
    assert job.lake.read("bronze", fixed.CASES).count() == 41 and same_as_a_rebuild(job)
    assert load(job, spark, [*range(0, 30, 2), 1, *range(40, 80, 2)])["loaded_files"] == 1
    assert job.lake.read("bronze", fixed.CASES).count() == 36 and same_as_a_rebuild(job)
    gone = load(job, spark, range(40, 80, 2))  # the first page has no rows any more
    assert gone["status"] == "success" and job.lake.read("bronze", fixed.CASES).count() == 20 and same_as_a_rebuild(job)


def test_duplicates_across_loads_and_few_buckets(spark, tmp_path):
    job = incremental(spark, tmp_path, buckets=1)
    load(job, spark, range(30))
    load(job, spark, range(95))  # the same keys again from 80 on
    assert same_as_a_rebuild(job) and job.lake.count("silver", fixed.CASES) < 95


def test_a_run_between_table_and_log_is_repeated(spark, tmp_path, monkeypatch):
    job = incremental(spark, tmp_path)
    load(job, spark, range(20))
    append = Lake.append
    monkeypatch.setattr(Lake, "append", lambda self, df, layer, name: (_ for _ in ()).throw(RuntimeError("lost")) if name in ("ingestion_log", "silver_loads") else append(self, df, layer, name))
    with pytest.raises(RuntimeError):
        job.extract({fixed.CASES: Source(spark.createDataFrame(case_rows(range(50)), CASES), "rec_id")})
        job.load_bronze()
    monkeypatch.undo()
    assert load(job, spark, range(50))["loaded_files"] == 2
    assert job.lake.read("bronze", fixed.CASES).count() == 50 and same_as_a_rebuild(job)


def test_from_whole_loads_to_increments(spark, tmp_path):
    whole = Medallion(Lake(spark, str(tmp_path)), datasets=[fixed.CASES], page_rows=20)
    load(whole, spark, range(40))
    assert FILE_ID not in whole.lake.read("bronze", fixed.CASES).columns
    job = incremental(spark, tmp_path)
    assert load(job, spark, range(45))["loaded_files"] == 3 and same_as_a_rebuild(job)


def test_rejected_records_are_kept(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b\n1,2\nx,3\n4,5,6\n7\n"8\n",9\n,\n')
    job = Medallion(Lake(spark, str(tmp_path / "lake")), schemas={"t": "a int, b int"}, datasets=["t"])
    entry = {"format": "csv", "dataset_key": "t", "local_path": str(path), "filename": "in.csv"}
    job.extract({}, [entry])
    found = job.load_bronze()
    assert found["rejected"] == {"t": 4}
    assert sorted(map(tuple, job.lake.read("bronze", "t").select("a", "b").collect()), key=str) == [(1, 2), (None, None)]
    bad = job.lake.read("bronze_rejects", "t").collect()
    assert sorted(r["record"] for r in bad) == sorted(["x,3", "4,5,6", "7", '"8\n",9']) and all(r["path"].endswith("in.csv") for r in bad)
    path.write_text("a,b\n1,2\n")
    assert job.load_bronze()["rejected"] == {} and job.lake.count("bronze_rejects", "t") == 0


def test_rejected_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": "x"}, {"a": "no"}, 5, null, {"b": "y", "c": [1]}]')
    (tmp_path / "b.json").write_text(' {"a": 7}')
    (tmp_path / "c.json").write_text('[{"a": 7}')
    (tmp_path / "d.json").write_text('﻿[{"a": 8}]')
    (tmp_path / "e.json").write_text("[]")
    routed = files.route_json(spark, str(tmp_path), "a int, b string")
    assert sorted(map(str, (tuple(r)[:2] for r in routed.good.collect()))) == sorted(map(str, [(1, "x"), (None, "y"), (7, None), (8, None)]))
    assert sorted(r["record"] for r in routed.bad.collect()) == sorted(['{"a":"no"}', "5", "null", '[{"a": 7}'])
    assert routed.good.count() == routed.bad.count() == 4


def test_pages_share_their_jobs(spark, tmp_path):
    jobs = lambda: spark.sparkContext.statusTracker().getJobIdsForGroup("pages")
    table = spark.range(0, 1200, 2).selectExpr("IF(id % 100 = 0, NULL, id) AS k", "id AS v", "CAST(id AS STRING) AS s")
    extract = KeysetExtract(spark, str(tmp_path / "x"), ["k", "v"], 20)
    spark.sparkContext.setJobGroup("pages", "")
    assert extract.run(table) == list(range(1, 31))
    first = len(jobs())
    grown = table.union(spark.sql("SELECT id AS k, id AS v, 'new' AS s FROM range(1, 1200, 80)")).union(spark.sql("SELECT 5000L, 1L, 'end'"))
    written = extract.run(grown.filter("k IS NULL OR k NOT BETWEEN 30 AND 70"))
    assert written[-1] == 31 and 12 < len(written) < 31 and len(set(written)) == len(written) and extract.run(grown.filter("k IS NULL OR k NOT BETWEEN 30 AND 70")) == []
    spark.sparkContext.setJobGroup("", "")
    assert first < 40 and len(jobs()) < 120  # a page alone takes two or more
    found = files.route_csv(spark, [extract.page_path(m["page"]) for m in extract.marks()], table.schema, null_mark=files.NULL_MARK).good.drop(files.FILE)
    want = grown.filter("k IS NULL OR k NOT BETWEEN 30 AND 70")
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    alone = KeysetExtract(spark, str(tmp_path / "y"), ["k", "v"], 10**6)
    alone.run(want.filter("v = 100"))
    assert sum(m["rows"] for m in extract.marks()) == want.count() and alone.marks()[0]["content_hash"]


def test_hash_of_a_page_is_the_same_alone_and_together(spark, tmp_path):
    table = spark.range(40).selectExpr("id AS k", "id / 7 AS page", "timestamp_micros(id * 1000001) AS t")
    together = KeysetExtract(spark, str(tmp_path / "x"), ["k"], 10)
    together.run(table.withColumnRenamed("page", "p"))
    alone = KeysetExtract(spark, str(tmp_path / "y"), ["k"], 10)  # a column of that name keeps pages apart
    alone.run(table)
    kept = lambda e: [(m["page"], m["last"], m["rows"], m["content_hash"]) for m in e.marks()]
    assert kept(together) == kept(alone) and len(kept(alone)) == 4


def test_appends_of_threads_are_all_kept(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: lake.append(spark.range(i, i + 1), "runs", "log"), range(24)))
    assert sorted(r.id for r in lake.read("runs", "log").collect()) == list(range(24))


def test_pages_are_dealt_in_one_pass(spark, tmp_path):
    passes = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            passes.add(len(batch))
            yield batch

    table = spark.range(400).selectExpr("id AS k", "id AS v").mapInPandas(seen, "k long, v long")
    extract = KeysetExtract(spark, str(tmp_path / "x"), ["k"], 20)
    ends = [[str(i)] for i in range(19, 400, 20)]
    pages = [(n, ends[n - 2] if n > 1 else None, end) for n, end in enumerate(ends, 1)]
    extract._write_pages(table, pages, None)
    assert passes.value == 400 and [m["rows"] for m in extract.marks()] == [20] * 20


@pytest.mark.parametrize("count", [1, 2, 3, 7, 8, 9])
def test_range_number(spark, count):
    rows = [(None, None), (None, "a"), *[(k, t) for k in range(9) for t in (None, "a", "b")]]
    ends = sorted(random.Random(count).sample(rows, count), key=lambda r: [(v is not None, v) for v in r])
    numbers = [None if i == 1 else 10 * i for i in range(count)]
    df = spark.createDataFrame(rows, "k int, t string")
    given = spark.createDataFrame([(n, e) for n, e in zip(numbers, ends, strict=True)], "number long, end struct<k0: int, k1: string>")
    after = lambda a, b: [(v is not None, v) for v in a] > [(v is not None, v) for v in b]
    want = {r: next((n for n, e in zip(numbers, ends, strict=True) if not after(r, e)), None) for r in rows}
    assert {(r.k, r.t): r.n for r in df.withColumn("n", keyset.range_number(["k", "t"], given)).collect()} == want


TEXTS = [None, "", 'say "x"', "two\nlines", " a, b ", "é"]


def shared_rows(spark, ids):
    return spark.createDataFrame([(i, TEXTS[i % 6], i * 10) for i in ids], "k int, s string, v int")


def rows_of(extract, table):
    found = extract.route(extract.marks(), table.schema)
    assert found.bad.count() == 0
    return sorted(map(str, (tuple(r)[:3] for r in found.good.collect()))), sorted(map(str, map(tuple, table.collect())))


def below(path, pattern="**/part-*"):
    return glob.glob(f"{path}/{pattern}", recursive=True)


def test_many_pages_share_files(spark, tmp_path):
    extract = KeysetExtract(spark, str(tmp_path / "x"), ["k"], 5)
    table = shared_rows(spark, range(0, 2000, 2))
    assert extract.run(table) == list(range(1, 201))
    first, marks = below(extract.path), extract.marks()
    assert len(first) <= 2 * spark.sparkContext.defaultParallelism and len({m["folder"] for m in marks}) == 1
    assert sum(m["bytes"] for m in marks) + len(first) * len("_page,k,s,v\n") + sum(m["rows"] * len(f"{m['page']},") for m in marks) == sum(os.path.getsize(f) for f in first)
    found, want = rows_of(extract, table)
    assert found == want
    pages = {r[0]: r[1] for r in extract.route(marks, table.schema).good.selectExpr("k", "CAST(regexp_extract(_file_path, '#page=([0-9]+)$', 1) AS INT)").collect()}
    assert pages == {k: i // 5 + 1 for i, k in enumerate(range(0, 2000, 2))}
    grown = shared_rows(spark, [*range(0, 2000, 2), *range(1, 1001, 10), 1501])
    assert extract.run(grown) == [*range(1, 101), 151] and extract.run(grown) == []
    found, want = rows_of(extract, grown)
    assert found == want and set(first) < set(below(extract.path))  # pages that have not changed are still there
    some = [m for m in extract.marks() if m["page"] in (1, 151, 160)]
    assert extract.route(some, table.schema).good.count() == 5 + 1 + 5 + 1 + 5
    again = shared_rows(spark, [*range(0, 2000, 2), *range(1, 2001, 10)])
    extract.run(again)
    extract.run(again, fresh=True)
    found, want = rows_of(extract, again)
    assert found == want and not set(first) & set(below(extract.path))


def test_rejects_of_shared_files(spark, tmp_path):
    extract = KeysetExtract(spark, str(tmp_path / "x"), ["k"], 5)
    extract.run(spark.range(400).selectExpr("id AS k", "id AS v"))
    for f in below(extract.path):
        with open(f, encoding="utf8") as lines:
            text = lines.read()
        with open(f, "w", encoding="utf8") as lines:
            lines.write(text.replace("2,7,7\n", "2,7,x\n2,8\n").replace("3,12,12\n", "3,12,12,12\n"))
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    routed = extract.route(extract.marks(), "k long, v long")
    assert routed.good.count() == 398
    assert sorted((r["record"], r["path"][-14:]) for r in routed.bad.collect()) == [("12,12,12", "#page=00000003"), ("7,x", "#page=00000002"), ("8", "#page=00000002")]
    assert extract.route(extract.marks()).good.filter("k = '5'").count() == 1  # columns as in the header


def many_pages(spark, path, monkeypatch):
    monkeypatch.setattr(increments, "PART_ROWS", 100)
    return Medallion(Lake(spark, str(path)), datasets=[fixed.CASES], incremental=True, page_rows=2, silver_buckets=4)


def test_small_files_share_a_partition(spark, tmp_path, monkeypatch):
    job = many_pages(spark, tmp_path, monkeypatch)
    assert load(job, spark, range(0, 400, 2))["loaded_files"] == 100
    first = stored_files(job, "bronze", fixed.CASES)
    assert len(os.listdir(job.lake.path("bronze", fixed.CASES))) <= 2 + 2 and len(first) < 20
    assert job.lake.read("bronze", fixed.CASES).columns[-1] == FILE_ID and same_as_a_rebuild(job)
    assert load(job, spark, [*range(0, 10), *range(10, 400, 2)])["loaded_files"] == 3
    second = stored_files(job, "bronze", fixed.CASES)
    assert {f for f, t in second.items() if first.get(f) == t} and set(first) - set(second)  # one part is as it was
    assert job.lake.read("bronze", fixed.CASES).count() == 205 and same_as_a_rebuild(job)
    assert load(job, spark, [*range(0, 10), *range(10, 400, 2), 500, 501, 502])["loaded_files"] == 2
    assert set(second.items()) <= set(stored_files(job, "bronze", fixed.CASES).items())
    assert load(job, spark, [*range(0, 400), 500, 501, 502])["loaded_files"] == 98
    assert job.lake.read("bronze", fixed.CASES).count() == 403 and same_as_a_rebuild(job)
    assert load(job, spark, [*range(0, 400), 500, 501, 502])["loaded_files"] == 0


def test_a_write_that_breaks_off_loses_nothing(spark, tmp_path, monkeypatch):
    job = many_pages(spark, tmp_path, monkeypatch)
    load(job, spark, range(0, 400, 2))
    replace = Lake.replace_partitions

    def broken(self, df, layer, name, by):
        for part in [r[0] for r in df.select(*by).distinct().collect()]:  # old files go before the new ones come
            shutil.rmtree(f"{self.path(layer, name)}/{by[0]}={part}")
        raise RuntimeError("lost")

    monkeypatch.setattr(Lake, "replace_partitions", broken)
    rows = [*range(0, 400, 2), 1]
    job.extract({fixed.CASES: Source(spark.createDataFrame(case_rows(rows), CASES), "rec_id")})
    assert job.load_bronze()["errors"] and job.lake.read("bronze", fixed.CASES).count() < 200
    monkeypatch.setattr(Lake, "replace_partitions", replace)
    assert load(job, spark, rows)["loaded_files"] >= 50
    assert job.lake.read("bronze", fixed.CASES).count() == 201 and same_as_a_rebuild(job)
    assert load(job, spark, rows)["loaded_files"] == 0
