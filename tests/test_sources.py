import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lamina import session
from lamina.functions import fixed
from lamina.operators import lineage, paging
from lamina.sources import files, manifest
from lamina.sources.tables import Lake, SchemaMismatch

AWKWARD = [(1, 'say "hi"'), (2, "two\nlines"), (3, " blanks "), (4, ""), (5, None), (6, "a,b\\"), (7, "cr\r\nlf")]


def test_csv_roundtrip_of_awkward_text(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "id int, text string")
    files.write_csv(df, str(tmp_path / "csv"))
    read = files.read_csv(spark, str(tmp_path / "csv"), df.schema, null_mark=files.NULL_MARK)
    assert sorted(map(tuple, read.collect())) == AWKWARD


def test_csv_types(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,x\n2,\n")
    assert files.read_csv(spark, path).dtypes == [("a", "string"), ("b", "string")]
    assert files.read_csv(spark, path, infer_schema=True).dtypes == [("a", "int"), ("b", "string")]
    assert [tuple(r) for r in files.read_csv(spark, path, "a long, b string").collect()] == [(1, "x"), (2, None)]


def test_headers_of_several_files_are_dropped(spark, tmp_path):
    paths = []
    for n in range(3):
        path = tmp_path / f"p{n}.csv"
        path.write_text(f"id,v\n{n},x\n{n + 10},y\n")
        paths.append(str(path))
    assert sorted(int(r.id) for r in files.read_csv(spark, paths).collect()) == [0, 1, 2, 10, 11, 12]


def test_json_array_document(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text(json.dumps([{"a": 1, "b": "x"}, {"a": 2}], indent=2))
    assert sorted(map(tuple, files.read_json_documents(spark, str(path)).collect())) == [(1, "x"), (2, None)]


def test_json_pages_and_lines(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "id int, text string")
    files.write_json_documents(paging.paginate(df, "id", 3), str(tmp_path / "pages"))
    assert files.list_files(spark, str(tmp_path / "pages")).filter(F.col("path").endswith(".txt")).count() == 3
    assert sorted(map(tuple, files.read_json_documents(spark, str(tmp_path / "pages"), df.schema).collect())) == AWKWARD
    files.write_ndjson(df, str(tmp_path / "lines"))
    assert sorted(map(tuple, files.read_ndjson(spark, str(tmp_path / "lines"), df.schema).collect())) == AWKWARD


def test_list_files(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.bin").write_bytes(b"123")
    (tmp_path / "b.bin").write_bytes(b"4")
    listed = {r.path.rsplit("/", 1)[-1]: r.length for r in files.list_files(spark, str(tmp_path)).collect()}
    assert listed == {"a.bin": 3, "b.bin": 1}


def test_lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path) + "/")
    assert lake.path("gold", "t") == f"{tmp_path}/gold/t"
    assert lake.read_optional("gold", "t") is None
    lake.overwrite(spark.range(3), "gold", "t")
    lake.overwrite(spark.range(2).withColumn("new", F.lit("x")), "gold", "t")
    assert lake.count("gold", "t") == 2 and lake.read("gold", "t").columns == ["id", "new"]
    lake.append(lake.read("gold", "t").limit(1), "gold", "u")
    lake.append(lake.read("gold", "t").limit(1), "gold", "u")
    assert lake.count("gold", "u") == 2


def test_enforced_schema(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite_enforced(spark.range(3), "silver", "t")
    lake.overwrite_enforced(spark.range(5), "silver", "t")
    for bad in (spark.range(1).withColumn("x", F.lit(1)), spark.range(1).select(F.col("id").cast("string"))):
        with pytest.raises(SchemaMismatch):
            lake.overwrite_enforced(bad, "silver", "t")
    assert lake.count("silver", "t") == 5


ENTRIES = [
    ("a", "json"), ("a", "csv"), ("a", "csv"), ("b", "csv"), ("b", "json"), ("c", "txt"), ("c", "csv"),
    ("d", "pdf"), ("", "csv"), (None, "csv"), ("e", "json"), ("e", "json"),
]


def entries(spark):
    return spark.createDataFrame(
        [(n, key, fmt, f"f{n}", None if n % 2 else 10) for n, (key, fmt) in enumerate(ENTRIES)],
        "position int, dataset_key string, format string, filename string, file_size long",
    )


def test_file_to_load_per_dataset(spark):
    chosen = {r.dataset_key: r.filename for r in manifest.structured_files(entries(spark)).collect()}
    assert chosen == {"a": "f1", "b": "f3", "c": "f5", "e": "f10"}


def test_manifest_totals(spark):
    assert tuple(manifest.totals(entries(spark)).first()) == (12, 60)
    assert tuple(manifest.totals(entries(spark).limit(0)).first()) == (0, 0)
    assert [r.filename for r in manifest.documents(entries(spark)).collect()] == ["f7"]


@pytest.mark.parametrize("mark", [b"", b"\xef\xbb\xbf"])
def test_manifest_scan_with_and_without_byte_order_mark(spark, tmp_path, mark):
    document = {"mode": "sample", "files": [{"filename": "x", "format": "csv", "extra": 1}, {"filename": "y", "file_size": 3}]}
    (tmp_path / "m.json").write_bytes(mark + json.dumps(document, indent=2).encode())
    found = manifest.read_manifest(spark, str(tmp_path / "m.json")).orderBy("position").collect()
    assert [(r.position, r.filename, r.format, r.file_size) for r in found] == [(0, "x", "csv", None), (1, "y", None, 3)]


def test_manifest_roundtrip(spark, tmp_path):
    path = str(tmp_path / "manifest")
    manifest.write_manifest(spark, path, [{"filename": "a", "file_size": 2}, {"filename": "b"}], "full", "now")
    head = spark.read.schema(fixed.MANIFEST_SCHEMA).json(path).first()
    assert (head.mode, head.total_files, head.total_size_bytes) == ("full", 2, 2)
    assert manifest.read_manifest(spark, path).count() == 2


def test_lineage_columns(spark):
    row = lineage.enrich(spark.range(1), {"source": "s", "filename": "f", "ingestion_time": "2024-03-01T12:30:00+00:00", "format": "csv"})
    found = row.selectExpr("_bronze_source", "_bronze_filename", "cast(_bronze_ingestion_time as string)", "_bronze_format").first()
    assert tuple(found) == ("s", "f", "2024-03-01 12:30:00", "csv")
    blank = lineage.enrich(spark.range(1), {}).first()
    assert blank._bronze_source == "" and blank._bronze_ingestion_time is not None
    assert lineage.enrich(spark.range(1), {"ingestion_time": "?"}).first()._bronze_ingestion_time is None


def test_ingestion_records(spark):
    given = spark.createDataFrame(
        [("s", None, "2024-03-01T00:00:00Z", 5), (None, "f", None, None)],
        "source string, filename string, ingestion_time string, file_size int",
    )
    out = lineage.ingestion_records(given)
    assert out.columns == StructType.fromDDL(fixed.INGESTION_LOG_SCHEMA).names
    first, second = out.collect()
    assert (first.source, first.filename, first.file_size, first.format, first.status) == ("s", "unknown", 5, "unknown", "unknown")
    assert (second.source, second.file_size, second.record_count) == ("unknown", 0, None)
    assert second.ingestion_time is not None


def test_document_registry(spark):
    given = spark.createDataFrame([("a", "pdf", None), ("b", "csv", 1), ("c", "pdf", 7)], "filename string, format string, file_size long")
    out = lineage.document_registry(given).orderBy("filename").collect()
    assert [tuple(r) for r in out] == [("", "a", 0, "pdf", "mmwr", "", "success"), ("", "c", 7, "pdf", "mmwr", "", "success")]


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.work_dir(spark) == named.rstrip("/")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
    written = session.write_out(spark.range(3), "test")
    assert written.count() == 3 and "FileScan" in written._jdf.queryExecution().executedPlan().toString()


def test_splits_and_shuffles_fit_the_input(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions"]
    before = {n: spark.conf.get(n) for n in names}
    try:
        session.size_session(spark, 10 * session.MB)
        assert [int(spark.conf.get(n).removesuffix("b")) for n in names] == [128 * session.MB, int(before[names[1]])]
        session.size_session(spark, 100 * 1024**4)
        scan, shuffle = (int(spark.conf.get(n).removesuffix("b")) for n in names)
        assert scan == session.SCAN_BYTES and shuffle == 100 * 1024**4 // session.SHUFFLE_BYTES
        session.size_session(spark, 1024**4)
        assert int(spark.conf.get(names[1])) == shuffle  # never lowered
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
