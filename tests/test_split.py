import csv
import io
import json
import random

import pytest

from lamina.sources import files, split

KIND = "id int, text string, more string"
TEXTS = ["plain", "a,b", 'say "hi"', "two\nlines", "\n", '"', '""', "cr\r\nlf", " blanks ", 'end"\n"start', "é😀", "x" * 300, "\n\n\n" * 40, "{[}]", "\\", "\\\\\"", ""]


@pytest.fixture
def blocks(spark):
    """Small blocks, so that their borders fall everywhere."""
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def some(seed, n=120):
    rng = random.Random(seed)
    return [(i, rng.choice(TEXTS), rng.choice(TEXTS)) for i in range(n)]


def as_csv(rows, end="\r\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["id", "text", "more"])
    for r in rows:
        writer.writerow(r)
    return out.getvalue()


def found(routed):
    good = sorted(map(str, (tuple(r) for r in routed.good.drop(files.FILE).collect())))
    return good, sorted(r["record"] for r in routed.bad.collect())


@pytest.mark.parametrize("size", [64, 257, 10**6])
def test_csv_as_one_task_reads_it(spark, tmp_path, blocks, size):
    for n, end in enumerate(["\n", "\r\n"]):
        rows = [r for r in some(n) if n == 0 or "\r" not in r[1] + r[2]]
        (tmp_path / f"{n}.csv").write_bytes(as_csv(rows, end).encode())
    (tmp_path / "bad.csv").write_bytes(b'id,text,more\nx,1,2\n1,2\n\n5,"a\nb",c\n6,"a","b\n\n",7\n')
    (tmp_path / "none.csv").write_bytes(b"id,text,more\n")
    blocks(size)
    assert split._pieces(spark, [str(tmp_path)], "\n").rdd.getNumPartitions() > (5 if size < 1000 else 0)
    want = found(files.route_csv(spark, str(tmp_path), KIND))
    assert found(split.scan_csv(spark, str(tmp_path), KIND)) == want
    assert len(want[0]) > 200 and len(want[1]) == 3


def test_csv_written_here(spark, tmp_path, blocks):
    df = spark.createDataFrame([(i, t or None, m) for i, t, m in some(5)], KIND)
    files.write_csv(df.coalesce(1), str(tmp_path / "t"))
    blocks(100)
    got = split.scan_csv(spark, str(tmp_path / "t"), KIND, files.NULL_MARK)
    assert found(got) == (sorted(map(str, (tuple(r) for r in df.collect()))), [])


def test_one_value_over_many_blocks(spark, tmp_path, blocks):
    long = "line\n" * 400
    (tmp_path / "t.csv").write_text(as_csv([(1, long, "a"), (2, "b", long)], "\n"))
    blocks(50)
    got = split.scan_csv(spark, str(tmp_path), KIND).good.drop(files.FILE).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, long, "a"), (2, "b", long)]


def test_another_cut_is_refused(spark, tmp_path, blocks):
    (tmp_path / "t.csv").write_text(as_csv(some(1), "\n"))
    blocks(100)
    pieces = split._pieces(spark, [str(tmp_path)], "\n")
    states = split._states(pieces, split._quotes_of_csv, False)
    states.pop(next(k for k in states if k[1] > 0))
    with pytest.raises(Exception, match="cut differently"):
        split._records(pieces, states, split._CsvEnds(), "\n").count()


@pytest.mark.parametrize("size", [64, 301, 10**6])
@pytest.mark.parametrize("indent", [None, 2])
def test_json_as_one_task_reads_it(spark, tmp_path, blocks, size, indent):
    kind = "id int, text string, nested struct<a: int, b: array<struct<c: string>>>"
    rows = [{"id": i, "text": t, "nested": {"a": i, "b": [{"c": m}] * (i % 3)}} for i, t, m in some(3)]
    rows[5]["id"], rows[7] = "no", 5
    rows[9] = {"id": 9, "text": "{}[]\"}", "other": [[{}]]}
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    (tmp_path / "one.json").write_text(json.dumps(rows[0], indent=indent))
    (tmp_path / "empty.json").write_text(" [ ] \n")
    (tmp_path / "mixed.json").write_text('[1, {"id": 1}, null, {"id": 2}, {"id": 3, "text": "]"}, 4 ]')
    blocks(size)
    want = found(files.route_json(spark, str(tmp_path), kind))
    assert found(split.scan_json(spark, str(tmp_path), kind)) == want
    assert len(want[0]) == len(rows) - 2 + 1 + 3 and len(want[1]) == 2 + 3


def test_the_writer_of_one_file_gets_no_whole_texts(spark, monkeypatch, tmp_path):
    from lamina.plans import queries

    seen, write = [], files.write_csv
    monkeypatch.setattr(queries.files, "write_csv", lambda df, path: (seen.append(df), write(df, path)))
    made = spark.range(50).selectExpr("id AS doc_id", "'en' AS lang", "repeat('long text ', 90) AS text", "900L AS n_chars")
    made.write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.QUERIES["csv_split_scan"](spark, str(tmp_path)).count() == 50
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and plan.index("Exchange") < plan.index("substring") < plan.index("Scan parquet")
    assert seen[0].rdd.getNumPartitions() == 1
