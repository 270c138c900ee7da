from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lamina.operators import runlog

COLUMNS = "ts timestamp, layer string, job_name string, dataset string, reason string, metric string, value double"
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 10)


@pytest.fixture(scope="module")
def log(spark):
    durations = [(T1, "gold", "j", "d", None, runlog.DURATION, v) for v in (0.5, 5.0, 2000.0)]
    return spark.createDataFrame([
        *durations, (T2, "gold", "k", "e", None, runlog.DURATION, 10.0),
        (T1, "silver", "j", "d", "quality", runlog.REJECTS, 3.0), (T2, "silver", "j", "d", "quality", runlog.REJECTS, 4.0),
        (T2, "silver", "j", "d", None, runlog.ROWS, 10.0),
    ], COLUMNS)


def test_histogram_is_cumulative(log):
    counts = {r.le: r.jobs for r in runlog.duration_histogram(log).filter("job_name = 'j'").collect()}
    assert counts == {
        "1": 1, "5": 2, "10": 2, "30": 2, "60": 2, "120": 2, "300": 2, "600": 2, "1800": 2, "+Inf": 3,
    }


def test_sums_and_means(log, rows):
    assert rows(runlog.rows_rejected(log)) == [("silver", "quality", 7.0)]
    assert rows(runlog.rows_inserted(log)) == [("silver", "d", 10.0)]
    assert rows(runlog.mean_duration(log)) == [("gold", "j", pytest.approx(2005.5 / 3)), ("gold", "k", 10.0)]


def test_freshness(log, rows):
    assert rows(runlog.freshness(log, F.lit("2024-01-01 00:11:00"))) == [
        ("gold", "d", 660), ("gold", "e", 60), ("silver", "d", 60),
    ]


def test_tracked_job_is_logged_also_when_it_fails(spark, tmp_path):
    log = runlog.RunLog(spark, str(tmp_path / "log"), mode="full")
    with log.track("gold", "good"):
        pass
    with pytest.raises(KeyError):
        with log.track("gold", "bad"):
            raise KeyError("x")
    log.add(runlog.BYTES, 12, layer="bronze", direction="read")
    assert log.flush() == 1 and log.flush() == 0
    stored = log.read()
    assert stored.filter(F.col("metric") == runlog.DURATION).count() == 2
    assert [(r.job_name, r.error_type) for r in stored.filter(F.col("metric") == runlog.ERRORS).collect()] == [("bad", "KeyError")]
    assert {(r.version, r.mode) for r in stored.collect()} == {("1.0.0", "full")}
    assert [tuple(r) for r in runlog.bytes_processed(stored).collect()] == [("bronze", "read", 12.0)]
    assert [tuple(r) for r in runlog.errors(stored).collect()] == [("gold", 1.0)]
    with pytest.raises(TypeError):
        log.add(runlog.FILES, 1, colour="red")
