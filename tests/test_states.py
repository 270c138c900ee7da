import pytest
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators import kpis, states
from lamina.plans import increments
from lamina.plans.increments import BUCKET
from lamina.plans.medallion import Medallion, Source
from lamina.sources.tables import Lake
from test_increments import CASES, case_rows

def measures():
    return {
        "total": ("sum", F.col("v")), "rows": ("count", F.col("v")), "top": ("max", F.col("v")), "low": ("min", F.col("v")), "names": ("set", F.col("name")),
    }


def test_merged_states_are_the_states_of_all(spark, rows):
    df = spark.createDataFrame([(i % 3, None if i % 5 == 0 else i % 2, None if i % 7 == 0 else float(i - 20), "abc"[i % 3]) for i in range(60)], "part int, k int, v double, name string")
    whole = states.states(df, ["k"], measures())
    merged = states.merge(states.states(df, ["part", "k"], measures()), ["k"], {name: kind for name, (kind, _) in measures().items()})
    assert [r[:5] for r in rows(merged)] == [r[:5] for r in rows(whole)]
    assert {r["k"]: r["names"] for r in merged.collect()} == {r["k"]: sorted(r["names"]) for r in whole.collect()}
    assert states.merge(states.states(df.limit(0), ["part", "k"], measures()), ["k"], {"total": "sum"}).count() == 0
    with pytest.raises(ValueError):
        states.merge(df, ["k"], {"v": "median"})


def test_only_touched_buckets_are_read(spark, tmp_path, rows, monkeypatch):
    job = Medallion(Lake(spark, str(tmp_path)), datasets=[fixed.CASES], incremental=True, page_rows=20, silver_buckets=8)
    seen = []
    make = kpis.daily
    monkeypatch.setitem(increments.DAILY_STATES, fixed.CASES, (lambda df, *parts: seen.append({r[0] for r in df.select(BUCKET).distinct().collect()}) or make(df, *parts), kpis.DAILY_KINDS))
    for ids in (range(40), range(41), range(41), [*range(30), *range(34, 41)]):
        job.extract({fixed.CASES: Source(spark.createDataFrame(case_rows(ids), CASES), "rec_id")})
        job.load_bronze()
        assert job.transform_dataset(fixed.CASES)["status"] == "success"
        found = increments.daily_states(job.lake, fixed.CASES)
        want = kpis.daily(job.lake.read("silver", fixed.CASES)).select(*found.columns)
        assert rows(found) == rows(want) and found.count()
    assert len(seen) == 3 and len(seen[1]) == 1  # one new row, one bucket; nothing for the load that brought nothing
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "/silver/" not in plan


def test_states_catch_up_after_a_lost_run(spark, tmp_path, rows):
    job = Medallion(Lake(spark, str(tmp_path)), datasets=[fixed.CASES], incremental=True, page_rows=20, silver_buckets=4)
    assert increments.daily_states(job.lake, fixed.CASES) is None
    for n, ids in enumerate([range(30), range(33), range(36)]):
        job.extract({fixed.CASES: Source(spark.createDataFrame(case_rows(ids), CASES), "rec_id")})
        job.load_bronze()
        job.transform_dataset(fixed.CASES)
        if n != 1:  # the second load never reached the states
            found = increments.daily_states(job.lake, fixed.CASES)
    assert rows(found) == rows(kpis.daily(job.lake.read("silver", fixed.CASES)).select(*found.columns))
