import glob

from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators import kpis, serving, views
from lamina.plans.medallion import Medallion
from lamina.sources.tables import Lake


def silver(spark, days):
    rows = [(f"S{i % 3}", d, float(i), float(i * 2), 1.0, 2.0) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "state_normalized string, end_date_parsed string, new_cases double, tot_cases double, new_deaths double, tot_deaths double").withColumn("end_date_parsed", F.col("end_date_parsed").cast("date"))


def stored(spark, path, days):
    job = Medallion(Lake(spark, str(path)), datasets=[], by_month=True)
    job.lake.overwrite(silver(spark, days), "silver", fixed.CASES)
    job.lake.overwrite(spark.createDataFrame([("S1", "2021-03-20", "7", "3"), ("S2", "2020-03-20", "7", "3")], "location string, date string, administered string, series_complete_yes string"), "silver", fixed.VACCINATIONS)
    assert job.build_gold()["status"] == "success" and job.load_warehouse()["status"] == "success", job.load_warehouse()
    return job


def test_only_the_months_of_the_days_are_read(spark, tmp_path, rows):
    days = ["2020-01-05", "2020-02-05", "2021-02-21", "2021-02-10", "2021-03-20", "2021-03-22", "2021-03-22", None]
    job = stored(spark, tmp_path, days)
    daily = kpis.daily(job.lake.read("silver", fixed.CASES))
    whole = views.dashboard(kpis.cases_per_day(daily), kpis.deaths_per_day(daily), kpis.vaccination_vs_cases(kpis.vaccination_daily(job.lake.read("silver", fixed.VACCINATIONS).withColumn("date", F.col("date").cast("date"))), daily))
    want = rows(whole.filter("report_date >= DATE '2021-02-20'"))
    for f in glob.glob(str(tmp_path) + "/gold/*/report_month=2020-0[23]*/*.parquet"):
        with open(f, "w") as broken:
            broken.write("not read")
    found = job.last_days(30, "gold")
    assert rows(found) == want and len(want) == 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(report_month") in (3, 6)  # three scans, in the final and in the first plan
    assert job.last_days(30).count() == 4


def test_the_newest_month_comes_from_names(spark, tmp_path):
    job = stored(spark, tmp_path, ["2020-01-05", None, "2019-12-31"])
    assert job.lake.newest("gold", "kpi_cases_per_day", serving.MONTH) == "2020-01-01"
    assert job.last_days(6, "gold").count() == 2
    empty = stored(spark, tmp_path / "none", [None])
    assert empty.lake.newest("gold", "kpi_cases_per_day", serving.MONTH) is None and empty.last_days(6, "gold").count() == 0
