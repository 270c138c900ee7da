"""The three reporting views over the indicator tables.

Each comes without its order, so that queries on top of it do not sort first; the
functions at the end give the order in which a view is shown.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.columns import percent
from lamina.operators.ranged import with_previous


def dashboard(cases: DataFrame, deaths: DataFrame, vaccination: DataFrame) -> DataFrame:
    """Cases with deaths and vaccinations of the same date and state, where there are any."""
    key = ["report_date", "state"]
    return (
        cases.select(*key, "new_cases", "cumulative_cases")
        .join(deaths.select(*key, "new_deaths", "cumulative_deaths"), key, "left")
        .join(vaccination.select(*key, "doses_administered", "fully_vaccinated", "vaccination_rate"), key, "left")
    )


def dashboard_from_daily(daily_cases: DataFrame, vaccination_daily: DataFrame) -> DataFrame:
    """The same rows as :func:`dashboard`, straight from the two daily aggregates.

    Cases and deaths share one aggregate, and every complete case key is in the
    vaccination table because that is an outer join with the cases. So one left join
    is enough; keys with a null part match nothing and keep nulls.
    """
    key = ["report_date", "state"]
    matched = F.col("report_date").isNotNull() & F.col("state").isNotNull()
    joined = daily_cases.join(vaccination_daily, key, "left")
    doses = F.coalesce("doses_administered", F.lit(0.0))
    full = F.coalesce("fully_vaccinated", F.lit(0.0))
    return joined.select(
        *key, "new_cases", "cumulative_cases",
        F.when(matched, F.col("new_deaths")).alias("new_deaths"),
        F.when(matched, F.col("cumulative_deaths")).alias("cumulative_deaths"),
        F.when(matched, doses).alias("doses_administered"),
        F.when(matched, full).alias("fully_vaccinated"),
        F.when(matched, percent(full, doses)).alias("vaccination_rate"),
    )


def regional_summary(incidence: DataFrame) -> DataFrame:
    """Totals, mean rate and last date per region and state."""
    return incidence.groupBy("region", "state").agg(
        F.sum("total_cases").alias("total_cases"),
        F.sum("total_deaths").alias("total_deaths"),
        F.avg("incidence_rate").alias("avg_incidence_rate"),
        F.max("report_date").alias("last_report_date"),
    )


def temporal_trends(temporal: DataFrame, ranged: bool = False) -> DataFrame:
    """Each metric with its previous value and the change since then.

    The input has one row per state, metric and date, so a window partition is no
    longer than the number of dates. Where that is not so, as for measurements by the second, ``ranged``
    spreads a group over many tasks.
    """
    if ranged:
        found = with_previous(temporal, ["state", "metric_name"], [F.asc_nulls_last("report_date")], "metric_value", "previous_value")
        return found.select("state", "report_date", "metric_name", "metric_value", "previous_value").withColumn("change", F.col("metric_value") - F.col("previous_value"))
    by_date = Window.partitionBy("state", "metric_name").orderBy(F.asc_nulls_last("report_date"))
    previous = F.lag("metric_value").over(by_date)
    return temporal.select(
        "state", "report_date", "metric_name", "metric_value", previous.alias("previous_value")
    ).withColumn("change", F.col("metric_value") - F.col("previous_value"))


def newest_first(dashboard: DataFrame) -> DataFrame:
    return dashboard.orderBy(F.desc_nulls_first("report_date"), F.asc_nulls_last("state"))


def most_cases_first(regional: DataFrame) -> DataFrame:
    return regional.orderBy(F.desc_nulls_first("total_cases"), F.asc_nulls_last("region"), F.asc_nulls_last("state"))


def by_state_and_date(trends: DataFrame) -> DataFrame:
    return trends.orderBy(F.asc_nulls_last("state"), F.asc_nulls_last("report_date"))
