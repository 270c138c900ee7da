"""Queries that dashboards and notebooks ask of the indicator tables.

Sorting follows the warehouse: descending puts nulls first, ascending puts them
last. A tie-break on the key makes every limited result unique.
"""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators.views import most_cases_first, newest_first


def query(spark: SparkSession, text: str, params: Mapping | None = None) -> DataFrame:
    """SQL with named parameters (``:name``) over the registered warehouse tables and views."""
    return spark.sql(text, args=dict(params or {}))


def checked_limit(name: str, limit: int) -> int:
    low, high = fixed.LIMITS[name]
    if not low <= limit <= high:
        raise ValueError(f"limit of {name} must be between {low} and {high}, got {limit}")
    return limit


def is_national(state: Column) -> Column:
    return F.upper(state).isin(fixed.NATIONAL)


def is_regional(state: Column) -> Column:
    """Not the national row; a null state is neither."""
    return ~F.upper(state).isin(fixed.NATIONAL_EXCLUDED)


def case_totals(cases: DataFrame) -> DataFrame:
    return cases.agg(
        F.coalesce(F.sum("new_cases"), F.lit(0)).alias("total_new_cases"),
        F.countDistinct("state").alias("states_count"),
        F.max("report_date").alias("latest_report_date"),
    )


def death_totals(deaths: DataFrame) -> DataFrame:
    return deaths.agg(F.coalesce(F.sum("new_deaths"), F.lit(0)).alias("total_new_deaths"))


def national_snapshot(vaccination: DataFrame) -> DataFrame:
    """The latest national vaccination row, if there is one."""
    return (
        vaccination.filter(is_national(F.col("state")))
        .orderBy(
            F.desc_nulls_first("report_date"), F.asc_nulls_last("state"),
            F.asc("doses_administered"), F.asc("fully_vaccinated"),
        )
        .limit(1)
        .select(
            F.col("doses_administered").alias("total_doses"),
            F.col("fully_vaccinated").alias("total_fully_vaccinated"),
            F.col("report_date").alias("vaccination_snapshot_date"),
        )
    )


def latest_per_state(vaccination: DataFrame) -> DataFrame:
    """All rows that carry the last date of their state, national rows left out."""
    regional = vaccination.filter(is_regional(F.col("state")))
    latest = regional.groupBy("state").agg(F.max("report_date").alias("report_date"))
    return regional.join(latest, ["state", "report_date"])


def vaccination_totals(vaccination: DataFrame) -> DataFrame:
    """The national row if there is one, else the sum of the latest rows per state.

    Both are taken in one pass: per state and date, then per state, then over all. Nulls
    first in descending date order is ascending order of (has a date, days back).
    """
    state, date = F.col("state"), F.col("report_date")
    national = F.struct(
        date.isNotNull().alias("dated"), (-F.unix_date(date)).alias("back"), "state",
        F.col("doses_administered").alias("doses"), F.col("fully_vaccinated").alias("full"), "report_date",
    )
    per_date = vaccination.groupBy("state", "report_date").agg(
        F.sum("doses_administered").alias("doses"), F.sum("fully_vaccinated").alias("full"),
        F.min(F.when(is_national(state), national)).alias("national"),
    )
    per_state = per_date.groupBy("state").agg(
        F.max(F.when(is_regional(state) & date.isNotNull(), F.struct("report_date", "doses", "full"))).alias("latest"),
        F.min("national").alias("national"),
    )
    found = per_state.agg(
        F.min("national").alias("national"), F.sum("latest.doses").alias("doses"),
        F.sum("latest.full").alias("full"), F.max("latest.report_date").alias("report_date"),
    )
    return found.select(*[
        F.when(F.col("national").isNotNull(), F.col(f"national.{c}")).otherwise(F.col(c)).alias(name)
        for c, name in [
            ("doses", "total_doses"), ("full", "total_fully_vaccinated"), ("report_date", "vaccination_snapshot_date")
        ]
    ])


def _overlaid(*parts: DataFrame) -> DataFrame:
    """One row from tables of one row each with different columns."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def summary(cases: DataFrame, deaths: DataFrame, vaccination: DataFrame) -> DataFrame:
    """One row of headline figures from the three indicator tables."""
    return _overlaid(case_totals(cases), death_totals(deaths), vaccination_totals(vaccination))


def summary_from_daily(daily_cases: DataFrame, vaccination: DataFrame) -> DataFrame:
    """The same figures where cases and deaths are still one daily aggregate."""
    totals = daily_cases.agg(
        F.coalesce(F.sum("new_cases"), F.lit(0)).alias("total_new_cases"),
        F.countDistinct("state").alias("states_count"),
        F.max("report_date").alias("latest_report_date"),
        F.coalesce(F.sum("new_deaths"), F.lit(0)).alias("total_new_deaths"),
    )
    return _overlaid(totals, vaccination_totals(vaccination))


def state_totals(dashboard: DataFrame) -> DataFrame:
    return dashboard.groupBy("state").agg(
        F.sum("new_cases").alias("total_cases"), F.sum("new_deaths").alias("total_deaths")
    )


def top_states(dashboard: DataFrame, limit: int = 10) -> DataFrame:
    """The states with most cases."""
    limit = checked_limit("top_states", limit)
    return (
        state_totals(dashboard)
        .orderBy(F.desc_nulls_first("total_cases"), F.asc_nulls_last("state"))
        .limit(limit)
    )


def timeline(metric: str, cases: DataFrame, deaths: DataFrame) -> DataFrame:
    """New cases or new deaths per date."""
    if metric not in ("cases", "deaths"):
        raise ValueError(f"metric must be cases or deaths, got {metric!r}")
    table, column = (cases, "new_cases") if metric == "cases" else (deaths, "new_deaths")
    return table.groupBy("report_date").agg(F.sum(column).alias("value")).orderBy(F.asc_nulls_last("report_date"))


def regional_top(regional: DataFrame, limit: int = 20) -> DataFrame:
    """The regions with most cases, from the regional view."""
    limit = checked_limit("regional", limit)
    return most_cases_first(regional.select(
        "region", "state", "total_cases", "total_deaths", "avg_incidence_rate", "last_report_date"
    )).limit(limit)


def dashboard_latest(dashboard: DataFrame, limit: int = 50) -> DataFrame:
    """The newest rows of the dashboard view."""
    limit = checked_limit("dashboard", limit)
    return newest_first(dashboard.select(
        "report_date", "state", "new_cases", "new_deaths", "doses_administered", "fully_vaccinated", "vaccination_rate"
    )).limit(limit)


def trailing(df: DataFrame, as_of: Column, days: int = 30, date: str = "report_date") -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of`` and after it."""
    return df.filter(F.col(date) >= F.date_sub(as_of, days))


MONTH = "report_month"


def with_month(df: DataFrame) -> DataFrame:
    """Add the first day of the month, by which tables of indicators are partitioned, and bring each month together."""
    return df.withColumn(MONTH, F.trunc("report_date", "month")).repartition(MONTH)


def recent(table: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """As :func:`trailing`, of a table that is partitioned by month: no other months are read."""
    since = F.date_sub(as_of, days)
    return trailing(table.filter(F.col(MONTH) >= F.trunc(since, "month")), as_of, days).drop(MONTH)


def metric_trend(trends: DataFrame, state: str, metric_name: str) -> DataFrame:
    return trends.filter((F.col("state") == state) & (F.col("metric_name") == metric_name))


def weekly_deaths(deaths: DataFrame) -> DataFrame:
    """Deaths per week, weeks starting on Monday."""
    return (
        deaths.groupBy(F.date_trunc("week", F.col("report_date")).cast("date").alias("week"))
        .agg(F.sum("new_deaths").alias("weekly_deaths"))
        .orderBy(F.asc_nulls_last("week"))
    )


def rate_by_state(vaccination: DataFrame) -> DataFrame:
    """Mean vaccination rate and total cases per state."""
    return (
        vaccination.groupBy("state")
        .agg(F.avg("vaccination_rate").alias("avg_vaccination_rate"), F.sum("new_cases").alias("total_cases"))
        .orderBy(F.desc_nulls_first("avg_vaccination_rate"), F.asc_nulls_last("state"))
    )


def recent_top_states(cases: DataFrame, recent: int = 100, top: int = 10) -> DataFrame:
    """The states with most cases among the newest ``recent`` rows."""
    return (
        newest_first(cases)
        .limit(recent)
        .groupBy("state")
        .agg(F.sum("new_cases").alias("new_cases"))
        .orderBy(F.desc("new_cases"), F.asc_nulls_last("state"))
        .limit(top)
    )


def records(df: DataFrame) -> DataFrame:
    """Each row as a JSON object: temporal values as text, nulls and NaN as null."""
    def plain(field):
        col = F.col(f"`{field.name}`")
        kind = field.dataType.typeName()
        if kind in ("date", "timestamp", "timestamp_ntz"):
            return col.cast("string").alias(field.name)
        if kind in ("double", "float"):
            return F.nanvl(col, F.lit(None).cast(kind)).alias(field.name)
        return col

    return df.select(F.to_json(F.struct(*[plain(f) for f in df.schema]), {"ignoreNullFields": "false"}).alias("record"))
