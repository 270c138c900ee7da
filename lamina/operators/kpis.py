"""Indicator tables of the gold layer.

All of them start from ``groupBy(state, report_date)`` or ``groupBy(state)``.
Sums and maxima are combined before the shuffle, so the shuffled data is at most
one row per task and group, however the rows are spread over the states.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.functions.columns import first_present, number, percent, quoted

KEY = ["state", "report_date"]

# How the daily measures of parts of the data merge.
DAILY_KINDS = {
    "new_cases": "sum", "cumulative_cases": "max", "new_deaths": "sum", "cumulative_deaths": "max", "summed_cases": "sum", "summed_deaths": "sum",
}
VACCINATION_KINDS = {"doses_administered": "max", "fully_vaccinated": "max"}


def empty(spark: SparkSession, table: str) -> DataFrame:
    """The typed empty indicator table, used where an input table is missing."""
    return spark.createDataFrame([], fixed.GOLD_SCHEMAS[table])


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("updated_at", F.current_timestamp())


def _case_keys(cases: DataFrame) -> list[Column]:
    return [
        quoted(first_present(cases, "state_normalized", "state")).alias("state"),
        quoted(first_present(cases, "end_date_parsed", "end_date")).alias("report_date"),
    ]


def daily(cases: DataFrame, *parts: str) -> DataFrame:
    """Every case measure per state and date, in one aggregation; the case indicators derive from it.

    With ``parts``, columns that divide the table, they are states per part, which merge by DAILY_KINDS.
    """
    new_cases, tot_cases = number(F.col("new_cases")), number(F.col("tot_cases"))
    new_deaths, tot_deaths = number(F.col("new_deaths")), number(F.col("tot_deaths"))
    return cases.groupBy(*map(quoted, parts), *_case_keys(cases)).agg(
        F.sum(new_cases).alias("new_cases"),
        F.max(tot_cases).alias("cumulative_cases"),
        F.sum(new_deaths).alias("new_deaths"),
        F.max(tot_deaths).alias("cumulative_deaths"),
        F.sum(tot_cases).alias("summed_cases"),
        F.sum(tot_deaths).alias("summed_deaths"),
    )


def incidence_by_region(daily_cases: DataFrame) -> DataFrame:
    """Total cases and deaths, deaths per cases and last date per state.

    The totals are cumulative counts, so summing them counts earlier weeks again;
    incidence_rate and mortality_rate are the same ratio. Both are part of the contract.
    """
    totals = daily_cases.groupBy("state").agg(
        F.sum("summed_cases").alias("total_cases"),
        F.sum("summed_deaths").alias("total_deaths"),
        F.max("report_date").alias("report_date"),
    )
    rate = percent(F.col("total_deaths"), F.col("total_cases"))
    return totals.select(
        F.col("state").alias("region"), "state", "total_cases", "total_deaths",
        rate.alias("incidence_rate"), rate.alias("mortality_rate"), "report_date",
    )


def cases_per_day(daily_cases: DataFrame) -> DataFrame:
    return daily_cases.select("report_date", "state", "new_cases", "cumulative_cases")


def deaths_per_day(daily_cases: DataFrame) -> DataFrame:
    return daily_cases.select("report_date", "state", "new_deaths", "cumulative_deaths")


def hospitalizations_by_region(
    daily_cases: DataFrame,
    hospital_share: float = fixed.HOSPITAL_SHARE,
    intensive_care_share: float = fixed.INTENSIVE_CARE_SHARE,
) -> DataFrame:
    """Hospital and intensive-care patients, estimated as shares of the new cases.

    The share is applied to the sum: case counts add up exactly, so the result does
    not depend on the order in which tasks deliver their sums.
    """
    return daily_cases.select(
        F.col("state").alias("region"), "state",
        (F.col("new_cases") * hospital_share).alias("hospitalized"),
        (F.col("new_cases") * intensive_care_share).alias("icu_patients"),
        "report_date",
    )


def vaccination_daily(vaccinations: DataFrame, *parts: str) -> DataFrame:
    """Highest dose counts per state and date; with ``parts`` as in :func:`daily`."""
    return vaccinations.groupBy(
        *map(quoted, parts),
        quoted(first_present(vaccinations, "location_normalized", "location")).alias("state"),
        quoted(first_present(vaccinations, "date_parsed", "date")).alias("report_date"),
    ).agg(
        F.max(number(F.col("administered"))).alias("doses_administered"),
        F.max(number(F.col("series_complete_yes"))).alias("fully_vaccinated"),
    )


def vaccination_vs_cases(vaccination: DataFrame, daily_cases: DataFrame) -> DataFrame:
    """Vaccinations beside new cases, keeping states and dates found on one side only.

    Both sides are already partitioned by state and date, so the join adds no shuffle.
    Null dates match nothing and stay as rows of their own.
    """
    joined = vaccination.join(daily_cases.select(*KEY, "new_cases"), on=KEY, how="outer").fillna(0)
    return joined.withColumn(
        "vaccination_rate", percent(F.col("fully_vaccinated"), F.col("doses_administered"))
    )


def temporal_evolution(daily_cases: DataFrame) -> DataFrame:
    """New cases and new deaths in long form: two rows per state and date."""
    return daily_cases.select(*KEY, "new_cases", "new_deaths").unpivot(
        KEY, ["new_cases", "new_deaths"], "metric_name", "metric_value"
    )
