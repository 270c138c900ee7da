"""Equivalent SQL for the registered queries, for an independent engine (DuckDB) over the same tables."""

from lamina.functions import fixed
from lamina.plans import fixtures


class _Names(dict):
    """``{name}`` in a fixture stands for the table of that name."""

    def __missing__(self, key: str) -> str:
        return key


def _fixture(text: str) -> str:
    return text.format_map(_Names())


def _date(c: str) -> str:
    return (
        f"coalesce(try_cast(try_strptime(regexp_extract({c}, '^([0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}})', 1), '%Y-%m-%d') AS DATE),"
        f" try_cast(try_strptime(regexp_extract({c}, '^([0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}})', 1), '%m/%d/%Y') AS DATE))"
    )


def _count(c: str) -> str:
    """A cleaned count: number, null as 0, negative as 0."""
    return f"greatest(coalesce(try_cast({c} AS DOUBLE), 0.0::DOUBLE), 0.0::DOUBLE)"


def _num(c: str) -> str:
    return f"coalesce(try_cast({c} AS DOUBLE), 0.0::DOUBLE)"


_STATES = ", ".join(f"('{code}', '{name}')" for code, name in fixed.STATE_NAMES.items())

_CASES_CLEAN = f"""
SELECT r.rec_id, coalesce(r.state, 'Unknown') AS state, coalesce(r.end_date, 'Unknown') AS end_date,
  {_count('r.new_cases')} AS new_cases, {_count('r.tot_cases')} AS tot_cases,
  {_count('r.new_deaths')} AS new_deaths, {_count('r.tot_deaths')} AS tot_deaths,
  coalesce(s.name, r.state, 'Unknown') AS state_normalized, {_date('r.end_date')} AS end_date_parsed
FROM cases_raw r LEFT JOIN state_names s ON upper(r.state) = s.code
"""

_VACC_CLEAN = f"""
SELECT coalesce(r.location, 'Unknown') AS location, coalesce(r.date, 'Unknown') AS date,
  coalesce(r.administered, 'Unknown') AS administered, coalesce(r.series_complete_yes, 'Unknown') AS series_complete_yes,
  coalesce(s.name, r.location, 'Unknown') AS location_normalized, {_date('r.date')} AS date_parsed
FROM vacc_raw r LEFT JOIN state_names s ON upper(r.location) = s.code
"""

_RESP_CLEAN = f"""
SELECT r.week_ending_date, r.jurisdiction, r.age_group,
  {_count('r.covid_19_deaths')} AS covid_19_deaths, {_count('r.pneumonia_deaths')} AS pneumonia_deaths,
  {_count('r.influenza_deaths')} AS influenza_deaths,
  coalesce(s.name, r.jurisdiction) AS jurisdiction_normalized, {_date('r.week_ending_date')} AS week_ending_date_parsed
FROM resp_raw r LEFT JOIN state_names s ON upper(r.jurisdiction) = s.code
"""


def _first(table: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn"
        f" FROM {table}) x WHERE rn = 1"
    )


_PERCENT_FULL = "CASE WHEN doses_administered > 0 THEN fully_vaccinated / doses_administered * 100 ELSE 0.0::DOUBLE END"

_CTES = {
    "state_names(code, name)": f"VALUES {_STATES}",
    "cases_raw": _fixture(fixtures.CASES_RAW),
    "vacc_raw": _fixture(fixtures.VACCINATIONS_RAW),
    "resp_raw": _fixture(fixtures.RESPIRATORY_RAW),
    "flu_raw": _fixture(fixtures.FLU_RAW),
    "manifest_files": _fixture(fixtures.MANIFEST_FILES),
    "pages_raw": _fixture(fixtures.PAGES),
    "run_log": _fixture(fixtures.RUN_LOG),
    "cases_all": _CASES_CLEAN,
    "cases": _first("cases_all", "end_date, state", "rec_id"),
    "vacc_all": _VACC_CLEAN,
    "vacc": _first("vacc_all", "date, location", "administered, series_complete_yes"),
    "resp_all": _RESP_CLEAN,
    "resp": _first(
        "resp_all", "week_ending_date, jurisdiction, age_group", "covid_19_deaths, pneumonia_deaths, influenza_deaths"
    ),
    "flu": _first("flu_raw", "year_season, month, geography, dimension", "coverage_estimate"),
    "cases_day": """
        SELECT end_date_parsed AS report_date, state_normalized AS state,
          sum(new_cases) AS new_cases, max(tot_cases) AS cumulative_cases
        FROM cases GROUP BY 1, 2""",
    "deaths_day": """
        SELECT end_date_parsed AS report_date, state_normalized AS state,
          sum(new_deaths) AS new_deaths, max(tot_deaths) AS cumulative_deaths
        FROM cases GROUP BY 1, 2""",
    "hospital": """
        SELECT state_normalized AS region, state_normalized AS state,
          sum(new_cases * 0.05::DOUBLE) AS hospitalized, sum(new_cases * 0.01::DOUBLE) AS icu_patients,
          end_date_parsed AS report_date
        FROM cases GROUP BY state_normalized, end_date_parsed""",
    "incidence": """
        SELECT state AS region, state, total_cases, total_deaths,
          CASE WHEN total_cases > 0 THEN total_deaths / total_cases * 100 ELSE 0.0::DOUBLE END AS incidence_rate,
          CASE WHEN total_cases > 0 THEN total_deaths / total_cases * 100 ELSE 0.0::DOUBLE END AS mortality_rate,
          report_date
        FROM (SELECT state_normalized AS state, sum(tot_cases) AS total_cases, sum(tot_deaths) AS total_deaths,
                max(end_date_parsed) AS report_date FROM cases GROUP BY 1) x""",
    "vacc_day": f"""
        SELECT location_normalized AS state, date_parsed AS report_date,
          max({_num('administered')}) AS doses_administered, max({_num('series_complete_yes')}) AS fully_vaccinated
        FROM vacc GROUP BY 1, 2""",
    "vacc_cases": f"""
        SELECT state, report_date, doses_administered, fully_vaccinated, new_cases, {_PERCENT_FULL} AS vaccination_rate
        FROM (SELECT coalesce(v.state, c.state) AS state, coalesce(v.report_date, c.report_date) AS report_date,
                coalesce(v.doses_administered, 0) AS doses_administered,
                coalesce(v.fully_vaccinated, 0) AS fully_vaccinated, coalesce(c.new_cases, 0) AS new_cases
              FROM vacc_day v FULL OUTER JOIN cases_day c ON v.state = c.state AND v.report_date = c.report_date) x""",
    "temporal": """
        SELECT state, report_date, 'new_cases' AS metric_name, new_cases AS metric_value FROM cases_day
        UNION ALL SELECT state, report_date, 'new_deaths', new_deaths FROM deaths_day""",
    "dashboard": """
        SELECT c.report_date, c.state, c.new_cases, c.cumulative_cases, d.new_deaths, d.cumulative_deaths,
          v.doses_administered, v.fully_vaccinated, v.vaccination_rate
        FROM cases_day c LEFT JOIN deaths_day d ON c.report_date = d.report_date AND c.state = d.state
        LEFT JOIN vacc_cases v ON c.report_date = v.report_date AND c.state = v.state""",
    "regional": """
        SELECT region, state, sum(total_cases) AS total_cases, sum(total_deaths) AS total_deaths,
          avg(incidence_rate) AS avg_incidence_rate, max(report_date) AS last_report_date
        FROM incidence GROUP BY region, state""",
    "trends": """
        SELECT state, report_date, metric_name, metric_value,
          lag(metric_value) OVER (PARTITION BY state, metric_name ORDER BY report_date NULLS LAST) AS previous_value,
          metric_value - lag(metric_value) OVER (PARTITION BY state, metric_name ORDER BY report_date NULLS LAST) AS change
        FROM temporal""",
    "ingestion": """
        SELECT coalesce(source, 'unknown') AS source, filename,
          replace(replace(ingestion_time, 'T', ' '), 'Z', '') AS ingestion_time,
          coalesce(file_size, 0)::BIGINT AS file_size, format, coalesce(status, 'unknown') AS status, dataset_key,
          NULL::BIGINT AS record_count, NULL::VARCHAR AS object_name
        FROM manifest_files""",
}

_WITH = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _CTES.items()) + "\n"


def _round(*columns: str) -> str:
    return ", ".join(f"round({c}, 4) AS {c}" for c in columns)


def _pages(n: int) -> str:
    return f"(row_number() OVER (ORDER BY o_orderkey) - 1) // {n}"


_DASH = (
    "report_date, state, " + _round("new_cases", "cumulative_cases", "new_deaths", "cumulative_deaths",
                                    "doses_administered", "fully_vaccinated", "vaccination_rate")
)
_VACC = "state, report_date, " + _round("doses_administered", "fully_vaccinated", "new_cases", "vaccination_rate")
_TREND = "state, report_date, metric_name, " + _round("metric_value", "previous_value", "change")
_REGION = "region, state, " + _round("total_cases", "total_deaths", "avg_incidence_rate") + ", last_report_date"
_REGION_ORDER = "ORDER BY total_cases DESC NULLS FIRST, region NULLS LAST, state NULLS LAST"


def _summary(vaccination: str, national: str) -> str:
    return f"""
SELECT round(c.total_new_cases, 4) AS total_new_cases, c.states_count, c.latest_report_date,
  round(d.total_new_deaths, 4) AS total_new_deaths, round(v.total_doses, 4) AS total_doses,
  round(v.total_fully_vaccinated, 4) AS total_fully_vaccinated, v.vaccination_snapshot_date
FROM (SELECT coalesce(sum(new_cases), 0) AS total_new_cases, count(DISTINCT state) AS states_count,
        max(report_date) AS latest_report_date FROM cases_day) c,
  (SELECT coalesce(sum(new_deaths), 0) AS total_new_deaths FROM deaths_day) d,
  ({national if national else f'''
    SELECT sum(v.doses_administered) AS total_doses, sum(v.fully_vaccinated) AS total_fully_vaccinated,
      max(v.report_date) AS vaccination_snapshot_date
    FROM ({vaccination}) v JOIN (SELECT state, max(report_date) AS max_date FROM ({vaccination}) w
      WHERE upper(state) NOT IN ('US', 'UNITED STATES', 'USA') GROUP BY state) l
    ON v.state = l.state AND v.report_date = l.max_date'''}) v
"""


_NATIONAL = """
SELECT doses_administered AS total_doses, fully_vaccinated AS total_fully_vaccinated,
  report_date AS vaccination_snapshot_date
FROM vacc_cases WHERE upper(state) IN ('US', 'UNITED STATES') ORDER BY report_date DESC NULLS FIRST LIMIT 1
"""


def _between(c: str, low: str, high: str | None = None) -> str:
    upper = "" if high is None else f" AND try_cast({c} AS DOUBLE) <= {high}"
    return f"avg(CASE WHEN try_cast({c} AS DOUBLE) >= {low}{upper} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


def _expectations(table: str, dataset: str, checks: list[tuple[str, str, str, str | None, str]]) -> str:
    """checks: (type, column, measured value, threshold, test of m)."""
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, {i}::INTEGER AS position, '{kind}' AS expectation, '{column}' AS column_name,"
        f" round(m, 4) AS observed, {threshold or 'NULL'}::DOUBLE AS threshold, {test} AS success, '' AS note"
        f" FROM (SELECT ({value})::DOUBLE AS m FROM {table}) t{i}"
        for i, (kind, column, value, threshold, test) in enumerate(checks)
    )


def _rate_check(column: str, value: str, threshold: str, kind: str = fixed.BETWEEN) -> tuple:
    return (kind, column, value, threshold, f"coalesce(m >= {threshold}, false)")


_ROWS_CHECK = (fixed.ROW_COUNT, "", "count(*)", None, "m >= 1")


def _exists(column: str) -> tuple:
    return (fixed.COLUMN_EXISTS, column, "CASE WHEN count(*) >= 0 THEN NULL END", None, "true")


def _cases_checks(table: str) -> str:
    return _expectations(table, fixed.CASES, [
        _ROWS_CHECK, _exists("state"),
        _rate_check("state", "avg(CASE WHEN state IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", "0.95", fixed.NOT_NULL),
        _rate_check("new_cases", _between("new_cases", "0"), "0.99"),
        _rate_check("new_deaths", _between("new_deaths", "0"), "0.99"),
    ])


_VACC_CHECKS = _expectations("vacc", fixed.VACCINATIONS, [
    _ROWS_CHECK, _exists("location"),
    _rate_check("administered", _between("administered", "0"), "0.95"),
    _rate_check("series_complete_yes", _between("series_complete_yes", "0"), "0.95"),
])
_RESP_CHECKS = _expectations("resp_raw", fixed.RESPIRATORY_DEATHS, [
    _ROWS_CHECK, _exists("jurisdiction"), _rate_check("covid_19_deaths", _between("covid_19_deaths", "0"), "0.99"),
])
_FLU_CHECKS = _expectations("flu_raw", fixed.FLU_COVERAGE, [
    _ROWS_CHECK, _exists("geography"),
    _rate_check("coverage_estimate", _between("coverage_estimate", "0", "100"), "0.95"),
])

_BOUNDS = ", ".join(f"('{b}', {b}::DOUBLE)" for b in fixed.DURATION_BOUNDS) + ", ('+Inf', 'inf'::DOUBLE)"


def _metric(labels: str, metric: str, value: str) -> str:
    return f"SELECT {labels}, {value} FROM run_log WHERE metric = '{metric}' GROUP BY {labels}"


def _text(table: str, whole: bool = False) -> str:
    text = "string_agg(text, chr(10) || chr(10) ORDER BY page_number)"
    return f"""
SELECT source_file, count(*)::BIGINT AS total_pages, sum(length(text))::BIGINT AS total_characters,
  {text if whole else f'left({text}, 10000)'} AS full_text
FROM (SELECT source_file, page_number, coalesce(text, '') AS text FROM {table}) p GROUP BY source_file
"""


_VALUES = {
    "kpi_incidence_by_region": "total_cases", "kpi_cases_per_day": "new_cases", "kpi_deaths_per_day": "new_deaths",
    "kpi_hospitalizations_by_region": "hospitalized", "kpi_vaccination_vs_cases": "doses_administered",
    "kpi_temporal_evolution_by_state": "metric_value",
}


def _rows(layer: str, table: str, source: str, where: str = "") -> str:
    found = "NULL::DOUBLE AS total, NULL::DATE AS first_date, NULL::DATE AS last_date"
    if table in _VALUES:
        value = _VALUES[table]
        if layer == "warehouse" and value != "metric_value":
            value = f"round(round({value}, 6))"
        found = f"round(sum({value})::DOUBLE, 2) AS total, min(report_date) AS first_date, max(report_date) AS last_date"
    return f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS table_rows, {found} FROM {source}{where}"


_GOLD = {
    "kpi_incidence_by_region": ("incidence", ""),
    "kpi_cases_per_day": ("cases_day", " WHERE report_date IS NOT NULL"),
    "kpi_deaths_per_day": ("deaths_day", " WHERE report_date IS NOT NULL"),
    "kpi_hospitalizations_by_region": ("hospital", ""),
    "kpi_vaccination_vs_cases": ("vacc_cases", ""),
    "kpi_temporal_evolution_by_state": ("temporal", " WHERE report_date IS NOT NULL"),
}
_BRONZE = {fixed.CASES: "cases_raw", fixed.VACCINATIONS: "vacc_raw", fixed.RESPIRATORY_DEATHS: "resp_raw", fixed.FLU_COVERAGE: "flu_raw"}
_SILVER = {
    fixed.CASES: "cases", fixed.VACCINATIONS: "vacc", fixed.RESPIRATORY_DEATHS: "resp", fixed.FLU_COVERAGE: "flu",
    "document_text": "(SELECT DISTINCT source_file FROM pages_raw) d",
}

_DAYS = "SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, o_custkey, o_totalprice FROM orders"


def _filled(order: str, size: int, rows: str = "orders") -> str:
    """Rows with the page of a keyset extract whose late rows (keys that end in 7) came when its pages were there already."""
    return f"""
        SELECT *, CASE WHEN late AND before = total THEN (total + {size - 1}) // {size} + 1 ELSE before // {size} + 1 END AS page, total FROM (
          SELECT *, o_orderkey % 10 = 7 AS late, count(*) FILTER (WHERE o_orderkey % 10 <> 7) OVER () AS total,
            coalesce(count(*) FILTER (WHERE o_orderkey % 10 <> 7) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM {rows}) x"""


_SQL = {
    "keyset_ties": f"SELECT day, o_orderkey, (rank() OVER (ORDER BY day NULLS FIRST) - 1) // 2000 AS page FROM ({_DAYS}) d",
    "keyset_resumed": f"""
        SELECT page::BIGINT AS page, count(*) AS page_rows, sum(o_orderkey)::BIGINT AS keys,
          (1 + CAST(bool_or(late) AND page <= (max(total) + 1999) // 2000 AS INTEGER))::BIGINT AS times_written
        FROM ({_filled('day NULLS FIRST, o_orderkey', 2000, f'({_DAYS}) d')}) f GROUP BY page""",
    "incremental_bronze": " UNION ALL ".join(
        f"SELECT {load}::INTEGER AS load, {read} AS files_read, {rows} AS table_rows, {keys}::BIGINT AS keys, {rows} AS different FROM ({_filled('o_orderkey', 1000)}) f"
        for load, read, rows, keys in [
            (1, "(max(total) + 999) // 1000", "max(total)", "(sum(o_orderkey) FILTER (WHERE NOT late))"),
            (2, "count(DISTINCT page) FILTER (WHERE late)", "count(*)", "sum(o_orderkey)"), (3, "0::BIGINT", "count(*)", "sum(o_orderkey)"),
        ]
    ),
    "incremental_silver": f"SELECT *, '{fixed.CASES}' AS silver_dataset FROM cases",
    "incremental_dashboard": f"SELECT {_DASH} FROM dashboard",
    "published_reasons": " UNION ALL ".join(
        f"SELECT 'silver' AS layer, '{dataset}' AS dataset, '{reason}' AS reason, ({' + '.join(f'count(*) FILTER (WHERE {c})' for c in tests)})::DOUBLE AS values FROM {raw}"
        for dataset, raw, dates, counts, every in [
            (fixed.CASES, "cases_raw", ["end_date"], ["new_cases", "tot_cases", "new_deaths", "tot_deaths"], ["rec_id", "state", "end_date", "new_cases", "tot_cases", "new_deaths", "tot_deaths"]),
            (fixed.RESPIRATORY_DEATHS, "resp_raw", ["week_ending_date"], ["covid_19_deaths", "pneumonia_deaths", "influenza_deaths"],
             ["week_ending_date", "jurisdiction", "age_group", "covid_19_deaths", "pneumonia_deaths", "influenza_deaths"]),
        ]
        for reason, tests in [
            ("date not parsed", [f"{c} IS NOT NULL AND {_date(c)} IS NULL" for c in dates]),
            ("number not cast", [f"{c} IS NOT NULL AND try_cast({c} AS DOUBLE) IS NULL" for c in counts]),
            ("negative", [f"try_cast({c} AS DOUBLE) < 0" for c in counts]), ("missing", [f"{c} IS NULL" for c in every]),
        ]
    ),
    "published_bytes": "SELECT * FROM (VALUES ('bronze', 'read', true), ('bronze', 'write', true), ('silver', 'write', true), ('gold', 'write', true), ('warehouse', 'write', true)) v(layer, direction, agrees)",
    "published_durations": """
        SELECT * FROM (VALUES ('silver', 'silver', 2::BIGINT, NULL::VARCHAR, NULL::DOUBLE, true), ('quality', 'quality', 1, 'RuntimeError', 1.0, true))
          v(layer, job_name, jobs, error_type, errors, timed)""",
    "doc_decoded": """
        SELECT conv_id, CASE WHEN conv_id % 5 = 2 THEN 0 ELSE count(*) END AS pages, CASE WHEN conv_id % 5 <> 2 THEN sum(length(text))::BIGINT END AS characters,
          CASE WHEN conv_id % 5 = 2 THEN 'not a text file' END AS error
        FROM conversations GROUP BY conv_id""",
    "file_lengths": """
        SELECT CAST(folder AS VARCHAR) AS folder, CASE WHEN o_custkey % 4 = 0 THEN 0 ELSE o_custkey % 50 END + 1 AS length, 1::BIGINT AS listed
        FROM (SELECT o_custkey % 40 AS folder, min(o_custkey) AS o_custkey FROM orders GROUP BY 1) f UNION ALL SELECT 'nothing', 0, 1""",
    "last_30_days_stored": f"SELECT {_DASH} FROM dashboard WHERE report_date >= (SELECT max(report_date) FROM cases_day) - 30",
    "csv_split_scan": "SELECT doc_id, lang, CASE doc_id % 3 WHEN 0 THEN 'say \"' || substr(text, 1, 300) || '\"' || chr(10) || chr(10) WHEN 1 THEN '\"' || chr(10) || substr(text, 1, 5) END AS note, n_chars FROM documents",
    "json_split_scan": "SELECT conv_id, role, '}]\"{' || substr(text, 1, 80) AS said, turn AS number FROM conversations",
    "quality_routed": " UNION ALL ".join([_cases_checks("cases_raw"), _FLU_CHECKS]),
    "quality_quarantine": f"""
        SELECT *, count(*) AS times FROM (
          SELECT '{fixed.CASES}' AS dataset, CAST(rec_id AS VARCHAR) AS row, CAST(s + 2 * c + 4 * d AS BIGINT) AS verdict, concat_ws(', ', CASE WHEN s = 1 THEN 'state: {fixed.NOT_NULL}' END,
            CASE WHEN c = 1 THEN 'new_cases: {fixed.BETWEEN}' END, CASE WHEN d = 1 THEN 'new_deaths: {fixed.BETWEEN}' END) AS rules
          FROM (SELECT rec_id, CASE WHEN state IS NULL THEN 1 ELSE 0 END AS s, CASE WHEN try_cast(new_cases AS DOUBLE) >= 0 THEN 0 ELSE 1 END AS c,
              CASE WHEN try_cast(new_deaths AS DOUBLE) >= 0 THEN 0 ELSE 1 END AS d FROM cases_raw) m WHERE s + c + d > 0
          UNION ALL
          SELECT '{fixed.FLU_COVERAGE}', concat_ws('|', year_season, month, geography, dimension, coverage_estimate), 1, 'coverage_estimate: {fixed.BETWEEN}'
          FROM flu_raw WHERE coalesce(NOT (try_cast(coverage_estimate AS DOUBLE) BETWEEN 0 AND 100), true)
        ) q GROUP BY ALL""",
    "v_temporal_trends_ranged": f"SELECT {_TREND} FROM trends",
    "event_gaps": "SELECT event_type, event_id, lag(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous_event FROM events",
    "malformed_records": """
        SELECT c_custkey % 10 NOT IN (1, 2, 3) AS fits, CASE c_custkey % 10 WHEN 1 THEN 'x' || c_custkey || ',' || c_name || ',1' WHEN 2 THEN c_custkey || ',' || c_name
          WHEN 3 THEN c_custkey || ',' || c_name || ',1,2' WHEN 4 THEN c_custkey || '|' || c_name || ', "the" 4th|4' ELSE c_custkey || '|' || c_name || '|' || c_nationkey END AS record
        FROM customer""",
    "malformed_json": """
        SELECT c_custkey % 7 <> 3 AS fits, c_custkey, c_name, CASE WHEN c_custkey % 7 <> 3 THEN c_nationkey END AS c_nationkey,
          CASE WHEN c_custkey % 7 = 3 THEN '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":"none"}' END AS record
        FROM customer""",
    "clean_state": "SELECT r.rec_id, r.state, coalesce(s.name, r.state) AS state_normalized"
                   " FROM cases_raw r LEFT JOIN state_names s ON upper(r.state) = s.code",
    "clean_dates": f"SELECT rec_id, end_date, {_date('end_date')} AS end_date_parsed FROM cases_raw",
    "clean_numeric": "SELECT rec_id, try_cast(new_cases AS DOUBLE) AS new_cases, try_cast(tot_cases AS DOUBLE) AS tot_cases,"
                     " try_cast(new_deaths AS DOUBLE) AS new_deaths, try_cast(tot_deaths AS DOUBLE) AS tot_deaths FROM cases_raw",
    "fill_nulls": f"SELECT rec_id, coalesce(state, 'Unknown') AS state, {_num('new_cases')} AS new_cases,"
                  " coalesce(new_deaths, 'Unknown') AS new_deaths FROM cases_raw",
    "clamp_negative": "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal FROM customer",
    "clean_full": f"SELECT *, '{fixed.CASES}' AS silver_dataset FROM cases",
    "clean_vaccinations": f"SELECT *, '{fixed.VACCINATIONS}' AS silver_dataset FROM vacc",
    "clean_respiratory": f"SELECT *, '{fixed.RESPIRATORY_DEATHS}' AS silver_dataset FROM resp",
    "clean_flu": f"SELECT *, '{fixed.FLU_COVERAGE}' AS silver_dataset FROM flu",
    "dedup_keys": "SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM (" + _first(
        "lineitem", "l_orderkey, l_linenumber",
        "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate",
    ) + ") y",
    "dedup_rows": "SELECT DISTINCT text FROM documents",
    "lineage_enrich": "SELECT c_custkey, c_name, 'table://customer' AS bronze_source, 'customer.csv' AS bronze_filename,"
                      " '2024-03-01 12:30:00' AS bronze_ingestion_time, 'csv' AS bronze_format FROM customer",
    "ingest_log_normalize": "SELECT * FROM ingestion",
    "doc_registry": "SELECT coalesce(source, '') AS source, filename, coalesce(file_size, 0)::BIGINT AS file_size,"
                    " 'pdf' AS format, coalesce(category, 'mmwr') AS category, '' AS local_path,"
                    " coalesce(status, 'success') AS status FROM manifest_files WHERE format = 'pdf'",
    "row_cap": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000",
    "offset_pages": f"SELECT o_orderkey, o_totalprice, ({_pages(1000)})::BIGINT AS page FROM orders",
    "page_index": "SELECT page, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, count(*) AS page_rows"
                  f" FROM (SELECT o_orderkey, ({_pages(1000)})::BIGINT AS page FROM orders) p GROUP BY page",
    "keyset_page": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM"
                   " (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 1000) f) ORDER BY o_orderkey LIMIT 1000",
    "keyset_walk": f"SELECT o_orderkey, o_totalprice, ({_pages(5000)})::BIGINT AS page FROM orders",
    "keyset_large_page": "SELECT page, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, count(*) AS page_rows"
                         f" FROM (SELECT o_orderkey, ({_pages(60_000)})::BIGINT AS page FROM orders) p GROUP BY page",
    "csv_roundtrip": "SELECT *, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'a, \"b\"' END AS note FROM documents",
    "multi_csv_concat": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders",
    "json_array_scan": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "json_single_load": "SELECT c_custkey, c_name, c_nationkey, true AS is_local, 'json' AS bronze_format FROM customer",
    "ndjson_roundtrip": "SELECT * FROM conversations",
    "file_inventory": "SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS folder FROM orders",
    "missing_table_empty": " UNION ALL ".join(
        f"SELECT count(*) AS table_rows, '{table}' AS table_name FROM {source}"
        + (" WHERE false" if table == "kpi_vaccination_vs_cases" else "")
        for table, (source, _) in _GOLD.items()
    ),
    "schema_enforced_overwrite": "SELECT * FROM customer",
    "silver_counts": " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, (SELECT count(*) FROM {raw}) AS input_rows,"
        f" (SELECT count(*) FROM {kept}) AS output_rows,"
        f" (SELECT count(*) FROM {raw}) - (SELECT count(*) FROM {kept}) AS rejected_rows, 'success' AS status"
        for dataset, raw, kept in [(fixed.CASES, "cases_raw", "cases"), (fixed.RESPIRATORY_DEATHS, "resp_raw", "resp")]
    ),
    "append_log": "SELECT format, status, count(*) AS files, sum(file_size)::BIGINT AS bytes,"
                  " max(CAST(ingestion_time AS DATE)) AS last_date FROM ingestion GROUP BY format, status",
    "manifest_scan": "SELECT ((row_number() OVER (ORDER BY position) - 1) % 1000)::INTEGER AS position, dataset_key,"
                     " format, file_size, filename, status FROM manifest_files",
    "manifest_best_format": """
        SELECT dataset_key, position, format, file_size FROM (
          SELECT *, row_number() OVER (PARTITION BY dataset_key
                    ORDER BY CASE WHEN ff = 'json' AND format = 'csv' THEN 0 ELSE 1 END, position) AS rn
          FROM (SELECT *, first_value(format) OVER (PARTITION BY dataset_key ORDER BY position) AS ff
                FROM manifest_files WHERE format <> 'pdf' AND dataset_key <> '') a) b WHERE rn = 1""",
    "manifest_best_format_many": """
        SELECT dataset_key, format, file_size, filename FROM (
          SELECT *, row_number() OVER (PARTITION BY dataset_key
                    ORDER BY CASE WHEN ff = 'json' AND format = 'csv' THEN 0 ELSE 1 END, position) AS rn
          FROM (SELECT *, first_value(format) OVER (PARTITION BY dataset_key ORDER BY position) AS ff
                FROM manifest_files WHERE format <> 'pdf' AND dataset_key <> '') a) b WHERE rn = 1""",
    "failing_source": "SELECT 'customer.csv' AS filename, 'csv' AS format, 'success' AS status, 'customer' AS dataset_key,"
                      " count(*) AS record_count FROM customer UNION ALL SELECT 'broken.csv', 'csv', 'error', NULL, NULL",
    "manifest_written": "SELECT 'sample' AS mode, 4::BIGINT AS total_files, true AS sizes_agree, true AS reported, (2 *"
                        " ((SELECT least(count(*), 1000) FROM customer) + (SELECT least(count(*), 1000) FROM orders)))::BIGINT AS records",
    "manifest_totals": "SELECT count(*) AS total_files, sum(coalesce(file_size, 0))::BIGINT AS total_size_bytes FROM manifest_files",
    "kpi_incidence": "SELECT region, state, " + _round("total_cases", "total_deaths", "incidence_rate", "mortality_rate")
                     + ", report_date FROM incidence",
    "kpi_cases_per_day": "SELECT report_date, state, " + _round("new_cases", "cumulative_cases") + " FROM cases_day",
    "kpi_deaths_per_day": "SELECT report_date, state, " + _round("new_deaths", "cumulative_deaths") + " FROM deaths_day",
    "kpi_hospitalizations": "SELECT region, state, " + _round("hospitalized", "icu_patients") + ", report_date FROM hospital",
    "kpi_vaccination_vs_cases": f"SELECT {_VACC} FROM vacc_cases",
    "kpi_temporal_evolution": "SELECT state, report_date, metric_name, " + _round("metric_value") + " FROM temporal",
    "warehouse_cast": "SELECT region, state, round(round(hospitalized, 6))::BIGINT AS hospitalized,"
                      " round(round(icu_patients, 6))::BIGINT AS icu_patients, report_date FROM hospital",
    "warehouse_rejects": "SELECT state, report_date, metric_name, " + _round("metric_value")
                         + ", 'report_date: null' AS reject_reason FROM temporal WHERE report_date IS NULL",
    "reject_reasons": """
        SELECT reject_reason, count(*) AS rejected_rows FROM (
          SELECT concat_ws('; ', CASE WHEN c_custkey % 10 > 5 THEN 'region: longer than 100' END,
                                 CASE WHEN c_custkey % 7 = 0 THEN 'total_cases: not a long' END) AS reject_reason FROM customer) r
        WHERE reject_reason <> '' GROUP BY reject_reason""",
    "warehouse_views": "SELECT report_date, state, " + ", ".join(
        f"round(round({c}, 6))::BIGINT AS {c}" for c in
        ["new_cases", "cumulative_cases", "new_deaths", "cumulative_deaths", "doses_administered", "fully_vaccinated"]
    ) + " FROM dashboard WHERE report_date IS NOT NULL",
    "gold_input_unreadable": "SELECT 'error' AS status, count(*) AS kept_rows FROM cases_day",
    "warehouse_load": """
        SELECT row_number() OVER (ORDER BY report_date, state, new_cases, cumulative_cases) AS id, *
        FROM (SELECT report_date, state, round(new_cases)::BIGINT AS new_cases,
                round(cumulative_cases)::BIGINT AS cumulative_cases FROM cases_day WHERE report_date IS NOT NULL) x""",
    "run_metadata": " UNION ALL ".join(
        f"SELECT 'gold' AS layer, '{table}' AS job_name, 'silver' AS source,"
        f" (SELECT count(*) FROM {source}{where}) AS records_processed,"
        f" (SELECT count(*) FROM {source}) - (SELECT count(*) FROM {source}{where}) AS records_rejected, 'success' AS status"
        for table, (source, where) in _GOLD.items()
    ),
    "v_kpi_dashboard": f"SELECT {_DASH} FROM dashboard",
    "v_regional_summary": f"SELECT {_REGION} FROM regional",
    "v_temporal_trends": f"SELECT {_TREND} FROM trends",
    "summary": _summary("", _NATIONAL),
    "summary_with_fallback": _summary("SELECT * FROM vacc_cases WHERE upper(state) NOT IN ('US', 'UNITED STATES')", ""),
    "national_snapshot": "SELECT " + _round("total_doses", "total_fully_vaccinated")
                         + f", vaccination_snapshot_date FROM ({_NATIONAL}) n",
    "latest_per_state": f"""
        SELECT {_VACC.replace('state, report_date', 'v.state AS state, v.report_date AS report_date')} FROM vacc_cases v
        JOIN (SELECT state AS s, max(report_date) AS d FROM vacc_cases
              WHERE upper(state) NOT IN ('US', 'UNITED STATES', 'USA') GROUP BY state) l
        ON v.state = l.s AND v.report_date = l.d""",
    "top_states": "SELECT state, " + _round("total_cases", "total_deaths") + """ FROM (
        SELECT state, sum(new_cases) AS total_cases, sum(new_deaths) AS total_deaths FROM dashboard GROUP BY state
        ORDER BY total_cases DESC NULLS FIRST, state NULLS LAST LIMIT 10) x""",
    "top_states_by_cases": "SELECT state, " + _round("total_cases") + """ FROM (
        SELECT state, sum(new_cases) AS total_cases FROM cases_day GROUP BY state
        ORDER BY total_cases DESC, state LIMIT 10) x""",
    "timeline_cases": "SELECT report_date, round(sum(new_cases), 4) AS value FROM cases_day GROUP BY report_date",
    "timeline_deaths": "SELECT report_date, round(sum(new_deaths), 4) AS value FROM deaths_day GROUP BY report_date",
    "regional_top": f"SELECT {_REGION} FROM (SELECT * FROM regional {_REGION_ORDER} LIMIT 10) x",
    "regional_sample": f"SELECT {_REGION} FROM (SELECT * FROM regional {_REGION_ORDER} LIMIT 20) x",
    "dashboard_latest": "SELECT report_date, state, " + _round(
        "new_cases", "new_deaths", "doses_administered", "fully_vaccinated", "vaccination_rate"
    ) + " FROM (SELECT * FROM dashboard ORDER BY report_date DESC NULLS FIRST, state NULLS LAST LIMIT 50) x",
    "json_records": """
        SELECT '{"report_date":' || coalesce('"' || CAST(report_date AS VARCHAR) || '"', 'null') || ',"value":'
          || CAST(CAST(sum(new_cases) AS BIGINT) AS VARCHAR) || '}' AS record FROM cases_day GROUP BY report_date""",
    "last_30_days": f"SELECT {_DASH} FROM dashboard WHERE report_date >= (SELECT max(report_date) FROM cases_day) - 30",
    "state_metric_trend": f"SELECT {_TREND} FROM trends WHERE state = 'California' AND metric_name = 'new_cases'",
    "weekly_deaths": "SELECT CAST(date_trunc('week', report_date) AS DATE) AS week, round(sum(new_deaths), 4) AS weekly_deaths"
                     " FROM deaths_day GROUP BY 1",
    "avg_rate_by_state": "SELECT state, round(avg(vaccination_rate), 4) AS avg_vaccination_rate,"
                         " round(sum(new_cases), 4) AS total_cases FROM vacc_cases GROUP BY state",
    "latest100_top10": "SELECT state, round(new_cases, 4) AS new_cases FROM (SELECT state, sum(new_cases) AS new_cases FROM"
                       " (SELECT * FROM cases_day ORDER BY report_date DESC NULLS FIRST, state NULLS LAST LIMIT 100) r"
                       " GROUP BY state ORDER BY new_cases DESC, state LIMIT 10) x",
    "sql_with_parameters": "SELECT state, round(sum(new_cases), 4) AS total FROM cases_day"
                           " WHERE report_date >= DATE '1998-01-01' GROUP BY state",
    "doc_pages": "SELECT source_file, page_number::BIGINT AS page_number, coalesce(text, '') AS text,"
                 " length(coalesce(text, ''))::INTEGER AS char_count FROM pages_raw WHERE page_number <= 5",
    "doc_text": _text("pages_raw"),
    "doc_text_long": _text("(" + _fixture(fixtures.LONG_PAGES) + ") l"),
    "doc_full_text": _text("pages_raw", whole=True),
    "doc_preview": "SELECT source_file, total_pages, left(full_text, 500) AS text_preview FROM (" + _text("pages_raw", whole=True) + ") t",
    "quality_cases": _cases_checks("cases_raw"),
    "quality_vaccinations": _VACC_CHECKS,
    "quality_respiratory": _RESP_CHECKS,
    "quality_flu": _FLU_CHECKS,
    "quality_default": _expectations("lineitem", "lineitem", [_ROWS_CHECK]),
    "quality_empty": _cases_checks("(SELECT * FROM cases_raw WHERE try_cast(tot_cases AS DOUBLE) < 0) e"),
    "quality_summary": f"""
        SELECT dataset, count(*) AS total_expectations, count(*) FILTER (WHERE success) AS passed,
          count(*) FILTER (WHERE NOT success) AS failed,
          round(count(*) FILTER (WHERE success) / count(*)::DOUBLE, 4) AS success_rate, 'success' AS status
        FROM ({' UNION ALL '.join([_cases_checks('cases_raw'), _VACC_CHECKS, _RESP_CHECKS, _FLU_CHECKS])}) r
        GROUP BY dataset""",
    "quality_edge_cases": """
        SELECT * FROM (VALUES ('no_suite', 0::BIGINT, 0::BIGINT, 0::BIGINT, 1.0::DOUBLE, 'success'),
          ('broken_suite', 3::BIGINT, 2::BIGINT, 1::BIGINT, 0.6667::DOUBLE, 'success'),
          ('unreadable', 0::BIGINT, 0::BIGINT, 0::BIGINT, NULL::DOUBLE, 'error'))
          v(dataset, total_expectations, passed, failed, success_rate, status)""",
    "quality_report": " UNION ALL ".join([_cases_checks("cases_raw"), _VACC_CHECKS]),
    "quality_totals": f"""
        SELECT 4::BIGINT AS datasets_validated, count(*) FILTER (WHERE success) AS total_passed,
          count(*) FILTER (WHERE NOT success) AS total_failed
        FROM ({' UNION ALL '.join([_cases_checks('cases_raw'), _VACC_CHECKS, _RESP_CHECKS, _FLU_CHECKS])}) r""",
    "run_files": _metric("layer, format, status", "files_read", "round(sum(value), 4) AS files"),
    "run_rows": _metric("layer, dataset", "rows_inserted", "round(sum(value), 4) AS rows"),
    "run_rejects": _metric("layer, reason", "rows_rejected", "round(sum(value), 4) AS rows"),
    "run_duration_mean": _metric("layer, job_name", "job_duration", "round(avg(value), 4) AS mean_seconds"),
    "run_duration_hist": f"""
        SELECT layer, job_name, b.le, count(*) FILTER (WHERE value <= b.bound) AS jobs
        FROM run_log, (VALUES {_BOUNDS}) b(le, bound) WHERE metric = 'job_duration' GROUP BY layer, job_name, b.le""",
    "run_errors": _metric("layer, job_name, error_type", "errors", "round(sum(value), 4) AS errors"),
    "run_bytes": _metric("layer, direction", "bytes_processed", "round(sum(value), 4) AS bytes"),
    "run_freshness": "SELECT layer, dataset, (epoch(TIMESTAMP '2024-02-01') - floor(epoch(max(ts))))::BIGINT AS age_seconds"
                     " FROM run_log GROUP BY layer, dataset",
    "published_volumes": " UNION ALL ".join(
        f"SELECT 'silver' AS layer, '{dataset}' AS dataset, '{metric}' AS metric, 'full' AS mode, ({count})::DOUBLE AS rows"
        for dataset, raw, kept in [(fixed.CASES, "cases_raw", "cases"), (fixed.VACCINATIONS, "vacc_raw", "vacc")]
        for metric, count in [
            ("rows_inserted", f"(SELECT count(*) FROM {kept})"),
            ("rows_rejected", f"(SELECT count(*) FROM {raw}) - (SELECT count(*) FROM {kept})"),
        ]
    ),
    "end_to_end": " UNION ALL ".join(
        [_rows("bronze", d, s) for d, s in _BRONZE.items()] + [_rows("silver", d, s) for d, s in _SILVER.items()]
        + [_rows("gold", k, s) for k, (s, _) in _GOLD.items()]
        + [_rows("warehouse", k, s, w) for k, (s, w) in _GOLD.items()]
    ),
}

ORACLES = {name: _WITH + text for name, text in _SQL.items()}
