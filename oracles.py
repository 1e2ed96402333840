"""Independent DuckDB SQL for the queries of ``panelkit.plans.catalog``.

Every statement starts from the raw test tables. Rounding: ``even`` halves to even, ``away``
halves away from zero, both on the scaled double.
"""

from __future__ import annotations

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
NATIONS = tuple(f"NATION_{i}" for i in range(6))
MIN_CASES = 50_000


def even(x: str, digits: int) -> str:
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits})"


def away(x: str, digits: int) -> str:
    return f"(round(({x}) * 1e{digits}) / 1e{digits})"


def names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def share(top: str, bottom: str, scale: str = "1e2") -> str:
    return f"CASE WHEN {bottom} > 0 THEN coalesce({top}, 0) / {bottom} * {scale} ELSE 0 END"


def clipped(top: str, bottom: str) -> str:
    return even(f"least(greatest({share(top, bottom)}, 0), 1e2)", 4)


def over_nation(first: str, last: str) -> str:
    return f"OVER (PARTITION BY country_id ORDER BY date ROWS BETWEEN {first} AND {last})"


PANEL = """
flows AS (
  SELECT c_nationkey AS country_id, CAST(o_orderdate AS DATE) AS date,
         sum(l_quantity) AS new_cases,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0e0 END) AS new_deaths
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2),
counted AS (
  SELECT flows.*, n_name AS country, r_name AS region,
         sum(new_cases) OVER days AS total_cases, sum(new_deaths) OVER days AS total_deaths,
         CAST(250000 * (country_id + 1) AS BIGINT) AS population,
         CAST(sum(CASE WHEN date >= DATE '1997-01-01' THEN new_cases ELSE 0e0 END) OVER days
              AS BIGINT) AS done,
         CAST(sum(new_cases) OVER (PARTITION BY country_id) AS BIGINT) AS everything
  FROM flows JOIN nation ON n_nationkey = country_id JOIN region ON r_regionkey = n_regionkey
  WINDOW days AS (PARTITION BY country_id ORDER BY date ROWS UNBOUNDED PRECEDING)),
panel AS (
  SELECT country_id, date, new_cases, new_deaths, country, region, total_cases, total_deaths,
         population, population * done // everything AS people_vaccinated,
         (population * done // everything) * (1 + country_id % 4) // 4 AS people_fully_vaccinated
  FROM counted)"""

_LOST = ("new_cases", "new_deaths", "total_cases", "total_deaths", "people_vaccinated")
GAPPY = f"""{PANEL},
gappy AS (
  SELECT country_id, date, country, region, people_fully_vaccinated,
         {", ".join(f"CASE WHEN NOT (country_id % 5 = 0 AND day(date) % 7 = 0) THEN {c} END AS {c}"
                    for c in _LOST)},
         CASE WHEN NOT (country_id % 6 = 0 AND date < DATE '1998-01-01')
              THEN population END AS population
  FROM panel)"""


def _rolling(metric: str, width: int) -> str:
    mean = f"avg({metric}) {over_nation(f'{width - 1} PRECEDING', 'CURRENT ROW')}"
    return f'{even(mean, 2)} AS "{width}_day_{metric[4:]}_avg"'


def _growth(metric: str, lag: int, name: str) -> str:
    base = f"lag({metric}, {lag}) OVER (PARTITION BY country_id ORDER BY date)"
    change = f"coalesce(CASE WHEN {base} <> 0 THEN {metric} / {base} - 1 END, 0) * 1e2"
    return f"{even(change, 2)} AS {name}"


_GROWTH = (("daily_growth_rate", 1), ("weekly_growth_rate", 7), ("monthly_growth_rate", 30))
_ROLLED = [_rolling(m, w) for m in ("new_cases", "new_deaths") for w in (7, 14, 30)]

FEATURES = f"""{PANEL},
smooth AS (
  SELECT *,
    {clipped("total_deaths", "total_cases")} AS case_fatality_rate,
    {even(share("total_deaths", "population"), 4)} AS death_rate,
    {even(share("total_deaths", "population", "1e5"), 4)} AS deaths_per_100k,
    {even(share("total_cases", "population", "1e5"), 4)} AS cases_per_100k,
    {clipped("people_vaccinated", "population")} AS vaccination_rate,
    {clipped("people_fully_vaccinated", "population")} AS fully_vaccinated_rate,
    {", ".join(_ROLLED)}
  FROM panel),
features AS (
  SELECT *, {", ".join(_growth('"7_day_cases_avg"', lag, name) for name, lag in _GROWTH)}
  FROM smooth)"""

MODEL = f"""{FEATURES},
regions AS (
  SELECT CAST(row_number() OVER (ORDER BY min(country), region) AS INTEGER) AS region_id,
         region AS region_name
  FROM features GROUP BY region),
countries AS (
  SELECT CAST(row_number() OVER (ORDER BY country) AS INTEGER) AS country_id, '' AS iso_code,
         country AS country_name, region_id, population,
         CAST(NULL AS DOUBLE) AS population_density, CAST(NULL AS DOUBLE) AS median_age
  FROM (SELECT DISTINCT country, region, population FROM panel) JOIN regions ON region = region_name),
numbered AS (
  SELECT row_number() OVER (ORDER BY country, date) AS record_id, c.country_id AS cid, f.*
  FROM features f JOIN countries c ON country = country_name),
daily AS (
  SELECT record_id, cid AS country_id, date, new_cases, total_cases, new_deaths, total_deaths,
         case_fatality_rate, cases_per_100k, deaths_per_100k,
         "7_day_cases_avg" AS rolling_7day_cases, "7_day_deaths_avg" AS rolling_7day_deaths
  FROM numbered),
vaccination AS (
  SELECT record_id, cid AS country_id, date, 0e0 AS total_vaccinations,
         CAST(people_vaccinated AS DOUBLE) AS people_vaccinated,
         CAST(people_fully_vaccinated AS DOUBLE) AS people_fully_vaccinated,
         0e0 AS new_vaccinations, vaccination_rate, fully_vaccinated_rate
  FROM numbered),
named AS (
  SELECT d.* EXCLUDE (country_id), country_name, iso_code, region_name, population, c.country_id
  FROM daily d JOIN countries c USING (country_id) LEFT JOIN regions USING (region_id)),
latest AS (
  SELECT * FROM named QUALIFY date = max(date) OVER (PARTITION BY country_id)),
covered AS (
  SELECT v.*, country_name, region_name, population
  FROM vaccination v JOIN countries USING (country_id) LEFT JOIN regions USING (region_id))"""

_NUMBER = "CASE WHEN day(date) = 28 THEN NULL WHEN day(date) % 10 = 3 THEN -new_cases ELSE new_cases END"
FEED = f"""{PANEL},
final AS (
  SELECT country_id, date AS real_date,
         chr(9) || ' ' || CASE WHEN country_id = 3 THEN 'Nation Three' ELSE country END || ' '
           AS location,
         CASE WHEN country_id % 7 <> 6 THEN region END AS continent,
         CASE WHEN country_id = 5 AND day(date) = 13 THEN NULL ELSE date END AS date, 1 AS seq,
         {_NUMBER} AS new_cases, CASE WHEN day(date) <> 15 THEN total_cases END AS total_cases,
         new_deaths,
         CASE WHEN country_id % 6 <> 0 OR year(date) > 1997
              THEN CAST(population AS DOUBLE) END AS population, country
  FROM panel),
feed AS (
  SELECT * FROM final
  UNION ALL SELECT * REPLACE (0 AS seq, 1e0 AS new_cases, 2e0 AS total_cases) FROM final
  UNION ALL SELECT NULL, date, 'World', NULL, date, 1, sum(new_cases), NULL, NULL, NULL, NULL
  FROM panel GROUP BY date)"""

_FEED_STATS = """
stats AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE date IS NULL) AS invalid,
         count(*) FILTER (WHERE new_cases < 0) AS negative, count(DISTINCT location) AS entities,
         min(date) AS first, max(date) AS last,
         count(*) - count(DISTINCT (location, coalesce(CAST(date AS VARCHAR), 'bad'))) AS keys,
         count(*) - count(DISTINCT (location, continent, coalesce(CAST(date AS VARCHAR), 'bad'),
           seq, coalesce(CAST(new_cases AS VARCHAR), 'n/a'), total_cases, new_deaths, population))
           AS copies
  FROM feed)"""


def per_cent(top: str, bottom: str, scale: str = "1e2", digits: int = 4) -> str:
    return away(f"{top} * {scale} / nullif({bottom}, 0)", digits)


def _profile(source: str, columns: dict[str, str]) -> str:
    rows = [
        f"""SELECT {i} AS position, '{c}' AS "column", '{kind}' AS type,
            count(*) FILTER (WHERE "{c}" IS NULL) AS null_count,
            {even(f'count(*) FILTER (WHERE "{c}" IS NULL) / count(*) * 1e2', 2)} AS null_pct FROM {source}"""
        for i, (c, kind) in enumerate(columns.items(), start=1)
    ]
    return "\nUNION ALL ".join(rows)


PANEL_COLUMNS = {
    "country_id": "int",
    "date": "date",
    "new_cases": "double",
    "new_deaths": "double",
    "country": "string",
    "region": "string",
    "total_cases": "double",
    "total_deaths": "double",
    "population": "bigint",
    "people_vaccinated": "bigint",
    "people_fully_vaccinated": "bigint",
}


def _describe(source: str, columns) -> str:
    parts = []
    for c in columns:
        q = {p: f"quantile_cont({c}, {p})" for p in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)}
        d = f"({c} - m_{c})"
        parts.append(
            f"""SELECT '{c}' AS metric, count({c}) AS count, {even(f"avg({c})", 2)} AS mean,
            {even(f"stddev_samp({c})", 2)} AS std_dev, {even(q[0.5], 2)} AS median,
            {even(f"{q[0.75]} - {q[0.25]}", 2)} AS iqr, {even(f"min({c})", 2)} AS min,
            {even(q[0.25], 2)} AS pct_25, {even(q[0.75], 2)} AS pct_75, {even(q[0.9], 2)} AS pct_90,
            {even(q[0.95], 2)} AS pct_95, {even(q[0.99], 2)} AS pct_99, {even(f"max({c})", 2)} AS max,
            {even(f"avg({d} ** 3) / var_pop({c}) ** 1.5", 2)} AS skewness,
            {even(f"kurtosis_pop({c})", 2)} AS kurtosis
            FROM (SELECT CAST({c} AS DOUBLE) AS {c}, avg({c}) OVER () AS m_{c} FROM {source})"""
        )
    return "\nUNION ALL ".join(parts)


def _corr_cell(source: str, x: str, y: str) -> str:
    if x == y:
        return f"SELECT '{x}' AS x, '{y}' AS y, 1e0 AS r"
    return f"SELECT '{x}' AS x, '{y}' AS y, {even(f'corr({x}, {y})', 4)} AS r FROM {source}"


def _corr(source: str, columns) -> str:
    return "\nUNION ALL ".join(_corr_cell(source, x, y) for x in columns for y in columns)


def _spearman_cell(source: str, x: str, y: str) -> str:
    def rank(c: str) -> str:
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2e0"

    pair = f"SELECT {x} AS a, {y} AS b FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL"
    ranked = f"SELECT {rank('a')} AS a, {rank('b')} AS b FROM ({pair})"
    if x == y:
        return f"SELECT '{x}' AS x, '{y}' AS y, 1e0 AS r"
    return f"SELECT '{x}' AS x, '{y}' AS y, {even('corr(a, b)', 4)} AS r FROM ({ranked})"


def _spearman(source: str, columns) -> str:
    return "\nUNION ALL ".join(_spearman_cell(source, x, y) for x in columns for y in columns)


def _last(c: str) -> str:
    return f"arg_max({c}, date) FILTER (WHERE {c} IS NOT NULL) AS {c}"


_SNAPSHOT = (
    "region", "total_cases", "total_deaths", "people_vaccinated", "people_fully_vaccinated",
    "population", "case_fatality_rate", "cases_per_100k", "deaths_per_100k",
    "fully_vaccinated_rate",
)
FILTERED = f"""{FEATURES},
filtered AS (
  SELECT * FROM features WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
    AND region IN ('AFRICA', 'ASIA', 'EUROPE')),
snapshot AS (SELECT country, {", ".join(_last(c) for c in _SNAPSHOT)} FROM filtered GROUP BY country),
day_totals AS (
  SELECT date, sum(new_cases) AS new_cases, sum(new_deaths) AS new_deaths,
         sum("7_day_cases_avg") AS "7_day_cases_avg", sum("7_day_deaths_avg") AS "7_day_deaths_avg"
  FROM filtered GROUP BY date)"""

TOTALS = f"""{PANEL},
totals AS (SELECT date, sum(new_cases) AS new_cases, sum(new_deaths) AS new_deaths
           FROM panel GROUP BY date)"""


def top_of(counter: str, n: int) -> str:
    return f"""top AS (SELECT country, max({counter}) AS {counter} FROM features GROUP BY country
      ORDER BY max({counter}) DESC NULLS LAST, country LIMIT {n})"""


def _rolling_total(flow: str, total: str, smoothed: str) -> str:
    mean = f"avg({total}) OVER (ORDER BY date ROWS 6 PRECEDING)"
    return f"""WITH {TOTALS} SELECT date, {total}, {away(mean, 2)} AS {smoothed}
      FROM (SELECT date, {flow} AS {total} FROM totals)"""


def _monthly(flow: str, total: str, peak: str) -> str:
    return f"""WITH {PANEL} SELECT strftime(date, '%Y-%m') AS year_month, sum({flow}) AS {total},
      {away(f"avg({flow})", 2)} AS daily_average_for_month, max({flow}) AS {peak}
      FROM panel GROUP BY 1"""


def _per_100k(counter: str, rate: str) -> str:
    return f"""WITH {MODEL} SELECT country_name, region_name, population, {counter},
      {per_cent(counter, "population", "1e5", 2)} AS {rate}
      FROM latest WHERE population >= 500000
      ORDER BY {rate} DESC NULLS LAST, country_name LIMIT 25"""


def _full_mean(metric: str, width: int = 7) -> str:
    frame = f"OVER (ORDER BY date ROWS {width - 1} PRECEDING)"
    return f"CASE WHEN count(*) {frame} = {width} THEN avg({metric}) {frame} END"


def _rate(top: str, bottom: str, clip: bool, scale: str = "1e2") -> str:
    value = clipped(top, bottom) if clip else even(share(top, bottom, scale), 4)
    return f"WITH {GAPPY} SELECT country, date, {value} AS rate FROM gappy"


def _filled(c: str, kind: str) -> str:
    back = over_nation("UNBOUNDED PRECEDING", "CURRENT ROW")
    ahead = over_nation("CURRENT ROW", "UNBOUNDED FOLLOWING")
    last = f"last_value({c} IGNORE NULLS) {back}"
    if kind == "counter":
        return f"CAST(coalesce({last}, 0) AS DOUBLE) AS {c}"
    return f"coalesce({last}, first_value({c} IGNORE NULLS) {ahead}) AS {c}"


def _coerced(rule: str) -> str:
    return f"""SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN NULL
      WHEN c_acctbal < 0 THEN {rule} ELSE c_acctbal END AS new_balance, c_acctbal AS balance
      FROM customer"""


def _kept(direction: str) -> str:
    return f"""SELECT event_id, user_id, event_type, value, props, CAST(ts AS DATE) AS day
      FROM events QUALIFY row_number() OVER (
        PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts {direction}, event_id {direction}) = 1"""


def _waves(series: str, distance: int, factor: float) -> str:
    """Peaks of (series, day, value): runs of equal values, greedy spacing from the highest
    peak down (a recursion that carries the kept positions), then prominences."""
    return f"""
    points AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY day) - 1 AS i
      FROM ({series}) WHERE value IS NOT NULL),
    steps AS (SELECT *, CASE WHEN value IS DISTINCT FROM lag(value) OVER s THEN 1 ELSE 0 END AS step
      FROM points WINDOW s AS (PARTITION BY series ORDER BY i)),
    run_ids AS (SELECT *, sum(step) OVER (PARTITION BY series ORDER BY i) AS run FROM steps),
    runs AS (SELECT series, run, (min(i) + max(i)) // 2 AS pos, any_value(value) AS height
      FROM run_ids GROUP BY series, run),
    tops AS (SELECT * FROM runs WINDOW s AS (PARTITION BY series ORDER BY run)
      QUALIFY height > lag(height) OVER s AND height > lead(height) OVER s),
    ordered AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY height DESC, pos DESC) AS n
      FROM tops),
    greedy AS (
      SELECT DISTINCT series, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS kept FROM points
      UNION ALL
      SELECT g.series, o.n, CASE WHEN len(list_filter(kept, lambda k: abs(k - pos) < {distance})) = 0
        THEN list_append(kept, pos) ELSE kept END
      FROM greedy g JOIN ordered o ON o.series = g.series AND o.n = g.n + 1),
    spaced AS (SELECT series, unnest(arg_max(kept, n)) AS pos FROM greedy GROUP BY series),
    peaks AS (SELECT s.series, pos, day, value FROM spaced s JOIN points p
      ON p.series = s.series AND i = pos),
    limits AS (SELECT k.series, pos, k.day, k.value,
        coalesce(max(CASE WHEN i < pos AND p.value > k.value THEN i END), -1) AS low,
        coalesce(min(CASE WHEN i > pos AND p.value > k.value THEN i END), count(*)) AS high,
        count(*) AS samples, max(p.value) AS top
      FROM peaks k JOIN points p USING (series) GROUP BY ALL),
    found AS (SELECT k.series, pos, k.day, k.value, k.value - greatest(
        min(CASE WHEN i > low AND i <= pos THEN p.value END),
        min(CASE WHEN i >= pos AND i < high THEN p.value END)) AS prominence
      FROM limits k JOIN points p USING (series) WHERE samples >= {distance}
      GROUP BY k.series, pos, k.day, k.value, top HAVING prominence >= top * {factor}e0),
    waves AS (SELECT series, day AS peak_date, {even("value", 2)} AS peak_value,
        {even("prominence", 2)} AS prominence,
        CAST(row_number() OVER (PARTITION BY series ORDER BY pos) AS INTEGER) AS wave_number
      FROM found)"""


def ingestion() -> dict[str, str]:
    required = "date,new_cases,new_deaths,population,total_cases,total_deaths"
    customer = "c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment"
    documents = dict(doc_id="bigint", text="string", lang="string", source="string", n_chars="bigint")
    return {
        "i1_read_csv": f"WITH {PANEL} SELECT country, date, new_cases, population FROM panel",
        "i1_read_csv_documents": "SELECT doc_id, text, source FROM documents",
        "i1_read_csv_by_name": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
        "i1_read_csv_gz": f"""WITH {PANEL} SELECT country, date,
          CAST(total_cases AS BIGINT) AS total_cases FROM panel""",
        "i1_read_csv_batches": f"WITH {PANEL} SELECT country, date, new_deaths FROM panel",
        "i2_validate_columns": f"""WITH {PANEL}
          SELECT 'FAIL' AS status, 11 AS total_columns_found,
          9 AS required_columns_count, 'continent,iso_code,location' AS missing_columns,
          '{required}' AS present_required_columns, count(*) AS row_count,
          count(*) FILTER (date IS NULL) + count(*) FILTER (total_cases IS NULL)
          + count(*) FILTER (new_cases IS NULL) + count(*) FILTER (total_deaths IS NULL)
          + count(*) FILTER (new_deaths IS NULL) + count(*) FILTER (population IS NULL)
          AS null_count FROM panel""",
        "i3_profile": f"WITH {GAPPY} {_profile('gappy', PANEL_COLUMNS)}",
        "i3_profile_documents": _profile("documents", documents),
        "i3_row_count": "SELECT count(*) AS row_count, 11 AS column_count FROM lineitem",
        "i4_write_with_audit": f"""WITH {PANEL}
          SELECT 'customers' AS source_name, count(*) AS record_count, 5 AS column_count,
                 '{customer}' AS columns FROM customer
          UNION ALL SELECT 'panel', count(*), 11, '{",".join(PANEL_COLUMNS)}' FROM panel""",
        "i4_read_parquet_or_csv": f"WITH {PANEL} SELECT country, date, new_cases FROM panel",
    }


def cleaning() -> dict[str, str]:
    segment = """CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'HOME' WHEN 'MACHINERY' THEN 'INDUSTRY'
      WHEN 'AUTOMOBILE' THEN 'INDUSTRY' ELSE c_mktsegment END"""
    parsed = "CASE WHEN o_orderkey % 8 < 7 THEN CAST(o_orderdate AS DATE) END AS date"
    counters = ("total_cases", "total_deaths", "people_vaccinated", "people_fully_vaccinated")
    return {
        "c1_snake_case_columns": """SELECT c_custkey AS customer_key, c_name AS customer_name,
          c_nationkey AS nation_key, c_acctbal AS acctbal_usd, c_mktsegment AS mkt_segment
          FROM customer""",
        "c2_canonicalise_entity": f"SELECT c_custkey, {segment} AS segment FROM customer",
        "c2_alias_hits": f"""SELECT {segment} AS segment, count(*) AS rows,
          count(*) FILTER (WHERE {segment} <> c_mktsegment) AS renamed FROM customer GROUP BY 1""",
        "c3_drop_aggregate_entities": """SELECT c_custkey, c_mktsegment FROM customer
          WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN ('BUILDING', 'FURNITURE')""",
        "c4_parse_dates": f"SELECT o_orderkey, {parsed} FROM orders WHERE o_orderkey % 8 < 7",
        "c4_parse_dates_keep_invalid": f"SELECT o_orderkey, {parsed} FROM orders",
        "c4_unparsed_dates": """SELECT count(*) FILTER (o_orderkey % 8 = 7) AS dropped,
          CAST(0 AS BIGINT) AS without_date FROM orders""",
        "c5_dedupe_keep": _kept("DESC"),
        "c5_dedupe_keep_first": _kept("ASC"),
        "c5_dedupe_whole_rows": "SELECT DISTINCT text, lang FROM documents",
        "c6_coerce_numeric": _coerced("0e0"),
        "c6_coerce_numeric_abs": _coerced("abs(c_acctbal)"),
        "c7_impute_panel": f"""WITH {GAPPY} SELECT country_id, date, country, region,
          coalesce(new_cases, 0) AS new_cases, coalesce(new_deaths, 0) AS new_deaths,
          {", ".join(_filled(c, "counter") for c in counters)},
          {_filled("population", "attribute")} FROM gappy""",
        "c8_clean_panel": f"""WITH {FEED},
          kept AS (SELECT * FROM feed WHERE seq = 1 AND date IS NOT NULL AND location <> 'World')
          SELECT location, continent, date, seq, greatest(coalesce(new_cases, 0), 0) AS new_cases,
            {_filled("total_cases", "counter")}, new_deaths, {_filled("population", "attribute")},
            country, continent AS region
          FROM kept""",
    }


def quality() -> dict[str, str]:
    def gate(i: int, name: str, metric: str, status: str, severity: str, rule="Must be 0") -> str:
        return f"""SELECT {i} AS position, '{name}' AS name, CAST({metric} AS BIGINT) AS metric,
          '{rule}' AS condition, {status} AS status, '{severity}' AS severity FROM stats"""

    def zero(metric: str, otherwise: str) -> str:
        return f"CASE WHEN {metric} = 0 THEN 'PASS' ELSE '{otherwise}' END"

    gates = [
        gate(1, "Missing Country Names", "0", "'PASS'", "CRITICAL"),
        gate(2, "Missing Dates", "0", "'PASS'", "CRITICAL"),
        gate(3, "Invalid Date Formats", "invalid", zero("invalid", "FAIL"), "CRITICAL"),
        gate(4, "Duplicate Country-Date Records", "keys", zero("keys", "FAIL"), "HIGH"),
        gate(5, "Exact Duplicate Rows", "copies", zero("copies", "WARN"), "MEDIUM"),
        gate(6, "Negative New Cases", "negative", zero("negative", "WARN"), "MEDIUM"),
        gate(7, "Negative New Deaths", "0", "'PASS'", "MEDIUM"),
        gate(8, "Country Coverage", "entities",
             "CASE WHEN entities >= 30 THEN 'PASS' ELSE 'WARN' END", "MEDIUM", "Expected >= 30"),
    ]
    nulls = []
    # unreadable dates and numbers are text in the feed, not nulls
    for c in ("location", "date", "new_cases", "new_deaths", "total_cases", "population"):
        count = "0" if c in ("date", "new_cases") else f"count(*) FILTER (WHERE {c} IS NULL)"
        nulls.append(
            f"""SELECT '{c}' AS "column", CAST({count} AS BIGINT) AS null_count,
            {even(f"{count} / count(*) * 1e2", 2)} AS null_pct FROM feed"""
        )
    return {
        "v1_missing_and_invalid_keys": f"""WITH {FEED} SELECT count(*) AS total_records,
          count(*) FILTER (WHERE continent IS NULL) AS missing_entity, CAST(0 AS BIGINT) AS missing_date,
          count(*) FILTER (WHERE date IS NULL) AS invalid_date FROM feed""",
        "v2_duplicate_key_gate": """SELECT CAST(sum(n - 1) AS BIGINT) AS surplus FROM (
          SELECT count(*) AS n FROM events GROUP BY user_id, CAST(ts AS DATE))""",
        "v3_exact_duplicate_gate": """SELECT CAST(sum(n - 1) AS BIGINT) AS surplus FROM (
          SELECT count(*) AS n FROM documents GROUP BY text)""",
        "v4_negative_flow_gates": f"""WITH {FEED} SELECT count(*) FILTER (WHERE new_cases < 0) AS negative_0,
          count(*) FILTER (WHERE new_deaths < 0) AS negative_1 FROM feed""",
        "v5_coverage_gate": f"""WITH {FEED} SELECT count(DISTINCT location) AS distinct_entities,
          min(date) AS min_date, max(date) AS max_date FROM feed""",
        "v6_quality_report": f"WITH {FEED}, {_FEED_STATS} " + " UNION ALL ".join(gates),
        "v6_column_nulls": f"""WITH {FEED} SELECT *, CASE WHEN null_pct < 5 THEN 'Excellent'
          WHEN null_pct < 25 THEN 'Acceptable' ELSE 'Sparse' END AS health
          FROM ({" UNION ALL ".join(nulls)})""",
        "v6_summary": f"""WITH {FEED}, {_FEED_STATS} SELECT
          CASE WHEN invalid + keys > 0 THEN 'FAIL' WHEN copies + negative > 0 OR entities < 30
          THEN 'WARN' ELSE 'PASS' END AS overall_status, total AS total_records,
          entities AS distinct_entities, first AS min_date, last AS max_date,
          copies AS duplicate_records, keys AS duplicate_keys, invalid AS invalid_records
          FROM stats""",
    }


def features() -> dict[str, str]:
    days = "OVER (PARTITION BY country_id ORDER BY date RANGE BETWEEN INTERVAL {} DAYS PRECEDING AND CURRENT ROW)"
    by_days = [
        f'{even(f"avg(new_cases) {days.format(w - 1)}", 2)} AS "{w}_day_cases_avg"'
        for w in (7, 14, 30)
    ]
    growth = ", ".join(_growth("new_cases", lag, name) for name, lag in _GROWTH)
    return {
        "t1_ratio_pct": _rate("total_deaths", "total_cases", True),
        "t2_per_capita": _rate("total_deaths", "population", False),
        "t3_coverage_pct": _rate("people_vaccinated * 3", "population", True),
        "t4_rolling_mean": f"WITH {GAPPY} SELECT country, date, {', '.join(_ROLLED)} FROM gappy",
        "t4_rolling_mean_days": f"WITH {PANEL} SELECT country, date, {', '.join(by_days)} FROM panel",
        "t5_growth_rates": f"WITH {PANEL} SELECT country, date, {growth} FROM panel",
        "t6_feature_panel": f"""WITH {FEATURES}
          SELECT * EXCLUDE (country_id), 'tests' AS data_curator FROM features""",
    }


def model() -> dict[str, str]:
    tables = ("regions", "countries", "population_stats", "daily", "vaccination")
    counts = [
        f"SELECT '{t}' AS \"table\", count(*) AS rows FROM "
        + ("countries" if t == "population_stats" else t)
        for t in tables
    ]
    statistics = ("population_density", "median_age", "gdp_per_capita", "life_expectancy",
                  "hospital_beds_per_thousand")
    empty = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in statistics)
    return {
        "l1_build_regions": f"WITH {MODEL} SELECT * FROM regions",
        "l2_build_entities": f"WITH {MODEL} SELECT * FROM countries",
        "l3_build_entity_stats": f"WITH {MODEL} SELECT country_id, population, {empty} FROM countries",
        "l4_build_daily_fact": f"WITH {MODEL} SELECT * FROM daily",
        "l5_build_vaccination_fact": f"WITH {MODEL} SELECT * FROM vaccination",
        "l6_build_all": f"WITH {MODEL} {' UNION ALL '.join(counts)}",
        "l6_run_sql_suite": f"""WITH {MODEL} SELECT region_name AS name, count(*) AS value
          FROM countries JOIN regions USING (region_id) GROUP BY 1
          UNION ALL SELECT CAST(year(date) AS VARCHAR), CAST(sum(new_cases) AS BIGINT)
          FROM daily GROUP BY 1""",
        "l6_run_query": f"""WITH {MODEL} SELECT country_name, population FROM countries
          WHERE population >= 2000000""",
    }


def suite() -> dict[str, str]:
    mean = {
        "a": "avg(new_cases) OVER (PARTITION BY country_id ORDER BY date ROWS 6 PRECEDING)",
        "b": f"avg(new_cases) {over_nation('20 PRECEDING', '7 PRECEDING')}",
        "c": f"avg(new_cases) {over_nation('1 FOLLOWING', '14 FOLLOWING')}",
    }
    growth = [
        away(f"CASE WHEN prior_month_{c} > 0 THEN (total_{c} - prior_month_{c}) * 1e2 / prior_month_{c} END", 2)
        + f" AS mom_{c}_growth_pct"
        for c in ("cases", "deaths")
    ]
    dense = "CAST(dense_rank() OVER (ORDER BY {} DESC NULLS LAST) AS INTEGER)"
    region_rank = "CAST(rank() OVER (ORDER BY {} DESC NULLS LAST) AS INTEGER)"
    coverage = "people_fully_vaccinated * 1e2 / population"
    last_dose = """last_dose AS (SELECT * FROM covered WHERE people_fully_vaccinated > 0
      QUALIFY date = max(date) OVER (PARTITION BY country_id))"""
    both = f"""{last_dose}, both_ AS (
      SELECT l.*, d.people_fully_vaccinated FROM latest l JOIN last_dose d USING (country_id))"""
    return {
        "dq1_dup_keys": """SELECT user_id AS country_id, CAST(ts AS DATE) AS date,
          count(*) AS record_count FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
        "dq2_negative_flows": f"""WITH {PANEL} SELECT country AS country_name, date,
          new_cases - 100 AS new_cases, new_deaths FROM panel
          WHERE new_cases - 100 < 0 OR new_deaths < 0""",
        "dq3_orphans": f"""WITH {MODEL} SELECT record_id, country_id, date FROM daily
          WHERE country_id NOT IN (SELECT country_id FROM countries WHERE population >= 2000000)""",
        "dq4_nonmonotonic": f"""WITH {PANEL}, lagged AS (
            SELECT country AS country_name, date, new_cases AS total_cases,
              lag(new_cases) OVER (PARTITION BY country ORDER BY date) AS prev_total_cases FROM panel)
          SELECT *, total_cases - prev_total_cases AS reporting_drop FROM lagged
          WHERE total_cases < prev_total_cases ORDER BY reporting_drop, country_name, date LIMIT 50""",
        "dq5_completeness": f"""WITH {MODEL} SELECT coalesce(region_name, 'Unknown') AS region,
          count(DISTINCT c.country_id) AS countries_count, count(record_id) AS total_daily_records,
          min(date) AS earliest_report, max(date) AS latest_report
          FROM countries c LEFT JOIN regions USING (region_id) LEFT JOIN daily USING (country_id)
          GROUP BY 1""",
        "q1_daily_flow": f"""WITH {PANEL} SELECT date, sum(new_cases) AS global_daily_cases,
          sum(total_cases) AS global_cumulative_cases FROM panel GROUP BY date""",
        "q2_daily_deaths_cfr": f"""WITH {PANEL} SELECT date, sum(new_deaths) AS global_daily_deaths,
          sum(total_deaths) AS global_cumulative_deaths, CASE WHEN sum(total_cases) > 0 THEN
          {per_cent("sum(total_deaths)", "sum(total_cases)")} ELSE 0 END AS global_case_fatality_rate
          FROM panel GROUP BY date""",
        "q3_top_cases": f"""WITH {MODEL} SELECT country_name, iso_code, region_name, total_cases,
          total_deaths, population FROM latest
          ORDER BY total_cases DESC NULLS LAST, country_name LIMIT 20""",
        "q4_top_deaths": f"""WITH {MODEL} SELECT country_name, iso_code, region_name, total_deaths,
          total_cases, population, {per_cent("total_deaths", "total_cases")} AS cfr_percentage
          FROM latest ORDER BY total_deaths DESC NULLS LAST, country_name LIMIT 20""",
        "q5_top_cfr": f"""WITH {MODEL} SELECT country_name, region_name, total_cases, total_deaths,
          {per_cent("total_deaths", "total_cases")} AS case_fatality_rate
          FROM (SELECT * EXCLUDE (case_fatality_rate) FROM latest) WHERE total_cases >= {MIN_CASES}
          ORDER BY case_fatality_rate DESC NULLS LAST, country_name LIMIT 25""",
        "q6_cases_per_100k": _per_100k("total_cases", "cases_per_100k").replace(
            "FROM latest", "FROM (SELECT * EXCLUDE (cases_per_100k) FROM latest)"),
        "q7_deaths_per_100k": _per_100k("total_deaths", "deaths_per_100k").replace(
            "FROM latest", "FROM (SELECT * EXCLUDE (deaths_per_100k) FROM latest)"),
        "q8_roll7_cases": _rolling_total("new_cases", "daily_cases", "rolling_7day_global_cases"),
        "q9_roll7_deaths": _rolling_total("new_deaths", "daily_deaths", "rolling_7day_global_deaths"),
        "q10_vax_status": f"""WITH {MODEL} SELECT country_name, region_name, population,
          people_vaccinated, people_fully_vaccinated,
          {per_cent("people_vaccinated", "population", digits=2)} AS single_dose_coverage_pct,
          {per_cent("people_fully_vaccinated", "population", digits=2)} AS fully_vaccinated_pct,
          date AS latest_data_reported
          FROM (SELECT * FROM covered WHERE people_vaccinated > 0
                QUALIFY date = max(date) OVER (PARTITION BY country_id))
          WHERE population >= 1000000
          ORDER BY fully_vaccinated_pct DESC NULLS LAST, country_name LIMIT 30""",
        "q11_monthly_cases": _monthly("new_cases", "monthly_new_cases", "peak_single_day_cases"),
        "q12_monthly_deaths": _monthly("new_deaths", "monthly_new_deaths", "peak_single_day_deaths"),
        "q13_burden_rank": f"""WITH {MODEL} SELECT country_name, total_cases, total_deaths,
          {dense.format("total_cases")} AS case_rank, {dense.format("total_deaths")} AS death_rank,
          {dense.format("total_cases * 1e5 / population")} AS case_per_capita_rank,
          {dense.format("total_deaths * 1e5 / population")} AS death_per_capita_rank
          FROM latest WHERE population >= 1000000 ORDER BY case_rank, country_name LIMIT 30""",
        "q14_region_rank": f"""WITH {MODEL} SELECT coalesce(region_name, 'Unassigned') AS region,
          count(DISTINCT country_id) AS sovereign_states,
          CAST(sum(population) AS BIGINT) AS total_regional_population,
          sum(total_cases) AS total_regional_cases, sum(total_deaths) AS total_regional_deaths,
          {per_cent("sum(total_deaths)", "sum(total_cases)")} AS regional_cfr,
          {per_cent("sum(total_cases)", "sum(population)", "1e5", 2)} AS regional_cases_per_100k,
          {per_cent("sum(total_deaths)", "sum(population)", "1e5", 2)} AS regional_deaths_per_100k,
          {region_rank.format("sum(total_cases)")} AS regional_case_rank,
          {region_rank.format("sum(total_deaths)")} AS regional_death_rank
          FROM latest GROUP BY 1""",
        "q15_mom_growth": f"""WITH {PANEL}, months AS (
            SELECT strftime(date, '%Y-%m') AS year_month, sum(new_cases) AS total_cases,
              sum(new_deaths) AS total_deaths FROM panel GROUP BY 1),
          lagged AS (SELECT *, lag(total_cases) OVER (ORDER BY year_month) AS prior_month_cases,
              lag(total_deaths) OVER (ORDER BY year_month) AS prior_month_deaths FROM months)
          SELECT *, {", ".join(growth)} FROM lagged""",
        "q16_vax_velocity": f"""WITH {MODEL}, gains AS (
            SELECT country_name, date AS peak_acceleration_date, population,
              people_fully_vaccinated - lag(people_fully_vaccinated, 30)
                OVER (PARTITION BY country_id ORDER BY date) AS monthly_fully_vax_growth
            FROM covered WHERE population >= 5000000)
          SELECT country_name, peak_acceleration_date, monthly_fully_vax_growth,
            {per_cent("monthly_fully_vax_growth", "population", digits=2)}
              AS population_pct_vaccinated_in_30days
          FROM gains WHERE monthly_fully_vax_growth > 0
          ORDER BY monthly_fully_vax_growth DESC, country_name, peak_acceleration_date LIMIT 25""",
        "q17_vax_tiers": f"""WITH {MODEL}, {both} SELECT
          CASE WHEN {coverage} >= 70 THEN 'High Vax (>=70%)'
               WHEN {coverage} >= 40 THEN 'Medium Vax (40-69%)' ELSE 'Low Vax (<40%)' END
            AS vaccination_tier, count(*) AS country_count,
          CAST(sum(population) AS BIGINT) AS total_population, sum(total_cases) AS total_cases,
          sum(total_deaths) AS total_deaths,
          {per_cent("sum(total_deaths)", "sum(total_cases)")} AS group_case_fatality_rate,
          {per_cent("sum(total_cases)", "sum(population)", "1e5", 2)} AS group_cases_per_100k,
          {per_cent("sum(total_deaths)", "sum(population)", "1e5", 2)} AS group_deaths_per_100k
          FROM both_ WHERE population >= 1000000 GROUP BY 1""",
        "q18_vax_cross_section": f"""WITH {MODEL}, {both} SELECT country_name, region_name, population,
          {per_cent("people_fully_vaccinated", "population", digits=2)} AS fully_vaccinated_pct,
          {per_cent("total_deaths", "population", "1e5", 2)} AS deaths_per_100k,
          {per_cent("total_deaths", "total_cases")} AS case_fatality_rate
          FROM (SELECT * EXCLUDE (deaths_per_100k, case_fatality_rate) FROM both_)
          WHERE population >= 5000000
          ORDER BY fully_vaccinated_pct DESC NULLS LAST, country_name LIMIT 30""",
        "qw_wave_windows": f"""WITH {PANEL}, means AS (
            SELECT country AS country_name, date AS wave_peak_date,
              {away(mean["a"], 2)} AS peak_7day_average_cases,
              {away(mean["b"], 2)} AS preceding_velocity,
              {away(mean["c"], 2)} AS succeeding_velocity
            FROM panel WHERE country IN ({names(NATIONS[:5])}))
          SELECT *, {away("peak_7day_average_cases - preceding_velocity", 2)} AS surge_intensity
          FROM means WHERE peak_7day_average_cases > 100
            AND peak_7day_average_cases > preceding_velocity * 1.4e0
            AND peak_7day_average_cases > succeeding_velocity * 1.2e0""",
        "qd_day_zero": f"""WITH {PANEL}, aged AS (
            SELECT *, min(CASE WHEN total_cases >= 100 THEN date END)
              OVER (PARTITION BY country_id) AS start FROM panel)
          SELECT country AS country_name,
            CAST(date_diff('day', start, date) AS INTEGER) AS days_since_outbreak_start,
            total_cases, total_deaths FROM aged
          WHERE country IN ({names(NATIONS)}) AND date >= start
            AND date_diff('day', start, date) IN (30, 60, 90, 180, 365, 730)""",
        "qn1_global_totals": f"""WITH {PANEL} SELECT count(DISTINCT country_id) AS total_countries,
          CAST(sum(population) AS BIGINT) AS monitored_population,
          max(total_cases) AS global_total_cases_approx,
          max(total_deaths) AS global_total_deaths_approx FROM panel""",
        "qn2_region_stress": f"""WITH {MODEL} SELECT region_name, count(*) AS country_count,
          {away("sum(total_cases) / 1e6", 2)} AS cases_millions,
          {away("sum(total_deaths) / 1e3", 2)} AS deaths_thousands,
          {per_cent("sum(total_deaths)", "sum(total_cases)", digits=3)} AS regional_cfr
          FROM latest WHERE region_name IS NOT NULL GROUP BY region_name""",
    }


def statistics() -> dict[str, str]:
    described = ("new_cases", "new_deaths", "total_cases", "total_deaths", "case_fatality_rate",
                 "cases_per_100k", "deaths_per_100k", "vaccination_rate", "fully_vaccinated_rate")
    lines = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    rates = ("cases_per_100k", "deaths_per_100k", "case_fatality_rate", "vaccination_rate",
             "fully_vaccinated_rate")
    gappy = ("new_cases", "new_deaths", "total_cases", "population")

    def cell(x: str, y: str) -> str:
        value = "1e0" if x == y else even(f"corr({x}, {y})", 4)
        return f"{value} AS {y}"

    matrix = " UNION ALL ".join(
        f"SELECT '{x}' AS x, {', '.join(cell(x, y) for y in lines)} FROM lineitem" for x in lines
    )

    def rolled(metric: str) -> str:
        return ", ".join(
            f'{even(f"avg({metric}) OVER (ORDER BY date ROWS {w - 1} PRECEDING)", 2)} AS "{w}d_avg"'
            for w in (7, 14, 30)
        )

    columns = ", ".join(
        f"max(CASE WHEN country = '{n}' THEN \"7_day_cases_avg\" END) AS \"{n}\"" for n in NATIONS
    )
    per_nation = 'SELECT country AS series, date AS day, "30_day_cases_avg" AS value FROM features'
    week = even("avg(new_cases) OVER (ORDER BY date ROWS 6 PRECEDING)", 2)
    total = f"SELECT 'all' AS series, date AS day, {week} AS value FROM totals"
    return {
        "a5_detect_peaks": f"""WITH RECURSIVE {FEATURES}, {_waves(per_nation, 45, 0.25)}
          SELECT series AS country, * EXCLUDE (series) FROM waves""",
        "a5_detect_peaks_total": f"""WITH RECURSIVE {TOTALS}, {_waves(total, 60, 0.25)}
          SELECT * EXCLUDE (series) FROM waves""",
        "a1_describe_plus": f"WITH {FEATURES} {_describe('features', described)}",
        "a1_describe_lineitem": _describe("lineitem", lines),
        "a2_corr_pearson": f"WITH {FEATURES} {_corr('features', rates)}",
        "a2_corr_matrix": matrix,
        "a3_corr_spearman": f"WITH {GAPPY} {_spearman('gappy', gappy)}",
        "a3_corr_spearman_lineitem": _spearman("lineitem", lines),
        "a4_series_rolling": f"WITH {TOTALS} SELECT date, new_cases, {rolled('new_cases')} FROM totals",
        "a4_series_rolling_entity": f"""WITH {PANEL} SELECT date, new_deaths, {rolled("new_deaths")}
          FROM panel WHERE country = 'NATION_3'""",
        "a6_compare_trajectories": f"""WITH {FEATURES} SELECT date, {columns} FROM features
          WHERE country IN ({names(NATIONS)}) GROUP BY date""",
        "a7_region_max_summary": f"""WITH {FEATURES} SELECT region, max(total_cases) AS total_cases,
          max(total_deaths) AS total_deaths, arg_min(population, (country, date)) AS population,
          max(total_deaths) / max(total_cases) * 1e2 AS cfr FROM features GROUP BY region""",
    }


def charts() -> dict[str, str]:
    def leaders(rate: str) -> str:
        return f"""WITH {FEATURES} SELECT country, max({rate}) AS {rate} FROM features
          WHERE population >= 1000000 GROUP BY country
          ORDER BY max({rate}) DESC NULLS LAST, country LIMIT 15"""

    def rolling(counter: str, smoothed: str) -> str:
        return f"""WITH {FEATURES}, {top_of(counter, 5)} SELECT country, date, "{smoothed}"
          FROM features WHERE country IN (SELECT country FROM top)"""

    def monthly(metric: str) -> str:
        return f"""WITH {PANEL} SELECT strftime(date, '%Y-%m') AS month, sum({metric}) AS {metric}
          FROM panel GROUP BY 1"""

    by_region = ", ".join(
        f"sum(CASE WHEN region = '{r}' THEN new_cases ELSE 0e0 END) AS \"{r}\"" for r in REGIONS
    )
    smoothed = ", ".join(_full_mean(f'"{r}"', 14) + f' AS "{r}"' for r in REGIONS)
    scatter = f"""scatter AS (
        SELECT country, max(fully_vaccinated_rate) AS fully_vaccinated_rate,
          {_last("case_fatality_rate")}, max(population) AS population,
          arg_min(region, date) AS region
        FROM features WHERE population >= 2000000 AND total_cases >= {MIN_CASES} GROUP BY country)"""
    two_weeks = "avg(new_cases) OVER (ORDER BY date ROWS 13 PRECEDING)"
    total = f"SELECT 'all' AS series, date AS day, {two_weeks} AS value FROM totals"
    return {
        "f17_chart_waves": f"""WITH RECURSIVE {TOTALS}, {_waves(total, 60, 0.2)}
          SELECT * EXCLUDE (series) FROM waves""",
        "f1_chart_daily_cases": f"""WITH {TOTALS} SELECT date, new_cases,
          {_full_mean("new_cases")} AS "7d_avg" FROM totals""",
        "f2_chart_daily_deaths": f"""WITH {TOTALS} SELECT date, new_deaths,
          {_full_mean("new_deaths")} AS "7d_avg" FROM totals""",
        "f3_chart_rolling_cases": rolling("total_cases", "7_day_cases_avg"),
        "f4_chart_rolling_deaths": rolling("total_deaths", "7_day_deaths_avg"),
        "f5_chart_top_cases": f"WITH {FEATURES}, {top_of('total_cases', 15)} SELECT * FROM top",
        "f6_chart_top_deaths": f"WITH {FEATURES}, {top_of('total_deaths', 15)} SELECT * FROM top",
        "f7_chart_cfr": f"""WITH {FEATURES} SELECT country, max(total_cases) AS total_cases,
          max(total_deaths) AS total_deaths, {_last("case_fatality_rate")}
          FROM features GROUP BY country HAVING max(total_cases) >= {MIN_CASES}
          ORDER BY case_fatality_rate DESC NULLS LAST, country LIMIT 15""",
        "f8_chart_vax_coverage": f"""WITH {PANEL} SELECT date,
          CAST(coalesce(sum(people_vaccinated), 0) AS BIGINT) AS people_vaccinated,
          CAST(coalesce(sum(people_fully_vaccinated), 0) AS BIGINT) AS people_fully_vaccinated,
          CAST(coalesce(sum(population), 0) AS BIGINT) AS population
          FROM panel WHERE date >= DATE '1997-01-01' GROUP BY date""",
        "f9_chart_cases_100k": leaders("cases_per_100k"),
        "f10_chart_deaths_100k": leaders("deaths_per_100k"),
        "f11_chart_compare": f"""WITH {FEATURES} SELECT country, date,
          "7_day_cases_avg" / 1e3 AS "7_day_cases_avg_thousands"
          FROM features WHERE country IN ({names(NATIONS)})""",
        "f12_chart_region_trend": f"""WITH {PANEL}, wide AS (
            SELECT date, {by_region} FROM panel GROUP BY date) SELECT date, {smoothed} FROM wide""",
        "f12_region_trend_rows": f"""WITH {PANEL}, wide AS (
            SELECT date, {by_region} FROM panel GROUP BY date), trend AS (SELECT date, {smoothed} FROM wide)
          SELECT date, region, value
          FROM trend UNPIVOT INCLUDE NULLS (value FOR region IN (COLUMNS(* EXCLUDE (date))))""",
        "f13_chart_vax_vs_cases": f"""WITH {FEATURES} SELECT country,
          max(fully_vaccinated_rate) AS fully_vaccinated_rate, max(cases_per_100k) AS cases_per_100k,
          max(population) AS population, arg_min(region, date) AS region
          FROM features WHERE population >= 2000000 GROUP BY country""",
        "f14_chart_vax_vs_cfr": f"WITH {FEATURES}, {scatter} SELECT * FROM scatter",
        "f14_straight_line": f"""WITH {FEATURES}, {scatter}
          SELECT {even("regr_slope(case_fatality_rate, fully_vaccinated_rate)", 8)} AS slope,
            {even("regr_intercept(case_fatality_rate, fully_vaccinated_rate)", 8)} AS intercept,
            CAST(count(*) AS BIGINT) AS points FROM scatter HAVING count(*) > 5""",
        "f15_chart_monthly_cases": monthly("new_cases"),
        "f16_chart_monthly_deaths": monthly("new_deaths"),
        "f17_smoothed_total": f"""WITH {TOTALS} SELECT date, new_cases,
          avg(new_cases) OVER (ORDER BY date ROWS 13 PRECEDING) AS smoothed FROM totals""",
        "f18_chart_month_heatmap": f"""WITH {FEATURES}, {top_of("total_cases", 15)},
          sums AS (SELECT country, strftime(date, '%Y-%m') AS month, sum(new_cases) / 1e6 AS millions
            FROM features WHERE country IN (SELECT country FROM top) GROUP BY 1, 2)
          SELECT country, month, coalesce(millions, 0e0) AS millions
          FROM (SELECT DISTINCT country FROM sums) CROSS JOIN (SELECT DISTINCT month FROM sums)
          LEFT JOIN sums USING (country, month)""",
    }


def exploration() -> dict[str, str]:
    def board(by: str, condition: str) -> str:
        return f"""(SELECT '{by}' AS board, country, {by} AS value FROM snapshot WHERE {condition}
          ORDER BY {by} DESC NULLS LAST, country LIMIT 10)"""

    shown = ("country", "date", "new_cases", "total_cases", "new_deaths", "total_deaths",
             "case_fatality_rate", "cases_per_100k", "fully_vaccinated_rate")
    snapshot = ("region", "total_cases", "total_deaths", "people_vaccinated",
                "people_fully_vaccinated", "population")

    def peak(metric: str, topic: str) -> str:
        return f"""SELECT '{topic}' AS topic, format('Highest daily {topic}: {{:,}} on {{}}',
          CAST({metric} AS BIGINT), strftime(date, '%B %d, %Y')) AS text
          FROM (SELECT * FROM day_totals ORDER BY {metric} DESC, date LIMIT 1)"""

    boards = [
        board("total_cases", "true"),
        board("case_fatality_rate", f"total_cases >= {MIN_CASES}"),
        board("cases_per_100k", "population >= 500000"),
        board("deaths_per_100k", "population >= 500000"),
    ]
    return {
        "d1_filter_panel": f"""WITH {PANEL} SELECT country, region, date, new_cases, total_cases
          FROM panel WHERE date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
            AND region IN ({names(REGIONS[:3])}) AND country IN ({names(NATIONS)})""",
        "d1_choices": f"WITH {PANEL} SELECT DISTINCT region, country FROM panel",
        "d2_latest_per_entity": f"""WITH {GAPPY} SELECT country, {", ".join(_last(c) for c in snapshot)}
          FROM gappy GROUP BY country""",
        "d3_kpis": f"""WITH {FILTERED} SELECT sum(total_cases) AS cases, sum(total_deaths) AS deaths,
          CAST(sum(people_vaccinated) AS BIGINT) AS vaccinated,
          CAST(sum(people_fully_vaccinated) AS BIGINT) AS fully_vaccinated,
          CAST(sum(population) AS BIGINT) AS population, count(*) AS entities,
          sum(total_deaths) / sum(total_cases) * 1e2 AS fatality_pct,
          sum(people_fully_vaccinated) / sum(population) * 1e2 AS coverage_pct FROM snapshot""",
        "d4_daily_filtered": f"""WITH {FILTERED} SELECT date, new_cases, new_deaths,
          {even('"7_day_cases_avg"', 2)} AS "7_day_cases_avg",
          {even('"7_day_deaths_avg"', 2)} AS "7_day_deaths_avg" FROM day_totals""",
        "d5_leaderboards": f"WITH {FILTERED} {' UNION ALL '.join(boards)}",
        "d5_coverage_scatter": f"""WITH {FILTERED} SELECT country, region, fully_vaccinated_rate,
          case_fatality_rate, total_cases, total_deaths FROM snapshot
          WHERE population >= 2000000 AND total_cases >= {MIN_CASES // 2}""",
        "d6_explorer_tail": f"""WITH {FILTERED} SELECT {", ".join(shown)} FROM filtered
          ORDER BY country DESC, date DESC LIMIT 500""",
        "d7_insights": f"""WITH {FILTERED} {peak("new_cases", "cases")}
          UNION ALL {peak("new_deaths", "deaths")}
          UNION ALL SELECT 'fatality', format(
            'Highest case fatality: {{}} with {{:.2f}}% ({{:,}} deaths of {{:,}} cases)', country,
            case_fatality_rate, CAST(total_deaths AS BIGINT), CAST(total_cases AS BIGINT))
          FROM (SELECT * FROM snapshot WHERE total_cases >= {MIN_CASES}
                ORDER BY case_fatality_rate DESC NULLS LAST, country LIMIT 1)""",
    }


def oracle_sql() -> dict[str, str]:
    parts = (ingestion, cleaning, quality, features, model, suite, statistics, charts, exploration)
    result = {}
    for part in parts:
        result |= part()
    result["ranks_bucketed"] = """SELECT c_custkey, c_acctbal,
      CAST(dense_rank() OVER (ORDER BY c_acctbal DESC NULLS LAST) AS INTEGER) AS dense,
      CAST(rank() OVER (ORDER BY c_acctbal DESC NULLS LAST) AS INTEGER) AS rank FROM customer"""
    return result
