"""Independent SQL formulations of the registered queries (DuckDB dialect).

These follow the *literal* definitions — one row per span and active period,
generated with ``generate_series`` — instead of the plans the library runs,
so agreement checks the rewrites (difference events, compact spans, window
fills) against the definition.
"""

from __future__ import annotations

# Proxy spans: one order = one vacancy (see jobtide.sources.proxy.order_spans).
SPANS_CTE = """
li AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship, sum(l_quantity) AS qty
  FROM lineitem GROUP BY l_orderkey),
spans AS (
  SELECT o.o_orderkey AS id, c.c_mktsegment AS grp, o.o_orderdate AS start_ts,
         coalesce(li.last_ship, o.o_orderdate + INTERVAL 77 DAY) AS end_ts,
         coalesce(CAST(trunc(li.qty) AS BIGINT), 1) AS weight
  FROM orders o
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE coalesce(li.last_ship, o.o_orderdate + INTERVAL 77 DAY) >= o.o_orderdate)"""


SPANS_NATION_CTE = SPANS_CTE.replace(
    "SELECT o.o_orderkey AS id, c.c_mktsegment AS grp,", "SELECT o.o_orderkey AS id, n.n_name AS grp,"
).replace("LEFT JOIN customer c ON o.o_custkey = c.c_custkey",
          "LEFT JOIN customer c ON o.o_custkey = c.c_custkey\n  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")


def _period_sql(freq: str) -> tuple[str, str, str]:
    """(truncation unit, generate_series step, label offset) per frequency."""
    if freq == "M":
        return "month", "INTERVAL 1 MONTH", "M"
    if freq == "W":
        return "week", "INTERVAL 7 DAY", "W"
    return "week", "INTERVAL 14 DAY", "2W"


def demand_series_sql(freq: str, min_activity: int = 5, spans_cte: str = SPANS_CTE) -> str:
    """TS-01 by brute force: each span's own period labels, kept if in the calendar."""
    return f"WITH {demand_ctes(freq, min_activity, spans_cte)}\nSELECT series, period, value FROM ts"


def demand_ctes(freq: str, min_activity: int = 5, spans_cte: str = SPANS_CTE) -> str:
    """CTEs ending in ``ts(series, period, value)``."""
    unit, step, kind = _period_sql(freq)
    if kind == "M":
        # month-start generator, label = month end
        first = f"date_trunc('{unit}', {{t}})"
        label = "last_day(CAST(m AS DATE))"
    else:
        # first Sunday on or after the Monday of the week, label = that Sunday
        first = f"date_trunc('{unit}', {{t}}) + INTERVAL 6 DAY"
        label = "CAST(m AS DATE)"
    return f"""
{spans_cte},
valid AS (SELECT * FROM spans WHERE start_ts IS NOT NULL AND end_ts IS NOT NULL),
active AS (SELECT grp FROM valid WHERE grp IS NOT NULL GROUP BY grp HAVING count(*) >= {min_activity}),
bounds AS (SELECT date_trunc('{unit}', min(start_ts)) AS lo, date_trunc('{unit}', max(end_ts)) AS hi FROM valid),
cal AS (
  SELECT DISTINCT period FROM (
    SELECT {label} AS period, hi FROM (
      SELECT unnest(generate_series({first.format(t='lo')}, hi, {step})) AS m, hi FROM bounds))
  WHERE period <= hi),
cells AS (
  SELECT grp, weight, {label} AS period, hi FROM (
    SELECT v.grp, v.weight, date_trunc('{unit}', v.end_ts) AS hi,
           unnest(generate_series({first.format(t='v.start_ts')}, date_trunc('{unit}', v.end_ts), {step})) AS m
    FROM valid v WHERE v.grp IN (SELECT grp FROM active))),
agg AS (
  SELECT grp, period, sum(weight) AS v FROM cells
  WHERE period <= hi AND period IN (SELECT period FROM cal)
  GROUP BY grp, period),
dense AS (
  SELECT a.grp AS series, c.period, CAST(coalesce(g.v, 0) AS DOUBLE) AS value
  FROM active a CROSS JOIN cal c
  LEFT JOIN agg g ON g.grp = a.grp AND g.period = c.period),
ts AS (
  SELECT series, period, value FROM dense
  UNION ALL
  SELECT 'total_demand' AS series, period, CAST(sum(value) AS DOUBLE) AS value
  FROM dense GROUP BY period)"""


# --- preparation -------------------------------------------------------------

# Proxy preparation settings shared by the Spark queries and the SQL below.
PROXY_KEYWORD = "o"
PROXY_LO = "1995-03-01"
PROXY_HI = "2001-06-30"

RAW_CTE = """
lia AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship, min(l_shipdate) AS first_ship,
         sum(l_quantity) AS qty, count(*) AS n_lines,
         min(l_partkey) AS first_part
  FROM lineitem GROUP BY l_orderkey),
rawj AS (
  SELECT o.*, lia.*, c.*, n.*, p.*,
         CAST(trunc(coalesce(lia.qty, 0.0)) AS BIGINT) AS q, o.o_orderkey % 10 AS form
  FROM orders o
  LEFT JOIN lia ON o.o_orderkey = lia.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN part p ON lia.first_part = p.p_partkey),
raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS vacancy_id, p_name AS title,
    CASE form WHEN 0 THEN CAST(q AS VARCHAR)
      WHEN 1 THEN 'от ' || CAST(q % 7 + 1 AS VARCHAR) || ' до ' || CAST(q % 11 + 8 AS VARCHAR)
      WHEN 2 THEN 'от ' || CAST(q % 20 AS VARCHAR)
      WHEN 3 THEN 'до ' || CAST(q % 9 + 1 AS VARCHAR)
      WHEN 4 THEN NULL
      WHEN 5 THEN CAST(q % 6 AS VARCHAR) || '.9'
      WHEN 6 THEN 'abc'
      WHEN 7 THEN CAST(q * 400 AS VARCHAR)
      WHEN 8 THEN '-' || CAST(q % 3 AS VARCHAR)
      ELSE ' ' || CAST(q % 5 + 1 AS VARCHAR) || 'e1 ' END AS work_places,
    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS industry,
    strftime(o_orderdate, '%Y-%m-%d') AS date_creation,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN '1' ELSE '0' END
      AS date_creation_mistake,
    strftime(first_ship, '%Y-%m-%d') AS date_posted,
    '0' AS date_posted_mistake,
    CASE WHEN o_orderstatus <> 'O' THEN strftime(last_ship, '%Y-%m-%d') END AS date_inactivation,
    CASE WHEN o_orderstatus = 'O' THEN strftime(last_ship, '%Y-%m-%d') END AS date_last_updated,
    strftime(o_orderdate, '%Y-%m-%d') AS date_modify_inner_info,
    '0' AS date_modify_inner_info_mistake,
    o_orderpriority AS employment_type,
    o_orderstatus AS education_requirements_education_type,
    n_name AS region, p_type AS profession, c_name AS organization,
    CAST(o_totalprice AS VARCHAR) AS base_salary_min,
    CAST(c_acctbal AS VARCHAR) AS base_salary_max,
    CAST(n_lines AS VARCHAR) AS experience_requirements
  FROM rawj)"""

_RANGE = r"от\s+(\d+)\s+до\s+(\d+)"
_FROM = r"от\s+(\d+)"


def weight_sql(x: str) -> str:
    """FN-01 in SQL."""
    num = f"TRY_CAST(trim({x}) AS DOUBLE)"
    return f"""CASE WHEN {x} IS NULL THEN 1
  WHEN contains({x}, 'до') AND regexp_matches({x}, '{_RANGE}')
    THEN (CAST(regexp_extract({x}, '{_RANGE}', 1) AS BIGINT)
          + CAST(regexp_extract({x}, '{_RANGE}', 2) AS BIGINT)) // 2
  WHEN NOT contains({x}, 'до') AND contains({x}, 'от') AND regexp_matches({x}, '{_FROM}')
    THEN CAST(regexp_extract({x}, '{_FROM}', 1) AS BIGINT)
  WHEN isfinite({num}) AND {num} >= 1 THEN CAST(least(floor({num}), 10000) AS BIGINT)
  ELSE 1 END"""


def ts_sql(x: str) -> str:
    """FN-08 in SQL (same format list)."""
    fmts = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d",
            "%d.%m.%Y %H:%M:%S", "%d.%m.%Y"]
    return "coalesce(" + ", ".join(f"try_strptime({x}, '{f}')" for f in fmts) + ")"


_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
          "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def nulls_sql(x: str) -> str:
    lst = ", ".join("'" + v + "'" for v in _NULLS)
    return f"CASE WHEN {x} IN ({lst}) THEN NULL ELSE {x} END"


DATES = (("date_creation", "date_creation_mistake"), ("date_posted", "date_posted_mistake"),
         ("date_inactivation", None), ("date_last_updated", None),
         ("date_modify_inner_info", "date_modify_inner_info_mistake"))
CATS = ("industry", "employment_type", "education_requirements_education_type", "region",
        "profession", "organization")
NUMS = ("base_salary_min", "base_salary_max", "experience_requirements")


def _base_cte() -> str:
    """Title filter, null markers, weight, dates and parts, categories filled."""
    cols = ["vacancy_id", "title", f"{weight_sql(nulls_sql('work_places'))} AS work_places"]
    for c in CATS:
        cols.append(f"coalesce({nulls_sql(c)}, 'Unknown') AS {c}")
    for c in NUMS:
        cols.append(f"TRY_CAST(trim(replace({nulls_sql(c)}, '_', '')) AS DOUBLE) AS {c}_num")
    for d, flag in DATES:
        txt = nulls_sql(d)
        if flag:
            txt = f"CASE WHEN {nulls_sql(flag)} = '1' THEN NULL ELSE {txt} END"
        cols.append(f"{ts_sql(txt)} AS {d}_processed")
    sel = ",\n    ".join(cols)
    parts = []
    for d, _ in DATES:
        parts += [f"year({d}_processed) AS {d}_year", f"month({d}_processed) AS {d}_month",
                  f"quarter({d}_processed) AS {d}_quarter"]
    return f"""
base0 AS (
  SELECT {sel}
  FROM raw WHERE contains(lower(title), '{PROXY_KEYWORD}')),
base AS (SELECT *, {', '.join(parts)} FROM base0),
g AS (SELECT avg(work_places) AS gm FROM base)"""


def _cat_features() -> list[str]:
    return [f"{d}_{p}" for d, _ in DATES for p in ("year", "month", "quarter")] + list(CATS)


def _bins_cte() -> str:
    """AGG-04/05: fence, median fill, quantile edges, bin index per numeric feature."""
    q = ", ".join(f"quantile_cont({c}_num, 0.25) AS {c}_q1, quantile_cont({c}_num, 0.75) AS {c}_q3"
                  for c in NUMS)
    clip = ", ".join(
        f"CASE WHEN {c}_num IS NULL THEN NULL "
        f"WHEN {c}_num < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) THEN {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) "
        f"WHEN {c}_num > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) THEN {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) "
        f"ELSE {c}_num END AS {c}_clip" for c in NUMS)
    med = ", ".join(f"quantile_cont({c}_clip, 0.5) AS {c}_med" for c in NUMS)
    fill = ", ".join(f"coalesce({c}_clip, {c}_med) AS {c}" for c in NUMS)
    probs = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"
    edges = ", ".join(f"list_sort(list_distinct(quantile_cont({c}, {probs}))) AS {c}_edges"
                      for c in NUMS)
    bins = ", ".join(
        f"CASE WHEN len({c}_edges) >= 2 THEN "
        f"greatest(len(list_filter({c}_edges, lambda e: e < {c})) - 1, 0) END AS {c}_bin"
        for c in NUMS)
    return f"""
qs AS (SELECT {q} FROM base),
clipped AS (SELECT base.*, {clip} FROM base, qs),
meds AS (SELECT {med} FROM clipped),
filled AS (SELECT clipped.*, {fill} FROM clipped, meds),
edges AS (SELECT {edges} FROM filled),
binned AS (SELECT filled.*, {bins} FROM filled, edges)"""


def _maps_cte() -> str:
    """One stacked relation for every encoding: (feature, key, n, mean, enc)."""
    parts = [f"SELECT '{f}' AS feature, coalesce(CAST({f} AS VARCHAR), 'Unknown') AS key, "
             f"work_places AS t FROM binned" for f in _cat_features()]
    parts += [f"SELECT '{c}' AS feature, CAST({c}_bin AS VARCHAR) AS key, work_places AS t "
              f"FROM binned WHERE {c}_bin IS NOT NULL" for c in NUMS]
    cats = ", ".join(f"'{f}'" for f in _cat_features())
    stacked = "\n  UNION ALL ".join(parts)
    return f"""
stacked AS (
  {stacked}),
maps AS (
  SELECT feature, key, count(t) AS n, avg(t) AS mean,
    CASE WHEN feature IN ({cats}) AND count(t) < 10
      THEN (avg(t) * count(t) + (SELECT gm FROM g) * 10) / (count(t) + 10)
      ELSE avg(t) END AS enc
  FROM stacked GROUP BY feature, key)"""


def _prepared_cte() -> str:
    """Encodings joined back, span end and duration, filters."""
    joins, encs = [], []
    for i, f in enumerate(_cat_features()):
        joins.append(f"LEFT JOIN maps m{i} ON m{i}.feature = '{f}' AND "
                     f"m{i}.key = coalesce(CAST(b.{f} AS VARCHAR), 'Unknown')")
        encs.append(f"coalesce(m{i}.enc, (SELECT gm FROM g)) AS {f}_encoded")
    for j, c in enumerate(NUMS):
        i = len(_cat_features()) + j
        joins.append(f"LEFT JOIN maps m{i} ON m{i}.feature = '{c}' AND m{i}.key = CAST(b.{c}_bin AS VARCHAR)")
        encs.append(f"coalesce(m{i}.enc, (SELECT gm FROM g)) AS {c}_encoded")
    end = ("coalesce(b.date_inactivation_processed, b.date_last_updated_processed, "
           "b.date_creation_processed + INTERVAL 77 DAY)")
    dur = (f"CAST(least(greatest(coalesce(CAST(floor((epoch({end}) - "
           f"epoch(b.date_creation_processed)) / 86400) AS BIGINT), 77), 1), 365) AS INTEGER)")
    return f"""
enc AS (
  SELECT b.*, {', '.join(encs)}, {end} AS date_end, {dur} AS vacancy_duration
  FROM binned b
  {chr(10).join('  ' + j for j in joins)}),
prepared AS (
  SELECT * FROM enc
  WHERE date_creation_processed IS NOT NULL
    AND date_end >= date_creation_processed
    AND industry <> 'Unknown'
    AND date_creation_processed BETWEEN TIMESTAMP '{PROXY_LO}' AND TIMESTAMP '{PROXY_HI}')"""


def prepare_cte() -> str:
    return RAW_CTE + "," + _base_cte() + "," + _bins_cte() + "," + _maps_cte() + "," + _prepared_cte()


def weight_parse_sql() -> str:
    return f"""WITH {RAW_CTE}
SELECT vacancy_id, work_places AS work_places_text,
       {weight_sql(nulls_sql('work_places'))} AS work_places
FROM raw"""


def prepared_spans_sql() -> str:
    return f"""WITH {prepare_cte()}
SELECT vacancy_id, industry, date_creation_processed, date_end, vacancy_duration, work_places
FROM prepared"""


def encoding_maps_sql() -> str:
    return f"""WITH {RAW_CTE},{_base_cte()},{_bins_cte()},{_maps_cte()}
SELECT feature, key, n, round(mean, 6) AS mean, round(enc, 6) AS enc FROM maps"""


def encoded_profile_sql() -> str:
    feats = _cat_features() + list(NUMS)
    rows = "\n  UNION ALL ".join(
        f"SELECT '{f}_encoded' AS column_name, round(min({f}_encoded), 6) AS min_value, "
        f"round(max({f}_encoded), 6) AS max_value, round(avg({f}_encoded), 6) AS mean_value "
        f"FROM prepared" for f in feats)
    return f"""WITH {prepare_cte()}
{rows}"""


# --- series operators ----------------------------------------------------------

def _ts(freq: str = "M") -> str:
    return demand_ctes(freq, 5)


def _qsorted(arr: str, p: float) -> str:
    """Linear-interpolation quantile of a sorted non-empty list (1-based)."""
    pos = f"((len({arr}) - 1) * {p})"
    lo = f"(CAST(floor({pos}) AS BIGINT) + 1)"
    hi = f"least({lo} + 1, len({arr}))"
    return f"({arr}[{lo}] + ({arr}[{hi}] - {arr}[{lo}]) * ({pos} - floor({pos})))"


FLAGS_CTE = """
st AS (
  SELECT series, period, value,
    abs(value - avg(value) OVER (PARTITION BY series))
      / nullif(stddev_pop(value) OVER (PARTITION BY series), 0) AS z,
    quantile_cont(value, 0.5) OVER (PARTITION BY series) AS med,
    quantile_cont(value, 0.9) OVER (PARTITION BY series) AS q90,
    quantile_cont(value, 0.95) OVER (PARTITION BY series) AS q95,
    abs(value - lag(value) OVER (PARTITION BY series ORDER BY period)) AS jf,
    abs(value - lead(value) OVER (PARTITION BY series ORDER BY period)) AS jb
  FROM ts),
flags AS (
  SELECT series, period, value, z,
    coalesce(z > 2.0, false) AS rule_z,
    (value > q90 AND value > med * 2.0) AS rule_extreme,
    CASE WHEN series = 'total_demand' THEN value > 80000.0 ELSE value > q95 * 1.2 END AS rule_high,
    (coalesce(jf > med * 1.5, false) OR coalesce(jb > med * 1.5, false)) AS rule_jump
  FROM st),
flagged AS (
  SELECT *, (rule_z OR rule_extreme OR rule_high OR rule_jump) AS is_anomaly FROM flags)"""


def anomaly_flags_sql(freq: str = "M") -> str:
    return f"""WITH {_ts(freq)},{FLAGS_CTE}
SELECT series, period, value, round(z, 6) AS z, rule_z, rule_extreme, rule_high, rule_jump,
       is_anomaly
FROM flagged"""


def repair_window_sql(freq: str = "M") -> str:
    s = "list_sort(nb)"
    mean = "(list_sum(nb) / len(nb))"
    total_fix = f"CASE WHEN value > 80000.0 THEN greatest({_qsorted(s, 0.75)}, value * 0.6) ELSE {mean} END"
    other_fix = (f"CASE WHEN value > {_qsorted(s, 0.9)} THEN {_qsorted(s, 0.9)} "
                 f"ELSE {_qsorted(s, 0.25)} END")
    fixed = f"CASE WHEN series = 'total_demand' THEN {total_fix} ELSE {other_fix} END"
    return f"""WITH {_ts(freq)},{FLAGS_CTE},
nbh AS (
  SELECT *, list_concat(
      coalesce(list(value) OVER (PARTITION BY series ORDER BY period
                                 ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), []),
      coalesce(list(value) OVER (PARTITION BY series ORDER BY period
                                 ROWS BETWEEN 1 FOLLOWING AND 8 FOLLOWING), [])) AS nb
  FROM flagged)
SELECT series, period, value, is_anomaly,
  CASE WHEN NOT is_anomaly OR len(nb) = 0 THEN value
       ELSE greatest(0.0, CAST(trunc({fixed}) AS DOUBLE)) END AS fixed
FROM nbh"""


def zscores_sql(freq: str = "W") -> str:
    return f"""WITH {_ts(freq)}
SELECT series, period, value,
  round(abs(value - avg(value) OVER (PARTITION BY series))
        / nullif(stddev_pop(value) OVER (PARTITION BY series), 0), 6) AS z_pop,
  round(CASE WHEN stddev_samp(value) OVER (PARTITION BY series) > 0
        THEN abs(value - avg(value) OVER (PARTITION BY series))
             / stddev_samp(value) OVER (PARTITION BY series) ELSE 0 END, 6) AS z_samp
FROM ts"""


def outliers_linear_sql(freq: str = "W", threshold: float = 3.0) -> str:
    return f"""WITH {_ts(freq)},
m AS (
  SELECT series, period,
    (count(value) OVER (PARTITION BY series) >= 4 AND coalesce(
      abs(value - avg(value) OVER (PARTITION BY series))
        / nullif(stddev_pop(value) OVER (PARTITION BY series), 0) > {threshold}, false)) AS is_outlier,
    value AS v0
  FROM ts),
k AS (SELECT series, period, is_outlier, CASE WHEN is_outlier THEN NULL ELSE v0 END AS v,
             CAST(period - DATE '1970-01-01' AS DOUBLE) AS t FROM m),
nb AS (
  SELECT *,
    last_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY period
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS y0,
    last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER (PARTITION BY series ORDER BY period
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS t0,
    first_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY period
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS y1,
    first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER (PARTITION BY series ORDER BY period
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS t1
  FROM k),
lin AS (SELECT series, period, is_outlier, coalesce(v, y0 + (y1 - y0) * (t - t0) / (t1 - t0)) AS v FROM nb)
SELECT series, period, is_outlier, round(coalesce(v,
    first_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY period
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    last_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY period
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0), 6) AS value
FROM lin"""


def decompose_sql(freq: str = "M") -> str:
    return f"""WITH {_ts(freq)},
d0 AS (
  SELECT series, period, value,
    CAST((row_number() OVER (PARTITION BY series ORDER BY period) - 1) % 12 AS INTEGER) AS phase,
    (sum(value) OVER (PARTITION BY series ORDER BY period ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
     + 0.5 * (lag(value, 6) OVER (PARTITION BY series ORDER BY period)
              + lead(value, 6) OVER (PARTITION BY series ORDER BY period))) / 12 AS trend,
    count(*) OVER (PARTITION BY series) AS n
  FROM ts),
d AS (SELECT *, value - trend AS detr FROM d0 WHERE n >= 24),
pm AS (SELECT series, phase, avg(detr) AS pm FROM d GROUP BY series, phase),
ps AS (SELECT series, phase, pm - avg(pm) OVER (PARTITION BY series) AS seasonal FROM pm)
SELECT d.series, d.period, d.value, round(d.trend, 6) AS trend, round(ps.seasonal, 6) AS seasonal,
       round(d.detr - ps.seasonal, 6) AS resid, d.phase
FROM d JOIN ps ON d.series = ps.series AND d.phase = ps.phase"""


def seasonal_by_month_sql(freq: str = "M") -> str:
    inner = decompose_sql(freq).split("SELECT d.series, d.period")[0]
    return inner + """SELECT d.series, CAST(month(d.period) AS INTEGER) AS month,
       round(avg(ps.seasonal), 6) AS seasonal_effect
FROM d JOIN ps ON d.series = ps.series AND d.phase = ps.phase
GROUP BY d.series, month(d.period)"""


def features_sql(freq: str = "M") -> str:
    w = "OVER (PARTITION BY series ORDER BY period"
    lags = ", ".join(f"coalesce(lag(value, {k}) {w}), 0.0) AS lag_{k}" for k in (1, 2, 3, 4, 8, 12))
    mas = ", ".join(
        f"round(CASE WHEN count(value) {w} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) = {k} "
        f"THEN avg(value) {w} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) "
        f"ELSE avg(value) OVER (PARTITION BY series) END, 6) AS ma_{k}" for k in (3, 6, 12))
    return f"""WITH {_ts(freq)}
SELECT series, period, value AS y,
  CAST(month(period) AS INTEGER) AS month, CAST(quarter(period) AS INTEGER) AS quarter,
  CAST(year(period) AS INTEGER) AS year, CAST(dayofyear(period) AS INTEGER) AS day_of_year,
  CAST(period = last_day(period) AND month(period) % 3 = 0 AS INTEGER) AS is_quarter_end,
  CAST(period = last_day(period) AND month(period) = 12 AS INTEGER) AS is_year_end,
  {lags},
  {mas},
  coalesce(value - lag(value, 1) {w}), 0.0) AS diff_1,
  coalesce(value - lag(value, 4) {w}), 0.0) AS diff_4,
  CAST(row_number() {w}) AS INTEGER) AS pos,
  count(*) OVER (PARTITION BY series) AS n
FROM ts"""


# --- report aggregates on the prepared table and on spans -------------------------------

def weight_summary_sql() -> str:
    return f"""WITH {prepare_cte()}
SELECT round(avg(work_places), 6) AS mean, round(quantile_cont(work_places, 0.5), 6) AS median,
       CAST(max(work_places) AS DOUBLE) AS max, round(quantile_cont(work_places, 0.99), 6) AS p99
FROM prepared"""


def overview_sql() -> str:
    return f"""WITH {prepare_cte()}
SELECT count(*) AS rows, strftime(min(date_creation_processed), '%Y-%m') AS first_month,
       strftime(max(date_creation_processed), '%Y-%m') AS last_month,
       CAST(sum(work_places) AS BIGINT) AS total_weight, count(DISTINCT industry) AS groups
FROM prepared"""


def value_counts_sql(k: int | None = None) -> str:
    lim = f"ORDER BY count DESC, grp ASC LIMIT {k}" if k else ""
    return f"""WITH {SPANS_NATION_CTE}
SELECT grp, count(*) AS count FROM spans WHERE grp IS NOT NULL GROUP BY grp {lim}"""


def group_stats_sql() -> str:
    return f"""WITH {SPANS_NATION_CTE}
SELECT grp, round(CAST(sum(weight) AS DOUBLE), 2) AS total, round(avg(weight), 2) AS mean,
       count(weight) AS n
FROM spans GROUP BY grp"""


def top_groups_sql() -> str:
    return f"""WITH {SPANS_NATION_CTE},
st AS (SELECT grp, round(CAST(sum(weight) AS DOUBLE), 2) AS total, round(avg(weight), 2) AS mean,
              count(weight) AS n FROM spans GROUP BY grp),
top AS (SELECT * FROM st ORDER BY total DESC, grp ASC LIMIT 20),
stable AS (SELECT * FROM top WHERE n >= 10 ORDER BY mean DESC, grp ASC LIMIT 15)
SELECT grp, total, mean, n,
       CASE WHEN length(grp) > 25 THEN substr(grp, 1, 25) || '...' ELSE grp END AS label
FROM stable"""


def monthly_counts_sql() -> str:
    return f"""WITH {SPANS_CTE},
m AS (SELECT last_day(CAST(start_ts AS DATE)) AS month FROM spans WHERE start_ts IS NOT NULL),
c AS (SELECT month, count(*) AS count FROM m GROUP BY month),
cal AS (SELECT last_day(CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE))
               AS month FROM m)
SELECT cal.month, CAST(coalesce(c.count, 0) AS BIGINT) AS count FROM cal LEFT JOIN c USING (month)"""


def _hist_sql(src: str, expr: str, name: str, bins: int = 50) -> str:
    return f"""SELECT '{name}' AS feature, CAST(CASE WHEN b.hi > b.lo
         THEN least(floor((v - b.lo) / ((b.hi - b.lo) / {bins})), {bins - 1}) ELSE 0 END AS INTEGER) AS bin,
       count(*) AS count
FROM (SELECT CAST({expr} AS DOUBLE) AS v FROM {src}) x,
     (SELECT min(CAST({expr} AS DOUBLE)) AS lo, max(CAST({expr} AS DOUBLE)) AS hi FROM {src}) b
WHERE v IS NOT NULL AND NOT isnan(v)
GROUP BY 1, 2"""


def weight_histograms_sql() -> str:
    return (f"WITH {SPANS_CTE}\n" + _hist_sql("spans", "weight", "weight") + "\nUNION ALL\n"
            + _hist_sql("spans", "ln(CAST(weight AS DOUBLE) + 1.0)", "log_weight"))


def salary_histogram_sql() -> str:
    return """WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders),
f AS (SELECT o_totalprice FROM orders, q
      WHERE o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
""" + _hist_sql("f", "o_totalprice", "o_totalprice")


def title_retention_sql() -> str:
    return f"""WITH {RAW_CTE}
SELECT count(*) AS rows_read,
       CAST(count_if(contains(lower(title), '{PROXY_KEYWORD}')) AS BIGINT) AS rows_kept,
       round(count_if(contains(lower(title), '{PROXY_KEYWORD}')) * 100.0 / nullif(count(*), 0), 4)
         AS retention_pct
FROM raw"""


def title_filter_sql() -> str:
    return f"""WITH {RAW_CTE}
SELECT vacancy_id, title FROM raw WHERE contains(lower(title), '{PROXY_KEYWORD}')"""


def labels_sql() -> str:
    return r"""SELECT p_partkey,
  replace(trim(regexp_replace(concat_ws(' ', p_brand, p_type), '[^\w\s-]', '', 'g')), ' ', '_')
    AS safe_label,
  CASE WHEN length(p_name) > 8 THEN substr(p_name, 1, 8) || '...' ELSE p_name END AS short_label
FROM part"""


def series_totals_sql() -> str:
    return f"""WITH {_ts('M')},
t AS (SELECT series, sum(value) AS total FROM ts WHERE series <> 'total_demand' GROUP BY series),
r AS (SELECT series, total, CAST(row_number() OVER (ORDER BY total DESC, series ASC) AS INTEGER) AS rank
      FROM t)
SELECT * FROM r WHERE rank <= 10"""


# --- evaluation on closed-form models ------------------------------------------------

def _naive_ctes(freq: str = "M") -> str:
    return f"""{_ts(freq)},
sp AS (
  SELECT series, period, value AS y,
    coalesce(lag(value, 1) OVER (PARTITION BY series ORDER BY period), 0.0) AS lag_1,
    coalesce(lag(value, 12) OVER (PARTITION BY series ORDER BY period), 0.0) AS lag_12,
    row_number() OVER (PARTITION BY series ORDER BY period) AS pos,
    count(*) OVER (PARTITION BY series) AS n
  FROM ts),
pred AS (
  SELECT series, period, y, 'last_value' AS model, lag_1 AS y_hat FROM sp WHERE pos > floor(n * 0.8)
  UNION ALL
  SELECT series, period, y, 'seasonal_naive' AS model, lag_12 AS y_hat FROM sp WHERE pos > floor(n * 0.8)),
dev AS (SELECT *, y - y_hat AS e, y - avg(y) OVER (PARTITION BY series, model) AS d FROM pred),
met AS (
  SELECT series, model, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
         1 - sum(e * e) / nullif(sum(d * d), 0) AS r2
  FROM dev GROUP BY series, model),
best AS (
  SELECT series, CASE WHEN max(CASE WHEN model = 'last_value' THEN rmse END)
                        < max(CASE WHEN model = 'seasonal_naive' THEN rmse END)
                      THEN 'last_value' ELSE 'seasonal_naive' END AS best_model
  FROM met GROUP BY series)"""


def metrics_naive_sql() -> str:
    return f"""WITH {_naive_ctes()}
SELECT series, model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2 FROM met"""


def best_naive_sql() -> str:
    return f"WITH {_naive_ctes()}\nSELECT series, best_model FROM best"


def mean_metrics_naive_sql() -> str:
    return f"""WITH {_naive_ctes()}
SELECT model, round(avg(mae), 6) AS mean_mae, round(avg(rmse), 6) AS mean_rmse,
       round(avg(r2), 6) AS mean_r2 FROM met GROUP BY model"""


def win_counts_naive_sql() -> str:
    return f"""WITH {_naive_ctes()}
SELECT best_model, count(*) AS wins, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct
FROM best GROUP BY best_model"""


def model_compare_naive_sql() -> str:
    return f"""WITH {_naive_ctes()}
SELECT series, round(a, 6) AS rmse_last, round(b, 6) AS rmse_seasonal, round(a - b, 6) AS rmse_diff
FROM (SELECT series, max(CASE WHEN model = 'last_value' THEN rmse END) AS a,
             max(CASE WHEN model = 'seasonal_naive' THEN rmse END) AS b FROM met GROUP BY series)"""


def _recursive_ctes(freq: str = "M", horizon: int = 6) -> str:
    """ML-09 with the closed-form model ``ma_3`` (mean of the last two values, Q7)."""
    step = {"M": "to_months(s.step + 1)", "W": "to_days(7 * (s.step + 1))",
            "2W": "to_days(14 * (s.step + 1))"}[freq]
    nxt = "greatest(0.0, round_even((s.h[-1] + s.h[-2]) / 2.0, 0))"
    return f"""{_ts(freq)},
hist AS (
  SELECT series, list(value ORDER BY period) AS h, max(period) AS last_period FROM (
    SELECT *, row_number() OVER (PARTITION BY series ORDER BY period DESC) AS rn FROM ts)
  WHERE rn <= 24 GROUP BY series),
rec(series, step, h, last_period, period, forecast) AS (
  SELECT series, 0, h, last_period, CAST(NULL AS DATE), CAST(NULL AS DOUBLE) FROM hist
  UNION ALL
  SELECT s.series, s.step + 1, list_append(s.h, {nxt}), s.last_period,
         CAST(s.last_period + {step} AS DATE), {nxt}
  FROM rec s WHERE s.step < {horizon}),
fc AS (SELECT series, CAST(step AS INTEGER) AS step, period, forecast FROM rec WHERE step > 0)"""


def recursive_naive_sql() -> str:
    return f"WITH RECURSIVE {_recursive_ctes()}\nSELECT series, step, period, forecast FROM fc"


def forecast_pivot_naive_sql() -> str:
    names = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "total_demand")
    cols = ", ".join(f"first(forecast) FILTER (WHERE series = '{n}') AS \"{n}\"" for n in names)
    return f"""WITH RECURSIVE {_recursive_ctes()}
SELECT period, {cols} FROM fc GROUP BY period"""


def forecast_summary_naive_sql() -> str:
    return f"""WITH RECURSIVE {_recursive_ctes()}
SELECT series, min(period) AS first_period, max(period) AS last_period,
       arg_min(forecast, step) AS first_forecast, arg_max(forecast, step) AS last_forecast,
       round(avg(forecast), 6) AS mean_forecast, min(forecast) AS min_forecast, max(forecast) AS max_forecast,
       count(*) AS horizon, count(*) OVER () AS n_targets
FROM fc GROUP BY series"""


def best_config_naive_sql() -> str:
    parts = []
    for i, f in enumerate(("W", "2W", "M")):
        body = _naive_ctes(f)
        parts.append(f"""SELECT {i} AS config_id, '{f}' AS freq, best_r2 FROM (
  WITH {body}
  SELECT max(r2) AS best_r2 FROM met WHERE series = 'total_demand')""")
    union = "\nUNION ALL\n".join(parts)
    return f"""SELECT config_id, freq, round(best_r2, 6) AS best_r2,
  row_number() OVER (ORDER BY best_r2 DESC NULLS LAST, config_id) = 1 AS is_best
FROM ({union})"""


def date_parts_sql() -> str:
    ts = ts_sql("CASE WHEN date_creation_mistake = '1' THEN NULL ELSE date_creation END")
    return f"""WITH {RAW_CTE}
SELECT vacancy_id, d AS date_creation_processed,
  CAST(year(d) AS INTEGER) AS date_creation_year, CAST(month(d) AS INTEGER) AS date_creation_month,
  CAST(quarter(d) AS INTEGER) AS date_creation_quarter,
  CAST(isodow(d) - 1 AS INTEGER) AS date_creation_day_of_week,
  CAST(dayofyear(d) AS INTEGER) AS date_creation_day_of_year
FROM (SELECT vacancy_id, {ts} AS d FROM raw)"""


def anomaly_counts_sql(freq: str = "M") -> str:
    return f"""WITH {_ts(freq)},{FLAGS_CTE}
SELECT series, CAST(count_if(is_anomaly) AS BIGINT) AS anomalies,
       CAST(count_if(rule_z) AS BIGINT) AS z_hits,
       CAST(count_if(rule_extreme) AS BIGINT) AS extreme_hits,
       CAST(count_if(rule_high) AS BIGINT) AS high_hits,
       CAST(count_if(rule_jump) AS BIGINT) AS jump_hits
FROM flagged GROUP BY series"""


def summary_naive_sql() -> str:
    """SNK-06 with the closed-form models (see ``snk06_summary_naive``)."""
    cfg = best_config_naive_sql()
    agg = []
    for m, p in (("last_value", "last"), ("seasonal_naive", "seasonal")):
        agg += [f"(SELECT round(avg(mae), 6) FROM met WHERE model = '{m}') AS {p}_mean_mae",
                f"(SELECT round(avg(rmse), 6) FROM met WHERE model = '{m}') AS {p}_mean_rmse",
                f"(SELECT round(avg(r2), 6) FROM met WHERE model = '{m}') AS {p}_mean_r2"]
    wins = ("(SELECT CAST(count_if(best_model = 'last_value') AS INTEGER) FROM best) AS last_wins, "
            "(SELECT CAST(count_if(best_model = 'seasonal_naive') AS INTEGER) FROM best) "
            "AS seasonal_wins")
    config_text = """'{"freq": "' || freq || '", "outlier_removal": false}'"""
    return f"""WITH {_naive_ctes('M')},
cfg AS ({cfg}),
r AS (
  SELECT
    (SELECT strftime(min(period), '%Y-%m') FROM ts) AS first_period,
    (SELECT strftime(max(period), '%Y-%m') FROM ts) AS last_period,
    (SELECT count(*) FROM spans) AS vacancies,
    (SELECT CAST(least(10, count(DISTINCT series)) AS INTEGER) FROM ts
      WHERE series <> 'total_demand') AS series_analysed,
    (SELECT {config_text} FROM cfg WHERE is_best) AS best_config,
    (SELECT best_r2 FROM cfg WHERE is_best) AS best_r2,
    {', '.join(agg)},
    {wins},
    6 AS horizon)
SELECT first_period, last_period, vacancies, series_analysed, best_config, best_r2,
  last_mean_mae, last_mean_rmse, last_mean_r2, seasonal_mean_mae, seasonal_mean_rmse,
  seasonal_mean_r2, last_wins, seasonal_wins,
  round(CASE WHEN last_wins + seasonal_wins > 0
        THEN last_wins * 100.0 / (last_wins + seasonal_wins) ELSE 0 END, 6) AS last_share_pct,
  round(CASE WHEN last_wins + seasonal_wins > 0
        THEN seasonal_wins * 100.0 / (last_wins + seasonal_wins) ELSE 0 END, 6)
    AS seasonal_share_pct,
  CASE WHEN last_mean_rmse < seasonal_mean_rmse THEN 'last_value' ELSE 'seasonal_naive' END
    AS overall_best,
  CAST(horizon AS INTEGER) AS horizon
FROM r"""


def repair_sequential_sql(freq: str = "M", window: int = 8) -> str:
    """TS-05 faithful: a recursive CTE repairs the anomalies of each series one
    at a time, in time order, each step reading the values left by the
    previous steps."""
    s = "list_sort(nb)"
    mean = "(list_sum(nb) / len(nb))"
    total_fix = (f"CASE WHEN orig > 80000.0 THEN greatest({_qsorted(s, 0.75)}, orig * 0.6) "
                 f"ELSE {mean} END")
    other_fix = (f"CASE WHEN orig > {_qsorted(s, 0.9)} THEN {_qsorted(s, 0.9)} "
                 f"ELSE {_qsorted(s, 0.25)} END")
    fixed = f"CASE WHEN sname = 'total_demand' THEN {total_fix} ELSE {other_fix} END"
    return f"""WITH RECURSIVE {_ts(freq)},{FLAGS_CTE},
pos AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY period) AS p FROM flagged),
per AS (
  SELECT series, list(value ORDER BY period) AS vals0,
         coalesce(list(p ORDER BY p) FILTER (WHERE is_anomaly), []) AS anos
  FROM pos GROUP BY series),
rec(series, k, vals, anos) AS (
  SELECT series, 0, vals0, anos FROM per
  UNION ALL
  SELECT r.series, r.k + 1,
         list_transform(r.vals, lambda v, j: CASE WHEN j = q.i THEN q.fixed ELSE v END),
         r.anos
  FROM rec r, LATERAL (
    SELECT i, CASE WHEN len(nb) = 0 THEN orig
                   ELSE greatest(0.0, CAST(trunc({fixed}) AS DOUBLE)) END AS fixed
    FROM (SELECT i, sname, r.vals[i] AS orig,
                 list_concat(r.vals[greatest(1, i - {window}):i - 1],
                             r.vals[i + 1:least(len(r.vals), i + {window})]) AS nb
          FROM (SELECT r.anos[r.k + 1] AS i, r.series AS sname))) q
  WHERE r.k < len(r.anos)),
final AS (SELECT series, vals FROM rec WHERE k = len(anos))
SELECT p.series, p.period, p.value, p.is_anomaly, f.vals[p.p] AS fixed
FROM pos p JOIN final f ON p.series = f.series"""
