"""SQL fragments of the oracles, written independently of the DataFrame code."""

from __future__ import annotations

# Measurements and attributes of the 48-hour reports.
EVENTS = """pts AS (
  SELECT epoch_ms(date_trunc('hour', ts)) AS time_stamp, event_type AS application,
         's' || (user_id % 4) AS source, CAST(user_id AS VARCHAR) AS target_address,
         user_id % 25 AS target_attribute_id, value AS app_rsp_time,
         CAST(floor(value * 1000) AS BIGINT) AS byte_count,
         CAST(floor(value) AS BIGINT) AS flow_count,
         CAST(floor(value * 600) AS BIGINT) AS rx_byte_count,
         CAST(floor(value / 2) AS BIGINT) AS rx_flow_count, value / 4 AS tcp_rsp_time,
         CAST(floor(value * 400) AS BIGINT) AS tx_byte_count,
         CAST(floor(value / 3) AS BIGINT) AS tx_flow_count
  FROM events),
attrs AS (SELECT n_nationkey AS attribute_id, n_name AS location FROM nation)"""

# Measurements and attributes of the 30-day reports.
ORDERS = """pts AS (
  SELECT epoch_ms(l_shipdate) + l_linenumber * 3600000 AS time_stamp, l_returnflag AS application,
         's' || (l_suppkey % 4) AS source, CAST(l_orderkey AS VARCHAR) AS target_address,
         l_suppkey AS target_attribute_id, l_discount AS app_rsp_time,
         CAST(floor(l_extendedprice) AS BIGINT) AS byte_count,
         CAST(floor(l_quantity) AS BIGINT) AS flow_count,
         CAST(floor(l_extendedprice / 2) AS BIGINT) AS rx_byte_count,
         CAST(l_linenumber AS BIGINT) AS rx_flow_count, l_tax AS tcp_rsp_time,
         CAST(floor(l_extendedprice / 4) AS BIGINT) AS tx_byte_count,
         CAST(floor(l_quantity / 2) AS BIGINT) AS tx_flow_count
  FROM lineitem),
attrs AS (SELECT s_suppkey AS attribute_id, r_name AS location
          FROM supplier JOIN nation ON s_nationkey = n_nationkey
                        JOIN region ON n_regionkey = r_regionkey)"""

POINTS = {"48h": EVENTS, "30d": ORDERS}
APPS = {"48h": "'click', 'purchase', 'signup', 'view'", "30d": "'A', 'R'"}

KEYS = {
    "p1": ["application", "source"],
    "p2": ["source"],
    "p3": ["application", "source"],
    "p6": ["location"],
    "p7": ["location"],
    "p8": ["source"],
    "p9": ["source"],
    "p10": ["application", "source"],
}
VALUE = {
    "p1": "app_rsp_time",
    "p2": "app_count",
    "p3": "user_count",
    "p6": "user_count",
    "p7": "bw",
    "p8": "user_count",
    "p9": "bw",
    "p10": "bw",
}
RULE = {"p1": 0.75, "p6": 0.75, "p7": 0.5, "p9": 0.5, "p10": 0.75}
GATE = {"30d": 61, "48h": 90}
DELAY = {"30d": 30, "48h": 48}
UNIT = {"30d": "day", "48h": "hour"}
SEASON = {"30d": "isodow({0}) - 1", "48h": "hour({0})"}

_JOINED = "pts LEFT JOIN attrs ON target_attribute_id = attribute_id"
_CLEAN = "app_rsp_time <> 0 AND byte_count <> 0"


def hourly(report: str, horizon: str, where: str = "TRUE") -> str:
    """SELECT of a report's hourly series over `pts` and `attrs`; `where` restricts the points."""
    keys = ", ".join(KEYS[report])
    allowed = f"application IN ({APPS[horizon]})"
    by, table, having, rows = f"{keys}, time_stamp", "pts", "TRUE", allowed
    if report == "p1":
        value = "avg(app_rsp_time) AS app_rsp_time"
        having = "avg(app_rsp_time) <> 0"
    elif report == "p2":
        value, rows = "count(DISTINCT application) AS app_count", "TRUE"
    elif report in ("p3", "p6", "p8"):
        value = "count(DISTINCT target_address) AS user_count"
    else:
        value = "CAST(sum(byte_count) AS BIGINT) AS byte_count_sum, sum(byte_count) / (8 * 3600) AS bw"
        having, rows = "sum(byte_count) <> 0", f"{allowed} AND {_CLEAN}"
    if report in ("p6", "p7"):
        table = _JOINED
    return f"SELECT {by}, {value} FROM {table} WHERE {rows} AND {where} GROUP BY {by} HAVING {having}"


def data(report: str, horizon: str, where: str = "TRUE") -> str:
    """SELECT of the data table: keys, date, value."""
    keys, value = ", ".join(KEYS[report]), VALUE[report]
    known = " AND ".join(f"{k} IS NOT NULL" for k in KEYS[report])
    if horizon == "30d":
        return (
            f"SELECT {keys}, CAST(epoch_ms(time_stamp) AS DATE) AS date, max({value}) AS {value}"
            f" FROM ({hourly(report, horizon, where)}) WHERE {known} GROUP BY {keys}, date"
        )
    return (
        f"SELECT {keys}, epoch_ms(time_stamp) AS date, {value}"
        f" FROM ({hourly(report, horizon, where)}) WHERE {known}"
        f" QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY time_stamp DESC) <= 90"
    )


def outlier(table: str, keys: str, q: float | None, cap: bool = False) -> str:
    """SELECT of a (keys, ds, y, ...) table with the outlier rule applied to y."""
    if q is None:
        return f"SELECT * FROM {table}"
    becomes = f"2 * {q_name(q)}" if cap else "NULL"
    return (
        f"SELECT t.* REPLACE (CASE WHEN top - q50 >= 2 * {q_name(q)} AND y >= 2 * {q_name(q)}"
        f" THEN {becomes} ELSE y END AS y) FROM {table} AS t JOIN"
        f" (SELECT {keys}, quantile_cont(y, 0.5) AS q50, quantile_cont(y, 0.75) AS q75,"
        f" max(y) AS top FROM {table} GROUP BY {keys}) USING ({keys})"
    )


def q_name(q: float) -> str:
    return {0.5: "q50", 0.75: "q75"}[q]


def trend_chain(
    report: str, horizon: str, tag: str = "", where: str = "TRUE", rule="own", cap: bool = False
) -> str:
    """CTEs data, series, ahead (forecast), held, valid of the trend model, with names tagged."""
    keys = ", ".join(KEYS[report])
    q = RULE.get(report) if rule == "own" else rule
    gate, delay = GATE[horizon], DELAY[horizon]

    def model(name: str, source: str) -> str:
        season, unit = SEASON[horizon], UNIT[horizon]
        return f"""
{name}_in{tag} AS ({outlier(source + tag, keys, q, cap)}),
{name}_last{tag} AS (SELECT {keys}, max(ds) AS t0 FROM {source}{tag} GROUP BY {keys}),
{name}_x{tag} AS (SELECT i.*, t0, date_diff('{unit}', t0, ds) AS x
                  FROM {name}_in{tag} AS i JOIN {name}_last{tag} USING ({keys})),
{name}_fit{tag} AS (SELECT {keys}, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
                    FROM {name}_x{tag} GROUP BY {keys}),
{name}_eff{tag} AS (SELECT {keys}, {season.format("ds")} AS season, avg(y - a - b * x) AS e
                    FROM {name}_x{tag} JOIN {name}_fit{tag} USING ({keys}) GROUP BY {keys}, season),
{name}_cal{tag} AS (SELECT {keys}, t0 + to_{unit}s(CAST(h AS INTEGER)) AS ds, h AS x
                    FROM {name}_last{tag}, range(1, {delay + 1}) AS r(h)),
{name}{tag} AS (SELECT {keys}, ds, a + b * x + coalesce(e, 0) AS yhat
                FROM (SELECT *, {season.format("ds")} AS season FROM {name}_cal{tag})
                JOIN {name}_fit{tag} USING ({keys})
                LEFT JOIN {name}_eff{tag} USING ({keys}, season))"""

    return f"""data{tag} AS ({data(report, horizon, where)}),
series{tag} AS (
  SELECT * FROM (
    SELECT {keys}, CAST(date AS TIMESTAMP) AS ds, CAST({VALUE[report]} AS DOUBLE) AS y,
           row_number() OVER (PARTITION BY {keys} ORDER BY date DESC) AS rn,
           count(*) OVER (PARTITION BY {keys}) AS n FROM data{tag})
  WHERE n >= {gate}),
train{tag} AS (SELECT * FROM series{tag} WHERE rn > {delay}),{model("ahead", "series")},{model("held", "train")},
valid{tag} AS (
  SELECT {keys}, ds, y, yhat, y - yhat AS error_test, abs((y - yhat) * 100 / nullif(y, 0)) AS "APE"
  FROM held{tag} JOIN (SELECT * FROM series{tag} WHERE rn <= {delay}) USING ({keys}, ds)
  WHERE y IS NOT NULL AND yhat IS NOT NULL)"""


def metrics(valid: str, keys: str) -> str:
    """SELECT of the error metrics of a validation table."""
    return f"""SELECT {keys}, sqrt(avg(error_test * error_test)) AS test_rmse, avg("APE") AS test_mape,
       stddev_pop("APE") AS std_mape, min("APE") / 100 AS min_error_rate,
       max("APE") / 100 AS max_error_rate, quantile_cont("APE", 0.5) / 100 AS median_error_rate,
       avg("APE") FILTER (WHERE "APE" < p98) AS test_mape_98
FROM (SELECT *, quantile_cont("APE", 0.98) OVER (PARTITION BY {keys}) AS p98 FROM {valid})
GROUP BY {keys}"""


def analysis(report: str, tag: str = "") -> str:
    keys = ", ".join(KEYS[report])
    return (
        f"SELECT m.*, length FROM ({metrics('valid' + tag, keys)}) AS m JOIN"
        f" (SELECT {keys}, max(n) AS length FROM series{tag} GROUP BY {keys}) USING ({keys})"
    )


def describe(table: str, keys: str, columns: list[str]) -> str:
    """SELECT of count, mean, std, min, quartiles and max per column."""
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    parts = [
        f"SELECT {lead}'{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean,"
        f" stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min,"
        f" quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,"
        f" quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM {table} {group}"
        for c in columns
    ]
    return " UNION ALL ".join(parts)
