"""The run-off data model over the driver's tables: each view as a DataFrame and as SQL with the same rows.

Orders stand for balance snapshots of their customers, market segments for product books, line items by ship month for
macro series and events for ticks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import features, macro, panel

FLOOR = 30.0
NAMES = ["money_market", "cpi", "cpi_yoy", "oil_brent", "usd_dzd"]
LAGS = {"cpi": 1, "cpi_yoy": 1}
START, END = 1995 * 12, 2001 * 12 + 11
CUTOFF, HORIZON = 1997 * 12, 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    month = C.month_of(F.col("o_orderdate"))
    opened = F.when(F.col("o_custkey") % 7 == 0, month + 2).otherwise(month - F.col("o_custkey") % 30)
    return rows.select(
        F.col("o_custkey").cast("string").alias("account_id"), month.alias("month_int"), (F.col("o_totalprice") / 1000).alias("ctrvl_kda"),
        F.col("c_mktsegment").alias("segment"), opened.cast("int").alias("open_month"), F.col("o_orderstatus").alias("type_compte"),
    )


SNAPSHOTS = """snapshots AS (
    SELECT CAST(o_custkey AS VARCHAR) AS account_id, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INT) AS month_int, o_totalprice / 1000 AS ctrvl_kda,
        c_mktsegment AS segment, o_orderstatus AS type_compte,
        CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 + CASE WHEN o_custkey % 7 = 0 THEN 2 ELSE -(o_custkey % 30) END AS INT) AS open_month
    FROM orders JOIN customer ON o_custkey = c_custkey)"""

ACCOUNTS = f"""{SNAPSHOTS}, monthly AS (
    SELECT account_id, month_int, sum(coalesce(ctrvl_kda, 0)) AS balance_kda, min(segment) AS segment, min(open_month) AS open_month
    FROM snapshots GROUP BY account_id, month_int
), bounds AS (SELECT min(month_int) AS panel_start, max(month_int) AS panel_end FROM monthly), acct0 AS (
    SELECT account_id, min(month_int) AS first_seen, max(month_int) AS last_seen, coalesce(min(open_month), min(month_int)) AS known_open,
        arg_min(segment, month_int) AS segment, min(CASE WHEN balance_kda < {FLOOR} THEN month_int END) AS floor_mi
    FROM monthly GROUP BY account_id
), acct1 AS (
    SELECT *, CASE WHEN last_seen < panel_end THEN last_seen END AS close_mi FROM acct0, bounds
), acct AS (
    SELECT *, CASE WHEN floor_mi IS NULL THEN close_mi WHEN close_mi IS NULL THEN floor_mi ELSE least(floor_mi, close_mi) END AS event_mi,
        least(known_open, first_seen) AS open_mi FROM acct1
)"""

PANEL = f"""{ACCOUNTS}, spells AS (
    SELECT m.account_id, m.month_int AS mi, m.balance_kda, a.segment, a.event_mi, a.open_mi, coalesce(a.event_mi, a.last_seen) AS end_mi,
        lead(m.month_int) OVER (PARTITION BY m.account_id ORDER BY m.month_int) AS nxt
    FROM monthly m JOIN acct a ON m.account_id = a.account_id
), filled AS (
    SELECT *, unnest(generate_series(mi, least(coalesce(nxt - 1, end_mi), end_mi))) AS month_int FROM spells WHERE mi <= end_mi
), panel AS (
    SELECT account_id, CAST(month_int AS INT) AS month_int, CAST(month_int // 12 AS INT) AS year, CAST(month_int % 12 + 1 AS INT) AS month,
        CASE WHEN month_int = event_mi THEN 1 ELSE 0 END AS event, CAST(month_int - open_mi AS INT) AS seasoning, ln(1 + greatest(balance_kda, 0)) AS log_balance,
        balance_kda, segment
    FROM filled
)"""


def account_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.build(records(spark, sf_dir), FLOOR)


def macro_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series, month_int, value) of money_market, cpi, oil_brent, usd_dzd and cpi_yoy."""
    items = table(spark, sf_dir, "lineitem").groupBy(C.month_of(F.col("l_shipdate")).alias("month_int")).agg(
        (F.avg("l_discount") * 100).alias("money_market"), F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("cpi"),
        F.avg(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("oil_brent"), (F.avg("l_tax") * 1000).alias("usd_dzd"),
    )
    long = items.unpivot(["month_int"], ["money_market", "cpi", "oil_brent", "usd_dzd"], "series", "value").select("series", "month_int", "value")
    return long.unionByName(macro.year_on_year(long, "cpi", "cpi_yoy"))


MACRO = """macro_month AS (
    SELECT CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INT) AS month_int, avg(l_discount) * 100 AS money_market, avg(l_extendedprice / l_quantity) AS cpi,
        avg(l_extendedprice * (1 - l_discount)) AS oil_brent, avg(l_tax) * 1000 AS usd_dzd
    FROM lineitem GROUP BY 1
), yoy AS (
    SELECT a.month_int, round(a.cpi / b.cpi - 1, 6) AS cpi_yoy FROM macro_month a JOIN macro_month b ON a.month_int = b.month_int + 12
), macro_long AS (
    SELECT 'money_market' AS series, month_int, money_market AS value FROM macro_month UNION ALL SELECT 'cpi', month_int, cpi FROM macro_month
    UNION ALL SELECT 'oil_brent', month_int, oil_brent FROM macro_month UNION ALL SELECT 'usd_dzd', month_int, usd_dzd FROM macro_month
    UNION ALL SELECT 'cpi_yoy', month_int, cpi_yoy FROM yoy
)"""

PIT = f"""{MACRO}, pit AS (
    SELECT CAST(s.m AS INT) AS month_int, a.money_market, c.cpi, y.cpi_yoy, a.oil_brent, a.usd_dzd
    FROM (SELECT unnest(generate_series({START}, {END})) AS m) s LEFT JOIN macro_month a ON a.month_int = s.m
        LEFT JOIN macro_month c ON c.month_int = s.m - 1 LEFT JOIN yoy y ON y.month_int = s.m - 1
)"""


def point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return macro.lagged(macro_long(spark, sf_dir), LAGS, NAMES, START, END)


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with macro columns and w, without rows that lack a model feature."""
    rows = account_panel(spark, sf_dir).join(F.broadcast(point_in_time(spark, sf_dir)), "month_int", "left")
    return rows.na.drop(subset=["seasoning", "log_balance", "cpi_yoy", "money_market", "oil_brent"]).withColumn("w", F.coalesce("balance_kda", F.lit(1.0)))


MODEL = f"""{PANEL}, {PIT}, model_rows AS (
    SELECT p.*, t.money_market, t.cpi_yoy, t.oil_brent, t.usd_dzd, p.balance_kda AS w FROM panel p JOIN pit t ON p.month_int = t.month_int
    WHERE t.cpi_yoy IS NOT NULL AND t.money_market IS NOT NULL AND t.oil_brent IS NOT NULL
)"""

#: A hazard and an erosion with fixed coefficients, for queries that only score.
HAZARD, HAZARD_B0 = {"seasoning": -0.01, "log_balance": -0.3, "money_market": 0.1}, -1.5
EROSION, EROSION_B0 = {"money_market": -0.001, "seasoning": 0.0001}, -0.002

HAZARD_SQL = "(1 / (1 + exp(-(-1.5 - 0.01 * seasoning - 0.3 * log_balance + 0.1 * money_market))))"


def hazard():
    return C.sigmoid(F.lit(HAZARD_B0) + sum(F.col(k) * v for k, v in HAZARD.items()))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model rows as predicted p and outcome y, with the row's key."""
    key = F.concat_ws("|", "account_id", F.col("month_int").cast("string"))
    return model_rows(spark, sf_dir).select("segment", key.alias("key"), "account_id", "month_int", hazard().alias("p"), F.col("event").alias("y"), "w")


SCORED = f"""{MODEL}, scored AS (
    SELECT segment, account_id || '|' || CAST(month_int AS VARCHAR) AS key, account_id, month_int, {HAZARD_SQL} AS p, event AS y, w FROM model_rows
)"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id, t, x): the macro series by month."""
    return macro_long(spark, sf_dir).select(F.col("series").alias("series_id"), F.col("month_int").cast("long").alias("t"), F.col("value").alias("x"))


SERIES = f"{MACRO}, s AS (SELECT series AS series_id, CAST(month_int AS BIGINT) AS t, value AS x FROM macro_long)"


def user_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id, t, x): each user's event values in order."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    events = table(spark, sf_dir, "events").where("user_id is not null and value is not null")
    return events.select(F.col("user_id").cast("string").alias("series_id"), F.row_number().over(w).cast("long").alias("t"), F.col("value").alias("x"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("user_id", "ts", F.to_date("ts").alias("day"), (F.col("value") + 1).alias("value"), F.col("event_id").alias("tie")).where("value > 0")


TICKS = "ticks AS (SELECT user_id, ts, CAST(ts AS DATE) AS day, value + 1 AS value, event_id AS tie FROM events WHERE value + 1 > 0)"


def curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(segment, h, B, b0): the realized run-off of the cohort at the cutoff."""
    rows = account_panel(spark, sf_dir)
    real = panel.realized(rows, CUTOFF, HORIZON)
    base = rows.where(F.col("month_int") == CUTOFF).groupBy("segment").agg(F.sum("balance_kda").alias("b0"))
    return real.join(F.broadcast(base), "segment").select("segment", "h", F.col("realized").alias("B"), "b0")  # a row a segment


CURVES = f"""{PANEL}, cohort AS (SELECT account_id, segment, balance_kda AS b0 FROM panel WHERE month_int = {CUTOFF}),
base AS (SELECT segment, sum(b0) AS b0 FROM cohort GROUP BY segment), kept AS (
    SELECT c.segment, p.month_int - {CUTOFF} AS h, sum(p.balance_kda) AS kept FROM cohort c JOIN panel p ON c.account_id = p.account_id
    WHERE p.month_int BETWEEN {CUTOFF} AND {CUTOFF + HORIZON} GROUP BY 1, 2
), curves AS (
    SELECT b.segment, CAST(g.h AS INT) AS h, coalesce(k.kept, 0) / b.b0 AS B, b.b0
    FROM base b CROSS JOIN (SELECT unnest(generate_series(0, {HORIZON})) AS h) g LEFT JOIN kept k ON k.segment = b.segment AND k.h = g.h
)"""


def with_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.path(account_panel(spark, sf_dir))
