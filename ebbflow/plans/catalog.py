"""Registered queries over the adapter views, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import features, macro, panel, rates, runoff, series, uncertainty, validate
from ..sources import dumps, payloads
from ..streaming import live, rolling
from . import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- panel -----------------------------------------------------------------------------------------------------


@query(f"WITH {V.ACCOUNTS} SELECT account_id, month_int, round(balance_kda, 6) AS balance_kda, segment, open_month FROM monthly")
def ag1_monthly_balances(spark, d):
    return rounded(panel.monthly(V.records(spark, d)))


@query(f"WITH {V.ACCOUNTS} SELECT min(month_int) AS panel_start, max(month_int) AS panel_end, CAST(count(DISTINCT account_id) AS BIGINT) AS n_accounts FROM monthly")
def ag2_panel_bounds(spark, d):
    return V.records(spark, d).agg(F.min("month_int").alias("panel_start"), F.max("month_int").alias("panel_end"), F.countDistinct("account_id").alias("n_accounts"))


@query(
    f"""WITH {V.ACCOUNTS} SELECT account_id, first_seen, last_seen, open_mi, event_mi, segment,
        CASE WHEN event_mi IS NULL THEN 'censored' WHEN event_mi = floor_mi THEN 'floor' ELSE 'closure' END AS event_kind,
        CAST(known_open > first_seen AS INT) AS bad_open, CAST(open_mi < panel_start AS INT) AS left_truncated FROM acct"""
)
def ag3_account_summary(spark, d):
    rows = panel.accounts(panel.monthly(V.records(spark, d)), V.FLOOR).where("month_int = first_seen")
    return rows.select("account_id", "first_seen", "last_seen", "open_mi", "event_mi", "segment", "event_kind", "bad_open", "left_truncated")


@query(
    f"""WITH {V.ACCOUNTS} SELECT segment, count(*) AS n_accounts, CAST(sum(coalesce(event_mi, last_seen) - first_seen + 1) AS BIGINT) AS n_person_months,
        CAST(count(*) FILTER (WHERE event_mi = floor_mi) AS BIGINT) AS events_floor, CAST(count(*) FILTER (WHERE event_mi IS NOT NULL AND event_mi IS DISTINCT FROM floor_mi) AS BIGINT) AS events_closure,
        count(*) FILTER (WHERE event_mi IS NULL) AS censored, CAST(sum(CAST(open_mi < panel_start AS INT)) AS BIGINT) AS left_truncated,
        CAST(sum(CAST(known_open > first_seen AS INT)) AS BIGINT) AS bad_open FROM acct GROUP BY ROLLUP (segment)"""
)
def ag4_panel_summary(spark, d):
    return panel.summary(V.records(spark, d), V.FLOOR)


@query(f"WITH {V.PANEL} SELECT account_id, month_int, year, month, event, seasoning, round(log_balance, 6) AS log_balance, round(balance_kda, 6) AS balance_kda, segment FROM panel")
def wn1_panel(spark, d):
    return rounded(V.account_panel(spark, d).drop("cal_month"))


def _shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, on a local master alone, one of this machine."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: it names the folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='ebbflow-')}"
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(ORACLE_SQL["wn1_panel"])
def str1_incremental_panel(spark, d):
    """The records in three batches: the early months without those of some accounts, the later ones, then those accounts' early months."""
    rows, store = V.records(spark, d), _shared_path(spark, "rolling")
    early, late = F.col("month_int") < V.CUTOFF, F.pmod(F.xxhash64("account_id"), F.lit(50)) == 0
    for k, batch in enumerate((early & ~late, ~early, early & late)):
        rolling.merge(rows.where(batch), store, k, V.FLOOR)
    return rounded(rolling.current(spark, store).drop("cal_month"))


@query(f"WITH {V.PANEL} SELECT p.account_id, p.month_int, p.event FROM panel p JOIN monthly m ON p.account_id = m.account_id AND p.month_int = m.month_int")
def wn1_panel_without_gaps(spark, d):
    return panel.build(V.records(spark, d), V.FLOOR, carry_gaps=False).select("account_id", "month_int", "event")


@query(f"WITH {V.PANEL}, {V.PIT} SELECT p.account_id, p.month_int, round(t.money_market, 6) AS money_market, round(t.cpi_yoy, 6) AS cpi_yoy FROM panel p LEFT JOIN pit t ON p.month_int = t.month_int")
def jn1_panel_macro(spark, d):
    rows = panel.build(V.records(spark, d), V.FLOOR, pit=V.point_in_time(spark, d))
    return rounded(rows.select("account_id", "month_int", "money_market", "cpi_yoy"))


@query(f"WITH {V.CURVES} SELECT segment, h, round(B, 6) AS realized FROM curves")
def ro6_cohort_realized(spark, d):
    return rounded(panel.realized(V.account_panel(spark, d), V.CUTOFF, V.HORIZON))


@query(f"WITH {V.PANEL} SELECT account_id, segment, round(balance_kda, 6) AS balance_kda FROM panel WHERE event = 0 AND month_int = (SELECT max(month_int) FROM panel)")
def flt4_alive(spark, d):
    return rounded(panel.alive(V.account_panel(spark, d)).select("account_id", "segment", "balance_kda"))


@query(
    f"""WITH {V.PANEL} SELECT segment, count(*) AS n_rows, count(DISTINCT month_int) AS n_months,
        CASE WHEN count(DISTINCT month_int) < 60 THEN 'too few months' WHEN segment = 'MACHINERY' THEN 'not behavioral' WHEN count(*) < 200 THEN 'too few rows' END AS skipped
    FROM panel GROUP BY segment"""
)
def flt3_behavioral(spark, d):
    known = spark.createDataFrame([(s, s != "MACHINERY") for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")], "segment string, behavioral boolean")
    return panel.behavioral(V.account_panel(spark, d), known, 200, 60)


@query(f"WITH {V.PANEL} SELECT month_int, round(sum(balance_kda), 6) AS total FROM panel GROUP BY month_int")
def ag9_book_totals(spark, d):
    return rounded(V.account_panel(spark, d).groupBy("month_int").agg(F.sum("balance_kda").alias("total")))


@query(f"WITH {V.MODEL} SELECT segment, month_int, round(ln(greatest(sum(balance_kda), 1e-9)), 6) AS logbal, round(avg(money_market), 6) AS rate, round(avg(cpi_yoy), 6) AS infl FROM model_rows GROUP BY 1, 2")
def ag10_book_months(spark, d):
    from ..operators import models

    return rounded(models.book_months(V.model_rows(spark, d)))


# --- macro -----------------------------------------------------------------------------------------------------


@query(f"WITH {V.MACRO} SELECT month_int, cpi_yoy AS value FROM yoy")
def prj2_year_on_year(spark, d):
    return macro.year_on_year(V.macro_long(spark, d).where("series = 'cpi'"), "cpi", "cpi_yoy").select("month_int", "value")


@query(f"WITH {V.PIT} SELECT month_int, round(money_market, 6) AS money_market, round(cpi, 4) AS cpi, cpi_yoy, round(oil_brent, 4) AS oil_brent, round(usd_dzd, 6) AS usd_dzd FROM pit")
def jn2_point_in_time(spark, d):
    t = V.point_in_time(spark, d)
    return t.select("month_int", F.round("money_market", 6).alias("money_market"), F.round("cpi", 4).alias("cpi"), "cpi_yoy", F.round("oil_brent", 4).alias("oil_brent"), F.round("usd_dzd", 6).alias("usd_dzd"))


@query(
    """WITH o AS (SELECT o_custkey, o_orderdate, o_orderkey FROM orders), p AS (SELECT l_orderkey AS k, o_custkey, l_shipdate AS available, min(l_discount) AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)
    SELECT o_custkey AS custkey, o_orderkey AS orderkey, round((SELECT min(value) FROM (SELECT value, available, rank() OVER (ORDER BY available DESC) AS r FROM p WHERE p.o_custkey = o.o_custkey AND p.available <= o.o_orderdate) WHERE r = 1), 6) AS value FROM o"""
)
def jn3_as_of(spark, d):
    orders = V.table(spark, d, "orders")
    items = V.table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    values = items.groupBy(F.col("o_custkey").alias("custkey"), F.col("l_shipdate").alias("available")).agg(F.min("l_discount").alias("value"))
    points = orders.select(F.col("o_custkey").alias("custkey"), F.col("o_orderdate").alias("at")).distinct()
    found = macro.as_of(points, values, ["custkey"])
    keyed = orders.select(F.col("o_custkey").alias("custkey"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("orderkey"))
    return rounded(keyed.join(found, ["custkey", "at"]).select("custkey", "orderkey", "value"))


@query(
    """WITH e AS (SELECT o_orderkey AS row_no, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS s, max(year(l_shipdate) * 12 + month(l_shipdate) - 1) AS e, o_orderpriority AS state
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL), m AS (SELECT row_no, state, unnest(generate_series(s, e)) AS month_int FROM e WHERE s <= e)
    SELECT CAST(month_int AS INT) AS month_int, arg_max(state, row_no) AS regime_state, CAST(substr(arg_max(state, row_no), 1, 1) AS INT) AS severity FROM m GROUP BY month_int"""
)
def jn5_event_months(spark, d):
    """Orders as intervals from order to last shipment, their priority as state and severity."""
    items = V.table(spark, d, "lineitem").groupBy("l_orderkey").agg(C.month_of(F.max("l_shipdate")).alias("end"))
    events = V.table(spark, d, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("row_no"), C.month_of(F.col("o_orderdate")).alias("start"), "end", F.col("o_orderpriority").alias("state"), F.substring("o_orderpriority", 1, 1).cast("int").alias("severity")
    )
    return macro.event_months(events.where("start <= end")).select("month_int", "regime_state", "severity")


@query(
    f"""WITH n AS (SELECT CAST(day AS DATE) AS day, date_diff('day', DATE '1970-01-01', CAST(day AS DATE)) + {C.ISLAMIC_EPOCH} AS n FROM (SELECT unnest(generate_series(DATE '1992-01-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS day)),
    y AS (SELECT *, (30 * n + 10646) // {C.ISLAMIC_CYCLE} AS hy FROM n), p AS (SELECT *, n - 354 * (hy - 1) - (3 + 11 * hy) // 30 AS p FROM y), m AS (SELECT *, (11 * p + 330) // 325 AS hm FROM p),
    x AS (SELECT year(day) * 12 + month(day) - 1 AS month_int, hm, p - 29 * (hm - 1) - (6 * hm - 1) // 11 + 1 AS hd, month(day) AS mo FROM m),
    c AS (SELECT month_int, round(avg(CAST(hm = 9 AS INT)), 4) AS ramadan_frac, CAST(sum(CAST(hm = 9 AS INT)) AS BIGINT) AS ramadan_days, max(CAST(hm = 10 AND hd = 1 AS INT)) AS eid_fitr,
        max(CAST(hm = 12 AND hd = 10 AS INT)) AS eid_adha, max(CAST(mo IN (7, 8) AS INT)) AS is_summer_vacation FROM x GROUP BY 1)
    SELECT CAST(o.month_int AS INT) AS month_int, ramadan_frac, ramadan_days, eid_fitr, eid_adha, is_summer_vacation FROM (SELECT DISTINCT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS month_int FROM orders) o LEFT JOIN c ON o.month_int = c.month_int"""
)
def ag12_seasonal_calendar(spark, d):
    """Months of the orders with their share of Ramadan."""
    months = V.table(spark, d, "orders").select(C.month_of(F.col("o_orderdate")).alias("month_int")).distinct()
    return months.join(F.broadcast(macro.seasonal(spark, 1992, 2002)), "month_int", "left")


@query(
    f"""WITH {V.SERIES}, h AS (SELECT a.series_id, a.t, a.x, list_sort(list(b.x)) AS past FROM s a JOIN s b ON a.series_id = b.series_id AND b.t <= a.t GROUP BY 1, 2, 3)
    SELECT series_id, t AS month_int, CASE WHEN len(past) < 24 THEN NULL WHEN x < past[len(past) // 3 + 1] THEN 'low' WHEN x >= past[2 * len(past) // 3 + 1] THEN 'high' ELSE 'mid' END AS tertile FROM h"""
)
def wn15_causal_tertile(spark, d):
    s = V.series(spark, d).select("series_id", F.col("t").alias("month_int"), F.col("x").alias("value"))
    return macro.causal_tertile(s).drop("value")


@query(
    f"""WITH {V.SERIES}, l AS (SELECT *, lag(x) OVER (PARTITION BY series_id ORDER BY t) AS b FROM s), c AS (SELECT *, CASE WHEN b IS NULL OR b <> x THEN 1 ELSE 0 END AS ch FROM l),
    r AS (SELECT *, sum(ch) OVER (PARTITION BY series_id ORDER BY t) AS run FROM c), f AS (SELECT series_id, max(n) AS longest_flat FROM (SELECT series_id, run, count(*) AS n FROM r GROUP BY 1, 2) GROUP BY 1)
    SELECT r.series_id, count(*) AS n, count(DISTINCT round(x, 6)) AS n_distinct, round(min(x), 6) AS low, round(max(x), 6) AS high, round(stddev_pop(x), 6) AS std, CAST(sum(ch) - 1 AS BIGINT) AS n_changes, max(longest_flat) AS longest_flat
    FROM r JOIN f ON r.series_id = f.series_id GROUP BY 1"""
)
def ag13_identifiability(spark, d):
    return rounded(macro.identifiability(V.series(spark, d).select("series_id", F.col("t").alias("month_int"), F.col("x").alias("value"))))


@query(f"WITH {V.SERIES} SELECT series_id, count(DISTINCT round(x, 6)) <= 5 AS stepwise, count(DISTINCT round(x, 6)) >= 30 AND stddev_pop(x) > 0.2 AS identifiable, stddev_pop(x) < 0.15 AS flat FROM s GROUP BY 1")
def ag14_gate(spark, d):
    return macro.gate(macro.identifiability(V.series(spark, d).select("series_id", F.col("t").alias("month_int"), F.col("x").alias("value"))))


@query(f"WITH {V.SERIES}, p AS (SELECT *, max(x) OVER (PARTITION BY series_id ORDER BY t) AS peak FROM s) SELECT series_id, t AS month_int, round(CASE WHEN peak > 0 THEN (peak - x) / peak ELSE 0 END, 6) AS drawdown FROM p")
def wn12_drawdown(spark, d):
    return rounded(macro.drawdown(V.series(spark, d).select("series_id", F.col("t").alias("month_int"), F.col("x").alias("value"))))


@query(f"WITH {V.SERIES}, p AS (SELECT *, coalesce(lag(x, 3) OVER (PARTITION BY series_id ORDER BY t), first_value(x) OVER (PARTITION BY series_id ORDER BY t)) AS o FROM s) SELECT series_id, t AS month_int, round(CASE WHEN o <> 0 THEN (x - o) / o ELSE 0 END, 6) AS depreciation FROM p")
def wn13_depreciation(spark, d):
    return rounded(macro.depreciation(V.series(spark, d).select("series_id", F.col("t").alias("month_int"), F.col("x").alias("value"))))


@query(
    """WITH q AS (SELECT year(ts) * 12 + month(ts) - 1 AS month_int, value + 1 AS p, value + 2 AS o, CASE WHEN event_id % 3 = 0 THEN value END AS u FROM events)
    SELECT CAST(month_int AS INT) AS month_int, round(avg(p), 2) AS parallel, round(avg(o), 2) AS official, round(avg(u), 2) AS usd, round((avg(p) / avg(o) - 1) * 100, 2) AS premium_pct FROM q GROUP BY 1"""
)
def ag11_monthly_premium(spark, d):
    q = V.table(spark, d, "events").select(F.col("ts").alias("day"), (F.col("value") + 1).alias("parallel"), (F.col("value") + 2).alias("official"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("usd"))
    return macro.monthly_premium(q)


@query(f"WITH {V.PIT} SELECT unnest(['money_market', 'cpi', 'cpi_yoy', 'oil_brent', 'usd_dzd']) AS series, unnest([count(money_market), count(cpi), count(cpi_yoy), count(oil_brent), count(usd_dzd)]) AS months FROM pit WHERE month_int BETWEEN 23952 AND 23999")
def va13_coverage(spark, d):
    return macro.coverage(V.point_in_time(spark, d), V.NAMES, 23952, 23999)


# --- path features ---------------------------------------------------------------------------------------------

_PATH = f"""WITH {V.PANEL}, w AS (
    SELECT *, row_number() OVER o AS i, lag(log_balance) OVER o AS prev, max(log_balance) OVER o AS peak, avg(log_balance) OVER o AS mean, coalesce(lag(log_balance, 3) OVER o, first_value(log_balance) OVER o) AS b3,
        coalesce(lag(log_balance, 6) OVER o, first_value(log_balance) OVER o) AS b6, max(log_balance) OVER (PARTITION BY account_id ORDER BY month_int ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
    FROM panel WINDOW o AS (PARTITION BY account_id ORDER BY month_int)
), v AS (SELECT *, log_balance - prev AS step, coalesce(log_balance < prev, false) AS falls FROM w), u AS (
    SELECT *, max(CASE WHEN before IS NULL OR log_balance > before THEN i END) OVER o AS peak_i, max(CASE WHEN NOT falls THEN i END) OVER o AS stop_i,
        count(step) OVER (PARTITION BY account_id ORDER BY month_int ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS steps, stddev_pop(step) OVER (PARTITION BY account_id ORDER BY month_int ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS spread
    FROM v WINDOW o AS (PARTITION BY account_id ORDER BY month_int)
)"""


@query(
    _PATH + """ SELECT account_id, month_int, round(CASE WHEN peak > 1e-9 THEN (peak - log_balance) / peak ELSE 0 END, 6) AS bal_drawdown, CAST(i - stop_i AS DOUBLE) AS decline_streak,
        round(log_balance - b3, 6) AS bal_mom3, round((log_balance - b3) - (b3 - b6), 6) AS bal_accel, round(log_balance - mean, 6) AS bal_vs_mean,
        round(CASE WHEN steps >= 2 THEN spread ELSE 0 END, 6) AS bal_vol6, CAST(i - peak_i AS DOUBLE) AS months_since_peak FROM u"""
)
def wn5_path_features(spark, d):
    rows = rounded(V.with_path(spark, d))
    return rows.select("account_id", "month_int", *[F.col(c) + 0.0 for c in ()], "bal_drawdown", "decline_streak", "bal_mom3", "bal_accel", "bal_vs_mean", "bal_vol6", "months_since_peak")


@query(f"WITH {V.PANEL} SELECT account_id, month_int, round(CASE WHEN count(*) OVER m > 1 THEN (row_number() OVER (PARTITION BY month_int ORDER BY log_balance, account_id) - 1) / (count(*) OVER m - 1) ELSE 0.5 END, 6) AS xs_rank_bal FROM panel WINDOW m AS (PARTITION BY month_int)")
def wn11_cross_rank(spark, d):
    return rounded(features.cross_rank(V.account_panel(spark, d)).select("account_id", "month_int", "xs_rank_bal"))


@query(f"WITH {V.PANEL}, l AS (SELECT *, lag(month_int) OVER o AS m0, lag(log_balance) OVER o AS b0, lag(balance_kda) OVER o AS w0 FROM panel WINDOW o AS (PARTITION BY account_id ORDER BY month_int)) SELECT account_id, month_int, round(log_balance - b0, 6) AS d_logbal, round(CASE WHEN w0 IS NULL OR w0 = 0 THEN 1 ELSE w0 END, 6) AS weight FROM l WHERE month_int - m0 = 1")
def wn4_increments(spark, d):
    return rounded(features.increments(V.account_panel(spark, d)).select("account_id", "month_int", "d_logbal", "weight"))


@query(
    f"""WITH {V.MODEL}, o AS (SELECT month_int, max(oil_brent) AS oil FROM model_rows GROUP BY 1), dd AS (SELECT month_int, CASE WHEN max(oil) OVER w > 0 THEN (max(oil) OVER w - oil) / max(oil) OVER w ELSE 0 END AS oil_drawdown FROM o WINDOW w AS (ORDER BY month_int))
    SELECT account_id, r.month_int, round(money_market - cpi_yoy, 6) AS real_rate, round(oil_drawdown * CASE WHEN seasoning < 18 THEN 1 ELSE 0 END, 6) AS oil_young FROM model_rows r JOIN dd ON r.month_int = dd.month_int"""
)
def wn14_interactions(spark, d):
    rows = V.model_rows(spark, d)
    oil = macro.drawdown(rows.groupBy("month_int").agg(F.max("oil_brent").alias("value")).withColumn("series_id", F.lit("oil")))
    rows = rows.join(F.broadcast(oil.select("month_int", F.col("drawdown").alias("oil_drawdown"))), "month_int")  # a row a month
    return rounded(features.young_under_stress(features.real_rate(rows)).select("account_id", "month_int", "real_rate", "oil_young"))


_SPLIT = f"""WITH {V.PANEL}, c AS (SELECT *, min(balance_kda) OVER (PARTITION BY account_id ORDER BY month_int ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS lo, row_number() OVER (PARTITION BY account_id ORDER BY month_int DESC) AS back FROM panel),
split AS (SELECT account_id, segment, month_int, least(greatest(lo, 0), greatest(balance_kda, 0)) AS core, balance_kda - least(greatest(lo, 0), greatest(balance_kda, 0)) AS volatile FROM c WHERE back = 1)"""


@query(_SPLIT + " SELECT account_id, month_int, round(core, 6) AS core, round(volatile, 6) AS volatile FROM split")
def wn16_core_volatile(spark, d):
    return rounded(features.core_volatile(V.account_panel(spark, d)).select("account_id", "month_int", "core", "volatile"))


@query()
def wn18_signature(spark, d):
    rows = V.model_rows(spark, d).select("account_id", "month_int", "log_balance", "money_market")
    return features.signature(rows, ["log_balance", "money_market"]).select("account_id", "month_int", F.transform("sig", lambda x: F.round(x, 6)).alias("sig"))


@query()
def wn19_deep_signature(spark, d):
    rows = V.account_panel(spark, d).select("account_id", "month_int", "log_balance")
    return features.signature(rows, ["log_balance"], depth=3).select("account_id", "month_int", F.transform("sig", lambda x: F.round(x, 6)).alias("sig"))


# --- curves ----------------------------------------------------------------------------------------------------

_HAZARDS = f"{V.CURVES}, hz AS (SELECT segment, h, CASE WHEN lag(B) OVER (PARTITION BY segment ORDER BY h) > 0 THEN 1 - B / lag(B) OVER (PARTITION BY segment ORDER BY h) ELSE 0 END AS hazard FROM curves)"


def _hazards(spark, d):
    before = F.lag("B").over(Window.partitionBy("segment").orderBy("h"))
    rows = V.curves(spark, d).withColumn("hazard", F.when(before > 0, 1 - F.col("B") / before).otherwise(0.0))
    return rows.where("h >= 1").select("segment", "h", "hazard")


@query(f"WITH {_HAZARDS} SELECT segment, h, round(exp(sum(ln(greatest(1 - hazard, 1e-300))) OVER (PARTITION BY segment ORDER BY h)), 6) AS S FROM hz WHERE h >= 1")
def ro1_survival(spark, d):
    return rounded(runoff.survival(_hazards(spark, d), ["segment"]).select("segment", "h", "S"))


@query(f"WITH {_HAZARDS} SELECT segment, h, round(exp(sum(-hazard / 2) OVER (PARTITION BY segment ORDER BY h)), 6) AS r FROM hz WHERE h >= 1")
def ro5_retention(spark, d):
    steps = _hazards(spark, d).select("segment", "h", (-F.col("hazard") / 2).alias("increment"))
    return rounded(runoff.retention(steps, ["segment"]).select("segment", "h", "r"))


_ROLL = f"""WITH {V.MODEL}, last AS (SELECT segment AS sg, max(month_int) AS m FROM model_rows GROUP BY 1), alive AS (SELECT r.*, CASE WHEN w = 0 THEN 1 ELSE w END AS wt FROM model_rows r JOIN last ON segment = sg AND month_int = m WHERE event = 0),
steps AS (SELECT *, unnest(generate_series(1, 24)) AS h FROM alive), hz AS (SELECT *, 1 / (1 + exp(-(-1.5 - 0.01 * (seasoning + h) - 0.3 * log_balance + 0.1 * money_market))) AS p, -0.002 - 0.001 * money_market + 0.0001 * (seasoning + h) AS e FROM steps),
paths AS (SELECT account_id, segment, wt, h, exp(sum(ln(1 - p)) OVER o) AS a, exp(sum(ln(1 - p)) OVER o) * exp(sum(e) OVER o) AS b FROM hz WINDOW o AS (PARTITION BY account_id ORDER BY h))
SELECT segment, CAST(h AS INT) AS h, round(sum(wt * a) / sum(wt), 6) AS A, round(sum(wt * b) / sum(wt), 6) AS B FROM paths GROUP BY 1, 2 UNION ALL SELECT DISTINCT segment, 0, 1.0, 1.0 FROM alive"""


@query(_ROLL)
def ro2_book_roll(spark, d):
    alive = panel.alive(V.model_rows(spark, d), ["segment"])
    return rounded(runoff.roll(alive, V.HAZARD, V.HAZARD_B0, V.EROSION, V.EROSION_B0, 24, ["segment"]))


def _rolled(scenarios: str, alive: str) -> str:
    """SQL of the roll for scenarios (scenario, bump, start): alive is where model_rows are taken, start replaces the rate if it isn't null."""
    return f"""alive AS (SELECT r.*, CASE WHEN w = 0 THEN 1 ELSE w END AS wt FROM model_rows r {alive}), sc AS ({scenarios}),
    steps AS (SELECT a.*, scenario, coalesce(start, money_market) + bump AS rate, unnest(generate_series(1, 24)) AS h FROM alive a CROSS JOIN sc),
    hz AS (SELECT *, 1 / (1 + exp(-(-1.5 - 0.01 * (seasoning + h) - 0.3 * log_balance + 0.1 * rate))) AS p, -0.002 - 0.001 * rate + 0.0001 * (seasoning + h) AS e FROM steps),
    tracks AS (SELECT account_id, segment, scenario, wt, h, exp(sum(ln(1 - p)) OVER o) AS a, exp(sum(ln(1 - p)) OVER o) * exp(sum(e) OVER o) AS b FROM hz WINDOW o AS (PARTITION BY account_id, segment, scenario ORDER BY h)),
    rolled AS (SELECT segment, scenario, CAST(h AS INT) AS h, sum(wt * a) / sum(wt) AS A, sum(wt * b) / sum(wt) AS B FROM tracks GROUP BY 1, 2, 3 UNION ALL SELECT DISTINCT segment, scenario, 0, 1.0, 1.0 FROM alive CROSS JOIN sc)"""


_LAST = "JOIN (SELECT segment AS sg, max(month_int) AS m FROM model_rows GROUP BY 1) ON segment = sg AND month_int = m WHERE event = 0"


@query(f"WITH {V.MODEL}, {_rolled("VALUES ('base', 0.0, NULL::DOUBLE), ('up_200bp', 2.0, NULL)", _LAST).replace('sc AS (', 'sc(scenario, bump, start) AS (')} SELECT segment, h, scenario, round(A, 6) AS A, round(B, 6) AS B, round(CASE WHEN A > 1e-12 THEN B / A ELSE 1 END, 6) AS r FROM rolled")
def ro11_rate_bump(spark, d):
    """Base and +2 points of money market, side by side."""
    alive = panel.alive(V.model_rows(spark, d), ["segment"])
    both = [runoff.roll(alive, V.HAZARD, V.HAZARD_B0, V.EROSION, V.EROSION_B0, 24, ["segment"], rate_bump=b).withColumn("scenario", F.lit(n)) for n, b in (("base", 0.0), ("up_200bp", 2.0))]
    return rounded(runoff.attribution(both[0].unionByName(both[1])))


@query(f"WITH {V.CURVES} SELECT segment, round(sum(CASE WHEN h >= 1 THEN B ELSE 0 END), 6) AS wal, min(CASE WHEN B < 0.5 THEN h END) AS runoff_month FROM curves GROUP BY segment")
def ag17_curve_summary(spark, d):
    return rounded(runoff.curve_summary(V.curves(spark, d), ["segment"], 0.5))


@query(f"WITH {V.CURVES} SELECT h, segment, round(sum(b0 * B) / sum(b0), 6) AS B FROM curves GROUP BY GROUPING SETS ((h, segment), (h))")
def ag16_book_curve(spark, d):
    c = V.curves(spark, d)
    weights = c.groupBy("segment").agg(F.max("b0").alias("W"))
    return rounded(runoff.book_curve(c.withColumn("A", F.col("B")), weights, "segment").select("h", "segment", "B"))


@query(_SPLIT + """, t AS (SELECT segment, sum(core) AS c, sum(volatile) AS v FROM split GROUP BY 1) SELECT segment, CAST(h AS INT) AS h, round(CASE WHEN c + v > 0 THEN (c * greatest(1 - h / 60, 0) + v * greatest(1 - h / 3, 0)) / (c + v) ELSE CAST(h = 0 AS INT) END, 6) AS B,
    round(CASE WHEN c + v > 0 THEN c / (c + v) ELSE 0 END, 6) AS core_share FROM t CROSS JOIN (SELECT unnest(generate_series(0, 72)) AS h)""")
def ro7_convention(spark, d):
    return rounded(runoff.convention(features.core_volatile(V.account_panel(spark, d)), 72))


@query(f"WITH {V.MODEL}, b AS (SELECT segment, arg_max(lb, month_int) AS lb0, avg(lb) AS eq FROM (SELECT segment, month_int, ln(greatest(sum(balance_kda), 1e-9)) AS lb FROM model_rows GROUP BY 1, 2) GROUP BY 1) SELECT segment, CAST(h AS INT) AS h, round(exp((lb0 - eq) * (pow(0.9, h) - 1)), 6) AS B FROM b CROSS JOIN (SELECT unnest(generate_series(0, 24)) AS h)")
def ro8_reverting(spark, d):
    from ..operators import models

    states = models.book_months(V.model_rows(spark, d)).groupBy("segment").agg(F.max_by("logbal", "month_int").alias("lb0"), F.avg("logbal").alias("eq")).withColumn("phi", F.lit(-0.1))
    return rounded(runoff.reverting(states, 24).select("segment", "h", "B"))


@query(f"WITH {V.PANEL}, r AS (SELECT segment, avg(event) AS rate FROM panel GROUP BY 1) SELECT segment, CAST(h AS INT) AS h, round(pow(1 - rate, h), 6) AS B FROM r CROSS JOIN (SELECT unnest(generate_series(0, 24)) AS h)")
def ro14_constant_hazard(spark, d):
    return rounded(runoff.constant_hazard(V.account_panel(spark, d), 24))


def _compared(spark, d):
    rows = V.account_panel(spark, d)
    real = panel.realized(rows, V.CUTOFF, V.HORIZON)
    past = rows.where(F.col("month_int") <= V.CUTOFF)
    curves = {"convention": runoff.convention(features.core_volatile(past), V.HORIZON), "constant": runoff.constant_hazard(past, V.HORIZON)}
    from ..operators import models

    model_rows = V.model_rows(spark, d)
    book = models.book_months(model_rows.where(F.col("month_int") <= V.CUTOFF))
    states = book.groupBy("segment").agg(F.max_by("logbal", "month_int").alias("lb0"), F.avg("logbal").alias("eq")).withColumn("phi", F.lit(-0.1))
    curves["reverting"] = runoff.reverting(states, V.HORIZON)
    curves["hazard"] = runoff.roll(model_rows.where(f"month_int = {V.CUTOFF} and event = 0"), V.HAZARD, V.HAZARD_B0, V.EROSION, V.EROSION_B0, V.HORIZON, ["segment"])
    both = None
    for name, curve in curves.items():
        curve = curve.select("segment", "h", "B").withColumn("model", F.lit(name))
        both = curve if both is None else both.unionByName(curve)
    return runoff.errors(both, real, ["segment"])


_ERRORS = f"""WITH {V.CURVES}, {V.PIT}, model_rows AS (
    SELECT p.*, t.money_market, t.cpi_yoy, t.oil_brent, t.usd_dzd, p.balance_kda AS w FROM panel p JOIN pit t ON p.month_int = t.month_int
    WHERE t.cpi_yoy IS NOT NULL AND t.money_market IS NOT NULL AND t.oil_brent IS NOT NULL
), {_rolled("VALUES ('base', 0.0, NULL::DOUBLE)", f"WHERE month_int = {V.CUTOFF} AND event = 0").replace('sc AS (', 'sc(scenario, bump, start) AS (')},
past AS (SELECT * FROM panel WHERE month_int <= {V.CUTOFF}), c AS (SELECT *, min(balance_kda) OVER (PARTITION BY account_id ORDER BY month_int ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS lo, row_number() OVER (PARTITION BY account_id ORDER BY month_int DESC) AS back FROM past),
split AS (SELECT segment, sum(least(greatest(lo, 0), greatest(balance_kda, 0))) AS c, sum(balance_kda - least(greatest(lo, 0), greatest(balance_kda, 0))) AS v FROM c WHERE back = 1 GROUP BY 1),
grid AS (SELECT unnest(generate_series(0, {V.HORIZON})) AS h), book AS (SELECT segment, month_int, ln(greatest(sum(balance_kda), 1e-9)) AS lb FROM model_rows WHERE month_int <= {V.CUTOFF} GROUP BY 1, 2),
preds AS (
    SELECT segment, h, 'convention' AS model, CASE WHEN c + v > 0 THEN (c * greatest(1 - h / 60, 0) + v * greatest(1 - h / 3, 0)) / (c + v) ELSE CAST(h = 0 AS INT) END AS B FROM split CROSS JOIN grid
    UNION ALL SELECT segment, h, 'constant', pow(1 - rate, h) FROM (SELECT segment, avg(event) AS rate FROM past GROUP BY 1) CROSS JOIN grid
    UNION ALL SELECT segment, h, 'reverting', exp((lb0 - eq) * (pow(0.9, h) - 1)) FROM (SELECT segment, arg_max(lb, month_int) AS lb0, avg(lb) AS eq FROM book GROUP BY 1) CROSS JOIN grid
    UNION ALL SELECT segment, h, 'hazard', B FROM rolled
), errors AS (SELECT p.segment, model, avg(abs(p.B - r.B)) AS mae FROM preds p JOIN curves r ON p.segment = r.segment AND p.h = r.h GROUP BY 1, 2)"""


@query(_ERRORS + " SELECT segment, model, round(mae, 6) AS mae FROM errors")
def ro9_model_errors(spark, d):
    return rounded(_compared(spark, d))


_RANKS = {"convention": 0, "constant": 1, "reverting": 2, "hazard": 3}


@query(
    _ERRORS + f""", ranked AS (SELECT *, min(mae) OVER (PARTITION BY segment) AS best, rank FROM errors JOIN (VALUES {", ".join(f"('{m}', {r})" for m, r in _RANKS.items())}) k(name, rank) ON model = name)
    SELECT segment, arg_min(model, mae) AS winner, arg_min(model, rank) FILTER (WHERE mae <= best * 1.05) AS chosen FROM ranked GROUP BY 1"""
)
def ro10_model_choice(spark, d):
    return runoff.pick(_compared(spark, d), ["segment"], _RANKS)


@query(
    f"""WITH {V.SERIES}, q AS (SELECT *, ntile(3) OVER (PARTITION BY series_id ORDER BY x, t) AS state FROM s), l AS (SELECT *, lead(state) OVER (PARTITION BY series_id ORDER BY t) AS nxt FROM q),
    n AS (SELECT series_id, CAST(state AS INT) AS a, CAST(nxt AS INT) AS b, count(*) AS c FROM l WHERE nxt IS NOT NULL GROUP BY ALL) SELECT series_id, a AS "from", b AS "to", c AS count, round(c / sum(c) OVER (PARTITION BY series_id, a), 6) AS share FROM n"""
)
def ag19_transitions(spark, d):
    s = V.series(spark, d).withColumn("state", F.ntile(3).over(Window.partitionBy("series_id").orderBy("x", "t")))
    return rounded(runoff.transitions(s.select("series_id", F.col("t").alias("month_int"), "state")))


# --- rate risk and stress --------------------------------------------------------------------------------------

_FLOWS = f"""{V.CURVES}, flows AS (SELECT segment, h, b0, b0 * (lag(B) OVER w - B + CASE WHEN h = {V.HORIZON} THEN B ELSE 0 END) AS cf FROM curves WINDOW w AS (PARTITION BY segment ORDER BY h)),
shocks(scenario, p, s, l) AS (VALUES {", ".join(f"('{n}', {p}, {s}, {x})" for n, p, s, x in rates.SHOCKS)})"""

_POINTS = [(0.1, 0.03), (0.25, 0.034), (1.0, 0.05)]


@query(f"WITH {_FLOWS} SELECT segment, h, round(cf, 6) AS cf FROM flows WHERE h >= 1")
def ir1_cash_flows(spark, d):
    return rounded(rates.cash_flows(V.curves(spark, d), ["segment"]).select("segment", "h", "cf"))


@query(
    f"""WITH {V.CURVES}, t AS (SELECT DISTINCT h, h / 12 AS t FROM curves) SELECT h, round(CASE WHEN t <= 0.1 THEN 0.03 WHEN t <= 0.25 THEN 0.03 + (t - 0.1) * (0.034 - 0.03) / 0.15 WHEN t <= 1 THEN 0.034 + (t - 0.25) * (0.05 - 0.034) / 0.75 ELSE 0.05 END, 6) AS rate FROM t"""
)
def ir3_curve_rates(spark, d):
    points = spark.createDataFrame(_POINTS, "tenor double, rate double")
    tenors = V.curves(spark, d).select("h", (F.col("h") / 12).alias("t")).distinct()
    return rounded(rates.curve_rates(points, tenors).select("h", "rate"))


def _eve(spark, d):
    c = V.curves(spark, d)
    flat = spark.range(0, V.HORIZON + 1).select(F.col("id").cast("int").alias("h"), F.lit(0.03).alias("rate"))
    return rates.delta_eve(rates.cash_flows(c, ["segment"]), flat, rates.scenarios(spark), ["segment"])


_EVE = f"{_FLOWS}, eve AS (SELECT segment, scenario, sum(cf * exp(-0.03 * h / 12)) AS pv_base, sum(cf * exp(-(0.03 + p + s * exp(-h / 12 / 4) + l * (1 - exp(-h / 12 / 4))) * h / 12)) AS pv_shock FROM flows CROSS JOIN shocks WHERE h >= 1 GROUP BY 1, 2)"


@query(f"WITH {_EVE} SELECT segment, scenario, round(pv_base, 4) AS pv_base, round(pv_shock, 4) AS pv_shock, round(pv_base - pv_shock, 4) AS delta_eve FROM eve")
def ir4_delta_eve(spark, d):
    return rounded(_eve(spark, d), 4)


@query(f"WITH {_EVE} SELECT scenario, round(sum(pv_base - pv_shock), 4) AS delta_eve, CAST(row_number() OVER (ORDER BY sum(pv_base - pv_shock), scenario) AS INT) AS severity, row_number() OVER (ORDER BY sum(pv_base - pv_shock), scenario) = 1 AS worst FROM eve GROUP BY 1")
def ir6_book_totals(spark, d):
    return rounded(rates.book_totals(_eve(spark, d), "segment"), 4)


@query(f"WITH {V.CURVES} SELECT segment, scenario, round(-CASE WHEN segment = 'BUILDING' THEN 0.4 ELSE 0 END * p * b0 * (1 - B) + 0.0, 4) AS delta_nii FROM curves CROSS JOIN (VALUES ('parallel_up', 0.02), ('parallel_down', -0.02), ('up_200bp', 0.02), ('down_200bp', -0.02)) x(scenario, p) WHERE h = 12")
def ir5_delta_nii(spark, d):
    betas = spark.createDataFrame([("BUILDING", 0.4)], "segment string, beta double")
    got = rates.delta_nii(V.curves(spark, d), betas, rates.scenarios(spark), "segment")
    return got.select("segment", "scenario", (F.round("delta_nii", 4) + F.lit(0.0)).alias("delta_nii"))


_STRESS = f"""WITH {V.PANEL}, {V.MACRO}, c AS (SELECT h, sum(b0 * B) / sum(b0) AS B FROM (SELECT b.segment, g.h, coalesce(k.kept, 0) / b.b0 AS B, b.b0 FROM (SELECT segment, sum(balance_kda) AS b0 FROM panel WHERE month_int = {V.CUTOFF} GROUP BY 1) b
        CROSS JOIN (SELECT unnest(generate_series(0, {V.HORIZON})) AS h) g LEFT JOIN (SELECT a.segment, p.month_int - {V.CUTOFF} AS h, sum(p.balance_kda) AS kept FROM panel a JOIN panel p ON a.account_id = p.account_id WHERE a.month_int = {V.CUTOFF} AND p.month_int BETWEEN {V.CUTOFF} AND {V.CUTOFF + V.HORIZON} GROUP BY 1, 2) k
        ON k.segment = b.segment AND k.h = g.h) GROUP BY h),
m AS (SELECT row_number() OVER (ORDER BY month_int) - 1 AS k, oil_brent AS oil, count(*) OVER () AS n FROM macro_month), paths AS (SELECT p.path_id, h.h, greatest((36000 - m.oil) / 36000, 0) AS stress FROM (SELECT unnest(generate_series(0, 19)) AS path_id) p CROSS JOIN (SELECT unnest(generate_series(1, {V.HORIZON})) AS h) h JOIN m ON m.k = (p.path_id * 3 + h.h) % m.n),
f AS (SELECT path_id, h, exp(sum(ln(1 - least(1, 0.6 * stress))) OVER (PARTITION BY path_id ORDER BY h)) AS kept FROM paths), out AS (SELECT path_id, c.h, B * coalesce(kept, 1) AS B FROM (SELECT DISTINCT path_id FROM paths) CROSS JOIN c LEFT JOIN f USING (path_id, h))"""


def _book(spark, d):
    c = V.curves(spark, d)
    return c.groupBy("h").agg((F.sum(F.col("b0") * F.col("B")) / F.sum("b0")).alias("B"))


def _stressed(spark, d, elasticity: float = 0.6):
    """Twenty paths of observed oil prices, from months three apart, over the book's curve."""
    months = V.macro_long(spark, d).where("series = 'oil_brent'")
    rows = months.select((F.row_number().over(Window.orderBy("month_int")) - 1).alias("k"), F.col("value").alias("oil"), F.count("*").over(Window.partitionBy()).alias("n"))  # a row a month
    grid = spark.range(20).select(F.col("id").alias("path_id"), F.explode(F.sequence(F.lit(1), F.lit(V.HORIZON))).alias("h"))
    paths = grid.join(F.broadcast(rows), F.col("k") == (F.col("path_id") * 3 + F.col("h")) % F.col("n"))
    return rates.flight(_book(spark, d), rates.stress_index(paths, 36_000.0).select("path_id", "h", "stress"), elasticity)


@query(_STRESS + " SELECT h, round(quantile_cont(B, 0.05), 6) AS p5, round(quantile_cont(B, 0.5), 6) AS p50, round(quantile_cont(B, 0.95), 6) AS p95 FROM out GROUP BY h")
def ss5_positioning_bands(spark, d):
    return rounded(rates.bands(_stressed(spark, d), [], [0.05, 0.5, 0.95]))


@query(_STRESS + " SELECT count(*) AS n_paths, round(quantile_cont(wal, 0.05), 6) AS p5, round(quantile_cont(wal, 0.5), 6) AS p50, round(quantile_cont(wal, 0.95), 6) AS p95 FROM (SELECT path_id, sum(B) AS wal FROM out WHERE h >= 1 GROUP BY 1)")
def ss5_positioning_wal(spark, d):
    return rounded(rates.wal_levels(_stressed(spark, d), [0.05, 0.5, 0.95]))


@query(_STRESS + f", cr AS (SELECT h, exp(sum(ln(1 - least(1, 0.8 * CASE WHEN h <= 6 THEN 0.4 ELSE 0.2 END))) OVER (ORDER BY h)) AS kept FROM (SELECT unnest(generate_series(1, {V.HORIZON})) AS h)) SELECT CAST(c.h AS INT) AS h, round(B, 6) AS base, round(B * coalesce(kept, 1), 6) AS stressed FROM c LEFT JOIN cr USING (h)")
def ss6_crisis(spark, d):
    book = _book(spark, d)
    hit = rates.flight(book, rates.crisis_path(spark, 0.4, 6, V.HORIZON), 0.8)
    return rounded(book.select("h", F.col("B").alias("base")).join(hit.select("h", F.col("B").alias("stressed")), "h"))


# --- validation ------------------------------------------------------------------------------------------------


@query(f"WITH {V.PANEL}, m AS (SELECT month_int, row_number() OVER (ORDER BY month_int DESC) AS r FROM (SELECT DISTINCT month_int FROM panel)) SELECT month_int, CASE WHEN r <= 12 THEN 'test' WHEN r <= 24 THEN 'val' ELSE 'train' END AS split FROM m")
def flt7_split(spark, d):
    return validate.label_split(V.account_panel(spark, d), 12, 12)


_FOLDS = f"""WITH {V.PANEL}, m AS (SELECT month_int, row_number() OVER (ORDER BY month_int) - 1 AS k, count(*) OVER () AS n FROM (SELECT DISTINCT month_int FROM panel)), o AS (SELECT unnest(generate_series(0, CAST(floor((max(n) - 36) / 6) AS INT))) AS fold FROM m),
x AS (SELECT fold, month_int, k, fold * 6 + 24 AS origin FROM o JOIN m ON k < fold * 6 + 36), y AS (SELECT *, min(CASE WHEN k >= origin THEN month_int END) OVER (PARTITION BY fold) AS first_test FROM x),
folds AS (SELECT CAST(fold AS INT) AS fold, month_int, CASE WHEN k >= origin THEN 'test' WHEN month_int + 6 < first_test THEN 'train' END AS role FROM y)"""


@query(_FOLDS + " SELECT * FROM folds WHERE role IS NOT NULL")
def va1_walk_forward(spark, d):
    return validate.walk_forward(V.account_panel(spark, d), 6)


_CPCV = f"""WITH {V.PANEL}, m AS (SELECT month_int, row_number() OVER (ORDER BY month_int) - 1 AS k, count(*) OVER () AS n FROM (SELECT DISTINCT month_int FROM panel)), b AS (SELECT month_int, CAST(((k + 1) * 8 - 1) // n AS INT) AS block FROM m),
    s AS (SELECT block, min(month_int) AS lo, max(month_int) AS hi FROM b GROUP BY 1), x AS (SELECT s1.block AS b1, s2.block AS b2, b.month_int, CASE WHEN b.block IN (s1.block, s2.block) THEN 'test'
        WHEN (month_int + 3 < s1.lo OR month_int > s1.hi + 3) AND (month_int + 3 < s2.lo OR month_int > s2.hi + 3) THEN 'train' END AS role FROM b, s s1, s s2 WHERE s1.block < s2.block),
    folds AS (SELECT * FROM x WHERE role IS NOT NULL)"""


@query(_CPCV + " SELECT * FROM folds")
def va2_combinatorial(spark, d):
    return validate.combinatorial(V.account_panel(spark, d), 8, 3)


@query(_CPCV + " SELECT count(*) AS n FROM folds a JOIN folds b ON a.b1 = b.b1 AND a.b2 = b.b2 WHERE a.role = 'train' AND b.role = 'test' AND (b.month_int BETWEEN a.month_int AND a.month_int + 3 OR a.month_int > b.month_int AND a.month_int <= b.month_int + 3)")
def va3_leaks(spark, d):
    return validate.leaks(validate.combinatorial(V.account_panel(spark, d), 8, 3), ["b1", "b2"], 3, 3).agg(F.count("*").alias("n"))


@query(
    f"""WITH {V.SCORED}, c AS (SELECT segment, greatest(1e-12, least(1 - 1e-12, p)) AS p, y FROM scored), g AS (SELECT segment, avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS nll, avg((p - y) ** 2) AS brier, avg(p) AS mean_p, avg(y) AS rate, count(*) AS n FROM c GROUP BY 1),
    q AS (SELECT *, greatest(1e-12, least(1 - 1e-12, rate)) AS q FROM g) SELECT segment, round(nll, 6) AS nll, round(brier, 6) AS brier, round(mean_p, 6) AS mean_p, round(rate, 6) AS rate, n, round((1 - nll / -(q * ln(q) + (1 - q) * ln(1 - q))) * 100, 4) AS nll_skill_pct, round((1 - brier / (q * (1 - q))) * 100, 4) AS brier_skill_pct FROM q"""
)
def va10_skill(spark, d):
    got = validate.skill(V.scored(spark, d), ["segment"])
    return got.select("segment", *[F.round(c, 6).alias(c) for c in ("nll", "brier", "mean_p", "rate")], "n", *[F.round(c, 4).alias(c) for c in ("nll_skill_pct", "brier_skill_pct")])


_BINS = f"""WITH {V.SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY p, key) AS r, count(*) OVER (PARTITION BY segment) AS n_all FROM scored), b AS (SELECT *, CAST((10 * r - 1) // n_all AS INT) AS bin FROM r),
t AS (SELECT segment, bin, count(*) AS n, avg(p) AS mean_p, avg(y) AS mean_y, sum(w * p) / greatest(sum(w), 1e-12) AS w_mean_p, sum(w * y) / greatest(sum(w), 1e-12) AS w_mean_y FROM b GROUP BY 1, 2)"""


@query(_BINS + " SELECT segment, bin, n, round(mean_p, 6) AS mean_p, round(mean_y, 6) AS mean_y, round(w_mean_p, 6) AS w_mean_p, round(w_mean_y, 6) AS w_mean_y FROM t")
def va5_reliability(spark, d):
    return rounded(validate.reliability(V.scored(spark, d), ["segment"], "key"))


@query(_BINS + " SELECT segment, round(sum(n * abs(mean_p - mean_y)) / sum(n), 6) AS ece FROM t GROUP BY 1")
def va6_calibration_error(spark, d):
    return rounded(validate.calibration_error(validate.reliability(V.scored(spark, d), ["segment"], "key"), ["segment"]))


@query(f"WITH {V.SCORED}, r AS (SELECT segment, p, y, avg(i) OVER (PARTITION BY segment, p) AS rk FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY p) AS i FROM scored)) SELECT segment, round((sum(rk * y) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 6) AS auc FROM r GROUP BY 1")
def va9_auc(spark, d):
    return rounded(validate.auc(V.scored(spark, d), ["segment"]))


def draw_sql(n: str, *keys: str) -> str:
    """SQL of columns.draw()."""
    out = "CAST(0 AS BIGINT)"
    for k in keys:
        out = f"(({out} * 1103515245 + CAST({k} AS BIGINT) * 12345 + 1013904223) % 2147483647)"
    return f"(((({out} * 48271) % 2147483647) * 48271) % 2147483647 % ({n}))"


_PIT = f"""WITH {V.SCORED}, u AS (SELECT *, {draw_sql("2147483647", "0", "account_id", "month_int")} / 2147483647.0 AS u, greatest(1e-9, least(1 - 1e-9, p)) AS q FROM scored),
pits AS (SELECT *, CASE WHEN y = 0 THEN u * (1 - q) ELSE 1 - q + u * q END AS pit FROM u)"""
_KS = """ks AS (SELECT segment, max(greatest(abs(r / n - pit), abs(pit - (r - 1) / n))) AS ks, max(n) AS n FROM (SELECT segment, pit, row_number() OVER (PARTITION BY segment ORDER BY pit, key) AS r, count(*) OVER (PARTITION BY segment) AS n FROM pits) GROUP BY 1)"""


@query(_PIT + " SELECT segment, CAST(least(floor(pit * 10), 9) AS INT) AS bin, count(*) AS n FROM pits GROUP BY 1, 2")
def va7_pit_counts(spark, d):
    rows = validate.pit(V.scored(spark, d), validate.uniform(F.lit(0), F.col("account_id"), F.col("month_int")))
    return rows.groupBy("segment", F.least(F.floor(F.col("pit") * 10), F.lit(9)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


@query(_PIT + ", " + _KS + """, x AS (SELECT *, (sqrt(n) + 0.12 + 0.11 / sqrt(n)) * ks AS x FROM ks)
    SELECT segment, round(ks, 6) AS ks, n, round(greatest(0, least(1, 2 * list_sum([pow(-1, k - 1) * exp(-2 * pow(k * x, 2)) FOR k IN generate_series(1, 100)]))), 6) AS p_value FROM x""")
def va8_pit_ks(spark, d):
    rows = validate.pit(V.scored(spark, d), validate.uniform(F.lit(0), F.col("account_id"), F.col("month_int")))
    return rounded(validate.ks_uniform(rows, ["segment"], "pit", "key"))


@query(f"WITH {V.SCORED}, r AS (SELECT segment, abs(y - p) AS r, row_number() OVER (PARTITION BY segment ORDER BY abs(y - p), key) AS k, count(*) OVER (PARTITION BY segment) AS n FROM scored) SELECT segment, round(max(CASE WHEN k = ceil((n + 1) * 0.9) THEN r END), 6) AS q FROM r GROUP BY 1")
def cf1_conformal(spark, d):
    rows = V.scored(spark, d).withColumn("r", F.abs(F.col("y") - F.col("p")))
    return rounded(validate.conformal(rows, ["segment"], "key", 0.1))


@query(f"WITH {V.SCORED}, r AS (SELECT segment, abs(y - p) AS r, sum(w) OVER (PARTITION BY segment ORDER BY abs(y - p), key ROWS UNBOUNDED PRECEDING) / (sum(w) OVER (PARTITION BY segment) + 1) AS c FROM scored) SELECT segment, round(min(CASE WHEN c >= 0.9 THEN r END), 6) AS q FROM r GROUP BY 1")
def cf2_weighted_conformal(spark, d):
    rows = V.scored(spark, d).withColumn("r", F.abs(F.col("y") - F.col("p")))
    return rounded(validate.weighted_conformal(rows, ["segment"], "key", 0.1))


@query(f"WITH {V.CURVES} SELECT segment, h, round(greatest(0, least(1, B - 0.01 * h)), 6) AS low, round(greatest(0, least(1, B + 0.01 * h)), 6) AS high FROM curves")
def cf3_band(spark, d):
    return rounded(validate.band(V.curves(spark, d), 0.01).select("segment", "h", "low", "high"))


# --- series ----------------------------------------------------------------------------------------------------


@query(f"WITH {V.SERIES}, w(k, v) AS (VALUES {', '.join(f'({k}, {v!r})' for k, v in enumerate(series.difference_weights(0.5, 1e-2)))}), r AS (SELECT series_id, t, x, row_number() OVER (PARTITION BY series_id ORDER BY t) AS i FROM s) SELECT a.series_id, a.t, round(CASE WHEN count(b.x) = (SELECT count(*) FROM w) THEN sum(w.v * b.x) END, 4) AS ffd FROM r a CROSS JOIN w LEFT JOIN r b ON b.series_id = a.series_id AND b.i = a.i - w.k GROUP BY 1, 2")
def wn17_fractional(spark, d):
    return rounded(series.fractional(V.series(spark, d), 0.5, 1e-2).select("series_id", "t", "ffd"), 4)


@query()
def ts1_cusum(spark, d):
    return rounded(series.cusum(V.user_series(spark, d)))


def _streamed(spark, d, online):
    """online() over the users' series as a stream of two files, early and late rows, each a query that goes on from the other's checkpoint."""
    at, provider = _shared_path(spark, "stream"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    live.keep_typed_state(spark)
    try:
        rows = V.user_series(spark, d).persist()
        middle = rows.agg(F.percentile_approx("t", 0.5)).first()[0]  # one number
        for late in (False, True):
            rows.where((F.col("t") > F.lit(middle)) == late).write.mode("append").parquet(f"{at}/in")
            stream = spark.readStream.schema(rows.schema).parquet(f"{at}/in")
            online(stream).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
        rows.unpersist()
    finally:
        spark.conf.set(provider, before)
    return spark.read.parquet(f"{at}/out")


@query()
def str3_online_breaks(spark, d):
    return _streamed(spark, d, live.online_cusum)


@query()
def str4_online_regimes(spark, d):
    return rounded(_streamed(spark, d, live.online_regimes))


@query()
def ts2_alarm(spark, d):
    return series.alarm(series.cusum(V.user_series(spark, d)))


@query()
def ts3_icss(spark, d):
    return series.icss(V.user_series(spark, d).withColumn("x", F.col("x") - F.avg("x").over(Window.partitionBy("series_id"))))


@query()
def ts3_icss_robust(spark, d):
    return series.icss(V.user_series(spark, d).withColumn("x", F.col("x") - F.avg("x").over(Window.partitionBy("series_id"))), robust=True)


@query()
def ts4_icss_causal(spark, d):
    return rounded(series.icss_causal(V.series(spark, d).withColumn("x", F.col("x") - F.avg("x").over(Window.partitionBy("series_id")))))


@query()
def ts5_adf(spark, d):
    return rounded(series.adf(V.series(spark, d)))


@query()
def ts6_least_difference(spark, d):
    return series.least_difference(V.series(spark, d))


_EXPLOSIVE = f"""WITH {V.SERIES}, c AS (SELECT series_id, t, x - avg(x) OVER (PARTITION BY series_id) AS x FROM s), r AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY series_id) AS n, lag(x) OVER w AS x0 FROM c WINDOW w AS (PARTITION BY series_id ORDER BY t)),
p AS (SELECT series_id, t, i, greatest(12, floor(n * 0.2)) AS r0, coalesce(sum(x0) OVER w, 0) AS sx, coalesce(sum(x - x0) OVER w, 0) AS sy, coalesce(sum(x0 * x0) OVER w, 0) AS sxx, coalesce(sum(x0 * (x - x0)) OVER w, 0) AS sxy, coalesce(sum((x - x0) * (x - x0)) OVER w, 0) AS syy FROM r WINDOW w AS (PARTITION BY series_id ORDER BY t)),
q AS (SELECT e.series_id, e.t, e.i - s.i AS m, e.sx - s.sx AS sx, e.sy - s.sy AS sy, e.sxx - s.sxx AS sxx, e.sxy - s.sxy AS sxy, e.syy - s.syy AS syy FROM p e JOIN p s ON e.series_id = s.series_id AND s.i <= e.i - e.r0 + 1),
g AS (SELECT *, sxx - sx * sx / m AS vx, (sxy - sx * sy / m) / (sxx - sx * sx / m) AS g FROM q), z AS (SELECT *, syy - sy * sy / m - g * (sxy - sx * sy / m) AS rss FROM g),
best AS (SELECT series_id, t, max(CASE WHEN vx > 1e-12 AND rss > 1e-12 AND m > 2 THEN g / sqrt(rss / (m - 2) / vx) END) AS bsadf FROM z GROUP BY 1, 2)"""


@query(_EXPLOSIVE + " SELECT s.series_id, s.t, round(bsadf, 4) AS bsadf FROM s LEFT JOIN best ON s.series_id = best.series_id AND s.t = best.t")
def ts8_bsadf(spark, d):
    return rounded(series.explosive(V.series(spark, d)), 4)


@query(_EXPLOSIVE + " SELECT series_id, round(max(bsadf), 4) AS gsadf FROM best GROUP BY 1")
def ts8_gsadf(spark, d):
    return rounded(series.supremum(series.explosive(V.series(spark, d))).select("series_id", "gsadf"), 4)


@query()
def ts9_regimes(spark, d):
    return series.regimes(V.user_series(spark, d), ["x"]).select("series_id", "t", "n_states", "state", F.transform("posterior", lambda p: F.round(p, 6)).alias("posterior"))


@query()
def ts11_regime_labels(spark, d):
    states = series.regimes(V.user_series(spark, d), ["x"])
    return rounded(series.label_regimes(states.groupBy("series_id", "state").agg(F.avg("x").alias("score"))))


@query()
def ts12_adaptive(spark, d):
    return rounded(series.adaptive(V.user_series(spark, d)))


@query(f"WITH {V.TICKS}, b AS (SELECT user_id, day, arg_min(value, (ts, tie)) AS o, max(value) AS hi, min(value) AS lo, arg_max(value, (ts, tie)) AS c, count(*) AS n FROM ticks GROUP BY 1, 2) SELECT user_id, day, round(ln(hi / lo) ** 2 / (4 * ln(2)), 6) AS parkinson, round(0.5 * ln(hi / lo) ** 2 - (2 * ln(2) - 1) * ln(c / o) ** 2, 6) AS garman_klass, round(ln(hi / c) * ln(hi / o) + ln(lo / c) * ln(lo / o), 6) AS rogers_satchell FROM b")
def wn20_range_volatility(spark, d):
    rows = series.range_volatility(series.bars(_ticks(spark, d), ["user_id", "day"]))
    return rounded(rows.select("user_id", "day", "parkinson", "garman_klass", "rogers_satchell"))


def _ticks(spark, d):
    return V.table(spark, d, "events").select("user_id", "ts", F.to_date("ts").alias("day"), (F.col("value") + 1).alias("value"), F.col("event_id").alias("tie")).where("value > 0")


@query(
    f"""WITH {V.TICKS}, b AS (SELECT user_id, day, arg_min(value, (ts, tie)) AS o, max(value) AS hi, min(value) AS lo, arg_max(value, (ts, tie)) AS c FROM ticks GROUP BY 1, 2), x AS (SELECT *, ln(o / lag(c) OVER (PARTITION BY user_id ORDER BY day)) AS night, ln(c / o) AS dy, ln(hi / c) * ln(hi / o) + ln(lo / c) * ln(lo / o) AS rs FROM b),
    g AS (SELECT user_id, count(*) AS m, var_samp(night) AS vn, var_samp(dy) AS vd, avg(rs) AS rs FROM x WHERE night IS NOT NULL GROUP BY 1) SELECT user_id, m, round(vn + 0.34 / (1.34 + (m + 1) / (m - 1)) * vd + (1 - 0.34 / (1.34 + (m + 1) / (m - 1))) * rs, 6) AS yang_zhang FROM g WHERE m > 1"""
)
def wn21_yang_zhang(spark, d):
    return rounded(series.yang_zhang(series.bars(_ticks(spark, d), ["user_id", "day"]), "user_id", "day"))


@query(f"WITH {V.TICKS}, r AS (SELECT user_id, day, ln(value / lag(value) OVER (PARTITION BY user_id ORDER BY ts, tie)) AS r FROM ticks) SELECT user_id, day, round(sum(r * r), 6) AS rv FROM r GROUP BY 1, 2")
def wn22_realized_variance(spark, d):
    return rounded(series.realized_variance(_ticks(spark, d), ["user_id", "day"], "user_id"))


# --- uncertainty -----------------------------------------------------------------------------------------------


_MONTHS = f"""WITH {V.PANEL}, m AS (SELECT month_int, row_number() OVER (ORDER BY month_int) - 1 AS k FROM (SELECT DISTINCT month_int FROM panel)), sz AS (SELECT count(*) AS n FROM m),
slots AS (SELECT boot_id, n, unnest(generate_series(0, n - 1)) AS slot FROM (SELECT unnest(generate_series(0, 49)) AS boot_id) CROSS JOIN sz), sums AS (SELECT k, sum(event) AS s, count(event) AS c FROM panel JOIN m USING (month_int) GROUP BY 1)"""
_BLOCKS = _MONTHS + f""", taken AS (SELECT boot_id, {draw_sql("n - least(6, n) + 1", "0", "boot_id", "slot // least(6, n)")} + slot % least(6, n) AS k FROM slots),
stats AS (SELECT boot_id, sum(s) / sum(c) AS stat FROM taken JOIN sums USING (k) GROUP BY 1)"""


@query(_BLOCKS + " SELECT boot_id, round(stat, 6) AS stat FROM stats")
def un1_block_bootstrap(spark, d):
    rows = V.account_panel(spark, d).withColumn("e", F.col("event").cast("double"))
    return rounded(uncertainty.monthly_bootstrap(rows, "e", uncertainty.block_months(rows, 50, 6)))


@query(
    _MONTHS + f""", f AS (SELECT *, CASE WHEN slot = 0 OR {draw_sql("6", "1", "boot_id", "slot")} = 0 THEN {draw_sql("n", "0", "boot_id", "slot")} - slot END AS start FROM slots),
    taken AS (SELECT boot_id, ((last_value(start IGNORE NULLS) OVER (PARTITION BY boot_id ORDER BY slot ROWS UNBOUNDED PRECEDING) + slot) % n + n) % n AS k FROM f)
    SELECT boot_id, round(sum(s) / sum(c), 6) AS stat FROM taken JOIN sums USING (k) GROUP BY 1"""
)
def un3_stationary_bootstrap(spark, d):
    rows = V.account_panel(spark, d).withColumn("e", F.col("event").cast("double"))
    return rounded(uncertainty.monthly_bootstrap(rows, "e", uncertainty.stationary_months(rows, 50, 6)))


@query(
    f"""WITH {V.PANEL}, acc AS (SELECT account_id, sum(event) AS s, count(event) AS n, row_number() OVER (ORDER BY substr(md5(account_id), 1, 3), account_id) - 1 AS k FROM panel GROUP BY 1),
    d AS (SELECT boot_id, {draw_sql("t", "0", "boot_id", "k")} AS at FROM acc CROSS JOIN (SELECT count(*) AS t FROM acc) CROSS JOIN (SELECT unnest(generate_series(0, 49)) AS boot_id))
    SELECT boot_id, round(sum(s) / sum(n), 6) AS stat FROM d JOIN acc ON d.at = acc.k GROUP BY 1"""
)
def un2_cluster_bootstrap(spark, d):
    return rounded(uncertainty.cluster_bootstrap(V.account_panel(spark, d).withColumn("e", F.col("event").cast("double")), "e", 50))


@query(_BLOCKS + " SELECT round(quantile_cont(stat, 0.05), 6) AS low, round(quantile_cont(stat, 0.5), 6) AS mid, round(quantile_cont(stat, 0.95), 6) AS high FROM stats")
def un4_percentile_interval(spark, d):
    rows = V.account_panel(spark, d).withColumn("e", F.col("event").cast("double"))
    return rounded(uncertainty.percentile_interval(uncertainty.monthly_bootstrap(rows, "e", uncertainty.block_months(rows, 50, 6))))


@query()
def un5_bca_interval(spark, d):
    rows = V.account_panel(spark, d).withColumn("e", F.col("event").cast("double"))
    stats = uncertainty.cluster_bootstrap(rows, "e", 50)
    return rounded(uncertainty.bca_interval(rows.select(F.col("e").alias("x")), stats))


@query(
    f"""WITH {V.SERIES}, r AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY t) AS i, count(*) OVER (PARTITION BY series_id) AS n, x - avg(x) OVER (PARTITION BY series_id) AS e FROM s), l AS (SELECT *, greatest(1, CAST(floor(4 * pow(n / 100, 2 / 9)) AS INT)) AS lags FROM r),
    v AS (SELECT a.series_id, sum(CASE WHEN a.i = b.i THEN 1 ELSE 2 * (1 - (a.i - b.i) / (a.lags + 1)) END * a.e * b.e) / max(a.n) AS lrv, max(a.n) AS n FROM l a JOIN l b ON a.series_id = b.series_id AND b.i BETWEEN a.i - a.lags AND a.i GROUP BY 1)
    SELECT v.series_id, round(m, 4) AS mean, round(m - 1.96 * sqrt(greatest(lrv, 0) / n), 4) AS low, round(m + 1.96 * sqrt(greatest(lrv, 0) / n), 4) AS high FROM v JOIN (SELECT series_id, avg(x) AS m FROM s GROUP BY 1) a ON v.series_id = a.series_id"""
)
def un6_hac_mean(spark, d):
    return rounded(uncertainty.hac_mean(V.series(spark, d)), 4)


@query(
    _STRESS + """, f3 AS (SELECT path_id, h, exp(sum(ln(1 - least(1, 0.3 * stress))) OVER (PARTITION BY path_id ORDER BY h)) AS kept FROM paths), out3 AS (SELECT path_id, c.h, B * coalesce(kept, 1) AS B FROM (SELECT DISTINCT path_id FROM paths) CROSS JOIN c LEFT JOIN f3 USING (path_id, h)),
    a AS (SELECT h, quantile_cont(B, 0.05) AS low, quantile_cont(B, 0.5) AS mid, quantile_cont(B, 0.95) AS high FROM out GROUP BY h), b AS (SELECT h, quantile_cont(B, 0.05) AS low, quantile_cont(B, 0.5) AS mid, quantile_cont(B, 0.95) AS high FROM out3 GROUP BY h)
    SELECT a.h, round(a.mid, 6) AS mid, round(greatest(0, least(1, a.mid - sqrt((a.mid - a.low) ** 2 + (b.mid - b.low) ** 2))), 6) AS low, round(greatest(0, least(1, a.mid + sqrt((a.high - a.mid) ** 2 + (b.high - b.mid) ** 2))), 6) AS high FROM a JOIN b ON a.h = b.h"""
)
def un8_quadrature(spark, d):
    """The fans of two elasticities as one."""
    fans = [rates.bands(_stressed(spark, d, e), [], [0.05, 0.5, 0.95]).toDF("h", "low", "mid", "high") for e in (0.6, 0.3)]
    return rounded(uncertainty.quadrature(*fans))


# --- profiles and payloads -------------------------------------------------------------------------------------


@query(
    """WITH t AS (SELECT o_orderstatus AS status, o_orderpriority AS priority FROM orders) SELECT 'status' AS "column", status AS value, count(*) AS n FROM t GROUP BY 2 UNION ALL SELECT 'priority', priority, count(*) FROM t GROUP BY 2"""
)
def ag5_profile(spark, d):
    rows = V.table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return dumps.profile(rows, ["status", "priority"])


@query(f"WITH {V.SNAPSHOTS}, p AS (SELECT account_id, month_int, count(*) AS n_rows, count(DISTINCT type_compte) AS l FROM snapshots GROUP BY 1, 2) SELECT n_rows, count(*) AS n, CAST(sum(CAST(l > 1 AS INT)) AS BIGINT) AS several_labels FROM p GROUP BY 1")
def ag6_grain(spark, d):
    return dumps.grain(V.records(spark, d), "account_id", "month_int", "type_compte")


@query(
    f"""WITH {V.SNAPSHOTS} SELECT CAST(count(*) FILTER (WHERE ctrvl_kda IS NULL) AS BIGINT) AS missing, count(*) FILTER (WHERE ctrvl_kda = 0) AS zero, count(*) FILTER (WHERE ctrvl_kda < 0) AS negative, count(ctrvl_kda) AS valid, {", ".join(f"round(quantile_cont(ctrvl_kda, {q / 100}), 6) AS q{q}" for q in (0, 25, 50, 75, 95, 100))} FROM snapshots"""
)
def ag7_balance_quality(spark, d):
    return rounded(dumps.balance_quality(V.records(spark, d), "ctrvl_kda"))


@query("SELECT type_compte, n FROM (SELECT p_type AS type_compte, count(*) AS n FROM part GROUP BY 1) ORDER BY n DESC, type_compte LIMIT 20")
def tk1_top_types(spark, d):
    return V.table(spark, d, "part").groupBy(F.col("p_type").alias("type_compte")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "type_compte").limit(20)


@query("SELECT doc_id, upper(trim(translate(text, '" + C.ACCENTED + "', '" + C.PLAIN + "'))) = text AS is_plain, length(regexp_replace(lower(translate(text, '" + C.ACCENTED + "', '" + C.PLAIN + "')), '[^a-z0-9]', '', 'g')) AS key_length FROM documents")
def cln1_plain_text(spark, d):
    return V.table(spark, d, "documents").select("doc_id", (C.plain_upper(F.col("text")) == F.col("text")).alias("is_plain"), F.length(C.header_key(F.col("text"))).alias("key_length"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment LIKE '%BUILD%' AND c_custkey % 3 <> 1 THEN 'hit' ELSE 'other' END AS hit FROM customer")
def flt2_scope(spark, d):
    """Customers' segments as labels; every third is an asset, every third says nothing of it."""
    kind = F.when(F.col("c_custkey") % 3 == 0, "Ressources").when(F.col("c_custkey") % 3 == 1, " R\u00e9mplois")
    rows = V.table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("rubrique"), kind.alias("ressources"))
    inside = panel.in_scope(rows, ["BUILD"]).select("c_custkey", F.lit("hit").alias("hit"))
    return rows.select("c_custkey").join(inside, "c_custkey", "left").select("c_custkey", F.coalesce("hit", F.lit("other")).alias("hit"))


@query("SELECT page_id, count(*) AS links FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"/([^\"]*)\"', 1)) AS l FROM pages) GROUP BY page_id")
def src14_page_matches(spark, d):
    """The extraction that quotes() uses, over all pages' links."""
    return V.table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="/([^"]*)"'), 1)).alias("l")).groupBy("page_id").agg(F.count("*").alias("links"))


@query("SELECT event_id, CAST(ts AS DATE) AS day, round(value + 0.5, 6) AS parallel, round(value / 2 + 1, 6) AS official, CASE WHEN event_id % 4 = 0 THEN round(value + 2, 6) END AS usd FROM events WHERE value > -0.5 AND event_id % 9 <> 0")
def src14_quotes(spark, d):
    """Events as quotes within page text, and read back; some pages hold none."""
    v, day = F.col("value"), F.date_format("ts", "yyyy-MM-dd")
    cell = lambda name, c: F.concat(F.lit(f',"{name}":'), c.cast("string"))
    extra = F.when(F.col("event_id") % 4 == 0, F.concat(cell("usdBuyRate", v + 1), cell("usdSellRate", v + 3))).otherwise("")
    quote = F.concat(F.lit('<script>x = [{"date":"'), day, F.lit('"'), cell("buyRate", v), cell("sellRate", v + 1), cell("officialBuyRate", v / 2), cell("officialSellRate", v / 2 + 2), extra, F.lit("}]</script>"))
    pages = V.table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 9 == 0, F.lit("<p>{}</p>")).otherwise(quote).alias("html"))
    return rounded(payloads.quotes(pages).select("event_id", "day", "parallel", "official", "usd"))


@query("SELECT event_id, round(CAST(json_extract(props, '$.k') AS DOUBLE), 6) AS value FROM events WHERE json_extract(props, '$.k') IS NOT NULL")
def src13_indicator(spark, d):
    """Events' JSON wrapped as an indicator's payload, and read back."""
    rows = V.table(spark, d, "events").select("event_id", F.concat(F.lit('[{},[{"date":"2024","value":'), F.coalesce(F.get_json_object("props", "$.k"), F.lit("null")), F.lit("}]]")).alias("payload"))
    return rounded(payloads.indicator(rows).select("event_id", "value"))


# --- fits and whole books --------------------------------------------------------------------------------------


def _segment(spark, d, name: str = "BUILDING"):
    return V.model_rows(spark, d).where(F.col("segment") == name)


@query()
def ml2_hazard_fit(spark, d):
    """Coefficients of the hazard over all segments' rows."""
    from ..operators import books, models

    m = models.fit_hazard(V.model_rows(spark, d), books.HAZARD, 1e-3, 0.5)
    return rounded(spark.createDataFrame([(k, v, models.version(m)) for k, v in [*m.raw.items(), ("intercept", m.b0)]], "feature string, coefficient double, version string"), 5)


@query()
def ml4_erosion_fit(spark, d):
    from ..operators import books, models

    coef, b0 = models.fit_erosion(features.increments(V.model_rows(spark, d)), books.EROSION)
    return rounded(spark.createDataFrame([*coef.items(), ("intercept", b0)], "feature string, coefficient double"))


@query()
def ml5_penalty_grid(spark, d):
    from ..operators import books, models

    rows = V.model_rows(spark, d).persist(StorageLevel.DISK_ONLY)
    folds = validate.walk_forward(rows, 6, step=12)
    grid = models.penalty_grid(rows, books.HAZARD, folds, [1e-5 * 10 ** (4 * k / 7) for k in range(8)], [0.0, 0.25, 0.5, 0.75, 1.0])
    return grid.select(F.round("lam", 9).alias("lam"), "alpha", *[F.round(c, 4).alias(c) for c in ("nll", "nll_se", "brier", "brier_se")])


@query()
def ml6_one_se_choice(spark, d):
    from ..operators import models

    return models.one_se(ml5_penalty_grid(spark, d))


@query()
def ml10_trees(spark, d):
    from ..operators import books

    rows = features.path(V.model_rows(spark, d))
    return rounded(books.compare_classes(rows, ["seasoning", "log_balance", "money_market"], ["bal_drawdown", "decline_streak", "bal_vol6"]), 3)


@query()
def ml11_error_correction(spark, d):
    from ..operators import models

    return rounded(models.error_correction(models.book_months(V.model_rows(spark, d))))


@query()
def ro13_books(spark, d):
    from ..operators import books

    return rounded(books.run(V.model_rows(spark, d).persist(), 24), 4)


@query()
def ro12_score_header(spark, d):
    from ..operators import books

    return rounded(books.score_header(books.run(V.model_rows(spark, d).persist(), 24), V.END), 4)


@query()
def va11_back_test(spark, d):
    from ..operators import books

    errors = books.back_test(V.model_rows(spark, d).persist(), [V.CUTOFF, V.CUTOFF + 12], 12)
    return rounded(books.leaderboard(errors), 4)


def _score(spark, d):
    from ..operators import scoring

    asof = V.CUTOFF + 24
    rows, months = V.model_rows(spark, d).where(F.col("month_int") <= asof), _rates(spark, d).where(F.col("month_int") <= asof)
    return scoring.score(rows.persist(StorageLevel.DISK_ONLY), months.persist(), 12, 24)


@query()
def ro12_score_record(spark, d):
    """The record of a run two years after the cutoff, appended twice to a table of runs: the second time nothing is new."""
    at, run = _shared_path(spark, "scores"), _score(spark, d)[3]
    for _ in range(2):
        dumps.append_scores(run, at)
    return rounded(spark.read.schema(run.schema).parquet(at).drop("regime_posterior", "version"), 3)


@query()
def ro13_scored_book(spark, d):
    """Curves of each segment by the model chosen for it, and of the book, with the segment's evaluation."""
    evaluation, _, scored, _ = _score(spark, d)
    return rounded(scored.join(F.broadcast(evaluation.drop("n")), "segment", "left").drop("version"), 3)


@query()
def va11_coverage(spark, d):
    from ..operators import scoring

    return rounded(scoring.back_test(V.model_rows(spark, d).persist(StorageLevel.DISK_ONLY), [V.CUTOFF, V.CUTOFF + 6, V.CUTOFF + 12], 12), 4)


def _fan(spark, d, n_paths: int = 30):
    from ..operators import books

    rows = V.model_rows(spark, d).persist()
    hazard, erosion, b0 = books.fit_segment(rows)
    names = ["money_market", "cpi_yoy", "oil_brent"]
    months = rows.groupBy("month_int").agg(*[F.max(n).alias(n) for n in names])
    return books.roll_paths(panel.alive(rows), books.resampled_paths(months, names, n_paths, 24), hazard, erosion, b0, 24)


@query()
def ss1_scenario_fan(spark, d):
    return rounded(rates.bands(_fan(spark, d), [], [0.05, 0.5, 0.95]), 4)


@query()
def ss1_wal_levels(spark, d):
    return rounded(rates.wal_levels(_fan(spark, d, 2000), [0.01, 0.05, 0.5, 0.95, 0.99]), 4)


@query()
def un7_coefficient_fan(spark, d):
    from ..operators import books

    return rounded(books.coefficient_fan(V.model_rows(spark, d).persist(StorageLevel.DISK_ONLY), 120, 20), 4)


# --- text cells, read-backs and checks -------------------------------------------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS value FROM orders")
def cln3_numbers(spark, d):
    """Prices as cells with commas and spaces, some blank or a dash."""
    cell = F.when(F.col("o_orderkey") % 10 == 0, F.lit(" - ")).when(F.col("o_orderkey") % 11 == 0, F.lit("")).otherwise(F.concat(F.lit(" "), F.format_number("o_totalprice", 2)))
    return V.table(spark, d, "orders").select("o_orderkey", F.round(C.number(cell), 2).alias("value"))


def _openings(spark, d):
    k, day = F.col("o_orderkey") % 5, F.col("o_orderdate")
    cell = F.when(k == 0, F.date_format(day, "M/d/yyyy")).when(k == 1, F.date_format(day, "d.M.yyyy")).when(k == 2, F.date_format(day, " MM-dd-yy")).when(k == 3, F.lit("unknown"))
    return V.table(spark, d, "orders").select("o_orderkey", cell.alias("cell"))


_OPENED = """opened AS (SELECT o_orderkey, o_orderkey % 5 AS k, CAST(CASE o_orderkey % 5 WHEN 0 THEN year(o_orderdate) * 12 + month(o_orderdate) - 1 WHEN 2 THEN year(o_orderdate) * 12 + month(o_orderdate) - 1
    WHEN 1 THEN year(o_orderdate) * 12 + CASE WHEN day(o_orderdate) > 12 THEN month(o_orderdate) ELSE day(o_orderdate) END - 1 END AS INT) AS month_int FROM orders)"""


@query(f"WITH {_OPENED} SELECT o_orderkey, month_int FROM opened")
def cln4_opening_months(spark, d):
    return _openings(spark, d).select("o_orderkey", C.opening_month(F.col("cell")).alias("month_int"))


@query(f"WITH {_OPENED} SELECT count(month_int) AS parsed, count(*) FILTER (WHERE k = 3) AS unparsed, CAST(min(month_int // 12) AS INT) AS first_year, CAST(max(month_int // 12) AS INT) AS last_year FROM opened")
def ag8_opening_dates(spark, d):
    return dumps.opening_dates(_openings(spark, d), "cell")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INT) END AS month_int FROM orders")
def cln6_path_months(spark, d):
    """Months out of names of files and folders."""
    k, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    name = F.array(*map(F.lit, C.FRENCH_MONTHS))[F.month(day) - 1]
    path = F.when(k == 1, F.concat(F.lit("/a/06-EFM/EFM "), F.date_format(day, "MM yyyy"), F.lit(".csv"))).when(k == 2, F.concat(F.lit("/a/Analyses_Resultats "), F.date_format(day, "yyyy/MM"), F.lit("-"), F.initcap(name), F.lit("/x.csv"))).otherwise("/a/b.csv")
    file = F.concat(F.lit("DAV_"), F.date_format(day, "MMyyyy"), F.lit(".txt"))
    return V.table(spark, d, "orders").select("o_orderkey", F.when(k == 0, C.file_month(file)).otherwise(C.path_month(path)).alias("month_int"))


_FIRST = ["Comptes \u00e0 vue", "D\u00e9p\u00f4t de garantie", "Engagement de", "Epargne", "Livret", "D\u00e9couverts", "Bureau", "Divers"]
_SECOND = ["dinars", "devises", "d\u00e9biteur", "financement", "BU", "hors bilan", "", "vue"]


@query(
    f"""WITH l AS (SELECT o_orderkey, upper(strip_accents(({_FIRST})[CAST(o_orderkey % 8 AS INT) + 1] || ' ' || ({_SECOND})[CAST(o_custkey % 8 AS INT) + 1])) AS r FROM orders)
    SELECT o_orderkey, CASE WHEN contains(r, 'EPARGNE') OR contains(r, 'LIVRET') THEN 'epargne' WHEN contains(r, 'DECOUVERT') OR contains(r, 'DEBITEUR') OR (contains(r, 'VUE') AND contains(r, 'DEBIT')) THEN 'decouverts'
        WHEN contains(r, 'ENGAGEMENT') OR contains(r, 'FINANCEMENT') THEN 'hb_engagement' WHEN contains(r, 'VUE') AND contains(r, 'DINAR') THEN 'vue_dinars' WHEN contains(r, 'VUE') AND (contains(r, 'DEVISE') OR contains(r, 'BU')) THEN 'vue_devises'
        WHEN contains(r, 'VUE') THEN 'vue_other' WHEN contains(r, 'GARANTIE') THEN 'garantie' ELSE 'other' END AS segment FROM l"""
)
def cln8_segments(spark, d):
    """Labels of two parts, by order and customer."""
    part = lambda words, k: F.array(*map(F.lit, words))[(F.col(k) % 8).cast("int")]
    label = F.concat_ws(" ", part(_FIRST, "o_orderkey"), part(_SECOND, "o_custkey"))
    return V.table(spark, d, "orders").select("o_orderkey", C.segment_of(label).alias("segment"))


@query(f"WITH {V.PANEL} SELECT CAST(row_number() OVER (ORDER BY sum(balance_kda) DESC, segment) AS INT) AS place, segment, round(sum(balance_kda), 4) AS W FROM panel WHERE month_int = {V.CUTOFF} GROUP BY segment")
def tk2_heaviest_segments(spark, d):
    weights = V.account_panel(spark, d).where(F.col("month_int") == V.CUTOFF).groupBy("segment").agg(F.sum("balance_kda").alias("W"))
    return rounded(weights.select(F.row_number().over(Window.orderBy(F.desc("W"), "segment")).alias("place"), "segment", "W"), 4)  # a row a segment


@query(
    f"""WITH {V.PANEL} SELECT account_id, segment, month_int, event, CAST(seasoning AS DOUBLE) AS seasoning, round(log_balance, 6) AS log_balance, CASE WHEN CAST(account_id AS BIGINT) % 5 = 0 THEN 1.0 ELSE round(balance_kda, 6) END AS weight
    FROM panel WHERE NOT (CAST(account_id AS BIGINT) % 7 = 0 AND month % 3 = 0)"""
)
def src16_typed_panel(spark, d):
    """The panel as text cells, some blank, and read back."""
    a = F.col("account_id").cast("long")
    text = V.account_panel(spark, d).select(
        "account_id", "segment", F.col("month_int").cast("string").alias("month_int"), F.concat(F.lit(" "), F.col("event").cast("string")).alias("event"), F.col("seasoning").cast("string").alias("seasoning"),
        F.when((a % 7 == 0) & (F.col("month") % 3 == 0), F.lit(" ")).otherwise(F.col("log_balance").cast("string")).alias("log_balance"), F.when(a % 5 == 0, F.lit("")).otherwise(F.col("balance_kda").cast("string")).alias("weight"),
    )
    return rounded(dumps.typed_panel(text, ["seasoning", "log_balance"], ["account_id", "segment"]))


@query(f"WITH {V.MACRO} SELECT series, month_int, round(value, 6) AS value, make_date(CAST((month_int + 1) // 12 AS INT), CAST((month_int + 1) % 12 + 1 AS INT), 15) AS available FROM macro_long WHERE month_int % 11 <> 0")
def src11_tidy_series(spark, d):
    """The macro series as text rows, some without a value, known on the 15th of the month after."""
    m = F.col("month_int")
    rows = V.macro_long(spark, d).select(
        "series", C.month_label(m).alias("ref_period"), F.when(m % 11 == 0, F.lit("")).otherwise(F.col("value").cast("string")).alias("value"), F.concat(C.month_label(m + 1), F.lit("-15")).alias("available_date")
    )
    return rounded(dumps.tidy_series(rows))


@query(
    f"""WITH {V.PANEL}, {V.PIT}, ends AS (SELECT account_id, min(CASE WHEN event = 1 THEN month_int END) AS event_month, max(month_int) AS last_month FROM panel GROUP BY 1),
    t AS (SELECT account_id, coalesce(close_mi, panel_end) AS month FROM acct WHERE event_mi IS NOT NULL)
    SELECT count(*) AS n_truth, count(*) FILTER (WHERE event_month <= month) AS n_found, count(*) FILTER (WHERE last_month > event_month) AS after_event, (SELECT count(*) FROM panel WHERE seasoning < 0) AS negative_seasoning,
        (SELECT count(money_market) FROM panel p LEFT JOIN pit USING (month_int)) AS filled, (SELECT count(*) FROM panel) AS n_rows FROM t LEFT JOIN ends ON t.account_id = ends.account_id"""
)
def va12_truth_checks(spark, d):
    """Accounts that closed or fell below the floor, against the panel's events."""
    monthly = panel.monthly(V.records(spark, d))
    known = panel.accounts(monthly, V.FLOOR).where("month_int = first_seen and event_mi is not null")
    end = monthly.agg(F.max("month_int").alias("end"))
    truth = known.crossJoin(F.broadcast(end)).select("account_id", F.when(F.col("last_seen") < F.col("end"), F.col("last_seen")).otherwise(F.col("end")).alias("month"))  # one row
    return panel.truth_checks(panel.build(V.records(spark, d), V.FLOOR, pit=V.point_in_time(spark, d)), truth, "money_market")


_STATES = "states AS (SELECT month_int, money_market, ntile(3) OVER (ORDER BY money_market, month_int) AS state FROM macro_month)"


def _states(spark, d):
    months = V.macro_long(spark, d).where("series = 'money_market'").select("month_int", F.col("value").alias("money_market"))
    return months.withColumn("state", F.ntile(3).over(Window.orderBy("money_market", "month_int")))  # a row a month


_SETS = """SELECT * FROM (VALUES ('base', 0.0, NULL::DOUBLE), ('up_200bp', 2.0, NULL), ('down_200bp', -2.0, NULL)) v UNION ALL SELECT 'adverse_start', 0.0, (SELECT max(r) FROM (SELECT avg(money_market) AS r FROM states GROUP BY state))"""


@query(
    f"WITH {V.MODEL}, {_STATES}, {_rolled(_SETS, _LAST).replace('sc AS (', 'sc(scenario, bump, start) AS (')}"
    " SELECT segment, h, scenario, round(A, 6) AS A, round(B, 6) AS B FROM rolled"
)
def ss2_scenario_set(spark, d):
    alive = panel.alive(V.model_rows(spark, d), ["segment"])
    return rounded(runoff.scenario_set(alive, _states(spark, d), V.HAZARD, V.HAZARD_B0, V.EROSION, V.EROSION_B0, 24, ["segment"]))


# --- frozen regimes, the chain of regimes, known months ahead --------------------------------------------------


def _rates(spark, d):
    """(month_int, x), computed once: bounds that are months' values must meet the same values again, to the last bit, and sums by month depend on the order of parts."""
    rows = V.macro_long(spark, d).where("series = 'money_market'").select("month_int", F.col("value").alias("x"))
    return spark.createDataFrame(rows.collect(), rows.schema)  # a row a month


_BOUNDS = f"""rates AS (SELECT month_int, money_market AS x FROM macro_month), v AS (SELECT list_sort(list(x)) AS v FROM rates WHERE month_int <= {V.CUTOFF}),
cuts AS (SELECT v[len(v) // 3 + 1] AS low, v[2 * len(v) // 3 + 1] AS high FROM v), states AS (SELECT month_int, x, CASE WHEN x < low THEN 0 WHEN x >= high THEN 2 ELSE 1 END AS state FROM rates CROSS JOIN cuts),
past AS (SELECT * FROM states WHERE month_int <= {V.CUTOFF}), led AS (SELECT state, lead(state) OVER (ORDER BY month_int) AS nxt FROM past)"""
_FILTER = f"""{_BOUNDS}, sc AS (SELECT avg(x) AS c, stddev_pop(x) AS s FROM past), prm AS (SELECT state, avg((x - c) / s) AS m, greatest(var_pop((x - c) / s), 1e-4) AS v FROM past CROSS JOIN sc GROUP BY 1),
mv AS (SELECT a.i, b.j, (count(l.state) + 1) / (sum(count(l.state)) OVER (PARTITION BY a.i) + 3) AS p FROM range(3) a(i) CROSS JOIN range(3) b(j) LEFT JOIN led l ON l.state = a.i AND l.nxt = b.j GROUP BY 1, 2),
dens AS (SELECT row_number() OVER (PARTITION BY state ORDER BY month_int) AS i, month_int, state, exp(-0.5 * (ln(2 * pi() * v) + ((x - c) / s - m) ** 2 / v)) AS b FROM rates CROSS JOIN sc CROSS JOIN prm),
wide AS (SELECT i, month_int, max(b) FILTER (state = 0) AS b0, max(b) FILTER (state = 1) AS b1, max(b) FILTER (state = 2) AS b2 FROM dens GROUP BY 1, 2),
mw AS (SELECT {", ".join(f"max(p) FILTER (i = {i} AND j = {j}) AS a{i}{j}" for i in range(3) for j in range(3))} FROM mv),
filt(i, month_int, p0, p1, p2) AS (
    SELECT i, month_int, b0 / (b0 + b1 + b2), b1 / (b0 + b1 + b2), b2 / (b0 + b1 + b2) FROM wide WHERE i = 1
    UNION ALL SELECT i, month_int, q0 / (q0 + q1 + q2), q1 / (q0 + q1 + q2), q2 / (q0 + q1 + q2) FROM (
        SELECT w.i, w.month_int, {", ".join(f"(p0 * a0{j} + p1 * a1{j} + p2 * a2{j}) * b{j} AS q{j}" for j in range(3))} FROM filt f JOIN wide w ON w.i = f.i + 1 CROSS JOIN mw)
)"""


def _posterior(spark, d):
    from ..operators import regimes

    rates = _rates(spark, d)
    return regimes.posterior_columns(regimes.filtered(rates, ["x"], regimes.tertile_parameters(rates, V.CUTOFF)), 3)


@query(f"WITH RECURSIVE {V.MACRO}, {_FILTER} SELECT month_int, round(p0, 6) AS regime_p0, round(p1, 6) AS regime_p1 FROM filt")
def ts10_causal_filter(spark, d):
    """Each month's regime probabilities by the months up to it, of parameters frozen at the cutoff."""
    return rounded(_posterior(spark, d))


@query(f"WITH RECURSIVE {V.PANEL}, {V.MACRO}, {_FILTER} SELECT account_id, p.month_int, round(coalesce(p0, 0), 6) AS regime_p0, round(coalesce(p1, 0), 6) AS regime_p1 FROM panel p LEFT JOIN filt f ON f.month_int = p.month_int + 3")
def jn7_regime_posterior(spark, d):
    """The filter's probabilities attached to the panel, three months late; the last months have none."""
    late = _posterior(spark, d).withColumn("month_int", F.col("month_int") - 3)
    return rounded(runoff.attach_posterior(V.account_panel(spark, d).select("account_id", "month_int"), late))


@query()
def jn7_regime_hazard(spark, d):
    """Coefficients of a hazard whose features hold the filtered posterior of a model frozen at the cutoff, fitted on the months up to it."""
    from ..operators import books, models, regimes

    rates = _rates(spark, d)
    frozen = regimes.fitted_parameters(rates, ["x"], V.CUTOFF)
    names = [f"regime_p{j}" for j in range(max(0, frozen.count() - 1))]
    rows = runoff.attach_posterior(V.model_rows(spark, d), regimes.posterior_columns(regimes.filtered(rates, ["x"], frozen), len(names) + 1))
    m = models.fit_hazard(rows.where(F.col("month_int") <= V.CUTOFF), books.HAZARD + names, 1e-3, 0.5)
    return rounded(spark.createDataFrame([*m.raw.items(), ("intercept", m.b0)], "feature string, coefficient double"))


_CHAIN = f"""WITH RECURSIVE {V.PANEL}, {V.MACRO}, {_BOUNDS}, mv AS (SELECT i, j, CASE WHEN sum(n) OVER (PARTITION BY i) > 0 THEN n / sum(n) OVER (PARTITION BY i) ELSE 0 END AS p FROM (
    SELECT a.i, b.j, count(l.state) AS n FROM range(3) a(i) CROSS JOIN range(3) b(j) LEFT JOIN led l ON l.state = a.i AND l.nxt = b.j GROUP BY 1, 2)),
hz AS (SELECT segment, {", ".join(f"-ln(greatest(1 - coalesce(avg(event) FILTER (state = {k}), 0), 1e-9)) AS r{k}" for k in range(3))} FROM panel p JOIN past s ON s.month_int = p.month_int GROUP BY 1),
g AS (SELECT segment, {", ".join(f"((SELECT p FROM mv WHERE i = {i} AND j = {j}) - {f'1 - r{i}' if i == j else '0'}) / 16 AS g{i}{j}" for i in range(3) for j in range(3))} FROM hz),
ser(segment, q, n, u0, u1, u2, v0, v1, v2) AS (
    SELECT segment, 0, 12, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE FROM g
    UNION ALL SELECT segment, q, n, u0 + t0, u1 + t1, u2 + t2, t0, t1, t2 FROM (
        SELECT s.segment, CASE WHEN n = 12 THEN q + 1 ELSE q END AS q, CASE WHEN n = 12 THEN 1 ELSE n + 1 END AS n, u0, u1, u2,
            {", ".join(f"(g{i}0 * CASE WHEN n = 12 THEN u0 ELSE v0 END + g{i}1 * CASE WHEN n = 12 THEN u1 ELSE v1 END + g{i}2 * CASE WHEN n = 12 THEN u2 ELSE v2 END) / CASE WHEN n = 12 THEN 1 ELSE n + 1 END AS t{i}" for i in range(3))}
        FROM ser s JOIN g ON g.segment = s.segment WHERE q < {16 * V.HORIZON} OR n < 12)
)"""


@query(_CHAIN + f" SELECT segment, CAST(q // 16 AS INT) AS h, round(CASE state WHEN 0 THEN u0 WHEN 1 THEN u1 ELSE u2 END, 6) AS B FROM ser JOIN past ON month_int = {V.CUTOFF} WHERE n = 12 AND q % 16 = 0")
def ro14_regime_chain(spark, d):
    from ..operators import regimes

    rates = _rates(spark, d)
    states = regimes.by_bounds(rates, regimes.tertile_bounds(rates, V.CUTOFF))
    return rounded(regimes.chain_survival(V.account_panel(spark, d), states, V.CUTOFF, V.HORIZON, ["segment"]))


@query()
def ml8_nested_evaluation(spark, d):
    """Levels, levels with the regime posterior, and with path features, chosen on a year of months and scored once on the last year."""
    from ..operators import books, models, regimes

    rates = _rates(spark, d)
    rows = features.path(V.model_rows(spark, d))
    cut = rows.agg(F.max("month_int")).first()[0] - 24
    frozen = regimes.fitted_parameters(rates, ["x"], cut)
    names = [f"regime_p{j}" for j in range(max(0, frozen.count() - 1))]
    rows = runoff.attach_posterior(rows, regimes.posterior_columns(regimes.filtered(rates, ["x"], frozen), len(names) + 1)).persist(StorageLevel.DISK_ONLY)
    more = ["bal_drawdown", "decline_streak", "bal_vol6"]
    families = {"base": books.HAZARD, "base+regime": books.HAZARD + names, "base+path": books.HAZARD + more, "base+regime+path": books.HAZARD + names + more}
    return rounded(models.nested_evaluation(rows, families, 12, 12, [1e-4, 1e-3, 1e-2, 1e-1], [0.0, 0.5, 1.0]), 4)


@query()
def ro9_fitted_errors(spark, d):
    """Error of each model's curve by segment, all of them fitted on the months up to a year after the cutoff: what was kept straight-line, a constant
    hazard, one by tenure alone, the chain of regimes, error correction, and the whole hazard with its erosion."""
    from ..operators import books

    return rounded(books.fitted_errors(V.model_rows(spark, d).persist(), _rates(spark, d), V.CUTOFF + 12, 6))


_DAYS = f"""n AS (SELECT CAST(day AS DATE) AS day, date_diff('day', DATE '1970-01-01', CAST(day AS DATE)) + {C.ISLAMIC_EPOCH} AS n FROM (SELECT unnest(generate_series(DATE '1997-02-01', DATE '1998-01-31', INTERVAL 1 DAY)) AS day)),
y AS (SELECT *, (30 * n + 10646) // {C.ISLAMIC_CYCLE} AS hy FROM n), hd AS (SELECT *, n - 354 * (hy - 1) - (3 + 11 * hy) // 30 AS hp FROM y),
cal AS (SELECT year(day) * 12 + month(day) - 1 - {V.CUTOFF} AS h, round(avg(CAST((11 * hp + 330) // 325 = 9 AS INT)), 4) AS ram FROM hd GROUP BY 1)"""


@query(
    f"""WITH {V.MODEL}, {_DAYS}, alive AS (SELECT *, CASE WHEN w = 0 THEN 1 ELSE w END AS wt FROM model_rows WHERE month_int = {V.CUTOFF} AND event = 0),
    hz AS (SELECT segment, account_id, wt, h, 1 / (1 + exp(-(-1.5 - 0.01 * (seasoning + h) - 0.3 * log_balance + 0.1 * money_market + 0.8 * ram))) AS p, -0.002 - 0.001 * money_market + 0.0001 * (seasoning + h) AS e FROM alive CROSS JOIN cal),
    paths AS (SELECT segment, wt, h, exp(sum(ln(1 - p)) OVER o) AS a, exp(sum(ln(1 - p)) OVER o) * exp(sum(e) OVER o) AS b FROM hz WINDOW o AS (PARTITION BY account_id ORDER BY h))
    SELECT segment, CAST(h AS INT) AS h, round(sum(wt * a) / sum(wt), 6) AS A, round(sum(wt * b) / sum(wt), 6) AS B FROM paths GROUP BY 1, 2 UNION ALL SELECT DISTINCT segment, 0, 1.0, 1.0 FROM alive"""
)
def ro3_known_months(spark, d):
    """The roll over the twelve months after the cutoff, whose shares of Ramadan the calendar knows."""
    months = macro.seasonal(spark, 1997, 1998).where(F.col("month_int").between(V.CUTOFF + 1, V.CUTOFF + 12)).orderBy("month_int")
    ahead = [float(r["ramadan_frac"]) for r in months.select("ramadan_frac").collect()]  # twelve months
    alive = V.model_rows(spark, d).where(f"month_int = {V.CUTOFF} and event = 0")
    return rounded(runoff.roll(alive, {**V.HAZARD, "ramadan_frac": 0.8}, V.HAZARD_B0, V.EROSION, V.EROSION_B0, 12, ["segment"], ahead={"ramadan_frac": ahead}))


@query(
    f"""{_PIT.replace("WITH ", "WITH ", 1)}, held AS (SELECT * FROM pits WHERE month_int > (SELECT max(month_int) FROM scored) - 12),
    c AS (SELECT segment, greatest(1e-12, least(1 - 1e-12, p)) AS p, y FROM held), g AS (SELECT segment, avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS nll, avg((p - y) ** 2) AS brier, avg(p) AS mean_p, avg(y) AS rate, count(*) AS n FROM c GROUP BY 1),
    r AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY p, key) AS r, count(*) OVER (PARTITION BY segment) AS n_all FROM held), t AS (SELECT segment, (10 * r - 1) // n_all AS bin, count(*) AS n, avg(p) AS mp, avg(y) AS my FROM r GROUP BY 1, 2),
    e AS (SELECT segment, sum(n * abs(mp - my)) / sum(n) AS ece FROM t GROUP BY 1), {_KS.replace("FROM pits", "FROM held")}
    SELECT g.segment, round(nll, 6) AS nll, round(brier, 6) AS brier, round(mean_p, 6) AS mean_p, round(rate, 6) AS rate, g.n, round(ece, 6) AS ece, round(ks, 6) AS pit_ks FROM g JOIN e ON g.segment = e.segment JOIN ks ON g.segment = ks.segment"""
)
def va14_holdout_record(spark, d):
    """The last twelve months' record by segment."""
    rows = V.scored(spark, d)
    last = rows.agg(F.max("month_int").alias("last"))
    held = rows.join(F.broadcast(last), F.col("month_int") > F.col("last") - 12).drop("last")  # one row
    record = validate.holdout_record(held, ["segment"], "key", validate.uniform(F.lit(0), F.col("account_id"), F.col("month_int")))
    return rounded(record.select("segment", "nll", "brier", "mean_p", "rate", "n", "ece", "pit_ks"))
