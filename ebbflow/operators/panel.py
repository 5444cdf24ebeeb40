"""From snapshot records to the account-month survival panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def in_scope(records: DataFrame, keywords: list[str] | None = None, require_resources: bool = True) -> DataFrame:
    """Without asset rows (ressources holds REMPLOI), and of labels that hold one of the keywords, if any are given."""
    if require_resources:
        records = records.where(~F.coalesce(C.plain_upper(F.col("ressources")).contains("REMPLOI"), F.lit(False)))
    if keywords:
        label = C.plain_upper(F.coalesce("rubrique", F.lit("")))
        records = records.where(F.exists(F.array(*[F.lit(k.upper()) for k in keywords]), lambda k: label.contains(k)))
    return records


def account_key(*parts: str) -> Column:
    """Parts joined by |; a missing one reads None."""
    return F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("None")) for p in parts])


def monthly(records: DataFrame) -> DataFrame:
    """One row per account and month: balances summed (null as 0), labels of the earliest month, earliest known opening.

    records: account_id, month_int, ctrvl_kda, segment, open_month. Rows are dealt out by account once; every
    window and grouping by account after it uses that.
    """
    dealt = records.repartition("account_id")
    return dealt.groupBy("account_id", "month_int").agg(
        F.sum(F.coalesce("ctrvl_kda", F.lit(0.0))).alias("balance_kda"), F.min("segment").alias("segment"), F.min("open_month").alias("open_month")
    )


def accounts(months: DataFrame, floor: float = 0.0, bounds: tuple[int, int] | None = None) -> DataFrame:
    """Per account-month row: the account's first_seen, last_seen, open_mi, end_mi, event_mi, event_kind, left_truncated, bad_open.

    bounds: the panel's first and last month, if months are only some of its accounts.
    """
    own = Window.partitionBy("account_id")
    if bounds is None:
        ends = months.agg(F.min("month_int").alias("panel_start"), F.max("month_int").alias("panel_end"))
        rows = months.crossJoin(F.broadcast(ends))  # one row
    else:
        rows = months.withColumns({"panel_start": F.lit(bounds[0]), "panel_end": F.lit(bounds[1])})
    rows = rows.withColumns({
        "first_seen": F.min("month_int").over(own), "last_seen": F.max("month_int").over(own),
        "known_open": F.min("open_month").over(own), "segment": F.min_by("segment", "month_int").over(own),
        "floor_mi": F.min(F.when((F.col("balance_kda") < floor) & F.lit(floor > 0), F.col("month_int"))).over(own),
    })
    rows = rows.withColumn("close_mi", F.when(F.col("last_seen") < F.col("panel_end"), F.col("last_seen")))
    rows = rows.withColumn("event_mi", F.least("floor_mi", "close_mi"))
    first_or_open = F.coalesce("known_open", "first_seen")
    return rows.withColumns({
        "end_mi": F.coalesce("event_mi", "last_seen"), "open_mi": F.least(first_or_open, F.col("first_seen")),
        "bad_open": (first_or_open > F.col("first_seen")).cast("int"), "left_truncated": (F.least(first_or_open, F.col("first_seen")) < F.col("panel_start")).cast("int"),
        "event_kind": F.when(F.col("event_mi").isNull(), "censored").when(F.col("event_mi") == F.col("floor_mi"), "floor").otherwise("closure"),
    }).drop("open_month", "known_open", "floor_mi", "close_mi")


def build(records: DataFrame, floor: float = 0.0, carry_gaps: bool = True, pit: DataFrame | None = None) -> DataFrame:
    """The panel: every month from first seen to the event or last seen, gaps carried forward, no row after the event.

    pit: macro columns by month_int, broadcast (a row a month); a month that it lacks has nulls.
    """
    rows = from_months(monthly(records), floor, carry_gaps)
    return rows if pit is None else rows.join(F.broadcast(pit), "month_int", "left")


def from_months(months: DataFrame, floor: float = 0.0, carry_gaps: bool = True, bounds: tuple[int, int] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The panel of monthly() rows, with the columns of accounts() in keep.

    Each row reaches to the month before the account's next one, so gaps fill without a join.
    """
    own = Window.partitionBy("account_id").orderBy("month_int")
    rows = accounts(months, floor, bounds).withColumn("next", F.lead("month_int").over(own)).where("month_int <= end_mi")
    if carry_gaps:
        until = F.least(F.coalesce(F.col("next") - 1, F.col("end_mi")), F.col("end_mi"))
        rows = rows.withColumn("month_int", F.explode(F.sequence("month_int", until)))
    month = F.col("month_int")
    return rows.select(
        "account_id", "month_int", F.floor(month / 12).cast("int").alias("year"), (month % 12 + 1).alias("month"),
        F.coalesce((month == F.col("event_mi")).cast("int"), F.lit(0)).alias("event"), (month - F.col("open_mi")).alias("seasoning"),
        F.log1p(F.greatest("balance_kda", F.lit(0.0))).alias("log_balance"), "balance_kda", (month % 12 + 1).alias("cal_month"), "segment", *keep,
    )


def summary(records: DataFrame, floor: float = 0.0) -> DataFrame:
    """Accounts, events by kind, censored, left-truncated and clamped openings, by segment and over all (segment null)."""
    rows = accounts(monthly(records), floor).where("month_int = first_seen")
    when = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return rows.rollup("segment").agg(
        F.count("*").alias("n_accounts"), F.sum(F.col("end_mi") - F.col("first_seen") + 1).alias("n_person_months"),
        when(F.col("event_kind") == "floor").alias("events_floor"), when(F.col("event_kind") == "closure").alias("events_closure"),
        when(F.col("event_kind") == "censored").alias("censored"), F.sum("left_truncated").alias("left_truncated"), F.sum("bad_open").alias("bad_open"),
    )


def alive(panel: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Each account's last row where that is the last month of the panel (or of its groups) and no event."""
    by = by or []
    last = panel.groupBy(*by).agg(F.max("month_int").alias("last_month"))
    rows = panel.join(F.broadcast(last), by) if by else panel.crossJoin(F.broadcast(last))
    return rows.where("month_int = last_month and event = 0").drop("last_month")


def behavioral(panel: DataFrame, catalogue: DataFrame, min_rows: int, min_months: int) -> DataFrame:
    """Per segment rows, months and the reason why its book is skipped (null: it is run)."""
    counts = panel.groupBy("segment").agg(F.count("*").alias("n_rows"), F.countDistinct("month_int").alias("n_months"))
    known = counts.join(F.broadcast(catalogue), "segment", "left")
    reason = F.when(~F.coalesce("behavioral", F.lit(False)), "not behavioral").when(F.col("n_rows") < min_rows, "too few rows")
    return known.select("segment", "n_rows", "n_months", reason.when(F.col("n_months") < min_months, "too few months").alias("skipped"))


def realized(panel: DataFrame, cutoff: int, horizon: int) -> DataFrame:
    """Share of the cohort's balance h months after the cutoff, by segment: the cohort's accounts that are absent count 0.

    The cohort is every account with a row at the cutoff, events included.
    """
    cohort = panel.where(F.col("month_int") == cutoff).select("account_id", "segment", F.col("balance_kda").alias("b0"))
    later = panel.where(F.col("month_int").between(cutoff, cutoff + horizon)).select("account_id", (F.col("month_int") - cutoff).alias("h"), "balance_kda")
    base = cohort.groupBy("segment").agg(F.sum("b0").alias("total"))
    sums = cohort.join(later, "account_id").groupBy("segment", "h").agg(F.sum("balance_kda").alias("kept"))
    grid = base.withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(horizon))))
    share = F.coalesce("kept", F.lit(0.0)) / F.when(F.col("total") != 0, F.col("total")).otherwise(1e-9)
    return grid.join(sums, ["segment", "h"], "left").select("segment", "h", share.alias("realized"))


def truth_checks(panel: DataFrame, truth: DataFrame, macro_column: str) -> DataFrame:
    """One row: events of truth (account_id, month) found at or before their month, rows after an event, negative seasoning, months filled."""
    ends = panel.groupBy("account_id").agg(F.min(F.when(F.col("event") == 1, F.col("month_int"))).alias("event_month"), F.max("month_int").alias("last_month"))
    found = truth.join(ends, "account_id", "left").agg(
        F.count("*").alias("n_truth"), F.count(F.when(F.col("event_month") <= F.col("month"), 1)).alias("n_found"),
        F.count(F.when(F.col("last_month") > F.col("event_month"), 1)).alias("after_event"),
    )
    rows = panel.agg(F.count(F.when(F.col("seasoning") < 0, 1)).alias("negative_seasoning"), F.count(macro_column).alias("filled"), F.count("*").alias("n_rows"))
    return found.crossJoin(rows)
