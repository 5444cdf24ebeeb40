"""Macro series: long and wide tables, publication lags, as-of join, calendars and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def year_on_year(long: DataFrame, series: str, name: str) -> DataFrame:
    """long (series, month_int, value) of one series as its change on 12 months before, where both months exist."""
    own = long.where(F.col("series") == series)
    before = own.select((F.col("month_int") + 12).alias("month_int"), F.col("value").alias("before"))
    return own.join(before, "month_int").select(F.lit(name).alias("series"), "month_int", F.round(F.col("value") / F.col("before") - 1, 6).alias("value"))


def wide(long: DataFrame, names: list[str], start: int, end: int) -> DataFrame:
    """A row for each month from start to end, a column for each series; null where it has no value."""
    spine = long.sparkSession.range(start, end + 1).select(F.col("id").cast("int").alias("month_int"))
    values = long.groupBy("month_int").pivot("series", names).agg(F.first("value"))
    return spine.join(values, "month_int", "left")


def lagged(long: DataFrame, lags: dict[str, int], names: list[str], start: int, end: int) -> DataFrame:
    """wide() of what was published: at month m a series has its value of month m - lag, and nothing carried forward."""
    shift = F.coalesce(F.create_map(*[F.lit(x) for kv in lags.items() for x in kv])[F.col("series")], F.lit(0)) if lags else F.lit(0)
    return wide(long.withColumn("month_int", (F.col("month_int") + shift).cast("int")), names, start, end)


def as_of(points: DataFrame, values: DataFrame, by: list[str]) -> DataFrame:
    """points (by, at) with the value of the latest row of values (by, available, value) whose available <= at.

    By union and a running last value, so it is one shuffle and one sort by series, with no pairs.
    """
    rows = points.select(*by, "at", F.lit(1).alias("is_point"), F.lit(None).cast("double").alias("value"))
    both = rows.unionByName(values.select(*by, F.col("available").alias("at"), F.lit(0).alias("is_point"), "value"))
    past = Window.partitionBy(*by).orderBy("at", "is_point").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("value", F.last("value", ignorenulls=True).over(past)).where("is_point = 1").drop("is_point")


def event_months(events: DataFrame) -> DataFrame:
    """Months of event intervals (row_no, start, end, state, severity); of overlapping ones the later row wins."""
    months = events.withColumn("month_int", F.explode(F.sequence("start", "end")))
    return months.groupBy("month_int").agg(F.max_by("state", "row_no").alias("regime_state"), F.max_by("severity", "row_no").alias("severity"))


def seasonal(spark, start_year: int, end_year: int) -> DataFrame:
    """Month by month: share and days of Ramadan, both Eid flags, July-August flag."""
    days = spark.sql(f"select explode(sequence(date'{start_year}-01-01', date'{end_year}-12-31')) as day")
    _, month, day = C.islamic(F.col("day"))
    rows = days.select(C.month_of(F.col("day")).alias("month_int"), month.alias("hm"), day.alias("hd"))
    ramadan = F.when(F.col("hm") == 9, 1).otherwise(0)
    flag = lambda m, d: F.max(F.when((F.col("hm") == m) & (F.col("hd") == d), 1).otherwise(0))
    return rows.groupBy("month_int").agg(
        F.round(F.avg(ramadan), 4).alias("ramadan_frac"), F.sum(ramadan).alias("ramadan_days"), flag(10, 1).alias("eid_fitr"), flag(12, 10).alias("eid_adha"),
        F.max((F.col("month_int") % 12 + 1).isin(7, 8).cast("int")).alias("is_summer_vacation"),
    )


def causal_tertile(series: DataFrame, least: int = 24) -> DataFrame:
    """series (series_id, month_int, value) with low, mid or high against the tertiles of its history so far, itself included.

    Null for the first `least` - 1 values. History is of one series: a few hundred months.
    """
    past = Window.partitionBy("series_id").orderBy("month_int").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = series.withColumn("past", F.sort_array(F.collect_list("value").over(past)))
    n = F.size("past")
    low, high = (F.element_at("past", (F.floor(k * n / 3) + 1).cast("int")) for k in (1, 2))
    state = F.when(n < least, None).when(F.col("value") < low, "low").when(F.col("value") >= high, "high").otherwise("mid")
    return rows.select("series_id", "month_int", "value", state.alias("tertile"))


def identifiability(series: DataFrame) -> DataFrame:
    """Per series: n, distinct values, min, max, population deviation, changes and the longest run without one."""
    own = Window.partitionBy("series_id").orderBy("month_int")
    rows = series.withColumn("before", F.lag("value").over(own))
    changed = F.when(F.col("before").isNull() | (F.col("before") != F.col("value")), 1).otherwise(0)
    rows = rows.withColumn("changed", changed).withColumn("run", F.sum("changed").over(own))
    longest = rows.groupBy("series_id", "run").count().groupBy("series_id").agg(F.max("count").alias("longest_flat"))
    stats = rows.groupBy("series_id").agg(
        F.count("*").alias("n"), F.countDistinct(F.round("value", 6)).alias("n_distinct"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.stddev_pop("value").alias("std"), (F.sum("changed") - 1).alias("n_changes"),
    )
    return stats.join(longest, "series_id")


def gate(stats: DataFrame) -> DataFrame:
    """What identifiability() says of a policy rate and a market rate: stepwise, and varied enough to fit on."""
    return stats.select(
        "series_id", (F.col("n_distinct") <= 5).alias("stepwise"), ((F.col("n_distinct") >= 30) & (F.col("std") > 0.2)).alias("identifiable"), (F.col("std") < 0.15).alias("flat")
    )


def drawdown(series: DataFrame) -> DataFrame:
    """(peak - value) / peak against the running maximum, 0 where that isn't positive."""
    past = Window.partitionBy("series_id").orderBy("month_int").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    peak = F.max("value").over(past)
    return series.select("series_id", "month_int", F.when(peak > 0, (peak - F.col("value")) / peak).otherwise(0.0).alias("drawdown"))


def depreciation(series: DataFrame, back: int = 3) -> DataFrame:
    """Change on `back` observations before, or on the first."""
    own = Window.partitionBy("series_id").orderBy("month_int")
    old = F.coalesce(F.lag("value", back).over(own), F.first("value").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return series.select("series_id", "month_int", F.when(old != 0, (F.col("value") - old) / old).otherwise(0.0).alias("depreciation"))


def monthly_premium(quotes: DataFrame) -> DataFrame:
    """Daily quotes (day, parallel, official, usd) to monthly means and the premium of the means, in percent."""
    rows = quotes.groupBy(C.month_of(F.col("day")).alias("month_int")).agg(*[F.avg(c).alias(c) for c in ("parallel", "official", "usd")])
    premium = F.round((F.col("parallel") / F.col("official") - 1) * 100, 2)
    return rows.select("month_int", *[F.round(c, 2).alias(c) for c in ("parallel", "official", "usd")], premium.alias("premium_pct"))


def coverage(wide_rows: DataFrame, names: list[str], start: int, end: int) -> DataFrame:
    """Months of a window in which each column has a value."""
    inside = wide_rows.where(F.col("month_int").between(start, end))
    pairs: list[Column] = [F.struct(F.lit(n).alias("series"), F.count(n).alias("months")) for n in names]
    return inside.agg(F.array(*pairs).alias("a")).select(F.explode("a").alias("x")).select("x.series", "x.months")
