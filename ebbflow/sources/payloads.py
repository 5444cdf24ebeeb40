"""Rows out of payloads: JSON indicators, SDMX messages, quotes within pages and price sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OBS = "map<string,array<string>>"
_SDMX = (
    "struct<data: struct<structures: array<struct<dimensions: struct<observation: array<struct<id: string, values: array<struct<id: string, value: string>>>>>>>, "
    f"dataSets: array<struct<series: map<string,struct<observations: {_OBS}>>, observations: {_OBS}>>>>"
)


def sdmx(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """SDMX-JSON to (period, value) with the other columns. Observations are under series or flat; 2015-M01 reads 2015-01."""
    rest = [c for c in payloads.columns if c != column]
    rows = payloads.select(*rest, F.from_json(column, _SDMX).alias("m"))
    dims = F.element_at(rows["m.data.structures"], 1)["dimensions"]["observation"]
    times = F.get(F.filter(dims, lambda d: d["id"] == "TIME_PERIOD"), F.lit(0))["values"]
    data = F.element_at(rows["m.data.dataSets"], 1)
    flat = F.coalesce(data["observations"], F.create_map().cast(_OBS))
    maps = F.concat(F.transform(F.map_values(F.coalesce(data["series"], F.create_map().cast(f"map<string,struct<observations: {_OBS}>>"))), lambda s: s["observations"]), F.array(flat))
    rows = rows.select(*rest, times.alias("times"), F.explode(maps).alias("obs")).select(*rest, "times", F.explode("obs"))
    place = F.element_at(F.split("key", ":"), -1).try_cast("int")
    period = F.get("times", place)
    period = F.regexp_replace(F.coalesce(period["id"], period["value"]), r"^(\d{4})-M(\d{2})$", "$1-$2")
    return rows.select(*rest, period.alias("period"), F.get("value", F.lit(0)).try_cast("double").alias("value")).where("value is not null and period is not null")


def indicator(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """[{header}, [{date, value}, ...]] to (period, value), without nulls."""
    rest = [c for c in payloads.columns if c != column]
    rows = payloads.select(*rest, F.explode(F.from_json(F.get_json_object(column, "$[1]"), "array<struct<date: string, value: double>>")).alias("x"))
    return rows.select(*rest, F.col("x.date").alias("period"), F.col("x.value").alias("value")).where("value is not null")


def quotes(pages: DataFrame, column: str = "html") -> DataFrame:
    """Daily quotes within page text: day, and the mean of buying and selling rates, parallel, official and, where given, usd."""
    rest = [c for c in pages.columns if c != column]
    found = pages.select(*rest, F.explode(F.regexp_extract_all(F.col(column), F.lit(r'(\{[^{}]*"date"[^{}]*\})'), 1)).alias("q"))
    mid = lambda a, b: (F.get_json_object("q", f"$.{a}").try_cast("double") + F.get_json_object("q", f"$.{b}").try_cast("double")) / 2
    rows = found.select(*rest, F.get_json_object("q", "$.date").try_cast("date").alias("day"), mid("buyRate", "sellRate").alias("parallel"), mid("officialBuyRate", "officialSellRate").alias("official"), mid("usdBuyRate", "usdSellRate").alias("usd"))
    return rows.where("day is not null and parallel > 0 and official > 0")


def price_sheet(rows: DataFrame, period: str, price: str) -> DataFrame:
    """Rows whose period reads 2015M01 to (period, value)."""
    return rows.where(F.col(period).rlike(r"^\d{4}M\d{2}$")).select(F.regexp_replace(period, "M", "-").alias("period"), F.col(price).try_cast("double").alias("value")).where("value is not null")
