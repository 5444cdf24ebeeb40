"""URL rules: host-suffix and path-prefix expressions, joined with rules on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Rule tables of up to so many rows are broadcast, about 100 bytes each; larger ones are shuffled.
BROADCAST_RULES = 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased. Path: then up to ? # or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _prefix(digest: Column) -> Column:
    return F.conv(F.substr(digest, F.lit(1), F.lit(8)), 16, 10).cast("long")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict; columns of those names are replaced.

    rules: host, path, verdict. A rule fits its host and all subdomains where the URL's path starts with the
    rule's. The longest rule (host and path together, then host) wins, of equal ones `block` before `allow`.
    No rule: rule null, verdict `default`. A null URL or one without :// has an empty host and path, which
    only a rule of an empty host fits. Rules with a null part fit nothing. Rows of pages stay as they are.

    Each different URL becomes its expressions: suffixes of the host and prefixes of the path, of as many labels and
    characters as some rule has together. They meet the rules on 32 bits of SHA-256; then the whole digest must agree.
    A URL of many pages is judged once, and its verdict does not meet them in one task.
    """
    rules = rules.where("host is not null and path is not null and verdict is not null")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
    n = rules.count()
    near = F.broadcast if n <= BROADCAST_RULES else (lambda df: df)
    shapes = rules.groupBy(F.size(F.split("host", r"\.")).alias("labels")).agg(F.collect_set(F.length("path")).alias("lengths"))
    rules = rules.select(
        _prefix(_digest(F.col("host"), F.col("path"))).alias("prefix"), _digest(F.col("host"), F.col("path")).alias("rule_digest"),
        F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), F.concat("host", "path").alias("rule"), "verdict").alias("best"),
    )
    host, path = host_and_path(F.col("page_url"))
    urls = pages.select(F.col(f"`{url}`").alias("page_url")).groupBy("page_url").agg(F.count("*").alias("copies"))
    urls = urls.select("page_url", "copies", host.alias("h"), path.alias("p"))
    # only suffixes of as many labels as a rule's host has are made, so a host of very many labels costs no more than its length
    counts = [r["labels"] for r in shapes.select("labels").collect()]  # at most as many as the longest rule's host has labels
    labels = F.array_intersect(F.sequence(F.lit(1), F.size(F.split("h", r"\."))), F.array(*map(F.lit, sorted(counts))).cast("array<int>"))
    start = F.transform(F.filter("lengths", lambda n: n <= F.length("p")), lambda n: F.substr("p", F.lit(1), n))
    made = urls.select("page_url", "copies", "h", "p", F.explode(labels).alias("labels")).join(near(shapes), "labels")
    made = made.select("page_url", "copies", F.expr("substring_index(h, '.', -labels)").alias("host_part"), F.explode(start).alias("path_part"))
    made = made.withColumn("digest", _digest(F.col("host_part"), F.col("path_part"))).withColumn("prefix", _prefix(F.col("digest")))
    helper = common.prefix(pages.columns, "judged_")
    key, found_best = f"{helper}url", f"{helper}best"
    best = made.join(near(rules), "prefix").where("digest = rule_digest").groupBy(F.col("page_url").alias(key)).agg(F.max("best").alias(found_best), F.max("copies").alias("copies"))
    best = common.stored(best, "judged-urls")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    own_host, own_path = host_and_path(F.col(f"`{url}`"))
    found = common.look_up(pages.withColumn(key, F.col(f"`{url}`")), best, [key], "copies", F.monotonically_increasing_id())
    return found.select(
        *kept, own_host.alias("host"), own_path.alias("path"), F.col(found_best)["rule"].alias("rule"),
        F.coalesce(F.col(found_best)["verdict"], F.lit(default)).alias("verdict"),
    )
