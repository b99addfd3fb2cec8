"""URL filter by prefix rules: a sorted sweep with a stack of the rules that are open.

A key is the reversed host (``com.example.www``), a zero byte, and the path. Each rule is the interval of all keys that
begin with its own; intervals of rules nest or are disjoint. A rule also holds for subdomains, so a URL asks with one key
for its host and for each parent domain. Keys and interval ends are sorted together by ranges; the running number of
open intervals is the height of the stack, and the top is the last rule that was opened at this height. What is open at
the start of a range comes from one small table of the last rule at each height of each range.

Only DataFrame functions. Each distinct URL is judged once. A null URL, or one without ``://``, has an empty host and
path and fits no rule; of two rules with the same key ``block`` wins; a result column replaces one of the same name,
other columns are dropped; repeated rows stay repeated; empty tables give an empty result, or no rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.sources.shared import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def _reversed_host(host):
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _key(reversed_host, path):
    return F.concat(reversed_host, F.lit("\0"), path).cast("binary")


def split_url(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    return urls.withColumns(
        {
            "host": F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER),
            "path": F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit("")),
        }
    )


def best_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) for distinct ``urls`` (url, host, path) that fit any of ``rules`` (host, path, verdict)."""
    opened = (
        rules.select("host", "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            _key(_reversed_host(F.col("host")), F.col("path")).alias("key"),
            F.struct(F.concat("host", "path").alias("rule"), "verdict").alias("rule"),
        )
    )
    labels = F.reverse(F.split("host", r"\."))
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, 1, n), "."))
    asked = urls.where("host <> ''").select("url", "path", F.explode(parents).alias("parent")).select(
        _key(F.col("parent"), F.col("path")).alias("key"), "url"
    )
    no_url, no_rule = F.lit(None).cast("string").alias("url"), F.lit(None).cast(opened.schema["rule"].dataType).alias("rule")
    # 0xFF is in no UTF-8 text, so it ends the interval of all keys with a prefix.
    events = (
        opened.select("key", F.lit(1).alias("step"), no_url, "rule")
        .unionByName(opened.select(F.expr("key || X'FF'").alias("key"), F.lit(-1).alias("step"), no_url, no_rule))
        .unionByName(asked.select("key", F.lit(0).alias("step"), "url", no_rule))
    )
    # At one key the rule opens first; the URL as the last field splits a key that many URLs have.
    order = ["key", F.desc("step"), "url"]
    ranged = stored(events.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "url-sweep")

    here = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    heights = ranged.groupBy("range").agg(F.sum("step").alias("change")).select("range", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("height_before"))

    def swept(some: DataFrame) -> DataFrame:
        return some.join(F.broadcast(heights), "range").withColumn("height", F.col("height_before") + F.sum("step").over(here))

    level = Window.partitionBy("range", "height").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    topped = swept(ranged).withColumn("top", F.last("rule", True).over(level)).where("url is not null and height > 0")
    # Rules still open at the start of a range: for each height the last one opened in an earlier range.
    earlier = Window.partitionBy("height").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    opened_in = swept(ranged.where("step <> 0")).where("step = 1").groupBy("range", "height").agg(F.max_by("rule", "key").alias("rule"))
    slots = heights.where("height_before > 0").select("range", F.explode(F.sequence(F.lit(1).cast("long"), "height_before")).alias("height"))
    carried = (
        slots.join(opened_in, ["range", "height"], "full")
        .withColumn("carried", F.last("rule", True).over(earlier))
        .where("carried is not null")
        .select("range", "height", "carried")
    )
    found = topped.join(carried, ["range", "height"], "left").withColumn("rule", F.coalesce("top", "carried"))
    longest = F.struct(F.length("rule.rule").alias("length"), F.col("rule.rule").alias("rule"), F.col("rule.verdict").alias("verdict"))
    return found.groupBy("url").agg(F.max(longest).alias("best")).select("url", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", url: str = "url", keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keys``, the URL, host, path, the longest fitting rule and its verdict, or ``otherwise``."""
    asked = split_url(pages.select(*keys, F.col(url).alias("url")))
    # Stored, so that only plain shuffles are joined, which Spark splits where one URL has very many rows.
    best = stored(best_rules(asked.where("url is not null").select("url", "host", "path").distinct(), rules), "best-rules")
    return asked.join(best, "url", "left").select(*keys, "url", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))
