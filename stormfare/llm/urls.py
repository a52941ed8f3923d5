"""URL rules by hash prefix, as in lists of unsafe sites.

Every URL is expanded into the (host suffix, path prefix) expressions whose
shape some rule has: so many host labels, so many path characters. Expressions
meet rules on the first ``PREFIX`` hex digits of their SHA-256, equal full
digests confirm, and the longest rule wins; among equally long ones the longer
host, then ``block``. Only distinct shapes of rules reach the driver.

Defined results: a null URL, or one without ``://``, has an empty host and path
and gets the default verdict; rules given twice count once; repeated pages each
get their row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stormfare.llm.text import only

PREFIX = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), SPLIT, 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), SPLIT, 2)


def _labels(name: str) -> Column:
    return F.size(F.split(F.col(name), r"\."))


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules (action, host, path) with their expression, digest and shape."""
    df = only(rules, "action", "host", "path").select(
        "action", F.translate("host", UPPER, LOWER).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
    ).filter(F.col("rule_host") != "")
    return df.select(
        "action", "rule_host", F.concat("rule_host", "rule_path").alias("rule"),
        _labels("rule_host").alias("labels"), F.length("rule_path").alias("chars"),
    ).withColumn("digest", F.sha2(F.col("rule"), 256)).withColumn(
        "prefix", F.substring("digest", 1, PREFIX)
    )


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
               default: str = "allow") -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    ready = prepared_rules(rules)
    shapes = sorted((r["labels"], r["chars"]) for r in ready.select("labels", "chars").distinct().collect())
    taken = only(pages, key, url).withColumnRenamed(url, "_url")
    parts = {"host": host(F.col("_url")), "path": path(F.col("_url"))}
    if shapes:
        listed = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(c).alias("c")) for n, c in shapes])
        expressions = (
            taken.select("_url").distinct().withColumns(parts)
            .withColumn("_labels", _labels("host"))
            .withColumn("_shape", F.explode(listed))
            .filter((F.col("_labels") >= F.col("_shape.n")) & (F.length("path") >= F.col("_shape.c")))
            .withColumn("expression", F.concat(
                F.expr("substring_index(host, '.', -_shape.n)"), F.expr("substring(path, 1, _shape.c)")
            ))
            .select("_url", F.sha2(F.col("expression"), 256).alias("_digest"))
            .withColumn("prefix", F.substring("_digest", 1, PREFIX))
        )
        confirmed = expressions.join(ready, "prefix").filter(F.col("_digest") == F.col("digest"))
        rank = F.struct(
            F.length("rule").alias("chars"), F.length("rule_host").alias("host_chars"),
            (F.col("action") == "block").alias("blocks"), F.col("rule"), F.col("action"),
        )
        best = confirmed.groupBy("_url").agg(F.max(rank).alias("_best"))
    else:
        best = taken.select("_url", F.lit(None).cast("struct<rule:string,action:string>").alias("_best")).limit(0)
    return taken.join(best, "_url", "left").withColumns(parts).select(
        F.col(f"`{key}`"), "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.action", F.lit(default)).alias("verdict"),
    )
