"""URL filters: rules on host suffixes and path prefixes, found by short hashes.

A URL is expanded into one expression per shape of the rule table (a number of
host labels and a length of path), which is far fewer than all its suffixes and
prefixes. Expressions and rules meet in an equi-join on the first 32 bits of
their SHA-256; the full digests then confirm, and the most exact rule wins.
Whether the rule side is broadcast is left to its measured size.

Only the shapes come to the driver: at most as many as there are pairs of label
count and path length among the rules, whatever the number of URLs.

Defined results: a null URL or one without `://` has an empty host and path,
fits no rule and gets the default verdict. Hosts are compared as written but
for A-Z; a port or user name is part of them. Repeated rows come back as often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.columns import ascii_lower

ALLOW, BLOCK = "allow", "block"
SHORT = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    parsed = F.when(F.contains(url, F.lit("://")), rest)
    host = F.regexp_extract(parsed, r"^([^/?#]*)", 1)
    path = F.regexp_extract(parsed, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def _labels(host: Column) -> Column:
    return F.split(host, r"\.")


def _shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """The distinct (host labels, path length) of the rules."""
    shape = rules.select(F.size(_labels(F.col("host"))).alias("n"), F.length("path").alias("m"))
    return sorted((row.n, row.m) for row in shape.distinct().collect())


def _expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """What a URL offers the rules, as an array of text."""
    kinds = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(m).alias("m")) for n, m in shapes])
    fitting = F.filter(
        kinds, lambda k: (k["n"] <= F.size(_labels(host))) & (k["m"] <= F.length(path))
    )
    return F.transform(
        fitting,
        lambda k: F.concat(
            F.array_join(F.slice(_labels(host), -k["n"], k["n"]), "."),
            F.substring(path, F.lit(1), k["m"]),
        ),
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """Per row `page_id`, `host`, `path`, the `rule` that won (or null) and the `verdict`.

    `rules` has `host`, `path` and `verdict`. The longest host and path win, then
    the longer host, then a block.
    """
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").na.drop()
    shapes = _shapes(rules)
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    itself = urls.select("*", F.lit(1).alias("_copies"), F.lit(None).alias("_win"))
    if shapes:
        digest = F.sha2("_expression", 256)
        offered = urls.select(
            "*", F.explode(_expressions(F.col("host"), F.col("path"), shapes)).alias("_expression")
        ).select("page_id", "host", "path", digest.alias("_digest"))
        known = rules.select(
            F.concat("host", "path").alias("_expression"), F.length("host").alias("_host"), "verdict"
        ).select(
            F.struct(F.length("_expression"), "_host", "verdict", "_expression").alias("_win"),
            digest.alias("_known"),
        )
        met = offered.withColumn("_short", F.substring("_digest", 1, SHORT)).join(
            known.withColumn("_short", F.substring("_known", 1, SHORT)), "_short"
        )
        confirmed = met.where(F.col("_digest") == F.col("_known"))
        itself = itself.withColumn("_win", F.lit(None).cast(known.schema["_win"].dataType))
        itself = itself.unionByName(
            confirmed.select("page_id", "host", "path", F.lit(0).alias("_copies"), "_win")
        )
    else:
        empty = "struct<n:int,_host:int,verdict:string,_expression:string>"
        itself = itself.withColumn("_win", F.lit(None).cast(empty))
    best = itself.groupBy("page_id", "host", "path").agg(
        F.sum("_copies").alias("_copies"), F.max("_win").alias("_win")
    )
    each = best.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return each.select(
        "page_id",
        "host",
        "path",
        F.col("_win._expression").alias("rule"),
        F.coalesce("_win.verdict", F.lit(default)).alias("verdict"),
    )
