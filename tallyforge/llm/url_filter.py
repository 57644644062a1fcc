"""URL allow and block rules by hashed host-suffix and path-prefix expressions.

Every URL is expanded into the expressions a rule could have: each suffix of its host's labels
with each prefix of its path of a length that some rule has. Expressions meet rules in an
equi-join on the first bytes of a digest, the whole digest confirms, and the longest rule wins.
All of it is DataFrame expressions.
"""

from __future__ import annotations

import string

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

PREFIX_HEX = 8
#: Rules up to this many rows (under 100 bytes each after hashing) are broadcast, more are shuffled.
BROADCAST_RULES = 200_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(urls: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``key``, host, path, rule (host + path, else null) and verdict of every row of ``urls``.

    ``rules`` has host, path and action (allow or block). A rule fits its host and all
    subdomains, if the path starts with its own. The longest rule (host and path together, then
    host) wins; of two actions for the same host and path, block wins; without a rule the
    verdict is ``default``. Rules with a null part never fit. A null url, or one without
    ``://``, has an empty host and path. Rows come back as often as they were there, with null
    keys too. Other columns of ``urls`` are not read, so their names cannot clash; empty tables
    give empty results, or the default where only the rules are empty.

    One shuffle of one row per URL: expanded rows are merged before it. A hot host or URL is no
    hot key, as rows are grouped by key and URL, and equal rows merge before the shuffle.
    """
    known = (
        rules.where("host is not null and path is not null and action is not null")
        .groupBy("host", "path").agg(F.max("action").alias("action"))
        .select(
            _digest(F.col("host"), F.col("path")).alias("rule_digest"),
            F.struct(
                (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
                F.concat("host", "path").alias("rule"), F.col("action"),
            ).alias("found"),
            F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_size"),
        )
    )
    reach = known.agg(F.count("*"), F.coalesce(F.max("labels"), F.lit(0)), F.sort_array(F.collect_set("path_size"))).first()
    table = known.groupBy(F.substring("rule_digest", 1, PREFIX_HEX).alias("rule_prefix")).agg(F.collect_list(F.struct("rule_digest", "found")).alias("near"))
    if reach[0] <= BROADCAST_RULES:
        table = F.broadcast(table)

    labels = F.slice(F.split("host", r"\."), -F.least(F.size(F.split("host", r"\.")), F.lit(reach[1] or 1)), F.lit(reach[1] or 1))
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size("labels")), lambda k: F.array_join(F.slice("labels", k, F.size("labels")), ".")
    )
    sizes = F.filter(F.array(*[F.lit(n) for n in reach[2]]).cast("array<int>"), lambda n: n <= F.length("path"))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(sizes, lambda n: _digest(h, F.substring(F.col("path"), F.lit(1), n)))))
    expanded = (
        urls.select(F.col(key).alias("tf_key"), F.col(url).alias("tf_url"))
        .select("*", host_of(F.col("tf_url")).alias("host"), path_of(F.col("tf_url")).alias("path"))
        .withColumn("labels", labels)
        .withColumn("expressions", expressions)
        .select("tf_key", "tf_url", "host", "path", F.greatest(F.size("expressions"), F.lit(1)).alias("times"), F.explode_outer("expressions").alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    )
    confirmed = F.filter("near", lambda r: r["rule_digest"] == F.col("digest"))
    met = expanded.join(table, F.col("prefix") == F.col("rule_prefix"), "left").withColumn("found", F.get(confirmed, F.lit(0))["found"])
    best = met.groupBy("tf_key", "tf_url").agg(
        F.first("host").alias("host"), F.first("path").alias("path"),
        F.max("found").alias("found"), (F.count("*") / F.first("times")).cast("int").alias("rows"),
    )
    return best.select(
        F.col("tf_key").alias(key), "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.action", F.lit(default)).alias("verdict"), F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("tf_row"),
    ).drop("tf_row")
