"""URL filters by hashed expressions: host suffixes times path prefixes against a rule list.

A url is cut into every suffix of its host at a label edge and every prefix of its path that has
the length of some rule's path. The digests of these expressions meet the rules on a short prefix
of the digest by an equi-join; the full digest then confirms the match, and of all rules that fit
a url the longest wins.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule and
gets the default verdict; repeated rows and null page ids are kept as they are; equal rules with
different verdicts count as the blocking one; an empty rule list or table works; columns other than
``page_id`` and ``url`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to so many rules are broadcast (about 100 bytes each); above, the join is shuffled and salted.
BROADCAST_RULES, SALTS = 100_000, 16


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\x1f"), path), 256)


def short(of: Column) -> Column:
    """The first 32 bits of a digest, the key of the join."""
    return F.conv(F.substring(of, 1, 8), 16, 10).cast("bigint")


def host_suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages``; rules: (host, path, verdict)."""
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' > 'allow'
    # At most one length per character of the longest rule path.
    lengths = sorted(r[0] for r in rules.select(F.char_length("path")).distinct().collect())
    rules = rules.select(
        F.concat("host", "path").alias("rule"),
        F.col("verdict").alias("rule_verdict"),
        F.char_length("host").alias("host_length"),
        digest(F.col("host"), F.col("path")).alias("rule_digest"),
    ).withColumn("key", short(F.col("rule_digest")))

    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # A place is judged once, however many rows carry it.
    places = cut.select("host", "path").distinct()
    prefixes = F.filter(
        F.array(*[F.when(F.char_length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit(None).cast("string")]),
        lambda p: p.isNotNull(),
    )
    expressions = (
        places.where("host != ''")
        .withColumn("prefix", F.explode(prefixes))
        .withColumn("suffix", F.explode(host_suffixes(F.col("host"))))
        .withColumn("expression", digest(F.col("suffix"), F.col("prefix")))
        .withColumn("key", short(F.col("expression")))
        .select("host", "path", "key", "expression")
    )
    if len(rules.select("key").limit(BROADCAST_RULES + 1).collect()) <= BROADCAST_RULES:
        met = expressions.join(F.broadcast(rules), "key")
    else:
        # A short suffix such as `com` is part of most urls: spread it over SALTS tasks.
        salt = F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")
        spread = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = expressions.withColumn("salt", salt).join(spread, ["key", "salt"])
    best = F.max_by(
        F.struct("rule", "rule_verdict"), F.struct(F.char_length("rule"), F.col("host_length"), F.col("rule"))
    )
    won = (
        met.where("expression = rule_digest")
        .groupBy(F.col("host").alias("won_host"), F.col("path").alias("won_path"))
        .agg(best.alias("best"))
    )
    return cut.join(won, (F.col("host") == F.col("won_host")) & (F.col("path") == F.col("won_path")), "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
