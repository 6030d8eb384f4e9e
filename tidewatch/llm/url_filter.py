"""URL rules: host-suffix and path-prefix expressions, matched on short hash prefixes.

Every URL is expanded into (host suffix, path prefix) expressions.  An equi-join
on a 32-bit prefix of each expression's SHA-256 digest finds candidate rules;
the full digest then confirms the match, and the longest rule wins.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import materialise

#: Rules up to this many bytes (of their plan-time text) are broadcast; more are joined by shuffle.
BROADCAST_RULE_BYTES = 4 << 20
#: About the bytes of a judged pair of a host and a path's start; few enough of them are broadcast, too.
BEST_ROW_BYTES = 256
#: Hexadecimal digits of the digest that the join compares.
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(_lower(host), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _host_suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Judge every URL by host and path rules.

    ``rules`` holds ``(host, path, verdict)``, the verdict ``allow`` or
    ``block``.  A rule fits its host and all subdomains, if the URL's path
    starts with the rule's path; the longest host and path together wins, then
    the longest host, then ``block``.  Path prefixes are expanded at exactly
    the path lengths that occur among the rules, so a rule may end within a
    path segment.

    Returns one row per input row: the id, ``host``, ``path``, ``rule`` (host
    and path, null if none fits) and ``verdict`` (``default`` if none fits).  A
    null URL or one without ``://`` has an empty host and path and no rule; an
    empty host fits no rule.  Repeated rows and null ids stay as they are;
    other input columns are not read.  No rules: every row gets ``default``.
    """
    spark = pages.sparkSession
    seen = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    kept = sorted({(h.lower(), p, v) for h, p, v in rules if h})
    if not kept:
        return seen.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    lengths = sorted({len(p) for _, p, _ in kept})

    # Distinct (host, path prefix) pairs are few beside the URLs: they are judged once.
    longest = lengths[-1]
    keyed = seen.withColumn("_head", F.substring("path", 1, longest))
    distinct = keyed.where(F.col("host") != "").select("host", "_head").distinct()
    prefixes = F.filter(
        F.array(*[F.when(F.length("_head") >= n, F.substring("_head", 1, n)) for n in lengths]),
        lambda p: p.isNotNull(),
    )
    expressions = (
        distinct.withColumn("_suffix", F.explode(_host_suffixes(F.col("host"))))
        .withColumn("_prefix", F.explode(prefixes))
        .withColumn("_digest", F.sha2(F.concat_ws("\n", "_suffix", "_prefix"), 256))
        .withColumn("_short", F.substring("_digest", 1, PREFIX_DIGITS))
    )
    listed = spark.createDataFrame(kept, "r_host string, r_path string, r_verdict string")
    listed = (
        listed.withColumn("_full", F.sha2(F.concat_ws("\n", "r_host", "r_path"), 256))
        .withColumn("_short", F.substring("_full", 1, PREFIX_DIGITS))
    )
    size = sum(len(h) + len(p) + 80 for h, p, _ in kept)
    if size <= BROADCAST_RULE_BYTES:
        listed = F.broadcast(listed)
    order = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("n"),
        F.length("r_host").alias("h"),
        (F.col("r_verdict") == "block").cast("int").alias("b"),
        F.concat("r_host", "r_path").alias("rule"),
        F.col("r_verdict").alias("verdict"),
    )
    best = (
        expressions.join(listed, "_short")
        .where(F.col("_digest") == F.col("_full"))
        .groupBy("host", "_head")
        .agg(F.max(order).alias("_best"))
    )
    best, _ = materialise(best, "url-rules", slim=True)
    if best.count() * BEST_ROW_BYTES <= BROADCAST_RULE_BYTES:
        best = F.broadcast(best)  # else a join that adaptive execution can split at a hot host
    return (
        keyed.join(best, ["host", "_head"], "left")
        .select(
            "page_id",
            "host",
            "path",
            F.col("_best.rule").alias("rule"),
            F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"),
        )
    )
