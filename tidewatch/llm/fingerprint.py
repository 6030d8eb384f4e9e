"""Canonical exact digests of documents.

A text is canonicalised (compatibility composition, full case folding, white
space folded to one space), hashed to 128 bits by two seeded xxhash64 values,
and grouped; inside a bucket of equal hashes the canonical bytes are compared,
and a bucket that holds different bytes gets a longer digest.  An edited text
exists only for a moment; it is compared by its SHA-256 instead of its bytes.  DataFrame
functions only: the normaliser and the folder are Java library calls.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import materialise

#: Rows of one id bucket, about, when each document is paired with its follower, and the square root
#: of the largest number of buckets.
BUCKET_ROWS, FAN = 2048, 64
#: Length of the hash that is grouped, in hexadecimal digits.
WIDE_DIGITS = 32
#: Runs of what Unicode counts as white space.
WHITE_SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
#: A side of a join of at most this many bytes is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 32 << 20


def canonical(text: Column) -> Column:
    """NFKC, full case folding, NFKC again, then runs of white space to one space, trimmed; null is empty."""
    nfkc = lambda c: F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    fold = lambda c: F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), c, F.lit(True))
    text = F.coalesce(text, F.lit(""))
    spaced = text
    for space in "\t\n\x0b\f\r\x1c\x1d\x1e\x1f":
        spaced = F.replace(spaced, F.lit(space), F.lit(" "))
    spaced = F.lower(spaced)
    ascii_form = F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)
    wide_form = F.regexp_replace(nfkc(fold(nfkc(text))), WHITE_SPACE, " ")
    return F.trim(F.when(F.octet_length(text) == F.length(text), ascii_form).otherwise(wide_form))


def wide_hash(canon: Column) -> Column:
    """128 bits of xxhash as 32 hexadecimal digits."""
    half = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return F.concat(half(F.xxhash64(canon)), half(F.xxhash64(F.lit("tidewatch"), canon)))


def _bounds(docs: DataFrame, n: int) -> list[list[int]]:
    """Quantiles of the ids, ``FAN`` lists of ``FAN`` at most: bounds of buckets that hold about as many rows each."""
    fan = max(1, min(FAN, math.ceil(math.sqrt(n / BUCKET_ROWS))))
    shares = [k / (fan * fan) for k in range(fan * fan)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 50 * fan * fan).alias("ids")).first()["ids"] or []
    return [found[k : k + fan] for k in range(0, len(found), fan)]


def _bucket(id_: Column, bounds: list[list[int]]) -> Column:
    """Number of the bucket that an id lies in, from 1; 0 for a null id or one below all bounds."""
    at_most = lambda ids: F.size(F.filter(ids, lambda b: b <= id_))
    longs = lambda ids: F.array(*[F.lit(x).cast("long") for x in ids])
    coarse = at_most(longs([ids[0] for ids in bounds]))
    inner = F.element_at(F.array(*[longs(ids) for ids in bounds]), F.greatest(coarse, F.lit(1)))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * F.lit(len(bounds[0])) + at_most(inner))


def with_follower(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Add ``next_<c>`` for every carried column: its value in the next document.

    Next is by ascending ``doc_id``; the last document is followed by the
    first.  Null ids come first; rows of equal id are ordered by the carried
    columns.  Ids are dealt into buckets by their quantiles, so that uneven ids
    give even buckets, and each bucket is ordered by itself; only each bucket's
    first row goes on to the bucket before it.  There are ``FAN`` squared
    buckets at most, whose numbers one task puts in order.
    """
    bounds = _bounds(docs, docs.count())
    dealt = docs.withColumn("_bucket", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(_bucket(F.col("doc_id"), bounds) if bounds else F.lit(0)))
    inner = Window.partitionBy("_bucket").orderBy(F.col("doc_id").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in carried])
    row = F.struct(*carried)
    paired = dealt.withColumn("_next", F.lead(row).over(inner))
    # Each bucket's first row, found by its id; one short row per bucket finds the bucket that follows.
    firsts = dealt.groupBy("_bucket").agg(F.min("doc_id").alias("_first"))
    by_bucket = Window.orderBy("_bucket")
    lowest = F.first("_bucket").over(by_bucket)
    chain = firsts.select("_bucket", F.coalesce(F.lead("_bucket").over(by_bucket), lowest).alias("_after"))
    heads = (
        dealt.join(F.broadcast(firsts.withColumnRenamed("_bucket", "_b")), (F.col("_bucket") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_first")))
        .groupBy(F.col("_bucket").alias("_after"))
        .agg(F.min(row).alias("_head"))
    )
    heads = chain.join(heads, "_after").select("_bucket", "_head")
    out = paired.join(heads, "_bucket", "left").withColumn("_next", F.coalesce("_next", "_head"))
    return out.select(*docs.columns, *[F.col(f"_next.{c}").alias(f"next_{c}") for c in carried])


def mixed_buckets(named: DataFrame, texts: DataFrame) -> DataFrame:
    """The wide hashes shared by different bytes, each once.

    ``named`` has ``wide`` and ``sha`` for every text that gets a fingerprint;
    ``texts`` has ``wide`` and ``canon`` for those whose bytes are compared.
    Only buckets of two or more rows move their bytes: hashes are counted first,
    and the repeated ones filter the texts, by a broadcast while they are few
    and by a shuffled join beyond.  A bucket's bytes are compared through their
    smallest and largest value, aggregated before the shuffle, so a large group
    of copies costs one row a task.
    """
    counted = named.groupBy("wide").agg(F.count(F.lit(1)).alias("n"), F.min("sha").alias("low"), F.max("sha").alias("high"))
    counted = counted.where(F.col("n") > 1)
    repeated = counted.select("wide")
    if repeated.count() * (WIDE_DIGITS + 32) <= BROADCAST_BYTES:
        repeated = F.broadcast(repeated)
    by_bytes = texts.join(repeated, "wide", "left_semi").groupBy("wide").agg(F.min("canon").alias("low"), F.max("canon").alias("high"))
    differ = F.col("low") != F.col("high")
    return by_bytes.where(differ).select("wide").union(counted.where(differ).select("wide")).distinct()


def _print(wide: Column, sha: Column, mixed: Column) -> Column:
    return F.when(mixed, F.concat(wide, F.lit("-"), sha)).otherwise(wide)


def fingerprint_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exact fingerprint and class of each document.

    Equal canonical texts get equal fingerprints, different ones different
    fingerprints: where a bucket of equal hashes holds different bytes, the
    SHA-256 of the canonical text follows the hash.  Returns one row per input
    row: ``doc_id``, ``fingerprint`` and ``n_copies`` (rows of that
    fingerprint).  A null text counts as empty; null ids and repeated rows stay;
    other columns are not read; an empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), canonical(F.col(text_col)).alias("canon"))
    base = base.select("doc_id", "canon", wide_hash(F.col("canon")).alias("wide"))
    named = base.select("doc_id", "wide", F.sha2("canon", 256).alias("sha"))
    mixed = mixed_buckets(named, base).withColumn("_mixed", F.lit(True))
    named = named.join(mixed, "wide", "left").select("doc_id", _print(F.col("wide"), F.col("sha"), F.col("_mixed")).alias("fingerprint"))
    counts = named.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_copies"))
    return named.join(counts, "fingerprint").select("doc_id", "fingerprint", "n_copies")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edit replaces the last quarter (rounded down) of a text's code points
    by the first as many (or all) of the next document's; see
    :func:`with_follower` for the order.  Returns one row per input row:
    ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``.  An exact
    fingerprint is alike (1.0) or not (0.0), nothing between.  A null text
    counts as empty; the only document of a table follows itself.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    base = base.withColumn("canon", canonical(F.col("text")))
    base = base.select("doc_id", "text", wide_hash(F.col("canon")).alias("wide"), F.sha2("canon", 256).alias("sha"))
    paired = with_follower(base, ["text", "wide", "sha"])
    cut = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - _cut)"), F.expr("substring(next_text, 1, _cut)"))
    paired = paired.withColumn("_cut", cut).withColumn("edited", edited).drop("next_text", "_cut")
    paired = paired.withColumn("e_canon", canonical(F.col("edited")))
    paired = paired.withColumns({"e_wide": wide_hash(F.col("e_canon")), "e_sha": F.sha2("e_canon", 256)})
    out = paired.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "wide", "sha", "e_wide", "e_sha", "next_wide", "next_sha",
    )
    out, _ = materialise(out, "fingerprints")
    named = out.select("wide", "sha").unionByName(out.select(F.col("e_wide").alias("wide"), F.col("e_sha").alias("sha")))
    mixed = mixed_buckets(named, base.select("wide", canonical(F.col("text")).alias("canon")))
    for name in ("wide", "e_wide", "next_wide"):
        out = out.join(mixed.select(F.col("wide").alias(name), F.lit(True).alias(f"{name}_mixed")), name, "left")
    names = {n: _print(F.col(f"{p}wide"), F.col(f"{p}sha"), F.col(f"{p}wide_mixed")) for n, p in (("fingerprint", ""), ("edited_fingerprint", "e_"), ("next_fingerprint", "next_"))}
    return out.withColumns(names).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        (F.col("fingerprint") == F.col("edited_fingerprint")).cast("double").alias("near_edited"),
        (F.col("fingerprint") == F.col("next_fingerprint")).cast("double").alias("near_next"),
    )
