"""Linking reports to registry identifiers, and names to names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import qualify
from tidewatch.functions.kernels import fuzzy_score

CONFIDENCE = {"UDI SUCCESS": "HIGH", "META SUCCESS": "MEDIUM", "NO UDI META SUCCESS": "LOW", "UDI FAILED": "VERY LOW"}


def agreeing(pairs: Sequence[tuple[str, str]]) -> Column:
    """How many of the column pairs are both present and equal."""
    return sum((F.coalesce((F.col(a) == F.col(b)).cast("int"), F.lit(0)) for a, b in pairs), F.lit(0))


def confidence(status: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for name, level in CONFIDENCE.items():
        out = out.when(status == name, level)
    return out


def match_identifiers(target: DataFrame, source: DataFrame, device: Sequence[str], least: int = 1) -> DataFrame:
    """Three tiers of matching a report's device to a registry entry.

    ``target`` has ``udi_di`` (may be null), ``manufacturer``, the device columns
    and ``target_date``; ``source`` has ``udi_di``, ``primary_udi_di``,
    ``manufacturer``, the device columns and ``source_date``.

    1. An identifier whose entries have one primary takes it (the latest entry).
    2. One with several primaries is settled by the maker and at least ``least``
       equal device columns, from entries before the report.
    3. Rows without an identifier are settled the same way over all entries.

    Settlement is per identifier, or per maker and device, not per report, so
    what the reports say of it is gathered first: only the latest report of each
    matters to the date.  Registry entries meet these by maker and equal device
    columns, each combination of ``least`` of them, and never by the maker alone.
    Ties of the date go to the smallest primary.  Adds ``matched_udi_di``,
    ``match_status`` and ``match_confidence``.
    """
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in ("udi_di", "primary_udi_di", "manufacturer", "source_date", *device)])
    has, no = target.where(F.col("udi_di").isNotNull()), target.where(F.col("udi_di").isNull())

    # Facts of an identifier do not depend on the reports: they are computed once for each.
    primaries = s.groupBy("s_udi_di").agg(F.countDistinct("s_primary_udi_di").alias("n_primary"))
    keys = ["manufacturer", *device]
    asked = has.groupBy("udi_di", *keys).agg(F.max("target_date").alias("target_date"))
    wanted = s.join(has.select(F.col("udi_di").alias("s_udi_di")).distinct(), "s_udi_di", "left_semi").join(primaries, "s_udi_di")
    direct = _latest(wanted.where("n_primary = 1"), ["s_udi_di"]).withColumn("status", F.lit("UDI SUCCESS"))
    pairs = [(c, f"s_{c}") for c in device]
    likely = (agreeing(pairs) >= least) & (F.col("target_date") > F.col("s_source_date"))
    ambiguous = asked.join(wanted.where("n_primary > 1"), (F.col("udi_di") == F.col("s_udi_di")) & (F.col("manufacturer") == F.col("s_manufacturer"))).where(likely)
    settled = _latest(ambiguous, ["s_udi_di"]).withColumn("status", F.lit("META SUCCESS"))
    by_id = direct.unionByName(settled)

    open_rows = no.groupBy(*keys).agg(F.max("target_date").alias("target_date"))
    offers = []
    for chosen in combinations(device, least):
        own = ["s_manufacturer", *[f"s_{c}" for c in chosen]]
        entries = s.groupBy(*own, "s_source_date").agg(_first_primary().alias("_p")).select(*own, "s_source_date", F.col("_p.p").alias("s_primary_udi_di"))
        same = F.col("manufacturer") == F.col("s_manufacturer")
        for c in chosen:
            same &= F.col(c) == F.col(f"s_{c}")
        offers.append(open_rows.join(entries, same).where(F.col("target_date") > F.col("s_source_date")).select(*keys, "s_source_date", "s_primary_udi_di"))
    by_meta = _latest(reduce(DataFrame.unionByName, offers), keys).withColumnsRenamed({k: f"k_{k}" for k in keys})

    with_id = has.join(by_id, F.col("udi_di") == F.col("s_udi_di"), "left").select(*target.columns, F.col("found").alias("matched_udi_di"), F.coalesce("status", F.lit("UDI FAILED")).alias("match_status"))
    same = (F.col("manufacturer") == F.col("k_manufacturer"))
    for c in device:
        same &= F.col(c).eqNullSafe(F.col(f"k_{c}"))
    without_id = no.join(by_meta, same, "left").select(*target.columns, F.col("found").alias("matched_udi_di"), F.when(F.col("found").isNotNull(), "NO UDI META SUCCESS").otherwise("NO MATCH").alias("match_status"))
    out = with_id.unionByName(without_id)
    return out.withColumn("match_confidence", F.coalesce(confidence(F.col("match_status")), F.lit("VERY LOW")))


def _first_primary() -> Column:
    """The smallest primary of a group, nulls last, as field ``p``."""
    return F.min(F.struct(F.col("s_primary_udi_di").isNull().alias("none"), F.col("s_primary_udi_di").alias("p")))


def _latest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The primary (``found``) of each key's latest entry, entries without a date last; aggregated before the shuffle."""
    age = F.coalesce(-F.unix_date("s_source_date"), F.lit(2**31 - 1))
    best = F.min(F.struct(age.alias("age"), F.col("s_primary_udi_di").isNull().alias("none"), F.col("s_primary_udi_di").alias("p")))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b.p").alias("found"))


def fuzzy_best(names: DataFrame, known: DataFrame, threshold: float = 0.85) -> DataFrame:
    """The best known name of each name that is not known itself.

    Names are distinct first; a name that is known needs no score.  Pairs meet
    by the lengths that the threshold allows: an Indel ratio of t needs
    2 min(len) / (sum of lengths) >= t, so a name of n characters meets lengths
    from n t / (2 - t) to n (2 - t) / t only.  Ties go to the smaller name.
    """
    left = names.select("name").where(F.col("name").isNotNull()).distinct()
    right = known.select(F.col("name").alias("other")).where(F.col("other").isNotNull()).distinct()
    left = left.join(right, F.col("name") == F.col("other"), "left_anti")
    n = F.length("name")
    low, high = F.ceil(n * threshold / (2 - threshold) - 1e-9), F.floor(n * (2 - threshold) / threshold + 1e-9)
    spread = left.withColumn("size", F.explode(F.sequence(F.greatest(low, F.lit(1)).cast("int"), F.greatest(high, F.lit(1)).cast("int"))))
    pairs = spread.join(right.withColumn("size", F.length("other")), "size").withColumn("score", fuzzy_score("name", "other"))
    return qualify(pairs.where(F.col("score") >= threshold).select("name", "other", "score"), ["name"], [F.desc("score"), F.asc("other")])


def rewrite_names(df: DataFrame, column: str, best: DataFrame) -> DataFrame:
    mapped = best.select(F.col("name").alias(column), F.col("other").alias("_other"))
    return df.join(mapped, column, "left").withColumn(column, F.coalesce("_other", column)).drop("_other").select(*df.columns)
