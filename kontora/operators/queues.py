"""Pending queues, age-out and forced re-checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontora import schema as S
from kontora.functions.rules import MIN_YEAR


def _cut(df: DataFrame, limit: int) -> DataFrame:
    return df.limit(limit) if limit else df


def dns_pending(targets: DataFrame, force: bool = False, limit: int = 0) -> DataFrame:
    rows = targets.filter("is_freemail = 0")
    return _cut((rows if force else rows.filter("dns_checked_at is null")).orderBy("domain"), limit)


def http_pending(targets: DataFrame, min_year: int = MIN_YEAR, force: bool = False, limit: int = 0) -> DataFrame:
    """Resolving stores not fetched yet, newest contacts first."""
    rows = targets.filter("is_freemail = 0 and dns_resolves = 1")
    if not force:
        rows = rows.filter("http_checked_at is null")
    if min_year:
        rows = rows.filter(F.col("created_year").isNull() | (F.col("created_year") >= min_year))
    return _cut(rows.orderBy(F.col("created_year").desc_nulls_last(), "domain"), limit)


def profile_pending(targets: DataFrame, tier: str | None = None, tlds: Sequence[str] = (), force: bool = False, limit: int = 0) -> DataFrame:
    rows = targets.filter((F.col("is_freemail") == 0) & (F.col("status") == S.LIVE))
    if not force:
        rows = rows.filter("profile_checked_at is null")
    if tier:
        rows = rows.filter(F.col("tier") == tier)
    if tlds:
        rows = rows.filter(F.col("tld").isin(*tlds))
    return _cut(rows.orderBy(F.col("score").desc_nulls_last(), "domain"), limit)


def verify_pending(targets: DataFrame) -> DataFrame:
    """Addresses cleared for mail that have no verdict; nothing ever probes SMTP."""
    return targets.filter((F.col("tier") == S.TIER1) & F.col("verify_result").isNull())


def apply_verdicts(targets: DataFrame, verdicts: DataFrame, now) -> DataFrame:
    """Put verdicts (target_key, result) of a verifier in."""
    v = verdicts.select(F.col("target_key").alias("_k"), F.coalesce("result", F.lit("unknown")).alias("_r"))
    joined = targets.join(v, F.col("target_key") == F.col("_k"), "left")
    hit = F.col("_k").isNotNull()
    new = {"verify_status": F.lit("done"), "verify_result": F.col("_r"), "verified_at": now}
    return joined.select(*(F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in targets.columns))


def age_out(targets: DataFrame, min_year: int = MIN_YEAR) -> DataFrame:
    """Resolving stores of old contacts are never fetched; 0 turns this off."""
    if not min_year:
        return targets
    old = (F.col("is_freemail") == 0) & (F.col("dns_resolves") == 1) & F.col("http_checked_at").isNull() & (F.col("created_year") < min_year)
    return targets.withColumn("status", F.when(F.coalesce(old, F.lit(False)), S.AGED_OUT).otherwise(F.col("status")))


def force_reset(targets: DataFrame, selected: DataFrame, stage: str) -> DataFrame:
    """Attempts of the selected targets back to 0, so that they may retry."""
    keys = selected.select(F.col("target_key").alias("_k")).distinct()
    name = f"{stage}_attempts"
    joined = targets.join(keys, F.col("target_key") == F.col("_k"), "left")
    return joined.select(*(F.when(F.col("_k").isNotNull(), 0).otherwise(F.col(c)).cast(targets.schema[c].dataType).alias(c) if c == name else F.col(c) for c in targets.columns))
