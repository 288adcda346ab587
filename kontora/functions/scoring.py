"""Score, disqualification and tier of an organisation, as column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontora import schema as S
from kontora.functions import rules as R


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)) != 0


def _points(test: Column, points: int) -> Column:
    return F.when(test, points).otherwise(0)


def recency_points(year: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for least, points in R.RECENCY_POINTS:
        out = out.when(year >= least, points)
    return out.otherwise(0)


def platform_points(platform: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for name, points in R.PLATFORM_POINTS.items():
        out = out.when(platform == name, points)
    return out.otherwise(R.UNKNOWN_PLATFORM_POINTS)


def score() -> Column:
    """0 to 100, of columns of the organisation table."""
    total = (
        F.lit(R.BASE_POINTS)
        + platform_points(F.col("platform"))
        + _points(_flag("has_cart"), R.CART_POINTS)
        + _points(_flag("has_product_schema"), R.SCHEMA_POINTS)
        + recency_points(F.col("created_year"))
        + _points(_flag("has_mx"), R.MX_POINTS)
        + _points(F.coalesce(F.col("response_time_ms") < R.FAST_MS, F.lit(False)), R.FAST_POINTS)
        + _points(_flag("is_role"), R.ROLE_POINTS)
    )
    return F.greatest(F.lit(0), F.least(F.lit(100), total)).cast("int")


def disqualified() -> Column:
    """Why an organisation is dropped, by the first rule that holds, or null."""
    status, none = F.col("status"), F.lit(None).cast("string")
    return (
        F.when(status == S.FREEMAIL, none)
        .when(status == S.DEAD, REASONS["dead"])
        .when(status == S.MX_ONLY, REASONS["mx_only"])
        .when(status == S.BLOCKED, REASONS["blocked"])
        .when((status == S.PARKED) | _flag("is_parked"), REASONS["parked"])
        .when(status == S.AGED_OUT, none)
        .when(~status.eqNullSafe(F.lit(S.LIVE)), F.concat(F.lit(REASONS["not_live"]), F.coalesce(status, F.lit("None")), F.lit(")")))
        .when(~F.col("http_status").eqNullSafe(F.lit(200)), F.concat(F.lit(REASONS["not_200"]), F.coalesce(F.col("http_status").cast("string"), F.lit("None")), F.lit(")")))
        .when(~_flag("has_cart"), REASONS["no_cart"])
    )


def assign_tiers(targets: DataFrame, min_score: int = R.MIN_SCORE) -> DataFrame:
    """``targets`` with ``tier``, ``score`` and ``tier_reason``.

    The order is a legal gate: what may not be mailed never gets to tier 1.
    """
    status = F.col("status")
    why = F.col("_why")
    live = F.when(status == S.LIVE, F.col("_score")).otherwise(F.lit(0))
    may_mail = F.coalesce(F.col("jurisdiction").isin(*R.COLD_EMAIL_OK), F.lit(False))
    free = (status == S.FREEMAIL) | _flag("is_freemail")
    low = F.col("_live") < min_score
    place = F.coalesce(F.col("jurisdiction"), F.lit("None"))

    def chain(dropped, freemail, abroad, no_mx, aged, below, clear):
        return (
            F.when(status == S.PENDING, F.lit(None)).when(why.isNotNull(), dropped).when(free, freemail).when(~may_mail, abroad).when(~_flag("has_mx"), no_mx)
            .when(status == S.AGED_OUT, aged).when(low, below).otherwise(clear)
        )

    base = targets.withColumn("_why", disqualified()).withColumn("_score", score()).withColumn("_live", live)
    tier = chain(*(F.lit(t) for t in (S.DROPPED, S.TIER2, S.TIER2, S.TIER2, S.TIER3, S.TIER3, S.TIER1)))
    points = F.when(status == S.PENDING, F.lit(None)).when(why.isNotNull(), 0).otherwise(F.col("_live")).cast("int")
    reason = chain(
        why,
        F.lit(REASONS["freemail"]),
        F.concat(place, F.lit(REASONS["abroad"])),
        F.lit(REASONS["no_mx"]),
        F.lit(REASONS["aged_out"]),
        F.concat(F.lit(REASONS["low"]), F.col("_live").cast("string"), F.lit(f" (below {min_score})")),
        F.lit(REASONS["clear"]),
    )
    return base.withColumn("tier", tier).withColumn("score", points).withColumn("tier_reason", reason).drop("_why", "_score", "_live")


#: Reasons as they are reported.
REASONS = {
    "dead": "does not resolve or nothing served",
    "mx_only": "mail exchanger but no website",
    "blocked": "robots.txt disallows the site root",
    "parked": "parked or for-sale page",
    "not_live": "not live (status ",
    "not_200": "non-200 response (",
    "no_cart": "no cart or checkout link found",
    "low": "live but scores ",
    "freemail": "freemail contact: ads audience only, never email",
    "abroad": " jurisdiction: ads audience only, no cold email",
    "no_mx": "no MX record: cannot be emailed, ads audience only",
    "aged_out": "contact predates the crawl cutoff; not fetched",
    "clear": "cleared for cold email",
}
