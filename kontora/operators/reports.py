"""Reports: counts in one pass, never a query for each number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kontora import schema as S
from kontora.functions.rules import MIN_IMAGES, MIN_YEAR


def metrics(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """(position, metric, n): how many rows pass each test, in a single scan."""
    one = df.agg(*(F.count_if(F.coalesce(t, F.lit(False))).alias(f"m{i}") for i, t in enumerate(tests.values())))
    rows = F.array(*(F.struct(F.lit(i).alias("position"), F.lit(k).alias("metric"), F.col(f"m{i}").alias("n")) for i, k in enumerate(tests)))
    return one.select(F.inline(rows))


def summarize(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Counts by value, null too: the largest first and ties by value, or by value
    alone with null last."""
    order = [F.col(column).asc_nulls_last()] if by_value else [F.col("n").desc(), F.col(column).asc_nulls_first()]
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(*order)


def top(df: DataFrame, column: str, n: int) -> DataFrame:
    return summarize(df.filter(F.col(column).isNotNull()), column).limit(n)


def shares(df: DataFrame, column: str) -> DataFrame:
    """Counts by value with their share of all rows in percent."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = F.greatest(df.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    return counts.withColumn("share", F.lit(100.0) * F.col("n") / total)


#: What a share is of, and the steps of the funnel with the place of their base.
BASES = ("", "of all rows", "of all shops")
FUNNEL = (
    ("all rows", 0), ("freemail contacts, never crawled", 1), ("shops", 1), ("DNS answered", 2), ("name resolves", 2), ("DNS to be retried", 2), ("DNS not asked yet", 2),
    ("contact older than {year}, not crawled", 2), ("home page answered", 2), ("live shop", 2), ("home page to be retried", 2), ("home page not asked yet", 2), ("rows with a tier", 1),
)


def funnel(targets: DataFrame, min_year: int = MIN_YEAR) -> DataFrame:
    """(position, step, n, basis, share): the narrowing from targets to tiers."""
    store, up = F.col("is_freemail") == 0, F.col("dns_resolves") == 1
    waiting_dns = store & F.col("dns_checked_at").isNull()
    unfetched = F.col("http_checked_at").isNull()
    young = F.col("created_year").isNull() | (F.col("created_year") >= min_year)
    tests = (
        F.lit(True), F.col("is_freemail") == 1, store, store & F.col("dns_checked_at").isNotNull(), up, waiting_dns & (F.col("dns_attempts") > 0), waiting_dns & (F.col("dns_attempts") == 0),
        store & up & (F.col("created_year") < min_year), ~unfetched, F.col("status") == S.LIVE, store & up & unfetched & (F.col("http_attempts") > 0),
        store & up & unfetched & (F.col("http_attempts") == 0) & (F.col("status") != S.AGED_OUT) & young, F.col("tier").isNotNull(),
    )
    of_all, of_stores = BASES[1:]
    steps = [(label.format(year=min_year), t, BASES[base]) for (label, base), t in zip(FUNNEL, tests, strict=True)]
    one = targets.agg(*(F.count_if(F.coalesce(t, F.lit(False))).alias(f"m{i}") for i, (_, t, _) in enumerate(steps)))
    base = {"": F.lit(None).cast("bigint"), of_all: F.col("m0"), of_stores: F.col("m2")}
    rows = F.array(
        *(
            F.struct(F.lit(i).alias("position"), F.lit(k).alias("step"), F.col(f"m{i}").alias("n"), F.lit(b).alias("basis"), F.when(base[b] > 0, 100.0 * F.col(f"m{i}") / base[b]).alias("share"))
            for i, (k, _, b) in enumerate(steps)
        )
    )
    return one.select(F.inline(rows))


def histogram(targets: DataFrame) -> DataFrame:
    """Ten score buckets of the qualified live rows: n, n at or above, and a bar.

    The last bucket is 90 to 100.  Bars are 40 characters for all, half to even.
    """
    rows = targets.filter((F.col("status") == S.LIVE) & F.col("tier").isNotNull() & (F.col("tier") != S.DROPPED))
    found = rows.groupBy(F.least(F.floor(F.col("score") / 10), F.lit(9)).cast("bigint").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    ten = targets.sparkSession.range(10).select(F.col("id").alias("bucket"))
    all_ten = ten.join(F.broadcast(found), "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    up = F.sum("n").over(W.partitionBy().orderBy(F.col("bucket").desc()).rowsBetween(W.unboundedPreceding, 0))  # ten rows
    total = F.greatest(F.sum("n").over(W.partitionBy()), F.lit(1))
    bar = F.repeat(F.lit("#"), F.bround(40 * F.col("n") / total, 0).cast("int"))
    return all_ten.select((F.col("bucket") * 10).alias("low"), F.when(F.col("bucket") == 9, 100).otherwise(F.col("bucket") * 10 + 9).alias("high"), "n", up.alias("at_or_above"), bar.alias("bar"))


def tier_stats(targets: DataFrame, tier: str = S.TIER1) -> DataFrame:
    rows = targets.filter(F.col("tier") == tier)
    return rows.agg(F.min("score").alias("min_score"), F.avg("score").alias("avg_score"), F.max("score").alias("max_score"))


def tier_tlds(targets: DataFrame, tier: str = S.TIER1, n: int = 20) -> DataFrame:
    return summarize(targets.filter(F.col("tier") == tier), "tld").limit(n)


def drop_reasons(targets: DataFrame, n: int = 10) -> DataFrame:
    return summarize(targets.filter(F.col("tier") == S.DROPPED), "tier_reason").limit(n)


#: Columns of a tier's workbook; dropped rows also say why.
TIER_COLUMNS = ("domain", "email", "platform", "score", "created_year", "jurisdiction", "http_status", "has_cart", "page_title", "final_url")


def tier_rows(targets: DataFrame, tier: str) -> DataFrame:
    """Rows of a tier's workbook, best first."""
    extra = [F.col("tier_reason").alias("reason")] if tier == S.DROPPED else []
    rows = targets.filter(F.col("tier") == tier).orderBy(F.col("score").desc_nulls_last(), F.col("created_year").desc_nulls_last(), "domain", "target_key")
    return rows.select(*TIER_COLUMNS, *extra)


def outreach(targets: DataFrame) -> DataFrame:
    """The projection all outreach sheets share, of profiled rows."""
    owner, account = F.col("owner_name").isNotNull(), F.col("linkedin_url").isNotNull()
    route = (
        F.when(owner & account, "name+linkedin").when(owner, "named owner").when(F.col("linkedin_kind") == "personal", "linkedin person").when(account, "linkedin company").otherwise("email only")
    )
    return targets.filter("profile_checked_at is not null").select(
        "domain", "email", F.when(F.col("tier") == S.TIER1, "yes").otherwise("NO").alias("email_ok"), route.alias("contact_route"), "owner_name", "linkedin_url", "linkedin_kind", "tier", "score",
        "platform", "jurisdiction", "created_year", "image_count", "images_no_alt", F.expr("sample_image_bytes div 1024").alias("sample_image_kb"), "page_title", "final_url", "has_cart",
    )


def outreach_sheets(targets: DataFrame, min_images: int = MIN_IMAGES) -> dict[str, DataFrame]:
    """Sheets by name, each best first; a row may be on several."""
    base = outreach(targets)
    owner, account = F.col("owner_name").isNotNull(), F.col("linkedin_url").isNotNull()
    many = F.col("image_count") >= min_images
    tests = {
        "best leads": many & (F.col("has_cart") == 1) & (F.col("tier") != S.DROPPED) & (owner | account),
        "image sites no cart": many & (F.coalesce("has_cart", F.lit(0)) == 0) & (owner | account),
        "named owners": owner,
        "linkedin only": account & ~owner,
        "image heavy no contact": many & ~owner & ~account,
    }
    order = [owner.desc(), (F.col("linkedin_kind") == "personal").desc_nulls_last(), F.col("image_count").desc_nulls_last(), F.col("score").desc_nulls_last(), F.col("domain")]
    return {name: base.filter(t).orderBy(*order).drop("has_cart") for name, t in tests.items()}


def dns_summary(targets: DataFrame) -> DataFrame:
    store = F.col("is_freemail") == 0
    return metrics(
        targets,
        {
            "checked": store & F.col("dns_checked_at").isNotNull(),
            "resolving": store & (F.col("dns_resolves") == 1),
            "www only": store & F.col("a_host").like("www.%"),
            "with mail": store & (F.col("has_mx") == 1),
            "mail only": F.col("status") == S.MX_ONLY,
            "dead": F.col("status") == S.DEAD,
        },
    )


def http_summary(targets: DataFrame) -> DataFrame:
    live = F.col("status") == S.LIVE
    return metrics(targets, {"fetched": F.col("http_checked_at").isNotNull(), "live": live, "with cart": live & (F.col("has_cart") == 1), "with schema": live & (F.col("has_product_schema") == 1), "unidentified": live & F.col("platform").isNull(), "awaiting retry": F.col("http_checked_at").isNull() & (F.col("http_attempts") > 0)})


def profile_summary(targets: DataFrame) -> DataFrame:
    done = F.col("profile_checked_at").isNotNull()
    return metrics(targets, {"profiled": done, "with linkedin": done & F.col("linkedin_url").isNotNull(), "personal": done & (F.col("linkedin_kind") == "personal"), "with owner": done & F.col("owner_name").isNotNull(), "with images": done & (F.col("image_count") > 0), "failed": done & F.col("profile_error").isNotNull()})


def ingest_summary(targets: DataFrame) -> DataFrame:
    return metrics(targets, {"targets": F.lit(True), "freemail": F.col("is_freemail") == 1, "stores": F.col("is_freemail") == 0, "role addresses": F.col("is_role") == 1, "undated": F.col("created").isNull()})
