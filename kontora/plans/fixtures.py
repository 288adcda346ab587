"""Relations derived from the driver's tables, the same in Spark and in SQL.

The tables have no shop signals, so contacts, observations and markup are made
from keys by arithmetic.  Each relation is one SELECT that both engines read;
``{name}`` stands for its inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontora import schema as S
from kontora.functions import contacts as C
from kontora.functions import scoring
from kontora.operators import ingest, observe, queues
from kontora.operators.settle import DNS, HTTP, PROFILE, settle
from kontora.sources.tables import settled

NOW = "TIMESTAMP '2025-01-01 00:00:00'"


def pick(value: str, items: list[str], default: str = "''") -> str:
    return f"CASE {value} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(items)) + f" ELSE {default} END"


def quoted(*items: str) -> list[str]:
    return [f"'{x}'" for x in items]


_FREE = pick("o_custkey % 4", quoted("gmail.com", "gmx.de", "yahoo.co.uk", "web.de"))
_TLD = pick("k % 12", quoted("com", "de", "co.uk", "ca", "com.au", "fr", "ru", "store", "net", "es", "org", "at"))
_LOCAL = pick("o_orderkey % 6", quoted("info", "sales", "kontakt"), "concat('user', CAST(o_custkey AS STRING))")

CONTACTS = f"""
SELECT CAST(o_orderkey % 4 AS INT) AS file_idx, o_orderkey AS row_idx, concat({_LOCAL}, '@', domain) AS email, created
FROM (SELECT o_orderkey, o_custkey, CASE WHEN k % 5 = 0 THEN {_FREE} ELSE concat('shop', CAST(k AS STRING), '.', {_TLD}) END AS domain,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE {{stamp}}(CAST(year(o_orderdate) + 18 + k % 7 AS INT), CAST(month(o_orderdate) AS INT), 1, 0, 0, 0) END AS created
  FROM (SELECT *, o_custkey AS k FROM {{orders}}) a) b
"""

_MARKER = pick(
    "k % 11",
    quoted(
        '<script src="https://cdn.shopify.com/s.js"></script>', '<link href="/wp-content/plugins/woocommerce/a.css">', '<script src="https://cdn11.bigcommerce.com/s.js"></script>',
        '<div data-mage-init="{{}}"></div>', "<script>var prestashop = 1;</script>", '<script src="https://static.parastorage.com/x.js"></script>',
        '<script src="https://static1.squarespace.com/a.js"></script>', '<link href="catalog/view/theme/a.css">',
    ),
)
_IMAGES = (
    '<img src="/p/a.jpg" alt="photo"><img src="/p/b.png" loading="lazy"><img src="/p/c.jpg" srcset="/p/c2.jpg 2x" alt="c"><img src="https://img.other.example/d.jpg" alt="">'
    '<img src="/p/e.webp" alt="e"><img src="data:image/gif;base64,R0" alt="x">'
)
_K = "CAST(k AS STRING)"
_LINKEDIN = pick(
    "k % 7",
    [
        f"concat('<a href=\"https://www.linkedin.com/in/jane-doe-', {_K}, '\">in</a>')", f"concat('<a href=\"https://de.linkedin.com/company/shop', {_K}, '/\">in</a>')",
        "'<a href=\"https://www.linkedin.com/company/jobs\">in</a>'", f"concat('<a href=\"https://lnkd.in/abc', {_K}, '\">in</a>')",
    ],
)

PAGES = f"""
SELECT k, concat('https://shop', {_K}, '.example.com/') AS base_url, CASE WHEN k % 11 = 10 THEN 1 ELSE 0 END AS header_only,
  concat(coalesce(html, ''), {_MARKER}, CASE WHEN k % 4 <> 0 THEN '<a href="/cart">Cart</a>' ELSE '' END,
    CASE WHEN k % 6 = 0 THEN '<script type="application/ld+json">{{{{"@type": "Product"}}}}</script>' ELSE '' END,
    repeat('{_IMAGES}', CAST(floor(k % 30 / 6.0) AS INT)), {_LINKEDIN},
    CASE WHEN k % 3 = 0 THEN concat('<a href="https://shop', {_K}, '.example.com/impressum">Impressum</a>') ELSE '' END,
    CASE WHEN k % 16 = 0 THEN '<p>Inhaber: Muster Handels GmbH</p>' WHEN k % 8 = 0 THEN '<p>Inhaber: Jörg Müller</p>' ELSE '' END,
    CASE WHEN k % 2 = 0 THEN '<meta property="og:image" content="/o.png">' ELSE '' END,
    CASE WHEN k % 5 <> 1 THEN '<meta name="description" content="Fine goods">' ELSE '' END,
    CASE WHEN k % 13 = 5 THEN '<p>This domain is for sale</p>' ELSE '' END) AS html
FROM (SELECT page_id AS k, html FROM {{pages}}) p
"""


def contacts(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(CONTACTS.replace("{stamp}", "make_timestamp_ntz"), orders=spark.read.parquet(f"{d}/orders.parquet"))


def pages(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(PAGES, pages=spark.read.parquet(f"{d}/pages.parquet"))


def with_page(rows: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    """Stores (domain, k) with a page each; between them they have all pages."""
    html = pages(spark, d).withColumnRenamed("k", "_k")
    n = spark.read.parquet(f"{d}/pages.parquet").count()  # page ids are 0 to n - 1
    return rows.select("domain", "k").join(html, F.col("k") % F.lit(max(n, 1)) == F.col("_k"))


def classified(spark: SparkSession, d: str) -> DataFrame:
    return C.classify(contacts(spark, d))


def newest(spark: SparkSession, d: str) -> DataFrame:
    return ingest.keep_newest(C.classify(ingest.first_wins(contacts(spark, d))))


def stores(targets: DataFrame) -> DataFrame:
    return targets.filter("is_freemail = 0").withColumn("k", store_number())


def store_number() -> Column:
    return F.regexp_extract("domain", "^shop([0-9]+)[.]", 1).try_cast("bigint")


def dns_answers(rows: DataFrame) -> DataFrame:
    """Scripted DNS answers of stores (with k)."""
    return rows.selectExpr(
        "domain",
        "k % 17 NOT IN (0, 1, 2, 3) AS a_apex",
        "CASE WHEN k % 17 = 2 THEN 'Timeout' END AS a_error",
        "k % 17 = 3 AS a_www",
        "CASE WHEN k % 17 IN (0, 2, 4) THEN NULL ELSE array(named_struct('exchange', concat('backup', k, '.mail.example.'), 'preference', 50), named_struct('exchange', concat('MX', k % 5, '.mail.example.'), 'preference', 10)) END AS mx",
        "CASE WHEN k % 17 IN (2, 4) THEN 'Timeout' END AS mx_error",
    )


def http_responses(rows: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    """Scripted answers of stores (with k) to a page request."""
    joined = with_page(rows, spark, d)
    code = "CASE WHEN k % 13 IN (0, 1, 3, 4) THEN NULL WHEN k % 13 = 2 THEN 503 ELSE 200 END"
    return joined.selectExpr(
        "domain", "k", "base_url",
        "CASE k % 13 WHEN 3 THEN 'robots_disallow' WHEN 4 THEN 'robots_unavailable_503' END AS robots_reason",
        f"{code} AS status_code",
        f"CASE WHEN {code} IS NOT NULL THEN base_url END AS final_url",
        "CASE WHEN header_only = 1 THEN map('X-ShopId', '1') ELSE map('server', 'x') END AS headers",
        f"CASE WHEN {code} IS NOT NULL THEN html END AS page",
        f"CASE WHEN {code} IS NOT NULL THEN char_length(html) END AS content_length",
        "(k * 37) % 4000 AS elapsed_ms",
        "CASE k % 13 WHEN 0 THEN 'timeout' WHEN 1 THEN 'refused' END AS error",
    )


def visits(rows: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    """Scripted profile visits of live stores (with k)."""
    joined = with_page(rows, spark, d)
    return joined.selectExpr(
        "domain", "base_url AS start_url", "CASE WHEN k % 19 = 0 THEN 'robots_unavailable_503' WHEN k % 19 = 1 THEN 'robots_disallow' END AS robots_reason",
        "CASE WHEN k % 19 IN (2, 3) THEN NULL WHEN k % 19 = 4 THEN 404 ELSE 200 END AS status_code", "CASE k % 19 WHEN 2 THEN 'timeout' WHEN 3 THEN 'refused' END AS error",
        "base_url AS final_url", "html AS page", "CASE WHEN k % 3 = 0 AND k % 9 = 0 THEN '<p>Titular: Ana de Souza</p>' END AS legal_page",
        "CAST(k * 100 AS BIGINT) AS image_bytes", "'image/jpeg' AS image_type",
    )


def ingested(spark: SparkSession, d: str) -> DataFrame:
    """The organisation table after ingest, with some attempts made before."""
    t = S.conform(newest(spark, d))
    prior = F.coalesce(store_number() % 3, F.lit(0)).cast("int")
    return t.withColumn("dns_attempts", prior).withColumn("http_attempts", prior).withColumn("profile_attempts", prior)


def after_dns(spark: SparkSession, d: str) -> DataFrame:
    t = settled(ingested(spark, d))
    return settle(t, observe.dns_verdict(dns_answers(stores(queues.dns_pending(t)))), DNS, F.expr(NOW))


def after_http(spark: SparkSession, d: str) -> DataFrame:
    t = settled(queues.age_out(after_dns(spark, d)))
    return settle(t, observe.http_verdict(http_responses(stores(queues.http_pending(t)), spark, d), by_sql=True), HTTP, F.expr(NOW))


def targets(spark: SparkSession, d: str) -> DataFrame:
    """The table after scoring."""
    return scoring.assign_tiers(after_http(spark, d))


def profiled(spark: SparkSession, d: str) -> DataFrame:
    t = settled(targets(spark, d))
    return settle(t, observe.profile_verdict(visits(stores(queues.profile_pending(t)), spark, d)), PROFILE, F.expr(NOW))
