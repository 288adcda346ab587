"""URL filters: rules by host and path, else a list of canonical URLs.

The list is summed up in a blocked Bloom filter built and read with DataFrame
functions alone: a URL's hash picks one block of four 64-bit words and a bit in
each, so a test reads one block.  URLs that pass are possible hits; only these
join the list itself, by hash, which removes the false positives.  The number
of blocks follows the list up to ``MAX_BLOCKS``, which bounds what is sent to
the executors; a longer list only lets more URLs through to the exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontora.llm.common import PRIVATE, ascii_lower, cut

#: Blocks of 32 bytes, at most (2 MB); keys of a block in mind.
MAX_BLOCKS, KEYS = 1 << 16, 16
#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Query parameters that don't change a page; fixed values.
TRACKING = "utm_[a-z]+|gclid|fbclid|ref"
#: The list of the query: canonical URLs that so many pages have.
LISTED_PAGES = 3


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z in lower case; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``? #``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without a last slash, and the query
    without tracking parameters.  Null and URLs without ``://`` have none."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r"^(?:www|m)\.", ""), r":(?:80|443)$", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, rf"(?i)(^|&)(?:{TRACKING})=[^&]*", "$1")
    query = F.regexp_replace(F.regexp_replace(query, "&{2,}", "&"), "^&|&$", "")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(F.instr(url, "://") > 0, whole)


def _rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits."""
    name = verdict = F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        name, verdict = F.when(fits, own + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key, and a mask of one bit for each of the block's words."""
    h, one = F.xxhash64(key, F.lit("bits")), F.lit(1).cast("bigint")
    at = [F.pmod(F.shiftrightunsigned(h, 6 * i), F.lit(64)).cast("int") for i in range(4)]
    return F.pmod(F.xxhash64(key), F.lit(blocks)), [F.call_function("shiftleft", one, x) for x in at]


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0..w3): at most ``blocks`` rows, combined before the shuffle."""
    block, masks = _bits(F.col(key), blocks)
    return keys.groupBy(block.alias("block")).agg(*(F.bit_or(m).alias(f"w{i}") for i, m in enumerate(masks)))


def filter_urls(pages: DataFrame, listed: DataFrame, url_col: str = "url", rules=RULES, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``listed`` has a column ``url`` of canonical URLs.  Where a rule fits, the
    longest decides; ``rule`` is null elsewhere and the URL is blocked if it is
    listed.  Null URLs and those without ``://`` have an empty host and path, fit
    no rule and are allowed.  URLs of any length are read whole.  New columns
    replace input columns of the same name.  Repeated rows are judged each; an
    empty list blocks nothing and empty ``pages`` give no rows.
    """
    made, key, hit = ("host", "path", "rule", "verdict"), PRIVATE + "key", PRIVATE + "hit"
    listed = cut(listed.select(F.col("url").alias(hit)).filter(F.col(hit).isNotNull()).distinct())  # read three times
    count = listed.count()
    blocks = min(max_blocks, 1 << max(4, (count // KEYS).bit_length()))
    bloom = bloom_blocks(listed, hit, blocks)  # at most max_blocks rows of 40 bytes
    base = pages.select(*(F.col(f"`{c}`") for c in pages.columns if c not in made))
    url = F.col(f"`{url_col}`")
    name, verdict = _rule(F.col("host"), F.col("path"), rules)
    rows = base.withColumn("host", url_host(url)).withColumn("path", url_path(url))
    rows = rows.withColumn("rule", name).withColumn("verdict", verdict).withColumn(key, F.when(F.col("verdict").isNull(), canonical(url)))
    block, masks = _bits(F.col(key), blocks)
    words = [F.col(f"b.w{i}") for i in range(4)]
    tested = rows.withColumn(PRIVATE + "block", F.when(F.col(key).isNotNull(), block)).join(
        F.broadcast(bloom.alias("b")), F.col(PRIVATE + "block") == F.col("b.block"), "left"
    )
    passes = F.lit(True)
    for m, w in zip(masks, words, strict=True):
        passes = passes & (m.bitwiseAND(w) != 0)
    tested = tested.withColumn(PRIVATE + "possible", F.when(passes, F.col(key))).select(*rows.columns, PRIVATE + "possible")
    # Rows without a possible hit never move.  Both sides of the join are plain
    # shuffles, so that adaptive execution can split a URL that many rows have.
    possible = F.col(PRIVATE + "possible")
    clear = tested.filter(possible.isNull()).withColumn(hit, F.lit(None).cast("string"))
    out = clear.unionByName(tested.filter(possible.isNotNull()).join(listed, possible == F.col(hit), "left"))
    final = F.coalesce(F.col("verdict"), F.when(F.col(hit).isNotNull(), "block").otherwise("allow"))
    return out.select(*base.columns, "host", "path", "rule", final.alias("verdict"))


def mass_posted(pages: DataFrame, url_col: str = "url", least: int = LISTED_PAGES) -> DataFrame:
    """Canonical URLs that ``least`` pages or more have."""
    return pages.select(canonical(F.col(f"`{url_col}`")).alias("url")).filter("url is not null").groupBy("url").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("url")


def op10_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, mass_posted(pages)).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH parts AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    regexp_extract(url, '^.*?://[^?#]*\?([^#]*)', 1, 's') AS q
  FROM pages
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
    regexp_replace(regexp_replace(regexp_replace(q, '(^|&)(utm_[a-z]+|gclid|fbclid|ref)=[^&]*', '\1', 'gi'), '&{2,}', '&', 'g'), '^&|&$', '', 'g') AS query
  FROM parts
), canon AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
      regexp_replace(regexp_replace(host, '^(www|m)\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS c
  FROM ruled
), listed AS (SELECT c FROM canon WHERE c IS NOT NULL GROUP BY c HAVING count(*) >= 3)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN l.c IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM canon LEFT JOIN listed l ON canon.c = l.c
"""
