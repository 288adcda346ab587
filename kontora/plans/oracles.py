"""The SQL that each query must equal, from common table expressions."""

from __future__ import annotations

from kontora.functions import rules as R
from kontora.plans import fixtures as X


def names(items) -> str:
    return ", ".join(f"'{x}'" for x in items)


def text(pattern: str) -> str:
    return pattern.replace("'", "''")


def any_of(column: str, patterns) -> str:
    return "(" + " OR ".join(f"regexp_matches({column}, '(?i){text(p)}')" for p in patterns) + ")"


def _filled(sql: str, **inputs: str) -> str:
    for k, v in inputs.items():
        sql = sql.replace("{" + k + "}", v)
    return sql.replace("{{", "{").replace("}}", "}")


CTES = {
    "contacts": _filled(X.CONTACTS, stamp="make_timestamp", orders="orders"),
    "html": _filled(X.PAGES, pages="pages"),
    "classified": f"""
SELECT *, CASE WHEN free THEN email ELSE domain END AS target_key, free::INT AS is_freemail, (local_part IN ({names(R.ROLE_LOCALS)}))::INT AS is_role,
  CASE WHEN tld IN ({names(R.EU_TLDS)}) THEN 'EU' WHEN tld = 'ca' THEN 'CASL' WHEN tld = 'uk' THEN 'PECR' WHEN tld IN ({names(R.PERMISSIVE_TLDS)}) THEN 'PERMISSIVE' ELSE 'OTHER' END AS jurisdiction,
  CASE WHEN free THEN 'freemail' ELSE 'pending' END AS status, year(created)::INT AS created_year
FROM (SELECT *, split_part(email, '@', 1) AS local_part, split_part(email, '@', 2) AS domain, regexp_extract(email, '[^.]+$') AS tld,
  split_part(email, '@', 2) IN ({names(R.FREEMAIL_DOMAINS)})
    OR (split_part(split_part(email, '@', 2), '.', 1) IN ({names(R.FREEMAIL_BRANDS)}) AND len(string_split(split_part(email, '@', 2), '.')) <= 3) AS free FROM contacts)""",
    "firsts": "SELECT * FROM classified QUALIFY row_number() OVER (PARTITION BY file_idx, email ORDER BY row_idx) = 1",
    "newest": """
SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY target_key)::INT AS email_count FROM firsts)
QUALIFY row_number() OVER (PARTITION BY target_key ORDER BY created DESC NULLS LAST, file_idx, row_idx) = 1""",
    "keyed": "SELECT *, TRY_CAST(nullif(regexp_extract(domain, '^shop([0-9]+)[.]', 1), '') AS BIGINT) AS k FROM newest",
    "dns_raw": """
SELECT *, k % 17 NOT IN (0, 1, 2, 3) AS a_apex, CASE WHEN k % 17 = 2 THEN 'Timeout' END AS a_error, k % 17 = 3 AS a_www,
  CASE WHEN k % 17 IN (2, 4) THEN 'Timeout' END AS mx_error,
  CASE WHEN k % 17 IN (0, 2, 4) THEN NULL ELSE lower(rtrim(list_sort([{'p': 50, 'x': 'backup' || k || '.mail.example.'}, {'p': 10, 'x': 'MX' || (k % 5) || '.mail.example.'}])[1].x, '.')) END AS mx_provider
FROM keyed WHERE is_freemail = 0""",
    "dns": """
SELECT domain, k, up::INT AS dns_resolves, CASE WHEN a_apex THEN domain WHEN up THEN 'www.' || domain END AS a_host, (mx_provider IS NOT NULL)::INT AS has_mx, mx_provider,
  nullif(concat_ws('; ', a_error, mx_error), '') AS dns_error, CASE WHEN up THEN NULL WHEN mx_provider IS NOT NULL THEN 'mx_only' ELSE 'dead' END AS status,
  NOT up AND mx_provider IS NULL AND a_error IS NOT NULL AS inconclusive
FROM (SELECT *, a_apex OR (a_error IS NULL AND a_www) AS up FROM dns_raw)""",
    "t1": """
SELECT n.* EXCLUDE (status, k), n.k, coalesce(n.k % 3, 0)::INT + (d.domain IS NOT NULL)::INT AS dns_attempts, coalesce(n.k % 3, 0)::INT AS http_prior,
  CASE WHEN d.inconclusive AND n.k % 3 + 1 < 3 THEN 0 WHEN d.domain IS NULL THEN 0 ELSE 1 END AS dns_checked,
  CASE WHEN d.inconclusive THEN CASE WHEN n.k % 3 + 1 >= 3 THEN 0 END ELSE d.dns_resolves END AS dns_resolves,
  CASE WHEN d.inconclusive THEN CASE WHEN n.k % 3 + 1 >= 3 THEN 0 END ELSE d.has_mx END AS has_mx,
  CASE WHEN NOT d.inconclusive THEN d.a_host END AS a_host, CASE WHEN NOT d.inconclusive THEN d.mx_provider END AS mx_provider, d.dns_error,
  CASE WHEN d.inconclusive THEN CASE WHEN n.k % 3 + 1 >= 3 THEN 'dead' ELSE n.status END ELSE coalesce(d.status, n.status) END AS status
FROM keyed n LEFT JOIN dns d ON n.domain = d.domain AND n.is_freemail = 0""",
    "t2": "SELECT * EXCLUDE (status), CASE WHEN is_freemail = 0 AND dns_resolves = 1 AND created_year < 2020 THEN 'aged_out' ELSE status END AS status FROM t1",
    "http_raw": """
SELECT t.domain, t.k, h.k AS page, h.html, h.base_url, h.header_only, CASE t.k % 13 WHEN 3 THEN 'robots_disallow' WHEN 4 THEN 'robots_unavailable_503' END AS robots_reason,
  CASE WHEN t.k % 13 IN (0, 1, 3, 4) THEN NULL WHEN t.k % 13 = 2 THEN 503 ELSE 200 END AS code, CASE t.k % 13 WHEN 0 THEN 'timeout' WHEN 1 THEN 'refused' END AS error
FROM t2 t JOIN html h ON t.k % (SELECT count(*) FROM pages) = h.k WHERE t.is_freemail = 0 AND t.dns_resolves = 1 AND (t.created_year IS NULL OR t.created_year >= 2020)""",
    "signals": f"""
SELECT k, html, base_url, nullif(left(trim(regexp_replace(replace(regexp_extract(html, '(?is){text(R.TITLE)}', 1), '&amp;', '&'), '\\s+', ' ', 'g')), 300), '') AS page_title,
  nullif(lower(regexp_extract(html, '(?i){text(R.HTML_LANG)}', 1)), '') AS lang,
  CASE {" ".join(f"WHEN regexp_matches(html, '(?i){text(body)}'){' OR header_only = 1' if name == 'Shopify' else ''} THEN '{name}'" for name, body, _, _ in R.PLATFORMS)} END AS platform,
  {any_of('html', R.CART)}::INT AS has_cart, {any_of('html', R.PRODUCT_SCHEMA)}::INT AS has_product_schema, {any_of('html', R.PARKED)}::INT AS is_parked,
  regexp_matches(html, '(?i){text(R.OG_IMAGE)}')::INT AS has_og_image, regexp_matches(html, '(?i){text(R.META_DESCRIPTION)}')::INT AS has_meta_desc,
  list_filter(regexp_extract_all(html, '(?i){R.IMG_TAG}'), lambda t: NOT contains(t, 'src="data:')) AS imgs,
  CASE WHEN regexp_matches(html, 'linkedin[.]com/in/') THEN regexp_extract(html, 'linkedin[.]com/in/([A-Za-z0-9_.%-]+)', 1) END AS person,
  list_filter(regexp_extract_all(html, 'linkedin[.]com/company/([A-Za-z0-9_.%-]+)', 1), lambda s: lower(s) NOT IN ({names(R.LINKEDIN_NOISE)}))[1] AS company,
  nullif(regexp_extract(html, 'lnkd[.]in/([A-Za-z0-9_-]+)', 1), '') AS short,
  nullif(regexp_extract(html, '(?i){text(R.LEGAL_PAGE)}', 1), '') AS legal_url
FROM html""",
    "http": """
SELECT r.domain, CASE WHEN seen THEN code END AS http_status, CASE WHEN seen THEN r.base_url END AS final_url, CASE WHEN seen THEN s.page_title END AS page_title,
  CASE WHEN robots_reason IS NULL THEN ((r.k * 37) % 4000)::INT END AS response_time_ms, CASE WHEN seen THEN s.platform END AS platform,
  CASE WHEN seen THEN s.has_cart ELSE 0 END AS has_cart, CASE WHEN seen THEN s.has_product_schema ELSE 0 END AS has_product_schema, CASE WHEN seen THEN s.is_parked ELSE 0 END AS is_parked,
  CASE WHEN seen THEN s.lang END AS lang, (robots_reason IS NULL)::INT AS robots_allowed, coalesce(robots_reason, error) AS http_error,
  CASE WHEN robots_reason IS NOT NULL THEN 'blocked' WHEN code IS NULL THEN 'dead' WHEN s.is_parked = 1 THEN 'parked' WHEN code = 200 THEN 'live' ELSE 'error' END AS status,
  coalesce(starts_with(robots_reason, 'robots_unavailable'), false) OR coalesce(error = 'timeout' AND robots_reason IS NULL, false) AS inconclusive
FROM (SELECT *, robots_reason IS NULL AND code IS NOT NULL AS seen FROM http_raw) r JOIN signals s ON r.page = s.k""",
    "t3": """
SELECT t.* EXCLUDE (status, http_prior), http_prior + (h.domain IS NOT NULL)::INT AS http_attempts, CASE WHEN h.domain IS NULL OR (h.inconclusive AND http_prior + 1 < 3) THEN 0 ELSE 1 END AS http_checked,
  CASE WHEN NOT h.inconclusive THEN h.http_status END AS http_status, CASE WHEN NOT h.inconclusive THEN h.final_url END AS final_url, CASE WHEN NOT h.inconclusive THEN h.page_title END AS page_title,
  h.response_time_ms, CASE WHEN NOT h.inconclusive THEN h.platform END AS platform, CASE WHEN NOT h.inconclusive THEN h.has_cart END AS has_cart,
  CASE WHEN NOT h.inconclusive THEN h.has_product_schema END AS has_product_schema, CASE WHEN NOT h.inconclusive THEN h.is_parked END AS is_parked, CASE WHEN NOT h.inconclusive THEN h.lang END AS lang,
  CASE WHEN NOT h.inconclusive THEN h.robots_allowed END AS robots_allowed, h.http_error,
  CASE WHEN h.domain IS NULL THEN t.status WHEN NOT h.inconclusive THEN h.status WHEN http_prior + 1 < 3 THEN t.status WHEN h.status = 'blocked' THEN 'blocked' ELSE 'dead' END AS status
FROM t2 t LEFT JOIN http h ON t.domain = h.domain AND t.is_freemail = 0""",
    "scored": """
SELECT *, CASE WHEN status = 'freemail' THEN NULL WHEN status = 'dead' THEN 'does not resolve or nothing served' WHEN status = 'mx_only' THEN 'mail exchanger but no website'
    WHEN status = 'blocked' THEN 'robots.txt disallows the site root' WHEN status = 'parked' OR coalesce(is_parked, 0) = 1 THEN 'parked or for-sale page' WHEN status = 'aged_out' THEN NULL
    WHEN status <> 'live' THEN 'not live (status ' || status || ')' WHEN http_status IS DISTINCT FROM 200 THEN 'non-200 response (' || coalesce(http_status::VARCHAR, 'None') || ')'
    WHEN coalesce(has_cart, 0) = 0 THEN 'no cart or checkout link found' END AS why,
  greatest(0, least(100, 5 + CASE WHEN platform IN ('Shopify', 'WooCommerce') THEN 35 WHEN platform IN ('BigCommerce', 'Magento', 'PrestaShop', 'OpenCart') THEN 22 ELSE 10 END
    + 20 * coalesce(has_cart, 0) + 5 * coalesce(has_product_schema, 0) + CASE WHEN created_year >= 2024 THEN 15 WHEN created_year >= 2022 THEN 12 WHEN created_year >= 2020 THEN 6 ELSE 0 END
    + 15 * coalesce(has_mx, 0) + CASE WHEN response_time_ms < 2000 THEN 5 ELSE 0 END - 5 * is_role))::INT AS raw
FROM t3""",
    "t4": """
SELECT *, CASE WHEN status = 'pending' THEN NULL WHEN why IS NOT NULL THEN 'dropped' WHEN is_freemail = 1 OR jurisdiction NOT IN ('PERMISSIVE', 'PECR') OR coalesce(has_mx, 0) = 0 THEN 'tier2_ads'
    WHEN status = 'aged_out' OR points < 55 THEN 'tier3_nurture' ELSE 'tier1_email' END AS tier,
  CASE WHEN status = 'pending' THEN NULL WHEN why IS NOT NULL THEN 0 ELSE points END::INT AS score,
  CASE WHEN status = 'pending' THEN NULL WHEN why IS NOT NULL THEN why WHEN is_freemail = 1 THEN 'freemail contact: ads audience only, never email'
    WHEN jurisdiction NOT IN ('PERMISSIVE', 'PECR') THEN jurisdiction || ' jurisdiction: ads audience only, no cold email' WHEN coalesce(has_mx, 0) = 0 THEN 'no MX record: cannot be emailed, ads audience only'
    WHEN status = 'aged_out' THEN 'contact predates the crawl cutoff; not fetched' WHEN points < 55 THEN 'live but scores ' || points || ' (below 55)' ELSE 'cleared for cold email' END AS tier_reason
FROM (SELECT *, CASE WHEN status = 'live' THEN raw ELSE 0 END AS points FROM scored)""",
    "visit": """
SELECT t.domain, t.k, s.*  EXCLUDE (k), CASE WHEN t.k % 19 = 0 THEN 'robots_unavailable' WHEN t.k % 19 = 1 THEN 'robots_disallow' WHEN t.k % 19 = 2 THEN 'timeout' WHEN t.k % 19 = 3 THEN 'refused'
  WHEN t.k % 19 = 4 THEN 'http_404' END AS problem, t.k % 19 IN (0, 2) AS inconclusive,
  CASE WHEN s.k % 16 = 0 THEN NULL WHEN s.k % 8 = 0 THEN 'Jörg Müller' END AS foot, CASE WHEN t.k % 9 = 0 THEN 'Ana de Souza' END AS note
FROM t4 t JOIN signals s ON t.k % (SELECT count(*) FROM pages) = s.k WHERE t.is_freemail = 0 AND t.status = 'live'""",
    "profile": """
SELECT domain, inconclusive, problem AS profile_error, CASE WHEN ok THEN CASE WHEN person IS NOT NULL THEN 'https://www.linkedin.com/in/' || person WHEN company IS NOT NULL THEN 'https://www.linkedin.com/company/' || company
    WHEN short IS NOT NULL THEN 'https://lnkd.in/' || short END END AS linkedin_url,
  CASE WHEN ok THEN CASE WHEN person IS NOT NULL THEN 'personal' WHEN company IS NOT NULL THEN 'company' WHEN short IS NOT NULL THEN 'short' END END AS linkedin_kind,
  CASE WHEN ok THEN len(imgs)::INT END AS image_count, CASE WHEN ok THEN len(list_filter(imgs, lambda t: NOT regexp_matches(t, 'alt="[^"]+"')))::INT END AS images_no_alt,
  CASE WHEN ok AND len(imgs) > 0 THEN k * 100 END AS sample_image_bytes, CASE WHEN ok THEN coalesce(note, foot) END AS owner_name
FROM (SELECT *, problem IS NULL AS ok FROM visit)""",
    "t5": """
SELECT t.*, coalesce(t.k % 3, 0)::INT + (p.domain IS NOT NULL)::INT AS profile_attempts, CASE WHEN p.domain IS NULL OR (p.inconclusive AND t.k % 3 + 1 < 3) THEN 0 ELSE 1 END AS profile_checked, p.profile_error,
  CASE WHEN NOT p.inconclusive THEN p.linkedin_url END AS linkedin_url, CASE WHEN NOT p.inconclusive THEN p.linkedin_kind END AS linkedin_kind, CASE WHEN NOT p.inconclusive THEN p.image_count END AS image_count,
  CASE WHEN NOT p.inconclusive THEN p.images_no_alt END AS images_no_alt, CASE WHEN NOT p.inconclusive THEN p.sample_image_bytes END AS sample_image_bytes, CASE WHEN NOT p.inconclusive THEN p.owner_name END AS owner_name
FROM t4 t LEFT JOIN profile p ON t.domain = p.domain AND t.is_freemail = 0""",
}


def sql(last: str) -> str:
    """``last`` with the expressions it needs before it, in their order."""
    import re

    needed: set[str] = set()

    def add(part: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN) {name}\b", part):
                needed.add(name)
                add(CTES[name])

    add(last)
    parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + last
