from __future__ import annotations

import sys
from datetime import datetime

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from kontora import schema as S
from kontora.functions.scoring import assign_tiers
from kontora.operators import observe, queues, reports
from kontora.operators.settle import DNS, HTTP, PROFILE, settle
from kontora.sources import network as N

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers have no tests
NOW = datetime(2025, 1, 1)
GOOD = {"target_key": "s.com", "domain": "s.com", "status": "live", "platform": "Shopify", "has_cart": 1, "has_product_schema": 1, "created_year": 2024, "has_mx": 1, "response_time_ms": 500, "is_role": 0, "is_freemail": 0, "is_parked": 0, "http_status": 200, "jurisdiction": "PERMISSIVE"}


def targets(spark, *rows):
    ddl = {f.name: f.dataType.simpleString() for f in S.TARGETS.fields}
    names = sorted({k for r in rows for k in r})
    return S.conform(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} {ddl[n]}" for n in names)))


@pytest.mark.parametrize(
    ("change", "tier", "score", "reason"),
    [({}, S.TIER1, 100, "cleared for cold email"), ({"status": "pending"}, None, None, None), ({"status": "freemail", "is_freemail": 1}, S.TIER2, 0, "freemail contact: ads audience only, never email"),
     ({"jurisdiction": "EU"}, S.TIER2, 100, "EU jurisdiction: ads audience only, no cold email"), ({"has_mx": None}, S.TIER2, 85, "no MX record: cannot be emailed, ads audience only"), ({"status": "aged_out"}, S.TIER3, 0, "contact predates the crawl cutoff; not fetched"),
     ({"platform": "Wix", "has_mx": 1, "created_year": None, "has_product_schema": 0, "response_time_ms": None}, S.TIER3, 50, "live but scores 50 (below 55)"), ({"has_cart": None}, S.DROPPED, 0, "no cart or checkout link found"),
     ({"http_status": None}, S.DROPPED, 0, "non-200 response (None)"), ({"is_parked": 1}, S.DROPPED, 0, "parked or for-sale page"), ({"status": "error"}, S.DROPPED, 0, "not live (status error)"), ({"status": "blocked", "jurisdiction": "EU"}, S.DROPPED, 0, "robots.txt disallows the site root")],
)
def test_tiers(spark, change, tier, score, reason):
    r = assign_tiers(targets(spark, GOOD | change)).first()
    assert (r.tier, r.score, r.tier_reason) == (tier, score, reason)


class Scripted:
    """DNS answers by (name, kind); what is missing has no answer."""

    def __init__(self, answers):
        self.answers = answers

    def _get(self, name, kind):
        got = self.answers.get((name, kind), N.NoAnswer())
        if isinstance(got, Exception):
            raise got
        return got

    def a(self, name):
        return self._get(name, "A")

    def mx(self, name):
        return self._get(name, "MX")


SLOW = N.Transient("Timeout")


@pytest.mark.parametrize(
    ("answers", "want"),
    [({("s.com", "A"): SLOW, ("s.com", "MX"): SLOW}, (0, None, 0, "dead", True)), ({}, (0, None, 0, "dead", False)), ({("s.com", "A"): True, ("s.com", "MX"): SLOW}, (1, "s.com", 0, None, False)),
     ({("s.com", "MX"): [("mx.mail.com.", 10)]}, (0, None, 1, "mx_only", False)), ({("www.s.com", "A"): True}, (1, "www.s.com", 0, None, False)), ({("s.com", "MX"): SLOW}, (0, None, 0, "dead", False)), ({("www.s.com", "A"): SLOW}, (0, None, 0, "dead", False))],
)
def test_dns(spark, answers, want):
    df = N.dns_answers(spark.createDataFrame([("s.com",)], "domain string"), lambda: Scripted(answers), tasks=1, retries=0)
    r = observe.dns_verdict(df).first()
    assert (r.dns_resolves, r.a_host, r.has_mx, r.status, r.inconclusive) == want


def test_lowest_preference_wins(spark):
    df = N.dns_answers(spark.createDataFrame([("s.com",)], "domain string"), lambda: Scripted({("s.com", "MX"): [("Backup.x.", 50), ("Primary.Mail.com.", 10), ("later.x", 10)]}), tasks=1)
    assert observe.dns_verdict(df).first().mx_provider == "primary.mail.com"


def test_retries_stop_at_an_answer():
    seen = []

    def ask(name):
        seen.append(name)
        raise N.Transient("Timeout") if len(seen) < 3 else N.NoAnswer

    assert N.looked_up(ask, "x", retries=5, sleep=lambda s: None) == (None, None) and len(seen) == 3


class Web:
    """Responses by text of the URL, first match; otherwise a timeout."""

    def __init__(self, *pairs):
        self.pairs, self.asked = pairs, []

    def get(self, url, retry_timeout=True, budget_s=None):
        self.asked.append(url)
        return next((r for part, r in self.pairs if part in url), N.Response(error=N.TIMEOUT))

    def head(self, url):
        return self.get(url)


PAGE = b'<html lang="en"><title>Shop</title><script src="https://cdn.shopify.com/a.js"></script><a href="/cart">c</a></html>'
NONE = ("robots", N.Response(404))
URLS = ["https://s.com/", "http://s.com/", "https://www.s.com/"]


@pytest.mark.parametrize(
    ("web", "want"),
    [((NONE,), ("dead", None, True)), ((NONE, ("s.com", N.Response(error="refused"))), ("dead", None, False)), ((NONE, ("https://s.com", N.Response(200, "https://s.com/", {}, PAGE, 5))), ("live", "Shopify", False)),
     ((NONE, ("s.com", N.Response(200, "u", {}, b"<title>domain for sale</title>", 5))), ("parked", None, False)), ((NONE, ("s.com", N.Response(503, "u", {}, b"", 5))), ("error", None, False)),
     ((NONE, ("https://", N.Response(error="refused")), ("http://s.com/", N.Response(200, "u", {}, PAGE, 5))), ("live", "Shopify", False)), ((("robots", N.Response(200, body=b"User-agent: *\nDisallow: /")),), ("blocked", None, False)), ((("robots", N.Response(503)),), ("blocked", None, True))],
)
def test_http(spark, web, want):
    df = N.http_responses(spark.createDataFrame([("s.com", URLS)], "domain string, urls array<string>"), lambda: Web(*web), tasks=1)
    r = observe.http_verdict(df).first()
    assert (r.status, r.platform, r.inconclusive) == want


def test_a_timeout_ends_the_search():
    web = Web(NONE)
    N.visit(web, URLS)
    assert web.asked == ["https://s.com/robots.txt", "https://s.com/"]


def test_profile(spark):
    home = b'<a href="/impressum">i</a><img src="/p.jpg" alt="p"><p>Owner: Jane Roe</p>'
    web = (("robots", N.Response(404)), ("impressum", N.Response(200, body="Inhaber: Jörg Müller https://linkedin.com/in/jm".encode())), ("p.jpg", N.Response(200, headers={"Content-Length": "2048", "Content-Type": "image/jpeg"})), ("s.com", N.Response(200, "https://s.com/", {}, home)))
    df = N.profile_visits(spark.createDataFrame([("s.com", "https://s.com/")], "domain string, start_url string"), lambda: Web(*web), tasks=1)
    r = observe.profile_verdict(df).first()
    assert (r.owner_name, r.owner_source, r.linkedin_kind, r.sample_image_bytes, r.legal_url, r.profile_error) == ("Jörg Müller", "legal_notice", "personal", 2048, "https://s.com/impressum", None)


@pytest.mark.parametrize(("attempts", "status", "stamped"), [(0, "pending", False), (2, "dead", True)])
def test_inconclusive_dns(spark, attempts, status, stamped):
    v = spark.createDataFrame([("s.com", 0, None, 0, None, "Timeout", "dead", True)], "domain string, dns_resolves int, a_host string, has_mx int, mx_provider string, dns_error string, status string, inconclusive boolean")
    t = targets(spark, {"target_key": "s.com", "domain": "s.com", "dns_attempts": attempts, "is_freemail": 0}, {"target_key": "x@s.com", "domain": "s.com", "is_freemail": 1, "status": "freemail"})
    got = {r.target_key: r for r in settle(t, v, DNS, F.lit(NOW)).collect()}
    r = got["s.com"]
    assert (r.status, r.dns_attempts, r.dns_checked_at is not None, r.dns_resolves) == (status, attempts + 1, stamped, 0 if stamped else None)
    assert got["x@s.com"].dns_attempts == 0


def test_one_domain_of_most_rows_never_enters_the_join(spark):
    """Freemail rows of one domain are nine in ten."""
    v = spark.createDataFrame([("s.com", 1, "s.com", 0, None, None, None, False)], "domain string, dns_resolves int, a_host string, has_mx int, mx_provider string, dns_error string, status string, inconclusive boolean")
    rows = spark.range(1000).selectExpr("concat('u', id, if(id % 10 = 0, '.com', '@s.com')) AS target_key", "if(id = 0, 's.com', if(id % 10 = 0, concat('u', id, '.com'), 's.com')) AS domain", "if(id % 10 = 0, 0, 1) AS is_freemail")
    out = settle(S.conform(rows), v, DNS, F.lit(NOW))
    assert out.count() == 1000 and [r.target_key for r in out.filter("dns_checked_at is not null").collect()] == ["u0.com"]
    joined = out._jdf.queryExecution().optimizedPlan().toString()
    assert "is_freemail" in joined.split("Join LeftOuter")[1].split("Filter", 1)[1]


def test_limits_and_orders_of_queues(spark):
    t = targets(spark, *({"target_key": f"{k}.com", "domain": f"{k}.com", "status": "live", "score": s, "tier": S.TIER1, "tld": "com", "is_freemail": 0, "dns_resolves": 1} for k, s in (("a", 5), ("b", 9), ("c", None), ("d", 9))))
    assert [r.domain for r in queues.profile_pending(t, tier=S.TIER1, tlds=("com",), limit=3).collect()] == ["b.com", "d.com", "a.com"]
    assert [r.domain for r in queues.dns_pending(t, limit=2).collect()] == ["a.com", "b.com"]
    assert [r.score for r in reports.summarize(t, "score", by_value=True).collect()] == [5, 9, None]


def test_fixed_values_are_what_they_were():
    from kontora.functions import rules as R

    assert {"gmail.com", "web.de", "t-online.de"} <= set(R.FREEMAIL_DOMAINS) and len(R.FREEMAIL_DOMAINS) == 28 and len(R.ROLE_LOCALS) == 20 and len(R.EU_TLDS) == 28
    assert (R.BASE_POINTS, R.CART_POINTS, R.SCHEMA_POINTS, R.MX_POINTS, R.FAST_POINTS, R.ROLE_POINTS, R.FAST_MS) == (5, 20, 5, 15, 5, -5, 2000)
    assert R.RECENCY_POINTS == ((2024, 15), (2022, 12), (2020, 6)) and R.PLATFORM_POINTS["Shopify"] == 35 and (R.MIN_YEAR, R.MIN_SCORE, R.MAX_ATTEMPTS, R.MIN_IMAGES) == (2020, 55, 3, 20)


def test_blocked_stays_blocked_at_the_last_attempt(spark):
    v = observe.http_verdict(N.http_responses(spark.createDataFrame([("s.com", URLS)], "domain string, urls array<string>"), lambda: Web(("robots", N.Response(503))), tasks=1))
    r = settle(targets(spark, {"target_key": "s.com", "domain": "s.com", "http_attempts": 2, "robots_allowed": 1}), v, HTTP, F.lit(NOW)).first()
    assert (r.status, r.robots_allowed, r.http_error, r.http_checked_at is not None) == ("blocked", 1, "robots_unavailable_503", True)


def test_profile_error_keeps_status(spark):
    v = observe.profile_verdict(N.profile_visits(spark.createDataFrame([("s.com", "https://s.com/")], "domain string, start_url string"), lambda: Web(("robots", N.Response(404))), tasks=1))
    r = settle(targets(spark, GOOD | {"profile_attempts": 2, "owner_name": "Old"}), v, PROFILE, F.lit(NOW)).first()
    assert (r.status, r.profile_error, r.owner_name, r.profile_checked_at is not None) == ("live", "timeout", "Old", True)


def test_age_out_and_queue(spark):
    rows = [{"target_key": f"{y}.com", "domain": f"{y}.com", "dns_resolves": 1, "created_year": y, "status": "pending"} for y in (2010, 2021, 2024, None)]
    t = queues.age_out(targets(spark, *rows))
    assert {r.domain: r.status for r in t.collect()}["2010.com"] == "aged_out"
    assert [r.domain for r in queues.http_pending(t).collect()] == ["2024.com", "2021.com", "None.com"]


def test_empty_reports(spark):
    t = assign_tiers(targets(spark, GOOD)).limit(0)
    assert [r.n for r in reports.funnel(t).collect()] == [0] * 13
    assert [r.n for r in reports.histogram(t).orderBy("low").collect()] == [0] * 10
