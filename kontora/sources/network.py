"""Requests behind protocols, so that every stage also runs without a network.

A ``Resolver`` or ``Fetcher`` is made in each partition by a picklable factory.
Rows are dealt by host first, so that one task alone talks to a host; verdicts
must be written before they are read twice, or the requests are made again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import NamedTuple, Protocol
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontora.functions.rules import MAX_BODY_BYTES
from kontora.functions.urls import robots_verdict

TIMEOUT, ABSENT = "timeout", "absent"


class NoAnswer(Exception):
    """The name has no such record: an answer, never tried again."""


class Transient(Exception):
    """A timeout or a server that can't answer: worth another try."""


class Resolver(Protocol):
    def a(self, name: str) -> bool: ...

    def mx(self, name: str) -> list[tuple[str, int]]: ...


class Response(NamedTuple):
    status: int | None = None
    final_url: str | None = None
    headers: dict[str, str] | None = None
    body: bytes = b""
    elapsed_ms: int = 0
    error: str | None = None


class Fetcher(Protocol):
    def get(self, url: str, retry_timeout: bool = True, budget_s: float | None = None) -> Response: ...

    def head(self, url: str) -> Response: ...


def looked_up(ask: Callable, name: str, retries: int = 2, wait: float = 0.25, sleep=time.sleep) -> tuple[object, str | None]:
    """(answer, error): no answer is (None, None); transient failures are retried."""
    for attempt in range(retries + 1):
        try:
            return ask(name), None
        except NoAnswer:
            return None, None
        except Transient as e:
            problem = str(e) or type(e).__name__
            if attempt < retries:
                sleep(wait * (attempt + 1))
        except Exception as e:  # any other failure is final
            return None, type(e).__name__
    return None, problem


DNS_SCHEMA = "domain string, a_apex boolean, a_error string, a_www boolean, mx array<struct<exchange:string,preference:int>>, mx_error string"


def dns_answers(pending: DataFrame, make: Callable[[], Resolver], tasks: int = 64, retries: int = 2) -> DataFrame:
    """Raw answers of pending domains; www is asked only after a clean no."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resolver = make()
        for frame in frames:
            rows = []
            for domain in frame["domain"]:
                apex, error = looked_up(resolver.a, domain, retries)
                www = looked_up(resolver.a, f"www.{domain}", retries)[0] if not apex and error is None else None
                mx, mx_error = looked_up(resolver.mx, domain, retries)
                rows.append((domain, bool(apex), error, bool(www), [{"exchange": x, "preference": p} for x, p in mx or []], mx_error))
            yield pd.DataFrame(rows, columns=["domain", "a_apex", "a_error", "a_www", "mx", "mx_error"])

    return pending.select("domain").repartition(tasks, "domain").mapInPandas(run, DNS_SCHEMA)


HTTP_SCHEMA = "domain string, robots_reason string, status_code int, final_url string, headers map<string,string>, page string, content_length int, elapsed_ms int, error string"


def visit(fetcher: Fetcher, urls: list[str], obey: bool = True) -> tuple[str | None, Response]:
    """(robots reason, response) of the first URL that answers.

    Robots rules are asked once an origin.  A timeout ends the search, another
    failure tries the next URL.
    """
    known: set[str] = set()
    got = Response(error="none")
    for url in urls:
        origin = "{0}://{1}".format(*urlsplit(url)[:2])
        if obey and origin not in known:
            known.add(origin)
            rules = fetcher.get(f"{origin}/robots.txt", retry_timeout=False, budget_s=8)
            allowed, reason = robots_verdict(rules.status, rules.body, rules.error, f"{origin}/")
            if not allowed:
                return reason, Response()
        got = fetcher.get(url)
        if got.status is not None or got.error == TIMEOUT:
            break
    return None, got


def http_responses(pending: DataFrame, make: Callable[[], Fetcher], tasks: int = 64, obey: bool = True) -> DataFrame:
    """Responses of pending stores (domain, urls), at most 200 KB of body each."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = make()
        for frame in frames:
            rows = []
            for domain, urls in zip(frame["domain"], frame["urls"], strict=True):
                reason, r = visit(fetcher, list(urls), obey)
                body, headers = r.body[:MAX_BODY_BYTES], {k.lower(): v for k, v in (r.headers or {}).items()}
                declared = headers.get("content-length", "")
                size = int(declared) if declared.isdigit() else len(body)
                seen = r.status is not None
                rows.append((domain, reason, r.status, r.final_url, headers, body.decode("utf-8", "ignore") if seen else None, size if seen else None, r.elapsed_ms, r.error))
            out = pd.DataFrame(rows, columns=["domain", "robots_reason", "status_code", "final_url", "headers", "page", "content_length", "elapsed_ms", "error"])
            yield out.astype({"status_code": "Int32", "content_length": "Int32", "elapsed_ms": "Int32"})

    return pending.select("domain", "urls").repartition(tasks, "domain").mapInPandas(run, HTTP_SCHEMA)


def image_head(r: Response) -> tuple[int | None, str | None]:
    """(bytes, type) of an image from the answer to a HEAD request."""
    if r.status != 200:
        return None, None
    headers = {k.lower(): v for k, v in (r.headers or {}).items()}
    size = headers.get("content-length", "")
    return (int(size) if size.isdigit() else None), (headers.get("content-type") or "")[:60] or None


VISIT_SCHEMA = "domain string, start_url string, robots_reason string, status_code int, error string, final_url string, page string, legal_page string, rules_status int, rules_body binary, rules_error string"
PROFILE_COLUMNS = ("domain", "start_url", "robots_reason", "status_code", "error", "final_url", "page", "legal_page", "image_bytes", "image_type")


def profile_visits(pending: DataFrame, make: Callable[[], Fetcher], tasks: int = 64, probe: bool = True) -> DataFrame:
    """Visits of live stores (domain, start_url): home page, legal notice, image.

    The rules of the home page's origin hold for all three requests.  Which image is
    asked for is worked out from the pages, which are written first.
    """
    from kontora.functions.pages import audit_images
    from kontora.functions.urls import robots_allows
    from kontora.sources.tables import settled

    seen = settled(_visited(pending, make, tasks))
    if not probe:
        return seen.withColumn("image_bytes", F.lit(None).cast("bigint")).withColumn("image_type", F.lit(None).cast("string")).select(*PROFILE_COLUMNS)
    pages = seen.filter("page is not null")
    sample = pages.select("domain", "rules_status", "rules_body", "rules_error", audit_images(F.col("page"), F.coalesce("final_url", "start_url"))["sample_image_url"].alias("url")).filter("url is not null")
    allowed = sample.withColumn("may", robots_allows(F.col("rules_status"), F.col("rules_body"), F.col("rules_error"), F.col("url"))["allowed"]).filter("may").select("domain", "url")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = make()
        for frame in frames:
            rows = [(d, *image_head(fetcher.head(u))) for d, u in zip(frame["domain"], frame["url"], strict=True)]
            yield pd.DataFrame(rows, columns=["domain", "image_bytes", "image_type"]).astype({"image_bytes": "Int64"})

    images = allowed.repartition(tasks, "domain").mapInPandas(run, "domain string, image_bytes bigint, image_type string")
    return seen.join(images, "domain", "left").select(*PROFILE_COLUMNS)


def _visited(pending: DataFrame, make: Callable[[], Fetcher], tasks: int) -> DataFrame:
    import re
    from urllib.parse import urljoin

    from kontora.functions import rules as R

    legal = re.compile(R.LEGAL_PAGE, re.I)

    def one(fetcher: Fetcher, domain: str, start: str) -> tuple:
        origin = "{0}://{1}".format(*urlsplit(start)[:2])
        rules = fetcher.get(f"{origin}/robots.txt", retry_timeout=False, budget_s=8)
        may = lambda url: robots_verdict(rules.status, rules.body, rules.error, url)
        told = (rules.status, rules.body, rules.error)
        allowed, reason = may(start)
        if not allowed:
            return domain, start, reason, None, None, None, None, None, *told
        home = fetcher.get(start)
        if home.status != 200:
            return domain, start, None, home.status, home.error, home.final_url, None, None, *told
        page, notice = home.body[:MAX_BODY_BYTES].decode("utf-8", "ignore"), None
        if (m := legal.search(page)) and may(url := urljoin(home.final_url or start, m[1]))[0]:
            got = fetcher.get(url, retry_timeout=False)
            notice = got.body[:MAX_BODY_BYTES].decode("utf-8", "ignore") if got.status == 200 else None
        return domain, start, None, 200, None, home.final_url, page, notice, *told

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = make()
        for frame in frames:
            rows = [one(fetcher, d, s) for d, s in zip(frame["domain"], frame["start_url"], strict=True)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in VISIT_SCHEMA.split(", ")]).astype({"status_code": "Int32", "rules_status": "Int32"})

    return pending.select("domain", "start_url").repartition(tasks, F.col("domain")).mapInPandas(run, VISIT_SCHEMA)
