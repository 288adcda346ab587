"""Column functions on hosts, URLs and robots rules."""

from __future__ import annotations

from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

AGENT = "kontora/1.0 (+https://example.com/crawler)"


def candidate_urls(domain: Column, a_host: Column) -> Column:
    """URLs to try, in order; a host known to answer only as www starts there."""
    host = F.coalesce(F.nullif(a_host, F.lit("")), domain)
    url = lambda scheme, name: F.concat(F.lit(f"{scheme}://"), name, F.lit("/"))
    www = F.array(url("https", host), url("http", host), url("https", domain))
    apex = F.array(url("https", domain), url("http", domain), url("https", F.concat(F.lit("www."), domain)))
    return F.when(host.startswith("www."), www).otherwise(apex)


def host(url: Column) -> Column:
    """Host and port without a leading www., in lower case."""
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("AUTHORITY"))), r"^www\.", "")


def robots_verdict(status: int | None, body: bytes | None, error: str | None, url: str, agent: str = AGENT) -> tuple[bool, str | None]:
    """(allowed, reason) from the answer to a request for robots.txt.

    No answer and 4xx allow everything; 5xx is a refusal for now, not for good.
    """
    if error or status is None:
        return True, None
    if 500 <= status < 600:
        return False, f"robots_unavailable_{status}"
    if status >= 400:
        return True, None
    rules = RobotFileParser()
    try:
        rules.parse((body or b"").decode("utf-8", "ignore").splitlines())
        allowed = rules.can_fetch(agent, url)
    except ValueError:
        return True, None
    return (True, None) if allowed else (False, "robots_disallow")


def robots_allows(status: Column, body: Column, error: Column, url: Column) -> Column:
    """struct(allowed, reason) of each row's robots answer and URL."""

    @F.pandas_udf("struct<allowed:boolean,reason:string>")
    def judge(s: pd.Series, b: pd.Series, e: pd.Series, u: pd.Series) -> pd.DataFrame:
        rows = [robots_verdict(None if pd.isna(x) else int(x), y, z, w) for x, y, z, w in zip(s, b, e, u, strict=True)]
        return pd.DataFrame(rows, columns=["allowed", "reason"])

    return judge(status, body, error, url)
