"""A crawl stage over a table of snapshots, in batches.

Each batch is a range of hashed domains: its answers are written, settled into the
table and kept as a new snapshot, so a stage that is lost goes on after its last
batch.  Requests run once, since verdicts are made from what was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontora.functions.rules import MAX_ATTEMPTS, MIN_YEAR
from kontora.functions.urls import candidate_urls
from kontora.operators import observe, queues
from kontora.operators.settle import DNS, HTTP, PROFILE, Stage, settle
from kontora.sources import network
from kontora.sources.tables import Snapshots, settled

BATCH = 100_000


def in_batches(table: Snapshots, pending: DataFrame, ask: Callable[[DataFrame], DataFrame], judge: Callable[[DataFrame], DataFrame], stage: Stage, batch: int = BATCH, max_attempts: int = MAX_ATTEMPTS) -> int:
    """Ask for the pending rows and settle what comes back; how many there were."""
    pending = settled(pending)
    total = pending.count()
    parts = -(-total // batch)
    for k in range(parts):
        own = pending.filter(F.pmod(F.xxhash64("domain"), F.lit(parts)) == k)
        verdicts = judge(settled(ask(own)))
        table.write(settle(table.read(), verdicts, stage, F.current_timestamp(), max_attempts))
        table.prune()
    return total


def _selected(table: Snapshots, pending: DataFrame, stage: str, force: bool) -> DataFrame:
    """Forced rows may be tried as often as new ones."""
    pending = settled(pending)
    if force:
        table.write(queues.force_reset(table.read(), pending, stage))
    return pending


def run_dns(table: Snapshots, make, concurrency: int = 200, retries: int = 2, limit: int = 0, force: bool = False, batch: int = BATCH, max_attempts: int = MAX_ATTEMPTS) -> int:
    pending = _selected(table, queues.dns_pending(table.read(), force, limit), "dns", force)
    ask = lambda rows: network.dns_answers(rows, make, concurrency, retries)
    return in_batches(table, pending, ask, observe.dns_verdict, DNS, batch, max_attempts)


def run_http(table: Snapshots, make, concurrency: int = 50, min_year: int = MIN_YEAR, obey: bool = True, limit: int = 0, force: bool = False, batch: int = BATCH, max_attempts: int = MAX_ATTEMPTS) -> int:
    table.write(queues.age_out(table.read(), min_year))
    pending = _selected(table, queues.http_pending(table.read(), min_year, force, limit), "http", force)
    pending = pending.withColumn("urls", candidate_urls(F.col("domain"), F.col("a_host")))
    ask = lambda rows: network.http_responses(rows, make, concurrency, obey)
    return in_batches(table, pending, ask, observe.http_verdict, HTTP, batch, max_attempts)


def run_profile(table: Snapshots, make, concurrency: int = 50, tier: str | None = None, tlds=(), probe: bool = True, limit: int = 0, force: bool = False, batch: int = BATCH, max_attempts: int = MAX_ATTEMPTS) -> int:
    pending = _selected(table, queues.profile_pending(table.read(), tier, tlds, force, limit), "profile", force)
    pending = pending.withColumn("start_url", observe.start_url(F.col("domain"), F.col("a_host"), F.col("final_url")))
    ask = lambda rows: network.profile_visits(rows, make, concurrency, probe)
    return in_batches(table, pending, ask, observe.profile_verdict, PROFILE, batch, max_attempts)
