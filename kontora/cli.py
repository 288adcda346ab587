"""Command line: ingest, dns, http, score, profile, export, outreach, status, verify."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontora import schema as S
from kontora.functions import rules as R
from kontora.functions.scoring import assign_tiers
from kontora.operators import crawl, ingest, queues, reports
from kontora.sources import xlsx
from kontora.sources.internet import HttpFetcher, UdpResolver
from kontora.sources.tables import Snapshots, settled

WORKBOOKS = {
    S.TIER1: ("tier1_email.xlsx", "Cleared for cold email."),
    S.TIER2: ("tier2_ads.xlsx", "Ads audience only. Never email."),
    S.TIER3: ("tier3_nurture.xlsx", "May be emailed, but not yet worth it."),
    S.DROPPED: ("dropped.xlsx", "Dropped, with the reason."),
}
#: Widths of columns, in characters; others follow their heading.
WIDTHS = {"domain": 30, "email": 36, "page_title": 48, "final_url": 48, "reason": 40}
#: What a sheet is for.
NOTES = {
    "best leads": "Shops with a cart, {n} images or more and a person or account to write to.",
    "image sites no cart": "{n} images or more and a contact, but nothing to buy: portfolios, galleries, catalogues.",
    "named owners": "The site names a person. See email_ok before any mail; another way in may be needed.",
    "linkedin only": "An account, but no name yet; a company's page has its people.",
    "image heavy no contact": "{n} images or more and only an address; write to it where email_ok says so.",
}


def is_figure(cell: str) -> bool:
    """A number as it is printed, with its signs and separators."""
    return bool(cell) and not cell.strip("0123456789,.%-+ ")


def text_table(rows: list[tuple], headings: list[str]) -> str:
    """Columns side by side; those of figures alone stand to the right."""
    columns = [[str(h), *("" if r[i] is None else str(r[i]) for r in rows)] for i, h in enumerate(headings)]
    printed = []
    for heading, *cells in columns:
        width, side = max(map(len, [heading, *cells])), ">" if cells and all(map(is_figure, cells)) else "<"
        printed.append([f"{heading:<{width}}", "-" * width, *(f"{c:{side}{width}}" for c in cells)])
    return "\n".join("  ".join(line).rstrip() for line in zip(*printed, strict=True))


def show(title: str, df: DataFrame) -> None:
    """Print a report, which has few rows."""
    figure = lambda v: f"{v:,}" if isinstance(v, int) else f"{v:.1f}" if isinstance(v, float) else v
    names = [c for c in df.columns if c != "position"]
    rows = [tuple(r[c] if c.endswith(("year", "low", "high")) else figure(r[c]) for c in names) for r in df.collect()]
    print(f"\n{title}\n{text_table(rows, names)}")


def files_frame(spark: SparkSession, paths: list[str]) -> DataFrame:
    rows = [(os.path.abspath(p), os.path.getsize(p), int(os.path.getmtime(p))) for p in paths]
    return spark.createDataFrame(rows, "path string, size bigint, mtime bigint")


def run_ingest(spark: SparkSession, db: str, data_dir: str, pattern: str, limit: int = 0, force: bool = False) -> int:
    """Merge all new workbooks at once; a file cut short is not entered in the ledger."""
    targets, ledger = Snapshots(spark, f"{db}/targets"), Snapshots(spark, f"{db}/ledger", S.LEDGER)
    paths = xlsx.discover(data_dir, pattern)
    if not paths:
        print(f"no {pattern} in {data_dir}", file=sys.stderr)
        return 1
    files = files_frame(spark, paths)
    fresh = sorted(r["path"] for r in (files if force else ingest.not_ingested(files, ledger.read())).collect())
    if not fresh:
        return 0
    # The place of a file in the list decides ties, as the order of merging would.
    parts = [xlsx.read(spark, path).withColumn("file_idx", F.lit(i)) for i, path in enumerate(fresh)]
    cells = parts[0]
    for more in parts[1:]:
        cells = cells.unionByName(more)
    known = targets.read()
    found = settled(_classified(ingest.first_wins(ingest.contacts_of(cells)).join(F.broadcast(spark.createDataFrame(list(enumerate(fresh)), "file_idx int, path string")), "file_idx")))
    targets.write(ingest.upsert(known, ingest.keep_newest(ingest.limit_per_file(found, limit))))
    # An organisation is new in the first file that has it.
    first = found.groupBy("target_key").agg(F.min("file_idx").alias("file_idx")).join(known.select("target_key"), "target_key", "left_anti")
    new = first.groupBy("file_idx").agg(F.count(F.lit(1)).alias("new_targets"))
    counts = found.groupBy("file_idx", "path").agg(F.count(F.lit(1)).alias("emails")).join(new, "file_idx", "left").drop("file_idx")
    done = files.filter(F.col("path").isin(fresh)).join(counts, "path", "left").na.fill(0, ["emails", "new_targets"])
    if limit:
        done = done.filter(F.col("emails") <= limit)
    ledger.write(ingest.ledger_after(ledger.read(), done.withColumn("ingested_at", F.current_timestamp())))
    show("ingested", reports.ingest_summary(targets.read()))
    return 0


def _classified(rows: DataFrame) -> DataFrame:
    from kontora.functions.contacts import classify

    return classify(rows.withColumn("created", F.date_trunc("second", "created").cast("timestamp_ntz")))


def run_score(spark: SparkSession, db: str, min_score: int, limit: int = 0) -> None:
    """Score all rows, or the first ``limit`` by key."""
    table = Snapshots(spark, f"{db}/targets")
    rows = table.read()
    stamp = lambda df: assign_tiers(df, min_score).withColumn("scored_at", F.current_timestamp())
    if not limit:
        table.write(stamp(rows))
        return
    some = rows.orderBy("target_key").limit(limit)
    table.write(stamp(some).unionByName(rows.join(some.select("target_key"), "target_key", "left_anti")))


def run_export(spark: SparkSession, db: str, out_dir: str) -> dict[str, int]:
    os.makedirs(out_dir, exist_ok=True)
    rows, counts = Snapshots(spark, f"{db}/targets").read(), {}
    for tier, (name, note) in WORKBOOKS.items():
        counts |= xlsx.write_workbook(f"{out_dir}/{name}", [xlsx.sheet_of(reports.tier_rows(rows, tier), tier, note, widths=WIDTHS)])
    return counts


def run_outreach(spark: SparkSession, db: str, path: str, min_images: int) -> dict[str, int]:
    sheets = reports.outreach_sheets(Snapshots(spark, f"{db}/targets").read(), min_images)
    return xlsx.write_workbook(path, [xlsx.sheet_of(df, name, NOTES[name].format(n=min_images), red={"email_ok": "NO"}) for name, df in sheets.items()])


def run_status(spark: SparkSession, db: str, min_year: int = R.MIN_YEAR) -> None:
    """The funnel, tiers, statuses and input files."""
    rows = Snapshots(spark, f"{db}/targets").read()
    show("progress", reports.funnel(rows, min_year).orderBy("position"))
    show("tiers", reports.summarize(rows.filter("tier is not null"), "tier"))
    show("statuses", reports.summarize(rows, "status"))
    show("contacts by year", reports.summarize(rows, "created_year", by_value=True))
    show("input files", Snapshots(spark, f"{db}/ledger", S.LEDGER).read().select("path", "emails", "new_targets").orderBy("path"))


def run_verify(spark: SparkSession, db: str, verify=None, limit: int = 0) -> int:
    """Verdicts of ``verify``, a function of rows (target_key, email) that returns
    (target_key, result), put in; how many addresses were given to it."""
    table = Snapshots(spark, f"{db}/targets")
    waiting = queues.verify_pending(table.read()).select("target_key", "email")
    waiting = settled(waiting.orderBy("target_key").limit(limit) if limit else waiting)
    n = waiting.count()
    if verify is not None and n:
        verdicts = waiting.select("target_key").join(verify(waiting), "target_key", "left").select("target_key", "result")
        table.write(queues.apply_verdicts(table.read(), settled(verdicts), F.current_timestamp()))
    return n


def run_crawl(spark: SparkSession, a: argparse.Namespace) -> int:
    """One of the stages dns, http and profile over what waits for it."""
    table = Snapshots(spark, f"{a.db}/targets")
    common = {"limit": a.limit, "force": a.force, "batch": a.batch, "max_attempts": a.max_attempts}
    servers, seconds, limits = [x for x in a.nameservers.split(",") if x], a.timeout, (a.connect_timeout, a.read_timeout)
    if a.command == "dns":
        n = crawl.run_dns(table, lambda: UdpResolver(servers, seconds), a.concurrency or 200, a.retries, **common)
        reports_of = {"DNS": reports.dns_summary, "mail providers": lambda t: reports.top(t, "mx_provider", 15)}
    elif a.command == "http":
        n = crawl.run_http(table, lambda: HttpFetcher(*limits), a.concurrency or 50, a.min_year, not a.ignore_robots, **common)
        reports_of = {"home pages": reports.http_summary, "platforms": lambda t: reports.top(t, "platform", 15), "errors": lambda t: reports.top(t, "http_error", 10)}
    else:
        n = crawl.run_profile(table, lambda: HttpFetcher(*limits), a.concurrency or 50, a.tier, [x for x in a.tld.split(",") if x], not a.no_image_probe, **common)
        reports_of = {"profiles": reports.profile_summary, "errors": lambda t: reports.top(t, "profile_error", 8)}
    print(f"{n:,} asked")
    for title, report in reports_of.items():
        show(title, report(table.read()))
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="kontora")
    p.add_argument("command", choices=["ingest", "dns", "http", "score", "profile", "export", "outreach", "status", "verify"])
    p.add_argument("--db", default="state", help="folder of the snapshots")
    p.add_argument("--limit", type=int, default=0)
    p.add_argument("--force", action="store_true")
    p.add_argument("--resume", action="store_true", help="the default; kept for scripts")
    p.add_argument("--data-dir", default=".")
    p.add_argument("--glob", default="*.xlsx")
    p.add_argument("--min-score", type=int, default=R.MIN_SCORE)
    p.add_argument("--min-year", type=int, default=R.MIN_YEAR)
    p.add_argument("--min-images", type=int, default=R.MIN_IMAGES)
    p.add_argument("--out-dir", default="out")
    p.add_argument("--no-workbooks", action="store_true")
    p.add_argument("--concurrency", type=int, default=0, help="requests at a time; 0 for the stage's own number")
    p.add_argument("--batch", type=int, default=crawl.BATCH, help="domains between two snapshots")
    p.add_argument("--max-attempts", type=int, default=R.MAX_ATTEMPTS)
    p.add_argument("--timeout", type=float, default=5.0, help="seconds for a DNS answer")
    p.add_argument("--retries", type=int, default=2)
    p.add_argument("--nameservers", default="", help="addresses with commas; the system's if left out")
    p.add_argument("--connect-timeout", type=float, default=10.0)
    p.add_argument("--read-timeout", type=float, default=15.0)
    p.add_argument("--ignore-robots", action="store_true")
    p.add_argument("--tier", choices=[S.TIER1, S.TIER2, S.TIER3, S.DROPPED])
    p.add_argument("--tld", default="", help="endings with commas")
    p.add_argument("--no-image-probe", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("kontora").getOrCreate()
    rows = Snapshots(spark, f"{a.db}/targets")
    if a.command == "ingest":
        return run_ingest(spark, a.db, a.data_dir, a.glob, a.limit, a.force)
    if a.command in ("dns", "http", "profile"):
        return run_crawl(spark, a)
    if a.command == "score":
        run_score(spark, a.db, a.min_score, a.limit)
        scored = rows.read()
        show("tiers", reports.shares(scored.filter("tier is not null"), "tier").orderBy("tier"))
        show("scores", reports.histogram(scored).orderBy("low"))
        show("first tier", reports.tier_stats(scored))
        show("its endings", reports.tier_tlds(scored))
        show("why dropped", reports.drop_reasons(scored))
        if not a.no_workbooks:
            print(run_export(spark, a.db, a.out_dir))
    elif a.command == "export":
        print(run_export(spark, a.db, a.out_dir))
    elif a.command == "outreach":
        os.makedirs(a.out_dir, exist_ok=True)
        print(run_outreach(spark, a.db, f"{a.out_dir}/outreach.xlsx", a.min_images))
    elif a.command == "status":
        run_status(spark, a.db, a.min_year)
    else:
        print(f"{run_verify(spark, a.db, limit=a.limit):,} addresses wait for a verdict; no verifier is connected, and none is ever probed by SMTP")
    return 0


if __name__ == "__main__":
    sys.exit(main())
