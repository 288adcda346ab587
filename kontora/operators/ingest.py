"""Ingest: cells to contacts, first wins in a file, newest wins per target.

Order of arrival is (file_idx, sheet_idx, row_idx, col_idx, match_idx); it
decides ties, so every step works on sets and none on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontora import schema as S
from kontora.functions import contacts as C

ORDER = ("file_idx", "sheet_idx", "row_idx", "col_idx", "match_idx")
#: Columns that move together when a newer contact takes over.
CONTACT = ("email", "local_part", "created", "created_year", "is_role", "source_file", "source_sheet")


def contacts_of(cells: DataFrame) -> DataFrame:
    """One row per valid address of workbook cells.

    ``cells`` has file_idx, source_file, sheet_idx, source_sheet, row_idx and
    ``cells`` array<struct<kind, str, ts>>.  A row's timestamp is its first date
    cell, in whatever place.
    """
    when = F.try_element_at(F.filter("cells", lambda c: c["ts"].isNotNull()), F.lit(1))["ts"]
    rows = cells.select("file_idx", "source_file", "sheet_idx", "source_sheet", "row_idx", when.alias("created"), F.posexplode("cells").alias("col_idx", "cell"))
    rows = rows.filter(F.col("cell.kind") == "str")
    found = rows.select("*", F.posexplode(C.scan_emails(F.col("cell.str"))).alias("match_idx", "raw")).withColumn("email", C.clean_email(F.col("raw")))
    return found.filter("email is not null").drop("cell", "raw")


def first_wins(contacts: DataFrame, per: tuple[str, ...] = ("file_idx", "email")) -> DataFrame:
    """The first arrival of each address in a file; later ones are ignored even
    when newer.  A hash aggregation of structs: no sort, no window."""
    order = [c for c in ORDER if c in contacts.columns]
    rest = [c for c in contacts.columns if c not in per and c not in order]
    best = contacts.groupBy(*per).agg(F.min(F.struct(*order, *rest)).alias("x"))
    return best.select(*per, *(F.col(f"x.{c}") for c in [*order, *rest] if c not in per))


def keep_newest(contacts: DataFrame) -> DataFrame:
    """One row per target: the newest contact, and how many arrived.

    Undated contacts lose to dated ones; of equals the earlier arrival stays.
    ``contacts`` are classified and, per file, distinct.
    """
    order = [c for c in ORDER if c in contacts.columns]
    contact = [c for c in CONTACT if c in contacts.columns and c != "created"]
    key = F.struct("created", *((-F.col(c)).alias(c) for c in order), *contact)
    fixed = [c for c in ("domain", "is_freemail", "tld", "jurisdiction", "status") if c in contacts.columns]
    out = contacts.groupBy("target_key").agg(F.max(key).alias("x"), F.count(F.lit(1)).cast("int").alias("email_count"), *(F.any_value(c).alias(c) for c in fixed))
    return out.select("target_key", "x.created", *(F.col(f"x.{c}") for c in contact), "email_count", *fixed)


def upsert(targets: DataFrame, batch: DataFrame) -> DataFrame:
    """``targets`` with ``batch`` (of ``keep_newest``) merged in.

    A contact is replaced only by one that is strictly newer, or by any dated one
    if it has no date; the seven contact columns move together.  Counts add up,
    everything that was learned since stays.
    """
    old, new = targets.alias("o"), batch.alias("n")
    both = old.join(new, F.col("o.target_key") == F.col("n.target_key"), "full_outer")
    is_new, absent = F.col("o.target_key").isNull(), F.col("n.target_key").isNull()
    newer = F.col("n.created").isNotNull() & (F.col("o.created").isNull() | (F.col("n.created") > F.col("o.created")))
    take = is_new | (~absent & F.coalesce(newer, F.lit(False)))
    columns = []
    for c in targets.columns:
        o = F.col(f"o.{c}")
        n = F.col(f"n.{c}") if c in batch.columns else F.lit(S.DEFAULTS.get(c))
        if c == "email_count":
            value = F.coalesce(o, F.lit(0)) + F.coalesce(n, F.lit(0))
        elif c in CONTACT:
            value = F.when(take, n).otherwise(o)
        else:
            value = F.when(is_new, n).otherwise(o)
        columns.append(value.cast(targets.schema[c].dataType).alias(c))
    return both.select(*columns)


def not_ingested(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files (path, size, mtime) that the ledger doesn't have in this very state."""
    return files.join(ledger.select("path", "size", "mtime"), ["path", "size", "mtime"], "left_anti")


def ledger_after(ledger: DataFrame, done: DataFrame) -> DataFrame:
    """The ledger with ``done`` put in by path."""
    return ledger.join(done.select("path"), "path", "left_anti").unionByName(done, allowMissingColumns=True)


def file_stats(contacts: DataFrame) -> DataFrame:
    """Addresses, duplicates and distinct addresses of each file."""
    return contacts.groupBy("file_idx").agg(
        F.count(F.lit(1)).alias("found"), F.countDistinct("email").alias("emails"), (F.count(F.lit(1)) - F.countDistinct("email")).alias("dupes")
    )


def limit_per_file(contacts: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` distinct addresses of each file, 0 for all."""
    if not limit:
        return contacts
    from pyspark.sql import Window as W

    order = [F.col(c) for c in ORDER if c in contacts.columns]
    return contacts.withColumn("_n", F.row_number().over(W.partitionBy("file_idx").orderBy(*order))).filter(F.col("_n") <= limit).drop("_n")


def ingest(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """Cells of new files merged into ``targets``."""
    return upsert(S.conform(targets), keep_newest(C.classify(first_wins(contacts_of(cells)))))


def unescaped(c: Column) -> Column:
    """A value that a workbook can hold."""
    from kontora.functions import rules as R

    return F.regexp_replace(c, R.ILLEGAL_CELL, "")
