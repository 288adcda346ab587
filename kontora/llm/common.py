"""Helpers shared by the training-data operators.

Nothing here knows about a particular operator.  The two rules every operator
follows: lineage is cut only through the cluster's shared checkpoint folder,
and column names made inside a plan start with ``PRIVATE`` so that they never
clash with columns of the caller.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRIVATE = "_kx_"
#: ASCII white space 0x09-0x0D and 0x20, as a Java character class and as bytes.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a session on one machine that names
    none gets a temporary folder, on a cluster that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="kontora-")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z alone.  ``lower`` is exact and fast on pure ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``.

    An expression named inside a lambda is otherwise run again for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(sizes: Column, block: int = 128) -> Column:
    """Exclusive prefix sums of an int array in about n * block / 2 steps.

    Two levels: totals of whole blocks first, then a short sum inside a block.
    """
    zero = F.lit(0).cast("long")

    def total(a: Column) -> Column:
        return F.aggregate(a, zero, lambda acc, x: acc + x)

    def blocks(a: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / block).cast("int"))
        sums = F.transform(starts, lambda b: total(F.slice(a, b * block + 1, F.lit(block))))
        return let(sums, lambda s: F.transform(starts, lambda b: total(F.slice(s, F.lit(1), b))))

    def inner(a: Column) -> Column:
        return let(
            blocks(a),
            lambda bs: F.transform(
                a,
                lambda _, i: F.get(bs, F.floor(i / block).cast("int"))
                + total(F.slice(a, (F.floor(i / block) * block).cast("int") + 1, i % block)),
            ),
        )

    return let(sizes, lambda a: F.when(F.size(a) > 0, inner(a)).otherwise(F.array().cast("array<bigint>")))


def small_enough(df: DataFrame, limit: int) -> bool:
    """True if ``df`` has at most ``limit`` rows; reads no more than it must."""
    return df.limit(limit + 1).count() <= limit


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches in parts of at most ``rows``, so that what a worker makes of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def extended(schema, **columns: str) -> str:
    """DDL of ``schema`` with columns put in place of equal names or added."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in columns]
    return ", ".join([*kept, *(f"`{k}` {v}" for k, v in columns.items())])
