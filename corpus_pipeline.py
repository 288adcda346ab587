"""A cleaning pipeline over ``documents``: five stages, each an operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontora.llm import common, decontamination, language_id, line_dedup, near_dedup, packing

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; ``und`` and ambiguous ones go.

    Null and empty texts and those without a letter are ``und``.  A null language
    teaches nothing, other null columns don't matter.  Repeated rows share a fate.
    Without labelled rows nothing is learned and every document goes.
    """
    model = language_id.train(docs, "doc_id", "text", "lang")
    out = language_id.identify(docs.select(*COLUMNS), model)
    return out.filter((F.col("lang_pred") != language_id.UNKNOWN) & ~F.col("ambiguous")).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; ``n_chars`` follows the text.

    No document goes.  Null text becomes empty.  Of ids that hold a line the largest
    keeps it, and so do all rows that repeat that id.
    """
    out = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def near_dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the least id.

    Texts without words are no duplicates and stay, as do rows with a null id.
    Rows that repeat an id that goes all go; those of one that stays all stay.
    """
    out = near_dedup.near_duplicates(docs)
    gone = out.filter(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Null and empty texts contain nothing.  Rows that share an id go together, of
    rows without an id those of equal text.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminate(docs, items).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their places; see ``packing.pack_documents``.

    Null and empty texts give one piece of one id; repeated rows are packed each.
    """
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup_documents),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: SQL cannot express the stages' models and tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; tables between them go to the shared folder."""
    place = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{place}/{k}_{name}")
            docs = spark.read.parquet(f"{place}/{k}_{name}")
    return docs
