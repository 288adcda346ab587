"""Column functions on addresses and contacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontora import schema as S
from kontora.functions import rules as R


def scan_emails(cell: Column) -> Column:
    """All candidate addresses of a cell, in order, as found."""
    return F.regexp_extract_all(cell, F.lit(R.EMAIL_SCAN), F.lit(0))


def clean_email(raw: Column) -> Column:
    """A trimmed, lower-case, valid address, or null."""
    trimmed = F.lower(F.btrim(F.btrim(raw, F.lit(" \t\n\r\x0b\x0c")), F.lit(R.EMAIL_TRIM)))
    email = F.regexp_replace(trimmed, "^mailto:", "")
    return F.when(email.rlike(R.EMAIL_VALID), email)


def is_header_row(cells: Column) -> Column:
    """A first row with a label in a cell of its own, and no address anywhere."""
    plain = F.transform(F.filter(cells, lambda c: c.isNotNull()), lambda c: F.lower(F.trim(c)))
    return F.arrays_overlap(plain, F.array(*(F.lit(w) for w in R.HEADER_WORDS))) & ~F.exists(plain, lambda c: c.rlike(R.EMAIL_SCAN))


def is_freemail(domain: Column) -> Column:
    brand = F.split_part(domain, F.lit("."), F.lit(1)).isin(R.FREEMAIL_BRANDS) & (F.regexp_count(domain, F.lit(r"\.")) <= 2)
    return domain.isin(R.FREEMAIL_DOMAINS) | brand


def is_role(local_part: Column) -> Column:
    return local_part.isin(R.ROLE_LOCALS)


def tld(domain: Column) -> Column:
    return F.element_at(F.split(domain, r"\."), -1)


def jurisdiction(domain: Column) -> Column:
    last = tld(domain)
    return (
        F.when(last.isin(R.EU_TLDS), "EU").when(last.isin(R.CASL_TLDS), "CASL").when(last.isin(R.PECR_TLDS), "PECR").when(last.isin(R.PERMISSIVE_TLDS), "PERMISSIVE").otherwise("OTHER")
    )


def classify(contacts: DataFrame) -> DataFrame:
    """``contacts`` (email, ...) with the nine columns that an address decides.

    The key is the domain of a store and the whole address of a freemail user.
    """
    domain, local = F.split_part("email", F.lit("@"), F.lit(2)), F.split_part("email", F.lit("@"), F.lit(1))
    free = is_freemail(F.col("domain"))
    return (
        contacts.withColumn("domain", domain)
        .withColumn("local_part", local)
        .withColumn("is_freemail", free.cast("int"))
        .withColumn("is_role", is_role(F.col("local_part")).cast("int"))
        .withColumn("tld", tld(F.col("domain")))
        .withColumn("jurisdiction", jurisdiction(F.col("domain")))
        .withColumn("target_key", F.when(free, F.col("email")).otherwise(F.col("domain")))
        .withColumn("status", F.when(free, S.FREEMAIL).otherwise(S.PENDING))
        .withColumn("created_year", F.year("created"))
    )
