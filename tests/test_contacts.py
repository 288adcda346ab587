from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kontora import schema as S
from kontora.functions import contacts as C
from kontora.operators import ingest

D = lambda y: datetime(y, 1, 1)


def values(spark, column, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.v for r in df.select("i", column(F.col("x")).alias("v")).orderBy("i").collect()]


def test_clean_email(spark):
    cases = {"  Info@Shop.COM. ": "info@shop.com", "mailto:a@b.com": "a@b.com", "<x@y.de>": "x@y.de", "no address": None, "a@b": None, "a@@b.com": None, None: None, "": None}
    assert values(spark, C.clean_email, list(cases)) == list(cases.values())


def test_scan_finds_packed_addresses(spark):
    assert values(spark, C.scan_emails, ["a@beta.com:info@beta.com:sales@beta.com", "none", ""]) == [["a@beta.com", "info@beta.com", "sales@beta.com"], [], []]


def test_freemail(spark):
    cases = {"gmail.com": True, "gmx.de": True, "yahoo.co.uk": True, "outlook.mystore.com": True, "gmx.a.b.c": False, "mygmail.com": False, "shop.de": False}
    assert values(spark, C.is_freemail, list(cases)) == list(cases.values())


@pytest.mark.parametrize(("domain", "law"), [("a.de", "EU"), ("a.ca", "CASL"), ("a.co.uk", "PECR"), ("a.com.au", "PERMISSIVE"), ("a.com", "PERMISSIVE"), ("a.ru", "OTHER")])
def test_jurisdiction(spark, domain, law):
    assert values(spark, C.jurisdiction, [domain]) == [law]


def contacts(spark, rows):
    return C.classify(spark.createDataFrame(rows, "file_idx int, row_idx long, email string, created timestamp_ntz"))


def test_newest_contact_wins_and_ties_keep_the_first(spark):
    rows = [(0, 0, "a@store.com", D(2019)), (0, 1, "b@store.com", D(2024)), (0, 2, "c@store.com", D(2017)), (0, 3, "d@store.com", D(2024)), (0, 4, "u@new.com", None), (0, 5, "v@new.com", D(2001)), (0, 6, "x@gmail.com", None), (0, 7, "y@gmail.com", None)]
    got = {r.target_key: r for r in ingest.keep_newest(contacts(spark, rows)).collect()}
    assert (got["store.com"].email, got["store.com"].email_count) == ("b@store.com", 4)
    assert got["new.com"].email == "v@new.com"
    assert {"x@gmail.com", "y@gmail.com"} <= set(got)


def test_first_wins_even_over_a_newer_duplicate(spark):
    rows = spark.createDataFrame([(0, 0, "a@s.com", D(2019)), (0, 1, "a@s.com", D(2024)), (1, 0, "a@s.com", D(2020))], "file_idx int, row_idx long, email string, created timestamp_ntz")
    got = sorted((r.file_idx, r.created.year) for r in ingest.first_wins(rows).collect())
    assert got == [(0, 2019), (1, 2020)]


def test_upsert_moves_contact_columns_together_and_keeps_enrichment(spark):
    old = S.conform(ingest.keep_newest(contacts(spark, [(0, 0, "info@s.com", D(2020)), (0, 1, "a@keep.com", D(2022))]))).withColumn("platform", F.lit("Wix")).withColumn("status", F.lit(S.LIVE))
    new = ingest.keep_newest(contacts(spark, [(1, 0, "joe@s.com", D(2021)), (1, 1, "b@keep.com", D(2022)), (1, 2, "z@fresh.de", None)]))
    got = {r.target_key: r for r in ingest.upsert(old, new).collect()}
    assert (got["s.com"].email, got["s.com"].is_role, got["s.com"].email_count, got["s.com"].platform, got["s.com"].status) == ("joe@s.com", 0, 2, "Wix", "live")
    assert got["keep.com"].email == "a@keep.com" and got["keep.com"].email_count == 2
    assert got["fresh.de"].status == "pending" and got["fresh.de"].dns_attempts == 0


def test_conform_adds_columns_and_defaults(spark):
    row = S.conform(spark.createDataFrame([("k", None)], "target_key string, status string")).first()
    assert row.status == "pending" and row.email_count == 1 and row.http_attempts == 0 and row.owner_name is None
