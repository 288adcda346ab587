from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import functions as F

from kontora import cli
from kontora import schema as S
from kontora.operators import ingest
from kontora.sources import xlsx
from kontora.sources.tables import Snapshots
from kontora.streaming.upsert import upsert_stream


def workbook(path):
    first = [("created", "emails"), (datetime(2020, 5, 1), "a@beta.com:info@beta.com:sales@beta.com"), (datetime(2024, 1, 2, 3, 4, 5), "info@alpha.com"), (datetime(2018, 1, 1), "x@alpha.com"), (datetime(2021, 1, 1), None), ("text", None)]
    second = [("mailto:hello@gamma.es", None), (None, "q@delta.co.uk", "junk"), ("mailto", "b\x08@c", "w@epsilon.ca")]
    return xlsx.write_workbook(str(path), [xlsx.Sheet("Sheet1", [], first), xlsx.Sheet("Sheet3", [], second)], header=False)


def test_round_trip_and_ingest(spark, tmp_path):
    assert workbook(tmp_path / "a.xlsx") == {"Sheet1": 6, "Sheet3": 3}
    rows = xlsx.read(spark, str(tmp_path))
    assert rows.count() == 9 and rows.filter("row_idx = 1 and sheet_idx = 0").first().cells[0].ts == datetime(2020, 5, 1)
    got = {r.target_key: r for r in ingest.ingest(rows, spark.createDataFrame([], S.TARGETS)).collect()}
    assert got["beta.com"].email_count == 3 and got["alpha.com"].email == "info@alpha.com" and got["alpha.com"].created == datetime(2024, 1, 2, 3, 4, 5)
    assert (got["gamma.es"].is_role, got["gamma.es"].jurisdiction, got["delta.co.uk"].jurisdiction, got["epsilon.ca"].jurisdiction) == (1, "EU", "PECR", "CASL")


def test_cli_resumes_by_ledger(spark, tmp_path, capsys):
    workbook(tmp_path / "a.xlsx")
    db = str(tmp_path / "db")
    total = lambda: Snapshots(spark, f"{db}/targets").read().agg({"email_count": "sum"}).first()[0]
    assert cli.run_ingest(spark, db, str(tmp_path), "*.xlsx", limit=2) == 0
    assert Snapshots(spark, f"{db}/ledger", S.LEDGER).read().count() == 0
    assert cli.run_ingest(spark, str(tmp_path / "db2"), str(tmp_path), "*.xlsx") == 0
    db = str(tmp_path / "db2")
    before = total()
    assert cli.run_ingest(spark, db, str(tmp_path), "*.xlsx") == 0 and total() == before
    assert cli.run_ingest(spark, db, str(tmp_path), "none*.xlsx") == 1
    cli.run_score(spark, db, 55)
    assert cli.run_export(spark, db, str(tmp_path / "out")) == {"tier1_email": 0, "tier2_ads": 0, "tier3_nurture": 0, "dropped": 0}
    assert sorted(os.listdir(tmp_path / "out")) == ["dropped.xlsx", "tier1_email.xlsx", "tier2_ads.xlsx", "tier3_nurture.xlsx"]
    assert set(cli.run_outreach(spark, db, str(tmp_path / "out" / "o.xlsx"), 20)) == {"best leads", "image sites no cart", "named owners", "linkedin only", "image heavy no contact"}
    cli.run_status(spark, db)
    assert "input files" in capsys.readouterr().out
    assert cli.run_verify(spark, db) == 0


def test_tables_of_the_console():
    assert cli.text_table([("a", "1,000"), ("b", "+2"), ("c", "- 3")], ["x", "number"]).splitlines() == ["x  number", "-  ------", "a   1,000", "b      +2", "c     - 3"]
    assert cli.text_table([("1", None), ("2", "5")], ["x", "n"]).splitlines()[2:] == ["1", "2  5"] and cli.text_table([], ["x"]) == "x\n-"


def test_many_workbooks_are_one_merge(spark, tmp_path):
    for name, rows in (("a", [(datetime(2020, 1, 1), "x@one.com:y@two.com")]), ("b", [(datetime(2022, 1, 1), "z@one.com:w@three.com")])):
        xlsx.write_workbook(str(tmp_path / f"{name}.xlsx"), [xlsx.Sheet("S", [], rows)], header=False)
    db = str(tmp_path / "db")
    assert cli.run_ingest(spark, db, str(tmp_path), "*.xlsx") == 0
    table = Snapshots(spark, f"{db}/targets")
    assert {r.target_key: (r.email, r.email_count) for r in table.read().collect()} == {"one.com": ("z@one.com", 2), "two.com": ("y@two.com", 1), "three.com": ("w@three.com", 1)}
    assert table.versions() == [0]
    ledger = Snapshots(spark, f"{db}/ledger", S.LEDGER).read().orderBy("path").collect()
    assert [(os.path.basename(r.path), r.emails, r.new_targets) for r in ledger] == [("a.xlsx", 2, 2), ("b.xlsx", 2, 1)]


def test_verdicts_of_a_verifier(spark, tmp_path):
    table = Snapshots(spark, f"{tmp_path}/db/targets")
    table.write(spark.createDataFrame([("a.com", "a@a.com", "tier1_email"), ("b.com", "b@b.com", "tier1_email"), ("c.com", "c@c.com", "dropped")], "target_key string, email string, tier string"))
    assert cli.run_verify(spark, f"{tmp_path}/db", lambda rows: rows.filter("email like 'a%'").select("target_key", F.lit("valid").alias("result")), limit=2) == 2
    assert {r.target_key: (r.verify_result, r.verify_status) for r in table.read().collect()} == {"a.com": ("valid", "done"), "b.com": ("unknown", "done"), "c.com": (None, None)}


def test_export_layout(tmp_path):
    path = str(tmp_path / "t.xlsx")
    xlsx.write_workbook(path, [xlsx.Sheet("t", ["domain", "score"], [("bad\x08.com", 5)], "note")])
    rows = dict(xlsx.Book(path).rows("xl/worksheets/sheet1.xml"))
    assert [c[1] for c in rows[2]] == ["domain", "score"] and [c[1] for c in rows[3]] == ["bad.com", "5"] and rows[0][0][1] == "note"


def test_snapshots_never_overwrite(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path / "s"))
    assert s.read().count() == 0
    s.write(spark.createDataFrame([("a", "pending")], "target_key string, status string"))
    s.write(s.read().withColumn("status", F.lit("live")))
    assert s.versions() == [0, 1] and s.read().first().status == "live" and s.read(0).first().status == "pending"
    s.prune(1)
    assert s.versions() == [1]


def test_stream_merges_batches(spark, tmp_path):
    ddl = "file_idx int, row_idx long, email string, created timestamp_ntz"
    src = str(tmp_path / "in")
    spark.createDataFrame([(0, 0, "a@s.com", datetime(2020, 1, 1))], ddl).write.parquet(src)
    snaps = Snapshots(spark, str(tmp_path / "t"))
    go = lambda: upsert_stream(spark.readStream.schema(ddl).parquet(src), snaps, str(tmp_path / "c")).awaitTermination()
    go()
    spark.createDataFrame([(1, 0, "b@s.com", datetime(2021, 1, 1))], ddl).write.mode("append").parquet(src)
    go()
    r = snaps.read().first()
    assert (r.email, r.email_count) == ("b@s.com", 2)
