"""The database by JDBC (Derby comes with Spark), and mails as a command."""

import io
import json

import pytest
from pyspark.sql import functions as F

from jobloom.__main__ import main
from jobloom.plans import flows
from jobloom.sources import boards, database, queue
from jobloom.sources.database import Database


def test_where_the_database_is():
    five = {"DB_HOST": "h", "DB_PORT": "5433", "DB_NAME": "d", "DB_USER": "u", "DB_PASSWORD": ""}
    assert database.database(five | {"DATABASE_URL": "postgres://x/y"}) == Database("jdbc:postgresql://h:5433/d?sslmode=prefer", "u", "")
    for missing in five:
        rest = {k: v for k, v in five.items() if k != missing}
        assert database.database(rest | {"DATABASE_URL": "postgresql://a%40b:p%3A@db/name?sslmode=require"}) == Database("jdbc:postgresql://db:5432/name?sslmode=require", "a@b", "p:")
        with pytest.raises(ValueError, match="DB_PASSWORD, or DATABASE_URL"):
            database.database(rest)


def test_tables_by_jdbc(spark):
    db = database.database({"DATABASE_URL": "jdbc:derby:memory:jobloom;create=true"})
    db.driver = "org.apache.derby.jdbc.EmbeddedDriver"
    rows = spark.range(1000).selectExpr("CAST(id AS INT) AS id", "concat('n', id % 10) AS name")
    database.write_table(rows, db, "sources", types="name VARCHAR(20)")
    read = database.read_table(spark, db, "sources", "id", split_rows=300)
    assert read.rdd.getNumPartitions() == 4 and read.count() == 1000 and read.filter("id >= 990").count() == 10
    assert [tuple(r) for r in database.lookup(spark, db, "sources", "name", "n7").collect()] == [(7, "n7")]
    database.write_table(rows.limit(5), db, "sources")
    assert database.read_table(spark, db, "sources").count() == 1005
    database.write_table(rows.filter("id < 3"), db, "sources", replace=True)
    assert sorted(r.id if hasattr(r, "id") else r[0] for r in database.read_table(spark, db, "sources", "id").collect()) == [0, 1, 2]


def test_mails_of_folders_are_read_once(spark, tmp_path):
    for i in range(450):
        (tmp_path / "in" / str(i // 230)).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / str(i // 230) / f"{i}.eml").write_bytes(f"Subject: S{i}\nFrom: a@b\nContent-Type: text/html\n\n<p><a href='https://jobs.lever.co/{i}'>Dev</a></p>".encode())
    mails, read = boards.read_mail_folders(spark, str(tmp_path / "in")), spark.sparkContext.accumulator(0)
    by_file = boards.mails(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path / "in")))
    rows = lambda df: sorted((r.path.removeprefix("file:"), r.subject, r.sender, r.html) for r in df.collect())
    assert rows(mails) == rows(by_file) and mails.count() == 450

    def counted(s):
        read.add(1)
        return s

    sent = [json.loads(r.body)["payload"] for r in flows.newsletter(mails.withColumn("sender", F.udf(counted, "string")("sender")), F.lit("2024-01-01")).collect()]
    assert sorted((p["url"], p["email_subject"], p["email_sender"]) for p in sent) == sorted((f"https://jobs.lever.co/{i}", f"S{i}", "a@b") for i in range(450))
    assert read.value == 450


def test_a_mail_from_standard_input(spark, tmp_path, capsys):
    raw = b"Subject: S\nFrom: a@b\nContent-Type: text/html; charset=utf-8\n\n<p>1) <a href='https://jobs.lever.co/1'>Dev</a> (X), C - $5</p>"
    assert main(["mail", "-"], spark, io.BytesIO(raw)) == 0
    assert capsys.readouterr().out.startswith("[1] Dev\n    C | X | $5\n    url=https://jobs.lever.co/1")
    (tmp_path / "m.eml").write_bytes(raw)
    assert main(["mail", str(tmp_path / "m.eml"), "--queue", str(tmp_path / "q")], spark) == 0
    assert capsys.readouterr().out == "published 1 messages\n"
    log = queue.Log(str(tmp_path / "q"))
    (part,) = queue._Reader({"path": log.folder}).partitions({"next": 0}, {"next": 1})
    (batch,) = queue._Reader({"path": log.folder}).read(part)
    assert json.loads(batch.column(1)[0].as_py())["payload"]["url"] == "https://jobs.lever.co/1"
