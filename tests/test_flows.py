"""Flows against a local server: lookups of messages, the schedule."""

import json
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from jobloom.operators.store import PostingStore
from jobloom.plans import flows
from jobloom.sources import boards
from jobloom.streaming import messages


def test_messages_are_enriched_with_one_request_for_each_posting(spark, board_server, tmp_path):
    base, asked = board_server
    source = boards.create(spark, {"type": "api", "name": "greenhouse", "rate_limit_per_minute": 0, "config": {"base_url": base}})
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    find = flows.detail_lookup(source, "https://boards.greenhouse.io", "greenhouse", now, str(tmp_path / "log"))
    assert flows.detail_lookup(source, "r", "greenhouse", now, enabled=False) is None
    board = "https://boards.greenhouse.io/a/jobs/"
    links = [board + "7", board + "07", "https://JOB-BOARDS.greenhouse.io/A/jobs/7", board + "99", "https://else/1"]
    rows = [(i, json.dumps({"payload": {"url": u, "title": f"t{i}", "summary": "own"}})) for i, u in enumerate(links)]
    store = PostingStore(spark, str(tmp_path / "s"), 4)
    batch = spark.createDataFrame(rows, "place bigint, body string")
    assert messages.save_messages(store, batch, 0, now, details=find)
    assert asked == Counter({"/boards/a/jobs/7": 1, "/boards/a/jobs/99": 1})
    got = {r.url: (r.job_title, r.job_description, r.company) for r in store.read().collect()}
    assert got == {board + "7": ("Seven", "seven", "Acme"), board + "99": ("t3", "own", None), "https://else/1": ("t4", "own", None)}
    assert {r.place: r.outcome for r in store.dispositions().collect()} == {0: "inserted", 1: "duplicate", 2: "duplicate", 3: "inserted", 4: "inserted"}
    assert messages.save_messages(store, spark.createDataFrame([(9, rows[0][1])], "place bigint, body string"), 1, now, details=find)
    assert asked["/boards/a/jobs/7"] == 1  # looked up a moment ago


def test_the_schedule_goes_on_after_a_source_that_fails(spark, board_server, tmp_path):
    base, asked = board_server
    tables, store = flows.RunTables(spark, str(tmp_path / "t")), PostingStore(spark, str(tmp_path / "s"), 4)
    config = json.dumps({"base_url": base, "details": "false"})
    sources = spark.createDataFrame([("1", "greenhouse", "api", True, 6, 0, config), ("2", "nobody", "api", True, 6, 0, config), ("3", "off", "api", None, 6, 0, config)], "id string, name string, type string, enabled boolean, schedule_hours int, rate_limit_per_minute int, config string")
    nothing = F.lit(None).cast("timestamp_ntz")
    tables.replace("sources", sources.withColumn("config", F.parse_json("config")).withColumns({"last_run_at": nothing, "updated_at": nothing}))
    tables.replace("companies", spark.createDataFrame([("c", "1", "A", "a", True)], "id string, source_id string, company_name string, company_endpoint string, enabled boolean").withColumns({"last_fetched_at": nothing, "updated_at": nothing}))
    times, seen = iter([timedelta(0), timedelta(minutes=2), timedelta(minutes=6)]), []
    query = flows.poll(spark, tables, flows.source_runner(spark, tables, store, "https://r"), str(tmp_path / "c"), 0.1, lambda: datetime(2024, 1, 1) + next(times, timedelta(hours=7)), lambda n, found: seen.append(found))
    for _ in range(600):
        if len(seen) >= 4:
            break
        query.awaitTermination(0.1)
    query.stop()
    failed = {"nobody": "ValueError: no class reads the source nobody"}
    assert seen[:4] == [{"greenhouse": "ran"} | failed, {}, failed, {"greenhouse": "ran"} | failed]  # paused after the error, then due after six hours
    assert [r.saved for r in tables.every("runs").orderBy("at").collect()] == [3, 3] and asked["/boards/a/jobs"] == 2  # a blank description counts as saved again
    assert store.read().count() == 2 and tables.read("companies").first().last_fetched_at is not None
    assert {r.name: r.last_run_at is not None for r in tables.read("sources").collect()} == {"greenhouse": True, "nobody": False, "off": False}
