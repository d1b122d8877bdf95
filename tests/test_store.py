"""The store: files of untouched buckets stay, readers see versions, filters have no false negatives, batches that come again change nothing."""

import json
import random

from pyspark.sql import functions as F

from jobloom.operators import store as stores
from jobloom.operators.store import PostingStore
from jobloom.schemas import POSTING
from jobloom.streaming import messages

def now():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def rows_of(spark, rows):
    named = {f.name: F.lit(None).cast(f.dataType) for f in POSTING}
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq bigint, u string, d string, h string")
    return df.select(*[{"url": F.col("u"), "job_description": F.col("d"), "content_hash": F.col("h")}.get(c, x).alias(c) for c, x in named.items()], "seq")


def test_filters_have_no_false_negatives():
    rng = random.Random(3)
    keys = [f"k{rng.random()}" for _ in range(5000)]
    for n in (0, 1, 77, 5000):
        held = stores.bloom(stores.hashes(keys[:n]))
        assert stores.may_hold(held, stores.hashes(keys[:n])).all()
        assert stores.may_hold(held, stores.hashes([f"x{i}" for i in range(5000)])).mean() < 0.02


def test_a_save_touches_its_buckets_alone(spark, tmp_path):
    store = PostingStore(spark, str(tmp_path / "s"), buckets=16)
    store.save(rows_of(spark, [(f"u{i}", "d", f"h{i}") for i in range(200)]))
    first, reader = dict(store.now["files"]), PostingStore(spark, str(tmp_path / "s")).read()
    outcomes = store.save(rows_of(spark, [("u7", "other", "h900"), ("new", None, "h901"), ("u8000", "d", "h9"), ("new", "filled", "h902")]))
    assert {r.seq: r.outcome for r in outcomes.collect()} == {0: "duplicate", 1: "inserted", 2: "duplicate", 3: "updated"}
    changed = {b for b, p in store.now["files"].items() if first.get(b) != p}
    assert len(changed) == 1 and store.now["version"] == 2
    assert reader.count() == 200 and store.read().count() == 201  # who read the first version still does
    assert [(r.url, r.job_description, r.content_hash) for r in PostingStore(spark, str(tmp_path / "s")).read().filter("url = 'new'").collect()] == [("new", "filled", "h902")]
    assert store.vacuum(keep=1) == 1 and store.read().count() == 201


def test_probes_open_files_that_may_hold_a_key(spark, tmp_path):
    store = PostingStore(spark, str(tmp_path / "s"), buckets=16)
    store.save(rows_of(spark, [(f"u{i}", "d", f"h{i}") for i in range(800)]))
    one = spark.createDataFrame([("u5", "none")], "url string, content_hash string")
    found = store.candidates(one)
    assert 1 <= len(found) <= 2 and store.read(found).filter("url = 'u5'").count() == 1
    assert len(store.read(found).inputFiles()) == len(found)
    assert len(store.candidates(spark.createDataFrame([("zz", "h77")], "url string, content_hash string"))) <= 2
    assert store.candidates(spark.createDataFrame([("none", "nothing")], "url string, content_hash string")) in ([], [x for x in store.now["files"].values()][:0])
    every = spark.createDataFrame([(f"u{i}", f"h{i + 3}") for i in range(0, 1600, 7)], "url string, content_hash string")
    assert {r.url for r in store.existing(every, "url").collect()} == {f"u{i}" for i in range(0, 800, 7)}
    assert store.existing(every, "content_hash").count() == len([i for i in range(0, 1600, 7) if i + 3 < 800])


def test_saves_by_batches_equal_one(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"u{rng.randint(0, 20)}", rng.choice([None, "", "text"]), f"h{rng.randint(0, 30)}") for _ in range(40)]
    one, many = PostingStore(spark, str(tmp_path / "one"), 4), PostingStore(spark, str(tmp_path / "many"), 4)
    one.save(rows_of(spark, rows))
    for i in range(0, 40, 20):
        many.save(rows_of(spark, rows[i : i + 20]), query="q", number=i)
        assert many.save(rows_of(spark, rows[i : i + 20]), query="q", number=i) is None
    key = lambda s: sorted((r.url, r.job_description or "", r.content_hash) for r in s.read().collect())
    assert key(one) == key(many)


def test_messages_that_could_not_be_saved_come_again(spark, tmp_path):
    body = lambda i, **more: json.dumps({"payload": {"url": f"https://h/{i}", "title": f"t{i}", "summary": "s"} | more})
    store = PostingStore(spark, str(tmp_path / "s"), 4)
    batch = lambda rows: spark.createDataFrame(rows, "place bigint, body string")
    down = {"refused": (F.col("url") == "https://h/2") & (F.col("attempt") < 3) | (F.col("url") == "https://h/3"), "most_attempts": 4}
    first = batch([(0, body(1)), (1, body(2)), (2, "{"), (3, body(3))])
    assert messages.save_messages(store, first, 0, now(), **down)
    version = store.now["version"]
    assert not messages.save_messages(store, first, 0, now(), **down) and store.refresh().now["version"] == version  # the batch comes again
    assert messages.save_messages(store, batch([(4, body(2))]), 1, now(), **down)
    assert messages.drain(store, now(), **down) == 2
    got = {}
    for r in store.dispositions().orderBy("attempt").collect():
        got.setdefault(r.place, []).append((r.disposition, r.outcome))
    retry = (messages.RETRY, None)
    assert got == {0: [(messages.ACK, "inserted")], 1: [retry, retry, (messages.ACK, "inserted")], 2: [(messages.REJECT, None)], 3: [retry] * 3 + [(messages.DEAD, None)], 4: [retry, (messages.ACK, "duplicate")]} or got[4] == [retry, retry, (messages.ACK, "duplicate")]
    assert sorted(r.url for r in store.read().collect()) == ["https://h/1", "https://h/2"]
