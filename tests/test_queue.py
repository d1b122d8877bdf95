"""The queue: nothing lost or repeated over restarts, failing tasks leave nothing, a batch is published once."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobloom.sources import queue


def bodies(spark, a, b):
    return spark.range(a, b).select(F.concat(F.lit("m"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("body"))


def consume(spark, folder, checkpoint, seen, prefetch=7, consumer="c", stop_after=None):
    """Runs a query until all is read, or until some batches are done."""

    def each(batch, number):
        rows = batch.collect()
        assert len(rows) <= prefetch
        if stop_after is not None and number >= stop_after:
            raise RuntimeError("stopped on purpose")
        seen.append((number, [(r.place, bytes(r.body).decode()) for r in rows]))

    query = queue.incoming(spark, folder, consumer, prefetch).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    except Exception as e:  # noqa: BLE001
        assert "stopped on purpose" in str(e)
    finally:
        query.stop()


def test_a_restarted_query_loses_and_repeats_nothing(spark, tmp_path):
    folder, seen = str(tmp_path / "q"), []
    queue.publish(bodies(spark, 0, 20).repartition(3), folder)
    queue.publish(bodies(spark, 20, 25).coalesce(1), folder)
    consume(spark, folder, str(tmp_path / "c"), seen, stop_after=2)  # its third batch fails
    assert [n for n, _ in seen] == [0, 1] and queue.Log(folder).acknowledged("c") in (7, 14)
    queue.publish(bodies(spark, 25, 40), folder)
    consume(spark, folder, str(tmp_path / "c"), seen)
    rows = [r for _, batch in seen for r in batch]
    assert [p for p, _ in sorted(rows)] == list(range(40)) and sorted(b for _, b in rows) == [f"m{i:04d}" for i in range(40)]
    consume(spark, folder, str(tmp_path / "c"), seen)
    assert sum(len(b) for _, b in seen) == 40
    other = []
    consume(spark, folder, str(tmp_path / "c2"), other, prefetch=100, consumer="other")
    assert sum(len(b) for _, b in other) == 40
    queue.publish(bodies(spark, 40, 42), folder)
    again = []  # a new checkpoint of the same consumer goes on after what was acknowledged
    consume(spark, folder, str(tmp_path / "c3"), again, prefetch=100, consumer="other")
    assert {b for _, x in again for _, b in x} >= {"m0040", "m0041"} and len(again) == 1
    before = queue.Log(folder).end()
    assert queue.Log(folder).trim() > 0 and queue.Log(folder).end() == before


def test_a_failing_task_leaves_no_message(spark, tmp_path):
    folder = str(tmp_path / "q")
    queue.publish(bodies(spark, 0, 3), folder)

    def run(batches):
        for b in batches:
            if "m0105" in b.column(0).to_pylist():
                raise ValueError("fails")
            yield b

    bad = bodies(spark, 100, 110).repartition(4).mapInArrow(run, "body string")
    with pytest.raises(Exception, match="fails"):
        queue.publish(bad, folder)
    log = queue.Log(folder)
    assert log.end() == 3
    left = {f for f in os.listdir(f"{folder}/segments") if f.endswith(".parquet")}
    assert {s[0].rpartition("/")[2] for e in log.entries() for s in log.get(e[4])["segments"]} <= left
    queue.publish(bodies(spark, 0, 0), folder)
    assert log.end() == 3


def test_a_key_is_published_once(spark, tmp_path):
    folder = str(tmp_path / "q")
    for _ in range(2):
        queue.publish(bodies(spark, 0, 5), folder, key="mail-1")
    assert queue.Log(folder).end() == 5
    segments = [queue._Segment(queue._StreamWriter(folder, "p").write(iter([pa.RecordBatch.from_pydict({"body": ["x"]})])).name, 1) for _ in range(2)]
    writer = queue._StreamWriter(folder, "p")
    writer.commit([segments[0], None], 4)
    writer.commit([segments[1]], 4)  # the same batch, tried again
    assert queue.Log(folder).end() == 6 and len(queue.Log(folder).entries()) == 2
    assert not os.path.exists(f"{folder}/{segments[1].name}")


def test_a_part_opens_its_groups_of_rows_alone(spark, tmp_path, monkeypatch):
    folder, asked = str(tmp_path / "q"), []
    monkeypatch.setattr(queue, "ROWS", 100)
    (one,) = [queue._Write(folder).write(iter([pa.RecordBatch.from_pydict({"body": [f"m{i}" for i in range(1050)]})]))]
    queue.Log(folder).publish([(one.name, one.rows)], "k")

    class File(queue.pq.ParquetFile):
        def iter_batches(self, *a, row_groups=None, **b):
            asked.append(row_groups)
            return super().iter_batches(*a, row_groups=row_groups, **b)

    monkeypatch.setattr(queue.pq, "ParquetFile", File)
    reader = queue._Reader({"path": folder})
    for start, end, groups in ((0, 1050, list(range(11))), (350, 500, [3, 4]), (999, 1001, [9, 10]), (1049, 1050, [10])):
        (part,) = reader.partitions({"next": start}, {"next": end})
        rows = [(p, v) for b in reader.read(part) for p, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        assert rows == [(i, f"m{i}".encode()) for i in range(start, end)] and asked.pop() == groups


def test_a_stream_is_published_by_batches(spark, tmp_path):
    queue.register(spark)
    bodies(spark, 0, 30).repartition(3).write.text(str(tmp_path / "in"))
    for _ in range(2):
        stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(tmp_path / "in")).withColumnRenamed("value", "body")
        stream.writeStream.format("posting_queue").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "q")).option("publisher", "p").trigger(availableNow=True).start().awaitTermination()
    assert queue.Log(str(tmp_path / "q")).end() == 30
    seen = []
    consume(spark, str(tmp_path / "q"), str(tmp_path / "c2"), seen, prefetch=8)
    assert sorted(b for _, x in seen for _, b in x) == [f"m{i:04d}" for i in range(30)] and max(len(x) for _, x in seen) <= 8
