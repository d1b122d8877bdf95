"""Whole flows: a crawl of boards, a newsletter to messages, messages to the store."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timedelta

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobloom.functions import postings, urls
from jobloom.operators import dedup, dml, links, schedule
from jobloom.operators.store import PostingStore
from jobloom.runtime import numbered, stored
from jobloom.sources import boards
from jobloom.sources.boards import PostingSource
from jobloom.streaming import messages


def crawl(rows: DataFrame, companies: DataFrame, store: DataFrame | PostingStore, root: str, source: str, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(store afterwards, outcomes (seq, outcome, company_endpoint, with_description), errors (company_endpoint, error)) of a source's rows (board, position, body, detail, error).

    A store saves the postings in its next version; of a table the rows afterwards are given.
    Every row is asked for once: the rows are written down first.  Companies are taken
    in the order of their names, and a company's postings in the order of its list, so
    of two equal postings the earlier stays.  Rows that can't be taken and lists that
    did not come are errors; they aren't fetched postings.
    """
    names = companies.select(F.col("company_endpoint").alias("board"), "company_name")
    rows = stored(rows.select("board", "position", "body", "detail", "error"))
    places = numbered(companies.select(F.col("company_endpoint").alias("company_endpoint")).distinct(), "company_endpoint", "place")
    parsed = rows.join(names, "board", "left").select(F.col("board").alias("company_endpoint"), "position", F.coalesce("company_name", postings.company_name(F.try_parse_json("detail"), F.col("board"))).alias("company_name"), F.try_parse_json("body").alias("row"), F.nullif(postings.description(F.try_parse_json("detail")), F.lit("")).alias("description"), "error")
    taken = stored(postings.from_api(parsed.filter("error IS NULL"), root, source, now, keep=("company_endpoint", "position", "description")))
    batch = taken.filter("NOT row_error").withColumn("job_description", F.col("description")).join(places, "company_endpoint", "left")
    seq = F.coalesce("place", F.lit(0)) * F.lit(1 << 24) + F.col("position")
    in_store = isinstance(store, PostingStore)
    batch = stored(batch.select(*(store.schema.names if in_store else store.columns), "company_endpoint", seq.alias("seq")))
    after, outcomes = (None, store.save(batch.drop("company_endpoint"))) if in_store else dedup.upsert(store, batch.drop("company_endpoint"))
    if in_store:
        after = store.read()
    failed = rows.filter("error IS NOT NULL").select(F.col("board").alias("company_endpoint"), "error").union(taken.filter("row_error").select("company_endpoint", F.lit("row error")))
    return after, outcomes.join(batch.select("seq", "company_endpoint", F.col("job_description").isNotNull().alias("with_description")), "seq"), failed


def run_source(rows: DataFrame, companies: DataFrame, sources: DataFrame, store: DataFrame | PostingStore, root: str, source: str, now: Column) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """A run of a source over its rows (board, position, body, detail, error): the store, companies and sources afterwards, and the run's statistics (one row).

    A list that did not come counts as an empty one.  All companies are touched but
    those that answered with something else than a list: these are the run's errors.
    The source is touched whatever came, as a run that found nothing was a run.
    """
    mine = sources.filter(F.col("name") == source).select(F.col("id").alias("source_id"))
    ours = companies.join(F.broadcast(mine), "source_id", "left_semi").filter(F.coalesce("enabled", F.lit(False)))
    after, outcomes, errors = crawl(rows, ours, store, root, source, now)
    outcomes, broken = stored(outcomes), stored(errors.filter(F.col("error") == boards.NO_LIST))
    done = stored(ours.join(broken.select("company_endpoint").distinct(), "company_endpoint", "left_anti").select("id").distinct())
    touched = dml.touch_rows(companies, done, now, ["last_fetched_at", "updated_at"])
    sources = dml.touch_rows(sources, mine.withColumnRenamed("source_id", "id"), now, ["last_run_at", "updated_at"])
    named = lambda df: df.withColumn("source", F.lit(source))
    came = outcomes.select(F.when(F.col("with_description"), "text").alias("job_description"))
    return after, touched, sources, schedule.run_stats(named(ours), named(came), named(outcomes), named(broken), "source")


def lookup(found: DataFrame, root: str, source: str, now: Column) -> DataFrame:
    """Postings of single links' details (url, board, job_id, detail); links whose request failed or whose row is faulty have none."""
    parsed = found.filter("detail IS NOT NULL").select("board", F.try_parse_json("detail").alias("row")).withColumn("company_name", postings.company_name(F.col("row"), F.col("board"))).withColumn("text", postings.description(F.col("row")))
    taken = postings.from_api(parsed, root, source, now, board="board", keep=("text",))
    good = taken.filter("NOT row_error")
    return good.select(*[F.col("text").alias(c) if c == "job_description" else F.col(c) for c in good.columns if c not in ("text", "row_error")])


def detail_lookup(source: PostingSource, root: str, name: str, now: Column, log: str | None = None, enabled: bool = True) -> Callable[[DataFrame], DataFrame] | None:
    """For ``messages.save_messages``: looks links (url) up at the source, each posting once, and gives its details (board, job_id and the columns of a posting); None for a source that is disabled."""
    if not enabled:
        return None

    def details(links: DataFrame) -> DataFrame:
        found = stored(source.lookup(links, log))
        once = dedup.first_wins(found.withColumn("low", F.lower("board")), ["low", "job_id"], ["url"])  # a board's name is the same in either case
        rows = lookup(once, root, name, now)
        return rows.select(urls.board_token(F.col("url")).alias("board"), urls.board_job_id(F.col("url")).alias("job_id"), *rows.columns)

    return details


#: Seconds until a source is looked at again after a run, and after one that failed.
PAUSE, PAUSE_AFTER_ERROR = 60, 300


def run_due(spark: SparkSession, tables: RunTables, now: datetime, run: Callable[[str, Column], DataFrame], pauses: dict[str, datetime]) -> dict[str, str]:
    """One look at the schedule: runs the sources that are due and not paused, one after the other; what became of each by name (ran, or the error).

    ``run`` runs a source by name and returns its statistics; a source that fails is
    looked at again after the longer pause, and the others run all the same.
    """
    at = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    found = {}
    for name in [r.name for r in schedule.due_sources(tables.read("sources"), at).select("name").orderBy("name").collect()]:
        if name in pauses and now < pauses[name]:
            continue
        try:
            tables.append("runs", run(name, at).withColumn("at", at))
            found[name], pauses[name] = "ran", now + timedelta(seconds=PAUSE)
        except Exception as e:  # noqa: BLE001 - whatever it was, the schedule goes on
            found[name], pauses[name] = f"{type(e).__name__}: {e}".splitlines()[0][:500], now + timedelta(seconds=PAUSE_AFTER_ERROR)
    return found


def poll(spark: SparkSession, tables: RunTables, run: Callable[[str, Column], DataFrame], checkpoint: str, seconds: float = PAUSE, clock: Callable[[], datetime] = datetime.now, seen: Callable[[int, dict[str, str]], None] | None = None) -> StreamingQuery:
    """Looks at the schedule every so many seconds, as a stream of ticks; ``seen`` gets each tick's number and what became of its sources."""
    pauses: dict[str, datetime] = {}

    def each(_: DataFrame, number: int) -> None:
        found = run_due(spark, tables, clock(), run, pauses)
        if seen is not None:
            seen(number, found)

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    return ticks.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=f"{max(1, int(seconds * 1000))} milliseconds").start()


class RunTables:
    """Small tables (sources, companies, runs) in a folder: each change writes a new version, and the last whole one is read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.store, self.path = boards.store_of(self.folder)

    def _versions(self, name: str) -> list[str]:
        found = self.store.get_file_info(fs.FileSelector(f"{self.path}/{name}", recursive=True, allow_not_found=True))
        return sorted(x.path.rpartition("/")[0].rpartition("/")[2] for x in found if x.base_name == "_SUCCESS")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}/{self._versions(name)[-1]}")

    def replace(self, name: str, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.folder}/{name}/{len(self._versions(name)):012d}")

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.folder}/{name}/{len(self._versions(name)):012d}")

    def every(self, name: str) -> DataFrame:
        """Rows of all versions, for a table that is appended to."""
        return self.spark.read.parquet(*[f"{self.folder}/{name}/{v}" for v in self._versions(name)])


def source_runner(spark: SparkSession, tables: RunTables, posted: PostingStore, root: str, log: str | None = None) -> Callable[[str, Column], DataFrame]:
    """For ``poll``: fetches a source's boards, saves their postings in the store, touches companies and source, and returns the run's statistics."""

    def run(name: str, now: Column) -> DataFrame:
        row = boards.source_config(tables.read("sources"), name).select("name", "type", "rate_limit_per_minute", F.to_json("config").alias("config")).first()
        source = boards.create(spark, {"name": row.name, "type": row.type, "rate_limit_per_minute": row.rate_limit_per_minute, "config": json.loads(row.config)})
        if source is None:
            raise ValueError(f"no class reads the source {name}")
        sources, companies = tables.read("sources"), tables.read("companies")
        ours = companies.join(sources.filter(F.col("name") == name).select(F.col("id").alias("source_id")), "source_id", "left_semi").filter(F.coalesce("enabled", F.lit(False)))
        _, touched, after, stats = run_source(source.rows(ours, log=log), companies, sources, posted, root, name, now)
        tables.replace("companies", touched)
        tables.replace("sources", after)
        return stats

    return run


def newsletter(mails: DataFrame, now: Column, base: str = "") -> DataFrame:
    """Messages of the job links of mails (path, subject, sender, html)."""
    named = mails.select("path", F.col("subject").alias("email_subject"), F.col("sender").alias("email_sender"), "html")
    return messages.envelope(links.job_entries(named, base=base, keep=("email_subject", "email_sender")), now)


def consume(batch: DataFrame, store: DataFrame, details: DataFrame | None, now: Column) -> tuple[DataFrame, DataFrame]:
    """(store afterwards, seq, disposition, reason) of messages (seq, body)."""
    checked = stored(messages.validated(batch).select("seq", "body", F.to_json("v").alias("text"), "reason"))
    good = checked.filter("reason IS NULL").select("seq", F.parse_json("text").alias("v"))
    payloads = good.select("seq", postings.field(F.col("v"), "$.payload", "variant").alias("payload"))
    taken = postings.from_payload(payloads, now, keep=("seq",))
    if details is not None:
        taken = postings.enriched(taken, details, True)
    after, outcomes = dedup.upsert(store, taken.select(*store.columns, "seq"))
    return after, messages.dispositions(checked.select("seq", "reason"), outcomes)
