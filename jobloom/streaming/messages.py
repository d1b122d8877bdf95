"""Queue messages: validation, dispositions, and saving them, in batch and as a stream.

``sources.queue`` carries the bytes; Kafka or files do as well.  A checkpointed stream
delivers a batch at least once: ``save_messages`` publishes its rows, what became of its
messages and those that come again in one version of the store, together with the
batch's number, so a batch that is delivered again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobloom.functions import postings
from jobloom.functions.postings import field, is_string, kind
from jobloom.functions.urls import canonical_http_url
from jobloom.operators.store import PostingStore
from jobloom.runtime import scratch, ship, stored

ACK, REJECT, RETRY, DEAD = "ACK", "NACK_NO_REQUEUE", "NACK_REQUEUE", "DEAD_LETTER"
TEXT_FIELDS = ("title", "location", "company", "salary", "summary", "email_subject", "email_sender")


def envelope(entries: DataFrame, now: Column, event_id: Column | None = None, event_type: str = "job.scrape.request") -> DataFrame:
    """Messages (one JSON text per row, nulls kept).  Event ids are hashes of the row unless given, so a repeated run sends the same."""
    fields = ("rank", "title", "url", "location", "company", "salary", "summary", "email_subject", "email_sender", "source")
    payload = F.struct(*[(F.col(c) if c in entries.columns else F.lit("email_raw_manual") if c == "source" else F.lit(None).cast("string")).alias(c) for c in fields])
    key = event_id if event_id is not None else F.sha2(F.to_json(payload), 256)
    return entries.select(F.to_json(F.struct(key.alias("event_id"), F.lit(event_type).alias("event_type"), now.cast("string").alias("occurred_at"), payload.alias("payload")), {"ignoreNullFields": "false"}).alias("body"))


def _optional_text(v: Column, path: str) -> Column:
    at = field(v, path, "variant")
    return at.isNull() | F.is_variant_null(at) | is_string(at)


def _whole_number(at: Column) -> Column:
    """Null, an integer, a number or text without a fraction, or a boolean."""
    as_text = F.try_variant_get(at, "$", "string")
    numeric = kind(at).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & as_text.rlike(r"^-?\d+(?:\.0*)?(?:[eE]\+?\d+)?$")
    worded = is_string(at) & as_text.rlike(r"^\s*[+-]?\d+(?:\.0*)?\s*$")
    return at.isNull() | F.is_variant_null(at) | numeric | worded | (kind(at) == "BOOLEAN")


def validated(messages: DataFrame, body: str = "body", link: str | None = None) -> DataFrame:
    """With v (VARIANT or null) and reason: null for a valid message, else what is wrong first.  ``body`` is text or bytes; ``link`` names a column for the canonical url."""
    raw = F.col(body)
    if dict(messages.dtypes)[body] == "binary":
        raw = F.when(F.is_valid_utf8(F.col(body).cast("string")), F.col(body).cast("string"))
    v = F.col("v")
    url, payload, source = field(v, "$.payload.url", "variant"), field(v, "$.payload", "variant"), field(v, "$.payload.source", "variant")
    object_at = lambda c: F.coalesce(kind(c).startswith("OBJECT"), F.lit(False))
    texts = F.lit(True)
    for name in TEXT_FIELDS:
        texts = texts & _optional_text(v, f"$.payload.{name}")
    for name in ("event_id", "event_type", "occurred_at"):
        texts = texts & _optional_text(v, f"$.{name}")
    reason = (
        F.when(F.col("__raw").isNull(), "not UTF-8")
        .when(v.isNull(), "not JSON")
        .when(~object_at(v), "not an object")
        .when(~object_at(payload), "no payload")
        .when(~F.coalesce(is_string(url) & F.col("__url").isNotNull(), F.lit(False)), "no url")
        .when(~F.coalesce(_whole_number(field(v, "$.payload.rank", "variant")), F.lit(True)), "rank")
        .when(source.isNotNull() & ~F.coalesce(is_string(source), F.lit(False)), "source")
        .when(~F.coalesce(texts, F.lit(True)), "text field")
    )
    ship(messages.sparkSession)
    parsed = messages.withColumn("__raw", raw).withColumn("v", F.try_parse_json("__raw"))
    parsed = parsed.withColumn("__sent", field(v, "$.payload.url")).withColumn("__url", canonical_http_url(F.col("__sent"))).withColumn("reason", reason).drop("__raw", "__sent")
    return parsed.withColumnRenamed("__url", link) if link else parsed.drop("__url")


def dispositions(checked: DataFrame, outcomes: DataFrame | None = None, seq: str = "seq") -> DataFrame:
    """With disposition: rejected messages don't come again; valid ones are acknowledged when saved or already there, else come again."""
    if outcomes is None:
        return checked.withColumn("disposition", F.when(F.col("reason").isNull(), ACK).otherwise(REJECT))
    done = outcomes.select(seq, "outcome")
    joined = checked.join(done, seq, "left")
    return joined.withColumn("disposition", F.when(F.col("reason").isNotNull(), REJECT).when(F.col("outcome").isNotNull(), ACK).otherwise(RETRY)).drop("outcome")


def start(messages: DataFrame, save: Callable[[DataFrame, int], None], reject: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True, interval: str = "60 seconds") -> StreamingQuery:
    """Runs a stream of messages: ``save`` gets the valid ones of a batch, ``reject`` the others.  ``once``: all there is now, then stop."""

    def each(batch: DataFrame, number: int) -> None:
        checked = validated(batch).persist()  # read and validated once
        try:
            save(checked.filter("reason IS NULL"), number)
            reject(checked.filter("reason IS NOT NULL"), number)
        finally:
            checked.unpersist()

    writer = messages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def save_messages(store: PostingStore, batch: DataFrame, number: int, now: Column, query: str = "messages", details: Callable[[DataFrame], DataFrame] | None = None, refused: Column | None = None, most_attempts: int = 5) -> bool:
    """Saves a batch of messages (place, body), and those that an earlier batch left to come again; False if the store has this batch already.

    A message that is not valid is rejected.  One that is saved, or whose posting is
    there already, is acknowledged.  All others come again with the next batch, until
    they were tried ``most_attempts`` times: then they are dead letters.  ``details`` gives the
    details (board, job_id and the columns of a posting) of links (url); ``refused`` is
    true for rows (place, attempt and the posting) that can't be saved now.
    Places are unique over all batches; the store keeps (place, body, attempt, reason, outcome, disposition).
    """
    if store.done(query, number):
        return False
    spark = store.spark
    with scratch(spark):
        rows = batch.select("place", F.col("body").cast("binary").alias("body"), F.lit(1).alias("attempt"))
        if store.now["pending"]:
            rows = rows.union(spark.read.parquet(f"{store.folder}/{store.now['pending']}").select("place", "body", F.col("attempt") + 1))
        parsed = validated(rows, link="link").withColumn("payload", field(F.col("v"), "$.payload", "variant"))
        checked = stored(postings.from_payload(parsed, now, keep=("place", "body", "attempt", "reason"), link="link"))  # each message is parsed once
        taken = checked.filter("reason IS NULL").drop("body", "reason")
        if details is not None:
            taken = postings.enriched(taken, details(taken.select("url")), True)
        if refused is not None:
            taken = taken.filter(~F.coalesce(refused, F.lit(False)))
        outcomes, files, access = store.staged(taken, "place")
        told = checked.select("place", "body", "attempt", "reason").join(outcomes, "place", "left")
        again = F.when(F.col("attempt") < most_attempts, RETRY).otherwise(DEAD)
        told = told.withColumn("disposition", F.when(F.col("reason").isNotNull(), REJECT).when(F.col("outcome").isNotNull(), ACK).otherwise(again))
        log = store.write("dispositions", told)
        left = spark.read.parquet(f"{store.folder}/{log}").filter(F.col("disposition") == RETRY).select("place", "body", "attempt")
        pending = None if left.isEmpty() else store.write("pending", left)
        store.publish(files, access, (query, number), pending, log)
    return True


def save_stream(messages: DataFrame, store: PostingStore, checkpoint: str, now: Column, interval: str = "5 seconds", **options) -> StreamingQuery:
    """A stream of messages (place, body) into the store; ``options`` as of ``save_messages``."""

    def each(batch: DataFrame, number: int) -> None:
        save_messages(store, batch, number, now, **options)

    return messages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def drain(store: PostingStore, now: Column, query: str = "messages", **options) -> int:
    """Tries what is left to come again without waiting for further messages, until nothing is; the batches it took."""
    turns = 0
    while store.refresh().now["pending"]:
        save_messages(store, store.spark.createDataFrame([], "place bigint, body binary"), turns, now, query=f"{query}-drain-{store.now['version']}", **options)
        turns += 1
    return turns
