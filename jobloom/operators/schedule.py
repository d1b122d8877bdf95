"""Schedules, admission at a rate, statistics of runs and the sort of newsletter rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def is_due(last_run: Column, hours: Column, now: Column) -> Column:
    """Never run, a last run that can't be read, or one that lies ``hours`` back or more."""
    at = last_run.cast("string").try_cast("timestamp_ntz")
    return at.isNull() | (now >= at + F.make_dt_interval(F.lit(0), F.coalesce(hours, F.lit(6))))


def due_sources(sources: DataFrame, now: Column) -> DataFrame:
    """Enabled sources (null is disabled) that are due."""
    return sources.filter(F.coalesce("enabled", F.lit(False)) & is_due(F.col("last_run_at"), F.col("schedule_hours"), now))


def admission(requests: DataFrame, per_minute: int | None, by: str, at: str, seq: str, block_seconds: int = 3600) -> DataFrame:
    """Second at which a limiter of fixed gaps admits each request; ``at`` in seconds.  No limit without a positive rate.

    Request i of a key is admitted at i gaps plus the most that any request up to it
    lags behind its own gaps.  Ranks and maxima are taken within blocks of time, so
    that a key's requests spread over tasks; one row per block carries them on.
    """
    if not per_minute or per_minute <= 0:
        return requests.withColumn("admitted", F.col(at).cast("double"))
    gap = F.lit(60.0 / per_minute)
    rows = requests.withColumn("__block", F.floor(F.col(at) / block_seconds))
    within = Window.partitionBy(by, "__block").orderBy(at, seq)
    rows = rows.withColumn("__i", F.row_number().over(within) - 1)
    rows = rows.withColumn("__lag", F.max(F.col(at).cast("double") - F.col("__i") * gap).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = rows.groupBy(F.col(by).alias("__by"), F.col("__block").alias("__at")).agg(F.count(F.lit(1)).alias("__n"), F.max("__lag").alias("__peak"))
    earlier = Window.partitionBy("__by").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    blocks = blocks.withColumn("__before", F.max(F.col("__peak") - F.col("__first") * gap).over(earlier))
    joined = rows.join(blocks, F.col(by).eqNullSafe(F.col("__by")) & F.col("__block").eqNullSafe(F.col("__at")))
    admitted = (F.col("__first") + F.col("__i")) * gap + F.greatest("__before", F.col("__lag") - F.col("__first") * gap)
    return joined.select(*requests.columns, admitted.alias("admitted"))


def run_stats(companies: DataFrame, fetched: DataFrame, outcomes: DataFrame, errors: DataFrame, by: str = "source_id") -> DataFrame:
    """Per source: companies (failed ones too), fetched, with_description, saved, duplicates, and how many failed, apart from duplicates."""
    parts = [
        companies.groupBy(by).agg(F.count(F.lit(1)).alias("companies")),
        fetched.groupBy(by).agg(F.count(F.lit(1)).alias("fetched"), F.count_if(F.coalesce("job_description", F.lit("")) != "").alias("with_description")),
        outcomes.groupBy(by).agg(F.count_if(F.col("outcome") != "duplicate").alias("saved"), F.count_if(F.col("outcome") == "duplicate").alias("duplicates")),
        errors.groupBy(by).agg(F.count(F.lit(1)).alias("failed")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, by, "left")
    return out.fillna(0, ["fetched", "with_description", "saved", "duplicates", "failed"])


def rank_order(rank: str = "rank", title: str = "title", pos: str = "pos") -> list[Column]:
    """By rank with nulls last, then title in lower case, then place."""
    return [F.col(rank).asc_nulls_last(), F.lower(title), F.col(pos)]


def keyword_matches(docs: DataFrame, keywords: list[str], text: str = "text") -> DataFrame:
    """Extension: rows with the keywords that their text holds, case not heeded."""
    found = F.filter(F.array(*[F.when(F.lower(text).contains(k.lower()), F.lit(k)) for k in keywords]), lambda k: k.isNotNull())
    return docs.withColumn("keywords", found).filter(F.size("keywords") > 0)
