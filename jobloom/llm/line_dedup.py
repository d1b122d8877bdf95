"""Line deduplication by site-relative frequency, in DataFrame functions only.

A line is boilerplate on a host if the share of the host's pages that hold it
exceeds a ratio.  A page counts once however often it was fetched: pages of one
host with the same text are one page, so copies don't make their text boilerplate.

A host has at most (its mean number of lines on a page) / ratio boilerplate lines,
whatever its size, since each stands on more than ratio * pages of its pages.  They
are kept as one array for each host, in buckets of about four by hash, so that a
line is looked up in constant time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import fresh, stored

#: Boilerplate lines (16-byte hashes, by host) up to this number are broadcast, 64 bytes each at most; beyond it hosts are joined by shuffling, and adaptive execution splits large ones.
BROADCAST_LINES = 200_000


def _key(line: Column) -> Column:
    """16 bytes that stand for a line; null for a blank one, which is never counted nor dropped."""
    bare = F.trim(F.regexp_replace(line, "[ \\t\\r]+", " "))
    return F.when(bare != "", F.unhex(F.md5(bare.cast("binary"))))


def boilerplate(docs: DataFrame, ratio: float = 0.02, least_pages: int = 2, host_column: str = "source", text_column: str = "text") -> DataFrame:
    """(host, line_key, pages, host_pages) of the lines on more than ``ratio`` of a host's distinct pages, and on ``least_pages`` at least: a line on one page doesn't repeat.

    Rows meet by (host, line), not by host: a host with a third of all pages is
    spread over all tasks, and its frequent lines are counted before the shuffle.
    """
    host = F.coalesce(F.col(host_column).cast("string"), F.lit("")).alias("host")
    pages = docs.filter(F.col(text_column).isNotNull()).select(host, F.xxhash64(text_column).alias("page"), F.col(text_column).alias("text"))
    totals = pages.groupBy("host").agg(F.count_distinct("page").alias("host_pages"))
    lines = pages.select("host", "page", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), _key))).alias("line_key")).filter("line_key IS NOT NULL")
    counts = lines.distinct().groupBy("host", "line_key").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= least_pages)
    return counts.join(totals, "host").filter(F.col("pages") > F.lit(ratio) * F.col("host_pages"))


def _buckets(found: DataFrame) -> DataFrame:
    """(host, drops): a host's line keys as an array of arrays; a key is in that of its hash modulo their number."""
    sizes = found.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / 4).cast("int").alias("n"))
    keys = found.join(sizes, "host").groupBy("host", F.pmod(F.xxhash64("line_key"), "n").cast("int").alias("bucket")).agg(F.collect_list("line_key").alias("keys"))
    every = sizes.select("host", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("bucket"))
    filled = every.join(keys, ["host", "bucket"], "left").select("host", F.struct("bucket", F.coalesce("keys", F.array().cast("array<binary>")).alias("keys")).alias("b"))
    return filled.groupBy("host").agg(F.array_sort(F.collect_list("b"))["keys"].alias("drops"))


def drop_boilerplate(docs: DataFrame, ratio: float = 0.02, least_pages: int = 2, host_column: str = "source", text_column: str = "text") -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and n_lines, n_dropped.

    Other lines keep their bytes and order.  A null text stays null with no lines;
    a text of boilerplate alone becomes empty; rows without a host share the host
    "".  Repeated rows are cleaned alike; other columns pass through, but earlier
    n_lines and n_dropped are replaced.  An empty table gives an empty result.
    """
    found = stored(boilerplate(docs, ratio, least_pages, host_column, text_column))
    few = found.count() <= BROADCAST_LINES
    host_name, drops_name, kept_name = fresh("host", "drops", "kept")
    drops = stored(_buckets(found)).toDF(host_name, drops_name)
    lines = F.split(text_column, "\n")
    keyed = F.transform(lines, lambda x: F.struct(x.alias("line"), _key(x).alias("key")))
    bucket = lambda key: F.element_at(drops_name, (F.pmod(F.xxhash64(key), F.size(drops_name)) + 1).cast("int"))
    kept = F.filter(keyed, lambda x: ~F.coalesce(F.array_contains(bucket(x["key"]), x["key"]), F.lit(False)))["line"]
    base = docs.drop("n_lines", "n_dropped").withColumn(host_name, F.coalesce(F.col(host_column).cast("string"), F.lit("")))
    out = base.join(F.broadcast(drops) if few else drops, host_name, "left").withColumn(kept_name, F.when(F.col(drops_name).isNotNull(), kept))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text = F.when(F.col(drops_name).isNull(), F.col(text_column)).otherwise(F.array_join(kept_name, "\n")).alias(text_column)
    none = F.lit(0).cast("bigint")
    n = F.when(F.col(text_column).isNull(), none).otherwise(F.size(lines).cast("bigint"))
    gone = F.when(F.col(text_column).isNull() | F.col(drops_name).isNull(), none).otherwise((F.size(lines) - F.size(kept_name)).cast("bigint"))
    return out.select(*[text if c == text_column else F.col(f"`{c}`") for c in names], n.alias("n_lines"), gone.alias("n_dropped"))
