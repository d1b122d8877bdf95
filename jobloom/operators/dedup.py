"""Ordered two-key deduplication, and the conditional upsert that it belongs to.

In order, a row is saved if neither its url nor its content hash is stored yet.
A row that is dropped leaves no keys behind, so chained distincts give another
result: the kept rows are the first maximal set without shared keys.  They are
found in rounds: rows that come first for both of their keys are kept, and rows
that share a key with them go.  A round is joins and partial aggregates; the
number of rounds grows with the logarithm of the rows for random orders.  Chains,
where each row waits for the one before, would take a round for each: what some
rounds leave is settled in order, group by group of rows that hang together, in
streams that hold the keys kept so far and no rows.

The upsert is resolved in rounds too.  A new link's fate hangs on one row, the first
whose hash no other link holds then; what follows (updates until one fills the
description) is the link's own affair, so every insertion says at once from when to when the
link holds which hash.  A round inserts the rows that come first of their hash
among all links still open, and strikes out rows whose hash is held at their time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions.text import is_blank
from jobloom.runtime import Stored, scratch, ship, stored


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key: a partial aggregate, so no key's rows meet in one task."""
    others = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *others)).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns])


def two_key_first(rows: DataFrame, seq: str = "seq", first: str = "url", second: str = "content_hash", rounds: int = 12) -> DataFrame:
    """(seq, first, second) of the rows that an ordered insert keeps.  seq is unique; rows with a null key are not kept."""
    ship(rows.sparkSession)
    left = Stored(rows.select(F.col(seq).alias("s"), F.col(first).alias("u"), F.col(second).alias("h")).filter("u IS NOT NULL AND h IS NOT NULL"))
    kept = None
    for turn in range(rounds + 1):
        if turn == rounds:
            chosen = _in_order(left.df)
        else:
            by_u = left.df.groupBy("u").agg(F.min("s").alias("s"))
            by_h = left.df.groupBy("h").agg(F.min("s").alias("s"))
            chosen = stored(by_u.join(by_h, "s").select("s", "u", "h"))
        kept = chosen if kept is None else kept.union(chosen)
        if turn == rounds:
            break
        after = Stored(left.df.join(chosen.select("u"), "u", "left_anti").join(chosen.select("h"), "h", "left_anti"))
        left.drop()
        left = after
        if left.df.isEmpty():
            break
    return kept.select(F.col("s").alias(seq), F.col("u").alias(first), F.col("h").alias(second))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _in_order(left: DataFrame) -> DataFrame:
    """(s, u, h) of the rows kept, by reading each group of rows linked by keys in order."""
    kind = left.schema["s"].dataType.simpleString()
    pairs = stored(left.select(F.col("s").alias("node"), F.explode(F.array(F.concat(F.lit("u"), "u"), F.concat(F.lit("h"), "h"))).alias("key")))
    grouped = left.join(_components(pairs), left.s == F.col("node")).select("root", "s", F.concat(F.lit("u"), "u").alias("u"), F.concat(F.lit("h"), "h").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_streamed(batches), lambda r: r[0]):
            taken, out = set(), []
            for _, s, u, h in rows:
                if u not in taken and h not in taken:
                    taken |= {u, h}
                    out.append(s)
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out)], names=["s"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out)], names=["s"])

    chosen = grouped.repartition("root").sortWithinPartitions("root", "s").mapInArrow(run, f"s {kind}")
    return stored(left.join(chosen, "s").select("s", "u", "h"))


def insert_new(store: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    """Rows of ``batch`` that an insert-only run saves: keys not stored, first of their keys."""
    fresh = batch.join(store.select("url"), "url", "left_anti").join(store.select("content_hash"), "content_hash", "left_anti")
    return batch.join(two_key_first(fresh, seq).select(seq), seq, "left_semi")


def outcomes_in_order(rows: Iterator[tuple]) -> Iterator[tuple[int, str]]:
    """(seq, outcome) of the rows inserted and updated of a group of new links, from (seq, url, hash, filled, change) in order.

    A row with a change (1 or -1) and no url says that another link takes or leaves
    the hash.  A row whose url is there with a blank description updates it; one
    whose url isn't there is inserted if no link holds its hash.
    """
    by_url: dict[str, tuple[str, bool]] = {}
    hashes: dict[str, int] = {}
    for seq, url, digest, filled, change in rows:
        if change:
            hashes[digest] = hashes.get(digest, 0) + change
            continue
        old = by_url.get(url)
        if old is not None and old[1] or old is None and hashes.get(digest, 0) > 0:
            continue
        if old is not None:
            hashes[old[0]] -= 1
        yield seq, "inserted" if old is None else "updated"
        by_url[url] = digest, filled
        hashes[digest] = hashes.get(digest, 0) + 1


def _components(pairs: DataFrame) -> DataFrame:
    """(node, root) from (node, key) memberships: nodes that share keys, by least label and pointer doubling."""
    label = Stored(pairs.select("node", F.col("node").alias("root")).distinct())
    for _ in range(100):
        low = pairs.join(label.df, "node").groupBy("key").agg(F.min("root").alias("low"))
        best = stored(pairs.join(low, "key").groupBy("node").agg(F.min("low").alias("best")))
        joined = label.df.join(best, "node").select("node", F.least("root", "best").alias("near"), "root")
        jump = label.df.select(F.col("node").alias("near"), F.col("root").alias("far"))
        after = Stored(joined.join(jump, "near", "left").select("node", F.least("near", F.coalesce("far", "near")).alias("root"), (F.least("near", F.coalesce("far", "near")) < F.col("root")).alias("moved")))
        moved = not after.df.filter("moved").isEmpty()
        label.drop()
        label = after
        if not moved:
            return label.df.select("node", "root")
    raise RuntimeError("components did not settle")


#: Rows of new links that one task reads in order, where no more are left.
FEW = 100_000
#: A hash is held from before any row, or for good.
BEFORE, FOREVER = -(1 << 62), 1 << 62


def _spread(rows: DataFrame, span: int, key: str) -> tuple[DataFrame, Window]:
    """Rows with block b of ``span`` numbers, and the window of a key's blocks: so one key's rows never meet in a task whole."""
    return rows.withColumn("b", F.floor(F.col("s") / span)), Window.partitionBy(key).orderBy("b")


def _until_next(rows: DataFrame, span: int) -> DataFrame:
    """(h, start, end) of links' rows (u, s, h): each holds its hash until the link's next row."""
    rows, over = _spread(rows, span, "u")
    within = rows.withColumn("n", F.lead("s").over(Window.partitionBy("u", "b").orderBy("s")))
    heads = within.groupBy("u", "b").agg(F.min("s").alias("head")).withColumn("then", F.lead("head").over(over)).select("u", "b", "then")
    return within.join(heads, ["u", "b"]).select("h", F.col("s").alias("start"), F.coalesce("n", "then", F.lit(FOREVER)).alias("end"))


def _struck(rows: DataFrame, holds: DataFrame, span: int) -> DataFrame:
    """Rows (s, u, h, filled, open) with those closed whose hash is held at their time, by a running maximum of the ends."""
    ours = rows.select("h").distinct()
    near = rows.join(holds.select("h").distinct(), "h", "left_semi")  # no other row's hash is held at any time
    events = near.select("h", "s", F.lit(None).cast("bigint").alias("end"), "u").union(holds.join(ours, "h", "left_semi").select("h", F.col("start").alias("s"), "end", F.lit(None).cast("string").alias("u")))
    events, over = _spread(events, span, "h")
    within = events.withColumn("m", F.max("end").over(Window.partitionBy("h", "b").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)))
    before = within.groupBy("h", "b").agg(F.max("end").alias("top")).withColumn("earlier", F.max("top").over(over.rowsBetween(Window.unboundedPreceding, -1))).select("h", "b", "earlier")
    held = within.filter("u IS NOT NULL").join(before, ["h", "b"]).filter(F.greatest("m", "earlier") > F.col("s")).select("s", F.lit(True).alias("held"))
    return rows.join(held, "s", "left").select("s", "u", "h", "filled", (F.col("open") & F.col("held").isNull()).alias("open"))


def _chains(rows: DataFrame) -> DataFrame:
    """Rows (u, s, h, filled) up to each link's first that fills its description: those that are written."""
    fill = stored(rows.filter("filled").groupBy("u").agg(F.min("s").alias("fill")))
    return rows.join(fill, "u", "left").filter(F.col("s") <= F.coalesce("fill", F.lit(FOREVER))).drop("fill")


def _rest_in_order(left: DataFrame, holds: DataFrame, whole: bool = False) -> DataFrame:
    """(s, outcome) of rows inserted and updated, each group of links that share hashes read in order as a stream of keys; ``whole``: all rows as one group."""
    ours = left.select("h").distinct()
    known = holds.join(ours, "h", "left_semi")
    change = known.select(F.col("start").alias("s"), "h", F.lit(1).alias("change")).union(known.filter(F.col("end") < FOREVER).select("end", "h", F.lit(-1)))
    if whole:
        roots, of_hash = left.select(F.lit(0).cast("bigint").alias("root"), "s", "u", "h", "filled"), ours.withColumn("root", F.lit(0).cast("bigint"))
    else:
        pairs = stored(left.select(F.col("s").alias("node"), F.explode(F.array(F.concat(F.lit("u"), "u"), F.concat(F.lit("h"), "h"))).alias("key")))
        roots = stored(left.join(_components(pairs), left.s == F.col("node")).select("root", "s", "u", "h", "filled"))
        of_hash = roots.groupBy("h").agg(F.min("root").alias("root"))
    events = roots.withColumn("change", F.lit(0)).union(change.join(of_hash, "h").select("root", "s", F.lit(None).cast("string"), "h", F.lit(None).cast("boolean"), "change"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_streamed(batches), lambda r: r[0]):
            found = outcomes_in_order(r[1:] for r in rows)
            while out := list(islice(found, 10_000)):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["s", "outcome"])

    return events.select("root", "s", "u", "h", "filled", "change").repartition("root").sortWithinPartitions("root", "s").mapInArrow(run, "s bigint, outcome string")


def resolved(store: DataFrame, batch: DataFrame, rounds: int = 12, few: int = FEW, blocks: int = 1000) -> DataFrame:
    """(s, outcome) of the rows inserted and updated, of store (u, h, filled) and batch (s, u, h, filled) rows; all others are duplicates.

    Every step is a join or a partial aggregate, or a window over a block of one
    key's rows.  For rows in random order the rounds grow with the logarithm of
    their number; what ``rounds`` leave (links that wait for each other one by one)
    is read in order, group by group.  Up to ``few`` rows of new links are read in
    order by one task at once.
    """
    span = max(1, -(-(batch.agg(F.max("s") - F.min("s")).first()[0] or 0) // blocks))
    known = store.select("u", F.col("h").alias("old"), F.col("filled").alias("done"))
    both = stored(batch.join(known, "u", "left"))
    refill = stored(_chains(both.filter("NOT done").select("u", "s", "h", "filled")))
    first = refill.groupBy("u").agg(F.min("s").alias("s"))
    holds = [stored(store.join(first, "u", "left").select("h", F.lit(BEFORE).alias("start"), F.coalesce("s", F.lit(FOREVER)).alias("end")).union(_until_next(refill, span)))]
    found = [refill.select("s", F.lit("updated").alias("outcome"))]
    left = Stored(_struck(both.filter("done IS NULL").select("s", "u", "h", "filled", F.lit(True).alias("open")), holds[0], span))
    if left.df.limit(few + 1).count() <= few:
        return found[0].union(_rest_in_order(left.df, holds[0], True))
    for turn in range(rounds + 1):
        first = stored(left.df.filter("open").groupBy("u").agg(F.min("s").alias("c")))
        if first.isEmpty():
            break
        live = stored(left.df.join(first, "u").filter("s >= c"))  # rows before, and links whose rows are all struck, are duplicates
        if turn == rounds:
            rest = live.select("s", "u", "h", "filled", "open")
            every = holds[0]
            for h in holds[1:]:
                every = every.union(h)
            found.append(stored(_rest_in_order(rest, every)))
            break
        least = stored(live.groupBy("h").agg(F.min("s").alias("m")))
        won = stored(live.filter("s = c").join(least, "h").filter("s = m").select("u", "c"))
        taken = stored(_chains(live.drop("c").join(won, "u").select("u", "s", "h", "filled", "c")))
        found.append(taken.select("s", F.when(F.col("s") == F.col("c"), "inserted").otherwise("updated").alias("outcome")))
        holds.append(stored(_until_next(taken, span)))
        after = Stored(_struck(live.join(won.select("u"), "u", "left_anti").select("s", "u", "h", "filled", "open"), holds[-1], span))
        left.drop()
        left = after
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def upsert(store: DataFrame, batch: DataFrame, seq: str = "seq", rounds: int = 12, few: int = FEW, written: bool = False) -> tuple[DataFrame, DataFrame]:
    """(store afterwards, outcomes (seq, outcome)) of saving ``batch`` in order; urls of the store and seq are unique, urls and hashes not null.

    A row whose url is stored with a blank description updates it; else a row whose
    url or hash is stored is a duplicate; else it is inserted.  Rows see what earlier
    ones have done; ``resolved`` works that out from keys, and the rows themselves
    meet in joins afterwards.  ``written``: both are read from files as they are.
    """
    ship(batch.sparkSession)
    columns = [c for c in batch.columns if c != seq]
    old = store.select(*columns) if written else stored(store.select(*columns))
    came = batch if written else stored(batch)
    keys = [F.col("url").alias("u"), F.col("content_hash").alias("h"), (~is_blank(F.col("job_description"))).alias("filled")]
    with scratch(batch.sparkSession) as keep:
        won = resolved(old.select(*keys), came.select(F.col(seq).cast("bigint").alias("s"), *keys), rounds, few)
        every = came.select(F.col(seq).cast("bigint").alias("seq"))
        outcomes = keep(every.join(won.withColumnRenamed("s", "seq"), "seq", "left").select("seq", F.coalesce("outcome", F.lit("duplicate")).alias("outcome"))).df

    by_seq = came.withColumn("seq", F.col(seq).cast("bigint"))
    taken = by_seq.join(outcomes.filter("outcome <> 'duplicate'"), "seq")
    fresh = taken.filter("outcome = 'inserted'").select(*columns)
    written = ("job_description", "last_updated", "scraped_at", "content_hash")
    last = taken.filter("outcome = 'updated'").groupBy("url").agg(F.max_by(F.struct(*written), "seq").alias("__new"))
    rows = old.select(*columns).union(fresh).join(last, "url", "left")
    after = rows.select(*[F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in written else F.col(c) for c in columns])
    return after, outcomes.select(F.col("seq").alias(seq), "outcome")
