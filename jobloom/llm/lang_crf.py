"""Language of texts by a linear-chain conditional random field over their words.

A word's features are its character n-grams, its affixes and its entry in a lexicon
of common words; transitions between the labels of neighbouring words are learned too.
Forward-backward gives each word's probability of each language, so text that
switches language is labelled word by word; a text's language is the one that
most of its words are expected to have.

All words of a block of texts are one chain, in which the first word of a text resets
the state.  It is cut into chunks of equal length: the chunks' transfer matrices are
made side by side, composed in order, and the chunks' inner states follow side by side again.
The result is that of the plain recursion.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import batch_of, ship, text_blocks

#: Rows of the table of hashed features (a power of two), words of the lexicon, words of a chunk.
HASHED, LEXICON, CHUNK = 1 << 16, 1 << 14, 256
#: Language of a text without letters.
UNKNOWN = "und"


@cache
def character_tables() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: its lower-case form (itself if that is no single character) if it can stand in a word, else 0; and whether it is a letter."""
    points = np.zeros(0x110000, np.uint32)
    letters = np.zeros(0x110000, bool)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LM":
            low = chr(c).lower()
            points[c] = ord(low) if len(low) == 1 else c
            letters[c] = kind == "L"
    return points, letters


def _mixed(*parts: np.ndarray) -> np.ndarray:
    """Rows of the hashed table for tuples of numbers."""
    h = np.full(len(parts[0]), len(parts) * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for p in parts:
        h = (h ^ p.astype(np.uint32)) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
    return (h * np.uint32(0xC2B2AE35) >> np.uint32(16)) & np.uint32(HASHED - 1)


class Words:
    """Words of texts: runs of letters and marks with a letter among them.  starts and stops are code points within the words' texts."""

    def __init__(self, texts: list[str]):
        points, letters = character_tables()
        sizes = np.array([len(x) for x in texts], np.int64)
        raw = np.frombuffer("\0".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)  # a gap before, between and after
        low = points[raw]
        at = np.flatnonzero(low)
        first = low[at - 1] == 0
        begin = np.flatnonzero(first)
        end = np.append(begin, len(at))[1:]
        if len(begin):
            good = np.logical_or.reduceat(letters[raw[at]], begin)
            if not good.all():
                keep = np.repeat(good, end - begin)
                at, first = at[keep], first[keep]
                begin = np.flatnonzero(first)
                end = np.append(begin, len(at))[1:]
        self.n, self.begin = len(begin), begin
        begins = np.cumsum(sizes + 1) - sizes  # of texts
        self.owner = np.searchsorted(begins, at[begin], "right") - 1
        self.starts, self.stops = at[begin] - begins[self.owner], at[end - 1] + 1 - begins[self.owner]
        self.characters, self.previous, self.next = low[at], low[at - 1], low[at + 1]
        place = np.arange(len(at)) - np.repeat(begin, end - begin)
        power = np.multiply.accumulate(np.full(int(place.max(initial=0)) + 1, 0x100000001B3, np.uint64))
        self.hashes = np.add.reduceat(self.characters * power[place], begin) if self.n else np.zeros(0, np.uint64)
        length = end - begin
        near = lambda base, step, inside: np.where(inside, self.characters[np.clip(base + step, 0, max(0, len(at) - 1))], 0) if self.n else np.zeros(0, np.uint32)
        head = [near(begin, i, length > i) for i in range(4)]
        tail = [near(end - 1, -i, length > i) for i in range(4)]
        one = np.full(self.n, 1, np.uint32)
        self.affixes = np.stack([_mixed(one, *head[:3]), _mixed(one, *head), _mixed(one, one, *tail[:3]), _mixed(one, one, *tail), _mixed(one, one, one, np.minimum(length, 12))]) if self.n else np.zeros((5, 0), np.uint32)

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each character's bigram with the one before, and trigram with those on both sides; 0 stands for a word's end."""
        return _mixed(self.previous, self.characters), _mixed(self.previous, self.characters, self.next)


@dataclass
class Model:
    """Weights by feature and label: hashed features, lexicon (sorted hashes of words; the last row is for all other words), transitions and starts."""

    labels: list[str]
    hashed: np.ndarray
    lexicon: np.ndarray
    words: np.ndarray
    transitions: np.ndarray
    start: np.ndarray

    def entries(self, w: Words) -> np.ndarray:
        """Row of each word in the lexicon's weights."""
        if not len(self.lexicon):
            return np.zeros(w.n, np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, w.hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == w.hashes, at, len(self.lexicon))

    def emissions(self, w: Words) -> np.ndarray:
        """Weight of each label for each word."""
        if not w.n:
            return np.zeros((0, len(self.labels)), np.float32)
        two, three = w.grams()
        found = np.add.reduceat(self.hashed[two] + self.hashed[three], w.begin, axis=0) + self.words[self.entries(w)]
        for row in w.affixes:
            found += self.hashed[row]
        return found

    def posteriors(self, w: Words) -> np.ndarray:
        """Probability of each label for each word."""
        return forward_backward(self.emissions(w), np.append(True, w.owner[1:] != w.owner[:-1])[: w.n], self.transitions, self.start, count_pairs=False)[0]


def forward_backward(emissions: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray, chunk: int = CHUNK, count_pairs: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(posteriors by word and label; with ``count_pairs`` the expected number of transitions from label to label), of words in order, ``first`` marking where a text begins.  All weights are logarithms."""
    n, k = emissions.shape
    if not n:
        return np.zeros((0, k)), np.zeros((k, k))
    count = -(-n // chunk)
    step, begin = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    e = np.ones((count * chunk, k))
    e[:n] = np.exp(emissions - emissions.max(1, keepdims=True))
    e = np.maximum(e, 1e-30).reshape(count, chunk, k).transpose(1, 0, 2).copy()
    reset = np.zeros(count * chunk, bool)
    reset[:n], reset[n:] = first, True
    reset = reset.reshape(count, chunk).T
    any_reset = reset.any(1)

    def moved(state: np.ndarray, t: int) -> np.ndarray:
        """States (rows of label weights) after word t of each chunk."""
        after = state @ step
        if any_reset[t]:
            at = reset[t]
            after[at] = state[at].sum(-1, keepdims=True) * begin
        return after * (e[t] if state.ndim == 2 else e[t][:, None, :])

    product = np.broadcast_to(np.eye(k), (count, k, k))
    for t in range(chunk):
        product = moved(product, t)
        product /= product.sum((1, 2), keepdims=True)
    state, heads = np.full(k, 1 / k), np.empty((count, k))
    for i in range(count):
        heads[i] = state
        state = state @ product[i]
        state /= state.sum()
    state, tails = np.ones(k), np.empty((count, k))
    for i in range(count - 1, -1, -1):
        tails[i] = state
        state = product[i] @ state
        state /= state.sum()
    alpha, before = np.empty_like(e), heads
    for t in range(chunk):
        before = moved(before, t)
        before /= before.sum(1, keepdims=True)
        alpha[t] = before
    pairs, after = np.zeros((k, k)), tails
    for t in range(chunk - 1, -1, -1):
        alpha[t], state = alpha[t] * after, alpha[t - 1] if t else heads
        alpha[t] /= alpha[t].sum(1, keepdims=True)
        weighed = e[t] * after
        if count_pairs and not reset[t].all():
            joint = (state[:, :, None] * step * weighed[:, None, :])[~reset[t]]
            pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        after = weighed @ step.T
        if any_reset[t]:
            after[reset[t]] = 1.0
        after /= after.sum(1, keepdims=True)
    return alpha.transpose(1, 0, 2).reshape(-1, k)[:n], pairs


def switched(w: Words, label_of: np.ndarray, rng: np.random.Generator, mean: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Order of the words of labelled texts, and where sequences begin: half of the texts as they are, the others in runs of words that alternate between texts, as in code-switched text."""
    bounds = np.append(np.flatnonzero(np.append(True, w.owner[1:] != w.owner[:-1])), w.n)
    order, first, mixed = [], [], []
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if i % 2:
            order.append(np.arange(a, b))
            first.append(np.arange(b - a) == 0)
        else:
            cuts = np.cumsum(rng.geometric(1 / mean, (b - a) // mean + 1))
            mixed += np.split(np.arange(a, b), cuts[cuts < b - a])
    for i, j in enumerate(rng.permutation(len(mixed))):
        order.append(mixed[j])
        first.append((np.arange(len(mixed[j])) == 0) & (i % 8 == 0))
    return np.concatenate(order), np.concatenate(first)


def fit(rows: list[tuple[str, str]], priors: dict[str, float] | None = None, epochs: int = 4, batch: int = 20_000, rate: float = 0.3, seed: int = 7) -> Model:
    """rows: texts and their languages.  Weights by AdaGrad on the gradient of the likelihood: expected features and transitions are taken from those observed."""
    labels = sorted({y for _, y in rows})
    k = len(labels)
    number = {y: i for i, y in enumerate(labels)}
    w = Words([x for x, _ in rows])
    told = np.array([number[y] for _, y in rows], np.int64)
    seen = Counter(w.hashes.tolist())
    common = [h for h, c in seen.most_common(LEXICON) if c > 2]
    model = Model(labels, np.zeros((HASHED, k), np.float32), np.array(sorted(common), np.uint64), np.zeros((len(common) + 1, k), np.float32), np.zeros((k, k)), np.zeros(k))
    if k < 2 or not w.n:
        return model
    y = told[w.owner]
    two, three = w.grams()
    ends = np.append(w.begin[1:], len(w.characters))
    entries, sums = model.entries(w), [np.full(x.shape, 1e-2) for x in (model.hashed, model.words, model.transitions, model.start)]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order, first = switched(w, told, rng)
        for i in range(0, len(order), batch):
            at, begins = order[i : i + batch], first[i : i + batch].copy()
            begins[0] = True
            size = ends[at] - w.begin[at]
            inner = np.repeat(w.begin[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            a, b, entry, word = two[inner], three[inner], entries[at], np.repeat(np.arange(len(at)), size)
            emission = np.add.reduceat(model.hashed[a] + model.hashed[b], np.cumsum(size) - size, axis=0) + model.words[entry]
            for row in w.affixes:
                emission += model.hashed[row[at]]
            expected, pairs = forward_backward(emission, begins, model.transitions, model.start)
            right = np.eye(k)[y[at]]
            delta = right - expected
            features = np.concatenate([a, b, *[row[at] for row in w.affixes]])
            words = np.concatenate([word, word, *[np.arange(len(at))] * len(w.affixes)])
            seen_pairs = np.zeros((k, k))
            inside = np.flatnonzero(~begins)
            np.add.at(seen_pairs, (y[at][inside - 1], y[at][inside]), 1)
            gradients = (
                np.stack([np.bincount(features, delta[words, j], HASHED) for j in range(k)], 1),
                np.stack([np.bincount(entry, delta[:, j], len(model.words)) for j in range(k)], 1),
                seen_pairs - pairs,
                delta[begins].sum(0),
            )
            for x, g, s in zip((model.hashed, model.words, model.transitions, model.start), gradients, sums):
                g = g / np.sqrt(len(at))
                s += g * g
                x += (rate * g / np.sqrt(s)).astype(x.dtype)
    if priors:
        share = np.bincount(told, minlength=k) / len(told)
        model.start += np.log([max(priors.get(x, 0), 1e-9) for x in labels]) - np.log(share)
    return model


def held_out(id_column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, most_rows: int = 2400, most_bytes: int = 8 << 10, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model:
    """Fits on rows outside the held-out fold.

    The sample is bounded: about ``most_rows`` rows, as many of each language (20 at
    least), those whose ids hash lowest among the ones of ``most_bytes`` UTF-8 bytes at most.
    Languages start a text as often as in all rows.  Rows without a language, an id or a text are left out;
    of rows that share an id one counts.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang")).filter(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("id"))
    fits = F.octet_length("text") <= most_bytes
    told = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(fits).alias("short")).collect()
    counts = {r.lang: r.n for r in told}
    if not counts:
        return fit([])
    each = max(20, most_rows // len(counts))
    # Of n hashes the lowest ``each`` lie below this share of all, but for one case in very many: so few rows are ranked.
    bounds = F.create_map(*[F.lit(x) for r in told for x in (r.lang, min(1.0, (2 * each + 40) / max(1, r.short)))])
    share = F.xxhash64("id") / F.lit(2.0**64) + 0.5
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    short = rows.filter(fits & (share <= bounds[F.col("lang")]))
    ids = short.select("id", "lang").withColumn("rank", rank).filter(F.col("rank") <= each).select("id", "lang").dropDuplicates(["id"])
    sample = short.join(F.broadcast(ids), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text")).orderBy(F.xxhash64("id"), "id").collect()
    return fit([(r.text, r.lang) for r in sample], {x: n / sum(counts.values()) for x, n in counts.items()})


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score (mean probability of that language over the text's words), n_words.

    A null text, or one without a letter, is of the language ``und``, with score 0; so is every
    text if no language was learned.  A null id is not held out.  The prediction
    depends on the text alone.  Repeated rows are predicted each; other columns are
    ignored.  An empty table gives an empty result.  One pass, no shuffle.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for part, texts in text_blocks(batches, text_column, 512 << 10):
            w, k = Words(texts), len(model.labels)
            n = np.bincount(w.owner, minlength=len(texts))
            shares = np.zeros((len(texts), max(1, k)))
            if k:
                p = model.posteriors(w)
                shares = np.stack([np.bincount(w.owner, p[:, j], len(texts)) for j in range(k)], 1) / np.maximum(1, n)[:, None]
            best = shares.argmax(1)
            known = (n > 0) & bool(k)
            fields = pa.schema([part.schema.field(id_column), ("lang_pred", pa.string()), ("score", pa.float64()), ("n_words", pa.int64())])
            langs = [model.labels[j] if yes else UNKNOWN for j, yes in zip(best.tolist(), known.tolist())]
            yield batch_of(part, [id_column], fields, lang_pred=langs, score=np.where(known, np.minimum(1.0, shares.max(1)), 0.0), n_words=n)

    found = docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, lang_pred string, score double, n_words bigint")
    return found.select(id_column, held_out(id_column).alias("held_out"), "lang_pred", "score", "n_words")


def label_spans(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and spans (array of start, end, lang, n_words, score): a text's runs of words of one language, in code points.

    Null texts and texts without a letter have no spans.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("n_words", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for part, texts in text_blocks(batches, text_column, 512 << 10):
            w, out = Words(texts), [[] for _ in texts]
            p = model.posteriors(w) if model.labels else np.zeros((0, 1))
            if len(p):
                best = p.argmax(1)
                begin = np.flatnonzero(np.append(True, (best[1:] != best[:-1]) | (w.owner[1:] != w.owner[:-1])))
                end = np.append(begin[1:], w.n)
                means = np.add.reduceat(p[np.arange(w.n), best], begin) / (end - begin)
                for a, b, m in zip(begin.tolist(), end.tolist(), means.tolist()):
                    out[w.owner[a]].append({"start": int(w.starts[a]), "end": int(w.stops[b - 1]), "lang": model.labels[best[a]], "n_words": b - a, "score": m})
            yield batch_of(part, [id_column], pa.schema([part.schema.field(id_column), ("spans", pa.list_(span))]), spans=out)

    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, spans array<struct<start:int,end:int,lang:string,n_words:int,score:double>>")
