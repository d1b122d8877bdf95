"""Language by CRF, co-bucketed tables and cross-tokenizer alignment against brute force; edge cases of each."""

import glob
import hashlib
import os
import random
import re
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobloom.llm import co_bucket, cross_tokens, lang_crf, queries
from jobloom.llm.byte_bpe import byte_table

SF = "/root/testdata/sf0.001"
CLASHES = ["part", "number", "bucket", "k", "l", "r", "n", "file", "block", "pair", "at", "told", "lang_pred", "score", "rank", "h"]


def plain_forward_backward(weights, first, transitions, start):
    """The recursions in logarithms, text by text."""
    out, pairs = np.zeros_like(weights), np.zeros_like(transitions)
    bounds = [*np.flatnonzero(first), len(weights)]
    for a, b in zip(bounds, bounds[1:]):
        e = weights[a:b]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[0] = start + e[0]
        for i in range(1, len(e)):
            alpha[i] = np.logaddexp.reduce(alpha[i - 1][:, None] + transitions, axis=0) + e[i]
        for i in range(len(e) - 2, -1, -1):
            beta[i] = np.logaddexp.reduce(transitions + (e[i + 1] + beta[i + 1])[None, :], axis=1)
        whole = np.logaddexp.reduce(alpha[-1])
        out[a:b] = np.exp(alpha + beta - whole)
        for i in range(1, len(e)):
            pairs += np.exp(alpha[i - 1][:, None] + transitions + (e[i] + beta[i])[None, :] - whole)
    return out, pairs


def test_chunked_forward_backward_is_the_plain_one():
    rng = np.random.default_rng(0)
    for n in (1, 5, 700):
        weights, first = rng.normal(0, 3, (n, 3)), rng.random(n) < 0.03
        first[0] = True
        transitions, start = rng.normal(0, 1, (3, 3)), rng.normal(0, 1, 3)
        want = plain_forward_backward(weights, first, transitions, start)
        for chunk in (1, 7, 64, 1000):
            got = lang_crf.forward_backward(weights, first, transitions, start, chunk)
            assert np.abs(got[0] - want[0]).max() < 1e-9 and np.abs(got[1] - want[1]).max() < 1e-7


def test_words_and_their_places():
    texts = ["", "Été d'hiver 12 x", "́ 1 2", "ab\0cd", "ﬁn İx 中文"]
    w = lang_crf.Words(texts)
    got = [(o, texts[o][a:b]) for o, a, b in zip(w.owner, w.starts, w.stops)]
    assert got == [(1, "Été"), (1, "d"), (1, "hiver"), (1, "x"), (3, "ab"), (3, "cd"), (4, "ﬁn"), (4, "İx"), (4, "中文")]
    assert len({*lang_crf.Words(["Abc abc ABC"]).hashes.tolist()}) == 1


def test_languages_of_the_held_out_fold(spark):
    """Accuracy on rows that the model has not seen; code-switched text is labelled part by part."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = lang_crf.train(docs, most_rows=400)
    got = lang_crf.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert len(held) > 200 and np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    some = {r.lang: r.text for r in docs.filter("n_chars BETWEEN 400 AND 900").collect()}
    mixed = some["de"][:300] + " " + some["es"][:300]
    (row,) = lang_crf.label_spans(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).collect()
    of = lambda lang, a, b: sum(min(s.end, b) - max(s.start, a) for s in row.spans if s.lang == lang and s.start < b and s.end > a)
    assert of("de", 0, 300) > 200 and of("es", 301, 601) > 200


def test_language_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "12 !", "b"), (4, "der die das", "a"), (None, "les des", None), (4, "der die das", "a")], "doc_id long, text string, lang string").withColumns({c: F.lit("clash") for c in CLASHES if c != "lang"})
    many = spark.range(60).select("id", F.when(F.col("id") % 2 == 0, "der die und das").otherwise("les des et une").alias("text"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("lang"))
    model = lang_crf.train(many.withColumnRenamed("id", "doc_id"))
    got = Counter((r.doc_id, r.held_out, r.lang_pred) for r in lang_crf.predict(docs, model).collect())
    fold = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    assert got == Counter([(1, fold(1), "und"), (2, fold(2), "und"), (3, fold(3), "und"), (4, fold(4), "a"), (4, fold(4), "a"), (None, False, "b")])
    assert lang_crf.predict(docs.filter("false"), model).count() == 0
    nothing = lang_crf.train(docs.filter("false"))
    assert {r.lang_pred for r in lang_crf.predict(docs, nothing).collect()} == {"und"}


def plain_buckets(left, right, buckets):
    """What op12 has to return, by (table, bucket): rows in order, digests, joined rows, rewritten."""
    own = lambda k: zlib.crc32(b"s" + str(k).encode()) % buckets
    known = {r[0] for r in left if r[0] is not None}
    order = lambda r: tuple((False, 0) if x is None else (True, x.encode() if isinstance(x, str) else x) for x in r)
    a, b, joined, want = Counter(r[0] for r in left), Counter(r[0] for r in right), Counter(), {}
    for k in known:
        joined[own(k)] += a[k] * b[k]
    for name, rows in (("sales", left), ("sale_lines", right)):
        final, start, lineage = defaultdict(list), defaultdict(set), defaultdict(Counter)
        for r in rows:
            to = buckets + 1 if r[0] is None else own(r[0]) if name == "sales" or r[0] in known else buckets
            at = (to - 1 if to % 4 == 1 else to) if name == "sales" else 0 if r[2] is None else zlib.crc32(str(r[2]).encode()) % buckets
            final[to].append(r)
            start[at].add(to)
            lineage[to][at] += 1
        for to, x in final.items():
            x.sort(key=order)
            stays = len(lineage[to]) == 1 and len(start[min(lineage[to])]) == 1
            sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
            want[name, to] = x, sha(",".join("" if r[0] is None else str(r[0]) for r in x)), sha(",".join(f"{s}:{n}" for s, n in sorted(lineage[to].items()))), joined[to] if to < buckets else 0, not stays
    return want


def held_against(rows, want, folder):
    assert {(r.table_name, r.bucket) for r in rows} == set(want) and len(rows) == len(want)
    for r in rows:
        x, ids, lineage, joined, rewritten = want[r.table_name, r.bucket]
        assert (r.ids_sha256, r.lineage_sha256, r.n_rows, r.n_joined, r.rewritten) == (ids, lineage, len(x), joined, rewritten)
        found = pq.ParquetFile(r.path.removeprefix("file:")).read()
        assert ",".join(found.column_names) == r.columns and list(zip(*[c.to_pylist() for c in found.columns])) == x
    assert {p for p in glob.glob(f"{folder}/**", recursive=True) if os.path.isfile(p)} == {r.path.removeprefix("file:") for r in rows}


def test_co_bucketed_tables(spark, tmp_path):
    """Hot keys that are sorted in ranges, a filter so small that rows are joined, repeated and null keys."""
    rng = random.Random(4)
    left = [(i, rng.choice([None, "a", "é", "b"])) for i in rng.sample(range(300), 200)] + [(5, "twice"), (5, "twice"), (None, "x"), (None, None)]
    right = [(7 if rng.random() < 0.4 else rng.choice([None, *range(400)]), rng.choice([1, 2, None]), rng.choice([None, *range(40)]), "part") for _ in range(1500)]
    a = spark.createDataFrame(left, "sale_id long, number string").repartition(3)
    b = spark.createDataFrame(right, "sale_id long, bucket int, item_id long, k string").repartition(3)
    for bits, hot in ((1 << 16, 200_000), (64, 100), (1 << 10, 100)):
        folder = f"{tmp_path}/{uuid.uuid4().hex}"
        got = co_bucket.co_bucketed(a, b, folder, ("sales", "sale_lines"), "sale_id", "item_id", 12, hot, bits).collect()
        held_against(got, plain_buckets(left, right, 12), folder)
    folder = f"{tmp_path}/empty"
    assert co_bucket.co_bucketed(a.filter("false"), b.filter("false"), folder, ("sales", "sale_lines"), "sale_id", "item_id").count() == 0
    orphans = co_bucket.co_bucketed(a.filter("false"), b.filter("bucket = 1"), f"{tmp_path}/orphans", ("sales", "sale_lines"), "sale_id", "item_id", 12).collect()
    held_against(orphans, plain_buckets([], [r for r in right if r[1] == 1], 12), f"{tmp_path}/orphans")


def test_op12_of_the_shop(spark):
    got = queries.op12_co_bucket(spark, SF).collect()
    left, right = (list(zip(*[c.to_pylist() for c in pq.read_table(f"{SF}/{t}.parquet").columns])) for t in ("sales", "sale_lines"))
    held_against(got, plain_buckets(left, right, 600), os.path.dirname(os.path.dirname(os.path.dirname(got[0].path.removeprefix("file:")))))


def plain_alignment(texts):
    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    names, table = {i: w for w, i in a_side.get_vocab().items()}, byte_table()
    found, held = [], Counter()
    for text in texts:
        found.append(None)
        if not text:
            continue
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        a_bytes = [bytes(table[c] for c in names[i]) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b_side.id_to_piece, b)]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            continue
        links, groups, i, j, a_end, b_end = [], [([a[0]], [b[0]])], 0, 0, len(a_bytes[0]), len(b_bytes[0])
        while True:
            links.append((a[i], b[j]))
            move_a, move_b = a_end <= b_end, b_end <= a_end
            if move_a and i + 1 == len(a):
                break
            if move_a and move_b:
                groups.append(([], []))
            if move_a:
                i += 1
                a_end += len(a_bytes[i])
                groups[-1][0].append(a[i])
            if move_b:
                j += 1
                b_end += len(b_bytes[j])
                groups[-1][1].append(b[j])
        found[-1] = len(a), len(b), groups, links
        held.update(set(links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    for r in found:
        if r is None:
            yield 0, 0, 0, 0, 0, 0, ""
        else:
            n_a, n_b, groups, links = r
            text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
            yield n_a, n_b, len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest()


def test_alignment(spark, monkeypatch):
    odd = [None, "", " ", "  a  b\n\n c ", "<|endoftext|> <s> </s>", "a▁b", "é中😀 naïve\x00nul", "word " * 9000 + "x" * 3000, " lead", "tail  ", "ﬁ①", " x　y", "a" * 3000, "same", "same"]
    texts = odd + pq.read_table(f"{SF}/documents.parquet", columns=["text"]).column(0).to_pylist()[:120]
    assert cross_tokens.PieceVocabulary(public_tokenizers.path("piece_bpe_32k.model")).in_units
    docs = spark.createDataFrame([(i, t, *CLASHES) for i, t in enumerate(texts)], f"doc_id long, text string, {', '.join(f'`{c}` string' for c in CLASHES)}").repartition(3)
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in cross_tokens.align(docs, block_bytes=60_000).collect()}
    assert [got[i] for i in range(len(texts))] == list(plain_alignment(texts))
    assert cross_tokens.align(docs.filter("false")).count() == 0
    monkeypatch.setattr(cross_tokens, "PIECE", 50)
    block = cross_tokens.Block(cross_tokens.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")), texts)
    assert [(*c, d) for c, d in zip(block.counts.T.tolist(), block.digests)] == [(*r[:4], r[6]) for r in plain_alignment(texts)]


def test_op13_counts_null_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "ab cd"), (1, "ab cd"), (None, "ab cd"), (None, None)], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_links, r.count_sum) for r in cross_tokens.align(docs).collect())
    links = next(plain_alignment(["ab cd"]))[3]
    assert got == Counter({(1, links, 3 * links): 2, (None, links, 3 * links): 1, (None, 0, 0): 1})
    assert queries.op13_cross_tokens(spark, SF).columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_stages_beside_columns_of_any_name(spark, monkeypatch):
    """Columns that are named like those the library makes change nothing and pass through; with and without shuffled joins."""
    import corpus_pipeline
    from jobloom.llm import decontaminate, exact_dedup, line_dedup, near_copies

    sources = "".join(open(m.__file__, encoding="utf-8").read() for m in (decontaminate, exact_dedup, line_dedup, near_copies, co_bucket, cross_tokens, lang_crf))
    names = sorted({*re.findall(r'"(__\w+)"', sources), *re.findall(r'alias\("(\w+)"\)', sources)} - {"text", "doc_id", "source", "n_lines", "n_dropped"})
    assert {"__id", "__key", "host"} <= {*names}
    rows = [(1, "same words here and there now", "a"), (2, "same words here and there now", "a"), (3, None, "a"), (4, "", None), (5, "menu\nown text of five words or more", "b"), (6, "menu\nanother text that stands for itself alone", "b"), (5, "menu\nown text of five words or more", "b"), (None, "no id for this text of some words", "c")]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    clash = plain.withColumns({n: F.lit("clash") for n in names})
    bench = spark.createDataFrame([(1, "no id for this text of some words")], "item_id bigint, text string")
    steps = [
        lambda d: line_dedup.drop_boilerplate(d, 0.5).drop("n_lines", "n_dropped"),
        near_copies.keep_one,
        lambda d: decontaminate.drop_contaminated(d, bench),
        lambda d: exact_dedup.exact_duplicates(d),
    ]
    for limit in (None, 0):
        if limit is not None:
            monkeypatch.setattr(line_dedup, "BROADCAST_LINES", limit)
            monkeypatch.setattr(exact_dedup, "BROADCAST_IDS", limit)
            monkeypatch.setattr(exact_dedup, "SUSPECT_BITS", 1 << 12)
        for i, step in enumerate(steps):
            want, got = step(plain), step(clash)
            if i < 3:
                assert got.columns == clash.columns and {tuple(r[n] for n in names) for r in got.collect()} == {("clash",) * len(names)}
            assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    stage = corpus_pipeline.line_stage(spark, clash.withColumn("n_chars", F.lit(0).cast("bigint")), SF)
    assert stage.columns == [*clash.columns, "n_chars"]
