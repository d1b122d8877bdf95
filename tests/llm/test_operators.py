"""Training-data operators against brute force, round trips and held-out labels; edge cases of each."""

import hashlib
import random
import re
import zlib
from collections import Counter
from math import log2

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobloom.llm import byte_bpe, decontaminate, exact_dedup, license_scan, line_dedup, quality, queries, secret_scan, simhash, token_count, warc
from jobloom.llm.pretoken import STATES, classes, packs, pieces, prefix_scan, state_maps

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CLASHES = ["part", "row", "id", "n", "fp", "sha", "kept", "host", "page", "score", "line_key", "digest", "n_lines", "root", "a", "b", "ids", "hits", "bare", "owner", "suspect", "drops", "best"]
LONG = "word " * 60_000 + "x" * 50_000
TEXTS = [None, "", " \n\t", "a", "a", "Same text here now.", "Same  text here\nnow.", "Same text here now.", LONG, LONG, "é中😀 naïve\x00nul", "Released under the MIT License.", "tokſen=abcdefgh", "<|endoftext|>x<|endoftext|>"]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, None if i == 2 else "en", None if i == 3 else "src0", len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "Same text here now.", "en", "src0", 5), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(spark, docs):
    return quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))


def operators(spark, model):
    bench = spark.createDataFrame([(1, "same text here now"), (2, None), (3, "a"), (None, "word " * 20)], "item_id bigint, text string")
    return {
        "exact": exact_dedup.exact_duplicates,
        "count": token_count.token_counts,
        "quality": lambda d: quality.score(d, model),
        "keep_good": lambda d: quality.keep_good(d, model, 0.0),
        "secrets": secret_scan.scan_documents,
        "lines": line_dedup.drop_boilerplate,
        "bpe": lambda d: byte_bpe.encode_documents(d, offsets=True),
        "contamination": lambda d: decontaminate.contamination(d, bench, slop=2),
        "warc": lambda d: warc.round_trip(d, id_column="doc_id", url_column="source", payload_column="text"),
        "licenses": license_scan.scan_licenses,
        "simhash": simhash.near_duplicates,
    }


@pytest.mark.parametrize("name", ["exact", "count", "quality", "keep_good", "secrets", "lines", "bpe", "contamination", "warc", "licenses", "simhash"])
def test_edges_and_empty_table(spark, edge, model, name):
    f = operators(spark, model)[name]
    got = Counter(r.doc_id for r in f(edge).select("doc_id").collect())
    assert got == Counter(r.doc_id for r in edge.select("doc_id").collect())
    assert f(edge.filter("false")).count() == 0


def test_exact_duplicates(spark, edge):
    rows = edge.select("doc_id", "text").collect()
    got = exact_dedup.exact_duplicates(edge).collect()
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
    want = Counter()
    for text, members in groups.items():
        best = min(members)
        for m in members:
            want[None if m[1] else m[2], None if best[1] else best[2], len(members), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_exact_duplicates_when_a_task_writes_many_parts(spark):
    """Parts of one task, read in many splits and row groups, against counts by text."""
    hadoop, splits = spark.sparkContext._jsc.hadoopConfiguration(), "spark.sql.files.maxPartitionBytes"
    hadoop.set("parquet.block.size", "65536")
    spark.conf.set(splits, "1m")
    try:
        df = spark.range(3 * exact_dedup.PART_ROWS + 5).coalesce(1).select(F.col("id").alias("doc_id"), F.concat(F.lit("a "), (F.xxhash64("id") % 40_000).cast("string")).alias("text"))
        got = exact_dedup.exact_duplicates(df)
        groups = df.groupBy("text").agg(F.count(F.lit(1)).alias("want_size"), F.min("doc_id").alias("want_keep"))
        wrong = got.join(df.join(groups, "text"), "doc_id").filter((F.col("group_size") != F.col("want_size")) | (F.col("keep_id") != F.col("want_keep")) | (F.col("kept") != (F.col("doc_id") == F.col("want_keep"))))
        assert got.count() == df.count() and wrong.count() == 0
    finally:
        hadoop.unset("parquet.block.size")
        spark.conf.unset(splits)


def test_golomb_codes():
    rng = np.random.default_rng(1)
    for n, span in ((0, 10), (1, 2**63), (3000, 2**58), (4000, 5000)):
        values = np.unique(rng.integers(0, span, n, dtype=np.uint64))
        assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(values, span)) == values).all()


def test_state_maps_compose():
    text = "I'll say 12 'tis  \n\n x 's 're're " * 20
    cls = classes(np.array([ord(c) for c in text], np.uint32)).astype(np.int16)
    cls = cls[: len(cls) // 8 * 8].reshape(-1, 8).T
    whole = state_maps(np.ascontiguousarray(cls.T.reshape(-1, 1)))[:, 0]
    assert (prefix_scan(state_maps(np.ascontiguousarray(cls)))[:, -1] == whole).all() and len(whole) == STATES


def _odd_texts(n=3000):
    rng = random.Random(5)
    signs = list("'srtdmvel aZ1 ²½\n\t 　é中😀!?.’_<|>$ ​")
    pieces = ["the", "ing", "tion", "THE", "'re", " ", "é", "\n", "'ll", "  "]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(n)] + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 60))) for _ in range(n)] + ["<|endoftext|>a<|endoftext|>", "a" * 5000, "ab" * 3000, "", "\0"]


def test_token_counts_equal_the_library(docs):
    library = Tokenizer.from_file(VOCABULARY)
    texts = _odd_texts() + [r.text for r in docs.collect()]
    texts += ["".join(random.Random(3).choice("abcdeABC") for _ in range(200_000)), "ab" * 70_000 + "c", "é中" * 3000]  # words of many chunks
    assert token_count.count_texts(texts, VOCABULARY)[1] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_long_texts_are_cut_where_words_part():
    library = Tokenizer.from_file(VOCABULARY)
    texts = ["".join(rng.choice(["word", "'ll", " ", "\n", "  ", "12", "!", "é", "\t", "<|endoftext|>"]) for _ in range(400)) for rng in map(random.Random, range(20))]
    for text in texts:
        for limit in (1, 7, 50):
            parts = list(pieces(text, limit))
            assert "".join(parts) == text and len(parts) > 3
            assert [t for x in parts for t in library.encode(x, add_special_tokens=False).ids] == library.encode(text, add_special_tokens=False).ids
    held = list(packs(texts, 100))
    assert ["".join(p for part, owners in held for p, o in zip(part, owners) if o == i) for i in range(len(texts))] == texts


def test_queries_of_tokens_against_the_libraries(spark, docs):
    """op2 and op6 as registered: every column."""
    import base64

    library = Tokenizer.from_file(VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    want = {i: (len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 1024) for i, t in texts.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op2_token_count(spark, SF).collect()} == want
    ids = {i: np.array(other.encode_ordinary(t), "<u4").tobytes() for i, t in texts.items()}
    want = {i: (len(ids[i]) // 4, hashlib.sha256(ids[i]).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts.items()}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op6_byte_bpe(spark, SF).collect()} == want


def test_words_move_between_generations(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST_WORDS", 5)
    bpe, fresh = byte_bpe.ByteBpe(VOCABULARY), byte_bpe.ByteBpe(VOCABULARY)
    texts = [f"one two three {i} four five six" for i in range(30)]
    assert [bpe.encode([t]) for t in texts] == [[x] for x in fresh._encode(texts)] and b" two" in bpe.known and len(bpe.known) < 40


def test_transducer_survives_a_full_table():
    machine = token_count.TokenTransducer(VOCABULARY, most_states=50)
    library = Tokenizer.from_file(VOCABULARY)
    words = [w for w in {w for t in _odd_texts(200) for w in re.findall("[a-zA-Z]+", t)}] + ["thethethe" * 100]
    for w in words:
        data = np.frombuffer(w.encode(), np.uint8)
        assert machine.count(data, np.array([0]), np.array([len(data)]))[0] == len(library.encode(w, add_special_tokens=False).ids)


def test_bpe_round_trip(docs):
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = byte_bpe.codec(VOCABULARY)
    texts = _odd_texts() + [r.text for r in docs.collect()]
    ids = bpe.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [other.encode_ordinary(t) for t in texts]
    assert all(bpe.decode(x) == t.encode() for x, t in zip(ids, texts))
    library = Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = True
    for t, x, e in zip(texts, ids, library.encode_batch(texts[:500], add_special_tokens=False)):
        assert [tuple(o) for o in bpe.offsets(t, x).tolist()] == e.offsets
    split = np.frombuffer(bpe.encode(["é😀中"])[0], "<u4").tolist()
    assert "".join(bpe.decode_stream(split)) == "é😀中" and list(bpe.decode_stream(split[:1])) in (["é"], ["�"])


def test_decode_documents(docs):
    pairs = byte_bpe.decode_documents(byte_bpe.encode_documents(docs)).join(docs.select("doc_id", F.col("text").alias("was")), "doc_id")
    assert pairs.filter("text <> was").count() == 0


def test_quality_on_held_out_rows(spark):
    big = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    rows = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_quality_hears_a_bad_part_of_a_long_text():
    rng = random.Random(5)
    speak = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    calm = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    loud = [w.upper() + "!!" for w in calm]
    model = quality.fit([(speak(loud if i % 3 == 0 else calm, rng.randint(20, 400)), int(i % 3 != 0)) for i in rng.sample(range(900), 900)])
    texts = [speak(calm, 30_000), speak(loud, 30_000), speak(calm, 30), speak(loud, 30)]
    assert (model.score(quality.features(texts, model.compressors())) >= 0.5).tolist() == [True, False, True, False]


def test_quality_without_labels():
    assert quality.fit([]).score(np.zeros((1, quality.FEATURES)))[0] == 0.5
    assert quality.fit([("x", 1)] * 3).score(np.zeros((1, quality.FEATURES)))[0] > 0.5


def _entropy(s):
    return -sum(c / len(s) * log2(c / len(s)) for c in Counter(s).values())


def test_secret_scan():
    spans = secret_scan.scan('PassWord = "abc" token:abcdef AKIA' + "A1" * 9 + " " + "0123456789abcdef" * 2 + " password=token:abcdefgh")
    assert [(k, b - a) for a, b, k in spans if k != "entropy"] == [("assign", 12), ("access", 22), ("hex", 32)]
    assert secret_scan.scan("toKen=abcdefgh toſken=abcdefgh", entropy=False) == []
    rng = random.Random(2)
    for _ in range(300):
        s = "".join(rng.choice("abcdef0123456789" if rng.random() < 0.5 else "aB3dE6gH9jKlMnOpQrStUvWxYz") for _ in range(rng.randint(20, 60)))
        if secret_scan.ALLOWED.fullmatch(s) or any(s in run for run in secret_scan.RUNS):
            assert secret_scan.entropy_spans(s) == []
            continue
        limit = secret_scan.THRESHOLDS["hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", s) else "mixed"]
        hit = set()
        for i in range(len(s) - 19):
            if _entropy(s[i : i + 20]) >= limit - 1e-9:
                hit.update(range(i, i + 20))
        assert hit == {p for a, b in secret_scan.entropy_spans(s) for p in range(a, b)}
    assert secret_scan.entropy_spans("123e4567-e89b-12d3-a456-426614174000") == [] and secret_scan.entropy_spans("abcdefghijklmnopqrstuvwxyz") == []


def _base_spans(text):
    """The three base kinds by the contract's own patterns."""
    found = [(m.start(), m.end(), "assign") for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[0], ("assign", "access", "hex").index(x[2])))


def test_secret_query_against_the_contract(spark, docs):
    rng = random.Random(9)
    bits = ["password", "PASSWD", "Secret", "toKen", "api_key", "APIKEY", "ſecret", ":", "=", " ", "\"", "'", "AKIA", "AKIAAKIA", "0123456789abcdef", "deadbeef", "abc", "XYZ9", ".", "é", "😀", "\n", "-", "Q7", "a1b2c3d4e5f6a7b8c9d0e1f2"]
    texts = [None, "", *("".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(3000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").union(docs.select("doc_id", "text"))
    want = Counter()
    for r in df.collect():
        spans = _base_spans(r.text or "")
        kinds = Counter(k for *_, k in spans)
        want[r.doc_id, kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for a, b, k in spans)] += 1
    got = Counter()
    for r in secret_scan.scan_documents(df).collect():
        parts = [x.split(":") for x in r.spans.split(",") if x]
        assert sorted(parts, key=lambda x: (int(x[1]), secret_scan.KINDS.index(x[0]))) == parts and sum(x[0] == "entropy" for x in parts) == r.n_entropy
        got[r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, ",".join(":".join(x) for x in parts if x[0] != "entropy")] += 1
    assert got == want and sum(n * c[1] for c, n in want.items()) > 100


def test_random_tokens_of_every_alphabet_are_found():
    low, up, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    rng = random.Random(8)
    for letters, least in ((low + digits, 0.95), (up + "234567", 0.9), (low + up, 0.92), (low + up + digits, 0.75), (low + up + digits + "+/", 0.75)):
        tokens = ["".join(rng.choice(letters) for _ in range(20)) for _ in range(1000)]
        assert np.mean([bool(secret_scan.entropy_spans(x)) for x in tokens]) >= least, letters
    token = "q7x2m9k4z8w1v5t3r6p0" * 2
    assert secret_scan.entropy_spans(token + "/EXAMPLE") and secret_scan.entropy_spans("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY") == []
    for words in ("internationalizationandlocalization", "src/main/java/org/apache/commons/lang", "getElementsByClassNameAndTagName", "2020-01-01/2021-02-03_04"):
        assert secret_scan.entropy_spans(words) == [], words


def test_line_dedup(spark):
    rows = [(i, "h", f"menu one\nbody {i}\n\nfooter" if i < 8 else f"body {i}") for i in range(20)] + [(99, "h", "menu one\nfooter")]
    df = spark.createDataFrame(rows * 2, "doc_id int, source string, text string")
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(df, ratio=0.3, least_pages=5).collect()}
    assert got[0].text == "body 0\n" and got[0].n_dropped == 2 and got[99].text == "" and got[15].text == "body 15"
    kept = {r.doc_id: r for r in line_dedup.drop_boilerplate(df, ratio=0.5, least_pages=5).collect()}
    assert kept[0].n_dropped == 0  # 9 of 21 pages; the repeated rows are no pages of their own


def test_line_dedup_lets_the_ratio_decide(spark):
    rows = [(i, "few", f"menu\nbody {i}" if i < 3 else f"body {i}") for i in range(4)] + [(9, "one", "menu\nalone")] + [(10 + i, None, f"menu\nown {i}") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id int, source string, text string")
    got = {r.doc_id: r.text for r in line_dedup.drop_boilerplate(df).collect()}
    assert got == {0: "body 0", 1: "body 1", 2: "body 2", 3: "body 3", 9: "menu\nalone", 10: "own 0", 11: "own 1"}


def test_line_dedup_by_broadcast_and_by_shuffle(spark, monkeypatch):
    """Hosts with many boilerplate lines, so that the buckets of a host's list count."""
    rng = random.Random(6)
    common = {h: [f"{h} line {i}" for i in range(300)] for h in ("h", "k", "")}
    rows = [(i, h := rng.choice([*common]), "\n".join(x for pair in zip(rng.sample(common[h], 40), [f"own {i} {j}" for j in range(40)]) for x in pair)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id int, source string, text string")
    for most in (line_dedup.BROADCAST_LINES, 0):
        monkeypatch.setattr(line_dedup, "BROADCAST_LINES", most)
        seen, pages = Counter((h, x) for _, h, t in rows for x in set(t.split("\n"))), Counter(h for _, h, _ in rows)
        want = {i: "\n".join(x for x in t.split("\n") if not (seen[h, x] >= 2 and seen[h, x] > 0.1 * pages[h])) for i, h, t in rows}
        assert {r.doc_id: r.text for r in line_dedup.drop_boilerplate(df, ratio=0.1).collect()} == want
    assert {len(t.split("\n")) for t in want.values()} != {80}


def _hits(words, items, window=13):
    hit, names = set(), set()
    for name, item in items:
        k = min(window, len(item))
        grams = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)} if k else set()
        for i in range(len(words) - k + 1 if k else 0):
            if tuple(words[i : i + k]) in grams:
                hit.update(range(i, i + k))
                names.add(name)
    return len(hit), names


def test_decontamination(spark):
    rng = random.Random(3)
    vocabulary = ["aa", "bb", "cc", "É1", "dd"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 12, 13, 14, 40])))) for i in range(12)]
    texts = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if i % 2:
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(items)[1].split()
        texts.append((i, rng.choice([" ", "-", ". "]).join(words).upper().replace("É", "É")))
    bench = spark.createDataFrame(items, "item_id int, text string")
    df = spark.createDataFrame(texts, "doc_id int, text string")
    parsed = [(str(i), decontaminate.words_of(t)) for i, t in items]
    for blocks in (16 << 20, 60):
        decontaminate.BLOCK_BYTES = blocks
        got = {r.doc_id: r for r in decontaminate.contamination(df, bench).collect()}
        for i, t in texts:
            words = decontaminate.words_of(t)
            n, names = _hits(words, parsed)
            assert (got[i].n_words, got[i].n_hit, set(got[i]["items"])) == (len(words), n, names), i
            assert got[i].contaminated == (n > 0 and 20 * n >= len(words))
    decontaminate.BLOCK_BYTES = 16 << 20


def test_blocks_of_test_items_tell_rows_of_one_id_apart(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1)  # a block for each item
    df = spark.createDataFrame([(1, "one two three"), (1, "four five six"), (None, "one two three"), (1, "one two three")], "doc_id int, text string")
    bench = spark.createDataFrame([(1, "one two"), (2, "two three"), (3, "six"), (3, "six")], "item_id int, text string")
    got = sorted((str(r.doc_id), r.n_hit, r["items"]) for r in decontaminate.contamination(df, bench).collect())
    assert got == sorted([("1", 3, ["1", "2"]), ("1", 1, ["3"]), ("None", 3, ["1", "2"]), ("1", 3, ["1", "2"])])


def test_proximity(spark):
    item = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen")]
    near = "one two three four extra five six seven eight nine ten eleven twelve thirteen"
    far = "one two three four " + "x " * 9 + "five six seven eight nine ten eleven twelve thirteen"
    df = spark.createDataFrame([(1, near), (2, far)], "doc_id int, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(df, spark.createDataFrame(item, "item_id int, text string"), slop=2).collect()}
    assert got[1].near_items == ["1"] and got[2].near_items == [] and got[1].n_hit == 0


def test_proximity_against_brute_force(spark):
    rng = random.Random(12)
    vocabulary = ["aa", "bb", "cc", "dd", "ee", "ff", "gg"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 13, 16])))) for i in range(10)]
    texts = []
    for i in range(50):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        if i % 2:
            near = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 2)):
                near.insert(rng.randint(0, len(near)), "zz")
            words[len(words) // 2 : len(words) // 2] = near
        texts.append((i, " ".join(words)))
    lists = {i: t.split() for i, t in texts}
    counts = Counter(w for x in lists.values() for w in x)
    want = {i: set() for i in lists}
    for name, item in items:
        item = item.split()
        k = min(13, len(item))
        for w in range(len(item) - k + 1):
            window = item[w : w + k]
            o = min(range(k), key=lambda x: (counts[window[x]], x))
            for i, words in lists.items():
                if any(words[p] == window[o] and all(window[x] in words[max(0, p - o + x - 2) : max(0, p - o + x + 3)] for x in range(k)) for p in range(len(words))):
                    want[i].add(str(name))
    df, bench = spark.createDataFrame(texts, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")
    got = decontaminate.contamination(df.repartition(3), bench, slop=2).collect()
    assert {r.doc_id: set(r.near_items) for r in got} == want and any(want.values())


def test_postings_are_packed_and_unpacked():
    rng = np.random.default_rng(3)
    lists = [np.unique(rng.integers(0, 2**int(rng.integers(1, 31)), rng.integers(1, 200))) for _ in range(300)]
    values, cuts = np.concatenate(lists), np.append(0, np.cumsum(list(map(len, lists))))
    data = decontaminate.pack(np.diff(values, prepend=0), cuts[:-1], values)
    assert (decontaminate.unpack(data, cuts) == values).all()
    assert decontaminate.pack(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)) == b"" and len(decontaminate.unpack(b"", np.zeros(1, np.int64))) == 0


def test_warc_files_and_odd_ids(spark, tmp_path):
    """Files under their final names only, several of a task, read as streams and as binaryFile; ids that a URN can't hold as they are."""
    names = ["a:b", "null", "<x>", "%41", "é 1", None, ""]
    pages = spark.createDataFrame([(n, "u", f"<p>{n}</p>" * 60) for n in names], "page_id string, url string, html string")
    assert sorted(map(str, (r.page_id for r in warc.round_trip(pages).collect()))) == sorted(map(str, names))
    again = spark.createDataFrame([(f"{i:02}:x", "u", "x" * 5000 + str(i % 2)) for i in range(40)], "page_id string, url string, html string").coalesce(1)
    written = warc.write_files(again, f"file://{tmp_path}/w", archive_bytes=2000)
    paths = sorted(r.path for r in written.collect())
    assert paths == sorted(f"file://{x}" for x in tmp_path.glob("w/*")) and len(paths) > 3 and all(x.endswith(".warc.gz") for x in paths)
    whole = warc.read_archives(spark.read.format("binaryFile").load(f"{tmp_path}/w"), payloads=True).collect()
    stream = warc.read_archives(written, "path", payloads=True).collect()
    assert Counter(map(tuple, whole)) == Counter(map(tuple, stream)) and len(whole) == 40
    assert Counter(r.record_type for r in stream) == {"response": 2, "revisit": 38} and {r.refers_to for r in stream} == {None, "00:x", "01:x"}
    rows = warc.read_archives(warc.write_archives(again)).collect()
    assert {(r.page, r.record_type) for r in rows} == {(r.page, r.record_type) for r in stream}
    assert warc.round_trip(pages.filter("false")).count() == 0


def test_warc_round_trip_and_faults(spark):
    big = "<p>" + "é" * 200 + "</p>"
    pages = spark.createDataFrame([(3, "http://h/3", big), (1, "http://h/\r\n1", big), (2, None, "tiny"), (4, "u", "tiny"), (5, "u", None), (1, "http://h/1", big)], "page_id bigint, url string, html string")
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to, r.payload_digest == hashlib.sha256((big if r.page_id in (1, 3) else "tiny" if r.page_id in (2, 4) else "").encode()).hexdigest()) for r in warc.round_trip(pages).collect())
    assert got == [(1, 407, "response", None, True), (1, 407, "response", None, True), (2, 4, "response", None, True), (3, 407, "revisit", 1, True), (4, 4, "response", None, True), (5, 0, "response", None, True)]
    content = warc.page_record("7", "u", b"x" * 300_000, None, "2000-01-01T00:00:00Z") + warc.page_record("8", "u", b"yy", "7", "2000-01-01T00:00:00Z")
    assert [(r.kind, len(r.payload)) for r in warc.read_records(content)] == [("response", 300_000), ("revisit", 0)]
    with pytest.raises(ValueError):
        list(warc.read_records(content[:-10]))
    plain = next(warc.members([content])).replace(b"xxx", b"xyx", 1)
    with pytest.raises(ValueError, match="digest"):
        warc.parse(plain)


def test_license_rules(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    parts = mit.split("\n\n")
    rows = [(1, mit), (2, "\n\n".join(reversed(parts))), (3, "Text\nLicensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0."), (4, "no licence")]
    got = {r.doc_id: r.licenses for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got == {1: "MIT", 2: "", 3: "Apache-2.0,CC-BY-NC-4.0", 4: ""}


#: Headers as their licences word them, by rule.
HEADERS = {
    "apache_by_name": ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    "apache_header,apache_comply": ("Apache-2.0", "Copyright 2020 A. Person\n\nLicensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0"),
    "apache_comply,apache_as_is": ("Apache-2.0", "you may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language governing permissions and\nlimitations under the License."),
    "bsd_grant,bsd_source,bsd_binary": ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution."),
    "bsd_grant,bsd_source,bsd_binary,bsd_endorse": ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission."),
    "cc_by": ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc_by_nc": ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc_by_sa": ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "gpl3_by_name": ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    "gpl_free,gpl_hope": ("GPL-3.0", "Copyright (C) 2020  A. Person\n\nThis program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details."),
    "isc_grant": ("ISC", "Copyright (c) 2020 A. Person\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."),
    "mit_by_name": ("MIT", "This project is licensed under the MIT License."),
    "mit_grant,mit_notice,mit_as_is": ("MIT", "MIT License\n\nCopyright (c) 2020 A. Person\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE\nAUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."),
    "mpl_subject,mpl_obtain": ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "agpl_free,gpl_hope": ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as\npublished by the Free Software Foundation, either version 3 of the\nLicense, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU Affero General Public License for more details."),
    "gpl_terms,version_2,gpl_hope": ("GPL-2.0", "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details."),
    "gpl_terms,version_3,gpl_hope": ("GPL-3.0", "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 3 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "lgpl_terms,version_2_1,gpl_hope": ("LGPL-2.1", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n\nThis library is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU\nLesser General Public License for more details."),
    "lgpl_terms,version_3,gpl_hope": ("LGPL-3.0", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 3 of the License, or (at your option) any later version.\n\nThis library is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "lgpl3_free,gpl_hope": ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Lesser General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "gpl2_by_name": ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    "cc0": ("CC0-1.0", "This work is licensed under CC0 1.0 Universal."),
    "zlib_as_is,zlib_grant": ("Zlib", "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\narising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin must not be misrepresented."),
    "boost": ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt)"),
    "epl2_available": ("EPL-2.0", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/"),
    "unlicense": ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\ndistribute this software."),
}


HEADERS |= {
    "mit_title": ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2021 Someone"), "gpl3_title": ("GPL-3.0", "GNU General Public License version 3"), "gpl_name,dated_version_3": ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
    "gpl2_title": ("GPL-2.0", "GNU General Public License, version 2"), "gpl_name,dated_version_2": ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991"), "lgpl3_title": ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "lgpl_name,dated_version_3": ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"), "agpl3_title": ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"), "agpl_name,dated_version_3_network": ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007"),
    "apache_title": ("Apache-2.0", "Apache License Version 2.0, January 2004"), "apache_name,dated_version_2_0": ("Apache-2.0", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/"),
}
HEADERS |= {"spdx_" + n.lower().replace("-", "_").replace(".", "_"): (n, f"SPDX-License-Identifier: {n}{'-or-later' if 'GPL' in n else ''}\n\nint main;") for n in license_scan.SPDX}


def test_licence_sql_knows_comments_banners_and_edges(spark):
    rows = [t for _, text in HEADERS.values() for t in (text, "/*\n" + "\n".join(f" * {x}".rstrip() for x in text.split("\n")) + "\n */", "\n".join(f"# {x}".rstrip() for x in text.split("\n")))]
    rows += ["=" * 900 + " Licensed under the MIT License.", "=" * 60 + "\nLicensed under the MIT License.", None, "", "#\n#", "\n#\n", "licence. ", "// spdx-license-identifier:MIT"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    got = [tuple(r) for r in license_scan.scan_licenses(df).orderBy("doc_id").collect()]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array(range(len(rows)), pa.int32()), "text": pa.array(rows, pa.string())}))
    assert got == con.sql(f"SELECT * FROM ({license_scan.oracle_sql()}) ORDER BY doc_id").fetchall()
    assert [x[3] for x in got[-8:]] == ["MIT", "MIT", "", "", "", "", "", "MIT"]


def test_every_licence_rule_on_its_own_words(spark):
    assert set(HEADERS) == {",".join(ids) for _, ids in license_scan.RULES}
    rows = []
    for rule, (_, text) in HEADERS.items():
        block = "/*\n" + "\n".join(f" * {x}".rstrip() for x in text.split("\n")) + "\n */\nint main() { return 0; }"
        rows += [(rule, text), (rule, block), (rule, block.replace("\n", "\r\n")), (rule, "\n".join(f"# {x}".rstrip() for x in text.split("\n"))), (rule, text.replace("free software:", "free software;"))]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert [(r.doc_id, r.licenses) for r in got if r.licenses != HEADERS[r.doc_id][0]] == [] and len(got) == len(rows)
    assert license_scan.scan_licenses(spark.createDataFrame([(1, HEADERS["gpl_free,gpl_hope"][1].replace("General", "Other General"))], "doc_id int, text string")).first().licenses == ""


def _brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(docs, edge):
    for df in (docs, edge):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        prints = {t: _brute_fingerprint(t) for t in {t for _, t in rows}}
        values = sorted({v for v in prints.values()})
        label = {v: v for v in values}
        changed = True
        while changed:
            changed = False
            for i, a in enumerate(values):
                for b in values[:i]:
                    if (a ^ b).bit_count() <= 2 and label[a] != label[b]:
                        label[a] = label[b] = min(label[a], label[b])
                        changed = True
        least = {}
        for d, t in rows:
            if d is not None:
                least[label[prints[t]]] = min(d, least.get(label[prints[t]], d))
        want = Counter((d, f"{prints[t]:016x}", least.get(label[prints[t]])) for d, t in rows)
        for largest in (30_000, 3):
            got = simhash.near_duplicates(df, largest=largest).collect()
            assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_vantage_tree_loses_no_link():
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 2**63, 40, dtype=np.uint64)
    x = np.unique(np.concatenate([centre[i % 40, None] ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, 3).astype(np.uint64), keepdims=True) for i in range(3000)]))
    links = simhash.Links(len(x))
    simhash.tree_links(x, np.arange(len(x)), 2, links)
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None]) <= 2)
    assert (links.labels() == simhash.components(len(x), a, b)).all()


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    got = simhash.connected(edges).collect()
    assert len(got) == 399 and all(r.root == 0 for r in got)


PROBES = [
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n * Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n * Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n * Neither the name of Google Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "BSD-3-Clause"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n1. Redistributions of source code must retain the above copyright\n   notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright\n   notice, this list of conditions and the following disclaimer in the\n   documentation and/or other materials provided with the distribution.\n3. Neither the name of the University nor the names of its contributors\n   may be used to endorse or promote products derived from this software\n   without specific prior written permission.", "BSD-3-Clause"),
    ("MIT License\n\nCopyright (c) 2020 Someone", "MIT"), ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n", "GPL-3.0"), ("Licensed under Apache-2.0", "Apache-2.0"), ("// SPDX-License-Identifier: MIT OR Apache-2.0\n", "Apache-2.0,MIT"),
    ("/* SPDX-License-Identifier: (GPL-2.0 OR MIT) */", "GPL-2.0,MIT"), ("This is licensed under the MIT license, see LICENSE", "MIT"), ("It was released under the MIT License (see LICENSE)", "MIT"), ("Code is available under the terms of the MIT licence.", "MIT"),
    ("# SPDX-License-Identifier: LGPL-2.1-or-later\n", "LGPL-2.1"), ("We left under the cover of night.", ""),
]


def test_licences_as_files_word_them(spark):
    """Owners in slots, names among other words, titles, SPDX expressions: by the query and by its SQL."""
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PROBES)], "doc_id bigint, text string")
    want = {i: w for i, (_, w) in enumerate(PROBES)}
    assert {r.doc_id: r.licenses for r in license_scan.scan_licenses(docs).collect()} == want
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, (t, _) in enumerate(PROBES)])
    assert dict(con.execute(f"SELECT doc_id, licenses FROM ({license_scan.oracle_sql()})").fetchall()) == want


def test_warc_of_other_writers():
    """Base32 digests, ids and lengths as crawlers write them; a wrong digest still raises."""
    import base64

    def member(headers, block):
        head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + f"Content-Length: {len(block)}\r\n\r\n"
        return warc._gz(head.encode() + block + b"\r\n\r\n")

    payload = b"<html>x</html>"
    sha1 = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    kind = {"WARC-Record-ID": "<urn:uuid:1>", "Content-Type": "application/http; msgtype=response"}
    good = member({"WARC-Type": "response", **kind, "WARC-Payload-Digest": sha1, "WARC-Block-Digest": "blake9:x"}, http + payload)
    again = member({"WARC-Type": "revisit", **kind, "WARC-Refers-To": "<urn:uuid:0>", "WARC-Payload-Digest": sha1}, http)
    first, second = warc.read_records(good + again)
    assert first.payload == payload and warc.payload_digest(first) == hashlib.sha256(payload).hexdigest() and warc.payload_digest(second) == sha1
    assert warc.page_of(first.headers["warc-record-id"]) == "urn:uuid:1" and warc.page_of(second.headers["warc-refers-to"]) == "urn:uuid:0"
    with pytest.raises(ValueError, match="digest differs"):
        list(warc.read_records(member({"WARC-Type": "response", **kind, "WARC-Payload-Digest": sha1}, http + payload + b"!")))


def test_warc_rows_of_other_writers(spark):
    head = b"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Type: application/http\r\nContent-Length: 19\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\r\n\r\n"
    (row,) = warc.read_archives(spark.createDataFrame([(bytearray(warc._gz(head)),)], "content binary"), "content").collect()
    assert (row.page, row.payload_bytes, row.payload_digest, row.record_type, row.refers_to) == ("urn:uuid:2", None, None, "revisit", None)
