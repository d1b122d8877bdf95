"""The pipeline against its stages in plain Python, and queries against their SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from jobloom import runtime
from jobloom.llm import byte_bpe, decontaminate, near_copies, quality, queries, simhash

SF = "/root/testdata/sf0.001"


def _similarity(a, b):
    return len(a & b) / max(1, len(a | b))


def _components(texts):
    """Least place of each text's component, linked by 2 bits of fingerprints or 0.8 of 5-word shingles."""
    words = [t.lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    prints = [simhash.fingerprint(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and ((prints[i] ^ prints[j]).bit_count() <= 2 or _similarity(sets[i], sets[j]) >= 0.8):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_pipeline_by_hand(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bench = [(str(r.item_id), decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = model.score(quality.features([d["text"] or "" for d in docs], model.compressors()))
    docs = [d for d, s in zip(docs, scores) if s >= 0.5]

    line = lambda x: " ".join(p for p in x.replace("\t", " ").replace("\r", " ").split(" ") if p)
    pages = {(d["source"], d["text"]) for d in docs}
    total, seen = {}, {}
    for s, t in pages:
        total[s] = total.get(s, 0) + 1
        for x in {line(x) for x in t.split("\n")} - {""}:
            seen[s, x] = seen.get((s, x), 0) + 1
    drops = {k for k, n in seen.items() if n >= 2 and n > 0.02 * total[k[0]]}
    for d in docs:
        d["text"] = "\n".join(x for x in d["text"].split("\n") if (d["source"], line(x)) not in drops)

    group = _components([d["text"] for d in docs])
    first = {}
    for d, g in zip(docs, group):
        first[g] = min(d["doc_id"], first.get(g, d["doc_id"]))
    docs = [d for d, g in zip(docs, group) if d["doc_id"] == first[g]]

    clean = []
    for d in docs:
        words, hit = decontaminate.words_of(d["text"]), set()
        for _, item in bench:
            k = min(13, len(item))
            grams = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)}
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in grams:
                    hit.update(range(i, i + k))
        if not (hit and 20 * len(hit) >= len(words)):
            clean.append(d)
    bpe = byte_bpe.codec(byte_bpe.public_tokenizers.path("byte_bpe_50k.json"))
    want = {d["doc_id"]: byte_bpe.digest(bpe.encode([d["text"]])[0]) for d in clean}
    before = set(runtime._written)
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()} == want
    assert len(runtime._written - before) == 1  # the result; tables of the stages are gone


@pytest.mark.parametrize("limits", [{}, {"GROUP": 2, "PIVOTS": 2, "ROUNDS": 1}, {"GROUP": 3, "BUCKET": 3, "BROADCAST_KEYS": 0}])
def test_no_two_texts_stay_that_share_their_shingles(spark, monkeypatch, limits):
    """Groups in one task, and dealt to shards, and buckets too large to compare."""
    for name, value in limits.items():
        monkeypatch.setattr(near_copies, name, value)
    rng = random.Random(3)
    rows = []
    for group in range(12):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([60, 200, 900]))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(3):  # a few words changed, or much of the text
            changed = list(words)
            for _ in range(rng.choice([1, len(words) // 60, len(words) // 12])):
                changed[rng.randrange(len(words))] = "other"
            rows.append((len(rows), " ".join(changed)))
    label = _components([t for _, t in rows])
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    got = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()}
    assert got == set(label) and len(rows) // 4 < len(got) < len(rows)


def test_one_row_of_each_group_of_copies_stays(spark):
    one, two = "one two three four " * 20, "five six seven eight nine " * 20
    rows = [(1, one, "x"), (1, one, "y"), (None, one, "x"), (2, two, "x"), (1, "a text of its own", "x"), (1, two, "x"), (None, "no id here", "x"), (None, "no id here", "x"), (None, "nor in this one at all", "x")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string").repartition(3)
    got = sorted((str(r.doc_id), r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect())
    assert got == sorted([("1", one), ("1", two), ("1", "a text of its own"), ("None", "no id here"), ("None", "nor in this one at all")])


def test_decontamination_judges_rows_and_not_ids(spark):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id int, text string")
    rows = [(None, "One two three four!"), (None, "clean"), (1, "one two three four"), (1, "clean too"), (2, None), (None, None)]
    out = decontaminate.drop_contaminated(spark.createDataFrame(rows, "doc_id int, text string"), bench)
    assert out.columns == ["doc_id", "text"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [(None, "clean"), (1, "clean too"), (2, None), (None, None)]))


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_stages_keep_nulls_and_clashing_columns(spark):
    rows = [(1, None, "en", None, None), (2, "", None, "s", 0), (3, "one two three four " * 50, "en", "s", 1), (3, "one two three four " * 50, "en", "s", 1), (None, "x y z", "en", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumns({c: F.lit(1) for c in ("fp", "host", "n_lines", "score", "kept")})
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in out.collect()} >= {1, 3}, name


def test_first_and_last_stage_on_nulls_clashes_and_repeated_rows(spark):
    """Whole rows, against the functions that the stages are made of."""
    junk = "zzzz$$$$ 0000 " * 40
    rows = [(1, None, "en", None, None), (2, "", None, "s", 0), (3, "one two three four " * 50, "en", "s", 1), (3, "one two three four " * 50, "en", "s", 1), (None, junk, "en", "s", 3), (None, "x y z", None, None, 3), (4, "word " * 30_000, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumns({c: F.lit(1) for c in ("score", "ids", "predicted", "id", "y")}).repartition(2)
    real = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(real, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = dict(zip([r[1] for r in rows], model.score(quality.features([r[1] or "" for r in rows], model.compressors()))))
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if scores[r.text] >= 0.5)
    bpe = byte_bpe.codec(byte_bpe.public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(str((r[0], ids := bpe.encode([r[1] or ""])[0], len(ids) // 4, byte_bpe.digest(ids), byte_bpe.digest((r[1] or "").encode()))) for r in rows)
    got = corpus_pipeline.encoding_stage(spark, docs, SF).collect()
    assert sorted(str((r.doc_id, bytes(r.ids), r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in got) == want


def test_line_stage_keeps_whole_rows(spark):
    rows = [(1, "menu\nbody", "s", 9), (1, "menu\nbody", "s", 9), (None, "menu\nother", "s", 9), (2, None, "s", None), (3, "menu", "s", 4), (4, "menu\nalone", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint").withColumn("host", F.lit("x"))
    want = [(1, "body", "s", 4, "x"), (1, "body", "s", 4, "x"), (None, "other", "s", 5, "x"), (2, None, "s", None, "x"), (3, "", "s", 0, "x"), (4, "menu\nalone", None, 10, "x")]
    assert sorted(map(str, (tuple(r) for r in corpus_pipeline.line_stage(spark, docs, SF).collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    found = queries.queries()[name](spark, SF)
    columns = sorted(found.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in found.collect()))) == sorted(map(str, con.sql(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall()))
