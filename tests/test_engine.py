"""Functions by tables of cases, dedup and upsert against the sequential rule, streams against batches, queries against SQL."""

import glob
import json
import os
import random
from collections import Counter
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from jobloom import catalog, runtime
from jobloom.functions import anchors, postings, text, urls
from jobloom.operators import dedup, dml, maintain, schedule
from jobloom.plans import flows
from jobloom.schemas import POSTING, create_tables, repeated_keys
from jobloom.sources import boards, queue
from jobloom.streaming import messages

SF = "/root/testdata/sf0.001"


def values(spark, f, *cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    return [r.v for r in df.select("i", f(F.col("c")).alias("v")).orderBy("i").collect()]


def test_html(spark):
    got = values(spark, text.html_to_text, None, "&lt;p&gt;Hi &amp;amp; you&lt;/p&gt;&lt;SCRIPT&gt;x\ny&lt;/SCRIPT&gt;end", "a<br>b<br />c<br >d</P>e</h5>f", "a\n \n\n\n\tb  \t c", "  <i></i> ")
    assert got == ["", "Hi &amp; you\n\nend", "a\nb\ncdef", "a\n\n b c", ""]


def test_pages_cut_within_an_entity(spark, tmp_path):
    """The query leaves what has no semicolon, as its SQL does; the content of postings is decoded as HTML has it."""
    cases = ["<h1>a &amp; b&amp</h1>&copy;&middot;&quot;&copy", "&ampx; &nosuch; &#65; &#65 &amp;quot;", "&amp", None]
    spark.createDataFrame(list(enumerate(cases)), "page_id bigint, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = [r.text for r in catalog.queries()["html_to_text"](spark, str(tmp_path)).orderBy("page_id").collect()]
    assert got == ['a & b&amp\n\n©·"&copy', "&ampx; &nosuch; A &#65 &quot;", "&amp", ""]
    assert values(spark, text.html_to_text, cases[0], cases[2]) == ['a & b&\n\n©·"©', "&"]


def test_dates_and_titles(spark):
    dates = values(spark, text.iso_date, "2024-01-31T23:30:00-05:00", "2024-01-31", "junk", "2024-13-01", None, "2024-01-05junk")
    assert [str(d) if d else None for d in dates] == ["2024-01-31", "2024-01-31", None, None, None, None]
    assert values(spark, text.title_case, "3m-o'reilly", None) == ["3M-O'Reilly", None]
    assert values(spark, text.is_blank, None, "", " \n ", "x") == [True, True, True, False]


def test_board_links(spark):
    cases = [" https://boards-api.greenhouse.io/v1/boards/Ab/jobs/007/ ", "HTTP://BOARDS.greenhouse.io/x/jobs/1", "https://boards.greenhouse.io/x/jobs/1?a=2", "https://job-boards.greenhouse.io/y/jobs/" + "9" * 30, None, "https://boards.greenhouse.io/x/jobs/000"]
    assert values(spark, urls.board_token, *cases) == ["Ab", "x", None, "y", None, "x"]
    assert values(spark, urls.board_job_id, *cases) == ["7", "1", None, "9" * 30, None, "0"]
    assert values(spark, lambda c: urls.rewritten(c, "https://boards.greenhouse.io/"), *cases)[:2] == ["https://boards.greenhouse.io/Ab/jobs/7", "https://boards.greenhouse.io/x/jobs/1"]


def test_tracking(spark):
    got = values(spark, urls.strip_tracking, 'https://h/p?utm_x=1&b=&referrer=2&c=a+b%2A~#f">', "https://h/p?sourceId=3", None, " https://h/ \n>", "https://h/p?a=1&a=2&blank=")
    assert got == ['https://h/p?b=&c=a+b%2A~#f"', "https://h/p", None, "https://h/", "https://h/p?a=1&a=2&blank="]
    assert values(spark, urls.canonical_http_url, " HTTP://EXAMPLE.com:80", "https://h/a b", "ftp://x", "https://bücher.de/ü", None, "https://h:8443/x?q=1#z") == ["http://example.com/", "https://h/a%20b", None, "https://xn--bcher-kva.de/%C3%BC", None, "https://h:8443/x?q=1#z"]


def test_job_links(spark):
    df = spark.createDataFrame([("https://x/y", "Unsubscribe job"), ("HTTP://lever.co/1", "t"), ("https://jobs.lever.co/1", "t"), ("https://x/careers", "t"), ("https://x/y", "t")], "u string, t string")
    assert [r.v for r in df.select(urls.is_job_link(F.col("u"), F.col("t")).alias("v")).collect()] == [False, False, True, True, False]


def test_cards_and_anchors(spark):
    df = spark.createDataFrame([("1) Dev (Remote - US), Acme - $1k - $2k", "Dev"), ("Dev", "Dev"), ("x 12) Dev Acme", "Dev"), ("3) A.B (X) Y", "A.B")], "p string, t string")
    got = [tuple(r.v) for r in df.select(postings.card_line(F.col("p"), F.col("t")).alias("v")).collect()]
    assert got == [(1, "Remote - US", "Acme", "$1k - $2k"), (None, None, None, None), (12, None, "x 12) Acme", None), (3, "X", "Y", None)]
    found = anchors.anchors("<div><p>1) <a href='/a'>Jo<b>b</b></a> (X), C</p><p>Sum</p><br>tail</div><a name=x>no</a><a href>empty</a>")
    assert found == [(0, "/a", "Jo b", "1) Jo b (X), C", "1) Jo b (X), C Sum tail"), (1, "", "empty", found[1][3], found[1][4])]
    assert anchors.anchors(None) == []


def api(spark, *bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string").select("i", F.parse_json("b").alias("row"), F.lit("C").alias("company_name"), F.lit("c").alias("company_endpoint"))
    return postings.from_api(df, "https://r/", "s", F.lit(None).cast("timestamp_ntz"), keep=("i",)).orderBy("i").collect()


def test_api_rows(spark):
    got = api(spark, '{"id": "007", "location": {}, "metadata": null}', '{"title": "t"}', '{"id": 1, "location": "x"}', '{"id": 1, "location": null, "metadata": [1]}', '{"id": 1, "metadata": [{"name": null, "value": "x"}]}', '{"id": 1, "metadata": [{"name": "Type", "value": true}, {"value": "n"}, {"name": "Workplace Type", "value": "remote hybrid"}, {"name": "employment", "value": "hybrid"}], "location": {"name": "Anywhere"}}')
    assert [r.row_error for r in got] == [False, True, True, True, True, False]
    assert got[0].url == "https://r/c/jobs/7" and got[0].location is None
    assert (got[5].employment_type, got[5].remote_allowed, got[5].hybrid_allowed) == ("remote hybrid", True, False)


def batch_of(spark, rows, seq=True):
    schema = "url string, job_description string, last_updated timestamp_ntz, scraped_at timestamp_ntz, content_hash string" + ", seq bigint" * seq
    return spark.createDataFrame([(u, d, None, None, h, *([i] if seq else [])) for i, (u, d, h) in enumerate(rows)], schema)


def fold(store, batch):
    """The sequential rule, row by row: rows of the store afterwards, and (seq, outcome) of each batch row."""
    by_url, outcomes = {r["url"]: dict(r) for r in store}, []
    for row in batch:
        old = by_url.get(row["url"])
        if old is not None and (old["job_description"] or "").strip():
            outcomes.append((row["seq"], "duplicate"))
        elif old is not None:
            old.update({c: row[c] for c in ("job_description", "last_updated", "scraped_at", "content_hash")})
            outcomes.append((row["seq"], "updated"))
        elif any(r["content_hash"] == row["content_hash"] for r in by_url.values()):
            outcomes.append((row["seq"], "duplicate"))
        else:
            by_url[row["url"]] = {k: v for k, v in row.items() if k != "seq"}
            outcomes.append((row["seq"], "inserted"))
    return list(by_url.values()), outcomes


def test_a_chain_settles(spark):
    """Every row shares a key with the next, so that rounds alone would settle two rows each."""
    rows = batch_of(spark, [(f"u{(i + 1) // 2}", "d", f"h{i // 2}") for i in range(1000)])
    assert sorted(r.seq for r in dedup.two_key_first(rows, rounds=3).collect()) == list(range(0, 1000, 2))


def test_dropped_rows_leave_no_keys(spark):
    rows = batch_of(spark, [("u1", "d", "h1"), ("u2", "d", "h1"), ("u2", "d", "h2")])
    assert sorted(r.seq for r in dedup.two_key_first(rows).collect()) == [0, 2]


@pytest.mark.parametrize("seed", range(2))
def test_upsert_equals_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    kinds = [None, "", " \n ", "text", "text", "text"]
    store = {f"u{i}": (f"u{i}", rng.choice(kinds), f"h{rng.randint(0, 60)}") for i in rng.sample(range(40), 12)}
    batch = [(f"u{rng.randint(0, 39)}", rng.choice(kinds), f"h{rng.randint(0, 60)}") for _ in range(70)]
    names = ("url", "job_description", "content_hash")
    record = lambda r, **more: dict(zip(names, r)) | {"last_updated": None, "scraped_at": None} | more
    want, outcomes = fold([record(r) for r in store.values()], [record(r, seq=i) for i, r in enumerate(batch)])
    after, got = dedup.upsert(batch_of(spark, list(store.values()), seq=False), batch_of(spark, batch))
    assert sorted((r.url, r.job_description or "", r.content_hash) for r in after.collect()) == sorted((r["url"], r["job_description"] or "", r["content_hash"]) for r in want)
    assert sorted((r.seq, r.outcome) for r in got.collect()) == sorted(outcomes)
    rows = batch_of(spark, batch)
    seqs, hashes = set(), set()
    for i, (u, _, h) in enumerate(batch):
        if u not in seqs and h not in hashes:
            seqs.add(u), hashes.add(h)
    assert {(r.url, r.content_hash) for r in dedup.two_key_first(rows, rounds=1).collect()} == {(r.url, r.content_hash) for r in dedup.two_key_first(rows).collect()}
    assert {r.url for r in dedup.two_key_first(rows, rounds=0).collect()} == seqs


def test_upsert_of_stored_blanks_and_held_hashes(spark):
    store = batch_of(spark, [("a", "text", "h1"), ("b", None, "h2")], seq=False)
    batch = batch_of(spark, [("a", None, "h9"), ("b", None, "h3"), ("b", "text", "h4"), ("b", "more", "h5"), ("c", None, "h1"), ("c", None, "h6"), ("c", None, "h1"), ("d", None, "h1")])
    outcomes = {r.seq: r.outcome for r in dedup.upsert(store, batch)[1].collect()}
    assert outcomes == {0: "duplicate", 1: "updated", 2: "updated", 3: "duplicate", 4: "duplicate", 5: "inserted", 6: "updated", 7: "duplicate"}


@pytest.mark.parametrize(("rounds", "few"), [(0, 0), (3, 0), (3, 9999)])
def test_upsert_of_linked_groups_with_blanks(spark, rounds, few):
    """Links and hashes in dense groups, a third of all rows with one hash, and a chain in which each row waits for the one before."""
    rng = random.Random(rounds)
    kinds, names = [None, "", "text"], ("url", "job_description", "content_hash")
    batch = [(f"u{rng.randint(0, 150)}", rng.choice(kinds), "h0" if rng.random() < 0.33 else f"h{rng.randint(0, 40)}") for _ in range(250)]
    batch += [(f"c{(i + 1) // 2}", rng.choice(kinds), f"g{i // 2}") for i in range(24)]
    store = [("u1", None, "h0"), ("u2", " ", "h3"), ("u3", "text", "h5"), ("z", "", "h0")]
    record = lambda r, **more: dict(zip(names, r)) | {"last_updated": None, "scraped_at": None} | more
    want, outcomes = fold([record(r) for r in store], [record(r, seq=i) for i, r in enumerate(batch)])
    after, got = dedup.upsert(batch_of(spark, store, seq=False), batch_of(spark, batch), rounds=rounds, few=few)
    assert sorted((r.seq, r.outcome) for r in got.collect()) == sorted(outcomes)
    assert sorted((r.url, r.job_description or "", r.content_hash) for r in after.collect()) == sorted((r["url"], r["job_description"] or "", r["content_hash"]) for r in want)


def test_no_task_reads_a_hot_group_whole(spark):
    """All rows share a hash, each of their links is blank at first: many tasks see the group, by the plan's partitions."""
    rows = spark.range(20_000).select(F.concat(F.lit("u"), (F.col("id") % 9000).cast("string")).alias("url"), F.when(F.col("id") >= 9000, "d").alias("job_description"), F.lit("h").alias("content_hash"), F.col("id").alias("seq"))
    rows = rows.withColumns({c: F.lit(None).cast("timestamp_ntz") for c in ("last_updated", "scraped_at")})
    store = rows.limit(0).drop("seq")
    after, outcomes = dedup.upsert(store, rows, few=0)
    assert {(r.outcome, r["count"]) for r in outcomes.groupBy("outcome").count().collect()} == {("inserted", 1), ("updated", 1), ("duplicate", 19_998)}
    assert [tuple(r) for r in after.select("url", "job_description").collect()] == [("u0", "d")]


def test_admission_equals_the_recurrence(spark):
    rng = random.Random(4)
    rows = [(k, rng.randint(0, 400), i) for i, k in enumerate(rng.choices([None, "x", "y"], [1, 2, 8], k=300))]
    free, want = {}, {}
    for k, a, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        want[i] = max(a, free.get(k, a))
        free[k] = want[i] + 1.5
    df = spark.createDataFrame(rows, "k string, a bigint, i bigint")
    for seconds in (1, 50, 3600):
        got = {r.i: r.admitted for r in schedule.admission(df, 40, "k", "a", "i", seconds).collect()}
        assert got == pytest.approx(want)


def test_changes_of_tables(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, y int")
    c = spark.createDataFrame([(2, "B", 9), (3, "C", 9)], "k int, x string, y int")
    assert sorted(map(tuple, dml.overwrite_upsert(t, c, ["k"], ["x"]).collect())) == [(1, "a", 1), (2, "B", 2), (3, "C", 9)]
    assert [tuple(r) for r in dml.insert_absent(t, c.union(c), ["k"], ["x", "y"]).collect()] == [(3, "C", 9)]


def test_rewrite_conflicts(spark):
    api_url, board = "https://boards-api.greenhouse.io/v1/boards/x/jobs/", "https://boards.greenhouse.io/x/jobs/"
    rows = spark.createDataFrame([("1", api_url + "01", api_url + "01"), ("2", api_url + "1/", None), ("3", api_url + "5", "https://own"), ("4", board + "5", None), ("5", "https://other", api_url + "7"), ("6", api_url + "x", None)], "id string, url string, application_url string")
    dry = {r.id: r for r in maintain.rewrite_plan(rows, "https://boards.greenhouse.io/").collect()}
    assert {i: r.status for i, r in dry.items()} == {"1": "updated", "2": "updated", "3": "skipped_conflict", "5": "updated", "6": "unchanged"}
    assert dry["1"].new_application_url == board + "1" and dry["5"].new_application_url == board + "7"
    run = maintain.rewrite_plan(rows, "https://boards.greenhouse.io/", execute=True)
    assert {r.id: r.status for r in run.collect()}["2"] == "skipped_conflict"
    assert {r.id: r.url for r in maintain.apply_plan(rows, run).collect()}["1"] == board + "1"
    assert maintain.counts(run).first().asDict() == {"updated": 2, "unchanged": 1, "skipped_conflict": 2}


def test_due(spark):
    rows = [(1, None, 6), (2, "2024-01-01 00:00:00", 6), (3, "2024-01-01 00:00:01", 6), (4, "junk", 6), (5, "2024-01-01T00:00:00", None)]
    df = spark.createDataFrame(rows, "i int, last_run_at string, schedule_hours int").withColumn("enabled", F.when(F.col("i") > 0, True))
    assert sorted(r.i for r in schedule.due_sources(df, F.lit("2024-01-01 06:00:00").cast("timestamp_ntz")).collect()) == [1, 2, 4, 5]


MESSAGES = [
    (b"\xff", "not UTF-8"), (b"{", "not JSON"), (b"[1]", "not an object"), (b"{}", "no payload"), (b'{"payload": {"url": "ftp://x"}}', "no url"), (b'{"payload": {"url": "https://h/1", "rank": "3"}}', None),
    (b'{"payload": {"url": "https://h/2", "rank": 3.0}}', None), (b'{"payload": {"url": "https://h/3", "rank": true}}', None), (b'{"payload": {"url": "https://h/4", "rank": 3.5}}', "rank"), (b'{"payload": {"url": "https://h/5", "rank": "x"}}', "rank"),
    (b'{"payload": {"url": "https://h/6", "source": null}}', "source"), (b'{"payload": {"url": "https://h/7", "title": 1}}', "text field"), (b'{"payload": {"url": "https://h/8", "other": [1]}, "event_id": null}', None),
]


def test_messages_are_validated_and_saved(spark):
    batch = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(MESSAGES)], "seq bigint, body binary")
    assert [r.reason for r in messages.validated(batch).orderBy("seq").collect()] == [w for _, w in MESSAGES]
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    store = spark.createDataFrame([], POSTING)
    after, found = flows.consume(batch, store, None, now)
    assert {r.seq: r.disposition for r in found.collect()} == {i: messages.REJECT if w else messages.ACK for i, (_, w) in enumerate(MESSAGES)}
    rows = {r.url: r for r in after.collect()}
    assert set(rows) == {"https://h/1"}  # all have the same empty fields, and so one hash
    assert rows["https://h/1"].source_website == "email_raw_manual"


def test_newsletter_to_messages(spark):
    raw = b"Subject: S\nFrom: a@b\nContent-Type: text/html; charset=utf-8\n\n<p>1) <a href='https://jobs.lever.co/1?utm_a=1'>Dev</a> (X), C - $5</p><a href='https://x/unsubscribe'>unsubscribe</a>"
    plain = b"Subject: T\nContent-Type: text/plain\n\nno html"
    mails = boards.mails(spark.createDataFrame([("m", raw), ("n", plain)], "path string, content binary"))
    assert {r.path: (r.subject, r.html is None) for r in mails.collect()} == {"m": ("S", False), "n": ("T", True)}
    sent = [json.loads(r.body) for r in flows.newsletter(mails, F.lit("2024-01-01")).collect()]
    assert len(sent) == 1 and sent[0]["payload"]["url"] == "https://jobs.lever.co/1" and sent[0]["payload"]["rank"] == 1 and sent[0]["payload"]["salary"] == "$5" and sent[0]["payload"]["email_subject"] == "S"


def test_crawl_of_local_boards(spark, tmp_path):
    for board, jobs in (("acme", [{"id": 1, "title": "A", "location": {"name": "Remote"}, "updated_at": "2024-01-01"}, {"title": "no id"}, {"id": 2, "title": "B"}]), ("other", [{"id": 3, "title": "A"}])):
        folder = tmp_path / "boards" / board / "jobs"
        folder.mkdir(parents=True)
        (tmp_path / "boards" / board / "jobs.json").write_text(json.dumps({"jobs": jobs}))
        (folder / "1.json").write_text(json.dumps({"content": "&lt;p&gt;Text&lt;/p&gt;"}))
    make = boards.create(spark, {"type": "api", "name": "greenhouse", "rate_limit_per_minute": 0, "config": {"base_url": f"file://{tmp_path}", "suffix": ".json", "details": "true"}})
    assert boards.create(spark, {"type": "scraper", "name": "x"}) is None
    companies = spark.createDataFrame([("acme", "Acme"), ("other", "Other"), ("gone", "Gone")], "company_endpoint string, company_name string")
    after, outcomes, errors = flows.crawl(make.rows(["acme", "other", "gone"]), companies, spark.createDataFrame([], POSTING), "https://boards.greenhouse.io", "greenhouse", F.lit(None).cast("timestamp_ntz"))
    assert {(r.url, r.job_description, r.company) for r in after.collect()} == {("https://boards.greenhouse.io/acme/jobs/1", "Text", "Acme"), ("https://boards.greenhouse.io/acme/jobs/2", None, "Acme"), ("https://boards.greenhouse.io/other/jobs/3", None, "Other")}
    assert {(r.company_endpoint, r.error) for r in errors.collect()} == {("gone", "list request failed"), ("acme", "row error")}
    assert outcomes.count() == 3

    sources = spark.createDataFrame([("7", "greenhouse", None, None), ("8", "other", None, None)], "id string, name string, last_run_at timestamp_ntz, updated_at timestamp_ntz")
    every = spark.createDataFrame([("1", "7", "Acme", "acme", True), ("2", "7", "Gone", "gone", True), ("3", "7", "Off", "other", None), ("4", "8", "Else", "else", True)], "id string, source_id string, company_name string, company_endpoint string, enabled boolean").withColumns({c: F.lit(None).cast("timestamp_ntz") for c in ("last_fetched_at", "updated_at")})
    now = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    after, companies, sources, stats = flows.run_source(make.rows(["acme", "gone"]), every, sources, spark.createDataFrame([], POSTING), "https://boards.greenhouse.io", "greenhouse", now)
    assert after.count() == 2 and {r.id for r in companies.collect() if r.last_fetched_at} == {"1", "2"} and {r.id for r in sources.collect() if r.last_run_at} == {"7"}
    got = stats.first()
    assert (got.companies, got.fetched, got.with_description, got.saved, got.duplicates, got.failed) == (2, 2, 1, 2, 0, 0)

    links = spark.createDataFrame([("https://boards.greenhouse.io/acme/jobs/01",), ("https://boards.greenhouse.io/acme/jobs/9",), ("https://else/1",)], "url string")
    found = make.lookup(links)
    assert {(r.board, r.job_id, r.detail is None) for r in found.collect()} == {("acme", "1", False), ("acme", "9", True)}
    (tmp_path / "boards" / "acme" / "jobs" / "1.json").write_text(json.dumps({"id": 1, "title": "A", "company": {"name": "Acme Inc"}, "content": "&lt;p&gt;Text&lt;/p&gt;"}))
    assert [(r.url, r.company, r.job_description) for r in flows.lookup(make.lookup(links), "https://boards.greenhouse.io", "greenhouse", now).collect()] == [("https://boards.greenhouse.io/acme/jobs/1", "Acme Inc", "Text")]


def test_a_run_asks_once_and_counts_as_it_should(spark, board_server):
    base, asked = board_server
    make = boards.create(spark, {"type": "api", "name": "greenhouse", "rate_limit_per_minute": 0, "config": {"base_url": base, "details": "true"}})
    sources = spark.createDataFrame([("7", "greenhouse", None, None)], "id string, name string, last_run_at timestamp_ntz, updated_at timestamp_ntz")
    every = spark.createDataFrame([(e, "7", e.upper(), e, True, None, None) for e in ("a", "b", "broken", "gone")], "id string, source_id string, company_name string, company_endpoint string, enabled boolean, last_fetched_at timestamp_ntz, updated_at timestamp_ntz")
    now = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    after, companies, sources, stats = flows.run_source(make.rows(every), every, sources, spark.createDataFrame([], POSTING), "https://r", "greenhouse", now)
    got = stats.first()
    assert (got.companies, got.fetched, got.with_description, got.saved, got.duplicates, got.failed) == (4, 4, 3, 2, 2, 1)
    assert {(r.url, r.job_description) for r in after.collect()} == {("https://r/a/jobs/3", "three"), ("https://r/a/jobs/2", "two")}  # of two equal postings the list's first
    assert {r.id for r in companies.collect() if r.last_fetched_at} == {"a", "b", "gone"} and sources.first().last_run_at is not None
    assert {p: n for p, n in asked.items() if not p.endswith("/2")} == {f"/boards/{b}/jobs": 1 for b in ("a", "b", "broken", "gone")} | {"/boards/a/jobs/3": 1, "/boards/a/jobs/1": 1} and asked["/boards/a/jobs/2"] == 2  # listed twice


def test_only_what_is_read_is_asked_for(spark, board_server, tmp_path):
    base, asked = board_server
    make = boards.create(spark, {"type": "api", "name": "greenhouse", "rate_limit_per_minute": 0, "config": {"base_url": base, "details": "true"}})
    companies = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 3)), ("gone", None)], "company_endpoint string, last_fetched_at timestamp_ntz")
    rows = make.rows(companies, columns=["board", "position", "body"])
    assert rows.filter("board = 'a'").count() == 5 and asked == {"/boards/a/jobs": 1}
    asked.clear()
    assert {r.board for r in make.rows(companies).filter("last_fetched_at < timestamp_ntz'2024-01-02 00:00:00'").select("board").collect()} == {"a", "gone"} and asked["/boards/b/jobs"] == 0
    asked.clear()
    log = str(tmp_path / "log")
    first = sorted(map(str, make.rows(companies, log=log).collect()))
    once = dict(asked)
    assert sorted(map(str, make.rows(companies, log=log).collect())) == first and asked == Counter(once) + Counter({"/boards/gone/jobs": 1})  # only what failed is asked again


def test_lanes_share_a_source_rate():
    reader = boards._BoardReader({"base_url": "x", "boards": ",".join("abcdefg"), "per_minute": "60", "lanes": "3"}, ["board"])
    assert sorted(b for p in reader.partitions() for b, _ in p.boards) == list("abcdefg") and len(reader.partitions()) == 3 and reader.gap == 3
    assert boards.gap_seconds(0, 3) == boards.gap_seconds(None, 3) == 0


def test_published_messages_come_as_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([(f"https://h/{i}", "a\nb") for i in range(5)], "url string, title string")
    queue.publish(messages.envelope(rows, F.lit("now")).repartition(3), str(tmp_path / "q"))
    seen = []
    messages.start(queue.incoming(spark, str(tmp_path / "q"), prefetch=5), lambda b, _: seen.extend(bytes(r.body).decode() for r in b.collect()), lambda b, _: seen.extend([None] * b.count()), str(tmp_path / "c")).awaitTermination()
    assert sorted(json.loads(x)["payload"]["url"] for x in seen) == [f"https://h/{i}" for i in range(5)]


def test_enrichment_replaces_the_whole_row(spark):
    row = dict.fromkeys([f.name for f in POSTING])
    own = [row | {"url": "https://boards.greenhouse.io/X/jobs/01", "salary_range": "1"}, row | {"url": "https://else", "salary_range": "2"}]
    detail = spark.createDataFrame([row | {"url": "new"}], POSTING).withColumns({"board": F.lit("x"), "job_id": F.lit(1)})
    df = spark.createDataFrame(own, POSTING)
    assert sorted((r.url, r.salary_range or "") for r in postings.enriched(df, detail, True).collect()) == [("https://else", "2"), ("new", "")]


def test_settings(tmp_path):
    raw = {"host": "", "port": 5672, "virtual_host": "v", "queue_name": "q", "prefetch_count": 2, "reconnect_delay_seconds": 5, "requeue_on_failure": True}
    got = boards.queue_settings(raw, {"RABBITMQ_PASSWORD": "p", "RABBITMQ_HOST": " h ", "RABBITMQ_PORT": "1"})
    assert (got.host, got.port, got.username, got.reconnect_delay_seconds, got.password) == ("h", 1, "guest", 5.0, "p")
    with pytest.raises(ValueError, match="password, host"):
        boards.queue_settings(raw, {})
    with pytest.raises(ValueError, match="prefetch_count"):
        boards.queue_settings({k: v for k, v in raw.items() if k != "prefetch_count"} | {"host": "h"}, {"RABBITMQ_PASSWORD": "p"})
    pytest.importorskip("yaml")
    (tmp_path / "s.yaml").write_text("host: h\nport: 5\nvirtual_host: v\nqueue_name: q\nprefetch_count: 3\nreconnect_delay_seconds: 1\nrequeue_on_failure: false\nusername: u\n")
    got = boards.queue_settings_of(env={"RABBITMQ_PASSWORD": "p", "RABBITMQ_WORKER_CONFIG": str(tmp_path / "s.yaml"), "RABBITMQ_USER": "w"})
    assert (got.port, got.prefetch_count, got.requeue_on_failure, got.username) == (5, 3, False, "w")


def test_urls_are_judged_by_their_canonical_form(spark):
    cases = {"https://h:99999/x": "no url", "https://[::1]/x": None, "https://u:p@h/x": None, "https:///x": "no url", "http://h": None, "mailto:a@b": "no url"}
    df = spark.createDataFrame([(u, json.dumps({"payload": {"url": u}})) for u in cases], "u string, body string")
    assert {r.u: r.reason for r in messages.validated(df).collect()} == cases


def test_tables_are_created_twice_without_harm(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    assert create_tables(spark, "made") == create_tables(spark, "made")
    assert len(spark.table("made.postings").columns) == 24
    spark.sql("INSERT INTO made.sources (id, name) VALUES ('1', 'a'), ('1', 'b'), ('2', NULL), ('3', NULL)")
    rows = spark.table("made.sources")
    assert {(r.enabled, r.schedule_hours, r.rate_limit_per_minute) for r in rows.collect()} == {(True, 6, None)}
    assert [tuple(r) for r in repeated_keys(rows, "sources").collect()] == [("id", '{"id":"1"}', 2)]
    spark.sql("DROP DATABASE made CASCADE")


def test_written_tables_are_released(spark):
    df = runtime.stored(spark.range(3))
    path = df.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and df.count() == 3
    runtime.Stored(spark.range(2)).drop()
    assert os.path.dirname(path) in {p.removeprefix("file:") for p in runtime._written}
    kept = set(runtime._written)
    runtime._written.clear()
    runtime._written.add(os.path.dirname(path))
    runtime.release(spark)
    assert not os.path.exists(path) and not runtime._written
    runtime._written.update(kept)


def test_scratch_tables_go_but_for_those_kept(spark):
    before = set(runtime._written)
    with runtime.scratch(spark) as keep:
        runtime.stored(spark.range(2))
        with runtime.scratch(spark) as keep_inner:
            runtime.stored(spark.range(3))
            inner = keep_inner(spark.range(4))
        assert inner.df.count() == 4 and len(runtime._written - before) == 2
        outer = keep(inner.df)
    assert outer.df.count() == 4 and runtime._written - before == {outer.path}
    with pytest.raises(ValueError), runtime.scratch(spark):
        runtime.stored(spark.range(2))
        raise ValueError
    assert runtime._written - before == {outer.path}
    outer.drop()


def test_stream_equals_batch(spark):
    a, b = (catalog.queries()[q](spark, SF).collect() for q in ("stream_dispositions", "dispositions"))
    key = lambda rows: sorted((r.event_id, r.reason or "", r.disposition) for r in rows)
    assert key(a) == key(b)


def test_a_batch_is_read_and_validated_once(spark, tmp_path):
    spark.range(30).select(F.format_string('{"payload": {"url": "https://h/%d"}}', "id").alias("value")).union(spark.range(6).select(F.lit("{"))).repartition(2).write.text(str(tmp_path / "in"))
    read, seen = spark.sparkContext.accumulator(0), []

    def counted(s):
        read.add(1)
        return s

    incoming = spark.readStream.text(str(tmp_path / "in")).select(F.udf(counted, "string")("value").alias("body"))
    messages.start(incoming, lambda b, _: seen.append(b.count()), lambda b, _: seen.append(b.count()), str(tmp_path / "c")).awaitTermination()
    assert seen == [30, 6] and read.value == 36


def test_plain_links_are_what_the_parser_makes_of_them(spark):
    from jobloom.functions.urls import PLAIN_LINK, _canonical

    links = ["https://h/1", "http://a.b-c.d/x_y/~z/./..//", "https://h/?a=1&b=/2", "http://1.2.3.4/", "https://h..x-/p", "https://h/\n", "https://h", "https://H/", "https://h:80/", "https://h/?", "https://u@h/", "https://h/a%20b", "https://h/ü", "https://h/#f", "https://h/x?y?z"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(links)], "i int, c string")
    plain = [r.c for r in df.filter(F.col("c").rlike(PLAIN_LINK)).orderBy("i").collect()]
    assert plain == links[:5] and [_canonical(x) for x in plain] == plain
    assert values(spark, urls.canonical_http_url, *links, None) == [_canonical(x) for x in links] + [None]


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS FROM '{path}'")
    found = catalog.queries()[name](spark, SF)
    columns = sorted(found.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in found.collect()))) == sorted(map(str, con.sql(f"SELECT {', '.join(columns)} FROM ({catalog.oracle_sql()[name]})").fetchall()))


def test_arrow_batches_are_bounded(spark):
    runtime.ship(spark)
    rows = spark.range(4000).coalesce(1).select(F.repeat(F.lit("x"), 8192).alias("text"))

    def run(batches):
        for b in batches:
            yield b.from_pydict({"rows": [b.num_rows], "bytes": [sum(len(x) for x in b.column(0).to_pylist())]})

    got = rows.mapInArrow(run, "rows bigint, bytes bigint").collect()
    assert sum(r.rows for r in got) == 4000
    assert max(r.bytes for r in got) <= runtime.BATCH_BYTES + 8192

    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    runtime.ship(own)
    assert own.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"
