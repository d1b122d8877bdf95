"""Driver queries of the training-data operators, and their SQL where it can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm import byte_bpe, co_bucket, cross_tokens, decontaminate, exact_dedup, lang_crf, license_scan, line_dedup, quality, secret_scan, simhash, token_count, warc
from jobloom.llm.common import shared_folder, table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents; see ``exact_dedup.exact_duplicates`` for nulls, ties and repeated rows."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op2_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents; see ``token_count.token_counts`` for nulls and special strings."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt outside the held-out fold; see ``quality.train`` and ``quality.score`` for nulls and missing labels."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents; see ``secret_scan.scan_documents`` for nulls."""
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the boilerplate lines of their sources; see ``line_dedup.drop_boilerplate`` for nulls and blank lines."""
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "text", "n_lines", "n_dropped")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of all documents, as digests; see ``byte_bpe.encode_documents`` for nulls and special strings."""
    coded = byte_bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of whole documents by all items, and the items near to them: a window whose words stand within two places of where they would."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=2)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated", F.array_join("near_items", ",").alias("near_items"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC files and read back; see ``warc.round_trip`` for nulls and repeated rows."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents; see ``license_scan.scan_licenses`` for nulls."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents; see ``simhash.near_duplicates`` for nulls and wordless texts."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt outside the held-out fold; see ``lang_crf.train`` and ``lang_crf.predict`` for nulls and texts without letters."""
    docs = table(spark, sf_dir, "documents")
    return lang_crf.predict(docs, lang_crf.train(docs))


def op12_co_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales and sale lines written, then rewritten into one file per table and bucket; see ``co_bucket.co_bucketed`` for nulls, ties and repeated rows."""
    folder = f"{shared_folder(spark)}/co-bucketed-{uuid.uuid4().hex}"
    return co_bucket.co_bucketed(table(spark, sf_dir, "sales"), table(spark, sf_dir, "sale_lines"), folder, ("sales", "sale_lines"), "sale_id", "item_id")


def op13_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers over all documents aligned, and how common their pairs are; see ``cross_tokens.align`` for nulls and texts that don't come back."""
    found = cross_tokens.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


OP1_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS s FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       row_number() OVER w = 1 AS kept, s AS text_sha256
FROM t WINDOW w AS (PARTITION BY s ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""

OP5_SQL = r"""
WITH pages AS (SELECT DISTINCT coalesce(source, '') AS host, text FROM documents WHERE text IS NOT NULL),
totals AS (SELECT host, count(*) AS n FROM pages GROUP BY host),
lines AS (SELECT DISTINCT host, text, trim(regexp_replace(unnest(string_split(text, chr(10))), '[ \t\r]+', ' ', 'g')) AS line FROM pages),
drops AS (SELECT l.host, list(line) AS gone FROM (SELECT host, line, count(*) AS pages FROM lines WHERE line <> '' GROUP BY host, line HAVING count(*) >= 2) l
          JOIN totals t ON l.host = t.host WHERE pages > 0.02 * n GROUP BY l.host),
cut AS (SELECT doc_id, string_split(text, chr(10)) AS before, text, list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(gone, []), trim(regexp_replace(x, '[ \t\r]+', ' ', 'g')))) AS after
        FROM documents d LEFT JOIN drops ON coalesce(d.source, '') = drops.host)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(array_to_string(after, chr(10)), '') END AS text,
       coalesce(len(before), 0) AS n_lines, coalesce(len(before) - len(after), 0) AS n_dropped FROM cut
"""

OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS gram FROM (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
grams AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS gram FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM items))),
hits AS (SELECT doc_id, item_id, k, i FROM grams JOIN windows USING (k, gram)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
pos AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
words AS (SELECT item_id, i, k, unnest(w[i : i + k - 1]) AS word, unnest(range(k)) AS o FROM (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
found AS (SELECT words.*, coalesce(c, 0) AS c FROM words LEFT JOIN (SELECT word, count(*) AS c FROM pos GROUP BY word) USING (word)),
anchors AS (SELECT item_id, i, min({'c': c, 'o': o}) AS a FROM found GROUP BY item_id, i HAVING min(c) > 0),
starts AS (SELECT DISTINCT item_id, i, k, pos.doc_id, pos.p - o AS s FROM anchors JOIN found USING (item_id, i) JOIN pos ON pos.word = found.word WHERE o = a.o),
nearby AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM (SELECT s.item_id, s.doc_id FROM starts s JOIN found f ON s.item_id = f.item_id AND s.i = f.i JOIN pos ON pos.doc_id = s.doc_id AND pos.word = f.word AND pos.p BETWEEN s.s + f.o - 2 AND s.s + f.o + 2
           GROUP BY s.item_id, s.i, s.doc_id, s.s, s.k HAVING count(DISTINCT f.o) = s.k)),
near AS (SELECT doc_id, string_agg(item_id, ',' ORDER BY item_id) AS near_items FROM nearby GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(near_items, '') AS near_items
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN near USING (doc_id)
"""

OP8_SQL = r"""
WITH t AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM t)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_exact_dedup, op2_token_count, op3_quality, op4_secret_scan, op5_line_dedup, op6_byte_bpe, op7_decontaminate, op8_warc, op9_license_scan, op10_simhash, op11_language, op12_co_bucket, op13_cross_tokens)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """Tokenizers, classifiers, entropy and XXH64 have no SQL: tests hold those queries against brute force."""
    return {"op1_exact_dedup": OP1_SQL, "op5_line_dedup": OP5_SQL, "op7_decontaminate": OP7_SQL, "op8_warc": OP8_SQL, "op9_license_scan": license_scan.oracle_sql()}
