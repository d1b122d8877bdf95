"""Corpus pipeline: documents in, encoded clean documents out.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and
returns a DataFrame, which is written as Parquet and reread for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm import byte_bpe, decontaminate, line_dedup, near_copies, quality
from jobloom.llm.common import scratch, table

#: SQL can't express compressed sizes, XXH64 or byte-level BPE: a test holds run() against a brute-force version.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that the compression classifier predicts to be bad.  It learns from labelled rows of the stage's own input.

    A null text is judged as an empty one; rows without a label or id are judged like
    any other, and repeated rows alike.  Without labels of either kind all stay.
    """
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes boilerplate lines out; the source is the host, and rows without one share a host.  n_chars follows the text.

    No row goes: a null text stays null, one of boilerplate alone becomes empty.
    """
    cleaned = line_dedup.drop_boilerplate(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast("bigint"))
    return cleaned.select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest id.  Linked are fingerprints within 2 bits, and texts that share 0.8 of their 5-word shingles.

    A null id comes last; of rows that agree in id and text one stays.  Null, empty
    and wordless texts are one group.
    """
    return near_copies.keep_one(docs).select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects contaminated documents, judged by their texts; null and empty ones, null and shared ids make no difference."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digests of them and of what they decode to.  A null text has no ids; repeated rows are encoded each."""
    coded = byte_bpe.encode_documents(docs)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared folder and reread.  Of the tables written on the way only the last stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        with scratch(spark) as keep:
            result = keep(stage(spark, docs, sf_dir))
        if before is not None:
            before.drop()
        docs, before = result.df, result
    return docs
