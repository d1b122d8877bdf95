"""Data model: postings, sources, companies, keywords and queue messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "date": T.DateType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "variant": T.VariantType(),
    "timestamp_ntz": T.TimestampNTZType(), "array<string>": T.ArrayType(T.StringType()),
}


def _struct(text: str) -> T.StructType:
    """A flat schema of its text; needs no session."""
    return T.StructType([T.StructField(*x.split(" ")[:1], _TYPES[x.split(" ")[1]]) for x in text.split(", ")])


POSTING = _struct(
    "id string, url string, job_title string, company string, location string, job_description string, date_posted date, employment_type string, "
    "salary_range string, experience_level string, education_required string, skills_required array<string>, application_url string, "
    "sponsorship_required boolean, citizenship_required boolean, remote_allowed boolean, hybrid_allowed boolean, source_website string, "
    "job_id_from_source string, status string, last_updated timestamp_ntz, scraped_at timestamp_ntz, created_at timestamp_ntz, content_hash string"
)
SOURCE = _struct("id string, name string, type string, enabled boolean, schedule_hours int, rate_limit_per_minute int, config variant, last_run_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz")
COMPANY = _struct("id string, source_id string, company_name string, company_endpoint string, enabled boolean, last_fetched_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz")
KEYWORD = _struct("id string, category string, keyword string, active boolean, created_at timestamp_ntz, updated_at timestamp_ntz")
PAYLOAD = _struct("url string, title string, rank int, location string, company string, salary string, summary string, email_subject string, email_sender string, source string")

TABLES = {"postings": POSTING, "sources": SOURCE, "source_companies": COMPANY, "keywords": KEYWORD}
SOURCE_TYPES = ("api", "scraper")
#: Columns that are unique in a table, and what a column holds where an insert names none.
KEYS = {"postings": [["id"], ["url"]], "sources": [["id"], ["name"]], "source_companies": [["id"], ["source_id", "company_endpoint"]], "keywords": [["id"], ["category", "keyword"]]}
DEFAULTS = {
    "postings": {"sponsorship_required": "false", "citizenship_required": "false", "remote_allowed": "false", "hybrid_allowed": "false", "status": "'active'"},
    "sources": {"enabled": "true", "schedule_hours": "6"},
    "source_companies": {"enabled": "true"},
    "keywords": {"active": "true"},
}


def repeated_keys(rows: DataFrame, name: str) -> DataFrame:
    """(key, value, n) of unique keys that a table's rows repeat: Spark enforces none.  A key with a null in it never repeats."""
    found = None
    for key in KEYS[name]:
        counts = rows.dropna(subset=key).groupBy(*key).count().filter("count > 1").select(F.lit(",".join(key)).alias("key"), F.to_json(F.struct(*key)).alias("value"), F.col("count").alias("n"))
        found = counts if found is None else found.union(counts)
    return found


def create_tables(spark: SparkSession, database: str = "default") -> list[str]:
    """Creates the tables that aren't there yet; the store of postings is partitioned by source."""
    made = []
    for name, schema in TABLES.items():
        default = lambda c: f" DEFAULT {DEFAULTS[name][c]}" if c in DEFAULTS[name] else ""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{default(f.name)}" for f in schema)
        part = " PARTITIONED BY (source_website)" if name == "postings" else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet{part}")
        made.append(f"{database}.{name}")
    return made
