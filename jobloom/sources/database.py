"""The store's database by JDBC: where it is, partitioned reads, whole writes."""

from __future__ import annotations

import os
from dataclasses import dataclass
from urllib.parse import parse_qsl, unquote, urlencode, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Variables that name the database, all of which must be set (the password may be empty).
VARIABLES = ("DB_HOST", "DB_PORT", "DB_NAME", "DB_USER", "DB_PASSWORD")
#: Seconds to wait for a connection.
TIMEOUT = 5
#: Rows of a read's partition, and partitions at most.
SPLIT_ROWS, MOST_SPLITS = 100_000, 200


@dataclass
class Database:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None

    def options(self) -> dict[str, str]:
        given = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver, "loginTimeout": str(TIMEOUT)}
        return {k: v for k, v in given.items() if v is not None}


def database(env: dict[str, str] | None = None) -> Database:
    """The database of the environment: the five variables win over DATABASE_URL; needs the driver's jar."""
    env = dict(os.environ if env is None else env)
    if all(env.get(x) for x in VARIABLES[:4]) and env.get("DB_PASSWORD") is not None:
        return Database(f"jdbc:postgresql://{env['DB_HOST']}:{env['DB_PORT']}/{env['DB_NAME']}?sslmode={env.get('PGSSLMODE') or 'prefer'}", env["DB_USER"], env["DB_PASSWORD"])
    if url := env.get("DATABASE_URL"):
        if url.startswith("jdbc:"):
            return Database(url)
        parts = urlsplit(url)
        more = f"?{urlencode(parse_qsl(parts.query))}" if parts.query else ""
        return Database(f"jdbc:postgresql://{parts.hostname}:{parts.port or 5432}{parts.path}{more}", unquote(parts.username or ""), unquote(parts.password or ""))
    raise ValueError(f"no database is named: set {', '.join(VARIABLES)}, or DATABASE_URL")


def read_table(spark: SparkSession, db: Database, table: str, number: str | None = None, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """A table's rows.  With ``number``, a numeric column, the rows are read in as many ranges of it as the table is large; nulls come with the first."""
    reader = spark.read.format("jdbc").options(**db.options())
    if number is None:
        return reader.option("dbtable", table).load()
    low, high, n = reader.option("query", f'SELECT min("{number}") AS lo, max("{number}") AS hi, count(*) AS n FROM {table}').load().first()
    splits = max(1, min(MOST_SPLITS, -(-n // split_rows)))
    if low is None or splits == 1:
        return spark.read.format("jdbc").options(**db.options()).option("dbtable", table).load()
    return spark.read.format("jdbc").options(**db.options()).options(dbtable=table, partitionColumn=number, lowerBound=str(low), upperBound=str(high), numPartitions=str(splits)).load()


def lookup(spark: SparkSession, db: Database, table: str, column: str, value: str) -> DataFrame:
    """The first row by id whose column has the value: filter, order and limit go to the database where its dialect can."""
    return read_table(spark, db, table).filter(F.col(column) == value).orderBy("id").limit(1)


def write_table(rows: DataFrame, db: Database, table: str, replace: bool = False, types: str | None = None) -> None:
    """Appends rows, or replaces all; a table that is replaced keeps its definition, and a new one has the given column ``types`` where they are said."""
    writer = rows.write.format("jdbc").options(**db.options()).option("dbtable", table)
    if types:
        writer = writer.option("createTableColumnTypes", types)
    (writer.option("truncate", "true").mode("overwrite") if replace else writer.mode("append")).save()
