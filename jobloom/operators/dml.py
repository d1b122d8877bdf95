"""Set-based changes of tables: each returns the table's rows afterwards (built-in tables know no MERGE)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def touch(table: DataFrame, ids: list[str], now: Column, columns: list[str], id_column: str = "id") -> DataFrame:
    """The named time columns of the given rows set to ``now``."""
    hit = F.col(id_column).isin(*ids)
    return table.select(*[F.when(hit, now).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns])


def touch_rows(table: DataFrame, ids: DataFrame, now: Column, columns: list[str], id_column: str = "id") -> DataFrame:
    """The same for the rows whose id is among ``ids`` (one column of that name), however many."""
    mark = f"touched-{uuid.uuid4().hex}"
    joined = table.join(ids.select(id_column).distinct().withColumn(mark, F.lit(True)), id_column, "left")
    return joined.select(*[F.when(F.col(mark), now).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns])


def overwrite_upsert(table: DataFrame, incoming: DataFrame, keys: list[str], overwritten: list[str]) -> DataFrame:
    """Rows of ``incoming`` replace the ``overwritten`` columns where the key is there, and are inserted where not.  Keys are unique on either side."""
    t, flag = (f"{x}-{uuid.uuid4().hex}" for x in "tc")
    there, came = F.lit(True).alias(t), F.lit(True).alias(flag)
    joined = table.select("*", there).alias("t").join(incoming.select("*", came).alias("c"), keys, "full_outer")

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        new = F.col(f"c.{c}") if c in incoming.columns else F.lit(None)
        old = F.col(f"t.{c}")
        return F.when(F.col(t).isNull(), new).when(F.col(flag) & F.lit(c in overwritten), new).otherwise(old).alias(c)

    return joined.select(*[value(c) for c in table.columns])


def insert_absent(table: DataFrame, incoming: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Rows of ``incoming`` whose key the table lacks, the first of each key by ``order``."""
    from jobloom.operators.dedup import first_wins

    new = incoming.join(table.select(*keys), keys, "left_anti")
    return first_wins(new, keys, order) if order else new.dropDuplicates(keys)


def existing(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows whose key the table has."""
    return rows.join(table.select(key), key, "left_semi")


def seed_companies(sources: DataFrame, companies: list[tuple[str, str]], name: str) -> DataFrame:
    """(source_id, company_name, company_endpoint, enabled) of an inline list for the source of that name: a filtered cross join with a relation of fixed size."""
    inline = sources.sparkSession.createDataFrame(companies, "company_name string, company_endpoint string")
    return sources.filter(F.col("name") == name).select(F.col("id").alias("source_id")).crossJoin(F.broadcast(inline)).withColumn("enabled", F.lit(True))

