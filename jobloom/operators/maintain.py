"""Rewriting stored API links to board links, with conflicts set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.functions.text import strip
from jobloom.functions.urls import rewritten

#: Fixed value: host of the links to be rewritten.
API_HOST = "boards-api.greenhouse.io"


def rewrite_plan(table: DataFrame, root: str, execute: bool = False, only_api: bool = True) -> DataFrame:
    """One row per candidate: id, url, new_url, application_url, new_application_url, status (unchanged, skipped_conflict, updated).

    A row whose target another row owns is skipped.  With ``execute`` earlier
    changes count: of several rows with one target the first by id gets it.
    """
    url, app = F.col("url"), F.col("application_url")
    rows = table.select("id", "url", "application_url")
    if only_api:
        rows = rows.filter(url.contains(API_HOST) | F.coalesce(app, F.lit("")).contains(API_HOST))
    to = F.coalesce(rewritten(url, root), url)
    rows = rows.withColumn("new_url", to)
    new_app = F.when(F.coalesce(app, F.lit("")) == "", app).when(strip(app) == strip(url), F.col("new_url")).otherwise(F.coalesce(rewritten(app, root), app))
    rows = rows.withColumn("new_application_url", new_app)
    same = (F.col("new_url") == url) & (F.coalesce("new_application_url", F.lit("")) == F.coalesce(app, F.lit("")))
    owners = table.groupBy(F.col("url").alias("new_url")).agg(F.min("id").alias("__low"), F.max("id").alias("__high"))
    rows = rows.withColumn("__same", same).join(owners, "new_url", "left")
    taken = F.coalesce((F.col("__low") != F.col("id")) | (F.col("__high") != F.col("id")), F.lit(False))
    if execute:
        first = rows.filter(~F.col("__same")).groupBy("new_url").agg(F.min("id").alias("__first"))
        rows = rows.join(first, "new_url", "left")
        taken = taken | F.coalesce(F.col("__first") != F.col("id"), F.lit(False))
    status = F.when(F.col("__same"), "unchanged").when(taken, "skipped_conflict").otherwise("updated")
    return rows.select("id", "url", "new_url", "application_url", "new_application_url", status.alias("status"))


def apply_plan(table: DataFrame, plan: DataFrame) -> DataFrame:
    """The table with the updates of a plan."""
    changes = plan.filter("status = 'updated'").select("id", F.col("new_url").alias("__url"), F.col("new_application_url").alias("__app"))
    put = {"url": F.coalesce("__url", "url"), "application_url": F.coalesce("__app", "application_url")}
    return table.join(changes, "id", "left").select(*[put[c].alias(c) if c in put else F.col(c) for c in table.columns])


def counts(plan: DataFrame) -> DataFrame:
    return plan.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("updated", "unchanged", "skipped_conflict")])
