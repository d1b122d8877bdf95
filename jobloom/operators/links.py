"""Postings of newsletter HTML: anchors, cleaned, filtered, parsed, first of each link."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.functions import anchors, postings, text, urls
from jobloom.operators.dedup import first_wins
from jobloom.runtime import ship


def job_entries(mails: DataFrame, id_column: str = "path", html: str = "html", base: str = "", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per mail and distinct job link: id, pos, rank, title, url, location, company, salary, summary, and the mail's columns to ``keep``.  ``base`` goes before links that start with a slash."""
    ship(mails.sparkSession)
    exploded = mails.select(F.col(id_column), *keep, F.explode(anchors.extract_anchors(F.col(html))).alias("a"))
    href = F.when(F.lit(bool(base)) & F.col("a.href").startswith("/"), F.concat(F.lit(base), "a.href")).otherwise(F.col("a.href"))
    rows = exploded.select(id_column, *keep, "a.pos", text.clean_text(F.col("a.anchor_text")).alias("title"), urls.strip_tracking(href).alias("url"), "a.parent_text", "a.summary")
    rows = rows.filter((F.col("title") != "") & urls.is_job_link(F.col("url"), F.col("title")))
    rows = first_wins(rows, [id_column, "url"], ["pos"])
    card = postings.card_line(F.col("parent_text"), F.col("title"))
    return rows.withColumn("c", card).select(id_column, "pos", "c.rank", "title", "url", "c.location", "c.company", "c.salary", "summary", *keep)


def preview(entries: DataFrame, width: int = 220) -> DataFrame:
    """Rows as a console shows them: rank or ?, summary cut to ``width``."""
    return entries.select(F.coalesce(F.col("rank").cast("string"), F.lit("?")).alias("rank"), "title", "company", "location", "salary", "url", F.substring("summary", 1, width).alias("summary"))
