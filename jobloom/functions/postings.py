"""Rows of APIs and queues as postings: VARIANT in, columns of POSTING out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import text, urls
from jobloom.schemas import POSTING


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_string(v: Column) -> Column:
    return kind(v) == "STRING"


def field(v: Column, path: str, to: str = "string") -> Column:
    return F.try_variant_get(v, path, to)


def posted(**columns: Column) -> list[Column]:
    """Columns of POSTING in order; those not given are null."""
    return [columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in POSTING]


def metadata_items(row: Column) -> Column:
    """metadata as an array of variants; empty unless it is a list."""
    return F.coalesce(F.when(kind(field(row, "$.metadata", "variant")).startswith("ARRAY"), field(row, "$.metadata", "array<variant>")), F.array().cast("array<variant>"))


def _name(item: Column) -> Column:
    return F.lower(F.coalesce(field(item, "$.name"), F.lit("")))


def _text_value(item: Column) -> Column:
    """value if it is a JSON string, else null: booleans and numbers don't count."""
    return F.when(is_string(field(item, "$.value", "variant")), field(item, "$.value"))


def employment_type(items: Column) -> Column:
    """Value of the first item with a text value whose name speaks of employment, workplace or type."""
    fit = F.filter(items, lambda i: _text_value(i).isNotNull() & _name(i).rlike("employment|workplace|type"))
    return _text_value(F.try_element_at(fit, F.lit(1)))


def workplace_flags(location: Column, items: Column) -> tuple[Column, Column]:
    """(remote, hybrid): of the location, and of items on workplace or type; one item says remote or else hybrid."""
    about = F.filter(items, lambda i: _text_value(i).isNotNull() & _name(i).rlike("workplace|type"))
    says = lambda i, word: F.lower(_text_value(i)).contains(word)
    remote = F.coalesce(F.lower(location).rlike("remote|anywhere"), F.lit(False)) | F.exists(about, lambda i: says(i, "remote"))
    return remote, F.exists(about, lambda i: says(i, "hybrid") & ~says(i, "remote"))


def row_error(row: Column, items: Column) -> Column:
    """Rows that can't be taken: no usable id, a location that is no object, a metadata item that is none or has a null name."""
    place = field(row, "$.location", "variant")
    odd_place = place.isNotNull() & ~F.is_variant_null(place) & ~kind(place).startswith("OBJECT") & ~F.coalesce(field(row, "$.location").isin("", "0", "false"), F.lit(False)) & (kind(place) != "ARRAY<VOID>")
    odd_item = F.exists(items, lambda i: ~kind(i).startswith("OBJECT") | F.coalesce(F.is_variant_null(field(i, "$.name", "variant")), F.lit(False)))
    return field(row, "$.id", "bigint").isNull() | F.coalesce(odd_place, F.lit(False)) | odd_item


def from_api(rows: DataFrame, root: str, source: str, now: Column, row: str = "row", company: str = "company_name", board: str = "company_endpoint", keep: tuple[str, ...] = ()) -> DataFrame:
    """Postings of list-API rows (a VARIANT column), and row_error; a row with an error keeps only its flag."""
    v = F.col(row)
    items = metadata_items(v)
    location = field(v, "$.location.name")
    job_id = field(v, "$.id", "bigint").cast("string")
    url = urls.board_url(root, F.col(board), job_id)
    remote, hybrid = workplace_flags(location, items)
    title, posted_on = field(v, "$.title"), text.iso_date(F.regexp_replace(field(v, "$.updated_at"), "Z", "+00:00"))
    columns = posted(
        url=url, job_title=title, company=F.col(company), location=location, date_posted=posted_on, employment_type=employment_type(items), application_url=url,
        sponsorship_required=F.lit(False), citizenship_required=F.lit(False), remote_allowed=remote, hybrid_allowed=hybrid, source_website=F.lit(source), job_id_from_source=job_id,
        status=F.lit("active"), scraped_at=now, created_at=now, content_hash=text.content_hash(title, F.col(company), location, posted_on),
    )
    return rows.select(*columns, F.coalesce(row_error(v, items), F.lit(True)).alias("row_error"), *keep)


def company_name(detail: Column, slug: Column) -> Column:
    """company.name of the detail, or company as a text that isn't blank, or the slug in title case."""
    c = field(detail, "$.company", "variant")
    named = F.when(kind(c).startswith("OBJECT"), F.nullif(field(c, "$.name"), F.lit("")))
    plain = F.when(is_string(c) & ~text.is_blank(field(detail, "$.company")), field(detail, "$.company"))
    return F.coalesce(named, plain, text.title_case(F.replace(slug, F.lit("-"), F.lit(" "))))


def description(detail: Column) -> Column:
    """Readable text of the content; null if there is none."""
    return F.when(field(detail, "$.content").isNotNull(), text.html_to_text(field(detail, "$.content")))


def with_default(payload: Column, name: str, default: str) -> Column:
    """The default stands for an absent key only; an explicit null stays null."""
    v = field(payload, f"$.{name}", "variant")
    return F.when(v.isNull(), F.lit(default)).otherwise(field(payload, f"$.{name}"))


def from_payload(messages: DataFrame, now: Column, payload: str = "payload", keep: tuple[str, ...] = (), link: str | None = None) -> DataFrame:
    """Postings of valid queue payloads (a VARIANT column), and the columns to keep; rank and the e-mail's fields are not kept.  ``link`` names a column of canonical urls, if there is one."""
    v = F.col(payload)
    title, company, location = field(v, "$.title"), field(v, "$.company"), field(v, "$.location")
    columns = posted(
        url=F.col(link) if link else urls.canonical_http_url(field(v, "$.url")), job_title=title, company=company, location=location, job_description=field(v, "$.summary"), salary_range=field(v, "$.salary"),
        sponsorship_required=F.lit(False), citizenship_required=F.lit(False), remote_allowed=F.lit(False), hybrid_allowed=F.lit(False), source_website=with_default(v, "source", "email_raw_manual"),
        status=F.lit("active"), scraped_at=now, created_at=now, content_hash=text.content_hash(title, company, location, F.lit(None).cast("date")),
    )
    return messages.select(*columns, *keep)


def enriched(postings: DataFrame, details: DataFrame, enabled: bool) -> DataFrame:
    """A posting whose link is a board link found in ``details`` (board, job_id, and the columns of POSTING) is replaced by that row whole; others stay."""
    if not enabled:
        return postings
    names = [f.name for f in POSTING]
    found = details.select(F.lower("board").alias("__board"), F.col("job_id").cast("string").alias("__job"), F.struct(*names).alias("__detail"))
    keyed = postings.withColumn("__board", F.lower(urls.board_token(F.col("url")))).withColumn("__job", urls.board_job_id(F.col("url")))
    joined = keyed.join(found, ["__board", "__job"], "left")
    own = F.struct(*names)
    return joined.withColumn("__row", F.when(F.col("__detail").isNotNull(), F.col("__detail")).otherwise(own)).select("__row.*", *[c for c in postings.columns if c not in names])


def with_detail(rows: DataFrame, details: DataFrame, keys: list[str]) -> DataFrame:
    """All ``rows`` with the columns of their detail, null where there is none: the left join of a list with what was looked up for it.  Keys are unique in ``details``."""
    return rows.join(details, keys, "left")


def card_line(parent: Column, title: Column) -> Column:
    """struct(rank, location, company, salary) of a line such as ``1) Title (Place), Company - Pay``."""
    parent, title = text.clean_text(parent), text.clean_text(title)
    rank = F.regexp_extract(parent, r"(?:^|\s)(\d+)\)\s", 1).try_cast("int")
    bare = F.regexp_replace(parent, r"^\s*\d+\)\s*", "")
    at = F.instr(bare, title)
    bare = F.when((title != "") & (at > 0), F.trim(F.concat(F.substring(bare, F.lit(1), at - 1), F.substring(bare, at + F.length(title), F.length(bare))))).otherwise(bare)
    placed = bare.rlike(r"^\((.*?)\)\s*,?\s*(.*)$")
    rest = F.when(placed, text.clean_text(F.regexp_extract(bare, r"^\((.*?)\)\s*,?\s*(.*)$", 2))).otherwise(bare)
    cut = F.instr(rest, " - ")
    company = F.when(cut > 0, F.substring(rest, F.lit(1), cut - 1)).otherwise(rest)
    salary = F.when(cut > 0, F.substring(rest, cut + 3, F.length(rest)))
    location = F.when(placed, text.clean_text(F.regexp_extract(bare, r"^\((.*?)\)\s*,?\s*(.*)$", 1)))
    filled = lambda c: F.nullif(text.clean_text(c), F.lit(""))
    return F.struct(rank.alias("rank"), location.alias("location"), filled(company).alias("company"), filled(salary).alias("salary"))
