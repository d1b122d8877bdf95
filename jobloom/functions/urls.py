"""URL functions: board links, tracking parameters, canonical form, job-link test."""

from __future__ import annotations

from urllib.parse import quote, urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions.text import strip, words_like

#: Hosts and paths under which a link names its board and posting.
BOARD_LINK = r"(?i)^https?://(?:boards-api\.greenhouse\.io/v1/boards|boards\.greenhouse\.io|job-boards\.greenhouse\.io)/([^/]+)/jobs/(\d+)/?$"

#: Sites whose links are postings; what marks other text; prefixes of tracking parameters; words that hint at a posting.
JOB_HOSTS = (
    "greenhouse.io", "ashbyhq.com", "lever.co", "myworkdayjobs.com", "icims.com", "smartrecruiters.com", "jobvite.com", "ycombinator.com",
    "rippling.com", "teamtailor.com", "personio.de", "catsone.com", "dejobs.org", "mayoclinic.org", "hubspot.com/careers", "lattice.com/job",
    "bitwarden.com/careers", "coinbase.com/careers", "toasttab.com/jobs", "samsara.com/company/careers", "motional.com/open-positions",
)
IGNORED_TEXT = ("unsubscribe", "linkedin post", "like or repost", "recommend them to subscribe")
#: Links that are canonical as they stand, and need no parser.
PLAIN_LINK = r"^https?://[a-z0-9][a-z0-9.-]*/[A-Za-z0-9._~/-]*(?:\?[A-Za-z0-9._~=&/-]+)?\z"
TRACKING_PREFIXES = ("utm_", "trk", "trkinfo", "ref", "source", "mc_", "vero_")
POSTING_WORDS = ("job", "jobs", "career", "careers", "apply", "position", "opening")


def _group(url: Column, n: int) -> Column:
    return F.nullif(F.regexp_extract(strip(url), BOARD_LINK, n), F.lit(""))


def board_token(url: Column) -> Column:
    """Board of a board link, as written; null for other URLs."""
    return _group(url, 1)


def board_job_id(url: Column) -> Column:
    """Posting number of a board link without leading zeros, as a string of any length."""
    return F.regexp_replace(_group(url, 2), r"^0+(?=\d)", "")


def board_url(root: Column | str, board: Column, job_id: Column) -> Column:
    root = F.lit(root) if isinstance(root, str) else root
    return F.concat(F.regexp_replace(root, "/+$", ""), F.lit("/"), board, F.lit("/jobs/"), job_id)


def canonical_board_url(url: Column, root: str) -> Column:
    return board_url(root, board_token(url), board_job_id(url))


def rewritten(url: Column, root: str) -> Column:
    """The canonical board URL where it differs from ``url`` (but for slashes at the end); null if it doesn't or ``url`` is no board link."""
    to = canonical_board_url(url, root)
    return F.when(F.regexp_replace(to, "/+$", "") != F.regexp_replace(strip(url), "/+$", ""), to)


def strip_tracking(url: Column) -> Column:
    """Without rubbish at the end and tracking parameters; other parameters are decoded and encoded again, the fragment stays."""
    bare = F.regexp_replace(F.regexp_replace(strip(url), "[\"}' \\t\\r\\n]+$", ""), r"(?U)[>\s]+$", "")
    query = F.regexp_extract(bare, r"^[^?#]*\?([^#]*)", 1)
    tracking = "(?i)^(?:" + words_like(TRACKING_PREFIXES) + ")"
    pairs = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.coalesce(F.try_url_decode(F.substring_index(p, "=", 1)), F.substring_index(p, "=", 1)).rlike(tracking))

    def again(s: Column) -> Column:
        plain = F.coalesce(F.try_url_decode(s), s)
        return F.replace(F.replace(F.url_encode(plain), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))

    def pair(p: Column) -> Column:
        at = F.instr(p, "=")
        name = F.when(at > 0, F.substring(p, F.lit(1), at - 1)).otherwise(p)
        value = F.when(at > 0, F.substring(p, at + 1, F.length(p))).otherwise(F.lit(""))
        return F.concat(again(name), F.lit("="), again(value))

    cleaned = F.array_join(F.transform(pairs, pair), "&")
    before, fragment = F.regexp_extract(bare, r"^([^?#]*)", 1), F.regexp_extract(bare, r"(#.*)$", 1)
    fragment = F.when(fragment == "#", F.lit("")).otherwise(fragment)
    return F.when(bare.isNotNull(), F.concat(before, F.when(cleaned != "", F.concat(F.lit("?"), cleaned)).otherwise(F.lit("")), fragment))


def is_job_link(url: Column, text: Column) -> Column:
    """Whether a link with this text leads to a posting, as far as its words and host say."""
    both = F.lower(F.concat(text, F.lit(" "), url))
    return (
        F.when(both.rlike(words_like(IGNORED_TEXT)), False)
        .when(~(url.startswith("http://") | url.startswith("https://")), False)
        .when(F.lower(url).rlike(words_like(JOB_HOSTS)), True)
        .otherwise(both.rlike(words_like(POSTING_WORDS)))
    )


def _canonical(url: str | None) -> str | None:
    if url is None:
        return None
    try:
        parts = urlsplit(url.strip())
        scheme, host, port = parts.scheme.lower(), parts.hostname, parts.port
        if scheme not in ("http", "https") or not host:
            return None
        host = f"[{host}]" if ":" in host else host if host.isascii() else host.encode("idna").decode()
    except (ValueError, UnicodeError):
        return None
    if any(ch.isspace() for ch in host):
        return None
    user = parts.netloc.rpartition("@")[0]
    place = (f"{user}@" if user else "") + host + (f":{port}" if port is not None and port != {"http": 80, "https": 443}[scheme] else "")
    keep = "!#$%&'()*+,/:;=?@[]~|^{}\\\"<>`"
    path = quote(parts.path or "/", safe=keep.translate({ord(c): None for c in "#?{}\"<>`"}))
    query = "?" + quote(parts.query, safe=keep.translate({ord(c): None for c in "#\"<>'"})) if parts.query else ""
    return f"{scheme}://{place}{path}{query}" + (f"#{parts.fragment}" if parts.fragment else "")


def canonical_http_url(url: Column) -> Column:
    """Trimmed, scheme and host in lower case, a slash for an empty path, no default port, ASCII; null for what is no http(s) URL.  Plain links go past the parser."""
    plain = url.rlike(PLAIN_LINK)
    return F.when(plain, url).otherwise(F.udf(_canonical, "string", useArrow=True)(F.when(~plain, url)))

