"""Column expressions for URLs and page metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track where a visitor came from; any name with the prefix goes as well.
TRACKING = ("ref", "source", "fbclid", "gclid", "mc_cid", "mc_eid")
TRACKING_PREFIX = "utm_"


def _part(c: Column, group: int) -> Column:
    return F.regexp_extract(c, "^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?", group)


def host(c: Column) -> Column:
    """Host in lower case without ``www.``; empty if there is none."""
    return F.regexp_replace(F.lower(_part(F.trim(c), 2)), "^www\\.", "")


def path(c: Column) -> Column:
    return _part(F.trim(c), 3)


def canonical_url(c: Column) -> Column:
    """One spelling of an address: https, lower-case host without www, no closing slash, fragment or tracking parameter."""
    kept = F.filter(F.split(_part(F.trim(c), 4), "&"), lambda p: (p != "") & ~F.split(p, "=")[0].isin(*TRACKING) & ~p.startswith(TRACKING_PREFIX))
    query = F.array_join(kept, "&")
    return F.concat(F.lit("https://"), host(c), F.regexp_replace(path(c), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def segments(c: Column) -> Column:
    return F.filter(F.split(path(c), "/"), lambda s: s != "")


def is_post(c: Column) -> Column:
    """An article rather than a front page: two path segments, or one that has a hyphen or 20 characters."""
    s = segments(c)
    first = F.get(s, F.lit(0))
    return (F.size(s) >= 2) | ((F.size(s) == 1) & (first.contains("-") | (F.length(first) >= 20)))


def is_pdf(c: Column) -> Column:
    return F.lower(path(c)).endswith(".pdf")


# Hosts of platforms.
PLATFORMS = {"twitter.com": "x", "x.com": "x", "linkedin.com": "linkedin", "youtube.com": "youtube", "youtu.be": "youtube", "github.com": "github", "instagram.com": "instagram", "tiktok.com": "tiktok", "reddit.com": "reddit", "substack.com": "substack"}


def platform(c: Column) -> Column:
    """Platform of an address by its registered domain, null for others."""
    base = F.regexp_extract(host(c), "([^.]+\\.[^.]+)$", 1)
    out = F.lit(None).cast("string")
    for domain, name in PLATFORMS.items():
        out = F.when(base == domain, name).otherwise(out)
    return out


def handle(c: Column) -> Column:
    """Account named by the first path segment on a platform, without @; null elsewhere."""
    first = F.regexp_replace(F.get(segments(c), F.lit(0)), "^@", "")
    return F.when(platform(c).isNotNull() & (F.length(first) > 0), F.lower(first))


def date_in_path(c: Column) -> Column:
    """Date of a /YYYY/MM/DD/ path; null if there is none or it does not exist."""
    found = F.regexp_extract(c, "/(\\d{4}/\\d{2}/\\d{2})(?:/|$)", 1)
    return F.try_to_date(F.nullif(found, F.lit("")), "yyyy/MM/dd")


def publish_date(c: Column, *metadata: Column) -> Column:
    """First metadata field that holds a date, else the date in the path."""
    read = [F.try_to_date(F.nullif(F.regexp_extract(m, "^\\s*(\\d{4}-\\d{2}-\\d{2})", 1), F.lit("")), "yyyy-MM-dd") for m in metadata]
    return F.coalesce(*read, date_in_path(c))


def number_in_path(c: Column) -> Column:
    """Number that is a whole path segment, null without one."""
    return F.regexp_extract(path(c), "/([0-9]+)(?:/|$)", 1).try_cast("long")


def pick_title(c: Column, *titles: Column) -> Column:
    """First non-blank title without a `` | Site`` ending; else the address."""
    read = [F.nullif(F.trim(F.regexp_replace(t, "\\s+\\|\\s+[^|]*$", "")), F.lit("")) for t in titles]
    return F.coalesce(*read, c)


def meta_content(page: Column, name: str) -> Column:
    """Content of a meta element by property or name, with the attributes in either order; null if missing."""
    key = f"(?:property|name)=[\"']{name}[\"']"
    content = "content=[\"']([^\"']*)[\"']"
    a = F.regexp_extract(page, f"(?is)<meta[^>]*{key}[^>]*{content}", 1)
    b = F.regexp_extract(page, f"(?is)<meta[^>]*{content}[^>]*{key}", 1)
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))


def element_text(page: Column, tag: str) -> Column:
    """Inner text of the first element of a kind, null if missing."""
    return F.nullif(F.trim(F.regexp_extract(page, f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}>", 1)), F.lit(""))


def links_out(page: Column) -> Column:
    """Number of absolute links."""
    return F.regexp_count(page, F.lit("(?i)href=[\"']https?://")).cast("long")


def page_date(page: Column) -> Column:
    """Date of a page: published-time meta element, JSON-LD ``datePublished``, else the first ``time`` element."""
    linked = F.nullif(F.regexp_extract(page, '"datePublished"\\s*:\\s*"([^"]*)"', 1), F.lit(""))
    element = F.nullif(F.regexp_extract(page, "(?is)<time[^>]*datetime=[\"']([^\"']*)", 1), F.lit(""))
    found = F.coalesce(meta_content(page, "article:published_time"), meta_content(page, "date"), linked, element)
    return F.try_to_date(F.nullif(F.regexp_extract(found, "^\\s*(\\d{4}-\\d{2}-\\d{2})", 1), F.lit("")), "yyyy-MM-dd")
