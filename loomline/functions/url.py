"""URL functions as Column expressions.

URLs are taken apart with patterns, as the built-in parsers reject or alter unusual
ones.  All functions give null for null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomline.config import CrawlConfig

#: Python's white space: Unicode's and the four separators that Java leaves out.
SPACE = r"(?U)[\s\x1c-\x1f]"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def percent_decode(text: Column) -> Column:
    """Percent-decoding that leaves ``+`` and broken escapes alone; bad UTF-8 becomes U+FFFD."""
    safe = F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(safe)


def _whole(url: Column) -> Column:
    """Without line breaks, tabs and fragment."""
    return F.regexp_replace(F.regexp_replace(url, r"[\t\r\n]", ""), r"#.*$", "")


def path_of(url: Column) -> Column:
    """The path, without the last segment's parameters."""
    path = F.regexp_extract(_whole(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?]*)?([^?]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def query_of(url: Column) -> Column:
    return F.regexp_extract(_whole(url), r"^[^?]*\?(.*)$", 1)


def clean_url(url: Column, config: CrawlConfig) -> Column:
    """Trimmed of white space and closing marks, and rewritten to https and the site's host."""
    base = F.regexp_replace(strip(url), r"[).,;!?\]>]+$", "")
    path, query = path_of(base), query_of(base)
    slash = F.when((path != "") & ~path.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit(config.origin), slash, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def last_segment(url: Column) -> Column:
    return F.substring_index(F.regexp_replace(path_of(url), "/+$", ""), "/", -1)


def visit_key(url: Column) -> Column:
    """What stands for a page in all its language and query variants: the decoded last path segment."""
    key = percent_decode(last_segment(url))
    return F.when(key == "", F.lit("/")).otherwise(key)


def is_candidate(url: Column, config: CrawlConfig) -> Column:
    out = url.startswith(f"{config.origin}/")
    for hint in config.url_hints:
        out = out & ~F.contains(url, F.lit(hint))
    decoded = percent_decode(url)
    for hint in config.path_hints:
        out = out & ~F.contains(decoded, F.lit(hint))
    return out


def without_dots(path: Column) -> Column:
    """An absolute path without ``.`` and ``..`` segments."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    empty = F.expr("array()").cast("array<string>")

    def step(acc: Column, part: Column) -> Column:
        up = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))  # never above the root
        return F.when(part == "..", up).when(part == ".", acc).otherwise(F.concat(acc, F.array(part)))

    joined = F.array_join(F.aggregate(parts, empty, step), "/")
    joined = F.when(last.isin(".", ".."), F.concat(joined, F.lit("/"))).otherwise(joined)
    return F.when(F.instr(path, "/.") == 0, path).otherwise(F.when(joined == "", F.lit("/")).otherwise(joined))


def join_href(href: Column, config: CrawlConfig) -> Column:
    """A link's target joined to the site's root."""
    same = F.regexp_replace(href, r"^https:(?!//)", "")
    path, rest = F.regexp_extract(same, r"^([^?#;]*)", 1), F.regexp_extract(same, r"^[^?#;]*(.*)$", 1)
    absolute = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), F.regexp_replace(path, "(?<=.)/{2,}", "/")))
    return (
        F.when(same.rlike(SCHEME), same)
        .when(same.startswith("//"), F.concat(F.lit("https:"), same))
        .otherwise(F.concat(F.lit(config.origin), without_dots(absolute), rest))
    )


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))
