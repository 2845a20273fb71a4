"""Text, naming, hash and time functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomline.config import CrawlConfig
from loomline.functions import url as U


def collapse(text: Column) -> Column:
    """Every run of white space becomes one space; trimmed."""
    return F.trim(F.regexp_replace(text, U.SPACE + "+", " "))


def running_text(text: Column, config: CrawlConfig) -> Column:
    """Plain running text of Markdown, whole."""
    out = F.regexp_replace(text, r"\A---[\s\S]*?---(?U)[\s\x1c-\x1f]*", " ")
    for pattern in config.boilerplate:
        out = F.regexp_replace(out, pattern, " ")
    return collapse(F.translate(out, "#*", "  "))


def compact_excerpt(text: Column, limit: int, config: CrawlConfig) -> Column:
    """Plain running text of Markdown, cut to ``limit`` code points with ``...`` where cut."""
    return shortened(running_text(text, config), limit)


def shortened(text: Column, limit: int) -> Column:
    """Cut to ``limit`` code points with ``...`` where cut."""
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("..."))).otherwise(text)


def short_summary(text: Column, config: CrawlConfig) -> Column:
    return compact_excerpt(text, config.summary_chars, config)


def title_of_markdown(text: Column, fallback: Column) -> Column:
    """Text of the first line that starts with ``#`` and has more than that."""
    lines = F.transform(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), U.strip)
    titles = F.filter(F.transform(F.filter(lines, lambda x: x.startswith("#")), lambda x: U.strip(F.ltrim(x, F.lit("#")))), lambda x: x != "")
    return F.coalesce(F.get(titles, F.lit(0)), fallback)


def normalize_title(title: Column, fallback: Column) -> Column:
    out = F.btrim(collapse(F.coalesce(title, F.lit(""))), F.lit(" \"'"))
    out = F.when(F.contains(out, F.lit(" - ")), U.strip(F.split_part(out, F.lit(" - "), F.lit(1)))).otherwise(out)
    return F.when(out == "", fallback).otherwise(out)


def safe_name(name: Column, fallback: Column | str) -> Column:
    """A file name: forbidden characters become ``_``, at most 80 code points."""
    fallback = F.lit(fallback) if isinstance(fallback, str) else fallback
    out = F.regexp_replace(U.strip(F.coalesce(name, F.lit(""))), r'[\\/:*?"<>|]+', "_")
    out = F.btrim(F.regexp_replace(out, U.SPACE + "+", " "), F.lit(" ."))
    return F.when(out == "", fallback).otherwise(F.left(out, F.lit(80)))


def page_slug(url: Column) -> Column:
    return safe_name(U.percent_decode(U.last_segment(url)), "page")


def page_filename(title: Column, url: Column) -> Column:
    return F.concat(safe_name(title, page_slug(url)), F.lit("-"), F.left(F.sha1(url.cast("binary")), F.lit(10)), F.lit(".md"))


def summary_cache_key(title: Column, content: Column) -> Column:
    return F.sha1(F.concat(U.strip(title), F.lit("\n"), U.strip(content)).cast("binary"))


def retry_delay_seconds(count: Column, config: CrawlConfig) -> Column:
    """Doubling backoff: 0 for no failure, then base, 2 base, ... up to the longest."""
    base = max(config.retry_base_seconds, 0.1)
    longest = max(config.retry_max_seconds, base)
    return F.when(count <= 0, F.lit(0.0)).otherwise(F.least(F.lit(float(longest)), F.lit(float(base)) * F.pow(F.lit(2.0), F.least(count - 1, F.lit(60)))))


def next_retry_at(count: Column, now: Column, config: CrawlConfig) -> Column:
    return now + F.make_dt_interval(secs=retry_delay_seconds(count, config).cast("decimal(18,6)"))


def parse_iso(value: Column) -> Column:
    """Timestamps of ISO texts; anything else is null; without a zone UTC counts (the session's)."""
    shaped = value.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    return F.when(shaped, F.try_to_timestamp(value))


def iso_format(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def percent_progress(current: Column, total: Column) -> Column:
    """0 to 100; a total of 0 or null counts as 100."""
    of = F.when(F.coalesce(total, F.lit(0.0)) == 0, F.lit(100.0)).otherwise(total)
    return F.when(of <= 0, F.lit(0.0)).otherwise(F.least(F.greatest(F.coalesce(current, F.lit(0.0)) / of * 100, F.lit(0.0)), F.lit(100.0)))


def normalize_extensions(values: Column) -> Column:
    """Lower-cased distinct extensions with a leading dot, sorted."""
    low = F.filter(F.transform(values, lambda x: F.lower(U.strip(x))), lambda x: x != "")
    return F.array_sort(F.array_distinct(F.transform(low, lambda x: F.when(x.startswith("."), x).otherwise(F.concat(F.lit("."), x)))))


def extension(path: Column) -> Column:
    """The lower-cased suffix of a path's last part; none for names that only start with a dot."""
    name = F.substring_index(path, "/", -1)
    return F.lower(F.regexp_extract(name, r"^.+?(\.[^./]+)$", 1))


def as_count(value: Column) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(0))


def as_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))
