"""The crawl frontier as tables: one step takes a state and a batch's results to the next state.

Tables: ``queue`` (seq, url, visit_key), ``visited`` (url, visit_key), ``failures`` (url,
count, next_retry_at, next_retry_raw, last_error).  The order of the queue is ``seq``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.config import CrawlConfig
from loomline.functions import text as X
from loomline.functions import url as U
from loomline.operators import membership, rules
from loomline.sources.state import shared_folder


def with_keys(urls: DataFrame) -> DataFrame:
    return urls.withColumn("visit_key", U.visit_key(F.col("url")))


def classify(queue: DataFrame, visited: DataFrame, failures: DataFrame, patterns: list[str], now: Column, forced: DataFrame | None = None, filters: dict[int, DataFrame] | None = None) -> DataFrame:
    """Adds ``fate``: dup, visited, deny, defer or pick, the first that holds for a row in ``seq`` order.

    ``filters``: of the visited keys, by level (``membership``); they change the work, not the result.
    """
    seen = membership.held_keys(queue, visited, "visit_key", filters).select(F.col("visit_key").alias("k"), F.lit(True).alias("seen"))
    out = queue.join(seen, F.col("visit_key") == F.col("k"), "left").drop("k")
    out = out.join(failures.select(F.col("url").alias("failed_url"), "next_retry_at"), F.col("url") == F.col("failed_url"), "left").drop("failed_url")
    if forced is not None:
        out = out.join(forced.select(F.col("url").alias("forced_url")).distinct().withColumn("forced", F.lit(True)), F.col("url") == F.col("forced_url"), "left").drop("forced_url")
    else:
        out = out.withColumn("forced", F.lit(None).cast("boolean"))
    waits = F.coalesce(now < F.col("next_retry_at"), F.lit(False)) & ~F.coalesce("forced", F.lit(False))
    fate = F.when(F.coalesce("seen", F.lit(False)), "visited").when(rules.denied(F.col("url"), patterns), "deny").when(waits, "defer").otherwise("pick")
    out = out.withColumn("fate", fate)
    nth = F.row_number().over(Window.partitionBy("url").orderBy("seq"))
    return out.withColumn("fate", F.when((F.col("fate") == "pick") & (nth > 1), "dup").otherwise(F.col("fate"))).drop("seen", "forced", "next_retry_at")


@dataclass
class Selection:
    batch: DataFrame  # seq, url, visit_key of the picked rows
    rest: DataFrame  # the queue that is left, deferred rows last
    deferred: int
    filtered: int


def select_batch(classified: DataFrame, n: int) -> Selection:
    """Picks the first ``n`` rows; rows after the last of them are not looked at and keep their place."""
    picked = classified.where("fate = 'pick'").orderBy("seq").limit(max(n, 0))
    ends = picked.agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("cut")).first()
    full = ends["n"] == n
    upto = (F.col("seq") <= (ends["cut"] if ends["cut"] is not None else -1)) if full else F.lit(True)
    inspected = classified.where(upto)
    counts = inspected.agg(F.count_if(F.col("fate") == "defer").alias("d"), F.count_if(F.col("fate") == "deny").alias("x")).first()
    tail = classified.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("m")).first()["m"]
    late = inspected.where("fate = 'defer'").withColumn("seq", F.col("seq") + F.lit(tail + 1))
    rest = classified.where(~upto).select("seq", "url", "visit_key").unionByName(late.select("seq", "url", "visit_key"))
    return Selection(picked.select("seq", "url", "visit_key"), rest, counts["d"], counts["x"])


@dataclass
class Head:
    """What a batch takes from the queue's head."""

    batch: list  # rows (seq, url, visit_key), at most as many as were asked for
    late: DataFrame | None  # deferred rows (seq, url, visit_key), which go to the tail
    head: int  # the least seq that is left
    deferred: int
    filtered: int


def select_head(rows_before, first: int, end: int, fates, keep, n: int) -> Head:
    """Picks the first ``n`` rows of a queue by looking at no more of it than it takes.

    ``rows_before(upto)`` gives the rows up to a seq, ``fates(rows)`` classifies them, ``keep(rows, k)`` writes them
    down.  A window at the head is classified once and written; it grows fourfold while it holds
    too few rows to pick, so that all windows together are little more than the last one.
    """
    span, turn = 4 * max(n, 1), 0
    while True:
        upto = min(first + span, end)
        seen = keep(fates(rows_before(upto)), turn)
        batch = seen.where("fate = 'pick'").orderBy("seq").limit(max(n, 0)).select("seq", "url", "visit_key").collect()
        if len(batch) == n or upto >= end:
            break
        span, turn = 4 * span, turn + 1
    head = batch[-1]["seq"] + 1 if batch and len(batch) == n else end
    looked = seen.where(F.col("seq") < head)
    counts = looked.agg(F.count_if(F.col("fate") == "defer").alias("d"), F.count_if(F.col("fate") == "deny").alias("x")).first()
    late = looked.where("fate = 'defer'").select("seq", "url", "visit_key") if counts["d"] else None
    return Head(batch, late, head, counts["d"], counts["x"])


def new_links(pages: DataFrame, visited: DataFrame, queue: DataFrame, patterns: list[str], filters: dict[int, DataFrame] | None = None, more: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Links of fetched pages that join the queue, and all denied (page, link) rows.

    ``pages``: position, links (sorted, distinct).  Of the links with one visit key the first
    by (position, place in the list) stays; keys that are visited or queued are left out.  ``filters``: of the keys of
    ``visited``, by level; ``more``: further visited rows, which the filters don't cover.
    """
    links = with_keys(pages.select("position", F.posexplode("links").alias("place", "url")))
    links = links.withColumn("denied", rules.denied(F.col("url"), patterns))
    first = F.row_number().over(Window.partitionBy("visit_key").orderBy("position", "place"))
    fresh = links.where("NOT denied").withColumn("nth", first).where("nth = 1").drop("nth", "denied")
    fresh = fresh.join(membership.held_keys(fresh, visited, "visit_key", filters), "visit_key", "left_anti")
    if more is not None:
        fresh = fresh.join(more.select("visit_key").distinct(), "visit_key", "left_anti")
    fresh = fresh.join(queue.select("visit_key").distinct(), "visit_key", "left_anti")
    return fresh.select("position", "place", "url", "visit_key"), links.where("denied")


def enqueue(queue: DataFrame, fresh: DataFrame, work: str | None = None) -> DataFrame:
    """The queue with new links at its end, numbered anew from 0."""
    parts = queue.select(F.lit(0).alias("part"), F.col("seq").alias("a"), F.lit(0).alias("b"), "url", "visit_key")
    more = fresh.select(F.lit(1).alias("part"), F.col("position").cast("long").alias("a"), F.col("place").alias("b"), "url", "visit_key")
    return renumber(parts.unionByName(more), "part", "a", "b", work=work)


def renumber(rows: DataFrame, *order: str, work: str | None = None) -> DataFrame:
    """(seq, url, visit_key) with seq from 0: ranges are counted in parallel, and only their sizes summed in one place.

    The ranged rows are written first (to the folder ``work``, or a new one in the shared folder), as ranges come from
    samples and so may differ whenever they are dealt out anew.
    """
    spark = rows.sparkSession
    work = work or f"{shared_folder(spark)}/ranged-{uuid.uuid4().hex}"
    ranged = rows.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = ranged.select("url", "visit_key", F.spark_partition_id().alias("__part"), at.alias("__at"))
    ranged.write.parquet(work)
    ranged = spark.read.schema(ranged.schema).parquet(work)
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    return ranged.join(starts, "__part").select((F.col("__start") + F.col("__at")).alias("seq"), "url", "visit_key")


def tail_of(late: DataFrame | None, fresh: DataFrame, start: int, work: str | None = None) -> DataFrame:
    """Rows that join the queue, numbered from ``start``: deferred ones first, then new links in their order."""
    rows = fresh.select(F.lit(1).alias("part"), F.col("position").cast("long").alias("a"), F.col("place").alias("b"), "url", "visit_key")
    if late is not None:
        rows = late.select(F.lit(0).alias("part"), F.col("seq").alias("a"), F.lit(0).alias("b"), "url", "visit_key").unionByName(rows)
    return renumber(rows, "part", "a", "b", work=work).withColumn("seq", F.col("seq") + F.lit(start))


def failure_changes(failures: DataFrame, results: DataFrame, now: Column, config: CrawlConfig) -> DataFrame:
    """What a batch's results change: failure records with a higher count, and ``__gone`` ones of URLs that succeeded."""
    own = failures.join(results.select("url").distinct(), "url", "left_semi")
    merged = merge_failures(own, results, now, config).withColumn("__gone", F.lit(False))
    gone = own.join(results.where("ok").select("url"), "url", "left_semi").withColumn("__gone", F.lit(True))
    return merged.unionByName(gone)


def merge_failures(failures: DataFrame, results: DataFrame, now: Column, config: CrawlConfig) -> DataFrame:
    """Failure records after a batch (url, ok, error): counts go up by one, successes drop theirs."""
    bad = results.where("NOT ok").select("url", F.col("error").alias("new_error"))
    good = results.where("ok").select("url")
    both = failures.join(good, "url", "left_anti").join(bad.withColumn("hit", F.lit(True)), "url", "full_outer")
    count = F.coalesce("count", F.lit(0)) + F.coalesce(F.col("hit").cast("int"), F.lit(0))
    hit = F.col("hit").isNotNull()
    retry = F.when(hit, X.next_retry_at(count, now, config)).otherwise(F.col("next_retry_at"))
    return both.select(
        "url", count.cast("int").alias("count"), retry.alias("next_retry_at"),
        F.when(hit, X.iso_format(retry)).otherwise(F.col("next_retry_raw")).alias("next_retry_raw"),
        F.when(hit, F.col("new_error")).otherwise(F.col("last_error")).alias("last_error"),
    )


def newly_visited(visited: DataFrame, results: DataFrame, filters: dict[int, DataFrame] | None = None) -> DataFrame:
    """(url, visit_key) of the successes of a batch that ``visited`` doesn't hold."""
    fresh = with_keys(results.where("ok").select("url").distinct())
    like = membership.held_keys(fresh, visited, "visit_key", filters)  # equal URLs have equal keys
    return fresh.join(visited.join(like, "visit_key", "left_semi").select("url"), "url", "left_anti")


def merge_visited(visited: DataFrame, results: DataFrame) -> DataFrame:
    return visited.unionByName(with_keys(results.where("ok").select("url"))).dropDuplicates(["url"])


def retry_first(failures: DataFrame, queue: DataFrame, visited: DataFrame, patterns: list[str], n: int) -> DataFrame:
    """Failed URLs to try again first: most failures, then earliest retry (as text), then URL; the top ``n``."""
    failed = with_keys(failures.select("url", "count", "next_retry_raw"))
    failed = failed.join(visited.select("visit_key").distinct(), "visit_key", "left_anti").where(~rules.denied(F.col("url"), patterns))
    order = [F.coalesce("count", F.lit(0)).desc(), F.coalesce("next_retry_raw", F.lit("")).asc(), F.col("url").asc()]
    return failed.orderBy(*order).limit(n).select("url", "visit_key", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("next_retry_raw", F.lit("")).alias("next_retry_raw"))


def promote(queue: DataFrame, first: DataFrame) -> DataFrame:
    """The queue with the retried URLs at its head, in their order."""
    order = Window.orderBy(F.col("count").desc(), "next_retry_raw", "url")
    head = first.withColumn("a", F.row_number().over(order)).select(F.lit(0).alias("part"), F.col("a").cast("long"), "url", "visit_key")
    rest = queue.join(first.select("url"), "url", "left_anti").select(F.lit(1).alias("part"), F.col("seq").alias("a"), "url", "visit_key")
    return renumber(head.unionByName(rest), "part", "a")
