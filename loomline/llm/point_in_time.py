"""Point-in-time join: which version of a key was usable, and the latest, when a row asks for it.

A version is usable from the later of its event and its arrival up to, but not at, its
expiry.  Times are whole numbers.  Usable intervals are exploded into fixed bins whose
widths are powers of two: the fewest bins that cover an interval exactly, at most two
of each width below the widest.  In each (key, bin) only the winner goes on, the
greatest ordered struct (event, then earliest arrival, then largest id), found by a
partial aggregate before the shuffle.  An ask explodes into the one bin of each width
that holds its time, is equi-joined on key and bin, filtered exactly, and takes the
greatest struct of what it met.

So no pairs arise: a bin hands on one row, whatever the number of versions of a hot key
in it, and a (key, time) is asked once, whatever the number of rows that ask it.  Work
grows as versions times the logarithm of an interval's length.  A hot key is spread by
bin and time.  All joins are sort-merge joins: nothing that grows is broadcast or sent
to the driver.  DataFrame functions only.

Cases: versions with a null key, event, arrival or expiry, or an empty interval, are never
usable; asks with a null key or time have no winner (they are spread by partition, so
that they don't meet in one task); versions that tie in event, arrival and id are told
apart by what is carried, greatest first, so that repeated versions give one winner;
repeated asks give repeated rows; a null id is below all others.  Empty asks give an empty
table, empty versions no winners.  Columns of the asks pass through under any name but one
that starts with ``__pit_``, as all added and internal names do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import shared

#: Widths of bins: 1, 2, 4 … 2 ** (WIDTHS - 1) time units.  Longer intervals take several of the widest.
WIDTHS = 10
STALE_AFTER = 120


def covering_bins(start: Column, end: Column, widths: int = WIDTHS) -> Column:
    """The fewest bins (width: a power of two, bin) that cover [start, end) exactly."""

    def one(width: int, bin_: Column) -> Column:
        return F.struct(F.lit(width).alias("width"), bin_.cast("long").alias("bin"))

    out = []
    for k in range(widths - 1):
        first, last = F.shiftright(start + (2**k - 1), k), F.shiftright(end, k)  # bins of this width inside, last exclusive
        open_ = first < last
        out.append(F.when(open_ & (first.bitwiseAND(F.lit(1)) == 1), one(k, first)))
        out.append(F.when(open_ & (last.bitwiseAND(F.lit(1)) == 1), one(k, last - 1)))
    top = widths - 1
    first, last = F.shiftright(start + (2**top - 1), top), F.shiftright(end, top)
    wide = F.when(first < last, F.transform(F.sequence(first, last - 1), lambda b: one(top, b))).otherwise(F.array().cast("array<struct<width:int,bin:bigint>>"))
    return F.concat(F.array_compact(F.array(*out)), wide)


def look_up(rows: DataFrame, table: DataFrame, on: dict[str, str]) -> DataFrame:
    """``rows`` with the one row of ``table`` whose columns equal theirs (rows' column: table's column), if any; its key columns are dropped.

    Rows with a null key match nothing and are spread by partition.
    """
    lost = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    left = rows.withColumn("__pit_spread", F.when(lost, F.spark_partition_id() + 1).otherwise(0))
    right = table.withColumn("__pit_own", F.lit(0))
    same = F.col("__pit_spread") == F.col("__pit_own")
    for a, b in on.items():
        same &= F.col(a) == F.col(b)
    return left.join(right.hint("merge"), same, "left").drop("__pit_spread", "__pit_own", *on.values())


def latest_usable(
    asks: DataFrame, versions: DataFrame, key: str = "source", at: str = "t",
    event: str = "event", arrival: str = "arrival", expiry: str = "expiry", version_id: str = "doc_id", carry: tuple[str, ...] = (), widths: int = WIDTHS,
) -> DataFrame:
    """Adds ``__pit_winner`` to the asks: a struct of event, early (arrival, negated), id, expiry and row (``carry``), or null.

    ``key`` is a column of both; the others but ``at`` are the versions', times of type long.
    """
    span = versions.select(
        F.col(key).alias("__pit_key"),
        *[F.col(c).cast("long").alias(f"__pit_{n}") for n, c in (("event", event), ("arrival", arrival), ("expiry", expiry))],
        F.col(version_id).alias("__pit_id"),
        F.struct(F.lit(0).alias("__pit_none"), *[F.col(c) for c in carry]).alias("__pit_row"),
    ).dropna(subset=["__pit_key", "__pit_event", "__pit_arrival", "__pit_expiry"])
    start, end = F.greatest("__pit_event", "__pit_arrival"), F.col("__pit_expiry")
    best = F.struct(*[c.alias(n) for n, c in (("event", F.col("__pit_event")), ("early", -F.col("__pit_arrival")), ("id", F.col("__pit_id")), ("expiry", end), ("row", F.col("__pit_row")))])
    binned = span.where(start < end).select("__pit_key", F.explode(covering_bins(start, end, widths)).alias("__pit_bin"), best.alias("__pit_best"))
    bins = binned.groupBy("__pit_key", F.col("__pit_bin.width").alias("__pit_width"), F.col("__pit_bin.bin").alias("__pit_n")).agg(F.max("__pit_best").alias("__pit_best"))

    t = F.col("__pit_t")
    points = asks.select(F.col(key).alias("__pit_key"), F.col(at).cast("long").alias("__pit_t")).dropna().distinct()
    holding = F.array(*[F.struct(F.lit(k).alias("width"), F.shiftright(t, k).alias("bin")) for k in range(widths)])
    probes = points.select("__pit_key", "__pit_t", F.explode(holding).alias("__pit_bin"))
    probes = probes.select("__pit_key", "__pit_t", F.col("__pit_bin.width").alias("__pit_width"), F.col("__pit_bin.bin").alias("__pit_n"))
    met = probes.join(bins.hint("merge"), ["__pit_key", "__pit_width", "__pit_n"])
    best = F.col("__pit_best")
    met = met.where((best["event"] <= t) & (-best["early"] <= t) & (t < best["expiry"]))
    won = met.groupBy("__pit_key", "__pit_t").agg(F.max("__pit_best").alias("__pit_winner"))
    rows = asks.withColumn("__pit_at", F.col(at).cast("long"))
    return look_up(rows, won, {key: "__pit_key", "__pit_at": "__pit_t"}).drop("__pit_at")


def dealt(doc_id: Column, group: int) -> Column:
    """The unsigned integer of one eight-digit group of the hex sha256 of the decimal id."""
    return F.conv(F.substring(F.sha2(doc_id.cast("string"), 256), 8 * group + 1, 8), 16, 10).cast("long")


def op12_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per label.  An id that repeats in the documents asks about its smallest source."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "lang")
    doc = F.col("doc_id")
    event = dealt(doc, 0) % 50000
    versions = docs.select(
        "doc_id", "source", "n_chars", "lang", event.alias("event"), (event - 60 + dealt(doc, 1) % 600).alias("arrival"), (event + dealt(doc, 2) % 900).alias("expiry")
    )
    sources = docs.groupBy(doc.alias("known_id")).agg(F.min("source").alias("source"))
    labels = shared.table(spark, sf_dir, "labels").select("doc_id", (dealt(doc, 3) % 50000).alias("t"))
    asks = look_up(labels, sources, {"doc_id": "known_id"})
    out = latest_usable(asks, versions, carry=("n_chars", "lang"))
    won = F.col("__pit_winner")
    age = F.col("t") - won["event"]
    fresh = won.isNotNull() & (age <= STALE_AFTER)
    status = F.when(won.isNull(), "none").when(fresh, "fresh").otherwise("stale")
    carried = [F.when(fresh, won["row"][c]).alias(c) for c in ("n_chars", "lang")]
    return out.select("doc_id", "t", won["id"].alias("version_id"), age.alias("age"), status.alias("status"), *carried)


ORACLE = """
WITH h AS (SELECT doc_id, source, n_chars, lang, sha256(CAST(doc_id AS VARCHAR)) AS x FROM documents),
v AS (SELECT doc_id, source, n_chars, lang, CAST('0x' || substr(x, 1, 8) AS BIGINT) % 50000 AS event,
             CAST('0x' || substr(x, 9, 8) AS BIGINT) % 600 - 60 AS late, CAST('0x' || substr(x, 17, 8) AS BIGINT) % 900 AS life FROM h),
s AS (SELECT doc_id, min(source) AS source FROM documents GROUP BY doc_id),
a AS (SELECT row_number() OVER () AS ask, l.doc_id, s.source, CAST('0x' || substr(sha256(CAST(l.doc_id AS VARCHAR)), 25, 8) AS BIGINT) % 50000 AS t
      FROM labels l LEFT JOIN s ON l.doc_id = s.doc_id),
w AS (SELECT a.ask, v.*, row_number() OVER (PARTITION BY a.ask ORDER BY v.event DESC, v.event + v.late, v.doc_id DESC) AS place
      FROM a JOIN v ON a.source = v.source AND v.event <= a.t AND v.event + v.late <= a.t AND a.t < v.event + v.life)
SELECT a.doc_id, a.t, w.doc_id AS version_id, a.t - w.event AS age,
       CASE WHEN w.doc_id IS NULL THEN 'none' WHEN a.t - w.event > 120 THEN 'stale' ELSE 'fresh' END AS status,
       CASE WHEN a.t - w.event <= 120 THEN w.n_chars END AS n_chars, CASE WHEN a.t - w.event <= 120 THEN w.lang END AS lang
FROM a LEFT JOIN w ON a.ask = w.ask AND w.place = 1
"""
