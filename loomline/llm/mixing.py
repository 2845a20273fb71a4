"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Each source's share of the mix is proportional to its weight, but no more than
``max_epochs`` times its size.  What a clamped source leaves is shared among the
others by weight until no share is above its clamp.  Sorted by clamp / weight the
clamped sources come first, so running sums over the sources give the level that
the repeated redistribution ends at.

A source's target is taken as whole repetitions of all its documents, and the
rest as one more repetition of documents in the order of a seeded hash of their
ids.  The document in which the rest ends is repeated in part, so a source's
words come to its target, rounded to a word.  The order is cut by hash range:
per source and range only sums are compared, and single documents only in the
one range in which the rest ends.  So no task gets a whole source.

DataFrame functions only.  The one unpartitioned window has a row per source.

Cases: a null source is a source of its own, last in order; a null or empty text
has size 0 and is taken 0 times; a source without words has target 0; documents
with the same id and size share a place in the order and are interchangeable;
an empty table gives an empty one.  Other columns pass through under any name but one
that starts with ``__mix_``, as all added and internal names do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.llm import shared

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
#: Hex digits of the hash that make a range: 16 ** 3 ranges.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(shared.WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = SEED) -> DataFrame:
    """Adds each document's number of words, hash and hash range."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    out = docs.withColumn("__mix_size", word_count(F.col(text))).withColumn("__mix_key", key)
    return out.withColumn("__mix_range", F.substring("__mix_key", 1, RANGE_DIGITS))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target of the sources in ``sizes`` (source, source_size)."""
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place.cast("int") + 1)
    size = F.col("source_size").cast("double")
    out = sizes.withColumn("weight", weight).withColumn("clamp", size * max_epochs)
    before = Window.orderBy((F.col("clamp") / F.col("weight")).asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    room = F.sum(size).over(everything) * share - F.coalesce(F.sum("clamp").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    out = out.withColumn("level", room / heavy).withColumn("clamped", F.col("level") * F.col("weight") >= F.col("clamp"))
    final = F.max(F.when(~F.col("clamped"), F.col("level"))).over(everything)
    return out.withColumn("target", F.when(F.col("clamped"), F.col("clamp")).otherwise(final * F.col("weight"))).select("source", "source_size", "target")


def plan(docs: DataFrame, source: str = "source", **how) -> DataFrame:
    """Per source: its size, target, whole repetitions, and where the rest ends; written to the shared folder."""
    ranges = docs.groupBy(F.col(source).alias("source"), "__mix_range").agg(F.sum("__mix_size").alias("words"))
    ranges = shared.cut(ranges, "mix-ranges")
    goal = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), **how)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", whole)
    goal = goal.withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    upto = Window.partitionBy("source").orderBy("__mix_range")
    ends = ranges.withColumn("upto", F.sum("words").over(upto)).join(goal.withColumnRenamed("source", "goal_source"), F.col("source").eqNullSafe(F.col("goal_source")))
    ends = ends.where((F.col("upto") - F.col("words") < F.col("rest")) & (F.col("upto") >= F.col("rest")))
    ends = ends.select(F.col("goal_source").alias("end_source"), F.col("__mix_range").alias("end_range"), (F.col("rest") - F.col("upto") + F.col("words")).alias("end_words"))
    out = goal.join(ends, F.col("source").eqNullSafe(F.col("end_source")), "left").drop("end_source")
    return shared.cut(out.select(*[F.col(c).alias(f"__mix_{c}") for c in out.columns]), "mix-plan")


#: What ``mix`` adds to the columns of its input.
ADDED = ("__mix_size", "__mix_source_size", "__mix_target", "__mix_taken")


def mix(docs: DataFrame, planned: DataFrame, source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """Adds __mix_size, __mix_source_size, __mix_target and __mix_taken to the documents of ``sized``."""
    kept = [F.col(c) for c in docs.columns if not c.startswith("__mix_")]
    rows = docs.join(planned, F.col(source).eqNullSafe(F.col("__mix_source")))
    ends_here = F.coalesce(F.col("__mix_range") == F.col("__mix_end_range"), F.lit(False))
    more = F.when(F.col("__mix_range") < F.col("__mix_end_range"), F.col("__mix_size")).otherwise(F.lit(0))
    clear = rows.where(~ends_here).withColumn("__mix_more", more.cast("long"))
    order = Window.partitionBy(source).orderBy("__mix_key", doc_id, "__mix_size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("__mix_end_words") - F.coalesce(F.sum("__mix_size").over(order), F.lit(0))
    last = rows.where(ends_here).withColumn("__mix_more", F.greatest(F.lit(0), F.least("__mix_size", left)).cast("long"))
    taken = (F.col("__mix_whole") * F.col("__mix_size") + F.col("__mix_more")).alias("__mix_taken")
    return clear.unionByName(last).select(*kept, *ADDED[:3], taken)


def repeat(mixed: DataFrame) -> DataFrame:
    """One row for each repetition of a mixed document; parts round to the nearest whole."""
    times = F.when(F.col("__mix_size") > 0, F.round(F.col("__mix_taken") / F.col("__mix_size"))).otherwise(0).cast("int")
    return mixed.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(1), times))).drop("__mix_copy", *ADDED)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = shared.cut(sized(docs).drop("text"), "mix-sizes")
    return mix(rows, plan(rows)).select("doc_id", *[F.col(c).alias(c.removeprefix("__mix_")) for c in ADDED])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
             2.0::DOUBLE * source_size AS clamp FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY clamp / weight, source ASC NULLS LAST) AS rn FROM w),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s) - coalesce(sum(clamp) OVER b, 0))
             / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER b, 0)) AS level
      FROM r WINDOW b AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
             CASE WHEN level * weight >= clamp THEN clamp
                  ELSE (SELECT max(level) FROM l WHERE level * weight < clamp) * weight END AS target
      FROM l),
g AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
h AS (SELECT *, CAST(round(target - whole * source_size) AS BIGINT) AS rest FROM g),
c AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT c.doc_id, c.size, h.source_size, h.target,
       CAST(h.whole * c.size + greatest(0, least(c.size, h.rest - c.before)) AS BIGINT) AS taken
FROM c JOIN h ON c.source IS NOT DISTINCT FROM h.source
"""
