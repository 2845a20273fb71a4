"""Upload planning by fingerprint, batches, and merging of the results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions import text as X
from loomline.operators import frontier


def of_extensions(files: DataFrame, extensions: list[str], path: str = "path") -> DataFrame:
    """Files whose suffix is in the list, which is normalised first."""
    wanted = X.normalize_extensions(F.array(*[F.lit(e) for e in extensions])) if extensions else F.expr("cast(array() as array<string>)")
    return files.where(F.array_contains(wanted, X.extension(F.col(path))))


def pending(files: DataFrame, progress: DataFrame) -> DataFrame:
    """Files (path, sha256) that have no successful upload of the same content."""
    done = progress.where("status = 'success'").select("path", "sha256").distinct()
    return files.join(done, ["path", "sha256"], "left_anti")


def batches(files: DataFrame, size: int) -> DataFrame:
    """Adds ``batch``: consecutive groups of ``size`` files in path order, from 0."""
    if size <= 0:
        raise ValueError("a batch has at least one file")
    numbered = frontier.renumber(files.select(F.col("path").alias("url"), F.lit(None).cast("string").alias("visit_key")), "url")
    place = numbered.select(F.col("url").alias("path"), F.floor(F.col("seq") / size).cast("long").alias("batch"))
    return files.join(place, "path")


def merge_results(sent: DataFrame, reports: DataFrame, now: str) -> DataFrame:
    """Each sent file (path, name, batch, ...) with status, uploaded_at and error.

    A file failed if its name is among its batch's failures (batch, pos, file_name, error);
    the error is the first that isn't empty.
    """
    failed = reports.groupBy("batch", F.col("file_name").alias("name")).agg(F.min_by(F.when(F.col("error") != "", F.col("error")), F.when(F.col("error") != "", F.col("pos"))).alias("error"), F.lit(True).alias("hit"))
    out = sent.join(failed, ["batch", "name"], "left")
    bad = F.col("hit").isNotNull()
    return out.withColumn("status", F.when(bad, "failed").otherwise("success")).withColumn("uploaded_at", F.when(~bad, F.lit(now))).withColumn("last_attempt_at", F.lit(now)).drop("hit")


def merge_progress(progress: DataFrame, merged: DataFrame) -> DataFrame:
    """Progress records with those of the uploaded files replaced; others are kept."""
    columns = [c for c in progress.columns if c in merged.columns]
    return progress.join(merged.select("path"), "path", "left_anti").unionByName(merged.select(*columns), allowMissingColumns=True)


def totals(candidates: int, merged: DataFrame, n_pending: int, failed_items: int = 0) -> DataFrame:
    """One row of upload totals; ``failed_items`` are the failures that the tasks reported, files counted once each."""
    ok = F.col("status") == "success"
    return merged.agg(
        F.lit(candidates).cast("long").alias("total_candidates"), F.lit(n_pending).cast("long").alias("pending_files"), F.lit(candidates - n_pending).cast("long").alias("skipped_files"),
        F.count_distinct("batch").alias("batches"), F.count_if(F.col("status") == "success").alias("total_success"), F.count_if(F.col("status") == "failed").alias("total_failed"),
        F.lit(failed_items).cast("long").alias("failed_items"), F.count_distinct(F.when(ok, F.col("path"))).alias("uploaded_files"), F.count_distinct(F.when(~ok, F.col("path"))).alias("failed_files"),
    )
