"""The upload: changed files in batches, one task each, progress kept after every batch."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators import upload
from loomline.sources import state as S
from loomline.sources.services import KnowledgeBase, ServiceError


def run(spark: SparkSession, paths: list[str], recursive: bool, extensions: list[str], progress_file: str, client: KnowledgeBase, now: str, files_per_task: int = 20) -> dict:
    """Totals of the upload.  A failed task fails its batch's files, and the run goes on.

    Files are fingerprinted once, into a table with their batches; a batch reads its own rows and the files'
    contents.  Its records are kept as a file of their own beside the progress file, and all are merged into
    that at the end, or when the next run begins.
    """
    folder, _, name = progress_file.rpartition("/")
    store = S.Store(spark, folder or ".")
    work, journal = f"{name}.work-{uuid.uuid4().hex}", f"{name}.batches"
    try:
        found = S.files(spark, paths, recursive)
        found = upload.of_extensions(found, extensions) if extensions else found
        found.write.parquet(f"{store.root}/{work}/found")
        found = spark.read.parquet(f"{store.root}/{work}/found")
        n_found = found.count()
        if not n_found:
            raise ValueError("no files to upload")
        progress = merged_journal(spark, store, progress_file, journal, now)
        upload.batches(upload.pending(found, progress), files_per_task).write.partitionBy("batch").parquet(f"{store.root}/{work}/plan")
        plan = spark.read.schema("path string, name string, sha256 string, size long, mtime_ns long, batch long").parquet(f"{store.root}/{work}/plan")
        n_todo = plan.count()
        out = {"total_candidates": n_found, "pending_files": n_todo, "skipped_files": n_found - n_todo, "batches": 0, "total_success": 0, "total_failed": 0, "failed_items": 0, "uploaded_files": 0, "failed_files": 0}
        if not n_todo:
            return out
        client.login()
        uploaded, failed_keys = set(), set()
        for number in range(-(-n_todo // files_per_task)):
            files = [tuple(r) for r in plan.where(f"batch = {number}").select("path", "name", "sha256", "size", "mtime_ns", "batch").orderBy("path").collect()]  # one task's files
            batch = spark.createDataFrame(files, "path string, name string, sha256 string, size long, mtime_ns long, batch long")
            try:
                failed = client.wait(client.start([f[0] for f in files], [store.read_bytes(f[0]) for f in files])).get("failed") or []
            except ServiceError as e:
                failed = [{"file_name": f[1], "error": str(e)} for f in files]
            reports = spark.createDataFrame([(number, i, x.get("file_name") or "", x.get("error") or "") for i, x in enumerate(failed)], "batch long, pos long, file_name string, error string")
            done = upload.merge_results(batch, reports, now).collect()
            records = [{k: v for k, v in r.asDict().items() if k != "batch"} for r in done]
            store.write(f"{journal}/{number:08d}-{work.rpartition('-')[2]}.jsonl", "\n".join(json.dumps(r, ensure_ascii=False) for r in records))
            bad = {r["path"] for r in done if r["status"] == "failed"}
            failed_keys = (failed_keys | bad) - ({r["path"] for r in done} - bad)
            uploaded |= {r["path"] for r in done} - bad
            out["batches"] += 1
            out["total_failed"] += len(bad)
            out["failed_items"] += len(failed)
            out["total_success"] += len(files) - len(bad)
        out |= {"uploaded_files": len(uploaded), "failed_files": len(failed_keys)}
        merged_journal(spark, store, progress_file, journal, now)
        return out
    finally:
        store.delete(work)


def merged_journal(spark: SparkSession, store: S.Store, progress_file: str, journal: str, now: str) -> DataFrame:
    """The progress with the records of finished batches, which it is written with; later files win."""
    progress = S.read_progress(spark, progress_file)
    if store.names(journal):
        place = F.input_file_name()
        rows = spark.read.schema(S.PROGRESS).json(f"{store.root}/{journal}").withColumn("place", place)
        columns = [c.split()[0] for c in S.PROGRESS.split(", ")]
        last = rows.groupBy("path").agg(F.max_by(F.struct(*columns), "place").alias("r")).select("r.*")
        progress = upload.merge_progress(progress, last)
    # the file is replaced below while the plan stands; as one JSON object it fits the driver
    progress = spark.createDataFrame(progress.collect(), S.PROGRESS)
    S.write_progress(progress, progress_file, now)
    store.delete(journal)
    return progress


def exit_status(totals: dict) -> int:
    return 2 if totals["total_failed"] else 0

