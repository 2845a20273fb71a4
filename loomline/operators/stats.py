"""Run statistics and the messages about a run."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: The messages' labels, with the columns that they show.
RUN_LINES = (
    ("状态", "status"), ("模型", "model"), ("扫描", "scanned"), ("抓取成功", "fetched"), ("抓取失败", "failed"), ("重试延后", "deferred"),
    ("已访问总量", "visited_total"), ("失败总量", "failed_total"), ("队列剩余", "queue_size"), ("LLM成功", "llm_success"), ("LLM回退", "llm_fallback"),
    ("LLM缓存命中", "llm_cache_hit"), ("入队过滤", "filtered"), ("LLM prompt_tokens", "prompt_tokens"), ("LLM completion_tokens", "completion_tokens"), ("LLM total_tokens", "total_tokens"),
)
UPLOAD_LINES = (("候选文件", "total_candidates"), ("待上传", "pending_files"), ("已跳过", "skipped_files"), ("任务数", "batches"), ("成功", "total_success"), ("失败", "total_failed"))
COUNTERS = tuple(c for _, c in RUN_LINES[2:])


def _lines(lines) -> list[Column]:
    return [F.concat(F.lit(f"{label}: "), F.coalesce(F.col(c).cast("string"), F.lit("0"))) for label, c in lines]


def run_message(error: str = "error", at: str = "at") -> Column:
    """The run's message of a row with the counters, ``status`` and ``model``."""
    wrong = F.when(F.coalesce(F.col(error), F.lit("")) != "", F.concat(F.lit("错误: "), F.col(error)))
    return F.concat_ws("\n", *_lines(RUN_LINES), wrong, F.concat(F.lit("时间: "), F.col(at)))


def upload_message(failed_items: str = "failed_items") -> Column:
    more = F.when(F.coalesce(F.col(failed_items), F.lit(0)) > 0, F.concat(F.lit("失败条目: "), F.col(failed_items).cast("string")))
    return F.concat_ws("\n", F.lit("知识库上传完成"), *_lines(UPLOAD_LINES), more)


def combined_message(run: Column, upload: Column | None) -> Column:
    return run if upload is None else F.when(upload.isNull(), run).otherwise(F.concat(run, F.lit("\n\n"), upload))


def render(spark: SparkSession, values: dict, message: Column) -> str:
    """A message over one row of values."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(message).first()[0]
