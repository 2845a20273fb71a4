"""Streaming form: fetched pages arrive in a folder, links and index follow batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomline.config import CrawlConfig
from loomline.functions import markdown as M
from loomline.functions import text as X
from loomline.functions import url as U
from loomline.operators import pages, rules
from loomline.sources import state as S


def links(stream: DataFrame, config: CrawlConfig, patterns: list[str]) -> DataFrame:
    """(source, url, visit_key) of the allowed links of a stream of pages (url, html)."""
    found = stream.select(F.col("url").alias("source"), F.explode(M.extract_links(M.anchors_to_markdown(F.col("html")), config)).alias("url"))
    return found.where(~rules.denied(F.col("url"), patterns)).withColumn("visit_key", U.visit_key(F.col("url")))


def run_index(spark: SparkSession, folder: str, root: str, config: CrawlConfig, now: str, checkpoint: str) -> StreamingQuery:
    """Upserts the page index under ``root`` with the pages of ``folder`` as they come.

    A generation is written per batch, with the batch's rows alone; a batch that is run again gives the same rows.
    """
    stream = spark.readStream.schema("page_id long, url string, html string").parquet(folder)

    def merge(batch: DataFrame, number: int) -> None:
        store = S.Generations(spark, root)
        title = X.normalize_title(F.regexp_extract("html", "(?is)<title>([^<]*)</title>", 1), X.page_slug(F.col("url")))
        name = X.page_filename(title, F.col("url"))
        rows = batch.select("url", title.alias("title"), X.short_summary(M.anchors_to_markdown(F.col("html")), config).alias("summary"), F.concat(F.lit("pages/"), name).alias("file_path"), name.alias("file_name"), F.lit(now).alias("fetched_at"))
        line = F.lit(0).cast("long").alias("line")
        none = spark.createDataFrame([], S.INDEX).select("*", line)
        store.save({}, {"index": pages.upsert(none, rows.select("*", line)).drop("line")})  # all other tables stay

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
