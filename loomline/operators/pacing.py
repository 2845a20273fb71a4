"""Rate limiting: the schedule as a table, the limiter itself, and changed progress lines."""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.sources.state import shared_folder


def schedule(arrivals: DataFrame, key: str | None, order: list[str], at: str, gap: int) -> DataFrame:
    """Adds ``start``: arrivals (in units of ``at``) start no sooner than ``gap`` after the one before.

    start_i = i * gap + max over j <= i of (arrival_j - j * gap), as one running maximum per limiter.  Without a key all
    arrivals are one limiter's: they are written by range of ``order``, a range counts and takes its maximum on its own, and
    only one row for each range is summed up in one place.
    """
    if key:
        by = Window.partitionBy(key).orderBy(*order)
        out = arrivals.withColumn("__i", F.row_number().over(by).cast("long") - 1)
        slack = F.max(F.col(at) - F.col("__i") * gap).over(by.rowsBetween(Window.unboundedPreceding, 0))
        return out.withColumn("start", F.col("__i") * gap + slack).drop("__i")
    spark = arrivals.sparkSession
    work = f"{shared_folder(spark)}/ranged-{uuid.uuid4().hex}"
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = arrivals.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__part": F.spark_partition_id(), "__at": place})
    ranged.write.parquet(work)
    ranged = spark.read.schema(ranged.schema).parquet(work)
    ranges = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.max(F.col(at) - F.col("__at") * gap).alias("__most"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__first", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    ranges = ranges.withColumn("__before", F.max(F.col("__most") - F.col("__first") * gap).over(before)).drop("__n", "__most")
    out = ranged.join(ranges, "__part").withColumn("__i", F.col("__first") + F.col("__at"))
    within = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    slack = F.greatest(F.max(F.col(at) - F.col("__i") * gap).over(within), "__before")
    return out.withColumn("start", F.col("__i") * gap + slack).select(*arrivals.columns, "start")


def changed_lines(lines: DataFrame, key: str, order: list[str], line: str = "line") -> DataFrame:
    """The rows whose line isn't the one before it."""
    before = F.lag(line).over(Window.partitionBy(key).orderBy(*order))
    return lines.withColumn("__before", before).where(F.col("__before").isNull() | (F.col("__before") != F.col(line))).drop("__before")


class Limiter:
    """Lets ``wait`` return at most ``qps`` times a second; 0 or less doesn't limit."""

    def __init__(self, qps: float):
        self.gap = 1 / qps if qps > 0 else 0.0
        self.next = 0.0
        self.lock = threading.Lock()

    def wait(self) -> None:
        if not self.gap:
            return
        with self.lock:
            now = time.monotonic()
            start = max(now, self.next)
            self.next = start + self.gap
        time.sleep(max(0.0, start - now))
