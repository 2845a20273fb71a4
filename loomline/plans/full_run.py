"""A crawl, an upload if one is wanted, and the message about both."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import SparkSession

from loomline.operators import stats
from loomline.plans.crawl import RunStats


def run(spark: SparkSession, crawl: Callable[[], RunStats], upload: Callable[[], dict] | None, notify: Callable[[str, str], object], model: str, now: str, notify_on_failure: bool = False) -> str:
    """The message of a run that went well, which is also sent.

    A failed run sends its message only if asked, and raises its error again.  If the crawl
    itself fails its counters are zero; failed uploads count as a failed run, with both messages.
    """
    done, text = RunStats(), None
    try:
        done = crawl()
        text = _about(spark, done, model, "success", "", now)
        if upload is not None:
            totals = upload()
            text = f"{text}\n\n{stats.render(spark, totals, stats.upload_message())}"
            if totals["total_failed"]:
                raise RuntimeError(f"{totals['total_failed']} uploads failed")
        notify("crawl done", text)
        return text
    except Exception as e:
        if notify_on_failure:
            notify("crawl failed", _about(spark, done, model, "failed", str(e), now))
        raise


def _about(spark: SparkSession, done: RunStats, model: str, status: str, error: str, now: str) -> str:
    values = {k: v for k, v in dataclasses.asdict(done).items() if k != "generations"}
    return stats.render(spark, values | {"model": model, "status": status, "error": error, "at": now}, stats.run_message())
