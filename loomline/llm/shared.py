"""Helpers that several corpus operators use."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: What separates words, as a Java and Python character class.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that a Python worker handles at once.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Local folders of sessions on one machine that name no shared folder, by application.
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine gets a temporary folder, as all its
    tasks see it; on a cluster that would be each machine's own, so it is an error.
    """
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if not path:
        app = spark.sparkContext.applicationId
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if app not in _local:
            _local[app] = tempfile.mkdtemp(prefix="loomline-")
        path = _local[app]
    return path.rstrip("/")


def cut(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    This cuts the lineage: a lost executor costs tasks, not the work before
    the table, and the planner knows the table's size.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


@contextmanager
def bucketed(df: DataFrame, name: str, part: str, bucket: str, buckets: int) -> Iterator[DataFrame]:
    """``df`` written to the shared folder in folders by ``part`` and buckets by ``bucket``, as a table that lasts as long as the context.

    Rows of one bucket are read by one task, so grouping by ``bucket`` needs no shuffle.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    path = f"{shared_dir(spark)}/{table}"
    df.write.option("path", path).option("compression", "zstd").partitionBy(part).bucketBy(buckets, bucket).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def observed_cut(df: DataFrame, name: str, *metrics: Column, **options: str) -> tuple[DataFrame, dict]:
    """``cut``, and aggregates of the rows, taken while they are written."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    out = cut(df.observe(seen, *metrics), name, **options)
    return out, seen.get


def discard(*tables: DataFrame) -> None:
    """Removes tables written by ``cut`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(df.cut_path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def map_arrow(df: DataFrame, work, schema) -> DataFrame:
    """``mapInArrow`` with batches of about ``SLICE_BYTES`` at most, so that long texts don't fill a worker.

    The bound is read when the result runs, so it stays with the session, which keeps a lower one of its own.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    held = re.fullmatch(r"(-?\d+)([kmg]?)b?", conf.get(name).lower())
    if held and not 0 < int(held[1]) << 10 * " kmg".index(held[2] or " ") <= SLICE_BYTES:
        conf.set(name, f"{SLICE_BYTES}b")
    return df.mapInArrow(work, schema)


def clash_free(df: DataFrame, *wanted: str) -> DataFrame:
    """Only the columns that an operator reads; others can't clash with its own."""
    return df.select(*wanted)


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def doc_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


# -- Arrow and numpy ------------------------------------------------------


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` bytes of ``column`` each."""
    sizes = np.asarray(pa.compute.binary_length(batch[column]).fill_null(0), dtype=np.int64)
    if not len(sizes):
        return
    part = (np.cumsum(sizes) - sizes) // limit
    ends = [*(np.flatnonzero(np.diff(part)) + 1), len(sizes)]
    start = 0
    for end in ends:
        yield batch.slice(start, end - start)
        start = end


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and the n + 1 offsets of the texts in them."""
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, *range(9, 14)]] = False


def word_array(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in order, and each text's number of words.

    A word is a maximal run of bytes other than 0x20 and 0x09 to 0x0D.
    """
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(offsets) - 1, np.int64)
    inside = _IN_WORD[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0] = after[-1] = False
    before[1:], after[:-1] = inside[:-1], inside[1:]
    bounds = offsets[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < len(data))]  # texts end words
    before[bounds], after[bounds - 1] = False, False
    begins, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after)
    counts = np.diff(np.searchsorted(begins, offsets))
    starts = runs(ends + 1 - begins)
    words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(starts), pa.py_buffer(data[inside])])
    return words, counts


def runs(counts: np.ndarray) -> np.ndarray:
    """Start offsets (n + 1) of consecutive runs of the given lengths."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def run_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each run; empty runs give 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing function, elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hashes of byte strings, the same on every executor."""
    import xxhash

    one = xxhash.xxh3_64_intdigest
    return np.fromiter((one(w) for w in words.to_pylist()), dtype=np.uint64, count=len(words))


class WordMemo:
    """Remembers a value for each distinct word, in bounded memory.

    ``make`` computes the values of a list of unseen words.  When more than
    ``limit`` words are held the memo starts anew; results don't depend on it.
    """

    def __init__(self, make, limit: int = 200_000):
        self.make, self.limit, self.held = make, limit, {}

    def __call__(self, words: list) -> list:
        held = self.held
        missing = [w for w in words if w not in held]
        if missing:
            fresh = dict(zip(missing, self.make(missing)))
            if len(held) + len(fresh) > self.limit:
                found = {w: held[w] for w in words if w in held}
                self.held = held = {}
                if len(fresh) <= self.limit:
                    held.update(fresh)
                return [fresh[w] if w in fresh else found[w] for w in words]
            held.update(fresh)
        return [held[w] for w in words]
