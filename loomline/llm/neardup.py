"""MinHash near-dedup on HyperMinHash registers.

A document's set holds the 64-bit hashes of its distinct 5-word shingles.  One
permutation deals the set into 128 buckets; a bucket's register keeps its minimum's
number of leading zeros (6 bits) and the 10 bits after the leading one.  An empty
bucket borrows the register of another by a fixed random probe.

1. Documents with equal sets make one class.  Classes, not documents, go on.
2. Bands of registers put classes into buckets: 25 bands of 5 from a similarity of
   0.85 on, 32 bands of 4 below.  They miss a pair at the threshold with a probability
   below one in a million (at 0.85, and at 0.8).
3. In each bucket, every class is paired with the one smallest class (a star, so a
   bucket of n classes has n - 1 pairs).  The collision-corrected Jaccard estimate
   drops pairs more than five standard errors below the threshold; the rest is
   confirmed on the full sets of whole texts, and the components are found.
4. Buckets that still hold several components are compared in full: the estimate
   is taken for all pairs across components inside a task of bounded size (large
   buckets, by classes or by shingles, are dealt into pairs of blocks), and the classes that have a partner left
   go in groups to exact confirmation, which returns one link for two components
   that it joins.  Pairs are never rows, and no link between different texts is lost
   to the size of a bucket.
5. The links found then join the components found before, as edges between their labels.

Class ids are 64 bits of a checksum of the set, and classes are told apart by it and the set's size.

Cases: a text that is null or has no word has an empty set, is linked with nothing
and is its own component.  A document without an id can't be named: its
component_id is null, kept is false and it takes no part in links.  Rows that repeat
an id with another text are judged text by text.  Repeated rows give repeated rows; an
empty table gives an empty one.  Only ``doc_id`` and ``text`` are read, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import shared
from loomline.llm.components import components

SHINGLE = 5
BUCKET_BITS = 7
REGISTERS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
PERCENT = 85
STANDARD_ERRORS = 5.0
#: Classes of a bucket, and shingles of their sets, that one task compares with as many others.
BLOCK, BLOCK_SHINGLES = 1000, 1 << 21


def shingle_sets(texts: pa.Array, percent_words: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and their starts (n + 1)."""
    data, offsets = shared.raw_bytes(texts)
    words, counts = shared.word_array(shared.lowered(data), offsets)
    n, total = len(counts), len(words)
    if not total:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    coded = words.dictionary_encode()
    hashed = shared.hash_words(coded.dictionary)[np.asarray(coded.indices)]
    starts = shared.runs(counts)
    width = percent_words
    h = np.zeros(total, dtype=np.uint64)
    short = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        ahead = max(total - k, 0)  # a slice may hold fewer words in all than a shingle has
        h[:ahead] = shared.mix64(h[:ahead] * np.uint64(0x9E3779B97F4A7C15) + hashed[k:])
        if k + 1 < width:  # texts of k + 1 words are one shingle
            whole = counts == k + 1
            short[whole] = shared.mix64(h[starts[:-1][whole]] + np.uint64(k + 1))
    out, sizes = [], np.zeros(n, np.int64)
    for i in np.flatnonzero(counts).tolist():
        a, b = starts[i], starts[i + 1]
        own = np.unique(h[a : b - width + 1]) if b - a >= width else short[i : i + 1]
        out.append(own)
        sizes[i] = len(own)
    return np.concatenate(out), shared.runs(sizes)


def _probes() -> np.ndarray:
    return np.random.default_rng(2017).integers(0, REGISTERS, (64, REGISTERS))


PROBES = _probes()


def registers(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """n by 128 registers of sorted sets; those of empty sets are 0."""
    n = len(starts) - 1
    owner = np.repeat(np.arange(n), np.diff(starts))
    mixed = flat
    slot = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    cell = owner * REGISTERS + slot
    first = np.flatnonzero(np.diff(cell, prepend=-1) != 0)  # sets are sorted: the minimum of each bucket
    rest = (mixed[first] << np.uint64(BUCKET_BITS)) | np.uint64(1 << (BUCKET_BITS - 1))
    zeros = 64 - np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    zeros = np.clip(zeros, 0, 56)
    mantissa = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    found = np.zeros(n * REGISTERS, dtype=np.int32)
    found[cell[first]] = (zeros << MANTISSA_BITS) + mantissa.astype(np.int64) + 1
    found = found.reshape(n, REGISTERS)
    out = found.copy()
    filled = np.diff(starts) > 0
    row, column = np.nonzero((out == 0) & filled[:, None])
    for probe in PROBES:
        if not len(row):
            break
        got = found[row, probe[column]]
        out[row, column] = got
        row, column = row[got == 0], column[got == 0]
    if len(row):
        out[row, column] = found[row, (found[row] > 0).argmax(axis=1)]
    return out.astype(np.uint16)


def checksums(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Order-free 64-bit checksums of the sets."""
    mixed = shared.mix64(flat ^ np.uint64(0xA5A5A5A55A5A5A5A))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return shared.mix64(total[starts[1:]] - total[starts[:-1]] + np.diff(starts).astype(np.uint64)).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of rows of registers."""
    chance = 2.0**-MANTISSA_BITS / 3
    return ((a == b).mean(axis=-1) - chance) / (1 - chance)


def least_estimate(na: np.ndarray, nb: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Estimates below this are out, ``STANDARD_ERRORS`` under the threshold; sizes alone can tell as well (2: never)."""
    t = percent / 100
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    error = np.sqrt(t * (1 - t) / np.clip(small, 1, REGISTERS))
    return np.where(100 * small >= percent * large, t - STANDARD_ERRORS * error, 2.0)


def signatures(rows: DataFrame) -> DataFrame:
    """key, n_shingles, cid (class) and regs of every key, text row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                flat, starts = shingle_sets(part["text"])
                regs = registers(flat, starts)
                fixed = pa.Array.from_buffers(pa.binary(), len(regs), [None, pa.py_buffer(np.arange(len(regs) + 1, dtype=np.int32) * 2 * REGISTERS), pa.py_buffer(np.ascontiguousarray(regs))])
                yield pa.RecordBatch.from_arrays([part["key"], pa.array(np.diff(starts)), pa.array(checksums(flat, starts)), fixed], ["key", "n_shingles", "cid", "regs"])

    return shared.map_arrow(rows.select("key", "text"), run, "key long, n_shingles long, cid long, regs binary")


def _registers_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)


def plausible(pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of pairs (a, b, na, nb, ra, rb) those whose estimate or sizes don't rule them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                na, nb = np.asarray(batch["na"]), np.asarray(batch["nb"])
                keep = estimate(_registers_of(batch["ra"]), _registers_of(batch["rb"])) >= least_estimate(na, nb, percent)
                yield pa.RecordBatch.from_arrays([batch[c].filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])

    return shared.map_arrow(pairs.select("a", "b", "na", "nb", "ra", "rb"), run, "a long, b long")


def confirmed(pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of pairs (a, b, ta, tb) those linked on the full sets of both texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "ta", shared.SLICE_BYTES // 2):
                distinct = part["ta"].dictionary_encode()
                fa, sa = shingle_sets(distinct.dictionary)
                fb, sb = shingle_sets(part["tb"])
                which = np.asarray(distinct.indices)
                keep = []
                for i in range(part.num_rows):
                    x, y = fa[sa[which[i]] : sa[which[i] + 1]], fb[sb[i] : sb[i + 1]]
                    both = len(x) + len(y) - len(np.union1d(x, y))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([part[c].filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    return shared.map_arrow(pairs.select("a", "b", "ta", "tb"), run, "a long, b long")


class Forest:
    """Union-find over small integers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows with equal keys, from sorted batches; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([np.asarray(batch[k], dtype=np.int64) for k in keys])
        ends = [*(np.flatnonzero((np.diff(values) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
        start = 0
        for end in ends:
            own = tuple(values[:, start].tolist())
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last, start = own, end
    if held:
        yield pa.Table.from_batches(held)


def open_groups(rows: pa.Table, percent: int = PERCENT) -> pa.RecordBatch:
    """Of a bucket's classes (or two blocks of them): those with a plausible partner in another component, in groups.

    Pairs with the bucket's center were confirmed or refuted before.  A group's id is a
    hash of its members, so that the same group found in several bands is one.
    """
    import xxhash

    cids = rows["cid"].to_numpy()
    order = np.unique(cids, return_index=True)[1]
    cids, n, label, side = cids[order], *(rows[c].to_numpy()[order] for c in ("n", "label", "block"))
    regs = _registers_of(rows["regs"].combine_chunks())[order]
    center, one_block = rows["center"][0].as_py(), rows["i"][0].as_py() == rows["j"][0].as_py()
    forest, touched = Forest(len(cids)), np.zeros(len(cids), bool)
    for x in range(len(cids)):
        if cids[x] == center:
            continue
        others = (label[x + 1 :] != label[x]) & (cids[x + 1 :] != center)
        if not one_block:
            others &= side[x + 1 :] != side[x]
        others = np.flatnonzero(others) + x + 1
        if len(others):
            fits = others[estimate(regs[others], regs[x]) >= least_estimate(n[others], n[x], percent)]
            if len(fits):
                touched[fits] = touched[x] = True
                for y in fits.tolist():
                    forest.join(x, y)
    found = np.flatnonzero(touched)
    roots = np.array([forest.find(x) for x in found.tolist()], dtype=np.int64)
    gids = np.zeros(len(found), np.int64)
    for root in np.unique(roots):
        own = roots == root
        gids[own] = np.uint64(xxhash.xxh3_64_intdigest(cids[found[own]].tobytes())).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(gids), pa.array(cids[found]), pa.array(label[found])], ["gid", "cid", "label"])


def group_links(rows: pa.Table, percent: int = PERCENT) -> pa.RecordBatch:
    """Links between the components of a group, confirmed on full sets: enough to connect what is connected."""
    cids, order = np.unique(rows["cid"].to_numpy(), return_index=True)
    labels = rows["label"].to_numpy()[order].tolist()
    flat, starts = shingle_sets(rows["text"].combine_chunks().take(pa.array(order)))
    m, sizes = len(cids), np.diff(starts)
    owner = np.repeat(np.arange(m), sizes)
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    useful = times[code] > 1
    owner, code = owner[useful], column[code[useful]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common, columns = np.zeros((m, m), dtype=np.float64), int((times > 1).sum())
    step = max(256, 8_000_000 // max(m, 1))
    for at in range(0, columns, step):
        a, b = np.searchsorted(code, [at, at + step])
        block = np.zeros((m, min(step, columns - at)), dtype=np.float32)
        block[owner[a:b], code[a:b] - at] = 1.0
        common += block @ block.T
    union = sizes[:, None] + sizes[None, :] - common
    forest, first = Forest(m), {}
    for x, label in enumerate(labels):
        forest.join(first.setdefault(label, x), x)
    linked = np.triu((100 * common >= percent * union) & (common > 0), 1)
    links = [(x, y) for x, y in zip(*(v.tolist() for v in np.nonzero(linked))) if forest.join(x, y)]
    return pa.RecordBatch.from_arrays([pa.array(cids[[k[i] for k in links]] if links else [], pa.int64()) for i in (0, 1)], ["a", "b"])


def in_groups(rows: DataFrame, keys: list[str], work, schema: str) -> DataFrame:
    """``work`` on every group of rows with equal keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, keys):
            out = work(group)
            if out.num_rows:
                yield out

    return shared.map_arrow(rows.repartition(*keys).sortWithinPartitions(*keys), run, schema)


def linked(rows: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Of key, text rows: (key, n_shingles, cid) of every row, and (cid, label) of every class; equal labels are linked.

    Rows without a key are signed, but make no class.
    """
    signed = shared.cut(signatures(rows), "signatures")
    classes = signed.where("key IS NOT NULL AND n_shingles > 0").groupBy("cid", F.col("n_shingles").alias("n"))
    classes = shared.cut(classes.agg(F.min("regs").alias("regs"), F.min("key").alias("rep")), "classes")

    # buckets with several classes
    size = 5 if percent >= 85 else 4
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("regs", 2 * size * k + 1, 2 * size)) for k in range(REGISTERS // size)])
    banded = classes.select("cid", "n", F.explode(keys).alias("key"))
    centers = banded.groupBy("key").agg(F.min("cid").alias("center"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("total")).where("m > 1")
    members = shared.cut(banded.drop("n").join(centers, "key"), "buckets")

    # whole texts of the classes in such buckets
    wanted = members.select("cid").distinct().join(classes.select("cid", "n", "rep"), "cid")
    texts = shared.cut(matching_texts(rows.join(wanted, rows.key == wanted.rep).select("cid", "n", "text")).dropDuplicates(["cid"]), "texts")

    # stars
    pairs = members.where("cid <> center").select(F.col("center").alias("a"), F.col("cid").alias("b")).distinct()
    left = classes.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    right = classes.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    likely = shared.cut(plausible(pairs.join(right, "b").join(left, "a"), percent), "likely")
    of_a, of_b = texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), texts.select(F.col("cid").alias("b"), F.col("text").alias("tb"))
    links = shared.cut(confirmed(likely.join(of_b, "b").join(of_a, "a"), percent), "links")
    labels = shared.cut(components(links).withColumnRenamed("node", "cid"), "labels")
    shared.discard(likely, links)

    # what the stars leave open
    labelled = members.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    labelled = shared.cut(labelled.where("m > 2"), "labelled")
    unsettled = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.least("m", F.ceil(F.col("total") / BLOCK_SHINGLES))).cast("int")
    open_rows = labelled.join(unsettled, "key").join(classes.select("cid", "n", "regs"), "cid").withColumn("block", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
    open_rows = open_rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    open_rows = open_rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    open_rows = open_rows.select("key", "i", "j", "block", "center", "cid", "n", "label", "regs")
    found = in_groups(open_rows, ["key", "i", "j"], lambda group: open_groups(group, percent), "gid long, cid long, label long")
    groups = shared.cut(found.distinct(), "groups")
    more = in_groups(groups.join(texts, "cid"), ["gid"], lambda group: group_links(group, percent), "a long, b long")

    # links between components found before are edges between their labels
    of = lambda end: labels.select(F.col("cid").alias(end), F.col("label").alias(f"label_{end}"))
    joined = more.join(of("a"), "a", "left").join(of("b"), "b", "left")
    joined = joined.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    merged = components(joined).toDF("label", "merged")
    named = classes.select("cid").join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    named = named.join(merged, "label", "left").select("cid", F.coalesce("merged", "label").alias("label"))
    out = signed.drop("regs"), shared.cut(named, "named")
    shared.discard(classes, members, texts, labelled, groups, labels)
    return out


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    signed, named = linked(docs.select(F.col(doc_id).cast("long").alias("key"), F.col(text).cast("string").alias("text")), percent)
    signed = signed.withColumnRenamed("key", "doc_id")
    some = signed.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("cid").agg(F.min("doc_id").alias("rep")).join(named, "cid")
    lowest = some.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_class = named.join(lowest, "label").select("cid", "component_id")
    out = signed.join(by_class, "cid", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def matching_texts(rows: DataFrame) -> DataFrame:
    """Of (cid, n, text) those whose text is of that class: keys may repeat with other texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                flat, starts = shingle_sets(part["text"])
                same = (checksums(flat, starts) == np.asarray(part["cid"])) & (np.diff(starts) == np.asarray(part["n"]))
                yield pa.RecordBatch.from_arrays([part[c].filter(pa.array(same)) for c in ("cid", "text")], ["cid", "text"])

    return shared.map_arrow(rows, run, "cid long, text string")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id, any of those if it repeats.

    Rows are told apart by a number of their own, so rows that repeat an id or have none are judged like all
    others (those without an id come last); rows with an empty set all stay.
    """
    numbered = shared.cut(docs.withColumn("__dup_row", F.monotonically_increasing_id()), "numbered")
    signed, named = linked(numbered.select(F.col("__dup_row").alias("key"), F.col(text).cast("string").alias("text")), percent)
    ids = numbered.select(F.col("__dup_row").alias("key"), F.col(doc_id).alias("id"))
    place = F.struct(F.col("id").isNull(), "id", "key")
    some = signed.where("n_shingles > 0").join(ids, "key")
    first = some.groupBy("cid").agg(F.min(place).alias("first")).join(named, "cid").groupBy("label").agg(F.min("first").alias("first"))
    dropped = some.join(named, "cid").join(first, "label").where(F.col("key") != F.col("first.key")).select(F.col("key").alias("__dup_key"))
    return numbered.join(dropped, F.col("__dup_row") == F.col("__dup_key"), "left_anti").select(docs.columns)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(shared.table(spark, sf_dir, "documents"))
