"""N-gram Jaccard join by parity sketches.

A document's set holds the 64-bit hashes of its distinct 3-word shingles.  Two sets of
similarity t or more, the smaller of size s, differ in at most D = s (1 - t) / t of them.

Parity sketches.  A token sets one bit by exclusive or, so the exclusive or of two sketches
is the sketch of the symmetric difference, and their Hamming distance is at most its size.

1. Sets that are equal make one class.  Classes, not documents, go on.
2. Sizes are dealt into bands.  A band's sketch has D + 1 blocks for its largest size, each
   of 4,096 bits and written as a hash of the bits that are set.  Linked sets differ in D
   bits at most, so one block at least is equal (pigeonhole): blocks are the keys of an
   equi-join.  A set is sketched for its own band and for lower ones that hold the smaller
   partners it may have.  A block that no token fell into tells nothing: sets with such
   a block are sketched once more, with another hash, and only there it is a key.
3. Buckets with the same members are one.  In each, every class is paired with the
   smallest one (a star: n - 1 pairs).  A second sketch of about as many bits as the
   set has tokens (folded to the shorter of two) rules pairs out whose Hamming distance is
   above what their sizes allow; the rest is verified on the full sets of whole texts.
4. Buckets that still hold several components are compared in full, by tasks of bounded size
   (a bucket's blocks of 1,000 classes meet in pairs), on these sketches.  First a spanning forest of
   what they don't rule out is verified, then what that left open between components.
   No link between different texts that could join two components is left out.

Verification streams: the smaller class's text is sent once for each 256 partners, and
partners pass by one at a time.

Class ids are 64 bits of a checksum of the set, told apart by it and the set's size.

Cases: a text that is null or has no word has an empty set, is linked with nothing and is
its own component; with fewer than three words the whole sequence is one shingle.  A document
without an id can't be named: its component_id is null and it takes no part in links.  Rows that
repeat an id with another text are judged text by text.  Repeated rows give repeated rows; an
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
from loomline.llm.neardup import Forest, checksums, in_groups, shingle_sets

SHINGLE = 3
PERCENT = 90
#: Bits of a block, as a power of two.
BLOCK_BITS = 12
#: Largest set size that has a band; larger ones share the last.
LARGEST = 1 << 31
#: Classes of a bucket that one task compares with as many others.
BLOCK = 1000
#: Partners that one copy of a center's text is sent to.
PARTNERS = 256
SEEDS = tuple(np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0))


def band_starts() -> np.ndarray:
    """Least sizes of the bands: a quarter apart, from 1."""
    out = [1]
    while out[-1] < LARGEST:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4))
    return np.array(out, dtype=np.int64)


BANDS = band_starts()


def most_apart(small: np.ndarray, percent: int) -> np.ndarray:
    """Most tokens in which a set of this size and a larger one may differ."""
    return small * (100 - percent) // percent


def _spans(lengths: np.ndarray) -> np.ndarray:
    """0 … n - 1 for each length, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def block_keys(flat: np.ndarray, starts: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of every set, and the set of each key."""
    sizes = np.diff(starts)
    band = np.searchsorted(BANDS, sizes, side="right") - 1
    tops = np.append(BANDS[1:] - 1, LARGEST)
    lowest = np.searchsorted(tops * 100 // percent, sizes)  # the first band whose sets may have partners of this size
    keys, owners = [], []
    for down in range(int((band - lowest).max(initial=0)) + 1):
        sets = np.flatnonzero((sizes > 0) & (band - down >= lowest))
        blocks = most_apart(tops[band[sets] - down], percent) + 1
        salt = (band[sets] - down).astype(np.uint64) << np.uint64(40)
        for turn in (0, 1):
            n, first = sizes[sets], np.append(0, np.cumsum(blocks))
            at = np.repeat(starts[sets], n) + _spans(n)
            mixed = shared.mix64(flat[at] ^ SEEDS[turn])
            block = np.repeat(first[:-1], n) + ((mixed >> np.uint64(32)) % np.repeat(blocks, n).astype(np.uint64)).astype(np.int64)
            bits, times = np.unique((block << BLOCK_BITS) | (mixed & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64), return_counts=True)
            bits = bits[times % 2 == 1]
            held = np.bincount(block, minlength=first[-1])
            sums = np.zeros(first[-1] + 1, np.uint64)
            sums[1:] = np.cumsum(np.bincount(bits >> BLOCK_BITS, minlength=first[-1])).astype(np.uint64)
            total = np.append(np.uint64(0), np.cumsum(shared.mix64((bits & ((1 << BLOCK_BITS) - 1)).astype(np.uint64) + SEEDS[2]), dtype=np.uint64))
            ends = sums.astype(np.int64)
            words = total[ends[1:]] - total[ends[:-1]]
            owner = np.repeat(sets, blocks)
            place = np.repeat(salt, blocks) | np.uint64(turn << 39) | _spans(blocks).astype(np.uint64)
            found = shared.mix64(words ^ shared.mix64(place + SEEDS[2]))
            told = held > 0
            bare = np.add.reduceat(~told, first[:-1]) > 0 if len(sets) else np.zeros(0, bool)
            use = told if turn == 0 else np.ones(len(told), bool)
            keys.append(found[use].view(np.int64))
            owners.append(owner[use])
            sets, blocks, salt = sets[bare], blocks[bare], salt[bare]
            if not len(sets):
                break
    return (np.concatenate(keys), np.concatenate(owners)) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def sketches(flat: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """A parity sketch of each set: the least power of two of bits that is no smaller than it, 64 at least."""
    sizes = np.diff(starts)
    width = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    first = np.append(0, np.cumsum(width))
    bit = np.repeat(first[:-1], sizes) + (shared.mix64(flat ^ SEEDS[2]) & np.repeat(width - 1, sizes).astype(np.uint64)).astype(np.int64)
    odd = np.packbits(np.bincount(bit, minlength=first[-1]).astype(np.uint8) & 1, bitorder="little").tobytes()
    return [odd[a // 8 : b // 8] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) with fewer words, a power of two: what a shorter sketch of the same set holds."""
    while sketch.shape[-1] > size:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of rows of sketches: at most the size of the symmetric difference."""
    size = min(a.shape[-1], b.shape[-1])
    return np.bitwise_count(folded(a, size) ^ folded(b, size)).sum(axis=-1, dtype=np.int64)


def may_link(na: np.ndarray, nb: np.ndarray, distance: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether sets of these sizes whose sketches are so far apart can be linked."""
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    return (100 * small >= percent * large) & (distance * (100 + percent) <= (100 - percent) * (na + nb))


def signatures(rows: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """key, n_shingles and cid (class) of every key, text row, its sketch and its bucket keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text", shared.SLICE_BYTES // 4):
                flat, starts = shingle_sets(part["text"], width)
                keys, owners = block_keys(flat, starts, percent)
                order = np.argsort(owners, kind="stable")
                ends = np.searchsorted(owners[order], np.arange(len(starts))).astype(np.int32)
                buckets = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[order]))
                columns = [part["key"], pa.array(np.diff(starts)), pa.array(checksums(flat, starts)), pa.array(sketches(flat, starts), pa.binary()), buckets]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n_shingles", "cid", "sketch", "buckets"])

    return shared.map_arrow(rows.select("key", "text"), run, "key long, n_shingles long, cid long, sketch binary, buckets array<long>")


def _words(sketch: bytes) -> np.ndarray:
    return np.frombuffer(sketch, dtype=np.uint64)


def plausible(pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of pairs (a, b, na, nb, ra, rb) those that sizes and sketches don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = np.array([int(apart(_words(x), _words(y))) for x, y in zip(batch["ra"].to_pylist(), batch["rb"].to_pylist())], dtype=np.int64)
                keep = pa.array(may_link(np.asarray(batch["na"]), np.asarray(batch["nb"]), far, percent))
                yield pa.RecordBatch.from_arrays([batch[c].filter(keep) for c in ("a", "b")], ["a", "b"])

    return shared.map_arrow(pairs.select("a", "b", "na", "nb", "ra", "rb"), run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """Of pairs (a, b) those linked on the full sets of their texts (cid, text).

    A task holds one center ``a`` at a time, and its partners pass by.
    """
    often = pairs.groupBy(F.col("a").alias("of")).agg((F.count(F.lit(1)) / PARTNERS).cast("int").alias("more"))
    dealt = pairs.join(often, F.col("a") == F.col("of")).select("a", "b", F.pmod(F.xxhash64("b"), F.col("more") + 1).alias("salt"))
    text = lambda end: texts.select(F.col("cid").alias(end), "text")
    centers = dealt.select("a", "salt").distinct().join(text("a"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    rows = centers.unionByName(dealt.join(text("b"), "b").select("a", "salt", "b", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                flat, starts = shingle_sets(part["text"], width)
                of, partner = part["a"].to_pylist(), part["b"].to_pylist()
                a, b = [], []
                for i, (x, y) in enumerate(zip(of, partner)):
                    mine = flat[starts[i] : starts[i + 1]]
                    if y is None:
                        center, own = x, mine
                    elif x == center:
                        both = int(np.isin(mine, own, assume_unique=True).sum())
                        if 100 * both >= percent * (len(mine) + len(own) - both):
                            a.append(x)
                            b.append(y)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt_out = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return shared.map_arrow(dealt_out.select("a", "b", "text"), run, "a long, b long")


def open_pairs(rows: pa.Table, percent: int, spanning: bool) -> pa.RecordBatch:
    """Pairs of a bucket's classes (or of two blocks of them) in different components that sketches don't rule out.

    ``spanning``: only so many as join what they can join.
    """
    order = np.unique(rows["cid"].to_numpy(), return_index=True)[1]
    cids, n, label, side = (rows[c].to_numpy()[order] for c in ("cid", "n", "label", "block"))
    held = [_words(x) for x in rows["sketch"].combine_chunks().take(pa.array(order)).to_pylist()]
    least = min(len(x) for x in held)
    held = np.stack([folded(x, least) for x in held])
    center, one_block = rows["center"][0].as_py(), rows["i"][0].as_py() == rows["j"][0].as_py()
    forest, first, a, b = Forest(len(cids)), {}, [], []
    for x, of in enumerate(label.tolist()):
        forest.join(first.setdefault(of, x), x)
    for x in range(len(cids)):
        if cids[x] == center:  # compared with all before
            continue
        others = (label[x + 1 :] != label[x]) & (cids[x + 1 :] != center)
        if not one_block:
            others &= side[x + 1 :] != side[x]
        others = np.flatnonzero(others) + x + 1
        for y in others[may_link(n[others], n[x], apart(held[others], held[x]), percent)].tolist():
            if not spanning or forest.join(x, y):
                a.append(cids[x])
                b.append(cids[y])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (cid, label) after more links between classes; classes without a label are their own."""
    of = lambda end: labels.select(F.col("cid").alias(end), F.col("label").alias(f"of_{end}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    found = components(between)
    known = labels.join(found.toDF("old", "to"), F.col("label") == F.col("old"), "left")
    known = known.select("cid", F.coalesce("to", "label").alias("label"))
    fresh = found.join(labels.select(F.col("cid").alias("node")), "node", "left_anti").select(F.col("node").alias("cid"), "label")
    return known.unionByName(fresh)


def linked(rows: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Of key, text rows: (key, n_shingles, cid) of every row, and (cid, label) of every class with a link; equal labels are linked.

    Rows without a key are signed, but make no class.
    """
    signed = shared.cut(signatures(rows, percent, width), "parity-signatures")
    usable = signed.where("key IS NOT NULL AND n_shingles > 0")
    first = F.min(F.struct("key", "sketch", "buckets")).alias("first")
    classes = usable.groupBy("cid", F.col("n_shingles").alias("n")).agg(first).select("cid", "n", F.col("first.key").alias("rep"), "first.sketch", "first.buckets")
    classes = shared.cut(classes, "parity-classes")

    # buckets of several classes; those with the same members are one
    banded = classes.select("cid", F.explode("buckets").alias("key"))
    print_ = F.sum(F.xxhash64("cid").cast("decimal(38,0)"))
    several = banded.groupBy("key").agg(F.min("cid").alias("center"), F.count(F.lit(1)).alias("m"), print_.alias("members")).where("m > 1")
    several = several.groupBy("center", "m", "members").agg(F.min("key").alias("key")).drop("members")
    members = shared.cut(banded.join(several, "key"), "parity-buckets")

    # whole texts of the classes in such buckets
    wanted = members.select("cid").distinct().join(classes.select("cid", "n", "rep"), "cid")
    texts = shared.cut(_texts_of(rows.join(wanted, rows.key == wanted.rep).select("cid", "n", "text"), width).dropDuplicates(["cid"]), "parity-texts")

    # stars
    of = lambda end: classes.select(F.col("cid").alias(end), F.col("n").alias(f"n{end}"), F.col("sketch").alias(f"r{end}"))
    pairs = members.where("cid <> center").select(F.col("center").alias("a"), F.col("cid").alias("b")).distinct()
    likely = shared.cut(plausible(pairs.join(of("b"), "b").join(of("a"), "a"), percent), "parity-likely")
    links = shared.cut(verified(likely, texts, percent, width), "parity-links")
    labels = shared.cut(components(links).withColumnRenamed("node", "cid"), "parity-labels")
    refuted = likely.join(links, ["a", "b"], "left_anti")

    # what stars leave open: a spanning forest of it, then the rest of it
    for spanning in (True, False):
        labelled = members.where("m > 2").join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        labelled = shared.cut(labelled, "parity-labelled")
        unsettled = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
        blocks = F.ceil(F.col("m") / BLOCK).cast("int")
        parts = labelled.join(unsettled, "key").join(classes.select("cid", "n", "sketch"), "cid").withColumn("block", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
        parts = parts.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        parts = parts.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
        parts = parts.select("key", "i", "j", "block", "center", "cid", "n", "label", "sketch")
        found = in_groups(parts, ["key", "i", "j"], lambda group, s=spanning: open_pairs(group, percent, s), "a long, b long").distinct()
        asked = shared.cut(found.join(refuted, ["a", "b"], "left_anti"), "parity-open")
        more = shared.cut(verified(asked, texts, percent, width), "parity-more")
        labels = shared.cut(_merged(labels, more), "parity-labels")
        refuted = refuted.unionByName(asked.join(more, ["a", "b"], "left_anti"))
        shared.discard(labelled)
    shared.discard(classes, members, texts)
    return signed.drop("sketch", "buckets"), labels


def _texts_of(rows: DataFrame, width: int) -> DataFrame:
    """Of (cid, n, text) those whose text is of that class: keys may repeat with other texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                flat, starts = shingle_sets(part["text"], width)
                same = pa.array((checksums(flat, starts) == np.asarray(part["cid"])) & (np.diff(starts) == np.asarray(part["n"])))
                yield pa.RecordBatch.from_arrays([part[c].filter(same) for c in ("cid", "text")], ["cid", "text"])

    return shared.map_arrow(rows, run, "cid long, text string")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    signed, labels = linked(docs.select(F.col(doc_id).cast("long").alias("key"), F.col(text).cast("string").alias("text")), percent, width)
    of = signed.where("key IS NOT NULL AND n_shingles > 0").groupBy("cid").agg(F.min("key").alias("rep"))
    of = of.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    lowest = of.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_class = of.join(lowest, "label").select("cid", "component_id")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("key"))
    out = signed.join(by_class, "cid", "left")
    return out.select(F.col("key").alias("doc_id"), "n_shingles", F.when(F.col("key").isNotNull(), component).alias("component_id"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(shared.table(spark, sf_dir, "documents"))
