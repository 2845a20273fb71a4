"""Cross-tokenizer alignment: where the tokens of two vocabularies end together, and which ids they pair.

Both vocabularies cut a text at a space after something that is no white space, so a text is
a sequence of segments (a space and what follows), and tokens, groups and links of a text are
those of its segments in order.  The relational work is done once for each distinct segment
of the corpus:

1. texts become runs of segment numbers, in units of 32 MB of text with a table of the unit's distinct
   segments and how often each occurs; a grouping gives each distinct segment its places (unit, number);
2. each distinct segment is encoded by both libraries (Arrow), and then stays relational:
   tokens of both sides are exploded with their positions, their ends are windowed running sums
   of their byte lengths, tokens of both sides with equal ends are neighbours in a window by end,
   which gives the links and with them the cuts, and the running count of cuts before a token is
   its group;
3. an id pair's count sums its links times the segments' occurrences; joins bring each
   link its pair's count and the highest one of its B id, summed by segment;
4. what a segment tells goes to its places, one row for each, and a unit's texts are put together in
   their order.

A vocabulary of another kind, or one that joins tokens over such spaces, gets whole texts as segments.

What grows is shuffled as rows of segments: a segment that a third of the words are comes once
for each unit.  A unit holds the segments of 32 MB of text (or of one longer text) and is one task's group.

Cases: a text that is null, empty, or whose tokens' bytes don't join to a space and the text (it
holds the format's own space mark, say) has no tokens: all counts are 0, groups is empty and it adds
nothing to counts of pairs.  Strings of special tokens are plain text.  Repeated rows give repeated rows
and count as often; an empty table gives an empty one.  Of the other columns only ``keep``
(``doc_id``) is carried, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm import shared, sp_model
from loomline.llm.sp_unigram import gather_runs

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
UNIT_BYTES = 32 << 20
#: So many segments are encoded as one text.
TOGETHER = 64
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1 for itself, the others from U+0100 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def cuttable(data: np.ndarray) -> np.ndarray:
    """The spaces before which any text ends tokens of both vocabularies: those after something that is no white space."""
    last, second, third = (np.concatenate([np.zeros(k, np.uint8), data[:-k]]) for k in (1, 2, 3))
    # of more bytes than one: not where the character may be white space or the space mark
    odd = (second == 0xC2) | (third == 0xE2) | ((third == 0xE3) & (second == 0x80)) | ((third == 0xE1) & (second == 0x9A))
    return (data == 32) & (((last > 32) & (last < 127)) | ((last >= 128) & ~odd))


def cut_segments(texts: pa.Array, split: bool = True) -> tuple[pa.Array, np.ndarray]:
    """The segments of all texts in order, without the space before each, and each text's number of them."""
    data, offsets = shared.raw_bytes(texts)
    n = len(data)
    cut = np.zeros(n, dtype=bool)
    if split and n > 2:
        cut = cuttable(data)
        edge = np.concatenate([offsets[:-1], offsets[1:] - 1])
        cut[edge[(edge >= 0) & (edge < n)]] = False
    filled = np.diff(offsets) > 0
    seen = shared.runs(cut)
    counts = np.diff(seen[offsets]) + filled
    left = np.arange(n + 1) - seen
    at = np.sort(np.concatenate([offsets[:-1][filled], np.flatnonzero(cut) + 1]))
    starts = np.append(left[at], left[-1]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(starts), pa.py_buffer(data[~cut])]), counts


def packed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in seven bits a byte, least first (the high bit says that more follow), and where each of them begins.

    A unit numbers its segments as they first come, so that frequent ones tend to take one byte.
    """
    numbers = numbers.astype(np.int64)
    sizes = 1 + sum((numbers >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    starts = shared.runs(sizes)
    out = np.zeros(starts[-1], np.uint8)
    for k in range(5):
        has = sizes > k
        out[starts[:-1][has] + k] = (numbers[has] >> 7 * k & 127) | ((sizes[has] > k + 1) << 7)
    return out, starts


def unpacked(data: bytes | np.ndarray) -> np.ndarray:
    """The numbers that ``packed`` wrote, of one text or of several one after the other."""
    held = np.frombuffer(data, np.uint8)
    if not len(held):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(held < 128) + 1
    starts = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(held)) - np.repeat(starts, ends - starts)
    return np.add.reduceat((held & 127).astype(np.int64) << 7 * place, starts)


def in_units(df: DataFrame, text: str, keep: str, split: bool, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Rows of words (unit, i, word, times) and of texts (unit, keep, parts: the ``packed`` numbers i of its segments)."""
    read = df.select(F.col(keep).alias("keep"), F.col(text).cast("string").alias("text"))
    out = ["unit", "i", "word", "times", "keep", "parts"]
    fields = [("unit", T.LongType()), ("i", T.IntegerType()), ("word", T.StringType()), ("times", T.LongType()), ("keep", read.schema["keep"].dataType), ("parts", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, known, times = TaskContext.get().partitionId() << 32, 0, {}, np.zeros(0, np.int64)

        def words_of_unit() -> Iterator[pa.RecordBatch]:
            n, words = len(known), list(known)
            for at in range(0, n, 50_000):
                some = words[at : at + 50_000]
                k = len(some)
                columns = [pa.array(np.full(k, unit)), pa.array(np.arange(at, at + k, dtype=np.int32)), pa.array(some, pa.binary()).cast(pa.string()), pa.array(times[at : at + k]), pa.nulls(k, keep_type), pa.nulls(k, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, out)

        keep_type = pa.null()
        for batch in batches:
            keep_type = batch["keep"].type
            for part in shared.by_bytes(batch, "text", shared.SLICE_BYTES // 4):
                segments, counts = cut_segments(part["text"], split)
                coded = segments.dictionary_encode()
                own = np.array([known.setdefault(w, len(known)) for w in coded.dictionary.to_pylist()], dtype=np.int32)
                numbers = own[np.asarray(coded.indices)] if len(segments) else np.zeros(0, np.int32)
                times = np.concatenate([times, np.zeros(len(known) - len(times), np.int64)]) + np.bincount(numbers, minlength=len(known))
                coded, starts = packed(numbers)
                ends = starts[shared.runs(counts)].astype(np.int32)
                parts = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(coded)])
                k = len(counts)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, unit)), pa.nulls(k, pa.int32()), pa.nulls(k, pa.string()), pa.nulls(k, pa.int64()), part["keep"], parts], out)
                held += int(pa.compute.sum(pa.compute.binary_length(part["text"])).as_py() or 0)
                if held >= unit_bytes:
                    yield from words_of_unit()
                    unit, held, known, times = unit + 1, 0, {}, np.zeros(0, np.int64)
        if known:
            yield from words_of_unit()

    return shared.map_arrow(read, run, T.StructType([T.StructField(*f) for f in fields]))


class Side:
    """One vocabulary: the ids of texts' tokens, and the bytes that each id stands for."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], entries: list[bytes]):
        self.encode, self.sizes = encode, np.array([len(x) for x in entries], dtype=np.int64)
        self.starts, self.spelled = shared.runs(self.sizes), np.frombuffer(b"".join(entries), np.uint8)

    def __call__(self, texts: list[str], data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the texts' tokens in order, where in ``data`` they end, and which texts they spell; only those have tokens."""
        ids = self.encode(texts)
        counts = np.array([len(x) for x in ids], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(ids), np.int64, counts.sum())
        text_of, starts, total = np.repeat(np.arange(len(texts)), counts), shared.runs(counts), shared.runs(self.sizes[flat])
        ends = total[1:] + (bounds[:-1] - total[starts[:-1]])[text_of]
        fits = np.diff(total[starts]) == np.diff(bounds)
        byte_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
        here = fits[byte_of]
        said, _ = gather_runs(self.spelled, self.starts, flat[fits[text_of]])
        fits[byte_of[here][said != data[here]]] = False
        kept = fits[text_of]
        return flat[kept], ends[kept], fits


def spelled(sides: list[Side], data: np.ndarray, bounds: np.ndarray, together: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Which words are made of whole tokens of both sides, and each side's ids and numbers of these words' tokens; so many words are encoded as one text."""
    n = len(bounds) - 1
    if not n:
        return np.zeros(0, bool), [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(sides)
    edges = np.append(bounds[:-1:together], bounds[-1])
    raw = data.tobytes()
    texts = [raw[i:j].decode() for i, j in zip(edges.tolist(), edges[1:].tolist())]
    ok, found = np.ones(n, bool), []
    for side in sides:
        flat, ends, fits = side(texts, data, edges)
        stops = np.zeros(len(data) + 1, bool)
        stops[ends] = stops[edges] = True
        ok &= np.repeat(fits, together)[:n] & stops[bounds[:-1]] & stops[bounds[1:]]
        found.append((flat, np.searchsorted(bounds, ends) - 1))
    return ok, [(flat[ok[word_of]], np.bincount(word_of[ok[word_of]], minlength=n)) for flat, word_of in found]


def encoded(words: DataFrame, a_path: str, b_path: str, split: bool = True) -> DataFrame:
    """times, places, good, n_a, and the ids and sizes in bytes of the tokens of a space and the word, those of a and then those of b; none if not good.

    Words after which any text may be cut are encoded many at once, as one text; those whose tokens don't come apart again, and all others, one by one.
    """
    out = ["times", "places", "good", "n_a", "ids", "sizes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        first = tokenizers.Tokenizer.from_file(a_path)
        first.encode_special_tokens = True
        second = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of, known = byte_level(), sp_model.read(b_path)
        a_bytes = {i: bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode() for entry, i in first.get_vocab().items()}
        b_bytes = [bytes([int(p[3:5], 16)]) if k == sp_model.BYTE else p.replace(sp_model.MARK, " ").encode() for p, k in zip(known.pieces, known.kinds)]
        sides = [
            Side(lambda texts: [x.ids for x in first.encode_batch_fast(texts, add_special_tokens=False)], [a_bytes.get(i, b"") for i in range(max(a_bytes, default=-1) + 1)]),
            Side(lambda texts: second.encode([t[1:] for t in texts], num_threads=1), b_bytes),
        ]
        del a_bytes, b_bytes, known

        for batch in batches:
            for part in shared.by_bytes(batch, "word", shared.SLICE_BYTES // 64):
                n = part.num_rows
                plain, offsets = shared.raw_bytes(part["word"])
                bounds = offsets + np.arange(n + 1)  # each with a space before it
                data = np.full(bounds[-1], 32, np.uint8)
                data[np.arange(len(plain)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = plain
                ends = cuttable(np.append(data, np.uint8(32)))[bounds[1:]] & split
                many = np.flatnonzero(ends)
                ok, held = spelled(sides, *gather_runs(data, bounds, many), TOGETHER)
                good = np.zeros(n, bool)
                good[many[ok]] = True
                single = np.flatnonzero(~good)
                fine, alone = spelled(sides, *gather_runs(data, bounds, single), 1)
                good[single[fine]] = True
                where = np.empty(n, np.int64)
                where[np.concatenate([many[ok], single])] = np.arange(n)
                flat = np.concatenate([x for (ids, _), (more, _) in zip(held, alone) for x in (ids, more)])
                sizes = np.concatenate([np.concatenate([side.sizes[ids], side.sizes[more]]) for side, (ids, _), (more, _) in zip(sides, held, alone)])
                counts = np.concatenate([x for (_, k), (_, more) in zip(held, alone) for x in (k[ok], more)])
                starts, both = shared.runs(counts), np.stack([where, n + where], axis=1).ravel()
                ids, at = gather_runs(flat, starts, both)
                lengths, _ = gather_runs(sizes, starts, both)
                at = pa.array(at[::2], pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x, kind)) for x, kind in ((ids, pa.int32()), (lengths, pa.int32()))]
                yield pa.RecordBatch.from_arrays([part["times"], part["places"], pa.array(good), pa.array(counts[where], pa.int32()), *lists], out)

    return shared.map_arrow(words, run, "times long, places array<struct<unit: long, i: int>>, good boolean, n_a int, ids array<int>, sizes array<int>")


@contextmanager
def step_by_step(spark: SparkSession) -> Iterator[None]:
    """Within this context, rows sorted by a grouping's key are grouped as they come, neither hashed nor sorted again, and a query's shuffle files go when it ends.

    Each query here is a table that is written whole, so nothing reads its shuffle again; otherwise all steps' files stay till the driver collects its garbage.
    """
    wanted = {"spark.sql.execution.replaceHashWithSortAgg": "true", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def distinct_words(words: DataFrame) -> DataFrame:
    """word, times, and the places (unit, i) of every distinct word, one in each unit that has it."""
    dealt = words.repartition("word").sortWithinPartitions("word")
    return dealt.groupBy("word").agg(F.sum("times").alias("times"), F.collect_list(F.struct("unit", "i")).alias("places"))


def tokens(segments: DataFrame) -> DataFrame:
    """sid, times, is_b, end (a running sum of bytes of the side) and id of both sides' tokens."""
    exploded = segments.select("sid", "times", "n_a", F.posexplode(F.arrays_zip("ids", "sizes")).alias("pos", "token"))
    placed = exploded.select("sid", "times", (F.col("pos") >= F.col("n_a")).alias("is_b"), "pos", F.col("token.ids").alias("id"), F.col("token.sizes").alias("size"))
    return placed.select("sid", "times", "is_b", F.sum("size").over(Window.partitionBy("sid", "is_b").orderBy("pos")).alias("end"), "id")


def aligned(segments: DataFrame) -> DataFrame:
    """sid, times, n_a, n_b, n_groups, groups (``a1,a2|b1;…``) and links (the ids of tokens that end together) of every segment.

    Segments are dealt out by ``sid`` once; windows and the grouping stay where they are.  By end, and a before b, tokens
    that end together are neighbours, as every token has bytes.  A token's group is the number of cuts, ends that
    both sides have, before its own end.
    """
    dealt = segments.select("sid", "times", "n_a", "ids", "sizes").repartition("sid")
    by_end = Window.partitionBy("sid").orderBy("end", "is_b")
    near = tokens(dealt).select("*", F.lag("end").over(by_end).alias("end_before"), F.lag("id").over(by_end).alias("id_before"), F.lead("end").over(by_end).alias("end_after"))
    cut = F.coalesce(F.when(F.col("is_b"), F.col("end_before")).otherwise(F.col("end_after")) == F.col("end"), F.lit(False))
    met = near.select("sid", "times", "is_b", "end", "id", "id_before", cut.alias("cut")).withColumn("link", F.col("is_b") & F.col("cut"))
    group = F.count_if("link").over(by_end.rowsBetween(Window.unboundedPreceding, -1))
    order = F.struct(F.coalesce(group, F.lit(0)).alias("group"), "is_b", "end")
    mark = F.when(~F.col("cut"), ",").when(F.col("is_b"), ";").otherwise("|")
    said = met.select("sid", "times", "is_b", "link", F.struct(order.alias("at"), F.concat(F.col("id").cast("string"), mark).alias("text")).alias("said"), F.when(F.col("link"), F.struct(F.col("id_before").alias("a"), F.col("id").alias("b"))).alias("pair"))
    counts = [F.count_if(~F.col("is_b")).alias("n_a"), F.count_if("is_b").alias("n_b"), F.count_if("link").alias("n_groups")]
    out = said.groupBy("sid").agg(F.first("times").alias("times"), *counts, F.collect_list("said").alias("said"), F.collect_list("pair").alias("links"))
    text = F.array_join(F.transform(F.array_sort("said"), lambda x: x["text"]), "")
    return out.withColumn("text", text).select("sid", "times", "n_a", "n_b", "n_groups", F.expr("left(text, length(text) - 1)").alias("groups"), "links")


def places_of(segments: DataFrame) -> DataFrame:
    """sid, unit, i of every segment in every unit that has it."""
    return segments.select("sid", F.explode("places").alias("place")).select("sid", "place.*")


def _uncounted(texts: DataFrame, segments: DataFrame) -> DataFrame:
    """sid, less: what texts with a segment that is not good have added to the occurrences, negated."""
    bad = places_of(segments.where("NOT good")).groupBy("unit").agg(F.collect_set("i").alias("bad"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, parts, bad in zip(*(batch[c].to_pylist() for c in ("unit", "parts", "bad"))):
                own = unpacked(parts)
                if np.isin(own, bad).any():
                    i, n = np.unique(own, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), unit)), pa.array(i.astype(np.int32)), pa.array(-n.astype(np.int64))], ["unit", "i", "times"])

    less = shared.map_arrow(texts.join(bad, "unit").select("unit", "parts", "bad"), run, "unit long, i int, times long")
    summed = less.groupBy("unit", "i").agg(F.sum("times").alias("times"))
    return summed.join(places_of(segments), ["unit", "i"]).groupBy("sid").agg(F.sum("times").alias("less"))


def together(texts: DataFrame, scored: DataFrame, keep_type: T.DataType) -> DataFrame:
    """keep, counts and groups of every text, put together from its unit's segments.

    ``scored`` (places, told) tells groups and counts as one text, as most are of a digit or two: in columns of their own they are most of the shuffle.
    """
    null = lambda kind: F.lit(None).cast(kind)
    parts = scored.select("told", F.explode("places").alias("place")).select("place.unit", "place.i", "told", null(keep_type).alias("keep"), null("binary").alias("parts"))
    rows = parts.unionByName(texts.select("unit", null("int").alias("i"), null("string").alias("told"), "keep", "parts"))
    fields = 1 + len(COUNTS)

    def heard(told: pa.Array) -> tuple:
        """If there is one, the counts (narrow, as a unit holds many: only sums of counts need 64 bits) and the groups of each segment."""
        flat = pa.compute.split_pattern(told.fill_null("\t".join(["", *["0"] * len(COUNTS)])), "\t").flatten()
        place = np.arange(len(told)) * fields
        counts = [np.asarray(flat.take(pa.array(place + 1 + j)).cast(pa.int64() if c == "count_sum" else pa.int32())) for j, c in enumerate(COUNTS)]
        return np.asarray(told.is_valid()), *counts, flat.take(pa.array(place))

    def whole_of(held: list) -> tuple[np.ndarray, list[np.ndarray], pa.Array]:
        """The unit's segments in their order; what was held is freed column by column."""
        columns = [list(c) for c in zip(*held)] if held else [[np.zeros(0, bool)], *[[np.zeros(0, np.int64)] for _ in COUNTS], [pa.array([], pa.string())]]
        held.clear()
        out = []
        while columns:
            some = columns.pop(0)
            out.append(np.concatenate(some) if isinstance(some[0], np.ndarray) else pa.concat_arrays(some))
        return out[0], out[1:-1], out[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, whole = None, [], None
        for batch in batches:
            ids = np.asarray(batch["unit"])
            is_text = np.asarray(batch["i"].is_null())
            ends = [*(np.flatnonzero((np.diff(ids) != 0) | (np.diff(is_text.astype(np.int8)) != 0)) + 1).tolist(), batch.num_rows]
            start = 0
            for end in ends:
                part, texts_here = batch.slice(start, end - start), is_text[start]
                if ids[start] != unit:
                    unit, held, whole = ids[start], [], None
                start = end
                if not texts_here:
                    held.append(heard(part["told"]))
                    continue
                if whole is None:  # the unit's segments are all there
                    whole = whole_of(held)
                good, counts, groups = whole
                for some in shared.by_bytes(part, "parts", shared.SLICE_BYTES // 32):
                    data, offsets = shared.raw_bytes(some["parts"])
                    own, starts = unpacked(data), shared.runs(data < 128)[offsets]  # a number ends with a byte below 128
                    sizes = np.diff(starts)
                    clean = (sizes > 0) & (shared.run_sums(~good[own], starts) == 0)
                    sums = [np.where(clean, shared.run_sums(c[own].astype(np.int64), starts), 0) for c in counts]
                    lists = pa.ListArray.from_arrays(pa.array(shared.runs(sizes * clean), pa.int32()), groups.take(pa.array(own[np.repeat(clean, sizes)])))
                    yield pa.RecordBatch.from_arrays([some["keep"], *map(pa.array, sums), pa.compute.binary_join(lists, ";")], ["keep", *COUNTS, "groups"])

    schema = T.StructType([T.StructField("keep", keep_type), *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("groups", T.StringType())])
    return shared.map_arrow(rows.repartition("unit").sortWithinPartitions("unit", F.col("i").asc_nulls_last()), run, schema)


def align(df: DataFrame, text: str = "text", keep: str = "doc_id", a_path: str | None = None, b_path: str | None = None, unit_bytes: int = UNIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """``keep``, counts and groups of every row, and the links of every id pair (a, b, count)."""
    import json

    a_path, b_path = a_path or public_tokenizers.path(VOCABULARY_A), b_path or public_tokenizers.path(VOCABULARY_B)
    known = sp_model.read(b_path)
    with open(a_path, encoding="utf-8") as f:
        made = json.load(f)
    before = made.get("pre_tokenizer") or {}
    by_bytes = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and made.get("normalizer") is None
    split = bool(by_bytes and known.plain and known.breaks_at_spaces)
    keep_type = df.schema[keep].dataType

    units = shared.cut(in_units(df, text, keep, split, unit_bytes), "align-units", compression="zstd")
    words, texts = units.where("i IS NOT NULL").select("unit", "i", "word", "times"), units.where("i IS NULL").select("unit", "keep", "parts")
    with step_by_step(df.sparkSession):
        coded = encoded(distinct_words(words), a_path, b_path, split).withColumn("sid", F.monotonically_increasing_id())
        segments, seen = shared.observed_cut(coded, "align-segments", F.count_if(~F.col("good")).alias("bad"), compression="zstd")
        done = shared.cut(aligned(segments.where("good")), "align-done", compression="zstd")

        links = done.select("sid", "times", F.explode("links").alias("link")).select("sid", "times", "link.*")
        if seen["bad"]:
            links = links.join(_uncounted(texts, segments), "sid", "left").withColumn("times", F.col("times") + F.coalesce("less", F.lit(0)))
        pairs = shared.cut(links.groupBy("a", "b").agg(F.sum("times").alias("count")).where("count > 0"), "align-pairs")
        best = pairs.groupBy("b").agg(F.max("count").alias("best"))
        ranked = pairs.join(best, "b").select("a", "b", "count", (F.col("count") == F.col("best")).alias("is_best"))
        linked = done.select("sid", F.explode("links").alias("link")).select("sid", "link.*").join(ranked, ["a", "b"]).groupBy("sid")
        linked = linked.agg(F.count(F.lit(1)).alias("n_links"), F.count_if("is_best").alias("n_best"), F.sum("count").alias("count_sum"))
        told = F.concat_ws("\t", "groups", *[F.coalesce(c, F.lit(0)).cast("string") for c in COUNTS]).alias("told")
        counted = done.select("sid", "n_a", "n_b", "n_groups", "groups").join(linked, "sid", "left").select("sid", told)
        scored = shared.cut(segments.select("sid", "places").join(counted, "sid", "left").select("places", "told"), "align-scored", compression="zstd")
    shared.discard(segments, done)
    out = together(texts, scored, keep_type)
    return out.select(F.col("keep").alias(keep), *COUNTS, "groups"), pairs


def digest(groups: Column) -> Column:
    """Lowercase hex of the sha256 of the groups; empty without any."""
    return F.when(groups == "", F.lit("")).otherwise(F.sha2(groups, 256))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = align(shared.table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *COUNTS, digest(F.col("groups")).alias("groups_sha256"))
