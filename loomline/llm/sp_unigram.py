"""SentencePiece encoding and decoding by the Unigram model.

The best segmentation of a text is found by the Viterbi algorithm over a
double-array trie of the pieces, maximising the sum of their log scores.  A
character that no single-character piece covers scores 10 below the lowest
piece and is written as its UTF-8 bytes, if the vocabulary has byte pieces,
else as the unknown piece, once for neighbouring ones.  Decoding joins the
pieces, bytes and spaces and drops the space that encoding put first.

If no piece goes on with a space after anything else, the best path of a text
is made of the best paths of its chunks (spaces, then other characters), so
each distinct chunk of a batch is solved once.
Otherwise the whole text is one chunk.

A Unigram file's scores are log probabilities and are used as they are.  The
scores of a BPE file are ranks; they stand for Zipf's law there: a piece of
rank r has the log probability -log((r + 1) H), with H the sum of 1 / (r + 1).
Nothing is trained.

Cases: a null text encodes as no pieces and decodes to the empty text; so does
an empty one.  The space mark U+2581 inside a text is a space to the format and
comes back as one (round_trip is then false).  Repeated rows give repeated rows,
an empty table an empty one.  Columns of the input named like the results are
replaced.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm import shared, sp_model

MODEL = "piece_bpe_32k.model"
#: How far below the lowest piece an unknown character scores.
UNKNOWN_PENALTY = 10.0
#: Chunks of up to so many bytes are solved together, so many at once.
TOGETHER_BYTES, TOGETHER_ROWS = 40, 20_000


class DoubleArray:
    """A trie in two arrays: node n goes by byte b to t = base[n] + b + 1 if check[t] == n."""

    def __init__(self, keys: list[bytes], values: list[int]):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys, values = [keys[i] for i in order], [values[i] for i in order]
        size = 1 << 16
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        self.check[0] = 0
        free = [1, 1]  # where the search begins, for nodes of many and of few children
        todo = [(0, 0, 0, len(keys))]  # node, depth, range of keys below it
        while todo:
            node, depth, low, high = todo.pop()
            if low < high and len(keys[low]) == depth:
                self.value[node] = values[low]
                low += 1
            if low == high:
                continue
            children = []
            while low < high:
                byte, end = keys[low][depth], low
                while end < high and keys[end][depth] == byte:
                    end += 1
                children.append((byte + 1, low, end))
                low = end
            few = len(children) < 4
            first, slot = children[0][0], free[few]
            tries = 0
            while True:
                if slot + 600 > len(self.check):
                    self._grow()
                base = slot - first
                if base > 0 and self.check[slot] < 0 and all(self.check[base + c] < 0 for c, _, _ in children):
                    break
                slot += 1
                tries += 1
            if tries > 8:  # the stretch before is nearly full
                free[few] = slot
            self.base[node] = base
            for code, start, end in children:
                self.check[base + code] = node
                todo.append((base + code, depth + 1, start, end))

    def _grow(self) -> None:
        n = len(self.check)
        self.base += [0] * n
        self.check += [-1] * n
        self.value += [-1] * n


class Unigram:
    """The vocabulary with its trie; spaces stand for the format's space mark."""

    def __init__(self, path: str):
        known = sp_model.read(path)
        if not known.plain:
            raise ValueError("only models with the identity normaliser and a dummy prefix are supported")
        self.by_chunk = known.breaks_at_spaces
        self.texts = [p.replace(sp_model.MARK, " ").encode() for p in known.pieces]
        scores = np.array(known.scores)
        usable = [i for i, k in enumerate(known.kinds) if k in (sp_model.NORMAL, sp_model.USER_DEFINED)]
        if known.model_type == sp_model.BPE:
            rank = 1.0 - scores[usable]
            scores[usable] = -np.log(rank) - math.log((1.0 / rank).sum())
        low, high = float(scores[usable].min()), float(scores[usable].max())
        self.unknown_score = low - UNKNOWN_PENALTY
        for i in usable:
            if known.kinds[i] == sp_model.USER_DEFINED:
                scores[i] = len(known.pieces[i]) * high - 0.1
        self.scores = scores.tolist()
        self.trie = DoubleArray([self.texts[i] for i in usable], usable)
        self.bytes: dict[int, int] = {}
        self.unknown = 0
        for i, kind in enumerate(known.kinds):
            if kind == sp_model.BYTE:
                value = int(known.pieces[i][1:-1], 16)
                self.bytes[value] = i
                self.texts[i] = bytes([value])
            elif kind == sp_model.CONTROL:
                self.texts[i] = b""
            elif kind == sp_model.UNKNOWN:
                self.unknown = i
                self.texts[i] = " ⁇ ".encode()
        self.arrays = [np.array(x, dtype=np.int64) for x in (self.trie.base, self.trie.check, self.trie.value)]
        self.score_array = np.array(self.scores)
        self.byte_ids = np.array([self.bytes.get(b, self.unknown) for b in range(256)])
        self.piece_starts = shared.runs(np.array([len(t) for t in self.texts]))
        self.piece_bytes = np.frombuffer(b"".join(self.texts), dtype=np.uint8)

    def viterbi(self, text: bytes) -> tuple[list[int], float]:
        """The pieces of the best path, and its score."""
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        n, least = len(text), -math.inf
        best, came, by = [least] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if here == least:
                continue
            lead = text[i]
            width = i + (1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            node, single = 0, False
            for j in range(i, n):
                t = base[node] + text[j] + 1
                if check[t] != node:
                    break
                node = t
                v = value[node]
                if v >= 0:
                    if j + 1 == width:
                        single = True
                    s = here + scores[v]
                    if s > best[j + 1]:
                        best[j + 1], came[j + 1], by[j + 1] = s, i, v
            if not single:
                s = here + self.unknown_score
                if s > best[width]:
                    best[width], came[width], by[width] = s, i, -1
        out: list[int] = []
        at, after_unknown = n, False
        while at > 0:
            if by[at] >= 0:
                out.append(by[at])
                after_unknown = False
            elif self.bytes:
                out.extend(self.bytes[b] for b in reversed(text[came[at] : at]))
            else:
                if not after_unknown:
                    out.append(self.unknown)
                after_unknown = True
            at = came[at]
        return out[::-1], best[n]


    def solve(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best paths of many chunks: all ids in order, starts (n + 1), scores.

        Short chunks go through the same Viterbi step by step together; long ones,
        and those with an unknown character of several bytes, one by one.
        """
        data, offsets = shared.raw_bytes(chunks)
        sizes = np.diff(offsets)
        n = len(sizes)
        counts, scores, parts, rows = np.zeros(n, np.int64), np.zeros(n), [], []
        alone = np.flatnonzero(sizes > TOGETHER_BYTES)
        short = np.flatnonzero(sizes <= TOGETHER_BYTES)
        short = short[np.argsort(-sizes[short], kind="stable")]
        for at in range(0, len(short), TOGETHER_ROWS):
            block = short[at : at + TOGETHER_ROWS]
            flat, number, score, odd = self._together(data, offsets[block], sizes[block])
            fine = ~odd
            counts[block[fine]], scores[block[fine]] = number[fine], score[fine]
            parts.append(flat)
            rows.append(block[fine])
            alone = np.concatenate([alone, block[odd]])
        for k in alone.tolist():
            ids, scores[k] = self.viterbi(data[offsets[k] : offsets[k + 1]].tobytes())
            counts[k] = len(ids)
            parts.append(np.array(ids, np.int32))
        rows.append(alone)
        order = np.concatenate(rows)
        if not len(order):
            return np.zeros(0, np.int32), np.zeros(1, np.int64), scores
        where = np.empty(n, np.int64)
        where[order] = np.arange(n)
        flat, starts = gather_runs(np.concatenate(parts), shared.runs(counts[order]), where)
        return flat, starts, scores

    def _together(self, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For chunks from long to short: ids of all in order, their numbers, scores, and which ones are left out."""
        base, check, value = self.arrays
        n, longest = len(sizes), int(sizes[0])
        text = data[np.minimum(begins[:, None] + np.arange(longest), len(data) - 1)].astype(np.int64)
        reach = np.searchsorted(-sizes, -np.arange(longest), side="left")  # chunks longer than i come first
        best = np.full((longest + 1, n), -np.inf)
        came, by = np.zeros((longest + 1, n), np.int64), np.zeros((longest + 1, n), np.int64)
        best[0] = 0.0
        odd = np.zeros(n, dtype=bool)
        for i in range(longest):
            first = np.flatnonzero(best[i, : reach[i]] > -np.inf)
            if not len(first):
                continue
            lead = text[first, i]
            width = i + 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            single = np.zeros(n, dtype=bool)
            ends = np.zeros(n, np.int64)
            ends[first] = width
            rows, node = first, np.zeros(len(first), np.int64)
            for j in range(i, longest):
                k = np.searchsorted(rows, reach[j])
                rows, node = rows[:k], node[:k]
                step = base[node] + text[rows, j] + 1
                fits = check[step] == node
                rows, node = rows[fits], step[fits]
                if not len(rows):
                    break
                hit = value[node] >= 0
                at, piece = rows[hit], value[node[hit]]
                score = best[i, at] + self.score_array[piece]
                single[at[ends[at] == j + 1]] = True
                better = score > best[j + 1, at]
                at = at[better]
                best[j + 1, at], came[j + 1, at], by[j + 1, at] = score[better], i, piece[better]
            lone = first[~single[first]]
            if len(lone):
                odd[lone[ends[lone] > i + 1]] = True
                one = lone[ends[lone] == i + 1]
                score = best[i, one] + self.unknown_score
                better = score > best[i + 1, one]
                one = one[better]
                best[i + 1, one], came[i + 1, one], by[i + 1, one] = score[better], i, self.byte_ids[text[one, i]]
                if not self.bytes:
                    odd[one] = True
        counts, at = np.zeros(n, np.int64), np.where(odd, 0, sizes)
        back = np.zeros((n, longest), np.int32)
        rows = np.flatnonzero(at)
        while len(rows):
            back[rows, counts[rows]] = by[at[rows], rows]
            counts[rows] += 1
            at[rows] = came[at[rows], rows]
            rows = rows[at[rows] > 0]
        starts = shared.runs(counts)
        row = np.repeat(np.arange(n), counts)
        return back[row, starts[row + 1] - 1 - np.arange(starts[-1])], counts, best[sizes, np.arange(n)], odd


@functools.lru_cache(maxsize=2)
def load(path: str) -> Unigram:
    return Unigram(path)


class Coder:
    """Encodes and decodes Arrow arrays of texts."""

    def __init__(self, model: Unigram):
        self.model = model

    def _chunks(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        pc = pa.compute
        texts = pc.replace_substring(texts.fill_null("").cast(pa.large_string()), sp_model.MARK, " ")
        lead = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string())
        data, offsets = shared.raw_bytes(pc.binary_join_element_wise(lead, texts, pa.scalar("", pa.large_string())))
        begins = np.zeros(len(data), dtype=bool)
        if self.model.by_chunk and len(data):
            begins[1:] = (data[1:] == 32) & (data[:-1] != 32)
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        counts = np.diff(np.concatenate([[0], np.cumsum(begins)])[offsets])
        starts = np.append(np.flatnonzero(begins), len(data)).astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]), counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All piece ids in order, each text's start among them (n + 1), and the scores."""
        chunks, counts = self._chunks(texts)
        if not len(chunks):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64), np.zeros(len(texts))
        coded = chunks.dictionary_encode()
        flat, starts, solved = self.model.solve(coded.dictionary)
        which = np.asarray(coded.indices)
        ids, bounds = gather_runs(flat, starts, which)
        by_text = shared.runs(counts)
        scores = solved[which]
        sums = np.add.reduceat(np.append(scores, 0.0), np.minimum(by_text[:-1], len(scores)))
        return ids, bounds[by_text], np.where(counts > 0, sums, 0.0)

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """Texts of runs of ids."""
        data, bounds = gather_runs(self.model.piece_bytes, self.model.piece_starts, ids)
        ends = bounds[starts]
        keep = np.ones(len(data), dtype=bool)
        first = ends[:-1][np.diff(ends) > 0]
        keep[first[data[first] == 32]] = False
        left = np.concatenate([[0], np.cumsum(keep)])
        joined = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(left[ends].astype(np.int64)), pa.py_buffer(data[keep])])
        try:
            return joined.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([x.decode(errors="replace") for x in joined.to_pylist()], pa.large_string())


def gather_runs(flat: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs numbered ``which`` of ``flat`` one after another, and where they begin (n + 1)."""
    sizes = np.diff(starts)[which]
    bounds = shared.runs(sizes)
    return flat[np.repeat(starts[:-1][which] - bounds[:-1], sizes) + np.arange(bounds[-1])], bounds


def _with(df: DataFrame, **columns: T.DataType) -> tuple[list[str], T.StructType]:
    kept = [c for c in df.columns if c not in columns]
    fields = [df.schema[c] for c in kept] + [T.StructField(n, t) for n, t in columns.items()]
    return kept, T.StructType(fields)


def encode(df: DataFrame, text: str = "text", model_path: str | None = None) -> DataFrame:
    """Adds n_tokens, score, ids (piece ids of the whole text) and round_trip.

    round_trip tells whether decoding the ids gives the text back.
    """
    spark = df.sparkSession
    model = spark.sparkContext.broadcast(load(model_path or public_tokenizers.path(MODEL)))  # bounded by the vocabulary
    kept, schema = _with(df, n_tokens=T.LongType(), score=T.DoubleType(), ids=T.ArrayType(T.IntegerType()), round_trip=T.BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(model.value)
        for batch in batches:
            for part in shared.by_bytes(batch, text):
                ids, starts, scores = coder.encode(part[text])
                same = pa.compute.equal(coder.decode(ids, starts), part[text].fill_null("").cast(pa.large_string()))
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), pa.array(np.diff(starts), pa.int64()), pa.array(scores), lists, same], [*kept, "n_tokens", "score", "ids", "round_trip"])

    return shared.map_arrow(df, run, schema)


def decode(df: DataFrame, ids: str = "ids", model_path: str | None = None) -> DataFrame:
    """Adds ``decoded``: the text of the piece ids; null ids give the empty text.

    Ids outside the vocabulary raise an error.  Bytes that are no UTF-8 become U+FFFD.
    """
    spark = df.sparkSession
    model = spark.sparkContext.broadcast(load(model_path or public_tokenizers.path(MODEL)))  # bounded by the vocabulary
    kept, schema = _with(df, decoded=T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(model.value)
        for batch in batches:
            lists = batch[ids]
            counts = np.asarray(pa.compute.list_value_length(lists).fill_null(0), dtype=np.int64)
            flat = np.asarray(lists.flatten().fill_null(coder.model.unknown), dtype=np.int64)
            texts = coder.decode(flat, shared.runs(counts))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), texts.cast(pa.string())], [*kept, "decoded"])

    return shared.map_arrow(df, run, schema)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole text: doc_id, n_tokens, score, ids, round_trip."""
    docs = shared.table(spark, sf_dir, "documents")
    return encode(docs.select("doc_id", "text")).drop("text")
