"""Language-model scores by context-tree weighting over bytes, with a word-count base.

A byte is eight binary decisions, so every byte context has 255 binary nodes with
Krichevsky-Trofimov estimates.  A context of depth d is the d bytes before; it is a
node of the tree if it occurs at least ``LEAST`` times in the training texts, at any corpus
size, so the tree grows with the corpus.  The bytes after contexts that are no nodes
stay with their parent's "other" child, so all training bytes count.  Weighting mixes
all depths: P_w = 1/2 P_kt + 1/2 prod P_w(children), and a byte's probability follows
the matched path from the deepest node up with the posterior weights 1/2 P_kt / P_w.

The tree is a table: all distinct (six bytes of context, byte) of all texts with their training
counts, dealt out by cell, which is the three nearest bytes of the context.  A unit of text
lists what it has of each cell; the lists are merged into one row for each cell.  A pass over
those rows weighs the subtrees below three bytes; what they come to is mixed on the driver for
contexts of up to three bytes; then the paths are followed down once in each row, the rows meet the
units' lists again, and each unit gets the log probabilities it asked for, from which its texts are scored.
Words are counted in the same way, dealt out by the first bits of their hashes.  Lists of one cell
are merged in salts of ``SALT_UNITS`` units, so no cell gathers the whole corpus in one task.  For the answers
only cells whose lists take more than ``SALT_BYTES`` and more than their row go to several tasks, each with a copy of the row:
so copies of a row add up to no more than the row and its lists, at any corpus size.
The units' texts are written bucketed by unit, so only lists and answers are shuffled.

The sequence of a text is its lower-cased bytes and one end byte 0xFF, which no UTF-8
has; contexts before the beginning hold 0xFF.

Words are told apart by 64-bit hashes.

Cases: a null or empty text is the end token alone.  Without training documents the
base gives 0 for every token and the tree 1/2 for every bit.  Repeated rows give
repeated rows, an empty table an empty one; a null id is an empty id to the split.
Of the other columns none is carried, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import shared

DEPTH = 6
#: A context is a node from so many occurrences on.
LEAST = 2
#: The nearest bytes of a context by which the tree is dealt out.
CELL = 3
#: The first bits of a word's hash by which words are dealt out.
WORD_CELL_BITS = 12
EDGE = 0xFF
#: Text of a unit, places that are worked on and that are sorted at once, and keys of whole cells that are worked on at once.
UNIT_BYTES, BLOCK, KEYS, CELL_KEYS = 32 << 20, 1 << 20, 1 << 24, 1 << 20
#: Units whose lists of a cell are merged in one task, and bytes of lists that a copy of a cell's row answers at least, if there are as many.
SALT_UNITS, SALT_BYTES = 512, 64 << 20
#: Kinds of rows: a unit's words and contexts by cell, learnt documents, texts.
WORDS, CONTEXTS, LEARNT, TEXTS = range(4)
#: Places that walk down the tree at once.
WALK = 1 << 15


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0, by Stirling's series after a shift of 8."""
    y = x + 8.0
    shift = np.log(x)
    for k in range(1, 8):
        shift += np.log(x + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def bit_counts(counts: np.ndarray) -> np.ndarray:
    """n by 256 byte counts -> n by 255 by 2 counts of zeros and ones at the binary nodes, by level."""
    n = len(counts)
    return np.concatenate([counts.reshape(n, 1 << level, 2, 128 >> level).sum(axis=-1) for level in range(8)], axis=1)


def log_kt(bits: np.ndarray) -> np.ndarray:
    """Log of the KT probability of the counts at each node."""
    a, b = bits[..., 0], bits[..., 1]
    out = np.zeros(a.shape)
    seen = (a + b) > 0
    x, y = a[seen], b[seen]
    out[seen] = log_gamma(x + 0.5) + log_gamma(y + 0.5) - log_gamma(x + y + 1.0) - np.log(np.pi)
    return out


def kt_one(bits: np.ndarray) -> np.ndarray:
    """KT probability of a one at each node."""
    return (bits[..., 1] + 0.5) / (bits[..., 0] + bits[..., 1] + 1.0)


def byte_logs(ones: np.ndarray) -> np.ndarray:
    """n by 255 probabilities of a one -> n by 256 log10 probabilities of the bytes."""
    out = np.zeros((len(ones), 1))
    at = 0
    for level in range(8):
        p = ones[:, at : at + (1 << level)]
        at += 1 << level
        out = np.stack([out + np.log10(1 - p), out + np.log10(p)], axis=2).reshape(len(ones), 2 << level)
    return out.astype(np.float32)


# The tree held in one place, from the nodes' definition: what the tests compare the dealt tree with.


@dataclass
class Nodes:
    """Contexts by depth, nearest byte most significant; rows are numbered by depth, then context."""

    contexts: list[np.ndarray]

    def __post_init__(self):
        self.first = np.concatenate([[0], np.cumsum([len(c) for c in self.contexts])]).tolist()
        self.depth = len(self.contexts) - 1
        # states: 0 for no node, then the rows; a state's number grows with its depth
        self.step = np.zeros((self.first[-1] + 1) * 256, dtype=np.int32)
        self.parent = []
        for d, (a, b) in enumerate(zip(self.contexts, self.contexts[1:])):
            self.parent.append(np.searchsorted(a, b >> 8))
            state = self.first[d] + 1 + self.parent[d]
            self.step[state * 256 + (b & 255)] = self.first[d + 1] + 1 + np.arange(len(b))

    def deepest(self, padded: np.ndarray) -> np.ndarray:
        """Row of the deepest node that the context before each place matches; the first ``depth`` places get row 0."""
        out = np.zeros(len(padded), dtype=np.int32)
        for low in range(self.depth, len(padded), WALK):
            high = min(low + WALK, len(padded))
            state = best = np.ones(high - low, dtype=np.int32)
            for d in range(1, self.depth + 1):
                state = self.step.take((state << 8) | padded[low - d : high - d])
                best = np.maximum(best, state)
            out[low:high] = best - 1
        return out


@dataclass
class Tree:
    """Log10 probabilities by node and byte."""

    nodes: Nodes
    logs: np.ndarray

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 probability of each text, its end included."""
        depth = self.nodes.depth
        padded, rooms = padded_texts(data, offsets, depth)
        at = positions(rooms, depth)
        logs = self.logs.reshape(-1).take((self.nodes.deepest(padded) << 8) | padded)[at].astype(np.float64)
        return shared.run_sums(logs, shared.runs(np.diff(offsets) + 1))


def padded_texts(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text after ``depth`` edge bytes and before one; and where the texts' rooms start (n + 1)."""
    sizes = np.diff(offsets)
    rooms = shared.runs(sizes + depth + 1)
    out = np.full(rooms[-1], EDGE, dtype=np.uint8)
    out[np.arange(len(data)) + np.repeat(rooms[:-1] + depth - offsets[:-1], sizes)] = data
    return out, rooms


def positions(rooms: np.ndarray, depth: int) -> np.ndarray:
    """Places of the texts' bytes and ends in ``padded_texts``."""
    sizes = np.diff(rooms) - depth
    return np.arange(sizes.sum()) + np.repeat(rooms[:-1] + depth - shared.runs(sizes)[:-1], sizes)


def contexts_of(data: np.ndarray, offsets: np.ndarray, depth: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of depths 1 to ``depth`` that occur ``least`` times or more, as depth << 48 | context, and their counts.

    A context can only be as frequent as its nearer part, so each depth goes on from those that the one before kept.
    """
    padded, rooms = padded_texts(data, offsets, depth)
    at = positions(rooms, depth)
    ids, names = np.zeros(len(at), dtype=np.int32), np.zeros(1, np.int64)
    keys, counts = [], []
    for d in range(1, depth + 1):
        step = (ids << 8) | padded[at - d]
        n = np.bincount(step, minlength=256 * len(names))
        many = np.flatnonzero(n >= max(least, 1))
        names = (names[many >> 8] << 8) | (many & 255)
        keys.append(names | (d << 48))
        counts.append(n[many])
        place = np.full(len(n), -1, dtype=np.int32)
        place[many] = np.arange(len(many), dtype=np.int32)
        ids = place.take(step)
        live = ids >= 0
        at, ids = at[live], ids[live]
    return np.concatenate(keys), np.concatenate(counts)


def pruned(nodes: Nodes, own: np.ndarray, share: float) -> tuple[Nodes, list[np.ndarray]]:
    """The nodes with at least ``share`` of all bytes, and the counts of bytes that end at each of them, by depth."""
    depth = nodes.depth
    tables = [own[a:b] for a, b in zip(nodes.first, nodes.first[1:])]
    sums = [t.sum(axis=1) for t in tables]
    for d in range(depth - 1, -1, -1):
        np.add.at(sums[d], nodes.parent[d], sums[d + 1])
    kept = [s >= share * sums[0][0] for s in sums]
    kept[0][:] = True
    for d in range(depth - 1, -1, -1):
        gone = ~kept[d + 1]
        np.add.at(tables[d], nodes.parent[d][gone], tables[d + 1][gone])
    return Nodes([c[k] for c, k in zip(nodes.contexts, kept)]), [t[k] for t, k in zip(tables, kept)]


def build(nodes: Nodes, own: list[np.ndarray]) -> Tree:
    """The weighted tree; ``own[d]``: counts of bytes for which the node is the deepest."""
    depth = nodes.depth
    full = [t.copy() for t in own]
    for d in range(depth - 1, -1, -1):
        np.add.at(full[d], nodes.parent[d], full[d + 1])
    mixed = log_kt(bit_counts(full[depth]))
    weight: list[np.ndarray] = [np.zeros(0)] * depth
    for d in range(depth - 1, -1, -1):
        below = log_kt(bit_counts(own[d]))
        np.add.at(below, nodes.parent[d], mixed)
        alone = log_kt(bit_counts(full[d]))
        mixed = np.logaddexp(alone, below) - np.log(2)
        weight[d] = np.exp(alone - np.log(2) - mixed)
    rows = []
    base, left = np.zeros((1, 255)), np.ones((1, 255))
    for d in range(depth + 1):
        if d == depth:
            rows.append(byte_logs(base + left * kt_one(bit_counts(full[d]))))
            break
        base, left = base + left * weight[d] * kt_one(bit_counts(full[d])), left * (1 - weight[d])
        rows.append(byte_logs(base + left * kt_one(bit_counts(own[d]))))
        base, left = base[nodes.parent[d]], left[nodes.parent[d]]
    return Tree(nodes, np.concatenate(rows))


def packed(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of ``values`` as binary values."""
    offsets = np.asarray(starts * values.itemsize, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and the number of values in each row."""
    sizes = np.asarray(pa.compute.binary_length(column), dtype=np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind), sizes


def packed_ints(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of non-negative integers as binary values, seven bits a byte, the last byte of each below 128."""
    sizes = 1 + sum((values >> k > 0).astype(np.int64) for k in (7, 14, 21, 28))
    at = shared.runs(sizes)
    out = np.zeros(at[-1], np.uint8)
    for k in range(5):
        some = np.flatnonzero(sizes > k)
        out[at[some] + k] = (values[some] >> 7 * k & 127) | ((sizes[some] > k + 1) << 7)
    return packed(out, at[starts])


def unpacked_ints(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``packed_ints``: all values, and the number of values in each row."""
    data, rooms = unpacked(column, np.uint8)
    ends = data < 128
    seen = shared.runs(ends)
    starts = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1]) if len(data) else np.zeros(0, np.int64)
    place = np.arange(len(data)) - starts[seen[:-1]] if len(data) else starts
    values = np.add.reduceat((data & 127).astype(np.int64) << 7 * place, starts) if len(data) else starts
    return values, np.diff(seen[shared.runs(rooms)])


def steps(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Differences within each run, the first value as it is."""
    out = np.diff(values, prepend=0)
    out[starts[:-1]] = values[starts[:-1]]
    return out


def sums_of_steps(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The inverse of ``steps``; no run is empty."""
    total, starts = np.cumsum(values), shared.runs(sizes)[:-1]
    return total - np.repeat(total[starts] - values[starts], sizes)


def merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their sums."""
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(n, starts) if len(starts) else n


def distinct_counts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of key << 1 | counts, in order, and how often the key counts; ``values`` are sorted in place."""
    values.sort()
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    sizes, values = np.diff(np.append(starts, len(values))), values[starts]
    keys, n = values >> 1, sizes * (values & 1)
    again = np.flatnonzero(keys[1:] == keys[:-1])  # first without, then with counts
    n[again] = n[again + 1]
    kept = np.ones(len(keys), bool)
    kept[again + 1] = False
    return keys[kept], n[kept]


def grams(texts: pa.Array, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For blocks of places: context << 8 | byte, nearest byte of the context most significant, and the text of each place.

    A place's key comes from eight bytes read at once, so ``depth`` is 7 at most.
    """
    data, offsets = shared.raw_bytes(texts)
    padded, rooms = padded_texts(shared.lowered(data), offsets, depth)
    n = len(padded)
    padded = np.concatenate([padded, np.zeros(8, np.uint8)])
    eight = np.ndarray(n, "<u8", padded, strides=(1,))
    context, byte = np.uint64((1 << 8 * depth) - 1), np.uint64(8 * depth)
    for low in range(depth, n, BLOCK):
        high = min(low + BLOCK, n)
        first, last = np.searchsorted(rooms, [low, high - 1], "right") - 1
        edges = np.clip(rooms[first : last + 2], low, high)
        owner = np.repeat(np.arange(first, last + 1, dtype=np.int32), np.diff(edges))
        read = eight[low - depth : high - depth].copy()
        keys = (((read & context) << np.uint64(8)) | ((read >> byte) & np.uint64(255))).view(np.int64)
        inside = np.ones(high - low, bool)
        for d in range(depth):  # a room begins with the edge
            begins = rooms[first : last + 1] + d - low
            inside[begins[(begins >= 0) & (begins < high - low)]] = False
        yield keys[inside], owner[inside]


class Layers:
    """The (context, byte) of whole cells by depth, from ``high`` to ``low``; ``up`` leads to the depth above."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, high: int, low: int):
        self.high, self.low = high, low
        self.keys, self.n, self.up, self.own, self.node = {high: keys}, {high: n.astype(np.float64)}, {}, {}, {}
        for d in range(high, low, -1):
            self.keys[d - 1], self.up[d] = np.unique(((self.keys[d] >> 16) << 8) | (self.keys[d] & 255), return_inverse=True)
            self.n[d - 1] = np.bincount(self.up[d], self.n[d], len(self.keys[d - 1]))
        for d in range(high, low - 1, -1):
            context = self.keys[d] >> 8
            run = np.cumsum(np.concatenate([[0], context[1:] != context[:-1]]))
            self.node[d] = np.bincount(run, self.n[d])[run] >= LEAST if d else np.ones(len(context), bool)
            self.own[d] = self.n[d] if d == high else np.bincount(self.up[d + 1], self.n[d + 1] * ~self.node[d + 1], len(context))

    def mix(self, level: int, given: np.ndarray | None = None) -> None:
        """Weights one level of the bytes' bits, upwards; ``given`` is the outcome at ``high``, by key, if that has deeper contexts."""
        self.bit, self.mixed, self.weight, self.one, self.rest = {}, {}, {}, {}, {}
        for d in range(self.high, self.low - 1, -1):
            code = self.keys[d] >> (8 - level)
            first = np.concatenate([[True], code[1:] != code[:-1]])
            of = np.cumsum(first) - 1
            self.bit[d] = (self.keys[d] >> (7 - level)) & 1
            counted = lambda n: np.stack([np.bincount(of, n * (1 - self.bit[d])), np.bincount(of, n * self.bit[d])], axis=1)  # noqa: B023, E731
            if d == self.high and given is not None:
                outcome = given[first]
            else:
                full = counted(self.n[d])
                outcome = log_kt(full)
                self.one[d] = kt_one(full)[of]
                if d < self.high:
                    own = counted(self.own[d])
                    alone, below = outcome, log_kt(own) + np.bincount(of[self.up[d + 1][heads]], lower, len(full))
                    outcome = np.logaddexp(alone, below) - np.log(2)
                    self.weight[d] = np.exp(alone - np.log(2) - outcome)[of]
                    self.rest[d] = kt_one(own)[of]
            self.mixed[d] = outcome[of]
            heads = np.flatnonzero(first)
            lower = outcome * self.node[d][first]

    def follow(self, base: np.ndarray, left: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From what is settled and left above ``low``, and the probability of a one if the path ends there, the same at ``high``."""
        for d in range(self.low, self.high + 1):
            if d > self.low:
                base, left, other = base[self.up[d]], left[self.up[d]], other[self.up[d]]
            if d not in self.one:
                continue
            weight = self.weight.get(d, 1.0)
            here, after = base + left * weight * self.one[d], left * (1 - weight)
            ends = here + after * self.rest[d] if d in self.rest else here
            base, left, other = (np.where(self.node[d], x, y) for x, y in ((here, base), (after, left), (ends, other)))
        return base, left, other


def listed(docs: DataFrame, depth: int = DEPTH, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """What units of doc_id, held_out, text rows hold, by kind.

    WORDS: of a cell the ``tails``, which are the words' hashes, and their training counts ``times``;
    CONTEXTS: of a cell the lower bytes of (context, byte), and their training counts, both packed;
    LEARNT: training documents (n); TEXTS: the documents.
    """
    low = 8 * (depth - CELL + 1)
    kinds = f"kind int, unit long, cell int, tails binary, times binary, n long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        unit, size = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {WORDS: [], CONTEXTS: []}
        room, used = np.empty(KEYS, np.int64), 0
        empty = None

        def collect(keys: np.ndarray) -> None:
            nonlocal used
            while len(keys):
                some = keys[: len(room) - used]
                room[used : used + len(some)] = some
                used, keys = used + len(some), keys[len(some) :]
                if used == len(room):
                    settle()

        def settle() -> None:
            nonlocal used
            if used:
                held[CONTEXTS].append(distinct_counts(room[:used]))
                used = 0

        def rows(kind: int, count: int, **given) -> pa.RecordBatch:
            given |= {"kind": pa.array(np.full(count, kind)), "unit": pa.array(np.full(count, unit))}
            return pa.RecordBatch.from_arrays([given[f.name].cast(f.type) if f.name in given else pa.nulls(count, f.type) for f in empty], schema=empty)

        def whole_unit() -> Iterator[pa.RecordBatch]:
            settle()
            for kind, parts in held.items():
                keys, n = merged(*map(np.concatenate, zip(*parts)))
                parts.clear()
                cell = (keys >> low if kind == CONTEXTS else keys >> np.uint64(64 - WORD_CELL_BITS)).astype(np.int64)
                starts = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(keys))
                for at in range(0, len(starts) - 1, 2000):
                    some = starts[at : at + 2001]
                    part, within = slice(some[0], some[-1]), some - some[0]
                    tails = packed_ints(steps(keys[part] & ((1 << low) - 1), within), within) if kind == CONTEXTS else packed(keys[part], within)
                    yield rows(kind, len(some) - 1, cell=pa.array(cell[some[:-1]]), tails=tails, times=packed_ints(n[part].astype(np.int64), within))

        for batch in batches:
            empty = empty or pa.schema([("kind", pa.int32()), ("unit", pa.int64()), ("cell", pa.int32()), ("tails", pa.binary()), ("times", pa.binary()), ("n", pa.int64()), ("doc_id", batch.schema.field("doc_id").type), ("held_out", pa.bool_()), ("text", pa.string())])
            for part in shared.by_bytes(batch, "text"):
                learnt = ~np.asarray(part["held_out"].fill_null(True).to_numpy(zero_copy_only=False), dtype=bool)
                for keys, owner in grams(part["text"], depth):
                    collect((keys << 1) | learnt[owner])
                data, offsets = shared.raw_bytes(part["text"])
                words, counted = shared.word_array(shared.lowered(data), offsets)
                words = words.dictionary_encode()
                hashed = shared.hash_words(words.dictionary)
                held[WORDS].append((hashed, np.bincount(words.indices.to_numpy(), np.repeat(learnt, counted), len(hashed))))
                yield rows(LEARNT, 1, n=pa.array([int(learnt.sum())]))
                yield rows(TEXTS, len(part), doc_id=part["doc_id"], held_out=part["held_out"], text=part["text"])
                size += len(data) + len(part)
                for parts in held.values():
                    if len(parts) > 7:
                        parts[:] = [merged(*map(np.concatenate, zip(*parts)))]
                if size >= unit_bytes:
                    yield from whole_unit()
                    unit, size = unit + 1, 0
        if size:
            yield from whole_unit()

    return shared.map_arrow(docs.select("doc_id", "held_out", "text"), run, kinds)


def keys_of(kind: int, cells: np.ndarray, tails: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All keys of rows of one kind, and the number of keys in each row."""
    if kind == WORDS:
        return unpacked(tails, np.uint64)
    values, sizes = unpacked_ints(tails)
    return (np.repeat(cells.astype(np.int64), sizes) << 8 * (depth - CELL + 1)) | sums_of_steps(values, sizes), sizes


def by_cell(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of rows of one kind with whole cells, from rows in the order of kind and cell; a run has few keys or one (cell, salt)."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None

    def done() -> tuple[int, pa.RecordBatch]:
        return last[0], pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.stack([batch[c].to_numpy() for c in ("kind", "cell", "salt")])
        rooms = np.asarray(pa.compute.binary_length(batch["tails"]), dtype=np.int64)
        ends = [*np.flatnonzero((np.diff(names) != 0).any(axis=0)) + 1, batch.num_rows]
        start = 0
        for end in ends:
            name = tuple(names[:, start].tolist())
            if held and name != last and (name[0] != last[0] or size >= limit or name[1] == last[1]):
                yield done()
                held, size = [], 0
            held.append(batch.slice(start, end - start))
            size += int(rooms[start:end].sum())
            start, last = end, name
    if held:
        yield done()


def merged_lists(rows: DataFrame, by: list[str], depth: int) -> DataFrame:
    """One row (kind, cell, salt, tails, times, n, v) for each ``by``; n: the sum of times, v: how many aren't 0."""
    low = 8 * (depth - CELL + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, part in by_cell(batches, 4 * CELL_KEYS):
            cells = part["cell"].to_numpy()
            keys, n = merged(keys_of(kind, cells, part["tails"], depth)[0], unpacked_ints(part["times"])[0])
            cell = (keys >> low if kind == CONTEXTS else keys >> np.uint64(64 - WORD_CELL_BITS)).astype(np.int64)
            starts = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(keys))
            tails = packed_ints(steps(keys & ((1 << low) - 1), starts), starts) if kind == CONTEXTS else packed(keys, starts)
            count = len(starts) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(count, kind, np.int32)), pa.array(cell[starts[:-1]].astype(np.int32)), pa.array(np.full(count, part["salt"][0].as_py(), np.int32)), tails, packed_ints(n, starts), pa.array(shared.run_sums(n, starts)), pa.array(shared.run_sums((n > 0).astype(np.int64), starts))],
                ["kind", "cell", "salt", "tails", "times", "n", "v"],
            )

    dealt = rows.select("kind", "cell", "salt", "tails", "times").repartition(*by).sortWithinPartitions(*by)
    return shared.map_arrow(dealt, run, "kind int, cell int, salt int, tails binary, times binary, n long, v long")


def upper_paths(whole: DataFrame, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (three bytes of context, byte), and what is settled at each of them for the paths below.

    To the driver comes a row for each of them with what lies below.
    """
    levels = range(8)

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(pa.compute.binary_length(batch["tails"]), dtype=np.int64)
            for part in shared.by_bytes(batch, "tails", 2 * CELL_KEYS) if len(sizes) else ():
                order = np.argsort(part["cell"].to_numpy())
                part = part.take(pa.array(order))
                layers = Layers(keys_of(CONTEXTS, part["cell"].to_numpy(), part["tails"], depth)[0], unpacked_ints(part["times"])[0], depth, CELL)
                mixed = []
                for level in levels:
                    layers.mix(level)
                    mixed.append(pa.array(layers.mixed[CELL]))
                yield pa.RecordBatch.from_arrays([pa.array(layers.keys[CELL]), pa.array(layers.n[CELL]), *mixed], ["key", "n", *(f"m{k}" for k in levels)])

    got = shared.map_arrow(whole.select("cell", "tails", "times"), below, "key long, n double, " + ", ".join(f"m{k} double" for k in levels)).toArrow().sort_by("key")
    keys = got["key"].to_numpy()
    paths = np.zeros((8, 3, len(keys)))
    if len(keys):
        layers = Layers(keys, got["n"].to_numpy(), CELL, 0)
        start = np.ones(len(layers.keys[0]))
        for level in levels:
            layers.mix(level, got[f"m{level}"].to_numpy())
            paths[level] = layers.follow(0 * start, start, start / 2)
    return keys, paths


def followed(whole: DataFrame, upper, depth: int) -> DataFrame:
    """kind, cell, tails, values of every cell: counts of words, log10 probabilities of contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, paths = upper.value
        for batch in batches:
            for kind in (WORDS, CONTEXTS):
                for part in shared.by_bytes(batch.filter(pa.compute.equal(batch["kind"], kind)), "tails", 2 * CELL_KEYS):
                    values = part["times"]
                    if kind == CONTEXTS:
                        part = part.take(pa.array(np.argsort(part["cell"].to_numpy())))
                        keys, sizes = keys_of(kind, part["cell"].to_numpy(), part["tails"], depth)
                        layers = Layers(keys, unpacked_ints(part["times"])[0], depth, CELL)
                        at = np.searchsorted(top, layers.keys[CELL])
                        logs = np.zeros(len(keys))
                        for level in range(8):
                            layers.mix(level)
                            one = layers.follow(*paths[level][:, at])[2]
                            logs += np.log10(np.where(layers.bit[depth] == 1, one, 1 - one))
                        values = packed(logs.astype(np.float32), shared.runs(sizes))
                    yield pa.RecordBatch.from_arrays([part["kind"], part["cell"], part["tails"], values], ["kind", "cell", "tails", "values"])

    return shared.map_arrow(whole.select("kind", "cell", "tails", "times"), run, "kind int, cell int, tails binary, values binary")


def hot_cells(lists: DataFrame, whole: DataFrame) -> DataFrame:
    """kind, cell, copies of the cells whose lists are dealt out to more than one task: a task gets as many bytes of lists as of the cell's row, at least."""
    asked = lists.groupBy("kind", "cell").agg(F.sum(F.length("tails")).alias("asked")).where(F.col("asked") > SALT_BYTES)
    held = whole.select("kind", "cell", F.length("tails").alias("held"))
    copies = 1 + F.floor(F.col("asked") / F.greatest(F.lit(SALT_BYTES), "held"))
    return asked.join(held, ["kind", "cell"]).select("kind", "cell", copies.cast("int").alias("copies")).where("copies > 1")


def answers(lists: DataFrame, whole: DataFrame, upper, depth: int) -> DataFrame:
    """(unit, kind, cell, values) for each row of ``lists``, in the order of its tails: counts of words, log10 probabilities of contexts."""
    hot = shared.cut(hot_cells(lists, whole), "lm-hot")
    copies, null = F.coalesce("copies", F.lit(1)), F.lit(None).cast("binary")
    salt = F.pmod(F.xxhash64("unit"), copies).cast("int").alias("salt")
    asked = lists.join(hot, ["kind", "cell"], "left").select("kind", "cell", salt, "unit", "tails", null.alias("values"))
    known = followed(whole, upper, depth).join(hot, ["kind", "cell"], "left")
    known = known.select("kind", "cell", F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt"), F.lit(-1).cast("long").alias("unit"), "tails", "values")
    rows = asked.unionByName(known).repartition("kind", "cell", "salt").sortWithinPartitions("kind", "cell", "salt", "unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, part in by_cell(batches, 2 * CELL_KEYS):
            unit = part["unit"].to_numpy()
            given, asks = (part.filter(pa.array(x)) for x in (unit < 0, unit >= 0))
            keys = keys_of(kind, given["cell"].to_numpy(), given["tails"], depth)[0]
            values = unpacked(given["values"], np.float32)[0] if kind == CONTEXTS else unpacked_ints(given["values"])[0]
            for ask in shared.by_bytes(asks, "tails", CELL_KEYS):
                own, sizes = keys_of(kind, ask["cell"].to_numpy(), ask["tails"], depth)
                place, starts = np.searchsorted(keys, own), shared.runs(sizes)
                told = (packed if kind == CONTEXTS else packed_ints)(values[place], starts)
                yield pa.RecordBatch.from_arrays([ask["unit"], ask["kind"], ask["cell"], told], ["unit", "kind", "cell", "values"])

    return shared.map_arrow(rows, run, "unit long, kind int, cell int, values binary")


def text_scores(texts: pa.Array, keys: np.ndarray, logs: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """log10 probability of each text; ``logs`` are those of the (context, byte) ``keys``, which are in order."""
    out = np.zeros(len(texts))
    for own, owner in grams(texts, depth):
        order = np.argsort(own)
        own = own[order]
        first = np.concatenate([[True], own[1:] != own[:-1]])
        found = logs[np.searchsorted(keys, own[first])].astype(np.float64)
        out += np.bincount(owner[order], found[np.cumsum(first) - 1], len(texts))
    return out


def word_counts(texts: pa.Array, keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The training count of each word of each text, and the texts' numbers of words; ``times`` are those of the hashes ``keys``, which are in order."""
    data, offsets = shared.raw_bytes(texts)
    words, counted = shared.word_array(shared.lowered(data), offsets)
    words = words.dictionary_encode()
    return times[np.searchsorted(keys, shared.hash_words(words.dictionary))][words.indices.to_numpy()], counted


def score(docs: DataFrame, learn: Column, depth: int = DEPTH, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Of doc_id, text rows: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Everything is learnt from the rows where ``learn`` holds.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shared.bucketed(listed(docs.withColumn("held_out", ~learn), depth, unit_bytes), "lm-units", "kind", "unit", buckets) as units:
        documents, n_units = units.where(F.col("kind") == LEARNT).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_distinct("unit")).first()
        salts = 1 + n_units // SALT_UNITS
        lists = units.where(F.col("kind").isin(WORDS, CONTEXTS)).select("kind", "cell", F.pmod(F.xxhash64("unit"), F.lit(salts)).cast("int").alias("salt"), "unit", "tails", "times")
        whole = merged_lists(lists, ["kind", "cell", "salt"], depth)
        if salts > 1:
            whole = merged_lists(whole.withColumn("salt", F.lit(0)), ["kind", "cell", "salt"], depth)
        whole = shared.cut(whole, "lm-tables", compression="zstd")
        n, v = whole.where(F.col("kind") == WORDS).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
        n, v = n + documents, v + (documents > 0)
        upper = spark.sparkContext.broadcast(upper_paths(whole.where(F.col("kind") == CONTEXTS), depth))
        below = n + 0.1 * (v + 1)

        log_rate = lambda c: np.log10((np.asarray(c) + 0.1) / below)
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes"]

        def run(unit: pa.Table, got: pa.Table) -> pa.Table:
            known = {}
            for kind, read in ((CONTEXTS, lambda x: unpacked(x, np.float32)[0]), (WORDS, lambda x: unpacked_ints(x)[0])):
                asked, told = (t.filter(pa.compute.equal(t["kind"], kind)).sort_by("cell").combine_chunks() for t in (unit, got))
                if asked.num_rows:
                    known[kind] = keys_of(kind, asked["cell"].chunk(0).to_numpy(), asked["tails"].chunk(0), depth)[0], read(told["values"].chunk(0))
            del got, asked, told
            out = []
            for batch in unit.filter(pa.compute.equal(unit["kind"], TEXTS)).select(["doc_id", "held_out", "text"]).to_batches():
                for part in shared.by_bytes(batch, "text"):
                    total = text_scores(part["text"], *known[CONTEXTS], depth)
                    counts, counted = word_counts(part["text"], *known.get(WORDS, (np.zeros(0, np.uint64), np.zeros(0, np.int64))))
                    starts = shared.runs(counted)
                    base = shared.run_sums(log_rate(counts), starts) + log_rate(documents)
                    n_known = shared.run_sums((counts > 0).astype(np.int64), starts) + (documents > 0)
                    n_bytes = pa.compute.binary_length(part["text"]).fill_null(0).cast(pa.int64())
                    out.append(pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], pa.array(counted + 1), pa.array(n_known), pa.array(base), pa.array(total), n_bytes], names))
            return pa.Table.from_batches(out)

        schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"
        held = units.where(F.col("kind") != LEARNT).select("unit", "kind", "cell", "tails", "doc_id", "held_out", "text")
        rows = held.groupBy("unit").cogroup(answers(lists, whole, upper, depth).groupBy("unit")).applyInArrow(run, schema)
        scored = shared.cut(rows, "lm-scored")
        upper.destroy()
        shared.discard(whole)
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", bits.alias("bits_per_byte"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    return score(docs, F.pmod(shared.doc_crc(F.col("doc_id")), F.lit(10)) != 0)
