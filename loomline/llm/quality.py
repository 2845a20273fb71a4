"""Quality rules as a short-circuit cascade.

Each rule's cost (time per document) and selectivity (share it rejects) are
measured on a bounded sample, and the rules run in the order of rejections per
cost.  A rule sees only the documents that all rules before it let through.
A document is kept if no rule rejects it, so the order changes the time and
never the verdict.

The base counts are computed for every document.  Repeated 5-word windows are
compared by 64-bit hashes of the words' exact codes within one document.

Cases: a null text is an empty one: all counts 0, base_failed.  Repeated rows give
repeated rows, an empty table an empty one, long texts are read whole.  Of the
other columns only ``keep`` is carried, so no name clashes.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm import shared
from loomline.llm.sp_unigram import gather_runs

#: Fixed: the symbol characters, and the window of repeated words.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Documents on which the rules' costs and selectivities are estimated.
SAMPLE_ROWS = 512


class Page:
    """Some texts with their base counts."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = shared.raw_bytes(texts)
        self.words, self.n_words = shared.word_array(self.data, self.offsets)
        self.word_starts = shared.runs(self.n_words)
        codes = self.words.dictionary_encode()
        self.codes = np.asarray(codes.indices).astype(np.int64)
        space = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        self.word_chars = self._per_text(~space & ((self.data & 0xC0) != 0x80))
        symbol = np.zeros(256, dtype=bool)
        symbol[list(SYMBOLS)] = True
        self.n_symbols = self._per_text(symbol[self.data])
        self.n_lines, self.n_dup_lines = self._lines(space)
        self.n_repeat_words = self._repeats()
        self.base_failed = (self.n_words < 10) | (100 * self.n_repeat_words > 20 * self.n_words)

    def _per_text(self, flags: np.ndarray) -> np.ndarray:
        return shared.run_sums(flags.astype(np.int64), self.offsets)

    def _lines(self, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those equal to an earlier line of the text."""
        data, offsets = self.data, self.offsets
        texts = len(offsets) - 1
        filled = np.flatnonzero(np.diff(offsets) > 0)
        feed = data == 10
        at = np.flatnonzero(feed)
        where = np.searchsorted(offsets, at, side="right") - 1
        begins = np.concatenate([offsets[filled], at + 1])
        owner = np.concatenate([filled, where])
        order = np.lexsort((begins, owner))
        begins, owner = begins[order], owner[order]
        last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
        ends = np.where(last, offsets[owner + 1] if len(owner) else 0, np.append(begins[1:] - 1, 0)) if len(owner) else begins
        inked = np.concatenate([[0], np.cumsum(~space)])
        has_word = inked[ends] > inked[begins]
        begins, ends, owner = begins[has_word], ends[has_word], owner[has_word]
        flat, bounds = gather_spans(data, begins, ends)
        lines = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(flat))])
        codes = np.asarray(lines.dictionary_encode().indices).astype(np.int64)
        n = np.bincount(owner, minlength=texts)
        different = np.unique(owner * (len(codes) + 1) + codes) // (len(codes) + 1)
        return n, n - np.bincount(different, minlength=texts)

    def _repeats(self) -> np.ndarray:
        """Words in windows found twice or more in their text."""
        total = len(self.codes)
        owner = np.repeat(np.arange(len(self.n_words)), self.n_words)
        if total < WINDOW:
            return np.zeros(len(self.n_words), np.int64)
        ahead = total - WINDOW + 1
        inside = owner[:ahead] == owner[WINDOW - 1 :]
        h = shared.mix64(owner[:ahead].astype(np.uint64) + np.uint64(1))
        for k in range(WINDOW):
            h = shared.mix64(h * np.uint64(0x9E3779B97F4A7C15) + self.codes[k : k + ahead].astype(np.uint64) + np.uint64(1))
        starts = np.flatnonzero(inside)
        h = h[inside]
        ranked = np.sort(h)
        twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
        if not len(twice):
            return np.zeros(len(self.n_words), np.int64)
        found = twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h
        change = np.bincount(starts[found], minlength=total + 1) - np.bincount(starts[found] + WINDOW, minlength=total + 1)
        return shared.run_sums((np.cumsum(change)[:total] > 0).astype(np.int64), self.word_starts)

    def bytes_of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gather_runs(self.data, self.offsets, rows)

    def codes_of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gather_runs(self.codes, self.word_starts, rows)


def gather_spans(flat: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = ends - begins
    bounds = shared.runs(sizes)
    return flat[np.repeat(begins - bounds[:-1], sizes) + np.arange(bounds[-1])], bounds


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a page and row numbers, and says which of them to reject."""

    name: str
    rejects: Callable[[Page, np.ndarray], np.ndarray]


def many_symbols(page: Page, rows: np.ndarray) -> np.ndarray:
    return 10 * page.n_symbols[rows] > page.n_words[rows]


def repeated_lines(page: Page, rows: np.ndarray) -> np.ndarray:
    return 10 * page.n_dup_lines[rows] > 3 * page.n_lines[rows]


def odd_word_length(page: Page, rows: np.ndarray) -> np.ndarray:
    mean = page.word_chars[rows] / np.maximum(page.n_words[rows], 1)
    return (mean < 2) | (mean > 15)


def stammering(page: Page, rows: np.ndarray) -> np.ndarray:
    """More than three tenths of the words repeat the word before them."""
    codes, starts = page.codes_of(rows)
    same = np.zeros(len(codes), dtype=np.int64)
    same[1:] = codes[1:] == codes[:-1]
    same[starts[:-1][starts[:-1] < len(codes)]] = 0
    return 10 * shared.run_sums(same, starts) > 3 * np.diff(starts)


def shouting(page: Page, rows: np.ndarray) -> np.ndarray:
    """More than half of the ASCII letters are capitals."""
    data, starts = page.bytes_of(rows)
    capital = (data >= 65) & (data <= 90)
    letter = capital | ((data >= 97) & (data <= 122))
    return 2 * shared.run_sums(capital.astype(np.int64), starts) > shared.run_sums(letter.astype(np.int64), starts)


def few_letters(page: Page, rows: np.ndarray) -> np.ndarray:
    """Less than half of the bytes in words belong to letters (or to other scripts)."""
    data, starts = page.bytes_of(rows)
    lower = data | 32
    letter = ((lower >= 97) & (lower <= 122)) | (data >= 128)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    return 2 * shared.run_sums(letter.astype(np.int64), starts) < shared.run_sums((~space).astype(np.int64), starts)


RULES = (
    Rule("many_symbols", many_symbols),
    Rule("repeated_lines", repeated_lines),
    Rule("odd_word_length", odd_word_length),
    Rule("stammering", stammering),
    Rule("shouting", shouting),
    Rule("few_letters", few_letters),
)


def estimate(df: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Each rule's (cost in ns per document, share it rejects) on a sample of ``keep``, ``text``.

    The sample has the ``sample_rows`` rows of the lowest id hash; only counts come to the driver.
    """
    chosen = df.select("keep").orderBy(F.xxhash64(F.col("keep").cast("string")), F.col("keep")).limit(sample_rows)
    sample = df.join(F.broadcast(chosen.distinct()), "keep", "left_semi")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                page = Page(part["text"])
                rows = np.flatnonzero(~page.base_failed)
                if not len(rows):
                    continue
                got = []
                for rule in rules:
                    began = time.perf_counter_ns()
                    rejected = int(rule.rejects(page, rows).sum())
                    got.append((rule.name, time.perf_counter_ns() - began, rejected, len(rows)))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*got)], ["rule", "ns", "rejected", "rows"])

    seen = shared.map_arrow(sample, measure, "rule string, ns long, rejected long, rows long").groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("ns", "rejected", "rows")])
    return {r["rule"]: (r["ns"] / r["rows"], r["rejected"] / r["rows"]) for r in seen.collect()}


def ordered(rules: tuple[Rule, ...], measured: dict[str, tuple[float, float]]) -> tuple[Rule, ...]:
    """Most rejections per cost first; unmeasured rules last."""

    def worth(rule: Rule) -> float:
        cost, share = measured.get(rule.name, (1.0, -1.0))
        return share / max(cost, 1.0)

    return tuple(sorted(rules, key=worth, reverse=True))


def cascade(page: Page, rules: tuple[Rule, ...]) -> np.ndarray:
    """Which rows every rule lets through; base failures aren't looked at."""
    kept = np.zeros(len(page.n_words), dtype=bool)
    rows = np.flatnonzero(~page.base_failed)
    for rule in rules:
        if not len(rows):
            break
        rows = rows[~rule.rejects(page, rows)]
    kept[rows] = True
    return kept


def quality(df: DataFrame, text: str = "text", keep: str = "doc_id", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``keep``, the base counts, base_failed and kept for every row."""
    read = df.select(F.col(keep).alias("keep"), F.col(text).cast("string").alias("text"))
    run = ordered(rules, estimate(read, rules, sample_rows))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                page = Page(part["text"])
                columns = [pa.array(getattr(page, c), pa.int64()) for c in counts]
                yield pa.RecordBatch.from_arrays([part["keep"], *columns, pa.array(page.base_failed), pa.array(cascade(page, run))], ["keep", *counts, "base_failed", "kept"])

    fields = [read.schema["keep"], *[T.StructField(c, T.LongType()) for c in counts], T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    return shared.map_arrow(read, judge, T.StructType(fields)).withColumnRenamed("keep", keep)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(shared.table(spark, sf_dir, "documents"))
