"""Token counts: lengths only, over byte-balanced batches of safe segments.

A text is cut where no token can span: at a space after something that is no
space, if no piece of the vocabulary goes on with a space after anything else.
The segment after the cut is encoded without that space, because the encoder
puts one before each input.  The counts of a text's segments then add up to
the library's count of the whole text.  Distinct segments are encoded once per
batch and remembered in bounded memory; batches hold about the same bytes.

Vocabularies without that property, or with another normaliser, are given the
whole texts.

Cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows give
repeated rows; an empty table gives an empty one; of the other columns only
``keep`` is carried, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm import shared, sp_model

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096


def safe_segments(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The segments of all texts in order, and each text's number of them."""
    data, offsets = shared.raw_bytes(texts)
    n = len(data)
    cut = np.zeros(n, dtype=bool)
    if n > 2:
        # 0x81 ends the format's own space mark
        cut[1:-1] = (data[1:-1] == 32) & (data[:-2] != 32) & (data[:-2] != 0x81)
        edge = np.concatenate([offsets[:-1], offsets[1:] - 1])
        cut[edge[(edge >= 0) & (edge < n)]] = False
    filled = np.diff(offsets) > 0
    seen = np.concatenate([[0], np.cumsum(cut)])
    counts = np.diff(seen[offsets]) + filled
    left = np.arange(n + 1) - seen
    at = np.sort(np.concatenate([offsets[:-1][filled], np.flatnonzero(cut) + 1]))
    starts = np.append(left[at], left[-1]).astype(np.int64)
    segments = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(starts), pa.py_buffer(data[~cut])])
    return segments, counts


class Counter:
    """Counts the tokens of Arrow arrays of texts with one vocabulary."""

    def __init__(self, path: str, split: bool):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.split = split
        self.memo = shared.WordMemo(self._lengths)

    def _lengths(self, segments: list[bytes]) -> list[int]:
        return [len(x) for x in self.model.encode([s.decode() for s in segments], num_threads=1)]

    def __call__(self, texts: pa.Array) -> np.ndarray:
        if not self.split:
            return np.array([len(x) for x in self.model.encode(texts.fill_null("").to_pylist(), num_threads=1)], dtype=np.int64)
        segments, counts = safe_segments(texts)
        coded = segments.dictionary_encode()
        lengths = np.array(self.memo(coded.dictionary.to_pylist()), dtype=np.int64)
        each = lengths[np.asarray(coded.indices)] if len(segments) else np.zeros(0, np.int64)
        return shared.run_sums(each, shared.runs(counts))


def token_counts(df: DataFrame, text: str = "text", keep: str = "doc_id", model_path: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """``keep``, n_bytes, n_tokens, over_limit of every row's whole text."""
    path = model_path or public_tokenizers.path(MODEL)
    known = sp_model.read(path)
    split = known.plain and known.breaks_at_spaces

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, split)
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                texts = part["text"]
                sizes = pa.compute.binary_length(texts.fill_null("")).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part["keep"], sizes, pa.array(counter(texts), pa.int64())], ["keep", "n_bytes", "n_tokens"])

    read = df.select(F.col(keep).alias("keep"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([read.schema["keep"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    out = shared.map_arrow(read, count, schema)
    return out.select(F.col("keep").alias(keep), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(shared.table(spark, sf_dir, "documents"))
