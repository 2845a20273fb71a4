"""Language ID: averaged hashed subword embeddings and a linear softmax.

A word's subwords are the word itself with its end marks and its 2- to 4-grams of
UTF-8 bytes, each hashed into a table of embeddings.  A text's vector is the mean
over all its words' subwords, and a linear softmax over the languages reads it.
Embeddings and softmax are trained together by stochastic gradient descent in
numpy, on a bounded sample of labelled documents (``SAMPLE_ROWS`` in all, dealt
evenly over the languages by a hash of id and text; repeated rows count once).

A share of the sample is held back to calibrate, together with copies of its texts whose
subwords are in random slots, as in languages never learnt.  The softmax's temperature is
the likeliest for the held-back texts' languages and for no language at all for the copies; a text
is rejected below the score that parts them with the fewest errors (the lowest such score,
so that texts of the learnt languages stay).

As the mean comes before the linear layer, the trained tables fold into one table
of hash slots by languages; its size is fixed.  A batch's distinct words are
looked up once.

Cases: a text that is null or has no letter is ``und`` with score 0 and rejected;
without any labelled training document every text is ``und``.  Words are lower-cased
by Unicode rules.  Repeated rows give repeated rows, an empty table an empty one;
whole texts count however long.  Other columns pass through under any name but one that
starts with ``__lid_``, as the results' names do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm import shared

SLOTS = 1 << 15
DIMENSIONS = 16
GRAMS = (2, 3, 4)
#: Labelled documents that the model is trained on, at most.
SAMPLE_ROWS = 3000
EPOCHS = 8
RATE = 0.5
#: A language gets so many sample rows at least; of more languages than fit, the commonest are learnt.
LEAST_EACH = 10
#: Copies in random slots, as of unknown languages, of each held-back text.
FOREIGN = 2
UNKNOWN = "und"


def slots_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash slots of each word's subwords, and the words' starts among them (n + 1)."""
    data, offsets = shared.raw_bytes(words)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    starts = shared.runs(sizes + 2)
    marked = np.zeros(starts[-1], dtype=np.uint64)
    marked[starts[:-1]] = 1
    marked[starts[1:] - 1] = 2
    inner = np.ones(len(marked), dtype=bool)
    inner[starts[:-1]] = inner[starts[1:] - 1] = False
    marked[inner] = data
    owner = np.repeat(np.arange(n), sizes + 2)
    slots, owners = [], []
    h = np.zeros(len(marked), dtype=np.uint64)
    for k in range(max(GRAMS)):
        h[: len(h) - k] = h[: len(h) - k] * np.uint64(0x100000001B3) + marked[k:] + np.uint64(k + 1)
        if k + 1 in GRAMS:
            inside = np.flatnonzero(owner[: len(h) - k] == owner[k:])
            slots.append(shared.mix64(h[inside] + np.uint64(k)))
            owners.append(owner[inside])
    slots.append(shared.hash_words(words))
    owners.append(np.arange(n))
    order = np.argsort(np.concatenate(owners), kind="stable")
    counts = np.bincount(np.concatenate(owners), minlength=n)
    return (np.concatenate(slots)[order] % np.uint64(SLOTS)).astype(np.int64), shared.runs(counts)


def folded(texts: pa.Array) -> pa.Array:
    return pa.compute.utf8_lower(texts.fill_null("").cast(pa.large_string()))


def with_letter(texts: pa.Array) -> np.ndarray:
    return np.asarray(pa.compute.match_substring_regex(texts, r"\p{L}"))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # slots by languages
    bias: np.ndarray
    temperature: float
    reject_below: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        """Of folded texts."""
        words, counts = shared.word_array(*shared.raw_bytes(texts))
        out = np.zeros((len(texts), len(self.languages)))
        if not len(words):
            return out + self.bias
        coded = words.dictionary_encode()
        slots, starts = slots_of(coded.dictionary)
        which = np.asarray(coded.indices)
        by_text = shared.runs(counts)
        subwords = shared.run_sums(np.diff(starts)[which], by_text)
        for k in range(len(self.languages)):
            word_sums = np.add.reduceat(self.table[slots, k], starts[:-1])
            out[:, k] = shared.run_sums(word_sums[which], by_text) / np.maximum(subwords, 1)
        return out + self.bias


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, str]], seed: int = 7) -> Model | None:
    """Fits a model to (slots, counts, language) rows; None without rows."""
    languages = sorted({r[2] for r in rows})
    if not languages:
        return None
    number = {x: i for i, x in enumerate(languages)}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    back = set(order[: len(rows) // 5].tolist()) if len(rows) >= 10 * len(languages) else set()
    fit = [r for i, r in enumerate(rows) if i not in back]
    embed = rng.uniform(-1, 1, (SLOTS, DIMENSIONS)) / DIMENSIONS
    weight, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, step = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(fit)).tolist():
            slots, counts, language = fit[i]
            share = counts.astype(np.float64) / counts.sum()
            hidden = share @ embed[slots]
            p = softmax((hidden @ weight + bias)[None])[0]
            p[number[language]] -= 1.0
            rate = RATE * (1 - step / steps)
            back_hidden = weight @ p
            weight -= rate * np.outer(hidden, p)
            bias -= rate * p
            # the mean makes each slot's step small; its share is scaled to the largest
            embed[slots] -= rate * np.outer(share / share.max(), back_hidden)
            step += 1
    table = embed @ weight
    held = [r for i, r in enumerate(rows) if i in back] or fit
    of = lambda rows: np.array([(c / c.sum()) @ table[s] + bias for s, c in rows])
    logits, foreign = of([r[:2] for r in held]), of([(rng.integers(0, SLOTS, len(s)), c) for s, c, _ in held for _ in range(FOREIGN)])
    truth = np.array([number[r[2]] for r in held])

    def loss(t: float) -> float:
        logs = [np.log(np.maximum(softmax(x / t), 1e-12)) for x in (logits, foreign)]
        return -logs[0][np.arange(len(truth)), truth].mean() - logs[1].mean()

    temperature = float(min(np.exp(np.linspace(-2.5, 2.5, 101)), key=loss))
    top, strange = (np.sort(softmax(x / temperature).max(axis=1)) for x in (logits, foreign))
    limits = np.concatenate([[0.0], np.nextafter(strange, 2)])
    errors = np.searchsorted(top, limits) / len(top) + 1 - np.searchsorted(strange, limits) / len(strange)
    reject_below = float(limits[errors.argmin()]) if len(languages) > 1 else 0.0
    return Model(languages, table, bias, temperature, reject_below)


def features(df: DataFrame) -> DataFrame:
    """(slots, counts, lang, h) of ``text``, ``lang``, ``h`` rows; slots fit 16 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                slots, counts = [], []
                for row in range(part.num_rows):
                    words, _ = shared.word_array(*shared.raw_bytes(folded(part["text"].slice(row, 1))))
                    coded = words.dictionary_encode()
                    hashed, starts = slots_of(coded.dictionary)
                    times = np.bincount(np.asarray(coded.indices), minlength=len(coded.dictionary))
                    seen = np.bincount(hashed, weights=np.repeat(times, np.diff(starts)), minlength=SLOTS)
                    slots.append(np.flatnonzero(seen).astype(np.int16))
                    counts.append(seen[slots[-1]].astype(np.float32))
                yield pa.RecordBatch.from_arrays([pa.array(slots, pa.list_(pa.int16())), pa.array(counts, pa.list_(pa.float32())), part["lang"], part["h"]], ["slots", "counts", "lang", "h"])

    return shared.map_arrow(df.select("text", "lang", "h"), run, "slots array<smallint>, counts array<float>, lang string, h long")


def fit(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Trains on a sample of the rows where ``learn`` holds that have a language and a letter.

    Counts by language set each language's hash threshold; the rows below it, repeats
    taken once, are few, and of those the smallest hashes are the sample.  Its features
    (bounded by ``sample_rows`` times the slots) come to the driver.
    """
    known = docs.where(learn).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), F.col(doc_id).cast("string").alias("id"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = known.select("lang", "text", F.shiftrightunsigned(F.xxhash64(F.lit("lang-sample"), "id", "text"), 1).alias("h"))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least"))
    counts = counts.orderBy(F.desc("n"), "lang").limit(max(1, sample_rows // LEAST_EACH)).collect()
    if not counts:
        return None
    each = sample_rows // len(counts)
    limits = [(r["lang"], max(r["least"], min(int(2.0**63 * 1.5 * each / r["n"]), 2**63 - 1))) for r in counts]
    limit = F.element_at(F.create_map(*[F.lit(v) for pair in limits for v in pair]), F.col("lang"))
    few = shared.cut(known.where(F.col("h") <= limit).dropDuplicates(["lang", "h"]), "lang-sample")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    sample = few.select("lang", "h", rank.alias("rank")).where(F.col("rank") <= each).select("lang", "h")
    got = features(few.join(F.broadcast(sample), ["lang", "h"])).toArrow().sort_by("h").combine_chunks()  # at most sample_rows keys
    starts = shared.runs(got["slots"].combine_chunks().value_lengths().to_numpy())
    slots, times = (got[c].combine_chunks().flatten().to_numpy() for c in ("slots", "counts"))
    rows = [(slots[a:b], times[a:b], language) for a, b, language in zip(starts, starts[1:], got["lang"].to_pylist()) if b > a]
    model = train(rows)
    shared.discard(few)
    del got, slots, times, rows
    pa.default_memory_pool().release_unused()
    return model


#: What ``predict`` adds to the columns of its input.
ADDED = {"__lid_pred": T.StringType(), "__lid_score": T.DoubleType(), "__lid_rejected": T.BooleanType()}


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Adds __lid_pred, __lid_score (calibrated) and __lid_rejected to every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # slots times languages
    kept = docs.columns
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in ADDED.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for part in shared.by_bytes(batch, text):
                texts = folded(part[text])
                if model is None:
                    names, top, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                else:
                    found = with_letter(texts)
                    p = softmax(model.logits(texts) / model.temperature)
                    names = [model.languages[i] if f else UNKNOWN for i, f in zip(p.argmax(axis=1).tolist(), found.tolist())]
                    top = np.where(found, p.max(axis=1), 0.0)
                    rejected = ~found | (top < model.reject_below)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(top), pa.array(rejected)], [*kept, *ADDED])

    return shared.map_arrow(docs, run, schema)


def held_out(doc_id: Column) -> Column:
    return F.pmod(shared.doc_crc(doc_id), F.lit(5)) == 0


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    model = fit(docs, ~held_out(F.col("doc_id")))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__lid_pred").alias("lang_pred"), F.col("__lid_score").alias("score"), F.col("__lid_rejected").alias("rejected"))
