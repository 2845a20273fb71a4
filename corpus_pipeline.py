"""Corpus pipeline: from ``documents`` to encoded, mixed, clean training texts.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept:

1. language ID is trained on the labelled texts and drops the documents it rejects;
2. MinHash near-dedup keeps one document of each group of texts that share 0.8 of
   their 5-word shingles or more;
3. personal data is replaced by its kind in the texts;
4. the sources are mixed to their target weights: documents are left out, kept or
   repeated, in whole copies;
5. the texts are encoded as SentencePiece Unigram pieces, with the round trip checked.

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import lang_id, mixing, neardup, pii, shared, sp_unigram

SIMILARITY_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = lang_id.fit(docs, F.lit(True))
    return lang_id.predict(docs, model).where("NOT __lid_rejected").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_first(docs, percent=SIMILARITY_PERCENT)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = mixing.sized(docs)
    return mixing.repeat(mixing.mix(rows, mixing.plan(rows))).select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sp_unigram.encode(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: SQL can't train a classifier; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = shared.cut(docs, f"stage-{name}")
    return docs
