"""The pipeline's stages, each on its own input, against brute force; and the whole run."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from loomline.llm import mixing, shared, sp_unigram
from tests.llm.test_llm_operators import SF, base_spans, brute_components, words


@pytest.fixture(scope="module")
def stages(spark):
    held = [shared.table(spark, SF, "documents")]
    for name, stage in P.STAGES:
        held.append(shared.cut(stage(spark, held[-1], SF), f"test-{name}"))
    return held


def test_shape(stages):
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "personal_data", "mixing", "sentencepiece"]
    assert all(df.schema == stages[0].schema for df in stages[1:-1])
    assert P.ORACLE_SQL is None


def test_language_id_keeps_prose(stages):
    kept = {r["doc_id"] for r in stages[1].collect()}
    gone = [r for r in stages[0].collect() if r["doc_id"] not in kept]
    assert len(gone) <= 0.02 * len(kept) and all(len(words(r["text"])) < 30 for r in gone)


def test_near_dedup_keeps_the_first_of_each_group(stages):
    before = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    want = {i for i, (_, c) in brute_components(before, P.SIMILARITY_PERCENT).items() if i == c}
    assert {r["doc_id"] for r in stages[2].collect()} == want


def test_personal_data_is_gone_and_clean_texts_stay(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    for r in stages[3].collect():
        old = before[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
        if any(base_spans(old).values()):
            assert r["text"] != old and not any(base_spans(r["text"]).values())
            pieces = sorted(s for spans in base_spans(old).values() for s in spans)
            assert r["text"].startswith(old[: pieces[0][0]][:20])
        elif "<" not in r["text"]:
            assert r["text"] == old


def test_mixing_repeats_whole_documents(stages):
    rows = mixing.sized(stages[3])
    planned = {r["doc_id"]: r for r in mixing.mix(rows, mixing.plan(rows)).collect()}
    times = {}
    for r in stages[4].collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        assert r["text"] == planned[r["doc_id"]]["text"]
    for i, r in planned.items():
        assert times.get(i, 0) == (int(r["__mix_taken"] / r["__mix_size"] + 0.5) if r["__mix_size"] else 0)
    assert max(times.values()) <= mixing.MAX_EPOCHS


def test_pieces_give_the_texts_back(stages):
    out = sp_unigram.decode(stages[5]).collect()
    assert len(out) == stages[4].count() and all(r["decoded"] == r["text"] and r["round_trip"] for r in out)


def test_run_gives_the_last_stage(spark, stages):
    assert P.run(spark, SF).count() == stages[5].count()


def test_stages_take_empty_tables(spark, stages):
    docs = stages[0].limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_stages_take_nulls_repeats_and_clashing_columns(spark, stages):
    """Extra columns pass through every stage but the last under any name the operators use themselves."""
    names = ("size", "taken", "target", "source_size", "score", "lang_pred", "rejected", "kept", "component_id", "spans", "kind", "key", "label", "row")
    odd = [(None, "the and of this with", "en", None, None), (1, None, None, "a", 3), (10**9, "", "en", "b", 0), (10**9, "", "en", "b", 0)]
    docs = stages[0].unionByName(spark.createDataFrame(odd, stages[0].schema)).unionByName(stages[0].limit(3))
    docs = docs.withColumns({n: stages[0].text.substr(1, 3) if n == "size" else F.lit(n) for n in names})
    for _, stage in P.STAGES[:-1]:
        schema = docs.schema
        docs = shared.cut(stage(spark, docs, SF), "test-odd")
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in schema]
        rows = docs.collect()
        assert rows and all(r[n] == n for r in rows for n in names if n != "size")
    assert P.STAGES[-1][1](spark, docs, SF).count() == len(rows)
