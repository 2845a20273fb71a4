"""Alignment, point-in-time join and n-gram join: edge cases, and each registered query against brute force."""

import bisect
import hashlib
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from loomline.llm import alignment, parity_join, point_in_time, registry
from tests.llm.test_llm_operators import LOW, docs, words

SF = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


def table_of(sf, name):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


# -- 11: alignment ------------------------------------------------------------


@pytest.fixture(scope="module")
def libraries():
    first = tokenizers.Tokenizer.from_file(public_tokenizers.path(alignment.VOCABULARY_A))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.VOCABULARY_B))


def brute_alignment(libraries, texts):
    """Per text: (n_a, n_b, n_groups, n_links, n_best, count_sum), groups; from the libraries on whole texts."""
    first, second = libraries
    byte_of = alignment.byte_level()
    spelled = {i: bytes(byte_of[c] for c in e) if all(c in byte_of for c in e) else e.encode() for e, i in first.get_vocab().items()}

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    found, counts = [], Counter()
    for text in texts:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a, bytes_b = [spelled[i] for i in a], [piece(i) for i in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            found.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        of_a, of_b = dict(zip(ends_a, a)), dict(zip(ends_b, b))
        links = [(of_a[e], of_b[e]) for e in common]
        counts.update(links)
        groups = {e: ([], []) for e in common}
        for side, (ids, ends) in enumerate(((a, ends_a), (b, ends_b))):
            for i, end in zip(ids, ends):
                groups[common[bisect.bisect_left(common, end)]][side].append(str(i))
        groups = ["|".join(map(",".join, groups[e])) for e in common]
        found.append((len(a), len(b), links, ";".join(groups)))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [((0,) * 6, "") if x is None else ((x[0], x[1], len(x[2]), len(x[2]), sum(counts[k] == best[k[1]] for k in x[2]), sum(counts[k] for k in x[2])), x[3]) for x in found], counts


TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "plain words only here", "<|endoftext|> </s> <s> <unk> <0x41>", "the space mark ▁ is lost", "over \n  two  spaces\t\tand tabs \n",
    "mañana straße où été пример текста 中文 字符 ☃ 😀 é", "no break   space　wide \u0085 x", "x" * 3000, "don't  we'll 3.14 1,000 C++ && ||", "“quoted” text – dash… end", "\x00 nul \x7f",
]


@pytest.mark.parametrize("unit_bytes", [1, 40, 1 << 20])
def test_alignment_equals_the_libraries_on_whole_texts(spark, libraries, unit_bytes):
    rows = [(i if i % 5 else None, t, "en", "a") for i, t in enumerate(TEXTS + TEXTS[5:9])]
    got, pairs = alignment.align(docs(spark, rows).repartition(2), unit_bytes=unit_bytes)
    want, counts = brute_alignment(libraries, [r[1] for r in rows])
    key = lambda doc, numbers, groups: (-1 if doc is None else doc, tuple(numbers), groups)
    assert sorted(key(r["doc_id"], [r[c] for c in alignment.COUNTS], r["groups"]) for r in got.collect()) == sorted(key(r[0], *w) for r, w in zip(rows, want))
    assert {(r["a"], r["b"]): r["count"] for r in pairs.collect()} == dict(counts)


def test_segments_join_to_the_texts():
    rng = random.Random(2)
    alphabet = ["a", "b", " ", " ", "\n", "é", "▁", " ", "中", "　", "😀", "“"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(400)]
    segments, counts = alignment.cut_segments(pa.array(texts))
    parts, at = [s.decode() for s in segments.to_pylist()], 0
    for text, n in zip(texts, counts.tolist()):
        assert " ".join(parts[at : at + n]) == text and (n > 0) == bool(text)
        at += n
    assert at == len(parts) and alignment.cut_segments(pa.array(texts), split=False)[1].max() == 1


def test_alignment_of_random_texts(spark, libraries):
    rng = random.Random(4)
    alphabet = ["a", "the", "'s", "1", " ", " ", " ", "\n", "é", " ", "中", "　", "😀", ".", "“"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(40))), "en", "a") for i in range(300)]
    got = {r["doc_id"]: (tuple(r[c] for c in alignment.COUNTS), r["groups"]) for r in alignment.align(docs(spark, rows), unit_bytes=500)[0].collect()}
    assert got == dict(enumerate(brute_alignment(libraries, [r[1] for r in rows])[0]))


def test_alignment_of_nothing(spark):
    rows, pairs = alignment.align(docs(spark, []))
    assert rows.count() == 0 and pairs.count() == 0


def test_words_encoded_together_equal_those_encoded_alone(spark, libraries):
    """Whatever lies beside a word: white space at its end, the space mark, strings of special tokens."""
    first, second = libraries
    some = ["a", "the", "don't", "x▁y", "end\n", "tab\t", " led", "wide　", "nb\u00a0", "<|endoftext|>", "</s>", "中文", "😀", "é", "☃", "1,000", "▁"] + [f"w{i}'s" for i in range(200)]
    random.Random(7).shuffle(some)
    table = spark.createDataFrame([(w, n, [(0, n)]) for n, w in enumerate(some)], "word string, times long, places array<struct<unit: long, i: int>>").coalesce(1)
    paths = [public_tokenizers.path(x) for x in (alignment.VOCABULARY_A, alignment.VOCABULARY_B)]
    for split in (True, False):
        got = {r["times"]: r for r in alignment.encoded(table, *paths, split).collect()}
        assert len(got) == len(some)
        for n, word in enumerate(some):
            a, b = first.encode(" " + word, add_special_tokens=False).ids, second.encode(word)
            assert got[n]["good"] == ("▁" not in word) and got[n]["places"] == [(0, n)]
            assert (got[n]["n_a"], got[n]["ids"]) == ((len(a), a + b) if got[n]["good"] else (0, [])) and len(got[n]["sizes"]) == len(got[n]["ids"])
            assert sum(got[n]["sizes"]) == (2 * len((" " + word).encode()) if got[n]["good"] else 0)


def test_segments_are_dealt_and_exploded_once(spark):
    table = spark.createDataFrame([(k, 1, 2, [5, 6, 7], [2, 1, 3]) for k in range(50)], "sid long, times long, n_a int, ids array<int>, sizes array<int>")
    with alignment.step_by_step(spark):
        done = alignment.aligned(table)
        plan = done._jdf.queryExecution().executedPlan().toString()
        assert {(r["n_a"], r["n_b"], r["n_groups"], r["groups"], tuple(map(tuple, r["links"]))) for r in done.collect()} == {(2, 1, 1, "5,6|7", ((6, 7),))}
    assert (plan.count("Exchange"), plan.count("Generate "), plan.count(" Sort ["), plan.count("Join")) == (1, 1, 2, 0)


def test_steps_leave_no_shuffle_files(spark):
    """Each step's table is written when the next begins, so its shuffle is not needed any more."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+", disk.getAllBlocks().mkString(" ")))
    before = held()
    rows, _ = alignment.align(docs(spark, [(i, f"some words {i} ▁" if i % 9 == 0 else f"other words {i}", "en", "a") for i in range(60)]))
    deadline = time.time() + 20
    while held() - before and time.time() < deadline:  # files go in the background
        time.sleep(0.2)
    assert not held() - before and rows.count() == 60


def test_op11(spark, libraries):
    documents = table_of(SMALL, "documents")
    want, _ = brute_alignment(libraries, [r["text"] for r in documents])
    got = {r["doc_id"]: (tuple(r[c] for c in alignment.COUNTS), r["groups_sha256"]) for r in registry.QUERIES["op11_alignment"](spark, SMALL).collect()}
    assert got == {r["doc_id"]: (numbers, hashlib.sha256(groups.encode()).hexdigest() if groups else "") for r, (numbers, groups) in zip(documents, want)}


# -- 12: point in time ------------------------------------------------------------


def test_bins_cover_an_interval_exactly_and_shortly(spark):
    rng = random.Random(1)
    spans = [(s, s + n) for s, n in [(0, 0), (5, 0), (5, 1), (-7, 20), (-1, 1), (0, 512), (3, 5000)]] + [(rng.randrange(-3000, 3000), 0) for _ in range(200)]
    spans = [(s, e if e > s else s + rng.randrange(0, 1500)) for s, e in spans]
    rows = spark.createDataFrame(spans, "s long, e long")
    for r in rows.select("s", "e", point_in_time.covering_bins(F.col("s"), F.col("e")).alias("bins")).collect():
        seconds = sorted(t for b in r["bins"] for t in range(b["bin"] << b["width"], (b["bin"] + 1) << b["width"]))
        assert seconds == list(range(r["s"], r["e"]))
        assert len(r["bins"]) <= 2 * (point_in_time.WIDTHS - 1) + (r["e"] - r["s"]) // 512


VERSIONS = "source string, event long, arrival long, expiry long, doc_id long, note string, t long, __x string"


def brute_winner(versions, source, t):
    usable = [v for v in versions if source is not None and t is not None and None not in v[:4] and v[0] == source and v[1] <= t and v[2] <= t < v[3]]
    return max(usable, key=lambda v: (v[1], -v[2], v[4] is not None, v[4] or 0, v[5] is not None, v[5] or ""), default=None)


def test_latest_usable_equals_brute_force(spark):
    rng = random.Random(9)
    versions = []
    for i in range(400):
        event = rng.randrange(200)
        versions.append((rng.choice("hhhab"), event, event + rng.randrange(-5, 30), event + rng.randrange(-5, 60), rng.choice([i, i, i % 7, None]), rng.choice([None, "x", "y"]), 1, "z"))
    versions += [versions[0], (None, 1, 1, 50, 1, None, 1, None), ("a", None, 1, 50, 1, None, 1, None), ("a", 1, None, 50, 1, None, 1, None), ("a", 1, 1, None, 1, None, 1, None), ("a", 10, 20, 20, 1, None, 1, None)]
    versions += [("long", -50, -60, 100_000, 3, "all", 1, None)]
    asks = [(rng.choice(["h", "a", "b", "long", "none", None]), rng.choice([rng.randrange(-10, 280), None]), k % 90) for k in range(500)]
    ask_rows = spark.createDataFrame([(s, t, k, "clash", 1, 2) for s, t, k in asks], "source string, t int, doc_id long, event string, arrival long, expiry long")
    out = point_in_time.latest_usable(ask_rows, spark.createDataFrame(versions, VERSIONS), carry=("note",))
    assert out.columns == [*ask_rows.columns, "__pit_winner"]
    show = lambda s, t, k, w: repr((s, t, k, w))
    got = sorted(show(r["source"], r["t"], r["doc_id"], r["__pit_winner"] and (r["__pit_winner"]["event"], -r["__pit_winner"]["early"], r["__pit_winner"]["id"], r["__pit_winner"]["row"]["note"])) for r in out.collect())
    won = [brute_winner(versions, s, t) for s, t, _ in asks]
    assert got == sorted(show(s, t, k, w and (w[1], w[2], w[4], w[5])) for (s, t, k), w in zip(asks, won))
    assert sum(w is not None for w in won) > 100


def test_latest_usable_of_nothing(spark):
    asks, versions = spark.createDataFrame([("a", 1)], "source string, t long"), spark.createDataFrame([], VERSIONS)
    assert [r["__pit_winner"] for r in point_in_time.latest_usable(asks, versions).collect()] == [None]
    assert point_in_time.latest_usable(asks.limit(0), versions).count() == 0


def test_point_in_time_broadcasts_nothing(spark):
    """However small the tables are, and no hot key makes pairs: the joins' rows stay below asks times widths."""
    plan = registry.QUERIES["op12_point_in_time"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Cartesian" not in plan and "SortMergeJoin" in plan


def test_op12(spark):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    want = con.execute(registry.ORACLES["op12_point_in_time"])
    columns = [d[0] for d in want.description]
    got = registry.QUERIES["op12_point_in_time"](spark, SMALL)
    assert got.columns == columns and sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_op12_with_repeated_and_null_ids(spark, tmp_path):
    rows = [(i, "x", None if i == 3 else "ab"[i % 2], "s" if i % 3 else None, i) for i in [1, 2, 3, 4, 5, 6, 2, 4]] + [(None, "x", "a", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (2, 1), (2, 1), (99, 1), (None, 1), (3, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = registry.QUERIES["op12_point_in_time"](spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter([1, 2, 2, 99, None, 3])
    assert all(r["status"] == "none" for r in got if r["doc_id"] in (99, None, 3)) and [r["t"] for r in got if r["doc_id"] is None] == [None]


# -- 13: n-gram join ------------------------------------------------------------


def grams(text, width=3):
    w = words((text or "").translate(LOW))
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_join(rows, percent=90):
    """(n_shingles, component_id) by id: all pairs that share a shingle."""
    sets = {i: grams(t) for i, t in rows}
    up, holders, both = {i: i for i in sets}, {}, Counter()

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sorted(sets):
        for gram in sets[i]:
            for other in holders.setdefault(gram, []):
                both[other, i] += 1
            holders[gram].append(i)
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def variants(rng, count, sizes=(1, 2, 3, 5, 9, 10, 11, 12, 20, 31, 60, 200, 700)):
    """Texts of all sizes with chains of near copies around the threshold."""
    out, vocabulary = [], [f"w{k}" for k in range(3000)]
    while len(out) < count:
        base = [rng.choice(vocabulary) for _ in range(rng.choice(sizes))]
        for _ in range(rng.randrange(1, 9)):
            out.append(" ".join(base))
            base = list(base)
            for _ in range(rng.randrange(0, 2 + len(base) // 40)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
            if rng.random() < 0.4:
                base = base[: len(base) - rng.randrange(0, 1 + len(base) // 12)] or base
    return out[:count]


@pytest.mark.parametrize("percent", [90, 80])
def test_ngram_join_equals_brute_force(spark, percent):
    rows = list(enumerate(variants(random.Random(percent), 700)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity_join.jaccard_components(docs(spark, [(i, t, "en", "a") for i, t in rows]), percent=percent).collect()}
    want = brute_join(rows, percent)
    assert got == want and len({c for _, c in want.values()}) < 600


def test_linked_sets_share_a_key_and_sketches_bound_their_difference():
    rng = np.random.default_rng(3)
    shared_keys = 0
    for _ in range(300):
        n = int(rng.integers(1, 400))
        own = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = int(rng.integers(0, max(1, len(own) // 9) + 1))
        fresh = rng.integers(0, 2**63, int(rng.integers(0, max(1, len(own) // 15) + 1))).astype(np.uint64)
        other = np.unique(np.concatenate([own[drop:], fresh]))
        if not len(other):
            continue
        both = len(np.intersect1d(own, other))
        flat, starts = np.concatenate([own, other]), np.array([0, len(own), len(own) + len(other)])
        keys, owners = parity_join.block_keys(flat, starts, 90)
        one, two = (np.frombuffer(x, np.uint64) for x in parity_join.sketches(flat, starts))
        assert parity_join.apart(one, two) <= len(own) + len(other) - 2 * both
        if 100 * both >= 90 * (len(own) + len(other) - both):
            assert set(keys[owners == 0]) & set(keys[owners == 1])
            assert parity_join.may_link(np.array(len(own)), np.array(len(other)), parity_join.apart(one, two))
            shared_keys += 1
    assert shared_keys > 100


def test_a_bucket_that_its_star_leaves_open(spark, monkeypatch):
    """Links that no center has, in blocks of two classes; a third of the rows in one group."""
    monkeypatch.setattr(parity_join, "BLOCK", 2)
    monkeypatch.setattr(parity_join, "PARTNERS", 2)
    rng = random.Random(8)
    base = [f"b{k}" for k in range(240)]
    rows = []
    for side in range(6):  # six bunches, each some way from the base and close together
        own = list(base)
        for k in rng.sample(range(240), 6):
            own[k] = f"s{side}-{k}"
        for _ in range(8):
            one = list(own)
            one[rng.randrange(240)] = f"x{rng.random()}"
            rows.append(" ".join(one))
    rows = list(enumerate(rows))
    got = {r["doc_id"]: r["component_id"] for r in parity_join.jaccard_components(docs(spark, [(i, t, "en", "a") for i, t in rows])).collect()}
    want = {i: c for i, (_, c) in brute_join(rows).items()}
    assert got == want and 1 < len(set(want.values())) < 20


def test_ngram_join_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (None, "a b c d"), (4, "A b"), (5, "a B"), (6, "a b c d"), (6, "a b c d"), (7, "a b c d"), (7, "q r s t u v"), (8, "y " * 30000)]
    got = sorted(map(repr, map(tuple, parity_join.jaccard_components(docs(spark, [(i, t, "en", "a") for i, t in rows])).collect())))
    assert got == sorted(map(repr, [(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 2, None), (4, 1, 4), (5, 1, 4), (6, 2, 6), (6, 2, 6), (7, 2, 6), (7, 4, 7), (8, 1, 8)]))
    assert parity_join.jaccard_components(docs(spark, [])).count() == 0



def test_op13(spark):
    rows = [(r["doc_id"], r["text"]) for r in table_of(SMALL, "documents")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in registry.QUERIES["op13_ngram_join"](spark, SMALL).collect()}
    want = brute_join(rows)
    assert got == want and any(i != c for i, (_, c) in want.items())
