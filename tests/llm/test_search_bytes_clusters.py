"""Ranked search, byte-level BPE and centroid clustering against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from barstats.llm import byte_bpe, centroids, queries, ranked_search
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import CASES, FOLDER, documents, same
from pyspark.errors import PySparkException
from test_brute import TEXTS

PATH, PATTERN = public_tokenizers.path(queries.BYTE_RANKS), public_tokenizers.PATTERN
RANKS = byte_bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


# --- byte-level BPE


@CASES
def test_bytes_are_those_of_the_library_and_come_back(spark, folders, case):
    want = []
    for row in documents(folders[case]):
        text = row["text"] or ""
        ids = LIBRARY.encode_ordinary(text)
        digests = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), text.encode())]
        want.append((row["doc_id"], len(ids), *digests))
    same([tuple(r) for r in queries.op12_byte_bpe(spark, folders[case]).collect()], want)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_of_any_text(text):
    own = byte_bpe.coder(PATH, PATTERN)
    ids = own.encode(text)
    assert ids.tolist() == LIBRARY.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


@given(st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)), st.integers(0, 50))
def test_merges_follow_the_lowest_rank_from_the_left(piece, seed):
    rng = random.Random(seed)
    ranks = {bytes([b]): b for b in range(3)}
    for _ in range(12):
        a, b = rng.choice(sorted(ranks)), rng.choice(sorted(ranks))
        ranks.setdefault(a + b, len(ranks))
    symbols = [bytes([b]) for b in piece]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in ranks]
        if not pairs:
            break
        _, i = min(pairs)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
    assert byte_bpe.merged(piece, ranks) == [ranks[s] for s in symbols]


def test_one_match_of_many_bytes():
    rng = random.Random(1)
    text = "".join(rng.choices("aeinrst", k=200_000)) + "x" * 5000
    assert byte_bpe.ByteCoder(PATH, PATTERN).encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_columns_of_the_new_names_are_replaced_and_others_kept(spark):
    rows = [(1, "one two", "mine", None), (1, None, "mine", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    out = byte_bpe.decode(byte_bpe.encode(docs, PATH, PATTERN), PATH, PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    ids = LIBRARY.encode_ordinary("one two")
    same([tuple(r) for r in out.collect()], [(1, "one two", ids, bytearray(b"one two")), (1, None, [], bytearray())])


def test_null_and_unknown_ids(spark):
    ids = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert sorted(byte_bpe.decode(ids, PATH, PATTERN).collect(), key=repr)[0]["decoded"] in (None, bytearray())
    assert {r["decoded"] is None for r in byte_bpe.decode(ids, PATH, PATTERN).collect()} == {True, False}
    with pytest.raises(PySparkException, match="no token has the id"):
        byte_bpe.decode(spark.createDataFrame([([70_000],)], "ids array<int>"), PATH, PATTERN).collect()


# --- ranked search


def brute_ranking(rows, items, k=20):
    """rows and items of (id, text)."""
    split = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    docs = [(key, Counter(split(text))) for key, text in rows]
    docs = [(key, terms, terms.total()) for key, terms in docs if terms]
    total, df = sum(n for *_, n in docs), Counter(t for _, terms, _ in docs for t in terms)
    out = []
    for item, text in items:
        scored = []
        for key, terms, n in docs:
            m = 100 - 25 + (25 * n * len(docs)) // total
            score = 0
            for t in split(text):
                if tf := terms[t]:
                    w = math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, key is not None, key))
        scored.sort()
        out += [(item, i + 1, key, -s) for i, (s, _, key) in enumerate(scored[:k])]
    return out


@CASES
def test_ranking(spark, folders, case):
    items = pq.read_table(f"{folders[case]}/benchmark.parquet").to_pylist()
    want = brute_ranking(
        [(r["doc_id"], r["text"]) for r in documents(folders[case])], [(r["item_id"], r["text"]) for r in items]
    )
    same([tuple(r) for r in queries.op11_ranked_search(spark, folders[case]).collect()], want)


def zipf_text(rng, words):
    return " ".join(f"w{int(rng.paretovariate(0.8)) % 300}" for _ in range(words))


def test_ranking_over_many_blocks_and_chunks(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i // 2, zipf_text(rng, rng.randrange(1, 60))) for i in range(400)] + [(1000 + i, "w1 w2 w3 w4") for i in range(90)]
    items = [(i, zipf_text(rng, rng.randrange(1, 25))) for i in range(30)] + [(50, "w4 W4 w1"), (51, "w4 W4 w1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    index = ranked_search.build_index(docs, str(tmp_path / "index"))
    assert index.rows.where("term IS NULL").count() == 7
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = ranked_search.search(index, asked, query_bytes=200)
    same([tuple(r) for r in found.collect()], brute_ranking(rows, items))


def test_ids_of_other_types_and_clashing_columns(spark, tmp_path):
    names = "block term docs times ids weight query terms rank score item_id df"
    schema = ", ".join(["doc_id string", "text string", *(f"{n} int" for n in names.split())])
    rows = [("b", "one two", *[1] * 12), ("a", "one two", *[None] * 12), (None, "One.", *[2] * 12), ("c", None, *[3] * 12)]
    index = ranked_search.build_index(spark.createDataFrame(rows, schema), str(tmp_path / "index"))
    asked = spark.createDataFrame([("x", "one", 1, 2)], "item_id string, text string, query int, terms int")
    got = [tuple(r) for r in ranked_search.search(index, asked).collect()]
    same(got, brute_ranking([r[:2] for r in rows], [("x", "one")]))


@settings(deadline=None)
@given(st.integers(0, 10_000))
def test_walk_finds_the_best_of_any_lists(seed):
    rng = random.Random(seed)
    n, best = rng.randrange(1, 40), ranked_search.Best(rng.randrange(1, 6))
    lists, want = [], Counter()
    for _ in range(rng.randrange(1, 6)):
        docs = sorted(rng.sample(range(n), rng.randrange(1, n + 1)))
        scores, times = [rng.randrange(1, 9) for _ in docs], rng.randrange(1, 3)
        lists.append((max(scores) * times, [*docs, n], [*scores, 0], times))
        for d, s in zip(docs, scores):
            want[d] += s * times
    ranked_search.walk(lists, list(range(n)), best)
    got = sorted(((s, late.key) for s, late in best.heap), key=lambda x: (-x[0], x[1]))
    assert got == sorted(((s, d) for d, s in want.items()), key=lambda x: (-x[0], x[1]))[: best.k]


def test_long_lists_are_skipped():
    n = 4000
    rare, common = [*range(0, n, 400), n], [*range(n), n]
    lists = [(100, rare, [100] * 10 + [0], 1), (5, common, [5] * n + [0], 1)]
    best = ranked_search.Best(5)
    # All of the common list's documents until five are known, then those of the rare one alone.
    assert ranked_search.walk(lists, list(range(n)), best) < 2000
    assert sorted(s for s, _ in best.heap) == [105] * 5


# --- centroids


def brute_clusters(rows, k=8, rounds=10):
    """rows of (id, components); without repeated and null ids."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in kept]
    first = sorted(kept, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())[:k]
    c = [v for _, v in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for j in range(len(c)):
            mine = [v for (_, v), (_, i) in zip(kept, own) if i == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    of = Counter()
    for d, j in own:
        of[j] += d
    return [
        (i, j, d, of[j], sum(of.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
        for (i, _), (d, j) in zip(kept, own)
    ]


def awkward_vectors(seed=2):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(i % 3, 0.7) for _ in range(64)]) for i in range(60)]
    rows += [(100, None), (101, []), (102, [0.5] * 63), (103, [float("nan")] * 64), (104, [float("inf")] + [0.0] * 63)]
    rows += [(105, [None] + [0.0] * 63), (106, [0.25] * 64), (107, [0.25] * 64), (108, [-1000.125] * 64), (109, [0.0] * 65)]
    return rows


def clusters(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return [tuple(r) for r in centroids.with_inertia(centroids.cluster(table)).collect()]


@pytest.mark.parametrize("rows", [awkward_vectors(), awkward_vectors()[:5], [(1, None)], []], ids=["all", "few", "none kept", "empty"])
def test_clusters(spark, rows):
    same(clusters(spark, rows), brute_clusters(rows))


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
def test_clusters_of_the_given_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{FOLDER}/embeddings.parquet").to_pylist()]
    same([tuple(r) for r in queries.op13_centroids(spark, str(FOLDER)).collect()], brute_clusters(rows))


def test_repeated_and_null_ids_and_clashing_columns(spark):
    rows = [(i % 2 or None, [float(i % 5)] * 64, i, i, str(i)) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x int, block int, cluster string")
    found = centroids.cluster(table, k=3)
    got = found.rows.collect()
    assert sorted(found.rows.columns) == ["cluster", "distance", "vec_id"] and len(got) == 40
    assert Counter(r["vec_id"] for r in got) == {None: 20, 1: 20}
    # The first centroids are the three least vectors of the id that has a hash: all alike, so the first takes all.
    assert len(found.centroids) == 3 and sum(r["distance"] for r in got) > 0
    again = centroids.cluster(table.orderBy("x"), k=3)
    assert again.centroids == found.centroids
    same([tuple(r) for r in again.rows.collect()], [tuple(r) for r in got])


def test_far_vectors_are_not_scanned_again(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(100 * (i % 2), 1) for _ in range(64)]) for i in range(200)]
    found = centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=2)
    assert found.scanned[0] == 200 and found.scanned[-1] < 200


def test_rounds_join_without_a_shuffle(spark):
    seen = []

    class Seen(centroids._Buckets):
        def write(self, df, label):
            seen.append(df._jdf.queryExecution().executedPlan().toString())
            return super().write(df, label)

    table = spark.createDataFrame(awkward_vectors(), "vec_id long, embedding array<float>")
    was, centroids._Buckets = centroids._Buckets, Seen
    try:
        centroids.cluster(table, rounds=2)
    finally:
        centroids._Buckets = was
    assert "Join" in seen[2] and "Exchange" not in seen[2]


def test_too_large_components_are_refused(spark):
    table = spark.createDataFrame([(1, [2.0**17] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(PySparkException, match="2\\^27"):
        centroids.cluster(table)




def test_what_is_remembered_changes_nothing():
    made = []
    memo = byte_bpe.Recent(lambda k: made.append(k) or k.upper(), 3)
    rng = random.Random(2)
    keys = rng.choices(["a", "b", "c", "d", "e", "f", "g", "x" * 60], k=400)
    assert [memo[k] for k in keys] == [k.upper() for k in keys]
    assert len(memo) <= 3 and len(memo.old) <= 3 and len(made) < len(keys)
