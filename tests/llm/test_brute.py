"""Registered queries against brute force, on the smallest tables and on awkward rows."""

import hashlib
import itertools
import re
import tempfile
import zlib
from uuid import uuid4

import numpy as np
import public_tokenizers
import pytest
import xxhash
from barstats.llm import queries, simhash, token_counts, token_store
from barstats.llm.common import components
from llm_cases import CASES, documents, same
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

@CASES
def test_secret_scan(spark, folders, case):
    patterns = {
        "assign": r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "access": r"AKIA[A-Z0-9]+",
        "hex": r"[0-9a-f]+",
    }
    least = {"assign": 12, "access": 18, "hex": 16}
    want = []
    for row in documents(folders[case]):
        found = []
        for rank, (kind, p) in enumerate(patterns.items()):
            hits = [m for m in re.finditer(p, row["text"] or "") if len(m[2 if kind == "assign" else 0]) >= least[kind]]
            found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in hits]
        ordered = ",".join(x[2] for x in sorted(found))
        n = [sum(x[1] == k for x in found) for k in range(3)]
        want.append((row["doc_id"], *n, hashlib.sha256(ordered.encode()).hexdigest()))
    got = queries.op2_secret_scan(spark, folders[case])
    same([tuple(r) for r in got.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256").collect()], want)


@CASES
def test_token_counts(spark, folders, case):
    own = Tokenizer.from_file(public_tokenizers.path(queries.WORD_TOKENIZER))
    want = []
    for row in documents(folders[case]):
        text = row["text"] or ""
        n = len(own.encode(text, add_special_tokens=False).ids)
        want.append((row["doc_id"], len(text.encode()), n, n > 2048))
    same([tuple(r) for r in queries.op3_token_counts(spark, folders[case]).collect()], want)


TEXTS = st.text(
    st.one_of(
        st.characters(exclude_categories=["Cs"]),
        st.sampled_from(list("ab Cd'stre12 \n\t.,!ΣσİßéÉ́  \x1c<|>")),
    ),
    max_size=60,
) | st.lists(
    st.sampled_from(["<|endoftext|>", "<|startoftext|>", " ", "  ", "\n", "it's", " They'll", "12", "ÀÉ", "###", "Wort"])
).map("".join)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_counts_and_ids_are_those_of_the_library(text):
    path = public_tokenizers.path(queries.WORD_TOKENIZER)
    want = len(library(path).encode(text, add_special_tokens=False).ids)
    assert token_counts.counter(path).count(text) == want
    path = public_tokenizers.path(queries.BYTE_TOKENIZER)
    own = token_store.encoder(path)
    want = library(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), own.dtype).tolist() == want


_LIBRARY = {}


def library(path):
    if path not in _LIBRARY:
        _LIBRARY[path] = Tokenizer.from_file(path)
    return _LIBRARY[path]


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """The group of each distinct fingerprint."""
    group = {f: f for f in fps}

    def root(f):
        while group[f] != f:
            f = group[f]
        return f

    for a, b in itertools.combinations(sorted(group), 2):
        if (a ^ b).bit_count() <= 4:
            group[max(root(a), root(b))] = min(root(a), root(b))
    return {f: root(f) for f in group}


@CASES
@pytest.mark.parametrize("crowded", [simhash.CROWDED, 1])
def test_simhash(spark, folders, case, crowded):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in documents(folders[case])]
    roots = brute_components({f for _, f in rows})
    least = {}
    for d, f in rows:
        if d is not None:
            least[roots[f]] = min(d, least.get(roots[f], d))
    want = [(d, f"{f:016x}", least.get(roots[f])) for d, f in rows]
    docs = queries.table(spark, folders[case])
    got = simhash.near_duplicates(docs, crowded=crowded)
    got = got.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")
    same([tuple(r) for r in got.collect()], want)
    if crowded > 1:
        same([tuple(r) for r in queries.op9_simhash(spark, folders[case]).collect()], want)
    kept = simhash.drop_near_duplicates(docs, crowded=crowded).collect()
    assert len(kept) == len(set(roots.values()))
    same([brute_fingerprint(r["text"]) in roots for r in kept], [True] * len(kept))
    assert {roots[brute_fingerprint(r["text"])] for r in kept} == set(roots.values())
    same([r["doc_id"] for r in kept if r["doc_id"] is not None], list(least.values()))


@pytest.mark.parametrize("crowded", [3, 64])
def test_crowded_entries_lose_no_link(spark, crowded):
    rng = np.random.default_rng(5)
    fps = set(rng.integers(0, 2**63, 300).tolist())
    for centre in rng.integers(0, 2**63, 4).tolist():
        at = centre
        for _ in range(150):
            for b in rng.integers(0, 63, rng.integers(1, 6)).tolist():
                at ^= 1 << b
            fps.add(at)
            if rng.random() < 0.6:
                at = centre
    want = brute_components(fps)
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), crowded).collect()
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    group = {f: {f} for f in fps}
    for a, b in found:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for f in group[b]:
                group[f] = group[a]
    assert {f: min(g) for f, g in group.items()} == want


@CASES
def test_token_store(spark, folders, case):
    own = library(public_tokenizers.path(queries.BYTE_TOKENIZER))
    rows = documents(folders[case])
    got = [tuple(r) for r in queries.op10_token_store(spark, folders[case]).collect()]
    ids = {}
    for r in rows:
        these = [*own.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        crc = zlib.crc32(np.array(these, "<u4").tobytes())
        ids.setdefault((r["doc_id"] is not None, r["doc_id"] or 0), []).append((r["doc_id"], len(these), crc))
    same([(d, n, c) for d, _, n, c in got], [x for key in ids for x in ids[key]])
    start = 0
    for d, at, n, _ in sorted(got, key=lambda x: x[1]):
        assert at == start
        start += n
    assert [x[0] is not None and x[0] or -1 for x in sorted(got, key=lambda x: x[1])] == [
        x[0] is not None and x[0] or -1 for key in sorted(ids) for x in ids[key]
    ]


def test_store_with_ids_that_span_shards(spark, tmp_path):
    rows = [(5 if i % 3 else i, f"text {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = public_tokenizers.path(queries.BYTE_TOKENIZER)
    store = token_store.write_store(docs, str(tmp_path / "store"), path, keys_per_bucket=64)
    directory = store.directory.collect()
    assert sorted(r["copy"] for r in directory if r["doc_id"] == 5) == list(range(sum(r[0] == 5 for r in rows)))
    keys = spark.createDataFrame([(5, 7), (5, 100_000), (9, 0), (10**12, 0), (None, 0)], "doc_id long, copy long")
    got = {(r["doc_id"], r["copy"]): r["ids"] for r in store.read(keys, "ids array<int>", lambda a: a.tolist()).collect()}
    assert set(got) == {(5, 7), (9, 0)}
    assert got[9, 0] == [*library(path).encode("text 9").ids, 0]
    every = store.read(store.directory.select("doc_id", "copy"), "ids array<int>", lambda a: a.tolist()).collect()
    texts = sorted(library(path).decode(r["ids"][:-1]) for r in every)
    assert texts == sorted(t for _, t in rows)


def test_perfect_hash_with_equal_hashes():
    rng = np.random.default_rng(3)
    h = np.r_[rng.integers(0, 2**63, 5000), [7, 7, 7, 9, 9]].astype(np.uint64)
    mark = np.arange(len(h), dtype=np.uint64)
    path = token_store._pack_index(h, mark, mark.astype(np.uint32), mark, mark)
    with tempfile.NamedTemporaryFile(suffix=".npz") as f:
        f.write(path)
        f.flush()
        bucket = token_store._Bucket(f.name)
    at = bucket.find(h, mark)
    assert sorted(at.tolist()) == list(range(len(h)))
    assert (bucket.tables["n"][at] == mark).all()
    assert (bucket.find(h[:50], mark[:50] + np.uint64(10**6)) == -1).all()


def test_plain_words_are_encoded_once_and_not_looked_through():
    """Letters behind a space take no search for pieces, and a mark behind them reuses their ids."""
    path = queries.public_tokenizers.path(queries.BYTE_TOKENIZER)
    own = token_store.Encoder(path)
    asked = []
    own.stretches = own.pieces = own.split = None  # the first word alone is looked through
    own._stretch = lambda stretch: asked.append(stretch) or b""
    text = " zebra Zébré, zebra. zebra zébré!"
    got = np.frombuffer(own.encode(text), own.dtype).tolist()
    assert got == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert asked == [""] and "zebra" in own.of_word and " zebra" not in own.of_piece


def tasks_of(spark, work):
    """What work gives, and how many tasks it ran."""
    context = spark.sparkContext
    group = f"tasks-{uuid4().hex}"
    context.setJobGroup(group, group)
    try:
        out = work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    context._jsc.sc().listenerBus().waitUntilEmpty()
    seen = context.statusTracker()
    stages = {s for j in seen.getJobIdsForGroup(group) for s in seen.getJobInfo(j).stageIds}
    return out, sum(i.numCompletedTasks for s in stages if (i := seen.getStageInfo(s)))


def test_a_group_of_near_copies_takes_few_tasks(spark):
    """With many partitions it is their number that costs: each pass over the links has so many tasks."""
    rng = np.random.default_rng(8)
    fps = set(rng.integers(0, 2**63, 200).tolist())
    for centre in rng.integers(0, 2**63, 3).tolist():
        for _ in range(120):
            fps.add(centre)
            for b in rng.integers(0, 63, 2).tolist():
                centre ^= (1 << b) * int(rng.random() < 0.4)
    want = brute_components(fps)
    most = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in most}
    for k, v in most.items():
        spark.conf.set(k, v)
    try:
        links = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
        got, tasks = tasks_of(spark, lambda: components(links).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    linked = {f for f, root in want.items() if list(want.values()).count(root) > 1}
    same([tuple(r) for r in got], [(f, want[f]) for f in linked])
    assert tasks <= 700
