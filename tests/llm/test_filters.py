"""Decontamination, mixing, surrogates, quality, licenses and line spread against brute force."""

import itertools
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from barstats.llm import common, decontamination, licenses, line_spread, mixing, quality, queries, surrogates
from barstats.llm.common import append, components
from llm_cases import CASES, FOLDER, documents, same
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- decontamination


def most_in_order(item, words, lo, hi):
    """All alignments of words in order at offsets from lo to hi, by plain recursion: which item words match."""
    best = {}
    for i in range(len(item), -1, -1):
        for j in range(i + hi + 1, i + lo - 1, -1):
            if i == len(item) or j > i + hi:
                best[i, j] = ()
                continue
            ways = [best[i, j + 1], best[i + 1, max(j, i + 1 + lo)]]
            if 0 <= j < len(words) and words[j] == item[i]:
                ways.append(((i, j), *best[i + 1, j + 1]))
            best[i, j] = max(ways, key=len)
    return best[0, lo]


def brute_leaks(text, items):
    """Every mask is tried at every place of every item and every offset; then all alignments."""
    words, leaks = PLAIN.findall(lower(text)), set()
    own = Counter(words)
    for key, item_text in items:
        item = PLAIN.findall(lower(item_text))
        n, need = len(item), decontamination.needed(len(PLAIN.findall(lower(item_text))))
        if not n or (own & Counter(item)).total() < need:  # not enough of its words, in any order
            continue
        tried = [[p + k for k, c in enumerate(m) if c == "1"] for m in decontamination.MASKS for p in range(n - len(m) + 1)]
        if n <= decontamination.SHORT:
            tried += map(list, itertools.combinations(range(n), need))
        hits = [d for d in range(-n, len(words)) if any(all(0 <= p + d < len(words) and words[p + d] == item[p] for p in t) for t in tried)]
        if n <= decontamination.SHORT and need < n:
            less = [item[:i] + item[i + 1 :] for i in range(n)]
            hits += [d for d in range(len(words)) if words[d : d + n - 1] in less]
        band = 1 if n <= decontamination.SHORT else decontamination.BAND
        matched = set()
        for d in hits:
            at = [i for i, _ in most_in_order(item, words, d - band, d + band)]
            if n <= decontamination.SHORT and len(at) >= need or len(at) >= max(need, 0.7 * n):
                matched |= set(at)
        if len(matched) >= need and 2 * len(matched) >= n:
            leaks.add(key)
    return leaks


@pytest.mark.parametrize("case", ["awkward", "empty", "given"])
@pytest.mark.parametrize("chunk", [decontamination.CHUNK, 60])
def test_decontamination(spark, folders, case, chunk):
    """Whatever holds 0.7 of an item, and enough of its words, at one place is a leak, and nothing is that has not half of one."""
    if case == "given" and chunk == 60:
        pytest.skip("a chunk for each item is tried on small tables")
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{folders[case]}/benchmark.parquet").to_pylist()]
    table = queries.table(spark, folders[case])
    got = decontamination.judge(table, queries.table(spark, folders[case], "benchmark"), chunk=chunk).collect()
    words = {key: PLAIN.findall(lower(text)) for key, text in items}
    rows = Counter()
    for r in got:
        rows[r["doc_id"], r["text"], r["leaked"], tuple(sorted({repr(o["item_id"]) for o in r["overlaps"] if o["leaked"]}))] += 1
        own = Counter(PLAIN.findall(lower(r["text"])))
        for o in r["overlaps"]:
            assert sum((own & Counter(words[o["item_id"]])).values()) >= o["matches"] - sum(w == "" for w in own)
    assert sum(rows.values()) == len(documents(folders[case]))
    for (_, text, _, leaked), _ in rows.items():
        if text is None or len(text) < 20_000:
            assert {repr(k) for k in brute_leaks(text, items)} <= set(leaked)
    if case == "awkward":
        assert {r["doc_id"] for r in got if r["leaked"]} >= {10, 11}


@pytest.mark.parametrize("n", range(1, 31))
def test_items_bear_substituted_words(n):
    item = [f"w{i}" for i in range(n)]
    seeds = decontamination.Seeds([("x", " ".join(item))])
    for i in range(n):
        for changed in ({i}, {i, (i + 3) % n}):
            text = " ".join(["so", *("z" if k in changed else w for k, w in enumerate(item)), "on"])
            found = [o["matches"] for o in seeds.overlaps(text) if o["leaked"]]
            enough = n - len(changed) >= decontamination.needed(n) and n > 4
            if n <= decontamination.SHORT:
                assert found == ([n - len(changed)] if enough else []), (i, changed)
            elif enough:
                assert found and found[0] >= decontamination.needed(n), (i, changed)
    assert seeds.overlaps(" ".join(item))[0]["leaked"]


@pytest.mark.parametrize("n", range(5, 31))
def test_items_bear_a_word_left_out_or_added(n):
    item = [f"w{i}" for i in range(n)]
    seeds = decontamination.Seeds([("x", " ".join(item))])
    for i in range(n):
        less = " ".join(["so", *item[:i], *item[i + 1 :], "on"])
        assert any(o["leaked"] for o in seeds.overlaps(less)), i
        more = " ".join(["so", *item[:i], "z", *item[i:], "on"])
        if n > decontamination.SHORT:
            assert any(o["leaked"] for o in seeds.overlaps(more)), i


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
@pytest.mark.parametrize("share,least", [(0.1, 0.99), (0.2, 0.99), (0.25, 0.97), (0.3, 0.9)])
def test_recall_by_share_of_substituted_words(share, least):
    """Items of every length: the given ones, and their beginnings of 5 to 20 words."""
    rng = np.random.default_rng(7)
    texts = [PLAIN.findall(lower(r["text"])) for r in pq.read_table(FOLDER / "benchmark.parquet").to_pylist()]
    items = [*texts, *(t[:n] for t in texts for n in range(5, 21) if len(t) > n)]
    found, of = Counter(), Counter()
    for item in items:
        n = len(item)
        k = int(share * n)
        if n - k < decontamination.needed(n):
            continue
        changed = set(rng.choice(n, k, replace=False).tolist())
        seeds = decontamination.Seeds([(0, " ".join(item))])
        text = " ".join(f"q{i}" if i in changed else w for i, w in enumerate(item))
        size = min(n, 21)
        of[size] += 1
        found[size] += any(o["leaked"] for o in seeds.overlaps(f"und so {text} weiter"))
    assert sum(found.values()) >= least * sum(of.values())
    each = 0.9 if share <= 0.25 else 0.75
    assert all(found[n] >= each * of[n] for n in of), {n: found[n] / of[n] for n in of}


def test_places_of_repeated_words_are_bounded():
    seeds = decontamination.Seeds([("x", "a b " * 10)])
    assert [o["leaked"] for o in seeds.overlaps("a b " * 3000)] == [True]


def test_decontamination_keeps_columns_and_clean_documents(spark):
    docs = spark.createDataFrame([(1, "nothing of it", 5), (2, None, 6)], "doc_id int, text string, overlaps int")
    bench = spark.createDataFrame([("x", "some other words altogether")], "item_id string, text string")
    same([tuple(r) for r in decontamination.decontaminate(docs, bench).collect()], [(1, "nothing of it", 5), (2, None, 6)])


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
def test_all_copied_items_are_found(spark):
    items = {r["item_id"]: " ".join(PLAIN.findall(lower(r["text"]))) for r in pq.read_table(FOLDER / "benchmark.parquet").to_pylist()}
    got = {r["doc_id"]: set(r["item_ids"]) for r in queries.op1_decontamination(spark, str(FOLDER)).collect()}
    for r in documents(FOLDER):
        line = " " + " ".join(PLAIN.findall(lower(r["text"]))) + " "
        assert {i for i, t in items.items() if f" {t} " in line} <= got[r["doc_id"]]
    assert sum(map(bool, got.values())) < 0.2 * len(got)


# --- mixing


def brute_targets(sizes):
    ordered = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(ordered)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        unit = sum(weight[s] for s in ordered if s not in capped)
        want = {s: 3 * sizes[s] if s in capped else left * weight[s] / unit for s in ordered}
        over = {s for s in ordered if want[s] > 3 * sizes[s]} - capped
        if not over:
            return want
        capped |= over


@CASES
@pytest.mark.parametrize("block", [mixing.BLOCK, 300])
def test_mixing(spark, folders, case, block):
    rows = documents(folders[case])
    size = [len(WORDS.findall(r["text"] or "")) for r in rows]
    of_source = Counter()
    for r, n in zip(rows, size):
        of_source[r["source"]] += n
    want = brute_targets(of_source) if rows else {}
    plan = mixing.plan_mix(queries.table(spark, folders[case]), block=block, shard_words=1000)
    got = plan.withColumn("taken", F.col("size") * F.size("copies")).collect()
    same([(r["doc_id"], r["size"]) for r in got], [(r["doc_id"], n) for r, n in zip(rows, size)])
    same(
        [(r["doc_id"], r["source_size"], round(r["target"], 4)) for r in got],
        [(r["doc_id"], of_source[r["source"]], round(want[r["source"]], 4)) for r in rows],
    )
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    taken, least = Counter(), defaultdict(lambda: 10**9)
    key = {round(t, 4): s for s, t in want.items()}
    for r in got:
        s = key[round(r["target"], 4)]
        taken[s] += r["taken"]
        if r["size"]:
            least[s] = min(least[s], r["size"])
    if len(key) == len(want):
        longest = max(size, default=0)
        assert all(abs(taken[s] - t) <= longest for s, t in want.items())
    shards = Counter(c["shard"] for r in got for c in r["copies"])
    if case == "given" and block == 300:
        total = sum(of_source.values())
        assert set(shards) == set(range(math.ceil(total / 1000)))
    again = mixing.plan_mix(queries.table(spark, folders[case]).repartition(3), block=block, shard_words=1000)
    unique = {d for d, n in Counter(r["doc_id"] for r in rows).items() if n == 1 and d is not None}
    plain = lambda rs: [(r["doc_id"], r["copies"]) for r in rs if r["doc_id"] in unique]
    if unique == {r["doc_id"] for r in rows}:
        same(plain(again.collect()), plain(got))


def test_quotas_are_exact_and_hypergeometric(spark):
    counts = np.array([500, 300, 0, 200])
    mean = np.zeros(4)
    for seed in range(200):
        parts = list(mixing.split_counts(counts, np.full(10, 100), 0, 10, seed))
        assert [lo for lo, _, _ in parts] == list(range(10))
        assert all(c.sum() == 100 for *_, c in parts)
        assert (sum(c for *_, c in parts) == counts).all()
        mean += parts[3][2]
    assert np.allclose(mean / 200, counts / 10, atol=2)
    drawn = spark.createDataFrame([(0, 500), (1, 300), (3, 200)], "sid int, blocks long")
    got = mixing.shard_quotas(drawn, 100, 1)
    assert got.groupBy("shard").agg(F.sum("quota").alias("n")).where("n <> 10").isEmpty()
    same([tuple(r) for r in got.groupBy("sid").agg(F.sum("quota")).collect()], [(0, 500), (1, 300), (3, 200)])


def test_mix_gives_rows_as_often_as_planned(spark, folders, tmp_path):
    docs = queries.table(spark, folders["awkward"]).withColumn("row", F.lit("own"))
    mixed = mixing.mix(docs, shard_words=500).collect()
    planned = mixing.plan_mix(docs, shard_words=500)
    n = {r[0]: r[1] for r in planned.groupBy("doc_id").agg(F.sum(F.size("copies"))).collect() if r[1]}
    assert Counter(r["doc_id"] for r in mixed) == Counter(n)
    assert all(r["row"] == "own" for r in mixed)
    mixing.write_shards(mixing.mix(docs, shard_words=500), str(tmp_path / "mix"))
    assert spark.read.parquet(str(tmp_path / "mix")).count() == len(mixed)


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
def test_the_query_goes_through_the_tree_and_a_local_shuffle(spark):
    rows = queries.op4_mixing(spark, str(FOLDER)).collect()
    order = defaultdict(list)
    for r in rows:
        assert r["taken"] == r["size"] * len(r["shards"])
        for shard, position in zip(r["shards"], r["positions"]):
            order[shard].append((position, r["doc_id"]))
    assert set(order) == set(range(mixing.SHARDS))
    for placed in order.values():
        ids = [d for _, d in sorted(placed)]
        assert sorted(p for p, _ in placed) == list(range(len(placed)))
        assert len(ids) < 5 or ids != sorted(ids)


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
def test_quotas_are_those_of_a_tree_drawn_by_hand(spark):
    """Blocks of each source that a shard gets, node by node from the root."""
    plan = mixing.plan_mix(queries.table(spark, str(FOLDER)))
    drawn = spark.createDataFrame([(0, 640), (1, 64), (2, 3), (3, 100)], "sid int, blocks long")
    counts = np.array([640, 64, 3, 100])
    capacity = np.diff(np.arange(mixing.SHARDS + 1) * counts.sum() // mixing.SHARDS)
    want, nodes = [], [(0, mixing.SHARDS, counts)]
    while nodes:
        lo, hi, here = nodes.pop()
        if hi - lo == 1:
            want += [(lo, sid, n) for sid, n in enumerate(here.tolist()) if n]
            continue
        mid = (lo + hi) // 2
        rng = np.random.default_rng([mixing.SEED, lo, hi])
        left = rng.multivariate_hypergeometric(here, int(capacity[lo:mid].sum()), method="marginals")
        nodes += [(lo, mid, left), (mid, hi, here - left)]
    got = mixing.shard_quotas(drawn, mixing.SHARDS, mixing.SEED)
    same([tuple(r) for r in got.select("shard", "sid", "quota").collect()], want)
    # Copies of a block stay together: they are dealt as blocks, and blocks are drawn in many parts.
    assert plan.select(F.explode("copies.shard")).distinct().count() == mixing.SHARDS


def test_columns_of_the_names_that_the_mix_adds(spark):
    rows = [(i, "one two three", "a", "mine", "mine") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_copy string, Mix_Shard string")
    mixed = mixing.mix(docs)
    assert mixed.columns == ["doc_id", "text", "source", "mix_copy", "mix_shard", "mix_place"]
    assert dict(mixed.dtypes)["mix_shard"] == "int" and mixed.count() == 20


# --- surrogates


@CASES
def test_surrogates(spark, folders, case):
    rows = documents(folders[case])
    got = queries.op5_surrogates(spark, folders[case]).collect()
    texts = defaultdict(list)
    for r in got:
        texts[r["doc_id"]].append(r["text"])
    real = {m[2:] for r in rows for m in surrogates.mentions(r["text"])}
    for r in rows:
        if not surrogates.mentions(r["text"]):
            assert r["text"] in texts[r["doc_id"]]
        for a, b, kind, canon in surrogates.mentions(r["text"]):
            if kind in ("email", "card", "phone"):
                assert not any(r["text"][a:b] in (t or "") for t in texts[r["doc_id"]])
    new = [m for r in got for m in surrogates.mentions(r["text"]) if m[2] in ("email", "card", "ip")]
    assert not {m[2:] for m in new} & real
    assert len({m[2:] for m in new}) == len([x for x in real if x[0] in ("email", "card", "ip")])


def test_surrogates_are_distinct_where_choices_are_few(spark):
    rows = [("ip", f"{a}.{b}.{c}.1") for a in range(1, 10) for b in range(1, 10) for c in range(1, 10)]
    got = surrogates.assign(spark.createDataFrame(rows, "kind string, canon string"), b"k" * 32).collect()
    assert len({r["new"] for r in got}) == len(rows)
    assert not {r["new"] for r in got} & {c for _, c in rows}
    assert max(r["attempt"] for r in got) > 0


def test_entities_that_draw_again_are_the_same_everywhere(spark):
    ips = [f"{a}.{b}.1.1" for a in range(1, 10) for b in range(1, 10)]
    docs = spark.createDataFrame([(i, f"from {ip} and {ips[0]} again {ip}") for i, ip in enumerate(ips)], "id int, text string")
    got = surrogates.replace_entities(docs, "k").collect()
    seen = {}
    for r in sorted(got, key=lambda r: r["id"]):
        a, b, c = re.findall(r"\d+\.\d+\.\d+\.\d+", r["text"])
        assert a == c
        seen[ips[r["id"]]] = a
        assert seen[ips[0]] == b
    assert len(set(seen.values())) == len(ips) and not set(seen.values()) & set(ips)


def test_surrogates_keep_format_gender_and_coreference():
    text = "Mr. John SMITH, Mrs Anna Smith. Call +1 (415) 555-1234 or 415-555-1234. Smith's: Jo.Do@x9.de jo.do@X9.de"
    new, spans = surrogates.rewrite(text, b"k" * 32, {})
    assert re.fullmatch(r"Mr\. [A-Z]\w+n [A-Z]+, Mrs [A-Z]\w+a [A-Z]\w+\. Call \+\d \(\d{3}\) \d{3}-\d{4} or [\d-]{12}\. [A-Z]\w+'s: .*", new)
    upper, plain, short = (s["surrogate"] for s in spans if s["kind"] == "name" and s["surrogate"].lower().endswith("el"))
    assert upper == plain.upper() and short == plain
    emails = [s["surrogate"].lower() for s in spans if s["kind"] == "email"]
    assert len(set(emails)) == 1 and emails[0].endswith(".example")


def test_long_runs_and_many_names_take_one_pass():
    """Texts of a size at which anything quadratic would take hours."""
    assert surrogates.mentions("ab1" * 500_000 + " a.b-1@" + "1." * 300_000) == []
    (found,) = surrogates.mentions("ab1" * 200_000 + "@x9.de")
    assert found[:3] == (0, 600_006, "email")
    names = ["A" + "".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(10_000)]
    text = ", Mr. ".join(["", *names]) + " " + " ".join(names) + f" {names[0]}-{names[1]} {names[0]}x"
    assert Counter(m[3] for m in surrogates.mentions(text)) == Counter(
        [n.casefold() for n in names] * 2 + [n.casefold() for n in names[:2]]
    )


def test_forms_of_address_in_a_row_are_no_names():
    text = "Herr Dr. Ann Mr. Don Lee Frau Mia, Drake"
    assert [(text[a:b], k) for a, b, k, _ in surrogates.mentions(text)] == [
        ("Ann", "name-family-latin"), ("Don", "name-given-m-latin"), ("Lee", "name-family-latin"), ("Mia", "name-family-latin"),
    ]


def test_surrogates_are_distinct_across_kinds(spark):
    words = ["x" + "".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(1500)]
    rows = [(kind, w) for w in words for kind in ("name-family-latin", "name-given-n-latin")]
    taken = surrogates.surrogate("name-family-latin", words[0], 0, b"k" * 32)
    rows += [("name-given-m-latin", taken), ("ssn", "123456789"), ("phone", surrogates.surrogate("ssn", "123456789", 0, b"k" * 32))]
    got = surrogates.assign(spark.createDataFrame(rows, "kind string, canon string"), b"k" * 32).collect()
    assert len({r["new"] for r in got}) == len(rows) == len(got)
    assert not {r["new"] for r in got} & {c for _, c in rows}


def test_a_name_has_one_surrogate_behind_any_form_of_address(spark):
    rows = [(1, "Dr Anna Meier"), (2, "Frau Anna Meier"), (3, "Dr Kim Meier"), (4, "Herr Kim Meier"), (5, "Frau Kim Meier"), (6, "Dr Toni Meier")]
    docs = spark.createDataFrame(rows, "id int, text string")
    new = {r["id"]: r["text"].split() for r in surrogates.replace_entities(docs, "k").collect()}
    assert new[1][1:] == new[2][1:] and new[1][1].endswith("a")
    assert len({new[i][1] for i in (3, 4, 5)}) == 3 and new[6][1].endswith("el")
    assert len({w[2] for w in new.values()}) == 1


def test_phones_of_any_grouping_and_both_ip_versions_are_found():
    for kind, written in [
        *(("phone", w) for w in ("+33 1 23 45 67 89", "01 23 45 67 89", "+34 912 34 56 78", "030/1234567", "+49 (0)30 1234567", "(030) 123 45 67", "0049 30 123456", "01.23.45.67.89")),
        *(("ip", w) for w in ("2001:db8::1", "2001:0DB8:0:0:0:FF00:42:8329", "fe80::ab", "::ffff:10.1.2.3")),
    ]:
        text = f"Call {written}, or not."
        assert [(text[a:b], k) for a, b, k, _ in surrogates.mentions(text)] == [(written, kind)], written
        new, (span,) = surrogates.rewrite(text, b"k" * 32, {})
        assert new == f"Call {span['surrogate']}, or not." and span["surrogate"] != written
        (again,) = surrogates.mentions(new)
        assert again[2] == kind and new[again[0] : again[1]] == span["surrogate"]
    assert surrogates.mentions("2001:DB8::1")[0][3] == surrogates.mentions("2001:db8:0:0:0:0:0:1")[0][3]
    for text in ("am 01.02.2020 um 12:30:45", "05/12/2023", "0.123456789", "std::abc ab::cd ::", "a1:b::2::3"):
        assert surrogates.mentions(text) == [], text


def test_nothing_of_planted_entities_is_left(spark):
    """Texts put together from known entities: none of them, however written, is in the result."""
    rng = np.random.default_rng(5)
    people = [("Mr.", "John"), ("Herr", "Jürgen"), ("Mrs", "Ana"), ("Mme", "Zoé"), ("Dr.", "Kim"), ("г-жа", "Анна")]
    families = ["Smith", "O'Hara", "Müller-Lang", "Garcia", "Петрова"]
    rows, planted = [], []
    for i in range(60):
        title, first = people[rng.integers(len(people))]
        family = families[rng.integers(len(families))]
        mail = f"user{i}.{chr(97 + i % 26)}@host{i % 7}.example.org"
        phone = f"+1 ({rng.integers(200, 999)}) {rng.integers(200, 999)}-{rng.integers(1000, 9999)}"
        card = "".join(map(str, rng.integers(1, 10, 16)))
        ip, ssn = f"{rng.integers(11, 99)}.{rng.integers(1, 255)}.7.{i + 1}", f"{rng.integers(100, 999)}-{rng.integers(10, 99)}-{rng.integers(1000, 9999)}"
        text = f"Dear {title} {first} {family}, write to {mail} or {mail.upper()}; call {phone}. {first.upper()} paid with {card} from {ip} ({ssn})."
        rows.append((i, text))
        planted.append([first, first.upper(), family, mail, mail.upper(), phone, card, ip, ssn])
    got = {r["id"]: r["text"] for r in surrogates.replace_entities(spark.createDataFrame(rows, "id int, text string"), "k").collect()}
    for i, text in rows:
        left = [x for x in planted[i] if re.search(rf"(?<!\w){re.escape(x)}(?!\w)", got[i])]
        assert not left, (text, got[i])
        shape = lambda t: re.sub(r"[0-9]", "0", re.sub(r"[^\W\d_]+", "a", t))
        assert shape(got[i]).count("@") == 2 and len(re.findall(r"\+0 \(000\) 000-0000", shape(got[i]))) == 1


def test_names_in_any_case_with_apostrophes_and_particles():
    text = "Mrs. MARIA LOPEZ and Maria, Mr. O'Brien's, Mr. Jan van der Berg; Berg may will it: Mr. Will"
    new, spans = surrogates.rewrite(text, b"k" * 32, {})
    assert [text[s["start"] : s["end"]] for s in spans] == ["MARIA", "LOPEZ", "Maria", "O'Brien", "Jan", "Berg", "Berg", "Will"]
    by = {text[s["start"] : s["end"]]: s["surrogate"] for s in spans}
    assert by["MARIA"] == by["Maria"].upper() and "van der" in new and "may will it" in new
    assert not any(f" {name}" in new for name in ("MARIA", "Maria", "LOPEZ", "O'Brien", "Jan", "Berg", "Will"))


def test_surrogates_are_of_the_same_type():
    def drawn(kind, canon):
        return [surrogates.surrogate(kind, canon, i, b"k" * 32) for i in range(20)]

    def luhn(n):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(n))) % 10 == 0

    assert all(luhn(n) and len(n) == 16 for n in drawn("card", "4111111111111111"))
    assert not all(luhn(n) for n in drawn("card", "4111111111111112"))
    for canon, pattern in [
        ("10.0.0.1", r"10\..*"), ("127.0.0.1", r"127\..*"), ("192.168.1.20", r"192\.168\..*"), ("169.254.1.1", r"169\.254\..*"),
        ("172.20.1.1", r"172\.(1[6-9]|2\d|3[01])\..*"), ("8.8.4.4", r"(?!10\.|127\.|192\.168\.|169\.254\.|172\.(1[6-9]|2\d|3[01])\.).*"),
    ]:
        assert all(re.fullmatch(pattern, n) for n in drawn("ip", canon)), canon


def test_a_format_without_free_values_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "MOST_DRAWS", 5)
    rows = [("ssn", str(n)) for n in range(1, 10)]
    with pytest.raises(ValueError, match="ssn"):
        surrogates.assign(spark.createDataFrame(rows, "kind string, canon string"), b"k" * 32)


def test_surrogates_keep_columns_of_any_name(spark):
    docs = spark.createDataFrame([("Mr. Ann", 1, 2, "x", 3)], "text string, _new int, _t1 int, replaced string, c0 int")
    out = surrogates.replace_entities(docs, "k")
    assert out.columns == ["text", "_new", "_t1", "c0", "replaced"]
    row = out.first()
    assert (row["_new"], row["_t1"], row["c0"]) == (1, 2, 3) and row["text"] == f"Mr. {row['replaced'][0]['surrogate']}"


def test_names_meet_neither_numbers_nor_longer_words():
    text = "Mr. Ann-Lee Ann, Dr. O’Neil: Ann@x9.de Ann-Lee Ann-Lees Anna O’Neil’s Ann"
    assert [(text[a:b], kind.split("-")[0]) for a, b, kind, _ in surrogates.mentions(text)] == [
        ("Ann-Lee", "name"), ("Ann", "name"), ("O’Neil", "name"), ("Ann@x9.de", "email"),
        ("Ann-Lee", "name"), ("Ann", "name"), ("O’Neil", "name"), ("Ann", "name"),
    ]


# --- quality


def brute_features(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


@CASES
def test_quality(spark, folders, case):
    rows = documents(folders[case])
    got = queries.op6_quality(spark, folders[case]).collect()
    columns = ("doc_id", *quality.FEATURES, "base_failed")
    same([tuple(r[c] for c in columns) for r in got], [(r["doc_id"], *brute_features(r["text"])) for r in rows])
    assert not any(r["kept"] and r["base_failed"] for r in got)


def brute_em(votes):
    n, rules = votes.shape
    good, on = quality.START_GOOD, np.array([[quality.START_ON_GOOD] * rules, [quality.START_ON_BAD] * rules])
    hot = np.stack([votes == k for k in (-1, 0, 1)], -1)
    for _ in range(quality.ROUNDS):
        w = np.log(on[0] / on[1])
        w[:, 0], w[:, 2] = w[:, 0].clip(max=0), w[:, 2].clip(min=0)
        p = 1 / (1 + np.exp(-math.log(good / (1 - good)) - (hot * w).sum((1, 2))))
        new = np.stack([((hot * q[:, None, None]).sum(0) + 0.5) / (q.sum() + 1.5) for q in (p, 1 - p)])
        now = (p.sum() + 0.5) / (n + 1)
        moved = max(abs(now - good), np.abs(new - on).max())
        good, on = now, new
        if moved < quality.SETTLED:
            break
    return good, on


def test_estimates_are_those_of_brute_force(spark):
    rng = np.random.default_rng(1)
    truth = rng.random(3000) < 0.7
    right = np.array([0.95, 0.85, 0.8, 0.7])
    votes = np.where(rng.random((3000, 4)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    votes[rng.random((3000, 4)) < 0.3] = 0
    rows = spark.createDataFrame(votes.tolist(), "_v0 int, _v1 int, _v2 int, _v3 int")
    model = quality.fit(rows, 4)
    good, on = brute_em(votes)
    assert math.isclose(model.good, good, abs_tol=1e-4)
    assert np.allclose([model.on_good, model.on_bad], on, atol=1e-4)
    assert np.allclose(on[0][:, 2] / (on[0][:, 2] + on[0][:, 0]), right, atol=0.06) and abs(good - 0.7) < 0.05


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
def test_kept_documents_are_those_labelled_good(spark):
    labels = spark.read.parquet(str(FOLDER / "labels.parquet"))
    joined = queries.op6_quality(spark, str(FOLDER)).join(labels, "doc_id").where("n_words >= 20").collect()
    good = [r["kept"] for r in joined if r["quality"] == 1]
    bad = [r["kept"] for r in joined if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.5 * len(bad)


# --- licenses


def brute_blocks(text):
    """Every run of lines with enough of a template, unless a smaller run within has it too."""
    lines = [set(PLAIN.findall(lower(line))) for line in (text or "").split("\n")]
    out = []
    for label, template in licenses.TEMPLATES:
        t, held = set(PLAIN.findall(lower(template))), set()
        for n in range(1, (licenses.WRAPPED if len(t) >= licenses.LONG else 1) + 1):
            for i in range(len(lines) - n + 1):
                share = len(t & set().union(*lines[i : i + n])) / len(t)
                if share >= licenses.THRESHOLD - 1e-9:
                    if not any(i <= a and a + m <= i + n for a, m in held):
                        out.append((label, share))
                    held.add((i, n))
    return out


def test_wrapped_templates_are_found():
    label, text = licenses.TEMPLATES[1]
    index = licenses.TemplateIndex(list(licenses.TEMPLATES), {}, licenses.THRESHOLD)
    words = text.split()
    for width in (5, 6, 9, 40):
        rows = ["# " + " ".join(words[i : i + width]) for i in range(0, len(words), width)]
        wrapped = "one\n" + "\n".join(rows) + "\ntwo"
        got = index.blocks(wrapped)
        same([(b["label"], b["score"]) for b in got], brute_blocks(wrapped))
        assert {b["label"] for b in got} == {label}
        assert all(1 <= b["line"] <= len(rows) and 1 <= b["lines"] <= licenses.WRAPPED for b in got)
    assert index.blocks(None) == index.blocks("") == []


def test_templates_are_found_whatever_the_line_breaks():
    index = licenses.TemplateIndex(list(licenses.TEMPLATES + licenses.OTHERS), {}, licenses.THRESHOLD)
    for label, text in licenses.TEMPLATES:
        words = text.split()
        for width in (1, 2, 3):
            for between in ("\n", "\n\n"):
                wrapped = between.join(" ".join(words[i : i + width]) for i in range(0, len(words), width))
                got = index.blocks(f"one two\n{wrapped}\nthree")
                assert {b["label"] for b in got} == {label}, (label, width)
    own = licenses.TemplateIndex([("house", "Use within our house only")], {}, licenses.THRESHOLD)
    assert own.blocks("a\nuse within\n\nour\nhouse b") == [{"label": "house", "line": 1, "lines": 4, "score": 0.8}]


def test_other_licenses_and_scattered_words_are_told_apart():
    index = licenses.TemplateIndex(list(licenses.TEMPLATES + licenses.OTHERS), {}, licenses.THRESHOLD)
    labels = lambda text: {b["label"] for b in index.blocks(text)}
    for label, text in licenses.OTHERS:
        assert labels(text) == labels(text.replace(" ", "\n")) == {label}, text
    wanted = licenses.TemplateIndex(list(licenses.TEMPLATES), {}, licenses.THRESHOLD)
    for text in ("Released under the BSD License.", "Licensed under the Mozilla Public License, Version 2.0.",
                 "Licensed under CC BY-SA 4.0.", "This work is licensed under the GNU General Public License, version 2."):
        assert wanted.blocks(text) == [], text
    far = " and many other words here ".join(["Released", "under", "the", "MIT", "license"])
    assert labels(far) == set()
    assert labels("Licensed under the MIT License or the Apache License, Version 2.0") == {"mit", "apache-2"}


@CASES
def test_license_scan(spark, folders, case):
    want = []
    for r in documents(folders[case]):
        words = PLAIN.findall(lower(r["text"]))
        places, labels, score = [], set(), 0.0
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
            places += [(i, label) for i in at]
        base = sorted({s for _, s in places})
        for label, score_of in brute_blocks(r["text"]):
            labels.add(label)
            score = max(score, score_of)
        at = [i for i, _ in places]
        want.append((r["doc_id"], len(words), len(at), min(at, default=None), max(at, default=None), ",".join(base),
                     ",".join(sorted(labels | set(base))), 1.0 if at else score))
    same([tuple(r) for r in queries.op7_license_scan(spark, folders[case]).collect()], want)


def test_phrases_of_a_long_text_take_one_pass():
    found = licenses.find_phrases(licenses.plain_words("so cc by nc " * 200_000), licenses.PHRASES)
    assert found == [(4 * i + 1, "cc-by-nc") for i in range(200_000)]


def test_license_chunks_give_the_same(spark, folders):
    templates = spark.createDataFrame(licenses.TEMPLATES, "label string, text string")
    docs = queries.table(spark, folders["awkward"])
    found = lambda **k: [
        (r["doc_id"], sorted(map(tuple, r["blocks"]))) for r in licenses.scan(docs, templates, **k).collect()
    ]
    same(found(chunk=100), found())


# --- line spread


@CASES
def test_line_spread(spark, folders, case):
    con = duckdb.connect()
    path = folders[case] + "/documents.parquet"
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path if case == 'given' else path + '/*.parquet'}')")
    got = [tuple(r) for r in queries.op8_line_spread(spark, folders[case]).collect()]
    if case == "awkward":  # ids repeat: without SQL
        rows = documents(folders[case])
        sites = defaultdict(set)
        for r in rows:
            for line in (r["text"] or "").split("\n"):
                sites[line].add(r["source"])
        wide = {x for x in sites if WORDS.search(x) and len(sites[x]) >= line_spread.MIN_SITES}
        assert wide == {"same line here"}
        want = []
        for r in rows:
            lines = r["text"].split("\n") if r["text"] is not None else []
            left = [x for x in lines if x not in wide]
            want.append((r["doc_id"], len(lines), len(lines) - len(left), None if r["text"] is None else "\n".join(left)))
    else:
        want = con.execute(queries.ORACLE["op8_line_spread"]).fetchall()
    same(got, want)


def test_spread_near_the_threshold_is_exact(spark):
    rows = [(f"line {k}", f"site {s}") for k in range(60) for s in range(280 + k)] * 2
    lines = spark.createDataFrame(rows, "line string, site string").select(
        F.xxhash64("line").alias("_l1"), F.hash("line").alias("_l2"), "site", "line"
    )
    wide = line_spread.widespread(lines, min_sites=300, lg_slots=6)
    got = {r["line"] for r in lines.join(wide, ["_l1", "_l2"]).select("line").distinct().collect()}
    assert got == {f"line {k}" for k in range(20, 60)}


# --- helpers


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(k, k + 1) for k in range(1000, 1080)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    apart = {n for e in edges if e[0] != e[1] for n in e}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    same([tuple(r) for r in got], [(n, find(n)) for n in apart])
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_components_of_paths_and_crowded_ends(spark):
    """A path whose links come down one by one, ends with all others below or above them, nulls, loops, names."""
    names = [f"{k:03}" for k in range(300)]
    down = [names[k : k + 2] for k in range(1, 60)] + [[names[0], names[60]]]
    below = [[names[160], n] for n in names[100:160]]
    above = [[names[200], n] for n in names[200:260]]
    edges = down + below + above + [[None, "270"], ["270", None], ["280", "280"], ["290", "291"], ["291", "290"]]
    want = [(n, names[0]) for n in names[:61]] + [(n, "100") for n in names[100:161]]
    want += [(n, "200") for n in names[200:260]] + [("290", "290"), ("291", "290")]
    got = components(spark.createDataFrame(edges, "a string, b string").repartition(7))
    assert got.columns == ["node", "root"]
    same([tuple(r) for r in got.collect()], want)


def test_tasks_that_hold_little_keep_all_edges_of_a_node_together(monkeypatch):
    monkeypatch.setattr(common, "_HELD", 3)
    edges = [(u, v) for u in range(10, 40) for v in (u - 10, u - 7, u - 3)]
    batches = [
        pa.RecordBatch.from_pydict({"u": [u for u, _ in some], "v": [v for _, v in some]})
        for some in (edges[k : k + 4] for k in range(0, len(edges), 4))
    ]
    given = [b.to_pylist() for b in common._linked_to_least(iter(batches))]
    assert len(given) > 5
    assert all(r["u"] > r["v"] for rows in given for r in rows)
    for u in range(10, 40):  # what is linked to u is linked within one of the pieces
        assert any({u, u - 10, u - 7, u - 3} <= {n for r in rows if r["v"] == least for n in r.values()} for rows in given for least in {r["v"] for r in rows})


def test_append_replaces_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 6)], "id int, text string, N int")
    out = append(df, ["text"], "n long, text2 string", lambda t: [[len(x or "") for x in t], t])
    assert out.columns == ["id", "text", "n", "text2"]
    same([tuple(r) for r in out.collect()], [(1, "a", 1, "a"), (2, None, 0, None)])
