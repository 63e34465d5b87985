"""Every operator on awkward rows: columns of the names of helpers, nulls, long texts, repeated rows, no rows."""

import public_tokenizers
import pytest
from barstats.llm import (
    byte_bpe,
    centroids,
    decontamination,
    licenses,
    line_spread,
    mixing,
    quality,
    queries,
    ranked_search,
    secrets,
    simhash,
    surrogates,
    token_counts,
    token_store,
)

#: Names that operators use for columns of their own.
HELPERS = (
    "_text _words _with_word _hashes _windows _sorted _starts _upper _lines _v0 _v1 mix_copy mix_shard mix_place row size"
    " _copy copies epoch shard _new _t1 _t2 _attempts _found _overlaps0 _overlaps1 _blocks0 _fp _root _least fp root"
    " component_id _gone _l1 _l2 no line site hash repo owner candidates block term docs times ids weight query kept"
    " posterior base_failed n_words phrases blocks overlaps leaked replaced n_lines n_removed c0 c1 c2 n_bytes n_tokens over_limit"
    " decoded copy offset mark bucket h sid target x cluster key"
).split()
BENCH = "item_id long, text string"


def store(docs, path):
    found = token_store.write_store(docs, f"{path}/store", public_tokenizers.path(queries.BYTE_TOKENIZER))
    return found.read(found.directory.select("doc_id", "copy"), "ids_crc32 long", token_store.crc32_of)


def bench(docs):
    rows = [(1, "some words of a benchmark item that is long enough to be found here"), (2, None)]
    return docs.sparkSession.createDataFrame(rows, BENCH)


def searched(docs, path):
    return ranked_search.search(ranked_search.build_index(docs, f"{path}/index"), bench(docs))


#: Each operator, and whether a row of its result stands for a row of the table with its columns.
OPERATORS = {
    "decontamination": (lambda d, p: decontamination.judge(d, bench(d)), True),
    "secrets": (lambda d, p: secrets.judge_candidates(d), False),
    "token_counts": (lambda d, p: token_counts.count_tokens(d, public_tokenizers.path(queries.WORD_TOKENIZER)), True),
    "mixing": (lambda d, p: mixing.plan_mix(d), False),
    "mix": (lambda d, p: mixing.mix(d), None),
    "surrogates": (lambda d, p: surrogates.replace_entities(d, "key"), True),
    "quality": (lambda d, p: quality.judge(d), True),
    "licenses": (
        lambda d, p: licenses.scan(d, d.sparkSession.createDataFrame(licenses.TEMPLATES, "label string, text string")),
        True,
    ),
    "line_spread": (lambda d, p: line_spread.remove_boilerplate(d), True),
    "simhash": (lambda d, p: simhash.near_duplicates(d), False),
    "token_store": (store, False),
    "ranked_search": (searched, None),
    "byte_bpe": (
        lambda d, p: byte_bpe.encode(d, public_tokenizers.path(queries.BYTE_RANKS), public_tokenizers.PATTERN),
        True,
    ),
    "keep_good": (lambda d, p: quality.keep_good(d), None),
    "decontaminate": (lambda d, p: decontamination.decontaminate(d, bench(d)), None),
    "drop_near_duplicates": (lambda d, p: simhash.drop_near_duplicates(d), None),
}


def table(spark, rows):
    names = [n for n in HELPERS]
    schema = ", ".join(["doc_id long", "text string", "source string", *(f"{n} string" for n in names)])
    return spark.createDataFrame([(*r, *(f"own {n}" for n in names)) for r in rows], schema)


LONG = "word and another of them, " * 40_000
ROWS = [
    (1, None, None), (2, "", "a"), (None, "x", "a"), (3, "the same text of some words\nand a line", "b"),
    (3, "the same text of some words\nand a line", "b"), (4, "the same text of some words\nand a line", "c"),
    (5, LONG, "c"), (6, 'password = "AbCdEfGh12345678" Mr. Smith licensed under the mit license', None), (None, None, None),
]


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_of_any_name_and_awkward_rows(spark, tmp_path, name):
    work, each = OPERATORS[name]
    out = work(table(spark, ROWS), tmp_path)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    rows = out.collect()
    if each is not None:
        assert len(rows) == len(ROWS)
    if each:
        new = set(out.columns) - set(HELPERS) | {
            "overlaps", "leaked", "n_bytes", "n_tokens", "over_limit", "replaced", "n_words", "phrases", "blocks",
            "base_failed", "posterior", "kept", "n_lines", "n_removed", "ids",
        }
        for c in set(HELPERS) - new:
            assert {r[c] for r in rows} == {f"own {c}"}, c


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, tmp_path, name):
    work, _ = OPERATORS[name]
    assert work(table(spark, []), tmp_path).count() == 0


def test_vectors_beside_columns_of_any_name(spark):
    schema = ", ".join(["vec_id long", "embedding array<float>", *(f"{n} string" for n in HELPERS)])
    rows = [(i, [float(i % 3)] * 64, *(["own"] * len(HELPERS))) for i in range(12)]
    assert centroids.cluster(spark.createDataFrame(rows, schema), k=2).rows.count() == 12
