"""The pipeline's stages one by one against what the operators' brute force says of each."""

from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
import pytest
from barstats.llm import queries, token_store
from llm_cases import FOLDER, documents
from test_brute import brute_components, brute_fingerprint
from test_filters import brute_features, brute_targets

WORDS = __import__("re").compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("case", ["awkward", "given"])
def test_stages(spark, folders, case, tmp_path):
    folder = folders[case]
    docs, tables = queries.table(spark, folder), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "token_output":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        tables[name] = [tuple(r) for r in docs.collect()]
    start = [tuple(r.values()) for r in documents(folder)]
    good, one, clean, mixed, tokens = tables.values()

    assert not Counter(good) - Counter(start)
    assert not any(brute_features(r[1])[-1] for r in good)
    roots = brute_components({brute_fingerprint(r[1]) for r in good})
    groups = Counter(roots[brute_fingerprint(r[1])] for r in one)
    assert set(groups) == set(roots.values()) and set(groups.values()) <= {1}
    assert not Counter(clean) - Counter(one)
    assert not Counter(set(mixed)) - Counter(set(clean))
    size = defaultdict(int)
    for r in clean:
        size[r[3]] += len(WORDS.findall(r[1] or ""))
    target, taken = brute_targets(size), defaultdict(int)
    for r in mixed:
        taken[r[3]] += len(WORDS.findall(r[1] or ""))
    longest = max((len(WORDS.findall(r[1] or "")) for r in clean), default=0)
    assert all(abs(taken[s] - target[s]) <= longest for s in size)
    assert max(Counter(mixed).values(), default=0) <= 3
    own = token_store.encoder(queries.public_tokenizers.path(queries.BYTE_TOKENIZER))
    lengths = Counter((r[0], len(own.encode(r[1])) // own.dtype.itemsize + 1) for r in mixed)
    assert Counter((r[0], r[3]) for r in tokens) == lengths


def test_run_gives_what_the_stages_give(spark, folders):
    assert corpus_pipeline.run(spark, folders["empty"]).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None
    assert Path(corpus_pipeline.__file__).parent == Path(__file__).parents[2]
    if FOLDER.exists():
        assert corpus_pipeline.run(spark, str(FOLDER)).count() > 50
