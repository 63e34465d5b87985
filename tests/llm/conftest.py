import pytest
from llm_cases import BENCH, FOLDER, ROWS, SCHEMA


@pytest.fixture(scope="session")
def folders(spark, tmp_path_factory):
    """Folders of tables: awkward rows, no rows, given ones."""
    out = {}
    for name, rows, items in (("awkward", ROWS, BENCH), ("empty", [], [])):
        out[name] = str(tmp_path_factory.mktemp(name))
        spark.createDataFrame(rows, SCHEMA).repartition(2).write.parquet(f"{out[name]}/documents.parquet")
        spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{out[name]}/benchmark.parquet")
    if FOLDER.exists():
        out["given"] = str(FOLDER)
    return out
