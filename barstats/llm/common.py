"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barstats.sources.scratch import staged

#: A word for every operator that does not say otherwise: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ascii_words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case, as UTF-8."""
    return text.encode().lower().split() if text else []


def append(
    df: DataFrame, inputs: Sequence[str], fields: str, work: Callable[..., Sequence[list]]
) -> DataFrame:
    """The table with new columns that are computed from whole batches of its own.

    ``work`` gets one list for each input column and gives one for each field. A column
    of the table that has the name of a new one is replaced.
    """
    new = StructType.fromDDL(fields)
    taken = {f.name.lower() for f in new}
    kept = [f for f in df.schema.fields if f.name.lower() not in taken]
    names = [f.name for f in kept]
    out = StructType([*kept, *new.fields])
    # The types of the new columns alone: those of the others come with the batch.
    types = list(to_arrow_schema(new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = work(*(batch.column(c).to_pylist() for c in inputs))
            made = [pa.array(v, f.type) for v, f in zip(values, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *made], [*names, *(f.name for f in types)]
            )

    return df.mapInArrow(run, out)


def set_apart(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[str], Callable[..., DataFrame]]:
    """The table with its columns named by number, so that none has the name of a helper.

    Also the new names of the needed columns, and a function that gives the others of a result their
    own names back, beside the columns that are added. One of an added name is replaced.
    """
    held = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)))
    lower = [c.lower() for c in docs.columns]

    def back(out: DataFrame, *added: str) -> DataFrame:
        taken = {c.lower() for c in added}
        own = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in taken]
        return out.select(*own, *added)

    return held, [f"c{lower.index(c.lower())}" for c in needed], back


class Memo(dict):
    """Values by key, made when first asked for; emptied when it holds ``most`` of them.

    Long keys are not kept, so that its memory is bounded. It changes no result.
    """

    def __init__(self, make: Callable, most: int = 600_000, longest: int = 48):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


#: Nodes that a task links before it gives them and begins anew.
_HELD = 200_000


def _linked_to_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) in the order of u, each node once with the least that it is linked to here.

    Gives what it holds between two values of u only, so edges of one u are always together.
    """
    parent: dict = {}

    def root(node):
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = node = parent[up]
        return node

    schema, last = None, None
    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if len(parent) >= _HELD and u != last:
                yield _stars(parent, root, schema)
                parent.clear()
            last = u
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if parent:
        yield _stars(parent, root, schema)


def _stars(parent: dict, root: Callable, schema: pa.Schema) -> pa.RecordBatch:
    links = [(n, r) for n in parent if (r := root(n)) != n]
    columns = [pa.array(c, f.type) for c, f in zip(zip(*links), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of a graph can reach: columns node, root.

    ``edges`` has two columns of ordered values, a and b. Tasks link the nodes of their own
    edges to the least of each group, first as the edges come, so that no node has more edges
    to smaller ones than there are tasks, then all of a node's. As long as a node has two such
    edges, or lies between two nodes, every edge hops to the least neighbour of its
    smaller end, and the edges of the larger are linked again. Every round is written to the
    shared folder, so no lineage grows; only a count comes to the driver. Nodes without an
    edge to another node are left out.
    """
    e = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    e = e.mapInArrow(_linked_to_least, e.schema)
    while True:
        dealt = e.repartition("u").sortWithinPartitions("u")
        e = staged(dealt.mapInArrow(_linked_to_least, e.schema), "links")
        ends = e.select(F.col("u").alias("node"), F.col("v").alias("to")).union(
            e.select("v", F.lit(None).cast(e.schema["v"].dataType))
        )
        between = F.max(F.col("to").isNull()) & F.min("to").isNotNull()
        nodes = ends.groupBy("node").agg(
            F.min("to").alias("least"),
            (between | F.coalesce(F.min("to") < F.max("to"), F.lit(False))).alias("open"),
        )
        nodes = staged(nodes, "nodes")
        if not nodes.where("open").count():
            return nodes.select("node", F.coalesce("least", "node").alias("root"))
        least = nodes.where("least IS NOT NULL").select(F.col("node").alias("v"), "least")
        e = e.join(least, "v", "left").select("u", F.coalesce("least", "v").alias("v"))


#: A-Z in lower case; other ASCII than letters and digits become spaces.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def plain_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits (in lower case) and of all other characters, as UTF-8."""
    return text.encode().translate(_PLAIN).split() if text else []


def chunks(table: DataFrame, text_col: str, most_bytes: int) -> Iterator[list]:
    """The rows of a small table in lists of about ``most_bytes`` of text, so that each can be
    sent to every task. They come one after the other: the driver holds one while it is made."""
    size = table.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = -(-size // most_bytes) or 1
    part = F.pmod(F.xxhash64(text_col), F.lit(n))
    return (table.where(part == i).collect() for i in range(n))
