"""Near-duplicates by SimHash, found with multi-index hashing.

Two 64-bit fingerprints that differ in at most ``r`` bits differ in at most ``r // 2`` of
the upper 32 or in at most ``(r - 1) // 2`` of the lower 32. So every fingerprint enters
the table of each half under the values within a small Hamming ball of its own half: two
halves at distance 2 meet under a value one bit from both. Fingerprints that share a
table entry have their complete distance verified.

The pairs of an entry are looked at only while it holds at most ``CROWDED`` different
fingerprints. Those of a fuller entry go another exact way that emits no pairs: two
fingerprints are within 4 bits just when some 64-bit value is within 2 bits of both, so
each is filed under its ball of radius 2 and linked to the least fingerprint filed there.

Equal texts have equal fingerprints, and only distinct fingerprints enter the tables, so
the size of a group of copies does not matter. The keys of a table are spread by hash and
streamed in sorted order: a task holds the fingerprints of one entry, CROWDED at most.

Null or empty text has fingerprint 0, and links like any other. ``component_id`` is the
smallest id that is not null; null if the component has none. Repeated rows are rows of
their own; an empty table has no groups, and texts of any length are shingled whole. Columns of the input with the names of new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstats.llm.common import append, ascii_words, components, set_apart
from barstats.sources.scratch import staged

SHINGLE = 4
SEED = 42
RADIUS = 4
CROWDED = 256
_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes. Signed, as a long is."""
    words = ascii_words(text)
    if not words:
        return 0
    line = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_digest
    spans = list(zip(starts, ends[shingle - 1 :])) or [(0, len(line))]
    ones = np.zeros(64, np.int64)
    for k in range(0, len(spans), _AT_ONCE):
        some = b"".join([digest(line[a:b], SEED) for a, b in spans[k : k + _AT_ONCE]])
        ones += np.unpackbits(np.frombuffer(some, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(spans)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fp") -> DataFrame:
    return append(docs, [text_col], f"{name} long", lambda texts: [list(map(fingerprint, texts))])


def hex_of(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _table_entries(fps: DataFrame) -> DataFrame:
    """Each fingerprint under the ball of radius 1 around each of its halves."""
    flips = fps.select("fp", F.explode(F.expr("sequence(0, 65)")).alias("j"))
    value = F.expr(
        "CASE WHEN j < 33 THEN shiftrightunsigned(fp, 32) ELSE fp & 4294967295L END"
        " ^ CASE WHEN j % 33 = 0 THEN 0L ELSE shiftleft(1L, j % 33 - 1) END"
    )
    half = F.expr("CASE WHEN j < 33 THEN 0L ELSE 4294967296L END")
    return flips.select((value + half).alias("key"), "fp")


def _ball_entries(fps: DataFrame) -> DataFrame:
    """Each fingerprint under every value within 2 bits of it."""
    one = fps.select("fp", F.explode(F.expr("sequence(0, 64)")).alias("i"))
    two = one.select("fp", "i", F.explode(F.expr("sequence(i, 64)")).alias("j"))
    two = two.where("i < j OR j = 0")
    bit = "CASE WHEN {0} = 0 THEN 0L ELSE shiftleft(1L, {0} - 1) END"
    return two.select(F.expr(f"fp ^ {bit.format('i')} ^ {bit.format('j')}").alias("key"), "fp")


def _entries_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows sorted by key as (key, fp) arrays that never cut an entry that is not crowded."""
    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        fps = np.concatenate([fps, batch.column(1).to_numpy()])
        if len(keys):
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield keys[:cut], fps[:cut]
            elif len(keys) > 50_000:  # one entry goes on and on: in pieces
                yield keys[:-CROWDED], fps[:-CROWDED]
                cut = len(keys) - CROWDED
            keys, fps = keys[cut:], fps[cut:]
    if len(keys):
        yield keys, fps


class _Forest:
    """What a task has linked so far, so that it gives no link within a connected group."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def _root(self, node: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = node = parent[up]
        return node

    def grown_by(self, pairs: np.ndarray) -> pa.RecordBatch:
        """Those of the links that join two groups."""
        kept = []
        for a, b in pairs.tolist():
            one, two = self._root(a), self._root(b)
            if one != two:
                self.parent[two] = one
                kept.append((a, b))
        columns = [pa.array(c, pa.int64()) for c in (zip(*kept) if kept else ((), ()))]
        return pa.RecordBatch.from_arrays(columns, schema=_LINKS)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verify(radius: int, crowded: int):
    """Links that connect what the entries of a task connect, and the fingerprints of
    crowded entries (paired with null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, given = _Forest(), np.zeros(0, np.int64)
        last = None  # the key of a crowded entry that may go on
        for keys, fps in _entries_in_order(batches):
            new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            size = np.diff(np.r_[new, len(keys)])
            full = size > crowded
            full[0] |= keys[0] == last
            last = keys[-1] if full[-1] else None
            if full.any():
                some = np.setdiff1d(fps[np.repeat(full, size)], given)
                given = np.union1d(given, some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.nulls(len(some), pa.int64())], schema=_LINKS
                )
            found = []
            for n in np.unique(size[~full & (size > 1)]):
                rows = fps[new[~full & (size == n)][:, None] + np.arange(n)]
                i, j = np.triu_indices(n, 1)
                for k in range(0, len(rows), max(1, 200_000 // len(i))):
                    some = rows[k : k + max(1, 200_000 // len(i))]
                    a, b = some[:, i].ravel(), some[:, j].ravel()
                    near = np.bitwise_count((a ^ b).view(np.uint64)) <= radius
                    found.append(np.unique(np.stack([a[near], b[near]], 1), axis=0))
            if found:
                yield forest.grown_by(np.unique(np.concatenate(found), axis=0))

    return run


def _star(radius: int):
    """Links every fingerprint of an entry to the least; they are near by construction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, last = _Forest(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.r_[last is None or keys[0] != last[0], keys[1:] != keys[:-1]]
            lead = fps[np.maximum.accumulate(np.where(new, np.arange(len(fps)), 0))]
            if not new[0]:  # the entry began in an earlier batch
                lead[: int(np.argmax(new)) if new.any() else len(new)] = last[1]
            last = (keys[-1], lead[-1])
            apart = lead != fps
            pairs = np.unique(np.stack([lead[apart], fps[apart]], 1), axis=0)
            near = np.bitwise_count((pairs[:, 0] ^ pairs[:, 1]).view(np.uint64)) <= radius
            yield forest.grown_by(pairs[near])

    return run


def links(fps: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links that connect what is connected: pairs (a, b) of fingerprints within 4 bits.

    ``fps`` has distinct values in column fp. The links of crowded table entries are
    given as stars, which connect the same fingerprints as all their pairs would. A link
    may come more than once.
    """
    entries = _table_entries(fps).repartition("key").sortWithinPartitions("key", "fp")
    found = staged(entries.mapInArrow(_verify(RADIUS, crowded), "a long, b long"), "pairs")
    full = found.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    balls = _ball_entries(full).repartition("key").sortWithinPartitions("key", "fp")
    stars = balls.mapInArrow(_star(RADIUS), "a long, b long")
    return found.where("b IS NOT NULL").union(stars)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED
) -> DataFrame:
    """A row for each document: its id, fp (long), root (of its group) and component_id."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    rows = staged(with_fingerprint(rows, "_text").drop("_text"), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = components(links(fps.select("fp"), crowded)).withColumnRenamed("node", "fp")
    # Only fingerprints that have a link are grouped and joined by their root; ids are staged, as
    # Spark splits a crowded root only where both sides of a join come straight from a shuffle.
    ids = groups.join(fps, "fp").groupBy("root").agg(F.min("least").alias("id"))
    linked = groups.join(staged(ids, "ids"), "root").select("fp", "root", "id")
    component = F.expr("CASE WHEN root IS NULL THEN least ELSE id END")
    of_fp = fps.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), component.alias("component_id")
    )
    return rows.join(staged(of_fp, "classes"), "fp", "left").select(
        "doc_id", "fp", "root", "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED
) -> DataFrame:
    """The documents, one of each group: that with the smallest id.

    Of rows that share that id one stays, as does one of a group in which no row has an
    id. Rows are told apart by id, so only rows whose id repeats or is null are compared
    by fingerprint once more.
    """
    held, (key, text), back = set_apart(docs, id_col, text_col)
    found = staged(near_duplicates(held, key, text, crowded), "classified")
    odd = found.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select("doc_id")
    odd = staged(odd, "odd")
    gone = found.where("NOT doc_id <=> component_id AND doc_id IS NOT NULL").select("doc_id")
    gone = staged(gone.union(odd.where("doc_id IS NOT NULL")).distinct(), "gone")
    same = held[key] == gone["doc_id"]
    plain = held.where(F.col(key).isNotNull()).join(gone, same, "left_anti")
    if odd.isEmpty():
        return back(plain)
    known = held.join(odd, held[key].eqNullSafe(odd["doc_id"]), "left_semi")
    roots = found.select(F.col("fp").alias("_fp"), "root", "component_id").distinct()
    known = with_fingerprint(known, text, "_fp").join(
        roots.withColumnsRenamed({"root": "_root", "component_id": "_least"}), "_fp"
    )
    known = known.where(F.col(key).eqNullSafe(F.col("_least"))).dropDuplicates(["_root"])
    return back(plain.unionByName(known.select(*held.columns)))
