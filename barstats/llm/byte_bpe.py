"""Byte-level BPE: ids of whole texts and texts of ids, by a table of ranks.

Each match of the pattern is a piece of its own. A piece that is no token itself is merged:
a segment tree over its byte positions keeps, for every range, the lowest rank of a pair of
neighbouring symbols and the leftmost place that has it. The root names the next merge. The merge
takes its right symbol out of the chain of live symbols, and only three leaves change: the
pair that began at the symbol now gone, the pair at the merged one, and the pair before it.
Each is a point update of one path to the root, so a piece of n bytes costs n log n, also
where one match is a whole text. Pieces that come often are remembered in a bounded table per worker.

A null text has no ids, and no ids are an empty text; null ids are null bytes. Special tokens are plain
text. Rows do not depend on each other: repeated rows and repeated keys each get their own
ids, and an empty table stays empty. A column that has the name of the new one is replaced.
Ids outside the table of ranks are refused with an error.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pieces that a worker remembers, some 220 bytes each: the last ones, and as many from before.
REMEMBERED = 300_000
LONGEST = 48
#: A leaf without a pair; greater than any rank and place.
_NONE = (1 << 62) - 1
_PLACE = (1 << 32) - 1
#: Pieces of more bytes hold their tree and chain in packed arrays.
_SMALL = 4096


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a file with a line for each: base64, a space, the rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a piece of bytes, by merging the leftmost pair of lowest rank until none is left."""
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    get, last = ranks.get, n - 1
    # Leaf p is node last + p. The key has the place in it, so the least of a range is leftmost
    # whatever the shape of the tree, and any number of leaves will do.
    tree = [_NONE] * last
    for p in range(last):
        rank = get(piece[p : p + 2])
        tree.append(_NONE if rank is None else rank << 32 | p)
    after, before = list(range(1, n + 1)), list(range(-1, last))
    if n > _SMALL:
        tree, after, before = array("q", tree), array("i", after), array("i", before)
    for node in range(last - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b

    while (least := tree[1]) != _NONE:
        i = least & _PLACE
        j = after[i]
        k = after[i] = after[j]
        # Three leaves change: the pair at j is gone, the one at i and the one before have grown.
        paths = [(last + i) >> 1]
        if j < last:
            tree[last + j] = _NONE
            paths.append((last + j) >> 1)
        if k < n:
            before[k] = i
            rank = get(piece[i : after[k]])
            tree[last + i] = _NONE if rank is None else rank << 32 | i
        else:
            tree[last + i] = _NONE
        if i:
            h = before[i]
            rank = get(piece[h:k])
            tree[last + h] = _NONE if rank is None else rank << 32 | h
            paths.append((last + h) >> 1)
        for node in paths:
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                if b < a:
                    a = b
                if tree[node] == a:
                    break
                tree[node] = a
                node >>= 1
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class Recent(dict):
    """Values by key, made when first asked for. When ``most`` are held they become the old ones,
    from which those that are asked for again come back. Long keys are not kept."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.old = {}
                self.old = self.copy()
                self.clear()
            self[key] = value
        return value


class ByteCoder:
    """Encodes and decodes by one file of ranks and one pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"{path}: bytes without a token")
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(_as_written(pattern))
        self.memo = Recent(self._ids, REMEMBERED)

    def _ids(self, piece: str) -> bytes:
        data = piece.encode()
        rank = self.ranks.get(data)
        return array("i", merged(data, self.ranks) if rank is None else [rank]).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text."""
        pieces = self.pattern.findall(text) if text else ()
        return np.frombuffer(b"".join(map(self.memo.__getitem__, pieces)), np.intc)

    def decode(self, ids: np.ndarray) -> bytes:
        try:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        except KeyError as e:
            raise ValueError(f"no token has the id {e}") from None


def _as_written(pattern: str) -> str:
    """The pattern with the white space of the Unicode property, as the library's regular
    expressions have it; here \\s would also take four control characters."""
    space = r"\p{White_Space}"
    return pattern.replace(r"[^\s", rf"[^{space}").replace(r"\S", rf"\P{{White_Space}}").replace(r"\s", space)


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteCoder:
    """One coder for each file, pattern and worker."""
    return ByteCoder(path, pattern)


def ids_of(path: str, pattern: str, text: Column) -> Column:
    """The ids of a column of texts: an array of int, empty for null."""

    @F.arrow_udf("array<int>")
    def encode_texts(texts: pa.Array) -> pa.Array:
        own = coder(path, pattern)
        ids = [own.encode(t.as_py()) for t in texts]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        values = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
        return pa.ListArray.from_arrays(pa.array(ends), values)

    # Ids that are used twice are still made once.
    return encode_texts.asNondeterministic()(text)


def bytes_of(path: str, pattern: str, ids: Column) -> Column:
    """The bytes of a column of ids; null for null."""

    @F.arrow_udf("binary")
    def decode_ids(ids: pa.Array) -> pa.Array:
        own = coder(path, pattern)
        made = [own.decode(x.values.to_numpy()) if x.is_valid else None for x in ids]
        return pa.array(made, pa.binary())

    return decode_ids(ids)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The documents with their ids. ``path`` is a file that every worker must be able to open."""
    return docs.withColumn(ids_col, ids_of(path, pattern, F.col(text_col)))


def decode(docs: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """The documents with the bytes their ids stand for."""
    return docs.withColumn(bytes_col, bytes_of(path, pattern, F.col(ids_col)))
