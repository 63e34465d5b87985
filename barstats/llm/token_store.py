"""Token ids as binary files, with a minimal perfect hash index for keyed access.

A store is a folder:

* ``data/``: a file per shard, with the ids of its documents one after the other: a
  header of 16 bytes (``TOKIDS1\\n``, the width of an id in bytes, zeros), then the ids as
  little-endian unsigned integers. Shards in order hold the documents in ascending id.
* ``directory/``: Parquet, a row per document: shard, doc_id, copy, offset, n_tokens.
* ``shards/``: Parquet, a row per shard: its file and the number of ids before it.
* ``index/``: a file per bucket of keys. A key's 64-bit hash goes through levels of bit
  arrays; where it is alone in its slot, the slot's bit is set, and the bit's rank is the
  key's place in the tables of fingerprints, shards, offsets and lengths. A look-up reads
  one place, and the stored 64-bit fingerprint tells keys that were never stored.

The key of a document is its id and ``copy``: 0, or the number of earlier rows with the
same id. Null ids come first and are keys like any other. A null text is empty, an empty table gives an empty store,
and texts of any length are encoded whole. Other columns are not read, whatever their names. Rows with
one id are ordered as they are read, and may span shards, so they can be any share of all.
Text goes through one shuffle, by range of id; tasks stream it, and keep a few numbers for each
document of the shard. A file's name carries the attempt that wrote it, and only
a committed task's rows name it, so lost and repeated tasks do no harm. Files are written
with pyarrow's file systems, straight into the store.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from barstats.llm.common import Memo
from barstats.llm.token_counts import ODD, SPACES, byte_symbols
from barstats.sources.scratch import staged

MAGIC = b"TOKIDS1\n"
HEADER = 16
KEYS_PER_BUCKET = 1 << 17
GAMMA = 2.0
LEVELS = 40
#: The published pattern of byte-level tokenizers for their pieces (a fixed value).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+".replace(
    r"[^\s\p{L}\p{N}]", rf"[^{SPACES}\p{{L}}\p{{N}}]"
).replace(r"(?!\S)", rf"(?![^{SPACES}])").replace(r"\s+", rf"[{SPACES}]+")

#: Marks that are a piece by themselves behind a word.
MARKS = frozenset(".,;:!?)")


class _Irregular(Exception):
    """Two white-space characters in a row: the text can't be cut at single spaces."""


class Encoder:
    """The ids of whole texts as bytes, by the model of the tokenizers library.

    A piece never holds white space after anything else, so a text can be cut before each
    space that follows a visible character, and the stretches encoded apart. Their ids are
    remembered in bounded tables, the library is asked for the others.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        names = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.split = regex.compile(f"({'|'.join(names)})" if names else "(?!)")
        self.symbols = byte_symbols()
        size = max([self.tokenizer.get_vocab_size(), *(i + 1 for i in added)])
        self.of_id = [i.to_bytes(self.dtype.itemsize, "little") for i in range(size)]
        self.pieces = regex.compile(PIECES)
        self.stretches = regex.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
        self.white = regex.compile(f"[{SPACES}]")
        self.of_piece = Memo(self._piece, most=500_000)
        self.of_word = Memo(self._word, most=500_000)

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.of_id[i] for i in ids])

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece[1:].isalpha() and piece[0] == " ":
            return self._written(self.symbols[32] + piece[1:])
        return self._written("".join([self.symbols[b] for b in piece.encode()]))

    def _written(self, symbols: str) -> bytes:
        return self._bytes([t.id for t in self.model.tokenize(symbols)])

    def _stretch(self, stretch: str) -> bytes:
        if ODD.search(stretch):
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(stretch)
            return b"".join([self._written(p) for p, _ in found])
        return b"".join(map(self.of_piece.__getitem__, self.pieces.findall(stretch)))

    def _word(self, word: str) -> bytes:
        """Of a word behind a single space.

        Letters are one piece with the space, and a mark behind them is another.
        """
        if not ODD.search(word):
            if word.isalpha():
                return self._piece(" " + word)
            if word[-1:] in MARKS and word[:-1].isalpha():
                return self.of_word[word[:-1]] + self.of_piece[word[-1]]
        if not word or self.white.match(word):
            raise _Irregular
        return self._stretch(" " + word)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<" in text and self.split.search(text):
            parts = self.split.split(text)
            return b"".join(
                self._bytes([self.special[p]]) if i % 2 else self.encode(p)
                for i, p in enumerate(parts)
            )
        first, *words = text.split(" ")
        try:
            return self._stretch(first) + b"".join(map(self.of_word.__getitem__, words))
        except _Irregular:
            return b"".join(map(self._stretch, self.stretches.findall(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _open(uri: str, mode: str):
    """A file of the store, on whatever file system its address names."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    if mode == "r":
        return system.open_input_file(path)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)


# --- the index


def _slot(h: np.ndarray, level: int, size: int) -> np.ndarray:
    """A slot of a level for each hash; a mixer of shifts and odd multipliers."""
    x = h + np.uint64((level * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Gives n distinct 64-bit hashes the numbers 0 to n - 1, in about 3 bits a key.

    Hashes that no level sets apart (the same 64 bits twice) are listed, and numbered last.
    """

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.before = np.cumsum([0, *(int(b.sum()) for b in levels)])
        self.ranks = [np.cumsum(b) - b for b in levels]

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        levels, left = [], hashes
        while len(left) and len(levels) < LEVELS:
            size = max(64, int(GAMMA * len(left)))
            slot = _slot(left, len(levels), size)
            alone = np.bincount(slot, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[slot]]
        return cls(levels, np.sort(left))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash; -1, or another's number, for one never built in."""
        out = np.full(len(hashes), -1, np.int64)
        todo = np.arange(len(hashes))
        for k, bits in enumerate(self.levels):
            slot = _slot(hashes[todo], k, len(bits))
            hit = bits[slot]
            out[todo[hit]] = self.before[k] + self.ranks[k][slot[hit]]
            todo = todo[~hit]
        if len(self.rest):
            at = np.searchsorted(self.rest, hashes[todo])
            found = at < len(self.rest)
            found[found] = self.rest[at[found]] == hashes[todo][found]
            out[todo[found]] = self.before[-1] + at[found]
        return out


def _pack_index(h, fingerprint, shard, offset, n) -> bytes:
    """The index file of one bucket."""
    mph = PerfectHash.build(h)
    place = mph.places(h)
    # Equal hashes share the first of their places: the others follow in order.
    tied = np.flatnonzero(place >= mph.before[-1])
    tied = tied[np.argsort(h[tied], kind="stable")]
    place[tied] = mph.before[-1] + np.arange(len(tied))
    tables = {}
    for name, values in (("fingerprint", fingerprint), ("shard", shard), ("offset", offset), ("n", n)):
        tables[name] = np.empty_like(values)
        tables[name][place] = values
    out = io.BytesIO()
    sizes = np.array([len(b) for b in mph.levels], np.int64)
    bits = np.packbits(np.concatenate([np.zeros(0, bool), *mph.levels]))
    np.savez(out, sizes=sizes, bits=bits, rest=mph.rest, **tables)
    return out.getvalue()


class _Bucket:
    """An index file in memory."""

    def __init__(self, uri: str):
        with _open(uri, "r") as f:
            self.tables = dict(np.load(io.BytesIO(f.read())))
        ends = np.cumsum(self.tables["sizes"])
        bits = np.unpackbits(self.tables["bits"], count=int(ends[-1]) if len(ends) else 0)
        self.mph = PerfectHash(np.split(bits.astype(bool), ends[:-1]) if len(ends) else [], self.tables["rest"])

    def find(self, h: np.ndarray, fingerprint: np.ndarray) -> np.ndarray:
        """Places in the tables, -1 for keys that are not stored."""
        at = self.mph.places(h)
        known, last = self.tables["fingerprint"], self.mph.before[-1]
        ok = (at >= 0) & (known[np.maximum(at, 0)] == fingerprint) if len(known) else np.zeros(len(h), bool)
        for i in np.flatnonzero((at >= last) & ~ok):  # one of several keys with one hash
            while at[i] + 1 < len(known) and self.mph.rest[at[i] + 1 - last] == h[i] and not ok[i]:
                at[i] += 1
                ok[i] = known[at[i]] == fingerprint[i]
        return np.where(ok, at, -1)


def _batches(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.RecordBatch]:
    """Parts of the batches that have one value of a column each."""
    for batch in batches:
        if batch.num_rows:
            value = batch.column(by).to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(np.r_[True, value[1:] != value[:-1], True])
            for a, b in zip(cut, cut[1:]):
                yield batch.slice(a, b - a)


# --- the store


@dataclass(frozen=True)
class TokenStore:
    """A written store. ``directory`` and ``shards`` are its Parquet tables."""

    spark: SparkSession
    path: str
    dtype: str
    buckets: int

    @property
    def directory(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/directory")

    @property
    def shards(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/shards")

    def locate(self, keys: DataFrame) -> DataFrame:
        """doc_id, copy, shard, offset, n_tokens of the keys (doc_id, copy) it has.

        Keys go to the tasks of their buckets; each loads one index file at a time.
        """
        path = self.path
        schema = "doc_id " + keys.schema["doc_id"].dataType.simpleString()
        schema += ", copy long, shard int, offset long, n_tokens long"
        arrow = to_arrow_schema(StructType.fromDDL(schema))

        def run(batches):
            name, bucket = None, None
            for b in _batches(batches, "bucket"):
                if b.column("bucket")[0].as_py() != name:
                    name = b.column("bucket")[0].as_py()
                    bucket = _Bucket(f"{path}/index/{name:06d}.npz")
                h, mark = (b.column(c).to_numpy().view(np.uint64) for c in ("h", "mark"))
                at = bucket.find(h, mark)
                ok = pa.array(at >= 0)
                at = at[at >= 0]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").filter(ok),
                        b.column("copy").filter(ok),
                        *(
                            pa.array(bucket.tables[c][at]).cast(arrow.field(i).type)
                            for i, c in enumerate(("shard", "offset", "n"), 2)
                        ),
                    ],
                    schema=arrow,
                )

        keyed = _hashed(keys.select("doc_id", F.col("copy").cast("long").alias("copy")), self.buckets)
        keyed = keyed.repartition("bucket").sortWithinPartitions("bucket")
        return keyed.mapInArrow(run, schema)

    def read(self, keys: DataFrame, field: str, work: Callable[[np.ndarray], object]) -> DataFrame:
        """doc_id, copy, start, n_tokens and a field computed from the ids of each key.

        Found keys go to the tasks of their shards and are read in the order of the file.
        """
        dtype = np.dtype(self.dtype)
        found = self.locate(keys).join(self.shards.select("shard", "file", "before"), "shard")
        key = found.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {key}, copy long, start long, n_tokens long, {field}"
        arrow = to_arrow_schema(StructType.fromDDL(schema))

        def run(batches):
            name, f = None, None
            for b in _batches(batches, "shard"):
                if b.column("file")[0].as_py() != name:
                    if f is not None:
                        f.close()
                    name = b.column("file")[0].as_py()
                    f = _open(name, "r")
                    if f.read(len(MAGIC)) != MAGIC:
                        raise ValueError(f"{name}: not a file of token ids")
                values = []
                for at, n in zip(b.column("offset").to_numpy().tolist(), b.column("n_tokens").to_numpy().tolist()):
                    f.seek(HEADER + at * dtype.itemsize)
                    values.append(work(np.frombuffer(f.read(n * dtype.itemsize), dtype)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(c) for c in ("doc_id", "copy", "start", "n_tokens")),
                        pa.array(values, arrow.field(4).type),
                    ],
                    schema=arrow,
                )
            if f is not None:
                f.close()

        rows = found.select(
            "doc_id", "copy", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "shard", "file", "offset"
        )
        rows = rows.repartition("shard").sortWithinPartitions("shard", "offset")
        return rows.mapInArrow(run, schema)


def _hashed(keys: DataFrame, buckets: int) -> DataFrame:
    """Keys with two hashes, of which the first also gives the bucket."""
    return keys.withColumns(
        {
            "h": F.xxhash64("doc_id", "copy"),
            "mark": F.xxhash64(F.lit("mark"), "copy", "doc_id"),
            "bucket": F.pmod(F.hash("copy", "doc_id"), F.lit(buckets)),
        }
    )


def _write_shards(path: str, tokenizer: str, end_id: int):
    schema = pa.schema(
        [("shard", pa.int32()), ("file", pa.string()), ("copy", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())]
    )

    def run(batches):
        own, f, at, last, copy = encoder(tokenizer), None, 0, object(), 0
        shard = TaskContext.get().partitionId()
        name = f"{path}/data/{shard:06d}-{uuid4().hex}.ids"
        end = own._bytes([end_id])
        for batch in batches:
            ids = batch.column(0).to_pylist()
            if ids and f is None:
                f = _open(name, "w")
                f.write((MAGIC + bytes([own.dtype.itemsize])).ljust(HEADER, b"\0"))
            copies, offsets, counts = [], [], []
            for key, text in zip(ids, batch.column(1)):
                data = own.encode(text.as_py()) + end
                f.write(data)
                copy = copy + 1 if key == last else 0
                last = key
                copies.append(copy)
                offsets.append(at)
                counts.append(len(data) // own.dtype.itemsize)
                at += counts[-1]
            rows = [pa.array([v] * len(ids), t) for v, t in ((shard, pa.int32()), (name, pa.string()))]
            numbers = [pa.array(v, pa.int64()) for v in (copies, offsets, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *rows, *numbers], schema=pa.schema([batch.schema.field(0), *schema])
            )
        if f is not None:
            f.close()

    return run


def _write_index(path: str):
    def pack(name, parts):
        both = pa.Table.from_batches(parts)
        h, mark = (both.column(c).to_numpy().view(np.uint64) for c in ("h", "mark"))
        rest = [both.column(c).to_numpy() for c in ("shard", "offset", "n_tokens")]
        # The content is the same for every attempt, and the file appears when closed.
        with _open(f"{path}/index/{name:06d}.npz", "w") as f:
            f.write(_pack_index(h, mark, rest[0].astype(np.uint32), rest[1].astype(np.uint64), rest[2].astype(np.uint64)))
        return pa.RecordBatch.from_pydict({"bucket": pa.array([name], pa.int32()), "keys": pa.array([len(h)], pa.int64())})

    def run(batches):
        name, parts = None, []
        for b in _batches(batches, "bucket"):
            if parts and b.column("bucket")[0].as_py() != name:
                yield pack(name, parts)
                parts = []
            name = b.column("bucket")[0].as_py()
            parts.append(b)
        if parts:
            yield pack(name, parts)

    return run


def write_store(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    keys_per_bucket: int = KEYS_PER_BUCKET,
) -> TokenStore:
    """Encode every text, with ``end_id`` behind it, into a store at a new path."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("_row")
    )
    rows = rows.repartitionByRange("doc_id", "_row").sortWithinPartitions("doc_id", "_row")
    key = docs.schema[id_col].dataType.simpleString()
    written = rows.select("doc_id", "text").mapInArrow(
        _write_shards(path, tokenizer, end_id),
        f"doc_id {key}, shard int, file string, copy long, offset long, n_tokens long",
    )
    written = staged(written, "shards")

    # One row for each shard, from here to the next comment.
    of_shard = written.groupBy("shard", "file").agg(
        F.sum("n_tokens").alias("n_ids"),
        F.min_by("doc_id", "offset").alias("first"),
        F.max_by("doc_id", "offset").alias("last"),
        (F.max_by("copy", "offset") + 1).alias("at_end"),
    )
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    of_shard = staged(of_shard.withColumn("before", F.coalesce(before, F.lit(0))), "before")
    one, two = of_shard.alias("one"), of_shard.alias("two")
    earlier = (
        one.join(two, F.expr("one.first <=> two.last AND two.shard < one.shard"))
        .groupBy("one.shard")
        .agg(F.sum("two.at_end").alias("earlier"))
    )
    carried = of_shard.join(earlier, "shard", "left")
    carried.select("shard", "file", "n_ids", "before").write.parquet(f"{path}/shards")

    # An id that goes on from earlier shards has had copies there.
    more = F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.coalesce("earlier", F.lit(0))).otherwise(0)
    directory = written.join(carried.select("shard", "first", "earlier"), "shard").select(
        "shard", "doc_id", (F.col("copy") + more).alias("copy"), "offset", "n_tokens"
    )
    directory.write.parquet(f"{path}/directory")
    directory = spark.read.parquet(f"{path}/directory")
    buckets = max(1, -(-directory.count() // keys_per_bucket))
    keyed = _hashed(directory, buckets).repartition("bucket").sortWithinPartitions("bucket")
    keyed.select("bucket", "h", "mark", "shard", "offset", "n_tokens").mapInArrow(
        _write_index(path), "bucket int, keys long"
    ).write.parquet(f"{path}/buckets")
    return TokenStore(spark, path, Encoder(tokenizer).dtype.str, buckets)


def crc32_of(ids: np.ndarray) -> int:
    """Of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
