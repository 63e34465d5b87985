"""Ranked lexical search: term at a time over short lists, document at a time over long ones.

``build_index`` packs documents into blocks as they are read: each block has a list of
(document, times) for every term it holds. Statistics (documents with a term, number of terms) are
of the whole index, so scores do not depend on blocks.

In each block a query's short lists are added up term by term: the sums are one more list, as
ordered as the others and with a greatest score. That list and the long ones, each with the
greatest score it has in the block, are then walked a document at a time. With the lists in order of
their bounds, those whose bounds together stay below the score of the k-th best so far can
bring in no document of their own: only the others name candidates, and the lists below are
skipped to a candidate while it can still reach that score. The best of a query are kept
from block to block of a task, so that k rows of each task meet at the end. No document is
left out, whatever the sizes: bounds only say what cannot be among the best.

Queries go to the tasks in chunks of a bounded size, one job after the other, and equal queries
are searched once. Lists are shuffled by block, and only those of the chunk's terms; a
block is bounded by documents and by bytes, so no term, copy or source can crowd a task.

Null and empty texts have no terms, and are found by no query; a query without terms finds nothing.
Equal scores are ordered by ascending id, null first, and rows with equal ids are rows
of their own. Repeated rows of the queries each get their list. Texts of any length are indexed
whole; an empty table of either side gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import total_ordering
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barstats.llm.common import plain_words
from barstats.sources.scratch import new_folder, staged

BEST = 20
#: A block has at most so many documents, and about so many bytes of text.
BLOCK_DOCS = 4096
BLOCK_BYTES = 16_000_000
#: Lists of up to this share of a block's documents are short.
SHORT = 0.25
#: Bytes of queries that go to the tasks at a time.
QUERY_BYTES = 1_000_000
#: Fixed values of the scores: times of a term weigh SCALE * t div (1000 * t + LENGTH * m),
#: where m is BASE + (SHARE * n * N) div L for a document of n terms.
SCALE, LENGTH, BASE, SHARE = 1_000_000_000, 12, 75, 25
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The terms of a text in lower case, as plain_words() finds them.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


# --- the index


def _pack(id_type: pa.DataType, schema: pa.Schema):
    """Documents (id, text) to rows of blocks: first one without a term that has the ids and
    lengths of the documents, then one for each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        ids, lengths, numbers, times, size, terms = [], [], [], [], 0, {}

        def block() -> pa.RecordBatch:
            n = [len(x) for x in numbers]
            term = np.fromiter((t for x in numbers for t in x), np.int32, sum(n))
            order = np.argsort(term, kind="stable")
            docs = np.repeat(np.arange(len(n), dtype=np.int32), n)[order]
            counts = np.fromiter((t for x in times for t in x), np.int32, len(term))[order]
            ends = np.concatenate([[0, 0], np.cumsum(np.bincount(term, minlength=len(terms)))]).astype(np.int32)
            ends_of_times = np.concatenate([[0], ends[1:] + len(n)]).astype(np.int32)
            count = len(terms) + 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(count, first + made)),
                    pa.array([None, *terms], pa.binary()).cast(pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(docs)),
                    pa.ListArray.from_arrays(
                        pa.array(ends_of_times), pa.array(np.concatenate([np.array(lengths, np.int32), counts]))
                    ),
                    pa.array([ids] + [None] * len(terms), pa.list_(id_type)),
                ],
                schema=schema,
            )

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                words = plain_words(text)
                counted = Counter(words)
                ids.append(key)
                lengths.append(len(words))
                numbers.append([terms.setdefault(t, len(terms)) for t in counted])
                times.append(counted.values())
                size += len(text or "")
                if len(ids) == BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield block()
                    made += 1
                    ids, lengths, numbers, times, size, terms = [], [], [], [], 0, {}
        if ids:
            yield block()

    return run


@dataclass(frozen=True)
class Index:
    """A written index. ``rows`` has block, term, docs, times and ids; in the row of a block that has
    no term, ids are those of its documents and times their lengths."""

    rows: DataFrame

    def statistics(self) -> tuple[int, int]:
        """How many documents have a term, and how many terms there are."""
        of_block = self.rows.where("term IS NULL").select(
            F.size(F.filter("times", lambda n: n > 0)).cast("long").alias("n"),
            F.aggregate("times", F.lit(0).cast("long"), lambda a, n: a + n).alias("terms"),
        )
        n, terms = of_block.agg(F.sum("n"), F.sum("terms")).first()
        return n or 0, terms or 0


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index every document into a new folder. One pass over the texts, without a shuffle."""
    key = docs.schema[id_col].dataType.simpleString()
    schema = f"block long, term string, docs array<int>, times array<int>, ids array<{key}>"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    rows = docs.select(F.col(id_col), F.col(text_col))
    rows.mapInArrow(_pack(arrow.field("ids").type.value_type, arrow), schema).write.parquet(path)
    return Index(docs.sparkSession.read.schema(schema).parquet(path))


# --- the search


@total_ordering
class _Later:
    """An id, ordered from the last to the first; null is the first of ids."""

    __slots__ = ("key",)

    def __init__(self, key):
        self.key = key

    def __eq__(self, other):
        return self.key == other.key

    def __lt__(self, other):
        if other.key is None:
            return self.key is not None
        return self.key is not None and other.key < self.key


class Best:
    """The k best (score, id) so far."""

    def __init__(self, k: int):
        self.k, self.heap = k, []
        #: The score that a document must reach.
        self.least = 1

    def add(self, score: int, key) -> None:
        entry = (score, _Later(key))
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)
        if len(self.heap) == self.k:
            self.least = max(1, self.heap[0][0])


class BlockLists:
    """The lists of one block that some query needs, with scores in place of times."""

    def __init__(self, ids: list, lengths: np.ndarray, documents: int, terms: int):
        self.ids = ids
        n = lengths.astype(np.int64)
        self.per_doc = LENGTH * (BASE + SHARE * n * documents // max(1, terms))
        self.lists: dict[str, tuple] = {}

    def add(self, term: str, docs: np.ndarray, times: np.ndarray, weight: int) -> None:
        if weight > 0:  # the others add nothing to any score
            t = times.astype(np.int64)
            scores = weight * (SCALE * t // (1000 * t + self.per_doc[docs]))
            if len(docs) > SHORT * len(self.ids):
                # A list walked by document ends with one behind all others.
                walked = [*docs.tolist(), len(self.ids)], [*scores.tolist(), 0]
                self.lists[term] = walked, int(scores.max())
            else:
                self.lists[term] = docs, scores

    def search(self, query: dict[str, int], best: Best) -> int:
        """Add the block's best documents for the terms (and their times); how many were candidates."""
        lists, sums = [], None
        for term, times in query.items():
            found = self.lists.get(term)
            if found is None:
                continue
            if isinstance(found[0], tuple):
                (docs, scores), bound = found
                lists.append((bound * times, docs, scores, times))
            else:
                if sums is None:
                    sums = np.zeros(len(self.ids), np.int64)
                sums[found[0]] += found[1] * times
        if sums is not None:
            docs = np.flatnonzero(sums)
            if len(docs):
                scores = sums[docs]
                walked = [*docs.tolist(), len(self.ids)], [*scores.tolist(), 0]
                lists.append((int(scores.max()), *walked, 1))
        return walk(lists, self.ids, best)


def walk(lists: list[tuple[int, list[int], list[int], int]], ids: list, best: Best) -> int:
    """Add the best documents of lists of (bound, documents, scores, times), document at a time.

    Every list of documents ends with len(ids). Gives how many candidates were scored.
    """
    lists = sorted(lists, key=lambda x: x[0])
    upto = list(accumulate(bound for bound, *_ in lists))
    n, end, scored = len(lists), len(ids), 0
    at = [0] * n
    least = best.least
    essential = bisect_left(upto, least)
    while essential < n:
        # The next document that an essential list names.
        if essential == n - 1:
            _, docs, scores, times = lists[essential]
            below = upto[essential - 1] if essential else 0
            place, need = at[essential], -(-(least - below) // times)
            while scores[place] < need and docs[place] < end:
                place += 1
            doc, at[essential] = docs[place], place + 1
            score = scores[place] * times
        else:
            doc = min(lists[i][1][at[i]] for i in range(essential, n))
            score = 0
            for i in range(essential, n):
                _, docs, scores, times = lists[i]
                if docs[at[i]] == doc:
                    score += scores[at[i]] * times
                    at[i] += doc < end
        if doc == end:
            break
        scored += 1
        for i in range(essential - 1, -1, -1):
            if score + upto[i] < least:
                break
            _, docs, scores, times = lists[i]
            place = at[i] = bisect_left(docs, doc, at[i])
            if docs[place] == doc:
                score += scores[place] * times
        else:
            if score >= least:
                best.add(score, ids[doc])
                if best.least > least:
                    least = best.least
                    essential = bisect_left(upto, least)
    return scored


def _searched(queries: list[tuple[str, dict[str, int]]], documents: int, terms: int, k: int, schema: pa.Schema):
    """Rows of blocks in order, each block's row without a term first, to the best of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        block = None

        def search() -> None:
            for (_, query), b in zip(queries, best):
                block.search(query, b)

        for batch in batches:
            term, weight = batch.column("term").to_pylist(), batch.column("weight").to_pylist()
            docs, times, ids = (batch.column(c) for c in ("docs", "times", "ids"))
            for i in range(batch.num_rows):
                numbers = times[i].values.to_numpy()
                if term[i] is not None:
                    block.add(term[i], docs[i].values.to_numpy(), numbers, weight[i])
                    continue
                if block is not None:
                    search()
                block = BlockLists(ids[i].as_py(), numbers, documents, terms)
        if block is not None:
            search()
        found = [(key, late.key, score) for (key, _), b in zip(queries, best) for score, late in b.heap]
        columns = [pa.array([row[i] for row in found], f.type) for i, f in enumerate(schema)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def search(
    index: Index, queries: DataFrame, query_id: str = "item_id", text_col: str = "text", k: int = BEST,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of every query."""
    spark = queries.sparkSession
    key_type = index.rows.schema["ids"].dataType.elementType.simpleString()
    schema = f"query string, doc_id {key_type}, score long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    documents, total = index.statistics()
    terms = F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(TERM), 0)
    asked = queries.select(F.col(query_id).alias("item_id"), F.array_join(terms, " ").alias("terms"))
    asked = staged(asked.where("terms <> ''").withColumn("query", F.sha2("terms", 256)), "queries")
    distinct = asked.dropDuplicates(["query"]).select("query", "terms")
    size = distinct.agg(F.sum(F.octet_length("terms"))).first()[0] or 0
    chunks = -(-size // query_bytes)
    folder = new_folder(spark, "found")
    for chunk in range(chunks):
        part = distinct.where(F.pmod(F.xxhash64("query"), F.lit(chunks)) == chunk)
        held = [(r["query"], dict(Counter(r["terms"].split(" ")))) for r in part.collect()]
        # A row for each term of the chunk, so never larger than the chunk.
        wanted = part.select(F.explode(F.split("terms", " ")).alias("term")).distinct()
        df = index.rows.where("term IS NOT NULL").select("term", F.size("docs").alias("df"))
        df = df.join(F.broadcast(wanted), "term").groupBy("term").agg(F.sum("df").alias("df"))
        weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2 * F.col("df") + 1)))
        weights = staged(df.select("term", weight.cast("long").alias("weight")), "weights")
        rows = index.rows.join(F.broadcast(weights), "term", "left").where("term IS NULL OR weight IS NOT NULL")
        rows = rows.repartition("block").sortWithinPartitions("block", F.col("term").asc_nulls_first())
        found = rows.mapInArrow(_searched(held, documents, total, k, arrow), schema)
        found.write.mode("append").parquet(folder)
    if not chunks:
        spark.createDataFrame([], schema).write.parquet(folder)
    found = spark.read.schema(schema).parquet(folder)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return asked.select("item_id", "query").join(found, "query").select("item_id", "rank", "doc_id", "score")
