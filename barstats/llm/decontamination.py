"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words: words at its ones are hashed together, words
at its zeros are ignored, so a substituted word only spoils the seeds that look at it.
Hashes of every place of the documents meet those of the benchmark. Hits of an item at nearby
offsets are one place, where the document and the whole item are aligned: the most words in
order, each within BAND of the offset of a hit, so that substituted, left out and added words only cost
themselves. An alignment with 0.7 of the item's words counts whole, of another the runs in which at least
half of the words match. Runs of all places of one item together tell how much of the item a document holds.

The benchmark is sent to the tasks in chunks of at most CHUNK bytes of text each (in
expectation: rows are dealt by hash), and documents pass by every chunk; a small benchmark
is one chunk. Documents are read once, nothing of them is shuffled or collected, and there
are no sizes at which anything is left out.

Words are runs of letters and digits with A-Z in lower case, so punctuation does not
matter. A leak has 0.8 of an item's words, or ten and half of them if it is longer than twelve.
Items of up to SHORT words have seeds for all choices of so many of their words, and for all words
but one that is left out. Of fewer than five words all must match. An item without words, or with a null
text, is in no document. A null document text has no words; texts of any length are looked through whole.
Equal items, and repeated documents, each count as themselves; of places that hold equally much of an
item the first is reported. An empty benchmark leaves every document without overlaps, and an
empty table stays empty. Columns of the input with the names of new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstats.llm.common import append, chunks, plain_words, set_apart

MASKS = ("111011", "1101101", "10110011")
#: What a word of the item that does not match costs a run, in words that do.
MISMATCH = 1
#: A run counts from this many words on (or the whole item, if it is shorter).
LEAST_RUN = 5
#: By how many words an alignment may leave the offsets of its hits; by one for items of up to SHORT.
BAND = 3
WIDE = 64
#: A document leaks an item of which it has this share of words, and this many if so long.
LEAK_SHARE, LEAK_WORDS = 0.5, 10
#: Items of up to so many words are found by LEAST_SHARE of them.
SHORT, LEAST_SHARE = 12, 0.8
#: An alignment with this share of an item's words needs no runs.
WHOLE_SHARE = 0.7
CHUNK = 16_000_000

OVERLAPS = "array<struct<item_id:{key},start:int,words:int,matches:int,share:double,leaked:boolean>>"


def needed(n: int) -> int:
    """The words of an item of n that a leak has at least."""
    return min(LEAK_WORDS, ceil(LEAST_SHARE * n - 1e-9)) if n > 4 else n


class Seeds:
    """The seeds of one chunk of the benchmark, and the check of their hits."""

    def __init__(self, items: list[tuple[object, str | None]], masks: tuple[str, ...] = MASKS):
        self.masks = [np.flatnonzero(np.frombuffer(m.encode(), np.uint8) == ord("1")) for m in masks]
        shortest = min(map(len, masks))
        self.ids, self.words, self.word_id = [], [], {}
        known: dict[bytes, int] = {}
        for key, text in items:
            words = plain_words(text)
            if words:
                # Items of the same words are looked for once.
                i = known.setdefault(b" ".join(words), len(known))
                if i == len(self.ids):
                    number = [self.word_id.setdefault(w, len(self.word_id) + 1) for w in words]
                    self.words.append(np.array(number, np.int64))
                    self.ids.append([])
                self.ids[i].append(key)
        short = sorted({len(w) for w in self.words if len(w) <= SHORT})
        self.tables = [(m, self._table(m, lambda w: len(w) >= shortest)) for m in self.masks]
        #: And for each length up to SHORT, used by items of that length, a mask for all the
        #: choices of words that are enough; it begins at the first of them.
        for n in short:
            for some in combinations(range(n), needed(n)):
                mask = np.array(some) - some[0]
                self.tables.append((mask, self._table(mask, lambda w, n=n: len(w) == n, some[0])))
            if needed(n) < n:  # and one for all its words but one that the document leaves out
                self.tables.append((np.arange(n - 1), self._table_without_one(n)))

    @staticmethod
    def _hash(words: np.ndarray, mask: np.ndarray, places: np.ndarray) -> np.ndarray:
        h = np.zeros(len(places), np.uint64)
        for k in mask.tolist():
            h = (h ^ words[places + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def _table(self, mask: np.ndarray, wanted, place: int | None = None) -> tuple[np.ndarray, ...]:
        """Sorted hashes with their item and place: every place, or the one that is given."""
        found = []
        for i, words in enumerate(self.words):
            n = len(words) - int(mask[-1])
            if wanted(words) and n > 0:
                at = np.arange(n) if place is None else np.array([place])
                found.append(np.stack([self._hash(words, mask, at).view(np.int64), np.full(len(at), i), at]))
        rows = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        h = rows[0].view(np.uint64)
        order = np.argsort(h, kind="stable")
        return h[order], rows[1][order], rows[2][order]

    def _table_without_one(self, n: int) -> tuple[np.ndarray, ...]:
        """Sorted hashes of the items of n words, each without one of its words."""
        every, first = np.arange(n - 1), np.array([0])
        found = [
            (int(self._hash(np.delete(words, gone), every, first)[0]), i)
            for i, words in enumerate(self.words)
            if len(words) == n
            for gone in range(n)
        ]
        h = np.array([x[0] for x in found], np.uint64)
        order = np.argsort(h, kind="stable")
        item = np.array([x[1] for x in found], np.int64)
        return h[order], item[order], np.zeros(len(found), np.int64)

    def hits(self, words: np.ndarray) -> np.ndarray:
        """Distinct (item, offset of the item in the document)."""
        found = []
        for mask, (hashes, item, place) in self.tables:
            n = len(words) - int(mask[-1])
            if n <= 0 or not len(hashes):
                continue
            ok = words[mask[0] : mask[0] + n] > 0
            for k in mask[1:].tolist():
                ok &= words[k : k + n] > 0
            at = np.flatnonzero(ok)
            h = self._hash(words, mask, at)
            first = np.searchsorted(hashes, h)
            last = np.searchsorted(hashes, h, "right")
            many = last - first
            some = many > 0
            if some.any():
                at, first, many = at[some], first[some], many[some]
                row = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                found.append(np.stack([item[row], np.repeat(at, many) - place[row]], 1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def overlaps(self, text: str | None) -> list[dict]:
        """What the text holds of each item: its runs over all places."""
        words = plain_words(text)
        numbers = np.fromiter((self.word_id.get(w, 0) for w in words), np.int64, len(words))
        runs: dict[int, list[tuple[int, int, int, np.ndarray]]] = {}
        for i, first, last in places(self.hits(numbers)):
            item = self.words[i]
            band = 1 if len(item) <= SHORT else BAND
            lo, hi = first - band, last + band
            near = numbers[max(0, lo) : max(0, len(item) + hi)]
            # No alignment has more than the item's words that are there at all.
            if np.isin(item, near).sum() < min(LEAST_RUN, needed(len(item))):
                continue
            at = aligned(item, numbers, lo, hi)
            taken = np.flatnonzero(at >= 0)
            if len(taken) >= max(needed(len(item)), WHOLE_SHARE * len(item)):
                spans = [(int(taken[0]), int(taken[-1]) + 1)]
            else:
                spans = good_runs(at >= 0, min(LEAST_RUN, needed(len(item))))
            for a, b in spans:
                matched = a + np.flatnonzero(at[a:b] >= 0)
                start = int(at[matched[0]])
                runs.setdefault(i, []).append((start, int(at[matched[-1]]) + 1 - start, matched))
        out = []
        for i, found in sorted(runs.items()):
            n = len(self.words[i])
            matches = len(np.unique(np.concatenate([m for _, _, m in found])))
            start, length, _ = max(found, key=lambda r: (len(r[2]), -r[0]))
            share = matches / n
            what = {
                "start": start,
                "words": length,
                "matches": matches,
                "share": share,
                "leaked": share >= LEAK_SHARE and matches >= needed(n),
            }
            out += [{"item_id": key, **what} for key in self.ids[i]]
        return out


def places(hits: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Item, first and last offset of its hits (sorted) that are no more than a band apart; of
    repeated words, whose hits go on and on, WIDE offsets at a time."""
    if len(hits):
        cut = (np.diff(hits[:, 0]) != 0) | (np.diff(hits[:, 1]) > BAND)
        starts = np.r_[0, np.flatnonzero(cut) + 1]
        ends = np.r_[starts[1:], len(hits)] - 1
        for i, first, last in zip(hits[starts, 0].tolist(), hits[starts, 1].tolist(), hits[ends, 1].tolist()):
            for lo in range(first, last + 1, WIDE):
                yield i, lo, min(last, lo + WIDE - 1)


def aligned(item: np.ndarray, words: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Where each word of the item stands in the document, or -1: as many as can be in order, at
    offsets from lo to hi."""
    n, width = len(item), hi - lo + 1
    # best[i][d] is the most matches of item[i:] at offsets from lo + d on, ahead of all that is used.
    best = [[0] * (width + 2) for _ in range(n + 1)]
    known = len(words)
    same = [
        [0 <= i + o < known and words[i + o] == item[i] for o in range(lo, hi + 1)] for i in range(n)
    ]
    for i in range(n - 1, -1, -1):
        row, after, match = best[i], best[i + 1], same[i]
        for d in range(width - 1, -1, -1):
            # Leave out the document's word, the item's word, or take both.
            most = row[d + 1]
            if d and after[d - 1] > most:
                most = after[d - 1]
            elif not d and after[0] > most:
                most = after[0]
            if match[d] and after[d] + 1 > most:
                most = after[d] + 1
            row[d] = most
    at, i, d = np.full(n, -1), 0, 0
    while i < n and d < width:
        if same[i][d] and best[i][d] == best[i + 1][d] + 1:
            at[i] = i + lo + d
            i += 1
        elif best[i][d] == best[i][d + 1]:
            d += 1
        else:
            i, d = i + 1, max(0, d - 1)
    return at


def good_runs(same: np.ndarray, least: int) -> list[tuple[int, int]]:
    """The best run, and those of the parts on both sides of it, of at least so many words."""
    found, parts = [], [(0, len(same))]
    while parts:
        lo, hi = parts.pop()
        if hi - lo >= least:
            a, b = best_run(same[lo:hi])
            if b - a >= least:
                found.append((lo + a, lo + b))
                parts += [(lo, lo + a), (lo + b, hi)]
    return found


def best_run(same: np.ndarray) -> tuple[int, int]:
    """The run of greatest score: where the running sum rises most above an earlier one."""
    total = np.r_[0, np.cumsum(np.where(same, 1, -MISMATCH))]
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.flatnonzero(total[: end + 1] == low[end])[-1])
    return start, end


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    chunk: int = CHUNK,
) -> DataFrame:
    """The documents with ``overlaps``: for each item of which they hold a run its id, the
    first word and the length of the longest run, the item's words that are matched and
    their share, and whether that is a leak."""
    key = benchmark.schema[item_col].dataType.simpleString()
    held, (text,), back = set_apart(docs, text_col)
    parts = []
    items = benchmark.select(F.col(item_col).alias("key"), F.col(item_text_col).alias("item"))
    for i, rows in enumerate(chunks(items, "item", chunk)):
        seeds = docs.sparkSession.sparkContext.broadcast([(r["key"], r["item"]) for r in rows])
        parts.append(f"_overlaps{i}")
        held = append(held, [text], f"{parts[-1]} {OVERLAPS.format(key=key)}", _Search(seeds))
    joined = F.concat(*parts) if len(parts) > 1 else F.col(parts[0])
    return back(held.withColumn("overlaps", joined), "overlaps")


class _Search:
    """Looks through texts for one chunk; the seeds are made once in each task."""

    def __init__(self, items):
        self.items, self.seeds = items, None

    def __getstate__(self):
        return {"items": self.items, "seeds": None}

    def __call__(self, texts):
        if self.seeds is None:
            self.seeds = Seeds(self.items.value)
        return [list(map(self.seeds.overlaps, texts))]


def judge(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The documents with ``overlaps`` and ``leaked``."""
    return find_overlaps(docs, benchmark, **names).withColumn("leaked", F.exists("overlaps", lambda o: o["leaked"]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The documents that leak no item, with their own columns."""
    held, (text,), back = set_apart(docs, names.pop("text_col", "text"))
    return back(judge(held, benchmark, text_col=text, **names).where("NOT leaked"))
