"""Token counts by byte-pair merging, without making token ids.

A piece's symbols form a linked list, and its adjacent pairs that have a merge rank a
heap. The pair of lowest rank is popped and merged until none is left: the piece then has
as many tokens as it had symbols, less the merges. Texts are cut at white space, which no
token spans, and the count of a stretch is remembered in a bounded table per worker.

A null text counts as empty: no tokens, no bytes; an empty table stays empty. Texts of any length are counted whole;
rows are independent of each other, and columns with the names of new ones are replaced.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from barstats.llm.common import Memo, append

#: White space as the tokenizer's patterns have it. str.split() also cuts at four separators.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_STRETCH = regex.compile(f"[^{SPACES}]+")
_SEPARATORS = regex.compile("[\x1c-\x1f]")
#: Beyond these characters tables of letters and cases change with the Unicode version, and the
#: library's own are asked.
ODD = re.compile("[^\x00-\u024f]")
LIMIT = 2048


def byte_symbols() -> list[str]:
    """A printable character for each byte: itself where it is one, else from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class PieceCounter:
    """Counts the tokens of texts as one tokenizer file describes them.

    For files of a byte-level BPE with word ends, whose normaliser composes, unifies white
    space and lower-cases, and whose pieces are found by one pattern; others are refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, pre = data["model"], data["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in data["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pre] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: not a tokenizer this counter knows")
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.end = model["end_of_word_suffix"] or ""
        self.symbols = byte_symbols()
        missing = [s for s in self.symbols if s not in model["vocab"] or s + self.end not in model["vocab"]]
        if missing:
            raise ValueError(f"{path}: bytes without a symbol")
        self.piece = regex.compile(pre[0]["pattern"]["Regex"])
        self.library = Tokenizer.from_file(path)
        special = [regex.escape(t["content"]) for t in data["added_tokens"]]
        self.special = regex.compile("|".join(sorted(special, key=len, reverse=True)) or r"(?!)")
        self.memo = Memo(self._stretch)

    def _stretch(self, stretch: str) -> int:
        if ODD.search(stretch):
            pieces = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(stretch)]
        else:
            found = self.piece.findall(stretch)
            pieces = [[self.symbols[b] for b in p.encode()] for p in found]
        return sum(map(self.merged, pieces))

    def merged(self, symbols: Iterable[str]) -> int:
        """Initial symbols minus merges."""
        sym: list = list(symbols)
        sym[-1] += self.end
        n, rank = len(sym), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i) for i, p in enumerate(zip(sym, sym[1:])) if p in rank]
        heapq.heapify(heap)
        merges = 0
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if sym[i] is None or j == n or rank.get((sym[i], sym[j])) != r:
                continue  # one of the two has been merged since
            sym[i] += sym[j]
            sym[j] = None
            after[i] = k = after[j]
            merges += 1
            if k < n:
                before[k] = i
                if (q := rank.get((sym[i], sym[k]))) is not None:
                    heapq.heappush(heap, (q, i))
            if (h := before[i]) >= 0 and (q := rank.get((sym[h], sym[i]))) is not None:
                heapq.heappush(heap, (q, h))
        return n - merges

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if "<" in text and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.count, parts))
        # Without odd characters nothing is left to compose.
        text = self.library.normalizer.normalize_str(text) if ODD.search(text) else text.lower()
        stretches = _STRETCH.findall(text) if _SEPARATORS.search(text) else text.split()
        return sum(map(self.memo.__getitem__, stretches))


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    """One counter for each file and worker."""
    return PieceCounter(path)


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """The documents with n_bytes (UTF-8), n_tokens and over_limit.

    ``path`` is the tokenizer's file, which every worker must be able to open.
    """

    def work(texts):
        tokens = list(map(counter(path).count, texts))
        n_bytes = [len(t.encode()) if t else 0 for t in texts]
        return n_bytes, tokens, [n > limit for n in tokens]

    return append(docs, [text_col], "n_bytes long, n_tokens long, over_limit boolean", work)
