"""License scan: an exact set-similarity join of text blocks with license templates.

A template is a set of words. It is found where a window of the text's words, whatever the line
breaks in it, has at least the share ``threshold`` of them; a window has up to SPREAD times as many
words as the template, so words that are scattered over a long line are no notice, and one that
names two licenses is. Words that tell licenses apart must be in the window: those of the template that are in its label (name
and version) or in NAMES. Where all that one template matches belongs to a match of another label that has
more, only the larger is given. ``TEMPLATES`` has the licenses that are wanted, ``OTHERS`` those that would be taken for them.

What is given of a window are the smallest blocks of lines around it, with their share: a line, or up to WRAPPED
lines in a row for templates of LONG words and more. A window that no such block holds is a block of
its own lines. The join is filtered, without losing a pair; texts and blocks go the same way:

* words are ordered by the number of blocks that have them in the whole corpus, rarest first;
* prefix: of a template of n words of which k must be in the block, one of the rarest
  n - k + 1 must be; only these are indexed;
* length: a block needs k of the templates' words;
* position: with the first common word at places i and j of the two ordered sets, no
  more than 1 + min(words behind i, words behind j) can be common.

What is left is verified by counting. The first pass counts words by block with partial sums,
the second finds blocks. Templates go to the tasks in chunks of a bounded size, and only their
own words are counted, so nothing that is sent or collected grows with the documents.

Besides, fixed phrases are found at every place where their words stand in a row, over the
whole text. Words are those of ``plain_words``. A null text has none; a template without
words is found nowhere, and an empty table stays empty; texts of any length are looked through whole. Of
equally good blocks the first is given. Rows stand for themselves, repeated or not. Columns of the input
with the names of new ones are replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate
from math import ceil, inf

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstats.llm.common import append, chunks, plain_words, set_apart

#: Fixed phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Sentences of public license texts and usual notices, with their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)
#: Notices that share most words with those above.
OTHERS = (
    ("bsd", "Released under the BSD License."),
    ("mpl-2", "Licensed under the Mozilla Public License, Version 2.0."),
    ("epl-2", "Licensed under the Eclipse Public License, Version 2.0."),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-2", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2"),
    ("lgpl-2", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl-3", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl-3", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("agpl-3", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
)
#: Words that a template's match must have, besides those of its label.
NAMES = frozenset(b"gnu lesser affero mozilla eclipse creative attribution sharealike noderivatives noncommercial".split())
THRESHOLD = 0.8
WRAPPED, LONG = 4, 10
SPREAD = 2
CHUNK = 4_000_000
FOUND = "array<struct<label:string,line:int,lines:int,score:double>>"


class TemplateIndex:
    """The prefixes of one chunk of templates under the global order of words."""

    def __init__(self, templates: list[tuple[str, str]], counts: dict[bytes, int], threshold: float):
        words = {w for _, text in templates for w in plain_words(text)}
        ordered = sorted(words, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(ordered)}
        self.templates, self.prefix = [], {}
        #: By template: the words that a match must have, and the most words of a window.
        self.telling, self.window = [], []
        #: The fewest common words that any template needs, and any of LONG words and more.
        self.least, self.least_long = inf, inf
        for label, text in templates:
            ranks = sorted({self.rank[w] for w in plain_words(text)})
            if ranks:
                need = max(1, ceil(threshold * len(ranks) - 1e-9))
                self.least = min(need, self.least)
                if len(ranks) >= LONG:
                    self.least_long = min(need, self.least_long)
                for i, r in enumerate(ranks[: len(ranks) - need + 1]):
                    self.prefix.setdefault(r, []).append((len(self.templates), i))
                self.templates.append((label, frozenset(ranks), need))
                own = plain_words(text)
                telling = NAMES.union(plain_words(label)).intersection(own)
                self.telling.append(frozenset(self.rank[w] for w in telling))
                self.window.append(SPREAD * len(own))
        self.vocabulary = self.rank.keys()

    def find(self, have: set[int], shortest: int = 1) -> dict[int, float]:
        """Share of every template of ``shortest`` words and more that a block has enough of.

        A block is given as the ranks of its words that templates have.
        """
        if len(have) < (self.least if shortest < LONG else self.least_long):
            return {}
        ranks = sorted(have)
        met: dict[int, bool] = {}
        for j, r in enumerate(ranks):
            for t, i in self.prefix.get(r, ()):
                if t not in met:  # the first common word decides the bound
                    _, template, need = self.templates[t]
                    possible = len(ranks) >= need <= min(len(template) - i, len(ranks) - j)
                    met[t] = possible and len(template) >= shortest
        found = {}
        for t, possible in met.items():
            if possible:
                _, template, need = self.templates[t]
                if (n := len(template & have)) >= need:
                    found[t] = n / len(template)
        return found

    def _windows_of(self, t: int, places: list[int], ranks: list[int]) -> list[tuple[int, int, int, frozenset]]:
        """The best windows of a template that do not overlap: first and last word, how
        many of the template's words, and where these are."""
        _, template, need = self.templates[t]
        own = [(p, r) for p, r in zip(places, ranks) if r in template]
        found, n, end = [], {}, 0
        for k, (start, first) in enumerate(own):
            while end < len(own) and own[end][0] < start + self.window[t]:
                n[own[end][1]] = n.get(own[end][1], 0) + 1
                end += 1
            if len(n) >= need and self.telling[t] <= n.keys():
                at: dict[int, int] = {}
                for p, r in own[k:end]:
                    at.setdefault(r, p)
                found.append((start, max(at.values()), len(at), frozenset(at.values())))
            n[first] -= 1
            if not n[first]:
                del n[first]
        best, taken = [], set()
        for w in sorted(found, key=lambda w: (-w[2], w[1] - w[0], w[0])):
            if taken.isdisjoint(range(w[0], w[1] + 1)):
                best.append(w)
                taken.update(range(w[0], w[1] + 1))
        return best

    def windows(self, words: list[bytes]) -> dict[int, list[tuple[int, int, int, frozenset]]]:
        """The windows of every template that the text has, without those that are part of
        a match of another label."""
        rank = self.rank
        possible = self.find({rank[w] for w in self.vocabulary & set(words)})
        if not possible:
            return {}
        places = [p for p, w in enumerate(words) if w in rank]
        ranks = [rank[words[p]] for p in places]
        found = {t: some for t in possible if (some := self._windows_of(t, places, ranks))}
        at: dict[int, list[tuple[str, frozenset]]] = {}
        for t, some in found.items():
            for w in some:
                for p in w[3]:
                    at.setdefault(p, []).append((self.templates[t][0], w[3]))
        for t, some in found.items():
            label = self.templates[t][0]
            found[t] = [w for w in some if not any(x != label and w[3] < more for x, more in at[w[0]])]
        return {t: some for t, some in found.items() if some}

    def blocks(self, text: str | None) -> list[dict]:
        """What is found, with the first line and the number of lines."""
        rows = [plain_words(x) for x in (text or "").split("\n")]
        windows = self.windows([w for row in rows for w in row])
        if not windows:
            return []
        begins = [0, *accumulate(map(len, rows))]
        rank, vocabulary = self.rank, self.vocabulary
        lines = [{rank[w] for w in vocabulary & set(row)} for row in rows]
        out, shown = [], set()

        def give(i: int, n: int, found: dict[int, float]) -> None:
            for t, share in found.items():
                inside = [w for w in windows.get(t, ()) if w[0] < begins[i + n] and begins[i] <= w[1]]
                if inside:
                    out.append({"label": self.templates[t][0], "line": i, "lines": n, "score": share})
                    shown.update((t, w[0]) for w in inside)

        joined, held = lines, []
        for i, have in enumerate(lines):
            found = self.find(have)
            give(i, 1, found)
            held.append({t for t in found if len(self.templates[t][1]) >= LONG})
        for n in range(2, WRAPPED + 1):
            joined = [a | b for a, b in zip(joined, lines[n - 1 :])]
            held = [a | b for a, b in zip(held, held[1:])]
            for i, have in enumerate(joined):
                found = {t: share for t, share in self.find(have, LONG).items() if t not in held[i]}
                give(i, n, found)
                held[i] |= found.keys()
        for t, some in windows.items():
            label, template, _ = self.templates[t]
            for first, last, n, _ in some:
                if (t, first) not in shown:
                    i, j = bisect_right(begins, first) - 1, bisect_right(begins, last) - 1
                    out.append({"label": label, "line": i, "lines": j - i + 1, "score": n / len(template)})
        return out


def block_counts(docs: DataFrame, words: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """In how many blocks each of these words is."""
    wanted = docs.sparkSession.sparkContext.broadcast(frozenset(words))

    def work(texts):
        out = []
        for text in texts:
            n: dict[bytes, int] = {}
            for line in (text or "").split("\n"):
                for w in wanted.value.intersection(plain_words(line)):
                    n[w] = n.get(w, 0) + 1
            out.append([{"word": w, "n": k} for w, k in n.items()])
        return [out]

    some = docs.select(F.col(text_col).alias("_text"))
    each = append(some, ["_text"], "_n array<struct<word:binary,n:int>>", work).select(F.inline("_n"))
    rows = each.groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row per given word at most
    return {bytes(r["word"]): r["n"] for r in rows}


def find_phrases(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(index of the first word, label) of every place of every phrase."""
    line, found = b" " + b" ".join(words) + b" ", []
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at, word, counted = line.find(wanted), 0, 0
        while at >= 0:
            word, counted = word + line.count(b" ", counted, at), at
            found.append((word, label))
            at = line.find(wanted, at + 1)
    return sorted(found)


def _words_and_phrases(text: str | None, phrases: dict[str, str]) -> tuple[int, list[dict]]:
    words = plain_words(text)
    return len(words), [{"word": i, "label": s} for i, s in find_phrases(words, phrases)]


def scan(
    docs: DataFrame,
    templates: DataFrame,
    text_col: str = "text",
    threshold: float = THRESHOLD,
    phrases: dict[str, str] | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """The documents with n_words, phrases (word, label) and blocks (label, first line, number of lines, score).

    ``templates`` has columns label and text.
    """
    phrases = PHRASES if phrases is None else phrases

    def base(texts):
        return list(zip(*(_words_and_phrases(t, phrases) for t in texts))) or [[], []]

    plain, (text,), back = set_apart(docs, text_col)
    held, parts = append(plain, [text], "n_words long, phrases array<struct<word:long,label:string>>", base), []
    for k, rows in enumerate(chunks(templates.select("label", "text"), "text", chunk)):
        pairs = [(r["label"], r["text"] or "") for r in rows]
        counts = block_counts(plain, {w for _, t in pairs for w in plain_words(t)}, text)
        index = docs.sparkSession.sparkContext.broadcast((pairs, counts))
        parts.append(f"_blocks{k}")
        held = append(held, [text], f"{parts[-1]} {FOUND}", _Search(index, threshold))
    joined = F.concat(*parts) if len(parts) > 1 else F.col(parts[0])
    return back(held.withColumn("blocks", joined), "n_words", "phrases", "blocks")


class _Search:
    """Looks through texts for one chunk; the index is made once in each task."""

    def __init__(self, given, threshold: float):
        self.given, self.threshold, self.index = given, threshold, None

    def __getstate__(self):
        return {"given": self.given, "threshold": self.threshold, "index": None}

    def __call__(self, texts):
        if self.index is None:
            self.index = TemplateIndex(*self.given.value, self.threshold)
        return [list(map(self.index.blocks, texts))]
