"""Secret scan: candidates in every text, judged by who has them across the corpus.

Candidates are found by pattern. Each value is hashed, and the hashes are counted by
distinct repository and by distinct owner. A value that several owners have is a copied
example (documentation, test fixtures); one that a single owner has, and that looks
random, is taken as live.

Null texts are empty, texts of any length are scanned whole, and an empty table gives none. A null
repository or owner counts as one of its own. Repeated rows are
scanned as rows of their own but count once per repository and owner. Values are known by
a 128-bit hash; the table of candidates holds no secret. A key block is known by what stands between its
first and its last line, however it is wrapped; one with nothing there is unclear. Candidates at one place
are in the order of their kinds. ``find_candidates`` replaces a column candidates.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstats.llm.common import append
from barstats.sources.scratch import staged

#: Fixed patterns of the base scan, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 and more starts where it is first possible
#: What the scan adds: tokens of well-known services, signed web tokens, key blocks.
KEYED = re.compile(
    r"gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{30,}"
    r"|sk-[A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"
    # A key block to its last line, or what can be of a key behind its first line.
    r"|-----BEGIN [A-Z ]*PRIVATE KEY-----(?:((?:[^-]|-(?!----))*)-----END [A-Z ]*PRIVATE KEY-----|([A-Za-z0-9+/=\s]*))"
)
#: The hash of a key block with nothing in it, which says nothing of who has it.
EMPTY = hashlib.blake2b(b"", digest_size=16).hexdigest()
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
KEY_MARKS = ("gh", "xox", "AIza", "sk-", "eyJ", "-----BEGIN ")
KINDS = ("assign", "access", "hex", "key")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
#: A value that this many owners have is an example; below the entropy it looks made up.
EXAMPLE_OWNERS = 3
LIVE_BITS = 2.5

SPAN = "array<struct<kind:string,start:int,end:int,hash:string,random:boolean>>"


def bits(value: str) -> float:
    """Shannon entropy of the characters, in bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def scan(text: str | None) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of all candidates, by start and then kind; code points."""
    if not text:
        return []
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LEAST:
                found.append(("assign", m.start(), m.end(), m[2]))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= ACCESS_LEAST:
                found.append(("access", m.start(), m.end(), m[0]))
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    if any(mark in text for mark in KEY_MARKS):
        found += [("key", m.start(), m.end(), _secret_of(m)) for m in KEYED.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _secret_of(m: re.Match) -> str:
    """What is secret of a key: of a block all between its first and last line, however it is wrapped."""
    body = m[0] if m[1] is None and m[2] is None else m[1] or m[2] or ""
    return "".join(body.split())


def find_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with an array of candidates in ``candidates``."""

    def spans(text):
        return [
            {
                "kind": kind,
                "start": start,
                "end": end,
                "hash": hashlib.blake2b(value.encode(), digest_size=16).hexdigest(),
                "random": bool(value) and bits(value) >= LIVE_BITS,
            }
            for kind, start, end, value in scan(text)
        ]

    return append(docs, [text_col], f"candidates {SPAN}", lambda texts: [list(map(spans, texts))])


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, repos, owners: in how many distinct repositories and owners a value occurs.

    ``candidates`` has columns hash, repo, owner. Distinct pairs are made first, with
    partial sums before each shuffle, so a value that a third of the rows have costs no
    more than its distinct pairs.
    """
    null = F.lit("\0")
    pairs = candidates.select(
        "hash",
        F.coalesce(F.col("repo").cast("string"), null).alias("repo"),
        F.coalesce(F.col("owner").cast("string"), null).alias("owner"),
    )
    owners = pairs.select("hash", "owner").distinct().groupBy("hash").agg(F.count("*").alias("owners"))
    repos = pairs.select("hash", "repo").distinct().groupBy("hash").agg(F.count("*").alias("repos"))
    return owners.join(repos, "hash")


def judge_candidates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "doc_id",
    owner_col: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """A row for each document: its id and its judged candidates, in order.

    ``candidates`` is an array of kind, start, end, hash, repos, owners and verdict:
    example (``example_owners`` and more have it), live (one owner has it and it looks
    random) or unclear. Texts are read once; what follows works on the small table of
    candidates, which is written to the shared folder.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(repo_col).cast("string").alias("repo"),
        F.col(owner_col).cast("string").alias("owner"),
        F.col(text_col).alias("_text"),
    )
    rows = staged(find_candidates(rows, "_text").drop("_text"), "candidates")
    each = rows.select("row", "repo", "owner", F.inline("candidates"))
    counts = staged(ownership(each), "ownership")
    verdict = (
        F.when(F.col("hash") == EMPTY, "unclear")
        .when(F.col("owners") >= example_owners, "example")
        .when((F.col("owners") == 1) & F.col("random"), "live")
        .otherwise("unclear")
    )
    judged = each.join(counts, "hash").withColumn("verdict", verdict)
    listed = judged.groupBy("row").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "start",
                    F.expr(f"array_position(array{KINDS}, kind)").alias("rank"),
                    "kind",
                    "end",
                    "hash",
                    "repos",
                    "owners",
                    "verdict",
                )
            )
        ).alias("candidates")
    )
    none = F.expr("filter(array(), x -> false)")
    return (
        rows.select("row", "doc_id")
        .join(listed, "row", "left")
        .select("doc_id", F.coalesce("candidates", none.cast(listed.schema["candidates"].dataType)).alias("candidates"))
    )
