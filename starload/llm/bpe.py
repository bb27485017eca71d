"""Token counts by byte-pair merging with a heap and a linked list.

A piece's symbols form a linked list; the heap holds the adjacent pairs that may merge.  The pair of lowest rank (leftmost
first) is popped and merged until none is left, so a piece of n symbols takes O(n log n) whatever its length, and its
number of tokens is n minus the merges made.  No token ids are made.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import ready, text_bytes

#: The pattern that splits text into pieces before merging; fixed by the vocabulary (byte-level BPE).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space followed by a space: only then do the pieces around a space depend on more than the space.
_LOOSE = re.compile(r"\s ")


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 characters stand
    for themselves, the others for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def merged_length(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many symbols are left when pairs are merged in the order of their ranks."""
    n = len(symbols)
    if n < 2:
        return n
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    if not heap:
        return n
    heapify(heap)
    symbols, after, before, merges = symbols.copy(), list(range(1, n + 1)), list(range(-1, n - 1)), 0
    while heap:
        _, i, left, right = heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # one of the two has been merged meanwhile
        symbols[i], symbols[j], after[i] = (both := left + right), None, (k := after[j])
        merges += 1
        if k < n:
            before[k] = i
            if (r := ranks.get((both, symbols[k]))) is not None:
                heappush(heap, (r, i, both, symbols[k]))
        if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], both))) is not None:
            heappush(heap, (r, h, symbols[h], both))
    return n - merges


class Counter:
    """Counts tokens as the tokenizer file says.  Counts of short stretches are remembered in two generations of bounded
    size: what is used moves to the newer one, the older one is given up when the newer is full."""

    def __init__(self, path: str, limit: int = 250_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): r for r, m in enumerate(spec["model"]["merges"])}
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pieces = regex.compile(PATTERN)
        self.symbols = {b: s for b, s in byte_symbols().items()}
        self.new, self.old, self.limit = {}, {}, limit

    def stretch(self, text: str) -> int:
        """Tokens of a stretch of text without special strings."""
        ranks, symbols = self.ranks, self.symbols
        return sum(merged_length(list(p.encode().decode("latin-1").translate(symbols)), ranks) for p in self.pieces.findall(text))

    def _miss(self, key: str) -> int:
        n = self.old.get(key)
        if n is None:
            n = self.stretch(" " + key)
        if len(key) <= 48:
            if len(self.new) >= self.limit:
                self.old, self.new = self.new, {}
            self.new[key] = n
        return n

    def plain(self, text: str) -> int:
        if _LOOSE.search(text):
            return self.stretch(text)
        head, *rest = text.split(" ")  # a piece can then only begin, never continue, at a space
        known = list(map(self.new.get, rest))
        if None in known:
            miss = self._miss
            known = [miss(k) if n is None else n for k, n in zip(rest, known, strict=True)]
        return self.stretch(head) + sum(known)

    def count(self, text: str) -> int:
        """Tokens of a text; each special string in it is one token."""
        if self.special is None or not (found := self.special.findall(text)):
            return self.plain(text)
        return len(found) + sum(map(self.plain, self.special.split(text)))


@cache
def counter(path: str) -> Counter:
    """One for each worker process."""
    return Counter(path)


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(1)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            counts = pa.array([own.count(t.decode("utf-8", "replace")) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, counts], names=["id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row of ``docs``; ``tokenizer`` is the path of a byte-level BPE file
    (tokenizers' JSON format) that every worker can open.

    Null and empty texts have 0 bytes and 0 tokens.  Texts are counted whole, whatever their length; repeated rows give
    repeated results; ids may be null; other columns are not looked at.  There is no shuffle.
    """
    ready(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))
    out = src.mapInArrow(_counts(tokenizer), "id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
