"""Bounded-space online packing of tokenised documents into windows of a fixed length.

Every partition keeps a fixed number of open windows.  What does not fit into a window whole goes as full windows of its
own; the rest of a document goes to the open window that it fills best.  If it fits into none, the fullest window is
emitted: topped up with the head of the document if the gap is worth a cut, else as it is.  At the end of a partition
what its open windows hold is moved together, which leaves one unfinished window at most; the unfinished windows of all
partitions are merged in the same way, in rounds of bounded size.
"""

from __future__ import annotations

import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import materialize, ready, text_bytes, tidy

LENGTH, OPEN, MIN_CUT = 2048, 64, 32
#: Unfinished windows that one task of a merging round takes (each holds less than one window's ids).
FAN_IN = 1000
PIECES = "id long, start long, length long, ids_crc32 long, doc_tokens long, part long, window long, offset long, ids binary"


class Encoder:
    """Ids of texts by a tokenizers file, as packed little-endian 32-bit numbers."""

    def __init__(self, path: str, last_id: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.last = Tokenizer.from_file(path), np.array([last_id], "<u4")
        self.fast = _merge_table(self.tokenizer)
        self.special = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items()]

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s, _ in self.special):
            got = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            got = self.fast(text)
        out = np.empty(len(got) + 1, "<u4")
        out[:-1] = got
        out[-1] = self.last[0]
        return out


def _merge_table(tokenizer):
    """The same vocabulary as ranks, for a faster encoder; None if it is of another kind than byte-level BPE with ids in
    the order of merges, or if the two disagree on a sample of byte strings."""
    import tiktoken

    from starload.llm.bpe import PATTERN, byte_symbols

    back = {s: b for b, s in byte_symbols().items()}
    added = set(tokenizer.get_added_tokens_decoder())
    vocab = tokenizer.get_vocab(with_added_tokens=False)
    try:
        ranks = {bytes(back[c] for c in s): i for s, i in vocab.items() if i not in added}
    except KeyError:
        return None
    fast = tiktoken.Encoding("packed", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    tests = ["", " ", "It's  a test\n\n of 1234 things;\tdone. ", "Größe über élève ñandú 你好", *(f" {s}x{s}" for s in " ​\u0001#'")]
    return fast if all(fast(t) == tokenizer.encode(t, add_special_tokens=False).ids for t in tests) else None


@cache
def encoder(path: str, last_id: int) -> Encoder:
    """One for each worker process."""
    return Encoder(path, last_id)


class Packer:
    """The open windows of one partition.  A piece is (id, start, ids, doc_tokens); ``out`` gets (window, [pieces])."""

    def __init__(self, length: int, n_open: int, min_cut: int):
        self.length, self.n_open, self.min_cut = length, n_open, min_cut
        self.space: list[tuple[int, int]] = []  # (free, window), sorted
        self.held: dict[int, list] = {}
        self.next = 0
        self.out: list[tuple[int, list]] = []

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def document(self, id_, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while total - start >= self.length:
            self.out.append((self._new(), [(id_, start, ids[start : start + self.length], total)]))
            start += self.length
        if start < total:
            self.place((id_, start, ids[start:], total))

    def place(self, piece) -> None:
        id_, start, ids, total = piece
        at = bisect_left(self.space, (len(ids), -1))
        if at == len(self.space) and len(self.space) >= self.n_open:  # it fits into none: the fullest goes
            free, w = self.space.pop(0)
            if free >= self.min_cut:
                self.held[w].append((id_, start, ids[:free], total))
                start, ids = start + free, ids[free:]
            self.out.append((w, self.held.pop(w)))
            at = bisect_left(self.space, (len(ids), -1))
        if at < len(self.space):
            free, w = self.space.pop(at)
        else:
            free, w = self.length, self._new()
            self.held[w] = []
        self.held[w].append((id_, start, ids, total))
        if free > len(ids):
            insort(self.space, (free - len(ids), w))
        else:
            self.out.append((w, self.held.pop(w)))

    def finish(self) -> list | None:
        """Move together what the open windows hold: the emptiest are taken apart to fill up the fullest."""
        while len(self.space) > 1:
            (_, giver), (free, w) = self.space[-1], self.space[0]
            pieces = self.held[giver]
            id_, start, ids, total = pieces.pop()
            if len(ids) > free:
                cut = len(ids) - free
                pieces.append((id_, start, ids[:cut], total))
                start, ids = start + cut, ids[cut:]
            self.held[w].append((id_, start, ids, total))
            left = self.space.pop()[0] + len(ids)
            if pieces:
                insort(self.space, (left, giver))
            else:
                del self.held[giver]
            if free == len(ids):
                self.space.remove((free, w))
                self.out.append((w, self.held.pop(w)))
            else:
                self.space.remove((free, w))
                insort(self.space, (free - len(ids), w))
        if not self.space:
            return None
        w = self.space.pop()[1]
        return [(w, self.held.pop(w))]

    def drain(self) -> list[tuple[int, list]]:
        out, self.out = self.out, []
        return out


def _rows(windows: list, part: int, unfinished: bool) -> pa.RecordBatch:
    rows = []
    for w, pieces in windows:
        offset = 0
        for id_, start, ids, total in pieces:
            raw = ids.tobytes()
            rows.append((id_, start, len(ids), zlib.crc32(raw), total, part, w, offset, raw if unfinished else None))
            offset += len(ids)
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "part", "window", "offset", "ids"]
    types = [pa.int64()] * 8 + [pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _packed(path: str, last_id: int, length: int, n_open: int, min_cut: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer, part = encoder(path, last_id), Packer(length, n_open, min_cut), TaskContext.get().partitionId()
        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.document(id_, own.ids((text.as_py() or b"").decode("utf-8", "replace")))
            yield _rows(packer.drain(), part, False)
        last = packer.finish()
        yield _rows(packer.drain(), part, False)
        if last:
            yield _rows(last, part, True)

    return run


def _merged(length: int, n_open: int, min_cut: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, part = Packer(length, n_open, min_cut), TaskContext.get().partitionId()
        for batch in batches:
            for r in batch.to_pylist():
                packer.place((r["id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]))
            yield _rows(packer.drain(), part, False)
        last = packer.finish()
        yield _rows(packer.drain(), part, False)
        if last:
            yield _rows(last, part, True)

    return run


@tidy
def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         n_open: int = OPEN, min_cut: int = MIN_CUT, last_id: int = 1) -> DataFrame:
    """One row for each piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``tokenizer`` is the path of a tokenizers file that every worker can open; each document's ids end with ``last_id``.
    ``start`` is the position of the piece in its document, ``offset`` in its sequence.  Null and empty texts are the one
    id ``last_id``; an empty table gives no rows; repeated rows are packed each; ids may be null; other columns are not
    looked at.  Memory is bounded by the open windows and one document.  Which documents share a sequence depends on the
    partitions of the input; the rows are written once, so they don't change when a task is lost.
    """
    assert sys.byteorder == "little"
    spark = ready(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))
    level, done = 0, []
    found = materialize(src.mapInArrow(_packed(tokenizer, last_id, length, n_open, min_cut), PIECES), "pack")
    while True:
        done.append((level, found))
        left = found.where("ids is not null")
        unfinished = left.agg(F.countDistinct("part")).first()[0]  # one window of each partition at most
        if unfinished <= 1:
            break
        done[-1] = (level, found.where("ids is null"))
        level += 1
        tasks = (unfinished + FAN_IN - 1) // FAN_IN
        found = materialize(left.repartition(tasks).mapInArrow(_merged(length, n_open, min_cut), PIECES), "pack")
    out = None
    for n, frame in done:
        seq = F.shiftleft(F.lit(n).cast("long"), 59) + F.shiftleft("part", 35) + F.col("window")
        rows = frame.select("id", "start", "length", "ids_crc32", "doc_tokens", seq.alias("sequence_id"), "offset")
        out = rows if out is None else out.unionByName(rows)
    return out
