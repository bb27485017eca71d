"""Spelling variants: words that differ by one letter, grouped under the most frequent one.

Near words are found by trying edits.  Every word yields its deletions, and the replacements of a letter by a later one of the
alphabet, so each pair of near words is tried once: from the longer word, or from the one whose letter is earlier.  The hash of
an edit follows from the word's by arithmetic; nothing is spelled out for it.  The hashes are looked up in blocked Bloom
filters of the vocabulary, one for each length, that every task has.  Only the edits that a filter lets through are written,
shuffled and joined with the vocabulary, which removes the false ones.

A filter has 16 bits a word, and all together have at most ``FILTER_BITS``: with a larger vocabulary they let more false edits
through to the join, and results stay the same.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import materialize, mixed, text_bytes, tidy

#: A run of letters in lower-cased UTF-8: a-z, and U+00C0 to U+00FF as C3 80 to C3 BF.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: One occurrence in so many loses a letter.
SLIP = 97
#: Bits of all filters together, bits of a block, and bits that a word sets in its block.
FILTER_BITS, BLOCK_BITS, WORD_BITS = 1 << 29, 512, 4
#: Lengths from here on share a filter.
LONG = 255
#: Words that are counted or edited together in a task.
COUNTED, EDITED = 200_000, 20_000
BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def slipped(run: bytes, h: int) -> bytes:
    """The run without its letter number ``h`` modulo its length; letters are counted from 0."""
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (word, n), summed over many texts.  A run of a text that the checksum of ``id:run`` hits loses a letter."""
    def out(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in found], pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    found: Counter = Counter()
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            start = zlib.crc32(b"%d:" % i if i is not None else b":")
            for run, n in Counter(RUN.findall((text.as_py() or b"").lower())).items():
                if len(run) < LEAST_LETTERS:
                    continue
                h = zlib.crc32(run, start)
                if h % SLIP == 0:
                    run = slipped(run, h)
                if len(run) - run.count(b"\xc3") >= LEAST_LETTERS:
                    found[run] += n
            if len(found) >= COUNTED:
                yield out(found)
                found.clear()
    if found:
        yield out(found)


def vocabulary(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, n): what occurs often enough."""
    texts = docs.select(F.col(id_col).cast("long"), text_bytes(text_col)).where(F.col(text_col).isNotNull())
    return texts.mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n + 1, BASE, np.uint64))


def _letters(words: list[bytes]) -> np.ndarray:
    """Words of one length, one byte a letter, as a matrix."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1).astype(np.uint64)


def _key(h: np.ndarray, length: int) -> np.ndarray:
    return mixed(h + np.uint64(length * 0xD6E8FEB86659FD93 % 2**64))


def _place(key: np.ndarray, blocks: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit ``i`` of every key: the 64-bit cell that holds it, and its mask.  The block comes from other bits than the place in it."""
    bit = (key >> np.uint64(9 * i)) & np.uint64(BLOCK_BITS - 1)
    block = ((key >> np.uint64(40)) & np.uint64(blocks - 1)) * np.uint64(BLOCK_BITS // 64)
    return (block + (bit >> np.uint64(6))).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))


def passing(key: np.ndarray, cells: np.ndarray, blocks: int) -> np.ndarray:
    """Positions of the keys that the filter lets through."""
    left = np.arange(len(key))
    for i in range(WORD_BITS):
        cell, mask = _place(key[left], blocks, i)
        left = left[(cells[cell] & mask) != 0]
    return left


def shard(length: int) -> int:
    return min(length, LONG)


def _by_length(words: list[bytes]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        groups.setdefault(len(w), []).append(k)
    return groups


def filters(vocab: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """The filter (blocks, cells) of every length.  Blocks are a power of two; what reaches the driver has at most FILTER_BITS."""
    lengths = vocab.groupBy(F.least(F.char_length("word"), F.lit(LONG)).alias("shard")).count().collect()
    blocks = {r[0]: 1 << max(0, -(-16 * r[1] // BLOCK_BITS) - 1).bit_length() for r in lengths}
    while sum(blocks.values()) * BLOCK_BITS > FILTER_BITS + len(blocks) * BLOCK_BITS:
        blocks = {k: max(1, n // 2) for k, n in blocks.items()}

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            shards, cells, masks = [], [], []
            for length, some in _by_length(words).items():
                code = _letters([words[k] for k in some])
                key = _key((code * powers(length)[:length]).sum(axis=1, dtype=np.uint64), length)
                for i in range(WORD_BITS):
                    cell, mask = _place(key, blocks[shard(length)], i)
                    shards.append(np.full(len(some), shard(length), np.int64))
                    cells.append(cell)
                    masks.append(mask.view(np.int64))
            columns = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64)) for c in (shards, cells, masks)]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "cell", "mask"])

    set_bits = vocab.select("word").mapInArrow(bits, "shard long, cell long, mask long").groupBy("shard", "cell").agg(F.bit_or("mask").alias("mask")).toArrow()
    at, cell, mask = (c.to_numpy() for c in set_bits.columns)
    out = {}
    for k, n in blocks.items():
        cells = np.zeros(n * BLOCK_BITS // 64, np.uint64)
        mine = at == k
        cells[cell[mine]] = mask[mine].view(np.uint64)
        out[k] = (n, cells)
    return out


def tried(words: list[bytes], alphabet: np.ndarray, filt: dict[int, tuple[int, np.ndarray]]) -> Iterator[tuple[int, bytes]]:
    """(word, edit) for the edits that the filters let through; words and edits have one byte a letter."""
    for length, some in _by_length(words).items():
        code, power = _letters([words[k] for k in some]), powers(length)
        part = code * power[:length]
        whole = part.sum(axis=1, dtype=np.uint64)
        same, shorter = filt.get(shard(length)), filt.get(shard(length - 1)) if length > LEAST_LETTERS else None
        before = np.zeros(len(some), np.uint64)
        for i in range(length):
            if same:  # a later letter instead of this one
                row, letter = np.nonzero(alphabet[None, :] > code[:, i, None])
                h = whole[row] + (alphabet[letter] - code[row, i]) * power[i]
                for k in passing(_key(h, length), same[1], same[0]):
                    w = words[some[row[k]]]
                    yield some[row[k]], w[:i] + bytes([int(alphabet[letter[k]])]) + w[i + 1 :]
            if shorter:  # without this letter; of a run of one letter only the first goes
                row = np.arange(len(some)) if i == 0 else np.flatnonzero(code[:, i] != code[:, i - 1])
                h = before[row] + (whole[row] - before[row] - part[row, i]) * BACK
                for k in passing(_key(h, length - 1), shorter[1], shorter[0]):
                    w = words[some[row[k]]]
                    yield some[row[k]], w[:i] + w[i + 1 :]
            before = before + part[:, i]


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every pair of near words, once in each direction."""
    spark = vocab.sparkSession
    alphabet = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct()
    # at most the 90 letters that a word may have
    codes = np.array(sorted(ord(r[0]) for r in alphabet.collect() if r[0]), np.uint64)
    shared = spark.sparkContext.broadcast((codes, filters(vocab)))

    def made(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
        edits, words, counts = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(edits, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["edit", "word", "n"])

    def of(words: list[bytes], counts: list[int]) -> Iterator[pa.RecordBatch]:
        letters, filt = shared.value
        rows = []
        for k, edit in tried(words, letters, filt):
            rows.append((edit.decode("latin-1"), words[k].decode("latin-1"), counts[k]))
            if len(rows) >= EDITED:
                yield made(rows)
                rows = []
        yield made(rows)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = [], []
        for batch in batches:
            words += [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            counts += batch.column(1).to_pylist()
            if len(words) >= EDITED:
                yield from of(words, counts)
                words, counts = [], []
        if words:
            yield from of(words, counts)

    edits = vocab.select("word", "n").mapInArrow(edit, "edit string, word string, n long")
    known = vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    once = materialize(edits.join(known, F.col("edit") == F.col("other")).select("word", "n", "other", "other_n"), "near")
    return once.union(once.select("other", "other_n", "word", "n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms(word, form)``: forms followed to the last.  Each step at least doubles the count, so chains are
    short; every round doubles how far a row has come."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        if not now.join(further, F.col("root") == F.col("at"), "left_semi").limit(1).count():
            return now
        now = materialize(now.join(further, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


@tidy
def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary of all texts.

    Words are runs of letters (A-Z in lower case) of five letters or more that occur three times or more.  One run of a text in
    ``SLIP``, by a checksum of the document's id and the run, loses a letter first.  Two words are near if one inserted, deleted
    or replaced letter makes one from the other.  ``form`` is the near word with the largest count, the first in order among
    equals, if its count is ``ratio`` times the word's or more, else null; ``root`` is where forms lead, or the word.

    Null texts have no words, a null id is an empty string in the checksum, repeated rows count each, other columns don't
    matter; without words the result is empty.  Words may be of any length: the edits of a long one are tried letter by letter.
    """
    vocab = materialize(vocabulary(docs, id_col, text_col), "vocabulary")
    near = near_words(vocab)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other")))
    seen = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    seen = seen.select(F.col("word").alias("of"), "n_near", F.col("best.other").alias("best"), (-F.col("best.less")).alias("best_n"))
    joined = vocab.join(seen, F.col("word") == F.col("of"), "left")
    good = F.col("best_n") >= ratio * F.col("n")
    named = materialize(joined.select("word", F.when(good, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                      F.when(good, F.col("best_n")).alias("form_n")), "forms")
    ends = roots(named.where("form is not null")).withColumnRenamed("word", "of")
    return named.join(ends, F.col("word") == F.col("of"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
