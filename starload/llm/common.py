"""Helpers shared by the text operators: shipping the package to Python workers, reading tables, hashing words."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextvars import ContextVar
from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload import session
from starload.session import checkpoint_dir, scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Bytes and rows of an Arrow batch handed to a Python worker; together they bound a worker's memory.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, keep Arrow batches small, and fix the checkpoint folder."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    checkpoint_dir(spark)
    return spark


_WORK: ContextVar[str | None] = ContextVar("work", default=None)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared checkpoint folder and read again; inside an operator its working folder is used."""
    folder = _WORK.get()
    if folder is None:
        return session.materialize(df, name)
    path = f"{folder}/{os.path.basename(scratch_path(df.sparkSession, name))}"
    df.write.mode("errorifexists").parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.working_folder = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Delete working tables (made by :func:`materialize` inside an operator) that nothing reads any more."""
    for df in tables:
        path = getattr(df, "working_folder", None)
        if path:
            p = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def tidy(operator):
    """An operator whose working tables go when its result is written, so that a pipeline's stages don't add them up."""
    @wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        spark = ready(docs.sparkSession)
        folder = scratch_path(spark, f"work-{operator.__name__}")
        token = _WORK.set(folder)
        try:
            return session.materialize(operator(docs, *args, **kwargs), operator.__name__)
        finally:
            _WORK.reset(token)
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or one like it that ``df`` has no column of (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(text: str):
    """The text column as UTF-8 bytes (a Python worker then gets bytes, without decoding)."""
    return F.col(text).cast("binary")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUES = np.arange(1, 257, dtype=np.uint64)
_BASE, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
#: Bytes or words that are hashed at once, so that a long text doesn't need many times its size.
STRETCH = 1 << 16


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as were needed so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = (np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n, 2 * len(cls.up)), x, np.uint64))]) for x in (_BASE, _BACK))
        return cls.up, cls.down


def _runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sums of ``values[i] * base^(i - start)`` over [start, end): a hash that doesn't depend on the place."""
    up, down = _Powers.get(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def _words(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some bytes begin, and their hashes."""
    edge = np.diff(np.concatenate([[True], _SPACE[b], [True]]).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return starts, mixed(_runs(_VALUES[b], starts, ends) + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word (run of anything but ASCII white space) of a text, in order."""
    out, at = [], 0
    while at < len(text):
        end = at + STRETCH
        if end < len(text):  # a stretch ends at white space; a longer word makes it longer
            found = np.flatnonzero(_SPACE[np.frombuffer(text, np.uint8, STRETCH, at)])
            more = _WHITE.search(text, end)
            end = at + int(found[-1]) + 1 if len(found) else more.end() if more else len(text)
        out.append(_words(np.frombuffer(text[at:end], np.uint8))[1])
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def hashed_together(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The word hashes of many texts, as :func:`word_hashes` gives them, short texts hashed together: (indices of the texts, their
    hashes one after the other, where each one's begin and the last one's end).  Null texts have no words."""
    group, size = [], 0

    def hashed(group: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = [len(texts[i] or b"") for i in group]
        if len(group) == 1 and sizes[0] > STRETCH:
            h = word_hashes(texts[group[0]])
            return np.array(group), h, np.array([0, len(h)])
        at, h = _words(np.frombuffer(b" ".join(texts[i] or b"" for i in group), np.uint8))
        return np.array(group), h, np.append(np.searchsorted(at, np.cumsum([0, *sizes[:-1]]) + np.arange(len(group))), len(h))

    for i, text in enumerate(texts):
        more = len(text or b"") + 1
        if group and size + more > STRETCH:
            yield hashed(group)
            group, size = [], 0
        group.append(i)
        size += more
    if group:
        yield hashed(group)


def room(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of texts that lie one after the other (``bounds`` as :func:`hashed_together` gives them): its text, and how many
    words this has from there on."""
    which = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return which, bounds[1:][which] - np.arange(bounds[-1])


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, in text order; one hash of the whole sequence if there are fewer words."""
    n = len(h)
    if n == 0:
        return h
    k, out = min(k, n), []
    for at in range(0, n - k + 1, STRETCH):
        part = mixed(h[at : at + STRETCH + k - 1])
        starts = np.arange(len(part) - k + 1)
        out.append(mixed(_runs(part, starts, starts + k) + np.uint64(k)))
    return np.concatenate(out)


def leftmost_minima(h: np.ndarray, w: int) -> np.ndarray:
    """For every run of ``w`` values the position of its smallest one (the leftmost), by doubling the length of the runs."""
    low, at, done = h, np.arange(len(h)), 1
    while done < w:
        step = min(done, w - done)
        right = low[step:] < low[:-step]
        low, at, done = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step]), done + step
    return at
