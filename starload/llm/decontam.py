"""Benchmark decontamination as a prefix-filtered set join, with DataFrame functions only.

A window of an item is a set of shingles of five consecutive words at known offsets (a shorter window is one shingle).  A
document that contains the window contains all of its shingles, so one of them is necessary: the rarest one in the
documents.  Occurrences of those shingles are joined with the windows; length and position decide where the window would
have to lie, and the words there are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import materialize, ready, tidy

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a shingle, and of a window.
SHINGLE, WINDOW = 5, 10
#: Bits of the bitmap that finds candidate shingles in documents: its size is fixed, whatever the benchmark's.
BITMAP = 1 << 21


def words(text: Column) -> Column:
    """The runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; null has none."""
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), ""), F.array().cast("array<string>"))


def _starts(n: Column, k: int | Column) -> Column:
    """0 .. n - k, or nothing."""
    last = n - k
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """(item, win, len, size, offset, h): each window's words and, exploded, its shingles of ``size`` words."""
    ws = items.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("ws")).withColumn("n", F.size("ws")).where("n > 0")
    ws = ws.withColumn("len", F.least(F.lit(window), F.col("n"))).withColumn("size", F.least(F.lit(shingle), F.col("len")))
    each = ws.select("item", "len", "size", "ws", F.explode(_starts(F.col("n"), F.col("len"))).alias("p"))
    return each.select("item", "len", "size", F.slice("ws", F.col("p") + 1, F.col("len")).alias("win")).distinct()


def _bitmap(hashes: DataFrame) -> Column:
    """The set of hashes as a literal array of BITMAP bits; at most BITMAP / 64 rows come to the driver."""
    bit = F.col("h").bitwiseAND(F.lit(BITMAP - 1))
    rows = hashes.select(F.shiftright(bit, 6).alias("i"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("b")).groupBy("i").agg(F.bit_or("b").alias("b")).collect()
    words64 = [0] * (BITMAP // 64)
    for r in rows:
        words64[r.i] = r.b
    return F.split(F.lit(",".join(map(str, words64))), ",").cast("array<bigint>")


@tidy
def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row for each row of ``docs``: (id, text_hash, n_words, n_hit, items), the number of words, of words inside an
    occurrence of a window of an item, and the sorted ids (as strings) of the items whose windows occur.

    A window is ``window`` consecutive words of an item, or all of a shorter item's.  Null and empty texts have no words
    and no hits, items without words have no windows; an item with a null id marks words, but isn't named; repeated
    rows give repeated results and ids may be null (rows are told apart by id and text).  Texts are searched whole.
    Other columns are not looked at.
    """
    spark = ready(docs.sparkSession)
    wins = materialize(_windows(items, item_col, item_text_col, window, shingle), "windows")
    shingles = wins.select("win", "len", "size", F.explode(_starts(F.col("len"), F.col("size"))).alias("offset")).distinct()
    shingles = shingles.withColumn("h", F.xxhash64(F.slice("win", F.col("offset") + 1, F.col("size"))))
    sizes = sorted(r[0] for r in wins.select("size").distinct().collect())  # 1 .. shingle
    bitmap = _bitmap(shingles)

    def found(size: int) -> Column:
        """Positions of shingles of this size that may be an item's, with as many words around as a window can need."""
        def hashed(p: Column) -> Column:
            return F.struct(p.alias("p"), F.xxhash64(*[F.get(F.col("ws"), p + i) for i in range(size)]).alias("h"))

        def may_be(x: Column) -> Column:
            bits = F.get(F.col("bits"), F.shiftright(x["h"].bitwiseAND(F.lit(BITMAP - 1)), 6).cast("int"))
            return F.getbit(bits, x["h"].bitwiseAND(F.lit(63)).cast("int")) == 1

        back = window - size if size == shingle else 0  # a smaller shingle is a whole window
        first = lambda x: F.greatest(x["p"] - back, F.lit(0))
        return F.transform(F.filter(F.transform(_starts(F.size("ws"), size), hashed), may_be), lambda x: F.struct(
            x["p"].alias("p"), F.lit(size).alias("size"), x["h"].alias("h"), first(x).alias("at"), F.slice("ws", first(x) + 1, x["p"] - first(x) + size + back).alias("near")))

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), words(F.col(text_col)).alias("ws"))
    none = F.array().cast("array<struct<p:int,size:int,h:bigint,at:int,near:array<string>>>")
    cands = F.concat(none, *[found(s) for s in sizes])
    scan = materialize(_with_literal(src, bitmap, cands), "candidates")

    seen = scan.select(F.explode("cands").alias("c")).groupBy("c.size", "c.h").agg(F.count("*").alias("times"))
    counted = shingles.join(seen, ["size", "h"])  # windows with a shingle that no document has can't occur
    rarest = F.min(F.struct("times", "h", "offset")).alias("r")
    need = counted.groupBy("win", "len", "size").agg(rarest, F.count("*").alias("n")).where("n = len - size + 1")
    need = need.select("win", "len", "size", "r.h", "r.offset")
    at = scan.select("id", "text_hash", "n_words", F.explode("cands").alias("c")).select("id", "text_hash", "n_words", "c.*")
    start = F.col("p") - F.col("offset")
    met = at.join(need, ["size", "h"]).withColumn("start", start).where("start >= 0 and start + len <= n_words")
    met = met.where(F.slice("near", F.col("start") - F.col("at") + 1, F.col("len")) == F.col("win"))
    hits = materialize(met.select("id", "text_hash", "start", "len", "win"), "hits")

    spans = hits.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "len"))).alias("spans"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    union = F.aggregate("spans", zero, lambda acc, s: F.struct(
        F.greatest(acc["end"], s["start"] + s["len"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(acc["end"], s["start"]))).alias("n")))
    named = hits.select("id", "text_hash", "win").distinct().join(wins.select("win", "item"), "win")
    named = named.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    same = lambda x: [F.col("d.id").eqNullSafe(F.col(f"{x}.id")), F.col("d.text_hash") == F.col(f"{x}.text_hash")]
    spans = spans.select("id", "text_hash", union["n"].alias("n_hit"))
    out = scan.select("id", "text_hash", "n_words").alias("d").join(spans.alias("s"), same("s"), "left").join(named.alias("i"), same("i"), "left")
    return out.select("d.id", "d.text_hash", F.col("d.n_words").cast("long").alias("n_words"), F.coalesce("s.n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("i.items", F.array().cast("array<string>")).alias("items"))


def _with_literal(src: DataFrame, bitmap: Column, cands: Column) -> DataFrame:
    """The candidates of each document.  The bitmap is a literal, so the optimiser puts it where ``bits`` is used."""
    return src.withColumn("bits", bitmap).select("id", "text_hash", F.size("ws").alias("n_words"), cands.alias("cands"))
