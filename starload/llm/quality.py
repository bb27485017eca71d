"""Quality rules with a hashed n-gram log-likelihood ratio, with DataFrame functions only.

Words and pairs of words are hashed into buckets.  Two multinomials over the buckets are counted, one of trusted documents
and one of all; a document's score is the mean of log(p_trusted / p_all) over its n-grams.  Documents that pass the base
rules are kept if their score reaches a threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import ready

#: Buckets; trusted documents that are counted at most (the ones with the smallest hash of the id); weight, in n-grams,
#: that the trusted multinomial is drawn towards the other; score that a document needs.
BUCKETS, MAX_TRUSTED, PRIOR, THRESHOLD = 10_000, 20_000, 10_000.0, -0.03
#: Base rules: least words, and largest share of words in repeated three-word windows (percent).
MIN_WORDS, MAX_REPEATS = 50, 50
#: Positions in a text that fit beside 40 bits of a hash.
_PLACES = 1 << 24


def words(text: Column) -> Column:
    """The runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""), F.array().cast("array<string>"))


def _starts(n: Column, k: int) -> Column:
    return F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))


def _ngrams() -> Column:
    """Buckets of the words and of the pairs of words, from column ``wh`` (the words' hashes)."""
    one = F.transform("wh", lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    two = F.transform(_starts(F.size("wh"), 2), lambda i: F.pmod(F.xxhash64(F.get("wh", i), F.get("wh", i + 1)), F.lit(BUCKETS)).cast("int"))
    return F.concat(one, two)


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), words(F.col(text_col)).alias("ws"))
    return src.withColumn("wh", F.transform("ws", lambda w: F.xxhash64(w)))


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_trusted: int = MAX_TRUSTED) -> list[float]:
    """log(p_trusted / p_all) for each bucket; ``trusted(id)`` names documents, of which ``max_trusted`` are counted at most."""
    picked = trusted.select(F.col("id").cast("long").alias("id")).where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(max_trusted)
    picked = picked.withColumn("t", F.lit(1))  # 16 bytes a row: small whatever the input, so it is broadcast
    marked = _hashed(docs, id_col, text_col).select("id", _ngrams().alias("g")).join(F.broadcast(picked), "id", "left")
    # explode() would have the optimiser compute the n-grams once more, in a filter on their number
    each = marked.select(F.coalesce("t", F.lit(0)).alias("t"), F.explode_outer("g").alias("b")).where("b is not null")
    rows = each.groupBy("b").agg(F.count("*").alias("n"), F.sum("t").alias("t")).collect()  # BUCKETS rows at most
    every, good = [1.0] * BUCKETS, [0.0] * BUCKETS
    for r in rows:
        every[r.b] += r.n
        good[r.b] += r.t
    total, trusted_total = sum(every), sum(good)
    return [math.log(((g + PRIOR * n / total) / (trusted_total + PRIOR)) / (n / total)) for n, g in zip(every, good, strict=True)]


def _repeated(n: Column) -> tuple[Column, Column, Column]:
    """Column expressions for n_repeat_words, to be added one after the other: ``sorted`` needs ``wh``, ``again`` needs
    ``sorted``, and the result needs ``again``.

    Hashes of three-word windows are sorted with their positions in their low bits; equal neighbours are then told apart
    by their full hashes.
    """
    def window(i: Column) -> Column:
        return F.xxhash64(F.get("wh", i), F.get("wh", i + 1), F.get("wh", i + 2))

    low = F.lit(_PLACES - 1).cast("long")
    packed = F.sort_array(F.transform(_starts(n, 3), lambda i: window(i).bitwiseAND(F.lit(-_PLACES).cast("long")).bitwiseOR(i.cast("long"))))

    def twin(x: Column, y: Column) -> Column:
        return F.coalesce(F.shiftright(x, 24) == F.shiftright(y, 24), F.lit(False))

    near = F.filter("sorted", lambda x, i: twin(x, F.get("sorted", i - 1)) | twin(x, F.get("sorted", i + 1)))
    places = F.when(n <= _PLACES, F.transform(near, lambda x: x.bitwiseAND(low).cast("int"))).otherwise(_starts(n, 3))
    again = F.sort_array(F.transform(places, lambda i: F.struct(window(i).alias("h"), i.alias("i"))))

    def same(x: Column, i: Column) -> Column:
        return F.coalesce(x["h"] == F.get("again", i)["h"], F.lit(False))

    both = F.sort_array(F.transform(F.filter("again", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))
    zero = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(both, zero, lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")))
    return packed, again, covered["n"]


def quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
            max_repeats: int = MAX_REPEATS, threshold: float = THRESHOLD, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """One row for each row of ``docs``: (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    score, kept).

    ``trusted(id)`` names the documents of the target distribution; ids that no document has don't count.  If there are
    none, all ratios are 1 and the base rules alone decide.  Null and empty texts have no words and fail the base rules;
    score is null without words.  Ids may be null and rows may repeat: rows are judged one by one.  Texts are read
    whole; other columns are not looked at.  Nothing is shuffled but counts of buckets.
    """
    ready(docs.sparkSession)
    ratios = log_ratios(docs, trusted, id_col, text_col, max_trusted)
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    n = F.size("ws")
    packed, again, repeats = _repeated(n)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    src = _hashed(docs, id_col, text_col).withColumn("sorted", packed).withColumn("again", again).withColumn("lines", lines)
    total = F.aggregate(_ngrams(), F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    none = F.lit(0)
    out = src.select(
        "id",
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        F.coalesce(F.char_length("text") - F.char_length(F.regexp_replace("text", r"[#*$%&|<>]+", "")), none).cast("long").alias("n_symbols"),
        F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), none).cast("long").alias("n_dup_lines"),
        repeats.cast("long").alias("n_repeat_words"),
        F.when(n > 0, total / (2 * n - 1)).alias("score"),
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeats * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(F.col("score") >= threshold, F.lit(False)))
