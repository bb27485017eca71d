"""Language identification by Bayesian fusion of evidence.

The likelihood of the text comes from byte trigrams, hashed to a fixed number of buckets and counted by declared
language over all documents.  What the text alone says then gives, by grouped aggregation, how often each language is
declared as what, which address suffixes it has, and how often each host and domain has it.  A document's posterior joins
the four: the text's likelihood (tempered, as trigrams aren't independent), the likelihoods of the declared language and
of the suffix, and a prior of the host that is smoothed towards its domain's, and that towards the whole corpus'.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import materialize, ready, text_bytes, tidy

BUCKETS = 1 << 14
#: A text counts as so many independent trigrams at most; strength of the smoothing of hosts and domains; a document needs
#: this posterior.
EVIDENCE, KAPPA, LEAST_POSTERIOR = 100, 20.0, 0.5
#: The two-letter codes of ISO 639, which bound the number of models, and the three-letter codes that name no language.
CODES = frozenset(
    """aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu
    fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik in io is it iu iw ja ji jv jw ka kg ki kj kk
    kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mo mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj
    om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg sh si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr
    ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu""".split()
)
NO_LANGUAGE = ("und", "mul", "mis", "zxx", "unk")

#: ASCII letters in lower case, everything else in ASCII a space, other bytes as they are.
_FOLD = bytes(ord(chr(b).lower()) if chr(b).isalpha() and b < 128 else 32 if b < 128 else b for b in range(256))


def _buckets(data: bytes) -> np.ndarray:
    """The bucket of every trigram of bytes; trigrams of spaces only are in bucket 0, alone."""
    x = np.frombuffer(data, np.uint8).astype(np.uint32)
    t = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    return np.where(t == 0x202020, 0, 1 + ((t * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(BUCKETS - 1))


def _chunks(texts: list[bytes], size: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(number of the text, folded stretch of it): long texts come in stretches that overlap by two bytes."""
    for i, t in enumerate(texts):
        t = b" " + t.translate(_FOLD) + b" "
        for at in range(0, max(1, len(t) - 2), size):
            yield i, t[at : at + size + 2]


def _counts(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), np.int64)
        number = {l: i for i, l in enumerate(languages)}
        for batch in batches:
            declared = batch.column(1).to_pylist()
            for i, data in _chunks([t.as_py() or b"" for t in batch.column(0)]):
                if len(data) > 2:
                    total[number[declared[i]]] += np.bincount(_buckets(data), minlength=BUCKETS)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int64)), pa.array(bucket), pa.array(total[lang, bucket])], names=["l", "bucket", "n"])

    return run


def _likelihoods(logp: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(0)]
            sums, n = np.zeros((len(texts), logp.shape[1])), np.zeros(len(texts), np.int64)
            for i, data in _chunks(texts):
                if len(data) > 2:
                    b = _buckets(data)
                    b = b[b > 0]
                    sums[i] += logp[b].sum(axis=0, dtype=np.float64)
                    n[i] += len(b)
            rest = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(n), pa.array(list(sums), pa.list_(pa.float64()))], names=[*batch.schema.names[1:], "n", "ll"])

    return run


def _log_shares(counts: DataFrame, by: str, size: int, prior: Column) -> DataFrame:
    """(by, p): the shares of the languages under each key, smoothed with ``KAPPA`` rows that are shared out as ``prior``."""
    each = [F.sum(F.when(F.col("l") == i, F.col("rows")).otherwise(0)).cast("double") for i in range(size)]
    got = counts.groupBy(by).agg(F.array(*each).alias("c"))
    total = F.aggregate("c", F.lit(0.0), lambda a, x: a + x)
    return got.withColumn("p", F.zip_with("c", prior, lambda c, p: (c + KAPPA * p) / (total + KAPPA))).select(by, "p")


@tidy
def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared: Column | None = None, host: Column | None = None,
             domain: Column | None = None, suffix: Column | None = None, least_posterior: float = LEAST_POSTERIOR) -> DataFrame:
    """One row for each row of ``docs``: (id, text_hash, lang, posterior, n_trigrams, accepted).

    ``declared``, ``host``, ``domain`` and ``suffix`` are string columns of ``docs`` or None; a null says nothing.  At
    least one row must declare a language, or no row is accepted.  Every two-letter code (with or without region) that any row
    declares is a language with a model, however little text it has and whatever else the corpus holds; ``lang`` is the code
    without region.  Languages with a three-letter code have none: documents with letters that declare one keep it and are
    accepted; their posterior is null.  Other declarations say nothing.  Any other document is accepted if it has letters, if its
    best language explains its trigrams better than chance (all buckets alike), and if that language's posterior is at
    least ``least_posterior``.  Null and empty texts, or texts without letters, have lang null and are not accepted.
    Ids may be null and rows may repeat: rows are judged one by one.  Texts are read whole, in stretches of bounded size;
    other columns are not looked at.
    """
    spark = ready(docs.sparkSession)
    none = F.lit(None).cast("string")
    given = lambda c: none if c is None else F.nullif(F.trim(F.lower(c)), F.lit(""))
    src = docs.select(text_bytes(text_col).alias("text"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"),
                      given(declared).alias("declared"), given(host).alias("host"), given(domain).alias("domain"), given(suffix).alias("suffix"))
    code = F.regexp_extract("declared", "^([a-z]{2,3})([-_][a-z0-9_-]+)?$", 1)
    three = (F.length(code) == 3) & ~code.isin(*NO_LANGUAGE)
    src = src.withColumn("declared", F.when(code.isin(sorted(CODES)), code).when(three, F.col("declared")))
    languages = sorted(r[0] for r in src.where(F.col("declared").isin(sorted(CODES))).select("declared").distinct().collect())
    size = max(1, len(languages))
    rare = F.coalesce(~F.col("declared").isin(languages), F.lit(False))

    counted = src.where(F.col("declared").isin(languages)).select("text", "declared").mapInArrow(_counts(languages), "l long, bucket long, n long")
    table = np.zeros((size, BUCKETS))
    for r in counted.groupBy("l", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():  # languages * BUCKETS rows at most
        table[r.l, r.bucket] = r.n
    table[:, 0] = 0
    logp = np.log((table + 0.1) / (table.sum(axis=1, keepdims=True) + 0.1 * BUCKETS)).T.astype(np.float32)
    model = spark.sparkContext.broadcast(logp)

    kept = "id long, text_hash long, declared string, host string, domain string, suffix string, n long, ll array<double>"
    seen = materialize(src.mapInArrow(lambda batches: _likelihoods(model.value)(batches), kept), "likelihoods")
    best = F.array_position("ll", F.array_max("ll")).cast("int") - 1
    counts = seen.where((F.col("n") > 0) & ~rare).groupBy(best.alias("l"), "declared", "suffix", "domain", "host").agg(F.count("*").alias("rows"))
    counts = materialize(counts, "evidence")

    even = F.array(*[F.lit(1.0 / size)] * size)
    whole = _log_shares(counts.withColumn("all", F.lit(1)), "all", size, even).select("p").collect()
    base = whole[0].p if whole else [1.0 / size] * size
    prior = F.array(*[F.lit(x) for x in base])
    domains = _log_shares(counts.where("domain is not null"), "domain", size, prior).withColumnRenamed("p", "p_domain")
    own = counts.where("host is not null").join(domains, "domain", "left").withColumn("up", F.coalesce("p_domain", prior))
    up = own.groupBy("host").agg(F.first("up").alias("up"))
    hosts = _log_shares(counts.where("host is not null").withColumnRenamed("host", "h"), "h", size, F.array(*[F.lit(0.0)] * size)).join(up, F.col("h") == F.col("host"))
    # p holds counts / (total + KAPPA) so far; the domain's part is added here
    mass = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    hosts = hosts.select("host", F.zip_with("p", "up", lambda c, u: c + (1 - mass) * u).alias("p_host"))

    def likelihood(by: str) -> DataFrame:
        """(by, lik): log P(value | language), each language's values smoothed alike."""
        values = counts.where(F.col(by).isNotNull()).groupBy(by).agg(*[F.sum(F.when(F.col("l") == i, F.col("rows")).otherwise(0)).alias(f"c{i}") for i in range(size)])
        n, *totals = values.agg(F.count("*"), *[F.sum(f"c{i}") for i in range(size)]).first()
        each = [F.log((F.col(f"c{i}") + 0.5) / F.lit((totals[i] or 0) + 0.5 * n)) for i in range(size)]
        return values.select(by, F.array(*each).alias(f"lik_{by}"))

    zero = F.array(*[F.lit(0.0)] * size)
    out = seen.join(hosts, "host", "left").join(likelihood("declared"), "declared", "left").join(likelihood("suffix"), "suffix", "left")
    weight = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / F.greatest("n", F.lit(1)))
    score = F.transform("ll", lambda x: x * weight)
    for part in (F.transform(F.coalesce("p_host", prior), lambda p: F.log(p)), F.coalesce("lik_declared", zero), F.coalesce("lik_suffix", zero)):
        score = F.zip_with(score, part, lambda x, y: x + y)
    out = out.withColumn("score", score).withColumn("top", F.array_max("score"))
    out = out.withColumn("posterior", 1.0 / F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    out = out.withColumn("at", F.array_position("score", F.col("top")).cast("int"))
    fits = F.element_at("ll", F.col("at")) / F.greatest("n", F.lit(1)) > -math.log(BUCKETS)
    known = F.lit(bool(languages)) & (F.col("n") > 0) & fits
    lang = F.when(known, F.element_at(F.array(*[F.lit(x) for x in languages or ["-"]]), F.col("at")))
    posterior = F.when((F.col("n") > 0) & ~rare, F.col("posterior"))
    keeps = rare & (F.col("n") > 0)
    return out.select("id", "text_hash", F.when(keeps, F.col("declared")).otherwise(lang).alias("lang"), posterior.alias("posterior"), F.col("n").alias("n_trigrams"),
                      F.coalesce(keeps | (known & (F.col("posterior") >= least_posterior)), F.lit(False)).alias("accepted"))


def address_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, domain (its last two labels) and suffix (the last one) of an address; null if it has no host."""
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)), F.lit(""))
    return host, F.substring_index(host, ".", -2), F.substring_index(host, ".", -1)


def markup_language(html: Column) -> Column:
    """The language that the markup's root element declares, without region; null if none."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})\b", 1)), F.lit(""))


def visible_text(html: Column) -> Column:
    """The markup's text: scripts, styles, comments and tags become spaces."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
