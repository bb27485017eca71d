"""The stages of the corpus pipeline, in order: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import fresh, table
from starload.llm.decontam import contamination
from starload.llm.language import identify
from starload.llm.minhash import near_duplicates
from starload.llm.packing import pack
from starload.llm.paragraphs import removals, repeated_passages
from starload.llm.passages import without_spans
from starload.llm.queries import tokenizer_path


def _named(docs: DataFrame, stay: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """``docs`` with two more columns, the doc_id and the xxhash64 of the text, ``stay(id, th, ...)`` with the same, and their names,
    which no column of ``docs`` has."""
    key, th = fresh(docs, "row_id"), fresh(docs, "row_text")
    none = F.lit(-(2**63)).cast("long")
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), none), th: F.xxhash64("text")})
    others = [c for c in stay.columns if c not in ("id", "th")]
    return keyed, stay.select(F.coalesce("id", none).alias(key), F.col("th").alias(th), *others), [key, th]


def keep_rows(docs: DataFrame, stay: DataFrame, once: bool = False) -> DataFrame:
    """The rows of ``docs`` named by ``stay(id, th)``, the doc_id and the xxhash64 of the text; ``once``: repeated rows once."""
    keyed, named, on = _named(docs, stay)
    kept = keyed.join(named, on, "left_semi")
    return (kept.dropDuplicates(on) if once else kept).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised stay, with the recognised language in ``lang``.  Without letters there is
    none: null and empty texts go.  ``lang`` is the declared language, ``source`` the host."""
    told = fresh(docs, "told_lang")
    found = identify(docs, declared=F.col("lang"), host=F.col("source")).where("accepted")
    found = found.groupBy("id", F.col("text_hash").alias("th")).agg(F.min("lang").alias(told))  # repeated rows have one text and one host each
    keyed, named, on = _named(docs, found)
    return keyed.join(named, on).withColumn("lang", F.col(told)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id; all without words stay."""
    found = near_duplicates(docs, shingle=5, percent=80)
    first = F.min(F.struct(F.col("id").isNull(), F.col("id").alias("id"), F.col("text_hash").alias("th"))).alias("first")
    stay = found.where("group is not null").groupBy("group").agg(first).select("first.id", "first.th")
    stay = stay.union(found.where("group is null").select("id", F.col("text_hash").alias("th")).distinct())
    return keep_rows(docs, stay, once=True)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of the texts; a document of which nothing is left goes."""
    spans = removals(repeated_passages(docs))
    left = without_spans(docs, spans, "doc_id", "text").withColumn("n_chars", F.char_length("text").cast("long"))
    return left.where(F.col("text").rlike(r"[^\x20\x09-\x0D]") | F.col("text").isNull()).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item stay."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return keep_rows(docs, found.where("n_hit = 0").select("id", F.col("text_hash").alias("th")).distinct())


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as sequences of at most 2048 tokens, one row for each piece."""
    return pack(docs, tokenizer_path(), length=2048).withColumnRenamed("id", "doc_id")


STAGES = [("language", language), ("near_copies", near_copies), ("passages", passages), ("decontaminated", decontaminated), ("packed", packed)]
