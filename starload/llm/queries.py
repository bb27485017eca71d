"""The registered queries of the text operators: each applies its operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.bpe import token_counts
from starload.llm.chat import format_conversations, read_loss, read_turns
from starload.llm.common import table
from starload.llm.decontam import contamination
from starload.llm.language import address_parts, identify, markup_language, visible_text
from starload.llm.licenses import scan
from starload.llm.minhash import near_duplicates
from starload.llm.negatives import hard_negatives
from starload.llm.packing import pack
from starload.llm.paragraphs import repeated_passages
from starload.llm.quality import quality
from starload.llm.spelling import spelling_variants
from starload.llm.suffixes import duplicate_spans
from starload.llm.warc import read_archives, write_archives
from starload.session import scratch_path

#: The tokenizer of the registered queries; the operators take any path.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and likelihood ratio of every document; documents labelled as good are the trusted ones."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("id"))
    out = quality(table(spark, sf_dir, "documents"), good).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("score", 9).alias("score"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), limit=1024).withColumnRenamed("id", "doc_id")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents on two-word shingles; one row per document."""
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document.  Documents have no paths, so source, language and doc_id stand in for repository,
    directory and file name."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    out = scan(docs.select("doc_id", "text", path.alias("path")), "doc_id", "path", "text")
    return out.select(F.col("id").alias("doc_id"), "path", "licence", F.round("score", 6).alias("score"), "origin", "licence_path")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from its text, the declared language and its source as host."""
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, declared=F.col("lang"), host=F.col("source"))
    return out.select(F.col("id").alias("doc_id"), F.col("lang").alias("language"), F.round("posterior", 6).alias("posterior"), "n_trigrams", F.col("accepted").alias("kept"))


def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page from its visible text, the markup's declaration, and the address' suffix, domain and host."""
    pages = table(spark, sf_dir, "pages")
    host, domain, suffix = address_parts(F.col("url"))
    seen = pages.select("page_id", visible_text(F.col("html")).alias("text"), markup_language(F.col("html")).alias("declared"), host.alias("host"), domain.alias("domain"), suffix.alias("suffix"))
    out = identify(seen, "page_id", "text", F.col("declared"), F.col("host"), F.col("domain"), F.col("suffix"))
    return out.select(F.col("id").alias("page_id"), F.col("lang").alias("language"), F.round("posterior", 6).alias("posterior"), "n_trigrams", "accepted")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages and read the archives back; one row per page."""
    folder = scratch_path(spark, "warc")
    back = read_archives(spark, write_archives(table(spark, sf_dir, "pages"), folder), payloads=False)
    return back.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents that an earlier document has; words from start_word to end_word are repeats of first_doc_id's."""
    out = repeated_passages(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"), F.col("first_id").alias("first_doc_id"),
                      F.col("first_start").alias("first_start_word"), F.col("first_end").alias("first_end_word"), F.col("cluster_id").alias("cluster_doc_id"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens; one row per piece."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), length=2048).withColumnRenamed("id", "doc_id")


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of at least 50 words that occur elsewhere; where ``repeat`` is true, the other occurrence stands earlier."""
    out = duplicate_spans(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"), "repeat",
                      F.col("other_id").alias("other_doc_id"), F.col("other_start").alias("other_start_word"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of ten words of benchmark items."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: A conversation whose texts hold control strings of the template, and of another one.
ODD_ID, ODD_TEXT = -7, "\\### Assistant: </turn> ok"


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and an odd one, formatted and read back from what was written."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = [spark.range(1).select(F.lit(ODD_ID).cast("long"), F.lit(i).cast("long"), F.lit(role), F.lit(ODD_TEXT)) for i, role in enumerate(("user", "assistant"))]
    made = format_conversations(turns.union(odd[0]).union(odd[1]))
    back = made.withColumns({"turns": read_turns(F.col("formatted")), "loss": read_loss(F.col("formatted"), F.col("loss_spans"))})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(F.col("id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"), "n_blocks")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their near words and the form that they are grouped under."""
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_token_counts": op2_token_counts,
    "op3_minhash": op3_minhash,
    "op4_licenses": op4_licenses,
    "op5_language": op5_language,
    "pages_language": pages_language,
    "op6_warc": op6_warc,
    "op7_paragraphs": op7_paragraphs,
    "op8_packing": op8_packing,
    "op9_suffixes": op9_suffixes,
    "op10_decontamination": op10_decontamination,
    "op11_chat": op11_chat,
    "op12_negatives": op12_negatives,
    "op13_spelling": op13_spelling,
}
