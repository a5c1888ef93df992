"""Queries ``op1_`` to ``op13_`` over the driver tables: each applies one operator with
production parameters to its whole table and derives the digest columns from its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.ann import nearest
from tessera.llm.collocations import collocations
from tessera.llm.common import documents
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.hard_negatives import hard_negatives
from tessera.llm.line_dedup import line_dedup
from tessera.llm.minhash_dedup import near_duplicates
from tessera.llm.mixing import mix_sources
from tessera.llm.page_text import page_texts
from tessera.llm.piece_codec import encode_documents
from tessera.llm.quality import quality
from tessera.llm.sharding import balanced_shards
from tessera.llm.token_counts import count_tokens
from tessera.llm.toxicity import toxicity
from tessera.session import table


PIECE_MODEL = "piece_bpe_32k.model"


def tokenizer_path(name: str = PIECE_MODEL) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the first offending sentence by byte offsets."""
    out = toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    first = F.get("offending", F.lit(0))
    return out.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"),
                      first["begin"].alias("first_begin"), first["end"].alias("first_end"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups: Jaccard similarity of 5-word shingles of 0.75 or more."""
    return near_duplicates(documents(spark, sf_dir), percent=75)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 shards, counts at most one apart, equal texts together."""
    return balanced_shards(documents(spark, sf_dir), n_shards=40).drop("label")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weighted 5, 2, 1, repeating; 150 % of all words; at most two epochs of a source."""
    return mix_sources(documents(spark, sf_dir))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest rows by cosine for each row whose id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more in at least 5 documents stay in the last of these only."""
    return line_dedup(documents(spark, sf_dir), min_chars=40, min_docs=5).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode with the end id, decode again, and check that the pieces' spans tile the text."""
    out = encode_documents(documents(spark, sf_dir), tokenizer_path())
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
                      F.element_at("ends", -1).alias("n_bytes_covered"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup(documents(spark, sf_dir), keep="max")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text, and whether they exceed 4096 tokens."""
    return count_tokens(documents(spark, sf_dir), tokenizer_path()).withColumn("over_limit", F.col("n_tokens") > 4096)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each row whose id is divisible by 100 and its 5 best rows of the same label: the 10 best rows of other
    labels with 30 to 90 percent of that score. Where an id is divisible by 7 the label is moved on by one."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best phrases of 2 to 5 words among those that occur 100 times or more."""
    return collocations(documents(spark, sf_dir), max_words=5, min_count=100, per_lang=2000)


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, its blocks joined by an empty line."""
    out = page_texts(table(spark, sf_dir, "pages")).withColumn("text", F.array_join("blocks", "\n\n"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_quality": op3_quality,
    "op4_sharding": op4_sharding,
    "op5_mixing": op5_mixing,
    "op6_ann": op6_ann,
    "op7_line_dedup": op7_line_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_collocations": op12_collocations,
    "op13_page_text": op13_page_text,
}
