"""From raw documents to packed training sequences: five stages, each a Spark job over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm import mixing, packing, repeats, simhash, toxicity
from riskframe.llm.common import stored

#: The pipeline's near-duplicates share words; the contract's shingles and bits.
SHINGLE = 4
MAX_BITS = 4


def _rows(docs: DataFrame) -> DataFrame:
    """Documents as one struct ``row``, so that no column of theirs can clash with one of ours, and the hash of the text."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(whole.alias("row")).withColumn("text_hash", F.xxhash64("row.text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator accepts; null and empty texts have no hits and stay."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest doc_id; one without a doc_id only where the group has no other."""
    grouped = stored(simhash.simhash_components(docs, SHINGLE, MAX_BITS), "simhash_groups")
    # A group is named by its smallest doc_id, and a group without any by its fingerprint.
    name = ["component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("lone")]
    rows = grouped.groupBy(*name, "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "rows"))
    kept = stored(rows.groupBy("component_id", "lone").agg(first.alias("m")).select("m.*"), "kept_documents")
    same = F.expr("l.row.doc_id <=> r.doc_id and l.text_hash = r.text_hash")
    matched = _rows(docs).alias("l").join(kept.alias("r"), same).select("l.row", "l.text_hash", "r.rows")
    once = matched.filter("rows = 1").select("row")
    # Rows that repeat a kept document are copies of it too.
    repeated = matched.filter("rows > 1").groupBy("row.doc_id", "text_hash").agg(F.min("row").alias("row")).select("row")
    return once.unionByName(repeated).select("row.*")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that repeat; a document that loses all of its text goes."""
    cut = repeats.remove_repeats(docs, with_text=True, with_row=True)
    whole = F.col("n_removed") == 0
    left = cut.filter(whole | (F.length(F.trim("kept_text")) > 0))
    text, n_chars = F.col("kept_text"), F.when(whole, F.col("row.n_chars")).otherwise(F.length("kept_text").cast("long"))
    new = {"text": text, "n_chars": n_chars}
    return left.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The word spans that the mix draws, in the order of the draws: a row for each, spans of one epoch that touch in a document
    made one. Null and empty texts are in no span; an empty table gives no row."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("suffix_array_dedup", drop_repeats),
    ("source_mixing", mix_sources),
    ("packing", pack),
]

#: Hashes, tokenizer ids and a learned model have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages, each stage's result written before the next one reads it.

    Null and empty texts have no words to be drawn, so no piece is theirs; an empty table gives no piece.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
