"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of documents; the last
returns the packed pieces. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import mixing, near_duplicates, packing, substrings, toxicity
from cohortlake.llm.common import table
from cohortlake.llm.queries import tokenizer
from cohortlake.sources.workspace import materialise

#: SQL has no ordinal regression, hashed signatures or tokenizer; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an expected severity grade below one half."""
    judged = toxicity.judge(docs, table(spark, sf_dir, "labels"))
    return judged.where(~F.col("rejected")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the smallest id."""
    return near_duplicates.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that repeat an earlier window; a document may be left empty but stays."""
    kept = substrings.drop_repeats(docs)
    changed = {"text": F.col("kept_text"), "n_chars": F.coalesce(F.length("kept_text"), F.lit(0)).cast("long")}
    return kept.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, in whole copies: ``taken / size`` rounded, 0 to 2."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), "doc_id", "text", "source")
    mixed = mixing.mix(rows, keep=["row"])
    copies = F.round(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    return mixed.where(copies > 0).select("row", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each copy goes."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeated_passages),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
