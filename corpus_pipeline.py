"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again by the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickfold.llm.chosen_path import near_duplicates
from tickfold.llm.common import settled, table, words, written
from tickfold.llm.quality_rules import passing
from tickfold.llm.queries import POWERS, SAMPLE_SHARE, packed_documents
from tickfold.llm.raking import form_topic, mix
from tickfold.llm.secret_scan import masked, with_spans

#: The stages after the first are joins of sampled or clustered sets: no SQL for the whole.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    return passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates, five-word shingles at 0.8.
    Documents with a null id match nothing and stay."""
    found = near_duplicates(docs, width=5, percent=80)
    kept = found.where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionAll(docs.where("doc_id IS NULL"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked and ``n_chars`` counted again where it is."""
    found = settled(with_spans(docs), clean=masked(F.col("row.text"), F.col("found")))
    count = F.length("clean").cast(docs.schema["n_chars"].dataType)
    changed = {
        "text": F.col("clean"),
        "n_chars": F.when(F.size("found") > 0, count).otherwise(F.col("row.n_chars")),
    }
    return found.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that the tokens of sources, languages and forms meet the targets."""
    counted = docs.select(
        "doc_id",
        "source",
        "lang",
        form_topic(F.col("text")).alias("topic"),
        F.size(words(F.col("text"))).alias("n_tokens"),
        F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("row"),
    )
    return mix(counted, POWERS, carry="row", share=SAMPLE_SHARE).where("sampled").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, as token ids, with their place in sequences of several lengths."""
    return packed_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("mixture", mixture),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
