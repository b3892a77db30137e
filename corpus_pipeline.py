"""From raw documents to a training mix, as stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm import contamination, jaccard, mixing, substrings, toxicity
from tidemill.llm.common import fold, table
from tidemill.session import scratch_path

TOXIC_FROM = 0.3  # scores from here on are rejected
MIX_COLUMNS = ("size", "source_size", "target", "taken")
_SCORE = "_toxicity_of_this_text"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar scores as toxic go; labels are learned from the folds of the query."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), keep=fold(F.col("doc_id"), 4) != 2)
    return toxicity.with_score(docs, model, _SCORE).where(F.col(_SCORE) < TOXIC_FROM).drop(_SCORE)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that occur earlier are cut; a document without any stays as it is."""
    rows = substrings.remove_repeats(docs, with_text=True)
    new = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint")).otherwise(F.col("doc.n_chars"))
    return rows.select(*(new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words of: their columns, with size, target of the source and words taken (these
    replace columns of the same names)."""
    rows = mixing.mix(docs, carry=True).where("taken > 0")
    own = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c.lower() not in MIX_COLUMNS]
    return rows.select(*own, *MIX_COLUMNS)


STAGES = [
    ("toxicity", without_toxic), ("near_copies", without_near_copies), ("substrings", without_repeated_passages),
    ("decontamination", without_benchmark), ("mixing", mixed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
