"""Corpus preparation in five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept and
returns the columns of documents (the last: the packed pieces).  ``run`` writes
every stage as Parquet into the shared folder and reads it again, which cuts the
lineage and lets a lost executor cost one stage at most.

Decisions are taken row by row: a stage that filters numbers its rows, has the
operator judge them under these numbers, and leaves out those rejected.  Ids may
be null, repeat, or stand for different texts.  Empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import best_fit, decontaminate, jaccard_join, pii, quality_mcd
from cartwheel.llm.queries import tokenizer
from cartwheel.llm.ship import ship
from cartwheel.session import ensure_checkpoint_dir, scratch_path, stage

ROW = "_pipeline_row"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written once, with a number for every row."""
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def _judged(rows: DataFrame) -> DataFrame:
    """What an operator sees: the rows' numbers as ids."""
    return rows.withColumn("doc_id", F.col(ROW))


def _without(rows: DataFrame, rejected: DataFrame, name: str) -> DataFrame:
    """``rows`` but those whose number is a ``doc_id`` of ``rejected``."""
    rejected = stage(rejected.select(F.col("doc_id").alias(ROW)).distinct(), name)
    return rows.join(rejected, ROW, "left_anti").drop(ROW)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the quality rules reject: texts that fail the base rules (null
    and empty ones too) and outliers of their language and source."""
    ship(spark)
    rows = _numbered(docs)
    return _without(rows, quality_mcd.quality_rules(_judged(rows)).where("NOT kept"), "rejected")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies, that of smallest id (rows without
    one last, then the first); texts without words are no copies of each other."""
    ship(spark)
    rows = _numbered(docs)
    groups = jaccard_join.jaccard_components(_judged(rows)).select(F.col("doc_id").alias(ROW), F.col("component_id").alias("group"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", ROW))
    members = stage(rows.select(ROW, "doc_id").join(groups, ROW), "members")
    kept = members.groupBy("group").agg(first.alias("first")).select(F.col("first")[ROW].alias("doc_id"))
    copies = members.select(F.col(ROW).alias("doc_id")).join(kept, "doc_id", "left_anti")
    return _without(rows, copies, "copies")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects rows that hold a benchmark item; null and empty texts hold none."""
    ship(spark)
    rows = _numbered(docs)
    return _without(rows, decontaminate.leaks(_judged(rows), spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "leaks")


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and secrets in the texts; ``n_chars`` follows."""
    ship(spark)
    out = pii.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenizes and packs what is left; a null text is empty, and packed as its end."""
    ship(spark)
    return best_fit.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the estimates, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        path = scratch_path(spark, name)
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
