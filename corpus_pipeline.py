"""The training-data pipeline: STAGES in order, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm.common import materialise
from tessera.llm.decontaminate import mark_contaminated
from tessera.llm.jaccard_join import keep_one_of_each
from tessera.llm.langid import fit, held_out, identify
from tessera.llm.packing import pack_documents
from tessera.llm.quality import judge
from tessera.sources.tables import table


def drop_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier rejects go."""
    model = fit(docs, ~held_out() & F.col("doc_id").isNotNull())
    return identify(docs, model, out="__language").where("not __language.rejected").select(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return judge(docs, labels, out="__judged").where("__judged.kept").select(*docs.columns)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar n-gram sets stays: that of the least id."""
    return keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    marked = mark_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), prefix="__decon_")
    return marked.where(F.size("__decon_hits") == 0).select(*docs.columns)


def pack_best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: a row per piece with its sequence and place there."""
    return pack_documents(docs)


STAGES = [
    ("language ID", drop_unknown_languages),
    ("quality classifier", drop_low_quality),
    ("n-gram Jaccard join", join_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_best_fit),
]

#: The stages hold trained models and a search over token ids, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{number}")
    return docs
