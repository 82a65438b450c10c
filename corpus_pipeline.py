"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return rows with the
columns of docs, of which they need doc_id and text. The result of a stage is written and read again
before the next, so a lost executor never goes back further than that.
"""

from pyspark.sql import DataFrame, SparkSession

from larder.llm import decontaminate, neardup, packing, quality_rules, secrets
from larder.llm.common import saved, session, table
from larder.llm.queries import BYTE_BPE, CAPACITY, PACK_END, quality_labels


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the trees learn from the labels of docs."""
    session(spark)
    return quality_rules.keep(docs, quality_rules.fit(docs, quality_labels(spark, sf_dir)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    session(spark)
    return neardup.keep(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with the benchmark."""
    return decontaminate.keep(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    session(spark)
    return secrets.mask(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in the sequences."""
    session(spark)
    return packing.pack_documents(docs, BYTE_BPE, "blank", PACK_END, CAPACITY)


STAGES = [("quality rules", quality), ("near-duplicates", near_dedup), ("decontamination", decontamination),
          ("secret scan", secret_scan), ("best-fit packing", best_fit_packing)]

# models, sketches and tokenizers aren't SQL; tests/llm has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs
