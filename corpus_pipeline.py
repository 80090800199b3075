"""The corpus pipeline: documents to packed sequences.

Each stage takes the documents that its predecessor kept and returns them with their columns; the last returns
the place of every piece. The stages learn and look up in tables beside the documents: ``labels``
(toxicity) and ``benchmark`` (decontamination).

1. toxicity: documents predicted toxic go.
2. near duplicates: one document of each group stays.
3. decontamination: documents of which a twentieth is benchmark text go.
4. personal data: spans are replaced by their kind, and ``n_chars`` follows.
5. packing: the rest is tokenized, cut and packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daygrid.llm import decontaminate, neardup, packing, pii, toxicity
from daygrid.llm.queries import tokenizer_path
from daygrid.sizing import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.accepted(docs, toxicity.fitted(docs.select("doc_id", "text"), labels))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs, pii.fitted(docs.select("doc_id", "text")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", without_copies),
    ("decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("packing", packed),
]

# Models and searches have no SQL form; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the whole table of documents; what lies between is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
