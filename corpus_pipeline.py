"""A cleaning pipeline over ``documents``: five stages, each one operator of ``urbanlens.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from urbanlens.llm import decontaminate, packing, pii, simhash, toxicity
from urbanlens.llm.text import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; learned from ``labels`` outside the held-out third."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(toxicity.learnable()))
    return toxicity.drop_toxic(docs, model, 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: three-word shingles, three bits."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of ten words with ``benchmark`` go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data in the texts become their kind in angle brackets."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", redact_personal_data),
    ("packing", pack),
]

#: The stages hash, train and pack; SQL has no such steps. Tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each one's rows are written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{i}")
    return docs
