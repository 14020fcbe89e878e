"""From raw documents to packed token rows: five stages, each a table that the next one reads."""

from leakwatch.llm import decontaminate, mixing, packing, quality, simhash
from leakwatch.llm.text import staged


def quality_rules(spark, docs, sf_dir):
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def near_dedup(spark, docs, sf_dir):
    """One document, the one with the least id, of each class of near-duplicates."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark, docs, sf_dir):
    """Documents without a notable share of benchmark passages."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def token_packing(spark, docs, sf_dir):
    """Packed rows of token ids."""
    return packing.packed_rows(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("decontamination", decontamination),
    ("source mixing", source_mixing),
    ("token packing", token_packing),
]

# Fingerprints and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over `documents`; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
