"""From documents to a balanced, mixed, clean corpus in five stages.

Every stage gets the documents that its predecessor kept, as a table, and returns the
rows it keeps with the columns of ``documents``; the last one returns the shard manifest
of what is left (one row per document of the mix). ``run`` writes each stage's rows as
Parquet in the cluster's shared folder and reads them back for the next.

Defined cases: as in the operators; a null text passes every stage as an empty one, an
empty table passes as an empty table, and other columns are carried along. Toxicity is
learned from the ``labels`` of the documents that reach the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.llm.common import stored, table
from contrail.llm.decontamination import uncontaminated
from contrail.llm.mixing import mixed_documents
from contrail.llm.sharding import shard_manifest
from contrail.llm.simhash import one_of_each
from contrail.llm.toxicity import clean_documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the noisy-or model predicts toxic."""
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash component (3-word shingles, 3 bits)."""
    return one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it (0, 1 or 2 times)."""
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix, by equal bytes."""
    return shard_manifest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Toxicity, XXH64 fingerprints and the edit-distance search have no SQL form; the tests
# hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
