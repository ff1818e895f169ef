"""From raw documents to encoded training data, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridgeline.llm.common import fresh_path, table
from ridgeline.llm.exact_dedup import deduplicated
from ridgeline.llm.mixing import mixed_documents
from ridgeline.llm.ngram_join import one_of_each_group
from ridgeline.llm.quality import good_documents
from ridgeline.llm.tokens import encoded

STAGES = [
    ("quality", good_documents),
    ("exact dedup", deduplicated),
    ("n-gram join", one_of_each_group),
    ("mixing", mixed_documents),
    ("byte BPE", encoded),
]

#: The classifier is fitted by expectation-maximisation and gradient steps, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written to the shared folder and read again.  The last one
    gives the token ids of every row of the mix."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir) if stage is not encoded else stage(spark, docs, sf_dir, ids=True)
        if i < len(STAGES) - 1:
            path = fresh_path(spark, f"stage-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
