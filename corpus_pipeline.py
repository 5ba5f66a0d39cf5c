"""The corpus pipeline: documents through language ID, near-duplicate removal,
repeated-passage removal, decontamination and source mixing.

Defined results: null, empty and letterless texts go in the first stage; a null label gets
the predicted language; null and repeated ids are rows of their own, and where ids don't
tell rows apart the stored order decides which copy stays; of equal texts the least id
stays; very long texts are read whole; other columns are kept, whatever their names, but
for those of the mix (size, source_size, target, copies, taken); empty tables give an
empty result.  The result has a row for each document that the mix takes, with its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from understory.llm import decontaminate, langid, mixing, ngram_join, passages
from understory.llm.common import saved

#: (name, function): each takes (spark, docs, sf_dir); its result is written and read again for the next.
STAGES = [
    ("language_id", langid.stage),
    ("ngram_join", ngram_join.stage),
    ("passage_dedup", passages.stage),
    ("decontamination", decontaminate.stage),
    ("mixing", mixing.stage),
]

#: Cross-parsing, fuzzy chains and weighted sampling keys have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
