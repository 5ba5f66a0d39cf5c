"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from understory.llm import decontaminate, embeddings, langid, licenses, mixing, ngram_join, passages, quality, urlfilter, warc


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": langid.op1_language_id,
        "op2_passage_dedup": passages.op2_passage_dedup,
        "op3_mixing": mixing.op3_mixing,
        "op4_quality": quality.op4_quality,
        "op5_warc": warc.op5_warc,
        "op6_ngram_join": ngram_join.op6_ngram_join,
        "op7_license_scan": licenses.op7_license_scan,
        "op8_embedding_dedup": embeddings.op8_embedding_dedup,
        "op9_url_filter": urlfilter.op9_url_filter,
        "op10_decontamination": decontaminate.op10_decontamination,
        "pipeline": pipeline,
        "url_aliases": urlfilter.url_aliases,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_warc": warc.OP5_SQL,
        "op6_ngram_join": ngram_join.OP6_SQL,
        "op8_embedding_dedup": embeddings.OP8_SQL,
        "op9_url_filter": urlfilter.OP9_SQL,
        "url_aliases": urlfilter.ALIASES_SQL,
        "op10_decontamination": decontaminate.OP10_SQL,
    }
