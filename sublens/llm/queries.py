"""The contract's queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sublens.llm import (
    audit,
    bpe,
    codes,
    decontaminate,
    jaccard,
    langid,
    line_dedup,
    maxent,
    mixing,
    pii,
    quality,
    suffix,
    toxicity,
)


def _over(digest: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: digest(*[spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in tables])


QUERIES = {
    "op1_lm_scoring": _over(maxent.digest, "documents"),
    "op2_quality_rules": _over(quality.digest, "documents"),
    "op3_language_id": _over(langid.digest, "documents"),
    "op4_suffix_dedup": _over(suffix.digest, "documents"),
    "op5_bpe": _over(bpe.digest, "documents"),
    "op6_line_dedup": _over(line_dedup.digest, "documents"),
    "op7_decontaminate": _over(decontaminate.digest, "documents", "benchmark"),
    "op8_pii": _over(pii.digest, "documents"),
    "op9_jaccard_join": _over(jaccard.digest, "documents"),
    "op10_toxicity": _over(toxicity.digest, "documents", "labels"),
    "op11_vector_codes": _over(codes.digest, "embeddings"),
    "op12_filter_audit": _over(audit.digest, "documents", "labels"),
    "op13_source_mixing": _over(mixing.digest, "documents"),
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op6_line_dedup": line_dedup.ORACLE_SQL,
    "op7_decontaminate": decontaminate.ORACLE_SQL,
    "op9_jaccard_join": jaccard.ORACLE_SQL,
    "op11_vector_codes": codes.ORACLE_SQL,
    "op12_filter_audit": audit.ORACLE_SQL,
    "op13_source_mixing": mixing.ORACLE_SQL,
}
