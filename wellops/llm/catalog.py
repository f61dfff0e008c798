"""The queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wellops.llm import revisits, url_filter
from wellops.llm.chat_windows import op8_chat_windows
from wellops.llm.decontamination import op2_decontamination
from wellops.llm.embedding_dedup import op1_embedding_dedup
from wellops.llm.embedding_whitening import op13_embedding_whitening
from wellops.llm.language_id import op9_language_id
from wellops.llm.merkle_manifest import op12_merkle_manifest
from wellops.llm.minhash_dedup import op7_minhash_dedup
from wellops.llm.mixing import op4_source_mixing
from wellops.llm.quality import op6_quality
from wellops.llm.token_counts import op11_token_counts
from wellops.llm.token_files import op10_token_files


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_embedding_dedup": op1_embedding_dedup,
        "op2_decontamination": op2_decontamination,
        "op3_revisits": revisits.op3_revisits,
        "op4_source_mixing": op4_source_mixing,
        "op5_url_filter": url_filter.op5_url_filter,
        "op6_quality": op6_quality,
        "op7_minhash_dedup": op7_minhash_dedup,
        "op8_chat_windows": op8_chat_windows,
        "op9_language_id": op9_language_id,
        "op10_token_files": op10_token_files,
        "op11_token_counts": op11_token_counts,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_embedding_whitening": op13_embedding_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_revisits": revisits.ORACLE_SQL, "op5_url_filter": url_filter.ORACLE_SQL}
