"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from phenoloom.llm.chat_format import OP4_SQL, op4_chat_format
from phenoloom.llm.decontaminate import op5_decontaminate
from phenoloom.llm.hard_negatives import op12_hard_negatives
from phenoloom.llm.language_id import op9_language_id
from phenoloom.llm.line_dedup import OP2_SQL, op2_line_dedup
from phenoloom.llm.packing import op8_packing
from phenoloom.llm.quality import OP7_SQL, op7_quality_hosts
from phenoloom.llm.quality_cnn import op11_quality_cnn
from phenoloom.llm.secret_scan import op3_secret_scan
from phenoloom.llm.simhash import op6_simhash
from phenoloom.llm.token_alignment import op13_token_alignment
from phenoloom.llm.token_files import op10_token_orc
from phenoloom.llm.toxicity import op1_toxicity


def _over(operator: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return operator(*[spark.read.parquet(f"{folder}/{t}.parquet") for t in tables])

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": _over(op1_toxicity, "documents", "labels"),
        "op2_line_dedup": _over(op2_line_dedup, "documents"),
        "op3_secret_scan": _over(op3_secret_scan, "documents"),
        "op4_chat_format": _over(op4_chat_format, "conversations"),
        "op5_decontaminate": _over(op5_decontaminate, "documents", "benchmark"),
        "op6_simhash": _over(op6_simhash, "documents"),
        "op7_quality_hosts": _over(op7_quality_hosts, "documents"),
        "op8_packing": _over(op8_packing, "documents"),
        "op9_language_id": _over(op9_language_id, "documents"),
        "op10_token_orc": _over(op10_token_orc, "documents"),
        "op11_quality_cnn": _over(op11_quality_cnn, "documents", "labels"),
        "op12_hard_negatives": _over(op12_hard_negatives, "embeddings"),
        "op13_token_alignment": _over(op13_token_alignment, "documents"),
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2_SQL, "op4_chat_format": OP4_SQL, "op7_quality_hosts": OP7_SQL}
