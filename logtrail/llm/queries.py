"""The registered queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logtrail.llm import bpe, collision_join, cover_dedup, cover_tree, decontaminate, dialogue_repair, fill_middle, language, licenses, odd_sketch, suffix_dedup, surrogates, toxicity
from logtrail.llm.common import table
from logtrail.llm.oracles import ORACLES  # noqa: F401  (read by the entry module)
from logtrail.session import configure

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def _over(operator: Callable[..., DataFrame], *tables: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*(table(configure(spark), sf_dir, name) for name in tables))

    REGISTRY[operator.__name__] = run


_over(toxicity.op1_toxicity, "documents", "labels")
_over(licenses.op2_license_scan, "documents")
_over(surrogates.op5_surrogates, "documents")
_over(language.op6_language_id, "documents")
_over(odd_sketch.op8_odd_sketch, "documents")
_over(bpe.op9_byte_bpe, "documents")
_over(cover_dedup.op10_cover_dedup, "documents")
_over(cover_tree.op7_cover_tree, "embeddings")
_over(decontaminate.op4_decontaminate, "documents", "benchmark")
_over(suffix_dedup.op3_suffix_dedup, "documents")
_over(fill_middle.op12_fill_middle, "documents")
_over(dialogue_repair.op13_dialogue_repair, "conversations")
_over(collision_join.op11_collision_join, "embeddings")
