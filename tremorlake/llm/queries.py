"""The registered queries of the corpus operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tremorlake.llm.bytepair import op7_byte_bpe
from tremorlake.llm.common import ship
from tremorlake.llm.fertility import op10_quality_rules
from tremorlake.llm.lines import OP3_SQL, op3_line_dedup
from tremorlake.llm.maxent import op11_maxent
from tremorlake.llm.mixing import OP1_SQL, op1_mixing
from tremorlake.llm.neighbours import op5_nearest
from tremorlake.llm.quality import op6_quality
from tremorlake.llm.resampling import op13_resampling
from tremorlake.llm.secrets import op8_secrets
from tremorlake.llm.simhash import op9_simhash
from tremorlake.llm.substrings import OP2_SQL, op2_substring_dedup
from tremorlake.llm.tokens import op4_token_counts
from tremorlake.llm.whitening import op12_whitening

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _shipped(query)
    for query in (
        op1_mixing,
        op2_substring_dedup,
        op3_line_dedup,
        op4_token_counts,
        op5_nearest,
        op6_quality,
        op7_byte_bpe,
        op8_secrets,
        op9_simhash,
        op10_quality_rules,
        op11_maxent,
        op12_whitening,
        op13_resampling,
    )
}

ORACLES: dict[str, str] = {"op1_mixing": OP1_SQL, "op2_substring_dedup": OP2_SQL, "op3_line_dedup": OP3_SQL}
