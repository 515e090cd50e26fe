"""The registered queries of this subpackage and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landstat.llm.bpe import op10_byte_bpe
from landstat.llm.decontaminate import OP6_SQL, op6_decontaminate
from landstat.llm.fingerprint import op7_fingerprints
from landstat.llm.htmltext import op9_html_text
from landstat.llm.licenses import op3_licenses
from landstat.llm.linededup import OP5_SQL, op5_line_dedup
from landstat.llm.lmscore import op2_lm_score
from landstat.llm.packing import op11_packing
from landstat.llm.quality import op8_quality
from landstat.llm.simhash import op1_simhash
from landstat.llm.spelling import op12_spelling
from landstat.llm.toxicity import op4_toxicity
from landstat.llm.trie import op13_prefix_trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_lm_score,
        op3_licenses,
        op4_toxicity,
        op5_line_dedup,
        op6_decontaminate,
        op7_fingerprints,
        op8_quality,
        op9_html_text,
        op10_byte_bpe,
        op11_packing,
        op12_spelling,
        op13_prefix_trie,
    )
}
ORACLE_SQL: dict[str, str] = {"op5_line_dedup": OP5_SQL, "op6_decontaminate": OP6_SQL}
