"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dirlens.llm import line_dedup, mixing, near_dedup, substring_dedup, tool_calls
from dirlens.llm.audio import op1_audio_features
from dirlens.llm.decontaminate import op4_decontaminate
from dirlens.llm.html_extract import op10_html_extraction
from dirlens.llm.language_id import op5_language_id
from dirlens.llm.line_dedup import op3_line_dedup
from dirlens.llm.mixing import op2_temperature_mixing
from dirlens.llm.near_dedup import op6_minhash_near_dedup
from dirlens.llm.quality import op8_quality_classifier
from dirlens.llm.substring_dedup import op9_substring_dedup
from dirlens.llm.tool_calls import op7_chat_tool_calls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_audio_features,
        op2_temperature_mixing,
        op3_line_dedup,
        op4_decontaminate,
        op5_language_id,
        op6_minhash_near_dedup,
        op7_chat_tool_calls,
        op8_quality_classifier,
        op9_substring_dedup,
        op10_html_extraction,
    )
}

SQL: dict[str, str] = {
    "op2_temperature_mixing": mixing.SQL,
    "op7_chat_tool_calls": tool_calls.SQL,
    "op3_line_dedup": line_dedup.SQL,
    "op6_minhash_near_dedup": near_dedup.SQL,
    "op9_substring_dedup": substring_dedup.SQL,
}
