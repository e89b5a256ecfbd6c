"""The scalar helpers as SQL functions of a session. Spark inlines their SQL bodies, so no Python runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from skytally.functions.numeric import RING_SIZE
from skytally.functions.text import SENTENCE_DELIMITERS

_VECTOR = "ARRAY<STRUCT<user_index: BIGINT, rating: INT>>"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_functions(spark: SparkSession) -> None:
    """Create the temporary functions ``tokenize_sentence``, ``ring_position`` and ``calculate_similarity``."""
    norm = "sqrt(aggregate({0}, 0D, (s, e) -> s + e.rating * e.rating))".format
    definitions = {
        "tokenize_sentence(text STRING) RETURNS ARRAY<STRING>":
            f"filter(split(text, {_literal(SENTENCE_DELIMITERS)}), w -> w <> '')",
        "ring_position(key STRING) RETURNS BIGINT":
            f"CAST(conv(substr(md5(key), 1, 8), 16, 10) AS BIGINT) % {RING_SIZE}",
        f"calculate_similarity(first {_VECTOR}, second {_VECTOR}) RETURNS DOUBLE":
            "try_divide(aggregate(second, 0D, (s, e) -> s + e.rating * "
            "coalesce(try_element_at(map_from_entries(first), e.user_index), 0)), "
            f"{norm('first')} * {norm('second')})",
    }
    for signature, body in definitions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
