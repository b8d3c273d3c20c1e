"""Schemas of the linkage tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, FLOAT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()


def _of(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


RAW_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
RECORD_TEXTS = [
    "country_key", "name_basic", "name_expanded", "name_without_suffix", "name_latin_folded", "address_normalized", "address_latin_folded",
    "postal_code_candidate", "state_candidate", "city_candidate", "house_number_zero_normalized",
]
RECORD = _of(("rid", LONG), ("entity_id", STRING), ("source", INT), *[(c, STRING) for c in RECORD_TEXTS], ("name_missing", INT), ("address_missing", INT))
CHANNELS = "ABCDEFG"
PAIR = _of(
    ("source1_entity_id", STRING), ("candidate_entity_id", STRING), ("candidate_source", INT), ("candidate_rank", INT),
    ("retrieval_score", FLOAT), ("name_retrieval_cosine", FLOAT), ("address_retrieval_cosine", FLOAT),
    *[(f"block_{c}", INT) for c in CHANNELS], ("neural_cosine", FLOAT), ("neural_rank", INT),
)
PROBABILITY = _of(("source1_entity_id", STRING), ("candidate_entity_id", STRING), ("match_probability", DOUBLE))
