"""Pair features: 36 comparisons of two records; null is missing evidence, never zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.functions import similarity as sim
from kinloom.functions import tokens
from kinloom.session import ship_package

# The names and order of the features, and of the columns a matcher sees.
FEATURES = [
    "name_token_sort_ratio", "address_token_sort_ratio", "name_levenshtein_ratio", "name_jaro_winkler", "name_token_jaccard", "name_tfidf_cosine",
    "name_char_ngram_similarity", "name_exact", "name_without_suffix_similarity", "name_expanded_similarity", "address_levenshtein",
    "address_edit_distance", "address_token_jaccard", "address_tfidf_cosine", "address_char_similarity", "postal_code_exact", "city_exact",
    "state_exact", "house_number_exact", "country_exact", "address_exact", "name_address_similarity_product", "name_missing", "address_missing",
    "name_missing_left", "name_missing_right", "address_missing_left", "address_missing_right", "name_missing_both", "address_missing_both",
    "postal_missing", "city_missing", "state_missing", "house_number_missing", "name_length_ratio", "address_length_ratio",
]
MODEL_COLUMNS = [
    *FEATURES, "candidate_source", "candidate_rank", "retrieval_score", "name_retrieval_cosine", "address_retrieval_cosine",
    *[f"block_{c}" for c in "ABCDEFG"], "neural_cosine", "neural_rank",
]
_COMPARED = [
    "name_basic", "name_expanded", "name_without_suffix", "address_normalized", "country_key", "postal_code_candidate", "state_candidate",
    "city_candidate", "house_number_zero_normalized", "name_missing", "address_missing",
]


def native_features(a: str, b: str) -> dict[str, Column]:
    """The features that need no UDF, of struct columns a and b."""
    left, right = (lambda c, s=s: F.col(f"{s}.{c}") for s in (a, b))
    both = lambda c: (left(c), right(c))
    word_set = lambda x: F.array_distinct(tokens.words(x))
    out: dict[str, Column] = {}
    for field, column in (("name", "name_basic"), ("address", "address_normalized")):
        x, y = both(column)
        ratio = sim.edit_ratio(x, y)
        out["name_levenshtein_ratio" if field == "name" else "address_levenshtein"] = ratio
        out[f"{field}_token_jaccard"] = sim.set_jaccard(word_set(x), word_set(y))
        out["name_char_ngram_similarity" if field == "name" else "address_char_similarity"] = sim.set_jaccard(tokens.grams(x), tokens.grams(y))
        out[f"{field}_exact"] = sim.exact(x, y)
        out[f"{field}_length_ratio"] = sim.length_ratio(x, y)
        gone, lacks = both(f"{field}_missing")
        out[f"{field}_missing"] = F.greatest(gone, lacks)
        out[f"{field}_missing_left"], out[f"{field}_missing_right"] = gone, lacks
        out[f"{field}_missing_both"] = F.least(gone, lacks)
    out["name_address_similarity_product"] = out["name_levenshtein_ratio"] * out["address_levenshtein"]
    out["address_edit_distance"] = sim.edit_distance(*both("address_normalized"))
    out["country_exact"] = sim.exact(*both("country_key"))
    for name in ("name_without_suffix", "name_expanded"):
        out[f"{name}_similarity"] = sim.edit_ratio(*both(name))
    for stem, column in (("postal", "postal_code_candidate"), ("city", "city_candidate"), ("state", "state_candidate"), ("house_number", "house_number_zero_normalized")):
        x, y = both(column)
        out["postal_code_exact" if stem == "postal" else f"{stem}_exact"] = sim.exact(x, y)
        out[f"{stem}_missing"] = ((x == "") | (y == "")).cast("int")
    return out


def pair_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """pairs (q, r, cosines and the pair columns) with all 36 features."""
    ship_package(pairs.sparkSession)
    side = lambda s: records.select(F.col("rid").alias(s), F.struct(*_COMPARED).alias(f"{s}_record"))
    joined = pairs.join(side("q"), "q").join(side("r"), "r")
    udf = {
        "name_token_sort_ratio": sim.token_sort_ratio("q_record.name_basic", "r_record.name_basic"),
        "address_token_sort_ratio": sim.token_sort_ratio("q_record.address_normalized", "r_record.address_normalized"),
        "name_jaro_winkler": sim.jaro_winkler("q_record.name_basic", "r_record.name_basic"),
    }
    passed = {"name_tfidf_cosine": F.col("name_retrieval_cosine"), "address_tfidf_cosine": F.col("address_retrieval_cosine")}
    every = {**native_features("q_record", "r_record"), **udf, **passed}
    return joined.withColumns({n: every[n] for n in FEATURES}).drop("q_record", "r_record")


def prototype_features(a: str, b: str) -> dict[str, Column]:
    """Ten features for small candidate sets; similarity by matching blocks."""
    left, right = (lambda c, s=s: F.col(f"{s}.{c}") for s in (a, b))
    words = lambda x: F.array_distinct(tokens.words(x))
    out = {f"{n}_similarity": sim.block_ratio(left(c), right(c)) for n, c in (("name", "name_basic"), ("name_expanded", "name_expanded"), ("name_without_suffix", "name_without_suffix"), ("address", "address_normalized"))}
    out["name_token_jaccard"] = sim.set_jaccard(words(left("name_without_suffix")), words(right("name_without_suffix")))
    out["address_token_jaccard"] = sim.set_jaccard(words(left("address_normalized")), words(right("address_normalized")))
    out["address_missing_left"], out["address_missing_right"] = left("address_missing"), right("address_missing")
    out["country_equal"] = sim.exact(left("country_key"), right("country_key"))
    out["house_number_equal"] = sim.exact(left("house_number_zero_normalized"), right("house_number_zero_normalized"))
    return out
