"""Threshold sweep, submissions and their audit."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.functions.similarity import f_half
from kinloom.operators.labeling import require_none


def checked_thresholds(thresholds: list[float]) -> list[float]:
    if not thresholds or any(not math.isfinite(t) or not 0 <= t <= 1 for t in thresholds):
        raise ValueError("thresholds must lie in [0, 1]")
    return sorted(set(thresholds))


def f_half_sweep(labels: DataFrame, scored: DataFrame, thresholds: list[float]) -> DataFrame:
    """(threshold, country, queries, macro_f05); country is null in the row over all queries.

    labels: sid, country, true_links. scored: sid, label, p. Queries without pairs and missed
    matches count. Each pair goes into the histogram of its thresholds once; the counts of
    a query at a threshold are sums over higher bins, so pairs are not repeated."""
    steps = checked_thresholds(thresholds)
    # Bin k: p reaches thresholds 0 to k - 1.
    reached = sum((F.when(F.col("p") >= t, 1).otherwise(0) for t in steps), F.lit(0))
    bins = scored.withColumn("reached", reached).groupBy("sid", "reached").agg(F.sum("label").alias("tp"), F.count("*").alias("predicted"))
    listed = bins.groupBy("sid").agg(F.collect_list(F.struct("reached", "tp", "predicted")).alias("bins"))  # at most one for each bin
    total = lambda field: lambda t: F.aggregate(F.filter("bins", lambda b: b["reached"] > t), F.lit(0).cast("long"), lambda s, b: s + b[field])
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.lit(t).alias("threshold")) for i, t in enumerate(steps)])).alias("s")
    each = labels.select("sid", "country", F.col("true_links").alias("truth")).join(listed, "sid", "left").select("country", "truth", "bins", at).select("country", "truth", "bins", "s.*")
    counted = each.withColumns({"tp": F.coalesce(total("tp")(F.col("at")), F.lit(0)), "predicted": F.coalesce(total("predicted")(F.col("at")), F.lit(0))})
    value = counted.withColumn("f", f_half(F.col("tp"), F.col("predicted"), F.col("truth")))
    return value.groupingSets([["threshold"], ["threshold", "country"]], "threshold", "country").agg(F.count("*").alias("queries"), F.avg("f").alias("macro_f05"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """One row: the greatest macro F0.5 over all queries, ties to the higher threshold."""
    return sweep.where("country IS NULL").select("threshold", "macro_f05").orderBy(F.desc("macro_f05"), F.desc("threshold")).limit(1)


def check_probabilities(pairs: DataFrame, probabilities: DataFrame) -> DataFrame:
    """probabilities, if they cover exactly the pairs, once each, with numbers in [0, 1]."""
    key = ["source1_entity_id", "candidate_entity_id"]
    p = F.col("match_probability")
    require_none(probabilities.where(p.isNull() | F.isnan(p) | (p < 0) | (p > 1)), "probability outside [0, 1]")
    require_none(probabilities.groupBy(*key).count().where("count > 1"), "pair with several probabilities")
    left, right = pairs.select(*key).withColumn("__pair", F.lit(1)), probabilities.select(*key).withColumn("__given", F.lit(1))
    require_none(left.join(right, key, "full").where("__pair IS NULL OR __given IS NULL"), "pairs and probabilities differ")
    return probabilities


def match_lists(queries: DataFrame, probabilities: DataFrame, threshold: float) -> DataFrame:
    """(rid, source1_entity_id, matched_entity_ids): all queries, ids sorted and joined by commas.

    queries: rid, source1_entity_id."""
    checked_thresholds([threshold])
    chosen = probabilities.where(F.col("match_probability") >= threshold).groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_list("candidate_entity_id")), ",").alias("ids"))
    return queries.select("rid", "source1_entity_id").join(chosen, "source1_entity_id", "left").select("rid", "source1_entity_id", F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))


def candidate_lists(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """(rid, source1_entity_id, candidate_entity_ids): all queries, ids by rank."""
    ranked = F.array_sort(F.collect_list(F.struct("candidate_rank", "candidate_entity_id")))
    listed = pairs.groupBy("source1_entity_id").agg(F.array_join(F.transform(ranked, lambda x: x["candidate_entity_id"]), ",").alias("ids"), F.count("*").alias("found"))
    joined = queries.join(listed, "source1_entity_id", "left")
    if "n_candidates" in queries.columns:
        require_none(joined.where(F.coalesce("found", F.lit(0)) != F.col("n_candidates")).select("source1_entity_id", "found", "n_candidates"), "candidates differ from the manifest")
    return joined.select("rid", "source1_entity_id", F.coalesce("ids", F.lit("")).alias("candidate_entity_ids"))


def audit(queries: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """What is wrong with a submission; empty if nothing.

    All three have source1_entity_id and a position rid: the same queries at the same places, ids
    without repeats, matches among the candidates."""
    of = lambda df, tag, *more: df.select("rid", F.col("source1_entity_id").alias(tag), *more)
    joined = of(queries, "sid").join(of(matches, "of_matches", "matched_entity_ids"), "rid", "full").join(of(candidates, "of_candidates", "candidate_entity_ids"), "rid", "full")
    ids = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), ","), lambda x: x != "")
    m, c = ids("matched_entity_ids"), ids("candidate_entity_ids")
    repeated = lambda x: F.size(x) != F.size(F.array_distinct(x))
    problem = (
        F.when(F.col("sid").isNull() | F.col("of_matches").isNull() | F.col("of_candidates").isNull(), "not in all tables")
        .when((F.col("sid") != F.col("of_matches")) | (F.col("sid") != F.col("of_candidates")), "other query at this place")
        .when(repeated(m) | repeated(c), "repeated id")
        .when(F.size(F.array_except(m, c)) > 0, "match outside the candidates")
    )
    return joined.withColumn("problem", problem).where("problem IS NOT NULL").select("rid", "sid", "problem")


def require_clean_audit(queries: DataFrame, matches: DataFrame, candidates: DataFrame) -> None:
    require_none(queries.agg(F.count("*").alias("n")).where("n = 0"), "no query")
    require_none(audit(queries, matches, candidates), "submission")
