"""The whole linkage: raw sources to audited match lists."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.config import BoostingConfig, DenseConfig, MatcherConfig, PrepConfig
from kinloom.functions import hashing, tokens
from kinloom.functions.normalize import clean_records
from kinloom.operators import blocking, evaluation, features, knn, labeling, matcher, tfidf
from kinloom.plans.manifest import Manifest, code_digest
from kinloom.session import shared_folder, staged
from kinloom.sources import files, tables


@dataclass
class Prepared:
    """What candidate generation leaves: numbered records, pairs with features, a row for each query."""

    records: DataFrame
    pairs: DataFrame
    queries: DataFrame


def hashed_encoder(records: DataFrame, dimension: int = 64) -> DataFrame:
    """records with an `embedding`: signed sums of hashed 3-grams of the encoder text.

    Stands in where no trained encoder is at hand; any `embedding` column can replace it."""
    marked = records.select("rid", F.explode(tokens.grams(tokens.encoder_text())).alias("g"))
    h = F.xxhash64("g")
    cells = marked.select("rid", F.pmod(h, F.lit(dimension)).cast("int").alias("cell"), F.when(h.bitwiseAND(F.lit(1 << 40)) > 0, 1.0).otherwise(-1.0).alias("x"))
    summed = cells.groupBy("rid", "cell").agg(F.sum("x").alias("x")).groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("cell", "x"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(dimension - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)))
    return records.join(summed, "rid", "left").withColumn("embedding", F.coalesce(F.when(F.col("m").isNotNull(), dense), F.array_repeat(F.lit(0.0), dimension))).drop("m")


def read_records(spark: SparkSession, root: str, split: str) -> DataFrame:
    """Cleaned, numbered records of all three sources."""
    raw = [tables.read_source(spark, root, split, n) for n in (1, 2, 3)]
    return staged(clean_records(tables.numbered_records(raw)), f"records-{split}")


def fit_terms(records: DataFrame, config: PrepConfig) -> tfidf.TfidfModel:
    """Term weights from the references of the training sources."""
    references = blocking.with_texts(records.where("source IN (2, 3)")).select("rid", *blocking.TEXT_FIELDS)
    return tfidf.fit_tfidf(references, blocking.TEXT_FIELDS, tfidf.hashed_terms(config.hash_bits))


def prepare(records: DataFrame, model: tfidf.TfidfModel, config: PrepConfig, dense: DenseConfig | None = None) -> Prepared:
    """Candidates and features; with `dense`, also by nearest neighbours of records' embeddings."""
    neural = None
    if dense:
        records = records if "embedding" in records.columns else staged(hashed_encoder(records), "encoded")
        neural = staged(knn.neighbours(records.select("rid", "source", "country_key", "embedding"), dense), "neighbours")
    pairs, queries = blocking.candidates(records, model, config, neural)
    described = features.pair_features(pairs, records)
    if dense:  # every pair gets its cosine, not only those of the channel
        vectors = knn.units(records.select("rid", "embedding"))
        side = lambda s: vectors.select(F.col("rid").alias(s), F.col("embedding").alias(f"{s}_vector"))
        both = described.join(side("q"), "q").join(side("r"), "r")
        described = both.withColumn("neural_cosine", knn.dot(F.col("q_vector"), F.col("r_vector"))).drop("q_vector", "r_vector")
    return Prepared(records, staged(described, "features"), staged(queries, "queries"))


def label(prepared: Prepared, truth: DataFrame, config: PrepConfig) -> tuple[DataFrame, DataFrame]:
    """Labelled pairs and a row for each query with its links."""
    sids = prepared.queries.select(F.col("source1_entity_id").alias("sid"), "country", "n_candidates")
    labeling.check_truth(sids, truth, prepared.records.where("source IN (2, 3)"))
    splits = staged(labeling.query_splits(sids, truth, config), "splits")
    labeled = staged(labeling.label_pairs(prepared.pairs, truth, splits), "labeled")
    return labeled, staged(labeling.query_labels(sids, truth, splits, labeled), "query-labels")


def validate(model: PipelineModel, labeled: DataFrame, labels: DataFrame, thresholds: tuple[float, ...]) -> tuple[DataFrame, float]:
    """The sweep over validation queries and its best threshold (a tuned score, not a final one)."""
    held = labels.where("dataset_split = 'validation'")
    if not held.head(1):
        raise ValueError("no validation queries")
    own = labeled.where("dataset_split = 'validation'")
    scored = matcher.predict(model, own).join(own.select("source1_entity_id", "candidate_entity_id", "label"), ["source1_entity_id", "candidate_entity_id"])
    sweep = staged(evaluation.f_half_sweep(held, scored.select(F.col("source1_entity_id").alias("sid"), F.col("label").cast("long").alias("label"), F.col("match_probability").alias("p")), list(thresholds)), "sweep")
    return sweep, evaluation.best_threshold(sweep).first()["threshold"]


def predicted(model: PipelineModel, pairs: DataFrame) -> DataFrame:
    """Probabilities that carry the fingerprint of the model they come from."""
    return staged(matcher.predict(model, pairs).withColumn("model_sha", F.lit(matcher.fingerprint(model))), "probabilities")


def require_model(probabilities: DataFrame, model_sha: str) -> DataFrame:
    """probabilities, if all of them come from that model."""
    labeling.require_none(probabilities.where(~F.col("model_sha").eqNullSafe(model_sha)).select("model_sha"), "probability of another model")
    return probabilities.drop("model_sha")


def submit(model: PipelineModel, prepared: Prepared, threshold: float, probabilities: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Audited match and candidate lists of all queries; probabilities made earlier must be this model's."""
    given = predicted(model, prepared.pairs) if probabilities is None else probabilities
    probabilities = evaluation.check_probabilities(prepared.pairs, require_model(given, matcher.fingerprint(model)))
    queries = prepared.queries.withColumnRenamed("q", "rid")
    matches = staged(evaluation.match_lists(queries, probabilities, threshold), "matches")
    listed = staged(evaluation.candidate_lists(queries, prepared.pairs), "candidate-lists")
    official = prepared.records.where("source = 1").select("rid", F.col("entity_id").alias("source1_entity_id"))
    evaluation.require_clean_audit(official, matches, listed)
    return matches, listed


def signature(*configs: object) -> str:
    """Tells runs of other settings apart."""
    return hashlib.sha256(json.dumps([asdict(c) for c in configs], sort_keys=True).encode()).hexdigest()


def run(spark: SparkSession, root: str, out: str, prep: PrepConfig, trees: MatcherConfig | BoostingConfig, dense: DenseConfig | None = None) -> dict:
    """Train on the train files below root, match the test files, write both under out.

    A run that was broken off goes on after its last finished stage; a finished one is not run again. Inputs, settings
    or code that changed since are an error."""
    configs = {"preparation": prep, "matcher": trees, **({"dense": dense} if dense else {})}
    done = Manifest(spark, out, {**{k: asdict(c) for k, c in configs.items()}, "inputs": files.identities(spark, root), "code": code_digest()})
    if done.done("match"):
        return tables.read_json(spark, f"{out}/report")
    tables.refuse_sample(spark, root)
    settings = signature(*configs.values())
    (train,) = done.frames("train-records", lambda: [read_records(spark, root, "train")])
    done.run("terms", [f"{out}/terms"], lambda: tfidf.save_tfidf(fit_terms(train, prep), f"{out}/terms"))
    terms = tfidf.load_tfidf(spark, f"{out}/terms", tfidf.hashed_terms(prep.hash_bits))
    prepared = _prepared(done, "train-candidates", train, terms, prep, dense)
    labeled, labels = done.frames("labels", lambda: list(label(prepared, labeling.staged_truth(tables.read_truth(spark, root)), prep)))
    done.run("recall", [f"{out}/candidate_recall"], lambda: tables.write_parquet(labeling.recall_report(labels), f"{out}/candidate_recall"))

    def fit() -> None:
        model = matcher.train(labeled, trees)
        sweep, threshold = validate(model, labeled, labels, trees.thresholds)
        tables.write_parquet(sweep, f"{out}/validation_f05")
        matcher.save(model, spark, f"{out}/matcher")
        held = labeled.where("dataset_split = 'validation'")
        report = {"signature": settings, "model_sha": matcher.fingerprint(model), "terms_sha": tfidf.fingerprint(terms), "threshold": threshold, "importances": matcher.importances(model)[:20], "learning_curve": matcher.learning_curve(model, held), "leafwise": isinstance(trees, BoostingConfig)}
        tables.write_json(spark, report, f"{out}/report")
        tables.log_metrics(spark, f"{out}/metrics", "train", len(report["learning_curve"]), threshold=threshold, loss=report["learning_curve"][-1])

    done.run("matcher", [f"{out}/{x}" for x in ("validation_f05", "matcher", "report")], fit)
    # What is applied is what was stored.
    model, terms, report = load_matcher(spark, out, settings, prep)
    (records,) = done.frames("test-records", lambda: [read_records(spark, root, "test")])
    test = _prepared(done, "test-candidates", records, terms, prep, dense)
    labeling.require_complete(test.queries, test.records)

    def match() -> None:
        matches, listed = submit(model, test, report["threshold"])
        tables.write_lists(matches, f"{out}/matching_results")
        tables.write_lists(listed, f"{out}/candidate_pairs")
        tables.log_metrics(spark, f"{out}/metrics", "match", 1, queries=test.queries.count(), pairs=test.pairs.count())

    done.run("match", [f"{out}/matching_results", f"{out}/candidate_pairs"], match)
    return report


def _prepared(done: Manifest, stage: str, records: DataFrame, terms: tfidf.TfidfModel, prep: PrepConfig, dense: DenseConfig | None) -> Prepared:
    def build() -> list[DataFrame]:
        made = prepare(records, terms, prep, dense)
        return [made.pairs, made.queries]

    return Prepared(records, *done.frames(stage, build))


def load_matcher(spark: SparkSession, out: str, expected: str, prep: PrepConfig) -> tuple[PipelineModel, tfidf.TfidfModel, dict]:
    """The stored matcher, its terms and report, if they were made with the expected settings and
    are what the report tells: new records can be scored with them."""
    report = tables.read_json(spark, f"{out}/report")
    if report["signature"] != expected:
        raise ValueError("the stored matcher was made with other settings")
    model = matcher.load(spark, f"{out}/matcher", report.get("leafwise", False))
    if matcher.feature_columns(model) != features.MODEL_COLUMNS:
        raise ValueError("the stored matcher has other features")
    terms = tfidf.load_tfidf(spark, f"{out}/terms", tfidf.hashed_terms(prep.hash_bits))
    if matcher.fingerprint(model) != report["model_sha"] or tfidf.fingerprint(terms) != report["terms_sha"]:
        raise ValueError("the stored matcher or its terms are not those of the report")
    return model, terms, report


def split_share(sid: str, country: str, has_match: bool, seed: int, spark: SparkSession) -> float:
    """The number in [0, 1) that decides a query's split."""
    row = spark.createDataFrame([(sid, country, has_match)], "sid string, country string, m boolean")
    return row.select(hashing.unit_hash(hashing.query_split_key(seed, F.col("country"), F.col("m"), F.col("sid"))).alias("u")).first()["u"]


def doctor(spark: SparkSession) -> dict:
    """Whether the shared folder can be written and read and workers run the package's UDFs."""
    probe = clean_records(spark.createDataFrame([("S1-0", "A.B.C. Motors Ltd", "1 Elm St", "usa")], "entity_id string, business_name string, business_address string, country string"))
    row = probe.first()
    return {"spark": spark.version, "workers": row["name_without_suffix"] == "abc motors", "country": row["country_key"], "shared_folder": shared_folder(spark)}
