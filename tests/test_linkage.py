"""Small end-to-end fixtures of the linkage plan."""

import gzip
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinloom.config import BoostingConfig, DenseConfig, MatcherConfig, PrepConfig
from kinloom.functions.normalize import clean_records
from kinloom.operators import blocking, components, evaluation, features, ivf, knn, labeling, matcher, sampling, tfidf
from kinloom.plans import linkage
from kinloom.sources import tables

RAW = "entity_id string, business_name string, business_address string, country string, source int"
CONFIG = PrepConfig(block_limit=1, lexical_pool=5, lexical_top_k=5, max_candidates=5, hash_bits=12)


@pytest.fixture(scope="module")
def mini(spark):
    rows = [
        ("S1-a", "abc motors", "105 elm street", "US", 1), ("S1-empty", "", "", "US", 1), ("S1-missed", "", "", "US", 1),
        ("S2-a", "abc motors", "105 elm street", "US", 2), ("S2-unseen", "unrelated", "", "US", 2), ("S2-fr", "abc motors", "105 elm street", "FR", 2),
        ("S3-a", "abc motors", "105 elm street", "US", 3),
    ]
    records = clean_records(sampling.dense_numbers(spark.createDataFrame(rows, RAW), "source", "entity_id")).cache()
    return records, linkage.prepare(records, linkage.fit_terms(records, CONFIG), CONFIG)


def test_candidates_labels_and_recall(spark, mini):
    records, prepared = mini
    assert {(r["source1_entity_id"], r["candidate_entity_id"]) for r in prepared.pairs.collect()} == {("S1-a", "S2-a"), ("S1-a", "S3-a")}
    assert set(features.MODEL_COLUMNS) <= set(prepared.pairs.columns) and len(features.MODEL_COLUMNS) == 50
    truth = labeling.parse_truth(spark.createDataFrame([("S1-a", "S2-a,S3-a"), ("S1-empty", ""), ("S1-missed", "S2-unseen")], "source1_entity_id string, matched_entity_ids string"))
    labeled, labels = linkage.label(prepared, truth, CONFIG)
    assert [r["label"] for r in labeled.collect()] == [1, 1]
    total = labeling.recall_report(labels).where("dataset_split IS NULL AND country IS NULL").first()
    assert (total["candidate_recall"], total["oracle_macro_f05_ceiling"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    lists = evaluation.candidate_lists(prepared.queries.withColumnRenamed("q", "rid"), prepared.pairs).collect()
    assert sorted(r["candidate_entity_ids"] for r in lists) == ["", "", "S2-a,S3-a"]
    scored = labeled.select(F.col("source1_entity_id").alias("sid"), F.col("label").cast("long").alias("label"), F.lit(0.9).alias("p"))
    assert evaluation.best_threshold(evaluation.f_half_sweep(labels, scored, [0.5, 0.95])).first()["macro_f05"] == pytest.approx(2 / 3)
    with pytest.raises(ValueError):
        evaluation.check_probabilities(prepared.pairs, prepared.pairs.limit(1).select("source1_entity_id", "candidate_entity_id", F.lit(0.5).alias("match_probability")))


def test_missing_evidence_is_null(spark, mini):
    records, _ = mini
    pair = records.where("entity_id = 'S2-unseen'").select(F.col("rid").alias("q")).crossJoin(records.where("entity_id = 'S2-a'").select(F.col("rid").alias("r")))
    pair = pair.withColumns({"name_retrieval_cosine": F.lit(0.0), "address_retrieval_cosine": F.lit(None).cast("double")})
    row = features.pair_features(pair, records).first()
    assert row["address_levenshtein"] is None and row["postal_code_exact"] is None and row["name_address_similarity_product"] is None
    assert (row["address_missing"], row["address_missing_left"], row["name_exact"]) == (1, 1, 0.0)


def test_word_order_and_empty_texts(spark):
    texts = spark.createDataFrame([(1, "holloway peak seafood"), (2, "seafood holloway peak"), (3, ""), (4, "हिन्दी नाम")], "rid long, name string")
    model = tfidf.fit_tfidf(texts, ["name"], tfidf.hashed_terms(12))
    vectors = model.vectors(texts, ["name"])
    pairs = spark.createDataFrame([(1, 2), (3, 3), (1, 3), (4, 4)], "q long, r long")
    got = {(r["q"], r["r"]): r["name_cosine"] for r in tfidf.pair_cosines(pairs, vectors, ["name"]).collect()}
    assert got[1, 2] == pytest.approx(1) and got[4, 4] == pytest.approx(1)
    assert got[3, 3] is None and got[1, 3] is None


def test_partitions_do_not_matter(spark):
    rows = [(f"S1-{i}", "abc motors", "elm street", "US", 1) for i in range(5)] + [("S2-a", "abc motors", "elm street", "US", 2), ("S2-b", "other", "oak road", "US", 2)]
    found = []
    for parts in (1, 7):
        records = clean_records(sampling.dense_numbers(spark.createDataFrame(rows, RAW).repartition(parts), "source", "entity_id"))
        pairs = linkage.prepare(records, linkage.fit_terms(records, CONFIG), CONFIG).pairs
        found.append(sorted((r["source1_entity_id"], r["candidate_entity_id"], r["candidate_rank"]) for r in pairs.collect()))
    assert found[0] == found[1] and len(found[0]) == 5


def test_blocks_make_no_cartesian_plan(spark, mini):
    records, _ = mini
    given = blocking.with_texts(records)
    plan = blocking.exact_blocks(given.where("source = 1"), given.where("source > 1"))._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_truth_errors(spark):
    make = lambda *rows: spark.createDataFrame(rows, "source1_entity_id string, matched_entity_ids string")
    for bad in (make(("S1-a", "S2-a,S2-a")), make(("S1-a", "S1-b")), make(("S1-a", ""), ("S1-a", ""))):
        with pytest.raises(ValueError):
            labeling.parse_truth(bad)


def test_clusters_do_not_leak(spark):
    truth = spark.createDataFrame([(f"S1-{i}", [f"S2-{i // 2}", f"S3-{(i + 1) // 4}"]) for i in range(60)], "sid string, ids array<string>")
    clusters = labeling.truth_clusters(truth)
    queries = truth.select("sid", F.lit("US").alias("country"))
    splits = labeling.query_splits(queries, truth, PrepConfig(split_strategy="cluster"))
    assert splits.count() == 60 and labeling.cluster_leaks(splits, clusters).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert {got[i] for i in range(1, 41)} == {0} and {got[100 + i] for i in range(1, 50)} == {100}
    assert components.connected_components(edges.where("a < 0")).collect() == []


def test_neighbours(spark):
    rng = np.random.default_rng(13)
    vectors = rng.normal(size=(3000, 8))
    rows = [(i + 2, 2, "US", v.tolist()) for i, v in enumerate(vectors)] + [(1, 1, "US", vectors[17].tolist())]
    records = spark.createDataFrame(rows, "rid long, source int, country_key string, embedding array<double>")
    for exact_below in (10_000, 100):
        got = knn.neighbours(records, DenseConfig(ann_top_k=5, nlist=16, nprobe=8, pq_m=4, exact_below=exact_below)).orderBy("neural_rank").collect()
        assert len(got) == 5 and got[0]["r"] == 19 and got[0]["neural_cosine"] == pytest.approx(1)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    best = set((np.argsort(-(unit @ unit[17]))[:5] + 2).tolist())
    assert {r["r"] for r in got} & best and {r["r"] for r in knn.neighbours(records, DenseConfig(ann_top_k=5)).collect()} == best


def test_matcher(spark):
    rows = []
    for i in range(72):
        split = "train" if i < 60 else "validation"
        for label in (1, 0):
            rows.append((f"S1-{i}", f"S2-{i}-{label}", label, split, float(label), None if i % 3 == 0 else 0.9 * label))
    df = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, label int, dataset_split string, name_exact double, lev double")
    config = MatcherConfig(max_iter=5, min_instances=1, feature_subset="all")
    model = matcher.train(df, config, ["name_exact", "lev"])
    got = matcher.predict(model, df).join(df, ["source1_entity_id", "candidate_entity_id"]).collect()
    assert len(got) == len(rows) and all((r["match_probability"] >= 0.5) == bool(r["label"]) for r in got)
    assert matcher.importances(model)[0][0] in ("name_exact", "lev")
    losses = matcher.learning_curve(model, df)
    assert losses == sorted(losses, reverse=True) and losses[-1] < losses[0]
    sample = [sorted(r["candidate_entity_id"] for r in matcher.sampled_rows(df.repartition(n), 20, 1).collect()) for n in (1, 5)]
    assert sample[0] == sample[1] and len(sample[0]) == 20
    with pytest.raises(ValueError):
        matcher.train(df.where("label = 1"), config, ["name_exact"])
    with pytest.raises(ValueError):
        matcher.train(df, config, ["label"])


def test_settings():
    for bad in ({"unknown": 1}, {"hash_bits": 30}, {"lexical_top_k": 500}, {"block_limit": 0}):
        with pytest.raises(ValueError):
            PrepConfig.from_dict(bad)
    with pytest.raises(ValueError):
        MatcherConfig.from_dict({"thresholds": [0.5, 0.2]})


def test_audit(spark):
    frame = lambda name, *values: spark.createDataFrame([(i, s, v) for i, (s, v) in enumerate(values)], f"rid int, source1_entity_id string, {name} string")
    queries = frame("x", ("S1-a", ""), ("S1-b", "")).drop("x")
    good = frame("matched_entity_ids", ("S1-a", "S2-x"), ("S1-b", ""))
    listed = frame("candidate_entity_ids", ("S1-a", "S2-x,S3-y"), ("S1-b", ""))
    evaluation.require_clean_audit(queries, good, listed)
    for matches in (frame("matched_entity_ids", ("S1-a", "S2-z"), ("S1-b", "")), frame("matched_entity_ids", ("S1-b", ""), ("S1-a", "")), good.limit(1)):
        with pytest.raises(ValueError):
            evaluation.require_clean_audit(queries, matches, listed)


def test_batches(spark):
    rows = [(f"s{i}", f"e{i}", 0, f"h{i:02}", f"c{i % 4}", "US" if i % 2 else "FR") for i in range(40)]
    positives = spark.createDataFrame(rows, "sid string, eid string, ordinal int, shuffle string, cluster string, country string")
    batches = sampling.contrastive_batches(positives, 3)
    assert batches.count() == 40
    for r in batches.groupBy("country", "lane", "batch").agg(F.count("*").alias("n"), F.count_distinct("cluster").alias("c")).collect():
        assert r["n"] == r["c"] <= 3
    lone = sampling.lone_batches(batches)
    found = sampling.partners(lone, positives).join(positives.select("sid", F.col("cluster").alias("other")), "sid").join(lone, ["country", "lane", "batch"])
    assert found.count() == lone.count() and found.where("other = cluster").count() == 0


def test_tsv_and_zip(spark, tmp_path):
    text = "﻿entity_id\tbusiness_name\tbusiness_address\tcountry\textra\nS1-1\t\"a\nb\"\tNA\tUS\t007\nS1-2\t\t\t\tx\n"
    (tmp_path / "train_source1.tsv").write_text(text, encoding="utf-8")
    rows = tables.read_source(spark, str(tmp_path), "train", 1).orderBy("entity_id").collect()
    assert [tuple(r)[:5] for r in rows] == [("S1-1", "a\nb", "NA", "US", "007"), ("S1-2", "", "", "", "x")]
    with zipfile.ZipFile(tmp_path / "all.zip", "w") as packed:
        packed.writestr("inner/train_source1.tsv", text)
    assert tables.read_source(spark, str(tmp_path / "all.zip"), "train", 1).count() == 2
    with pytest.raises(ValueError):
        tables.find_one(spark, str(tmp_path), "nothing")
    tables.write_json(spark, {"a": [1, "é"]}, str(tmp_path / "doc"))
    assert tables.read_json(spark, str(tmp_path / "doc")) == {"a": [1, "é"]}


@pytest.mark.parametrize("trees", [MatcherConfig(max_iter=5, min_instances=1, feature_subset="all"), BoostingConfig(num_boost_round=3, num_leaves=4, min_data_in_leaf=5, learning_rate=0.5)], ids=["mllib", "leafwise"])
def test_whole_run(spark, tmp_path, trees):
    header = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    for split, n in (("train", 60), ("test", 12)):
        for source in (1, 2, 3):
            trade = "auto spare" if source == 3 else "motors"
            lines = [f"S{source}-{split}-{i}\tharbor {trade} branch {i}\t{i + 1} elm road city\t{'India' if i % 2 else 'US'}\n" for i in range(n)]
            (tmp_path / f"{split}_source{source}.tsv").write_text(header + "".join(lines))
    (tmp_path / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-train-{i}\tS2-train-{i}\n" for i in range(60)))
    prep = PrepConfig(hash_bits=12, validation_fraction=0.3, max_candidates=20)
    dense = DenseConfig(ann_top_k=4, ann_shortlist=8)
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    for name in os.listdir(tmp_path):
        if name.endswith(".tsv"):
            (tmp_path / name).rename(raw / name)
    # Broken off while matching, then run to its end, then run again: no stage twice, and no job the third time.
    with pytest.MonkeyPatch.context() as broken:
        broken.setattr(linkage, "submit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            linkage.run(spark, str(raw), str(out), prep, trees, dense)
    with pytest.MonkeyPatch.context() as once:
        once.setattr(matcher, "train", lambda *_: 1 / 0)
        once.setattr(linkage, "prepare", lambda *_: 1 / 0)
        report = linkage.run(spark, str(raw), str(out), prep, trees, dense)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("again", "again")
    assert linkage.run(spark, str(raw), str(out), prep, trees, dense) == report
    assert list(tracker.getJobIdsForGroup("again")) == []
    spark.sparkContext.setJobGroup("tests", "tests")
    with pytest.raises(ValueError, match="preparation"):
        linkage.run(spark, str(raw), str(out), PrepConfig(hash_bits=13), trees, dense)
    with open(raw / "test_source1.tsv", "a") as more:
        more.write("S1-more\tx\ty\tUS\n")
    with pytest.raises(ValueError, match="inputs"):
        linkage.run(spark, str(raw), str(out), prep, trees, dense)
    assert 0 <= report["threshold"] <= 1
    matches = spark.read.csv(str(tmp_path / "out/matching_results"), sep="\t", header=True).collect()
    assert len(matches) == 12
    right = sum(r["matched_entity_ids"] == r["source1_entity_id"].replace("S1", "S2") for r in matches)
    assert right >= 10
    model, terms, report = linkage.load_matcher(spark, str(tmp_path / "out"), linkage.signature(prep, trees, dense), prep)
    assert report["model_sha"] == matcher.fingerprint(model) and report["terms_sha"] == tfidf.fingerprint(terms)
    assert [x["stage"] for x in tables.read_metrics(spark, str(tmp_path / "out" / "metrics"))] == ["train", "match"]
    assert matcher.feature_columns(model) == features.MODEL_COLUMNS
    with pytest.raises(ValueError):
        linkage.load_matcher(spark, str(tmp_path / "out"), "other", prep)
    other = spark.createDataFrame([("S1-0", "S2-0", 0.5, "x")], "source1_entity_id string, candidate_entity_id string, match_probability double, model_sha string")
    with pytest.raises(ValueError):
        linkage.require_model(other, report["model_sha"])
    again = terms.idf.where("key % 2 = 0").withColumn("df", F.col("df") + 1)
    assert tfidf.fingerprint(tfidf.TfidfModel(again, terms.n, terms.keyed)) != report["terms_sha"]


def test_ivf_finds_k_in_partitions_far_from_the_query(spark):
    """Partition b lies far from the queries, whose nearest cells hold rows of a alone."""
    rng = np.random.default_rng(5)
    near, far = rng.normal(size=(2, 16))
    cloud = lambda centre, n: [[float(x) for x in v / np.linalg.norm(v)] for v in centre + 0.4 * rng.normal(size=(n, 16))]
    rows = [(i, "a", v) for i, v in enumerate(cloud(near, 900))] + [(1000 + i, "b", v) for i, v in enumerate(cloud(far, 300))]
    references = spark.createDataFrame(rows, "r long, part string, embedding array<double>")
    queries = spark.createDataFrame([(i, p, v) for i, v in enumerate(cloud(near, 20)) for p in "ab"], "q long, part string, embedding array<double>")
    config = DenseConfig(ann_top_k=5, nlist=16, nprobe=8, pq_m=8)
    pairs = lambda df: {(r["q"], r["part"], r["r"]) for r in df.collect()}
    exact, got = pairs(knn.exact_top_k(queries, references, 5)), pairs(ivf.top_k(queries, references, config))
    for part in "ab":
        wanted = {x for x in exact if x[1] == part}
        assert len({x for x in got if x[1] == part}) == len(wanted) == 100
        assert len(wanted & got) >= 0.9 * len(wanted)


def test_batches_do_not_depend_on_the_cluster(spark):
    positives = spark.createDataFrame([("FR", i, f"s{i:03}", f"S1-{i}", f"S2-{i}", f"c{i % 40}") for i in range(300)], "country string, ordinal int, shuffle string, sid string, eid string, cluster string")
    plain = sorted(map(tuple, sampling.contrastive_batches(positives, 8).collect()))
    assert sorted(map(tuple, sampling.contrastive_batches(positives.repartition(7), 8).collect())) == plain
    assert len({r["lane"] for r in sampling.contrastive_batches(positives, 8).collect()}) > 8
    one = sampling.contrastive_batches(positives, 8, F.lit(0)).collect()
    assert {r["lane"] for r in one} == {0}


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([("S1-1", "x", 1, "train"), ("S1-2", None, 2, "validation")], "source1_entity_id string, name string, derived int, dataset_split string")
    tables.write_by_split(rows, str(tmp_path / "split"))
    assert spark.read.parquet(str(tmp_path / "split" / "dataset_split=train")).first()["source1_entity_id"] == "S1-1"
    tables.write_cleaned(rows, str(tmp_path / "cleaned"), ["source1_entity_id"])
    part = next((tmp_path / "cleaned").glob("*.csv.gz"))
    assert gzip.open(part, "rt").readline().split("\t")[0] == "source1_entity_id"
    with pytest.raises(Exception):
        tables.write_cleaned(rows, str(tmp_path / "cleaned"), ["source1_entity_id"])
    tables.log_metrics(spark, str(tmp_path / "log"), "a", 1, x=1.5)
    tables.log_metrics(spark, str(tmp_path / "log"), "a", 2, x=2.5)
    assert [(r["step"], r["x"]) for r in tables.read_metrics(spark, str(tmp_path / "log"))] == [(1, 1.5), (2, 2.5)]
    with pytest.raises(ValueError):
        tables.log_metrics(spark, str(tmp_path / "log"), "a", 3, x=float("nan"))
