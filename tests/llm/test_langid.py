"""Held-out accuracy, and what a prediction may depend on."""

import numpy as np

from kinloom.llm import langid, queries
from kinloom.session import read_table

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    got = queries.op2_language_id(spark, SF)
    truth = read_table(spark, SF, "documents").select("doc_id", "lang")
    rows = got.where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 20
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_gradients_fit_two_alphabets():
    left, right = (np.tile(langid.windows_of(t), (40, 1)) for t in ("abab abba " * 20, "xyxy yxxy " * 20))
    model = langid.ByteCNN(["l", "r"]).fit(np.concatenate([left, right]), np.repeat([0, 1], 40))
    assert model.scores(left[:1]).argmax() == 0
    assert model.scores(right[:1]).argmax() == 1


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(3)
    windows, labels = rng.integers(1, 62, (4, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 1, 0])
    model = langid.ByteCNN(["l", "r"])
    model.embedding, model.dense = model.embedding.astype(float), model.dense.astype(float)
    loss = lambda: -np.log(model.scores(windows)[np.arange(4), labels]).mean()
    gradients = model._gradients(windows, labels)
    for parameter, gradient in zip([model.dense, model.embedding], [gradients[1], gradients[0]], strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before = loss()
        parameter[at] += 1e-4
        assert abs((loss() - before) / 1e-4 - gradient[at]) < 0.05 * abs(gradient[at]) + 1e-3


def test_edges(documents, edge_rows):
    docs = documents([(i, t, "aa") for i, t in edge_rows] + [(50 + i, "xyzzy yxxy " * 20, "bb") for i in range(20)])
    model = langid.train(docs)
    rows = langid.identify(docs, model).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    for i in (1, 2, 3):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[50]["lang_pred"] == "bb"
    assert by_id[None]["held_out"] is False
    kept = langid.filter_documents(docs, model, 0.0)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 3


def test_no_labels_and_empty_table(documents):
    docs = documents([(1, "some text"), (2, None)])
    assert langid.train(docs) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.identify(documents([]), None).collect() == []


def test_only_letters_make_a_language(documents):
    rows = [(i, "plain words of a text " * 10, "en") for i in range(20)]
    texts = {100: "² ½", 101: "Ⅷ 12", 102: "_ -", 103: "ª", 104: "日本", 105: "é"}
    docs = documents(rows + [(i, t, None) for i, t in texts.items()])
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, langid.train(docs)).collect()}
    assert [got[i] for i in texts] == ["und", "und", "und", "en", "en", "en"]


def test_many_languages_are_all_learned(documents, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_TOTAL", 140)
    rows = [(i, f"word{chr(97 + i % 7)}{i % 70} " * 20, f"l{i % 70:02}") for i in range(700)]
    docs = documents(rows)
    model = langid.train(docs)
    assert model.languages == [f"l{k:02}" for k in range(70)]
    again = langid.train(docs.repartition(5))
    assert all((a == b).all() for a, b in zip(model.dense, again.dense, strict=True))


def test_no_language_is_lost_where_each_gives_one_document(documents, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_TOTAL", 60)
    rows = [(i, f"word{chr(97 + i % 60 % 26)} text{i % 60} " * 3, f"l{i % 60:02}") for i in range(60 * 800)]
    monkeypatch.setattr(langid.ByteCNN, "fit", lambda self, windows, labels: self)
    assert langid.train(documents(rows)).languages == [f"l{k:02}" for k in range(60)]
