"""Every stage against its operator's verdicts on its own input."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from kinloom.llm import jaccard_join, secret_scan
from kinloom.session import read_table, staged

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    columns, inputs = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        inputs.append(docs)
        docs = staged(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns, name
    first, _, before_join, before_scan = inputs
    known = {r["doc_id"] for r in first.collect()}
    assert {r["doc_id"] for r in docs.collect()} <= known
    groups = {r["component_id"] for r in jaccard_join.join_components(before_join).collect()}
    assert sorted(r["doc_id"] for r in before_scan.collect()) == sorted(groups)
    assert docs.count() == before_scan.count()
    assert secret_scan.scan(docs).where("n_assign + n_access + n_hex > 0").count() == 0
    assert docs.where("n_chars <> length(text)").count() == 0
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs.collect())
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert sum(r["length"] for r in pieces) == expected


def test_edges(spark, documents, edge_rows):
    for rows in (edge_rows, []):
        docs = documents(rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, SF), f"edge-{name}")
        assert set(docs.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
