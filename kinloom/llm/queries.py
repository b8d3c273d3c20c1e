"""The opN_ queries, each its operator with production parameters over the whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinloom.llm import bpe, hpylm, jaccard_join, langid, packing, pii, quality, secret_scan, sharding, token_files, vector_codes, whitening, winnow
from kinloom.session import read_table, shared_folder


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(read_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit_references(docs))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_decode(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, digests=True)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(read_table(spark, sf_dir, "documents"))


def op8_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.compare_edited(read_table(spark, sf_dir, "documents"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score(read_table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_components(read_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    return made.withColumn("deviation", made["deviation"].cast("long"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_files(read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_files(spark, folder)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_language_id": op2_language_id,
    "op3_quality_rules": op3_quality_rules,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_secret_scan": op5_secret_scan,
    "op6_packing": op6_packing,
    "op7_sharding": op7_sharding,
    "op8_winnow": op8_winnow,
    "op9_lm_score": op9_lm_score,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_whitening": op11_whitening,
    "op12_vector_codes": op12_vector_codes,
    "op13_token_files": op13_token_files,
}


def _rounds_of_codes(rounds: int = 4) -> str:
    """The codes as SQL: a list of whole numbers for each part, and every part beside every entry in each round."""
    nearest = """SELECT i, p, q, min(CAST(list_inner_product(q, q) - 2 * list_inner_product(q, e) + list_inner_product(e, e) AS BIGINT) * 256 + k) AS best FROM part JOIN {book} USING (p) GROUP BY ALL"""
    steps = ["""WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (SELECT i, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS q FROM kept, range(4) AS t(p)),
book0 AS (SELECT p, i - 1 AS k, q AS e FROM part WHERE i <= 256)"""]
    for r in range(rounds):
        steps.append(f"""near{r} AS ({nearest.format(book=f"book{r}")}),
sums{r} AS (SELECT p, best % 256 AS k, j, sum(q[j + 1]) AS s, count(*) AS c FROM near{r}, range(4096) AS t(j) WHERE j < len(q) GROUP BY ALL),
moved{r} AS (SELECT p, k, list(floor(s / c) ORDER BY j) AS e FROM sums{r} GROUP BY ALL),
book{r + 1} AS MATERIALIZED (SELECT p, k, coalesce(m.e, b.e) AS e FROM book{r} b LEFT JOIN moved{r} m USING (p, k))""")
    steps.append(f"""last AS ({nearest.format(book=f"book{rounds}")}),
coded AS (SELECT i, string_agg(format('{{:02x}}', best % 256), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM last GROUP BY i),
digest AS (SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: x::BIGINT), ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (i), digest""")
    return ",\n".join(steps)


# All pairs that share a shingle: right, and affordable on small tables only.
ORACLE_SQL: dict[str, str] = {
    "op10_jaccard_join": r"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] ELSE list_transform(range(1, greatest(2, len(w) - 3)), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT a, b FROM c WHERE 100 * k >= 80 * (n + m - k)),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS node, a AS label FROM u UNION SELECT u.b, r.label FROM r JOIN u ON u.a = r.node WHERE r.label < u.b),
f AS (SELECT node, min(label) AS label FROM r GROUP BY node)
SELECT s.doc_id, len(s) AS n_shingles, coalesce(label, s.doc_id) AS component_id FROM s LEFT JOIN f ON f.node = s.doc_id""",
    "op12_vector_codes": _rounds_of_codes(),
}
