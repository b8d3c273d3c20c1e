"""Ranked full-text pools: the best references of each query by BM25.

A document is a reference's country, block keys, name terms and address terms; it has each term once or not at all, so its score is
one weight of its length times the sum of the matched terms' idf, and the weight alone bounds what any set of terms can give.

Posting lists are not joined whole. First each list's best by weight, as many as a pool holds, give a score that the
pool's last place has at least. Terms whose sums stay below it bring nobody in alone, and of the other lists
only those blocks of equal length (and ids) are opened whose weight could still reach that score. What was met is then scored
in full. The pools are exact; ties stand by id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinloom.functions import tokens
from kinloom.session import staged_by_shuffle as staged
from kinloom.session import unstage

# Fixed values of the formula: saturation, share of the length, least idf.
K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
#: Decimals at which scores are compared, and the slack of bounds.
DIGITS, SLACK = 9, 1e-8
#: Stretches of ids into which the blocks of one length are cut.
STRETCHES = 64
_LIST = ["field", "token", "scope"]


@dataclass(frozen=True)
class Statistics:
    """(rid, length, weight) of every reference and (field, token, idf) of every term; stages, both."""

    weights: DataFrame
    idf: DataFrame


def statistics(references: DataFrame, fields: list[str]) -> Statistics:
    """references: records with their texts. Lengths count the terms of all columns, the country's one included."""
    keys = tokens.block_keys()
    parts = [F.size(keys[c]) for c in "ABCD"] + [F.size(tokens.lexical_tokens(F.col(f))) for f in fields]
    lengths = staged(references.select("rid", sum(parts, F.lit(1)).alias("length")), "ranked-lengths")
    n, mean = lengths.agg(F.count("*"), F.avg("length")).first()
    weight = F.lit(K1 + 1) / (1 + F.lit(K1) * (1 - B + B * F.col("length") / F.lit(mean or 1.0)))
    marked = [references.select(F.lit(f).alias("field"), F.explode(tokens.lexical_tokens(F.col(f))).alias("token")) for f in fields]
    every = marked[0]
    for more in marked[1:]:
        every = every.unionByName(more)
    idf = F.log((F.lit(n) - F.col("n") + 0.5) / (F.col("n") + 0.5))
    counted = every.groupBy("field", "token").agg(F.count("*").alias("n")).select("field", "token", F.greatest(idf, F.lit(LEAST_IDF)).alias("idf"))
    return Statistics(lengths.withColumn("weight", weight), staged(counted, "ranked-idf"))


def alike(query_tokens: DataFrame, scopes: DataFrame) -> DataFrame:
    """(q, first): the least query that has the same terms, scopes and limits."""
    asked = query_tokens.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("field", "token"))).alias("terms"))
    under = scopes.groupBy("q").agg(F.sort_array(F.collect_set(F.struct("scope", "limit"))).alias("scopes"))
    marked = staged(asked.join(under, "q").select("q", F.sha2(F.to_json(F.struct("terms", "scopes")), 256).alias("form")), "ranked-forms")
    return staged(marked.join(marked.groupBy("form").agg(F.min("q").alias("first")), "form").select("q", "first"), "ranked-alike")


def ranked_pool(query_tokens: DataFrame, postings: DataFrame, scopes: DataFrame, known: Statistics) -> DataFrame:
    """(q, r, score, rank): the first `limit` of each query's references, by score, ties by r.

    query_tokens: q, field, token. postings: rid, field, token, scope. scopes: q, scope, limit; a reference
    belongs to a query's pool if it has one of its terms under one of its scopes. Of queries of equal terms and scopes the
    least is searched, and the others get its pool."""
    members = alike(query_tokens, scopes)
    one = members.where("q = first").select("q")
    query_tokens, scopes = query_tokens.join(one, "q", "left_semi"), staged(scopes.join(one, "q", "left_semi"), "ranked-scopes")
    asked = query_tokens.join(known.idf, ["field", "token"])
    asked = staged(asked.withColumn("total", F.sum("idf").over(Window.partitionBy("q"))), "ranked-asked")  # a query's terms are few
    most = scopes.agg(F.max("limit")).first()[0] or 0
    held = postings.join(asked.select("field", "token").distinct(), ["field", "token"], "left_semi").join(scopes.select("scope").distinct(), "scope", "left_semi")
    held = held.join(known.weights, "rid")
    width = (known.weights.agg(F.max("rid")).first()[0] or 0) // STRETCHES + 1
    held = staged(held.withColumn("stretch", F.floor(F.col("rid") / width)), "ranked-postings")
    terms = asked.join(scopes, "q")

    # The head of each list; each task cuts its own before the shuffle.
    heads = held.withColumn("at", F.row_number().over(Window.partitionBy(*_LIST).orderBy(F.desc("weight"), "rid"))).where(F.col("at") <= most)
    seen = terms.join(heads.select(*_LIST, "rid", "weight"), _LIST).dropDuplicates(["q", "rid", "field", "token"])
    partial = seen.groupBy("q", "rid").agg((F.max("weight") * F.sum("idf")).alias("score"), F.max("weight").alias("weight"), F.max("limit").alias("limit"))
    best = Window.partitionBy("q").orderBy(F.desc(F.round("score", DIGITS)), "rid")
    partial = staged(partial.withColumn("nth", F.row_number().over(best)), "ranked-heads")
    top = partial.groupBy("q").agg(F.max("weight").alias("heaviest"), *[F.max(F.when(F.col("nth") == F.col("limit"), F.col(c))).alias(a) for c, a in (("score", "bar"), ("rid", "last"))])

    # Which lists can still bring in a reference, and which of their blocks.
    weakest = Window.partitionBy("q").orderBy("idf", "field", "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    strong = asked.withColumn("below", F.sum("idf").over(weakest)).join(top, "q").where(F.col("bar").isNull() | (F.col("below") * F.col("heaviest") >= F.col("bar") - SLACK))
    blocks = held.groupBy(*_LIST, "length", "stretch").agg(F.max("weight").alias("reach"), F.min("rid").alias("first"))
    bound = F.col("reach") * F.col("total")
    enters = F.col("bar").isNull() | (bound > F.col("bar") + SLACK) | ((bound >= F.col("bar") - SLACK) & (F.col("first") < F.col("last")))
    opened = strong.join(scopes, "q").join(blocks, _LIST).where(enters).select("q", *_LIST, "length", "stretch")
    met = opened.join(held.select(*_LIST, "length", "stretch", "rid"), [*_LIST, "length", "stretch"]).select("q", "rid")

    # Full scores of all that were met.
    met = met.unionByName(partial.select("q", "rid")).distinct()
    matched = met.join(asked.select("q", "field", "token", "idf"), "q").join(held.select("rid", "field", "token", "weight").distinct(), ["rid", "field", "token"])
    scored = matched.groupBy("q", "rid").agg(F.round(F.max("weight") * F.sum("idf"), DIGITS).alias("score"))
    limits = scopes.groupBy("q").agg(F.max("limit").alias("limit"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "rid"))
    pools = staged(scored.withColumn("rank", place).join(limits, "q").where(F.col("rank") <= F.col("limit")).select(F.col("q").alias("first"), F.col("rid").alias("r"), "score", "rank"), "ranked-firsts")
    out = staged(pools.join(members, "first").select("q", "r", "score", "rank"), "ranked-pools")
    unstage(asked, held, partial, pools)
    return out
