"""Personal data by bootstrapped contextual extraction.

The base patterns are the seed entities. The words around every identifier-like token make
lexical patterns; Spark holds the graph of patterns and instances (values) with their
counts, and scores both sides in turn: a pattern is as trustworthy for a kind as the
share of its instances already known to be of that kind, and a value is believed
as far as the patterns it stands in are. Patterns above a confidence and with enough
distinct instances discover values that no base pattern matches.

Defined cases: null or empty text has no spans; an empty table gives an empty
result; repeated rows count as repeated evidence and are all reported; a null or
repeated id is carried along, since rows are matched by an internal key.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinloom.llm.arrow_map import map_text, texts_of
from kinloom.llm.spans import LETTERS_SPACES, Span, digest, joined
from kinloom.session import staged

ORDER = {"email": 0, "ip": 1, "card": 2, "phone": 3}
#: Rounds over the graph; a pattern's least confidence and distinct known instances; a value's least belief.
ROUNDS, LEAST_CONFIDENCE, LEAST_SUPPORT, LEAST_BELIEF = 3, 0.7, 5, 0.9
#: Added to a pattern's count, so that rare patterns are trusted less.
SMOOTHING = 2.0
#: Longer words of patterns and longer values, in code points, go by their hash.
LONG_KEY = 64

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IDENTIFIER = re.compile(r"(?<![^ \t\n\v\f\r])" + r"(?=[^ \t\n\v\f\r]*[0-9@])" + LETTERS_SPACES)
_NO_SPACE = re.compile(LETTERS_SPACES)
_SPACES = " \t\n\v\f\r"
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_matches(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and matches of a base pattern that failed its check."""
    good: list[Span] = []
    bad: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        # The local part is the run of its characters before the sign, from the last match on.
        start = at
        while start > done and not _NOT_LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            good.append((start, domain.end(), "email"))
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        (good if all(int(x[-4:]) <= 255 and not x[:-4].strip("0") for x in m[0].split(".")) else bad).append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGITS.findall(m[0]))
        if len(digits) >= 12:
            (good if len(digits) <= 19 and luhn(digits) else bad).append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        (good if 9 <= len(_DIGITS.findall(m[0])) <= 15 else bad).append((*m.span(), "phone"))
    return good, bad


def plausible(value: str) -> list[str]:
    """Kinds whose look an unmatched value could have."""
    digits = len(_DIGITS.findall(value))
    kinds = []
    if "@" in value[1:-1]:
        kinds.append("email")
    if digits >= 4 and (value.count(".") == 3 or value.count(":") >= 2) and not value.isdigit():
        kinds.append("ip")
    if 12 <= digits <= 19 and digits >= 0.7 * len(value):
        kinds.append("card")
    if 7 <= digits <= 15 and digits >= 0.5 * len(value):
        kinds.append("phone")
    return kinds


def as_key(value: str) -> str:
    return value if len(value) <= LONG_KEY else hashlib.blake2b(value.encode(), digest_size=16).hexdigest()


def word_before(text: str, at: int) -> tuple[int, int]:
    """Start and end of the last word before a place (of what stands of it there); empty if there is none."""
    end = at
    while end and text[end - 1] in _SPACES:
        end -= 1
    start = end
    while start and text[start - 1] not in _SPACES:
        start -= 1
    return start, end


def context(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: the two words before it, the one before it with the one after."""
    tidy = lambda w: as_key(_DIGITS.sub("0", w.lower()))
    a, b = word_before(text, start)
    c, d = word_before(text, a)
    left = [tidy(text[x:y]) for x, y in ((c, d), (a, b)) if x < y]
    after = _NO_SPACE.search(text, end)
    patterns = []
    if len(left) == 2:
        patterns.append(f"{left[0]} {left[1]} _")
    if left and after:
        patterns.append(f"{left[-1]} _ {tidy(after[0])}")
    if left and not text[b - 1].isalnum():  # a label such as `tel:` tells enough by itself
        patterns.append(f"{left[-1]} _")
    return patterns


_OCCURRENCE = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("value", T.StringType()),
            T.StructField("kind", T.StringType()),
            T.StructField("looks", T.ArrayType(T.StringType())),
            T.StructField("patterns", T.ArrayType(T.StringType())),
        ]
    )
)
_COUNTS = [(f"n_{kind}", T.LongType()) for kind in ORDER]


def _make() -> Callable:
    none = digest([], ORDER)

    def work(texts: pa.Array) -> list:
        maybe = pc.match_substring_regex(pc.fill_null(texts, ""), "[0-9@]").to_pylist()
        rows = []
        for text, look in zip(texts_of(texts), maybe, strict=True):
            if not look:
                rows.append((0, 0, 0, 0, none, "", []))
                continue
            good, bad = base_matches(text)
            counts = Counter(kind for _, _, kind in good)
            taken = sorted(good + bad)
            found = [{"start": s, "end": e, "value": as_key(text[s:e].lower()), "kind": kind, "looks": [], "patterns": context(text, s, e)} for s, e, kind in good]
            at = 0
            for m in _IDENTIFIER.finditer(text):
                while at < len(taken) and taken[at][1] <= m.start():
                    at += 1
                start, end = m.start(), m.start() + len(m[0].rstrip(".,;:!?)\"'"))
                near, covered = at, False
                while near < len(taken) and taken[near][0] < end and not covered:
                    covered = taken[near][1] > start
                    near += 1
                if covered:
                    continue
                looks = plausible(text[start:end])
                if looks:
                    found.append({"start": start, "end": end, "value": as_key(text[start:end].lower()), "kind": None, "looks": looks, "patterns": context(text, start, end)})
            rows.append((*(counts[k] for k in ORDER), digest(good, ORDER), joined(good, ORDER), found))
        return [list(x) for x in zip(*rows, strict=True)]

    return work


def learn(occurrences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confident patterns (pattern, kind, confidence) and believed new values (value, kind, belief).

    occurrences: value, kind (null if not a seed), looks, patterns."""
    # Repeated pattern-value pairs are summed before anything is joined, so a hot context costs
    # a row for each value and not for each mention.
    edges = staged(
        occurrences.select("value", "kind", "looks", F.explode("patterns").alias("pattern")).groupBy("pattern", "value", "kind", "looks").agg(F.count("*").alias("n")),
        "pii-edges",
    )
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    seeds = edges.where(F.col("kind").isNotNull()).select("value", "kind").distinct().withColumn("belief", F.lit(1.0))
    believed, patterns = seeds, None
    for k in range(ROUNDS):
        known = edges.select("pattern", "value", "n").join(believed, "value")
        evidence = known.groupBy("pattern", F.col("kind").alias("for_kind")).agg(F.sum(F.col("n") * F.col("belief")).alias("weight"), F.count_distinct("value").alias("support"))
        patterns = staged(
            evidence.where(F.col("support") >= LEAST_SUPPORT)
            .join(totals, "pattern")
            .withColumn("confidence", F.col("weight") / (F.col("total") + SMOOTHING))
            .where(F.col("confidence") >= LEAST_CONFIDENCE)
            .select("pattern", "for_kind", "confidence"),
            f"pii-patterns-{k}",
        )
        fresh = (
            edges.where(F.col("kind").isNull())
            .join(patterns, "pattern")
            .where(F.array_contains("looks", F.col("for_kind")))
            .groupBy("value", F.col("for_kind").alias("kind"))
            .agg((1 - F.exp(F.sum("n") * F.avg(F.log(1 - F.col("confidence"))))).alias("belief"))
        )
        believed = seeds.unionByName(fresh)
    return patterns, believed.where(F.col("belief") >= LEAST_BELIEF)


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts and digest, and all spans, of every document."""
    fields = [*_COUNTS, ("base_sha256", T.StringType()), ("base_spans", T.StringType()), ("found", _OCCURRENCE)]
    read = map_text(docs, _make, [F.col(text_col)], fields, keep=[F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("__row")])
    read = staged(read, "pii-read")  # the row key must not change between the two joins below
    occurrences = read.where(F.size("found") > 0).select("__row", F.explode("found").alias("o")).select("__row", "o.*")
    _, believed = learn(occurrences)
    new = (
        occurrences.where(F.col("kind").isNull())
        .select("__row", "start", "end", "value", "looks")
        .join(believed.select("value", F.col("kind").alias("new_kind")), "value")
        .where(F.array_contains("looks", F.col("new_kind")))
        .groupBy("__row")
        .agg(F.collect_set(F.concat_ws(":", "new_kind", "start", "end")).alias("new_spans"))
    )
    listed = F.filter(F.concat(F.split("base_spans", ","), F.coalesce("new_spans", F.array())), lambda s: s != "")
    rank = F.create_map(*[F.lit(x) for pair in ORDER.items() for x in pair])
    keyed = F.transform(listed, lambda s: F.struct(F.split(s, ":")[1].cast("int").alias("start"), rank[F.split(s, ":")[0]].alias("rank"), F.split(s, ":")[2].cast("int").alias("end"), s.alias("span")))
    spans = F.array_join(F.transform(F.array_sort(keyed), lambda s: s["span"]), ",")
    return read.drop("found").join(new, "__row", "left").select("doc_id", *[name for name, _ in _COUNTS], "base_sha256", spans.alias("spans"))
