"""Words, character n-grams and terms as arrays; keys of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Address words that make no key.
KEY_STOP_WORDS = ["road", "street", "avenue", "lane", "block", "near", "and", "the"]


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def padded_grams(word: Column, n: int, least: int = 0) -> Column:
    """n-grams of a word between spaces, in order; at least `least` even where the word is shorter."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    count = F.greatest(F.lit(least), F.length(padded) - (n - 1))
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.substring(padded, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def grams(text: Column, n: int = 3) -> Column:
    """Distinct n-grams; word order does not matter."""
    return F.array_distinct(F.flatten(F.transform(words(text), lambda w: padded_grams(w, n, 1))))


def _marked(kind: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(kind), v))


def terms(text: Column) -> Column:
    """All words and 3- to 5-grams with their repeats, marked by kind."""

    def of_word(w: Column) -> Column:
        kinds = [_marked(f"{n}:", padded_grams(w, n)) for n in (3, 4, 5)]
        return F.concat(F.array(F.concat(F.lit("w:"), w)), *kinds)

    return F.flatten(F.transform(words(text), of_word))


def lexical_tokens(text: Column) -> Column:
    """Distinct words and 3-grams, marked by kind and sorted."""
    return F.array_sort(F.concat(_marked("w:", F.array_distinct(words(text))), _marked("3:", grams(text))))


def name_text() -> Column:
    return F.coalesce(F.nullif("name_latin_folded", F.lit("")), F.nullif("name_without_suffix", F.lit("")), "name_basic")


def address_text() -> Column:
    return F.coalesce(F.nullif("address_latin_folded", F.lit("")), "address_normalized")


def encoder_text() -> Column:
    return F.format_string("name: %s | address: %s | country: %s", "name_basic", "address_normalized", "country_key")


def listed_ids(text: Column) -> Column:
    """Ids of a comma list, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def _key(channel: str, *values: Column | str) -> Column:
    """A key of one channel, null where a component is empty."""
    parts = [F.lit(channel), *[F.col(v) if isinstance(v, str) else v for v in values]]
    blank = F.lit(False)
    for p in parts[1:]:
        blank = blank | (F.coalesce(p, F.lit("")) == "")
    return F.when(~blank, F.concat_ws("\x1f", *parts))


def block_keys() -> dict[str, Column]:
    """Channel to array of keys: exact names (A), name prefix (B), places (C), house and prefix (D)."""
    name = name_text()
    prefix = F.substring(F.regexp_replace(name, r"\s", ""), 1, 3)
    whole_prefix = F.when(F.length(prefix) == 3, prefix)
    near = F.array_sort(F.array_except(F.array_distinct(words(address_text())), F.array(*[F.lit(w) for w in KEY_STOP_WORDS])))
    told = F.filter(near, lambda t: (F.length(t) >= 3) & ~t.rlike("^[0-9]+$") & ~F.array_contains(words(F.col("city_candidate")), t))
    by_token = F.transform(told, lambda t: _key("city_token", "city_candidate", t))
    some = lambda *keys: F.array_distinct(F.array_compact(F.array(*keys)))
    return {
        "A": some(
            _key("basic", "name_basic"), _key("core", name), _key("suffix_free", "name_without_suffix"), _key("expanded", "name_expanded"), _key("sorted", F.array_join(F.array_sort(words(name)), " ")),
        ),
        "B": some(_key("prefix", whole_prefix)),
        "C": F.array_distinct(F.array_compact(F.concat(
            F.array(_key("postal", "state_candidate", "postal_code_candidate"), _key("postal_only", "postal_code_candidate"), _key("city_name", "city_candidate", F.array_join(F.slice(words(name), 1, 3), " "))), by_token,
        ))),
        "D": some(_key("house", "house_number_zero_normalized", whole_prefix)),
    }
