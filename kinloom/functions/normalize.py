"""Multilingual names and addresses as Column expressions.

Only what Spark lacks (compatibility normalisation, full case folding, HTML entities and
script-aware accents) runs in two Arrow UDFs over plain strings; all rules are native.
"""

from __future__ import annotations

import html
import sys
import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinloom.session import ship_package, staged

# Texts that stand for nothing, legal forms, countries, states, road words.
MISSING = ["", "null", "<null>", "none", "<none>", "n/a", "na", "nan", "<na>", "-", "--"]
LEGAL_FORMS = {"pvt": "private", "ltd": "limited", "corp": "corporation", "co": "company", "inc": "incorporated", "llp": "llp", "llc": "llc"}
MORE_SUFFIXES = ["plc", "sarl", "sas", "sasu", "eurl"]
COUNTRIES = {
    "india": "IN", "in": "IN", "ind": "IN", "us": "US", "usa": "US", "united states": "US", "united states of america": "US",
    "fr": "FR", "fra": "FR", "france": "FR",
}
US_STATES = {
    "al": "alabama", "ak": "alaska", "az": "arizona", "ar": "arkansas", "ca": "california", "co": "colorado", "ct": "connecticut",
    "de": "delaware", "fl": "florida", "ga": "georgia", "hi": "hawaii", "id": "idaho", "il": "illinois", "in": "indiana", "ia": "iowa",
    "ks": "kansas", "ky": "kentucky", "la": "louisiana", "me": "maine", "md": "maryland", "ma": "massachusetts", "mi": "michigan",
    "mn": "minnesota", "ms": "mississippi", "mo": "missouri", "mt": "montana", "ne": "nebraska", "nv": "nevada", "nh": "new hampshire",
    "nj": "new jersey", "nm": "new mexico", "ny": "new york", "nc": "north carolina", "nd": "north dakota", "oh": "ohio", "ok": "oklahoma",
    "or": "oregon", "pa": "pennsylvania", "ri": "rhode island", "sc": "south carolina", "sd": "south dakota", "tn": "tennessee", "tx": "texas",
    "ut": "utah", "vt": "vermont", "va": "virginia", "wa": "washington", "wv": "west virginia", "wi": "wisconsin", "wy": "wyoming",
    "dc": "district of columbia",
}
INDIA_STATES = [
    "andhra pradesh", "arunachal pradesh", "assam", "bihar", "chhattisgarh", "goa", "gujarat", "haryana", "himachal pradesh", "jharkhand",
    "karnataka", "kerala", "madhya pradesh", "maharashtra", "manipur", "meghalaya", "mizoram", "nagaland", "odisha", "punjab", "rajasthan",
    "sikkim", "tamil nadu", "telangana", "tripura", "uttar pradesh", "uttarakhand", "west bengal", "delhi", "chandigarh", "puducherry",
    "jammu and kashmir", "ladakh", "lakshadweep", "andaman and nicobar islands", "dadra and nagar haveli and daman and diu",
]
ROAD_WORDS = {"rd": "road", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "ln": "lane", "hwy": "highway"}
LATE_ROAD_WORDS = {"st": "street", "dr": "drive"}
FRENCH_ROAD_WORDS = {"av": "avenue", "bd": "boulevard"}

# Separators, tags and marks of addresses, the shapes of house numbers, and what a locality is called.
PIECE_ENDS = r"[,;|\n\r]+"
PLACEHOLDER = r"<\s*(?:null|none|na)\s*>"
HOUSE_NUMBER = r"(?U)^(?:(?:plot|house|door|no|number)\s+)?([a-z]?\d+[a-z]?(?:[-/][a-z0-9]+)*)\b"
LOCALITIES = r"(?U)\b(?:nagar|colony|sector|phase|locality)\b"

#: Decimal digits of all other scripts, and the ASCII ones that they stand for.
_OTHER_DIGITS = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd")
_THEIR_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)
_CUT = "\ue000"  # a private character: it outlives folding, so parts of an address can be folded in one go
_ID_TAG = r"(?i)\(\s*id\s*:\s*[^)]*\)|\[\s*id\s*:\s*[^\]]*\]"
_FORMAT_MARKS = regex.compile(r"[\p{Cf}--[\u200c\u200d]]", regex.V1)
_CONTROLS = regex.compile(r"\p{Cc}")
_ACCENTED = regex.compile(r"(\p{Script=Latin})\p{M}+")


def _fold(value: str | None) -> str | None:
    if value is None:
        return None
    folded = unicodedata.normalize("NFKC", html.unescape(value)).casefold()
    return " ".join(_FORMAT_MARKS.sub("", _CONTROLS.sub(" ", folded)).split())


@F.pandas_udf(T.StringType())
def unicode_normalized(values: pd.Series) -> pd.Series:
    """Entities resolved, NFKC, case folded, controls to spaces, format marks but joiners dropped, spaces collapsed."""
    return values.map(_fold)


@F.pandas_udf(T.StringType())
def latin_folded(values: pd.Series) -> pd.Series:
    """Marks after Latin letters dropped; vowel signs of other scripts stay."""
    plain = lambda v: None if v is None else unicodedata.normalize("NFC", _ACCENTED.sub(r"\1", unicodedata.normalize("NFD", v)))
    return values.map(plain)


def _literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _spaced(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


def basic(normalized: Column, address: bool = False) -> Column:
    """Words of a normalised text: dotted acronyms closed, `&` spelt out, other marks to spaces.

    In addresses, slash and hyphen stay between letters or digits."""
    closed = F.regexp_replace(normalized, r"(?U)(?:(?<!\w)(?=(?:[a-z]\.){2})|\G(?!^))([a-z])\.", "$1")
    spelt = F.replace(closed, F.lit("&"), F.lit(" and "))
    drop = r"[^\p{L}\p{M}\p{N}\u200c\u200d]"
    if address:
        drop = r"[^\p{L}\p{M}\p{N}\u200c\u200d/-]|(?<![\p{L}\p{N}])[/-]|[/-](?![\p{L}\p{N}])"
    return _spaced(F.regexp_replace(spelt, drop, " "))


def is_missing(normalized: Column) -> Column:
    return normalized.isNull() | normalized.isin(MISSING)


def country_key(normalized: Column) -> Column:
    """Two letters of a known country, else the name in capitals; empty where missing."""
    words = basic(normalized)
    return F.when(is_missing(normalized), "").otherwise(F.coalesce(_literal_map(COUNTRIES)[words], F.upper(words)))


def expanded_legal_forms(words: Column) -> Column:
    table = _literal_map(LEGAL_FORMS)
    return F.array_join(F.transform(F.split(words, " "), lambda t: F.coalesce(table[t], t)), " ")


def without_suffixes(words: Column) -> Column:
    """Trailing legal forms removed, all of them."""
    forms = "|".join(sorted({*LEGAL_FORMS.values(), *MORE_SUFFIXES}))
    return F.regexp_replace(words, rf"(?:(?:^| )(?:{forms}))+$", "")


def token_key(words: Column) -> Column:
    """Sorted distinct words."""
    return F.array_join(F.array_sort(F.array_distinct(F.split(words, " "))), " ")


def zero_normalized(text: Column) -> Column:
    """Runs of digits as numbers: ASCII digits for those of any script, no leading zeros."""
    plain = F.when(text.rlike(r"[^\x00-\x7f]"), F.translate(text, _OTHER_DIGITS, _THEIR_DIGITS)).otherwise(text)
    return F.regexp_replace(plain, r"(?<![0-9])0+(?=[0-9])", "")


def with_name_columns(df: DataFrame, raw: str = "business_name") -> DataFrame:
    """The name columns but the accent-free one; two UDF columns, the rest native."""
    ship_package(df.sparkSession)
    text = F.coalesce(F.col(raw), F.lit(""))
    df = df.withColumns({"name_raw": text, "name_normalized_unicode": unicode_normalized(text), "__untagged": unicode_normalized(F.regexp_replace(text, _ID_TAG, " "))})
    missing = is_missing(F.col("name_normalized_unicode"))
    df = df.withColumns(
        {
            "name_basic": F.when(missing, "").otherwise(basic(F.col("name_normalized_unicode"))),
            "name_expanded": F.when(missing, "").otherwise(expanded_legal_forms(basic(F.col("__untagged")))),
            "name_missing": missing.cast("int"),
            "name_had_id_tag": text.rlike(_ID_TAG).cast("int"),
        }
    )
    core = without_suffixes(F.col("name_expanded"))
    df = df.withColumn("name_without_suffix", core)
    return df.withColumns(
        {
            "name_token_key": token_key(F.col("name_without_suffix")),
            "name_compact": F.replace(F.col("name_without_suffix"), F.lit(" "), F.lit("")),
        }
    ).drop("__untagged")


def _us_state(part: Column) -> Column:
    bare = F.trim(F.regexp_replace(part, r"(?U)\b\d{5}(?:-\d{4})?\b", ""))
    codes, names = _literal_map({c: c.upper() for c in US_STATES}), _literal_map({n: c.upper() for c, n in US_STATES.items()})
    return F.coalesce(codes[bare], names[bare], codes[F.regexp_extract(bare, r"\s([a-z]{2})$", 1)])


def _road_words(part: Column, country: Column) -> Column:
    english, late, french = _literal_map(ROAD_WORDS), _literal_map(LATE_ROAD_WORDS), _literal_map(FRENCH_ROAD_WORDS)
    numbered = part.rlike(r"^[^ ]*\p{Nd}")

    def word(token: Column, at: Column) -> Column:
        local = F.coalesce(english[token], F.when((at >= 2) & numbered, late[token]), F.when((country == "IN") & (token == "nr"), F.lit("near")))
        return F.coalesce(F.when(country.isin("US", "IN"), local), F.when(country == "FR", french[token]), token)

    return F.array_join(F.transform(F.split(part, " "), word), " ")


def with_address_columns(df: DataFrame, raw: str = "business_address") -> DataFrame:
    """The address columns but the accent-free one; needs country_key."""
    ship_package(df.sparkSession)
    text, country = F.coalesce(F.col(raw), F.lit("")), F.col("country_key")
    df = df.withColumns({"address_raw": text, "__pieces": F.split(unicode_normalized(F.regexp_replace(text, PIECE_ENDS, _CUT)), _CUT)})
    df = df.withColumn("__pieces", F.transform("__pieces", lambda p: F.trim(p)))
    df = df.withColumns(
        {
            "address_component_missing": F.exists("__pieces", lambda p: (p.isin(MISSING) & (p != "")) | (~p.isin(MISSING) & p.rlike(PLACEHOLDER))).cast("int"),
            "__parts": F.filter(F.transform(F.filter("__pieces", lambda p: ~p.isin(MISSING)), lambda p: basic(F.regexp_replace(p, PLACEHOLDER, " "), True)), lambda p: p != ""),
        }
    )
    state_of = lambda p: F.when(country == "US", _us_state(p)).when((country == "IN") & p.isin(INDIA_STATES), p)
    found = F.filter(F.transform("__parts", lambda p, i: F.struct(i.alias("at"), state_of(p).alias("state"))), lambda x: x["state"].isNotNull())
    df = df.withColumn("__found", F.try_element_at(found, F.lit(-1))).withColumn("address_basic", F.array_join("__parts", " "))
    words = "|".join([*US_STATES, *US_STATES.values()])
    french = F.filter("__parts", lambda p: p.rlike(r"(?U)^\d{5}\s+\D+$"))
    postal = (
        F.when(country == "IN", F.regexp_extract("address_basic", r"(?U)(?<!\w)[1-9]\d{5}(?!\w)", 0))
        .when(country == "US", F.regexp_extract("address_basic", rf"(?U)\b(?:{words})\s+(\d{{5}}(?:-\d{{4}})?)(?!\w)", 1))
        .when(country == "FR", F.substring(F.try_element_at(french, F.lit(1)), 1, 5))
    )
    first = F.coalesce(F.try_element_at("__parts", F.lit(1)), F.lit(""))
    house = F.regexp_extract(first, HOUSE_NUMBER, 1)
    df = df.withColumns({"state_candidate": F.coalesce("__found.state", F.lit("")), "__at": F.coalesce("__found.at", F.lit(-1)), "postal_code_candidate": F.coalesce(postal, F.lit("")), "__first": first})
    df = df.withColumn("house_number_candidate", F.when(house != F.col("postal_code_candidate"), house).otherwise(""))
    before = F.when(F.col("__at") > 0, F.try_element_at("__parts", F.col("__at")))
    full = F.coalesce(_literal_map({c.upper(): n for c, n in US_STATES.items()})[F.col("state_candidate")], F.lit(""))
    whole_state = lambda p, i: (i == F.col("__at")) & ((p == F.lower("state_candidate")) | (p == full))
    df = df.withColumns(
        {
            "city_candidate": F.when(before != F.col("__first"), before).otherwise(""),
            "__roads": F.transform("__parts", lambda p, i: F.when(whole_state(p, i), p).otherwise(_road_words(p, country))),
            "__numbers": F.array_sort(F.array_distinct(F.filter(F.split("address_basic", " "), lambda t: t.rlike(r"\p{Nd}")))),
        }
    )
    locality = F.filter("__roads", lambda p: p.rlike(LOCALITIES))
    df = df.withColumn("address_normalized", F.array_join("__roads", " "))
    return df.withColumns(
        {
            "address_tokens": F.array_join(F.array_sort(F.array_distinct(F.filter(F.split("address_normalized", " "), lambda t: t != ""))), "|"),
            "address_numbers": F.array_join("__numbers", "|"),
            "address_numbers_zero_normalized": F.array_join(F.array_sort(F.array_distinct(F.transform("__numbers", zero_normalized))), "|"),
            "house_number_zero_normalized": zero_normalized(F.col("house_number_candidate")),
            "street_candidate": F.when(F.col("house_number_candidate") != "", F.try_element_at("__roads", F.lit(1))).otherwise(""),
            "locality_candidate": F.coalesce(F.try_element_at(locality, F.lit(1)), F.lit("")),
            "address_missing": (F.size("__parts") == 0).cast("int"),
        }
    ).drop("__pieces", "__parts", "__found", "__at", "__first", "__roads", "__numbers")


def with_latin_columns(df: DataFrame) -> DataFrame:
    """Accent-free name and address; their inputs must be stored columns, not expressions over other UDFs."""
    return df.withColumns({f"{f}_latin_folded": latin_folded(F.col(c)) for f, c in (("name", "name_without_suffix"), ("address", "address_normalized"))})


def clean_records(raw: DataFrame) -> DataFrame:
    """Raw columns and the derived ones of names, addresses and countries."""
    keyed = raw.withColumn("country_key", country_key(unicode_normalized(F.coalesce("country", F.lit("")))))
    # Staged: Spark does not tell UDFs over long expressions of other UDFs apart in one projection.
    return with_latin_columns(staged(with_address_columns(with_name_columns(keyed)), "cleaned"))
