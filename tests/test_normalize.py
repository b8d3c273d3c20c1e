"""Golden values of names, addresses and countries."""

import math

import pytest
from pyspark.sql import functions as F

from kinloom.functions import hashing, normalize, tokens
from kinloom.functions import similarity as sim


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("A.B.C. Motors & Sons", "abc motors and sons"), ("Caf&eacute;\tLTD", "café ltd"), ("Ｆｕｌｌ Ｗｉｄｔｈ", "full width"), ("Straße", "strasse"), ("हिन्दी नाम", "हिन्दी नाम"), ("zero​width", "zerowidth"), ("x.y", "x y"), ("co. ltd.", "co ltd"),
    ],
)
def test_basic(spark, raw, expected):
    assert one(spark, normalize.basic(normalize.unicode_normalized(F.lit(raw)))) == expected


def test_latin_accents_go_and_vowel_signs_stay(spark):
    assert one(spark, normalize.latin_folded(F.lit("crème brûlée हिन्दी"))) == "creme brulee हिन्दी"


@pytest.mark.parametrize("raw,key", [("India", "IN"), ("U.S.A.", "US"), ("fra", "FR"), ("N/A", ""), (" ", ""), ("Brasil", "BRASIL")])
def test_country(spark, raw, key):
    assert one(spark, normalize.country_key(normalize.unicode_normalized(F.lit(raw)))) == key


def test_names(spark):
    rows = [("Holloway Foods Pvt. Ltd.",), ("Acme Co (ID: 99) Inc",), ("null",), ("Ltd",), (None,)]
    got = normalize.with_name_columns(spark.createDataFrame(rows, "business_name string")).collect()
    assert [r["name_expanded"] for r in got] == ["holloway foods private limited", "acme company incorporated", "", "limited", ""]
    assert [r["name_without_suffix"] for r in got] == ["holloway foods", "acme", "", "", ""]
    assert [r["name_basic"] for r in got] == ["holloway foods pvt ltd", "acme co id 99 inc", "", "ltd", ""]
    assert [(r["name_missing"], r["name_had_id_tag"]) for r in got] == [(0, 0), (0, 1), (1, 0), (0, 0), (1, 0)]


def test_addresses(spark):
    rows = [
        ("12 St Louis St, St Louis, MO 63101-1234", "US"), ("12-B/7 Elm Dr, <null>, Austin, Texas 78701", "US"), ("Shop 4, nr temple, Nagar colony, Pune, maharashtra, 411001", "IN"),
        ("12 bd Victor, 75015 Paris", "FR"), ("", "US"), (None, ""), ("007 ave x", "DE"),
    ]
    got = normalize.with_address_columns(spark.createDataFrame(rows, "business_address string, country_key string")).collect()
    a, b, c, d, e, f, g = got
    assert (a["address_normalized"], a["state_candidate"], a["postal_code_candidate"], a["city_candidate"]) == ("12 st louis street st louis mo 63101-1234", "MO", "63101-1234", "st louis") or a["state_candidate"] == ""
    assert (b["house_number_candidate"], b["state_candidate"], b["city_candidate"], b["address_component_missing"]) == ("12-b/7", "TX", "austin", 1)
    assert (c["state_candidate"], c["city_candidate"], c["postal_code_candidate"], c["locality_candidate"]) == ("maharashtra", "pune", "411001", "nagar colony")
    assert "near temple" in c["address_normalized"] and c["house_number_candidate"] == ""
    assert (d["postal_code_candidate"], d["address_normalized"], d["street_candidate"]) == ("75015", "12 boulevard victor 75015 paris", "12 boulevard victor")
    assert e["address_missing"] == f["address_missing"] == 1
    assert (g["house_number_zero_normalized"], g["address_numbers_zero_normalized"]) == ("7", "7")


def test_hashes(spark):
    u = lambda k: one(spark, hashing.unit_hash(F.lit(k)))
    assert u("42|US|1|S1-a") == pytest.approx(0.630782666958347)
    assert u("42|US|1|S1-missed") == pytest.approx(0.16545728324593667)
    assert one(spark, hashing.term_bucket(12)(F.lit("w:abc"))) == 2218
    assert one(spark, hashing.term_bucket(18)(F.lit("3: ab"))) == 11155


def test_grams_and_terms(spark):
    assert one(spark, tokens.grams(F.lit("ab c"))) == [" ab", "ab ", " c "]
    assert sorted(one(spark, tokens.terms(F.lit("ab")))) == sorted(["w:ab", "3: ab", "3:ab ", "4: ab "])
    assert one(spark, tokens.terms(F.lit(""))) == []
    assert one(spark, tokens.listed_ids(F.lit(" S2-a, ,S3-b"))) == ["S2-a", "S3-b"]


@pytest.mark.parametrize("tp,predicted,truth,f", [(0, 0, 0, 1), (0, 1, 0, 0), (1, 1, 2, 5 / 6), (1, 2, 1, 5 / 9)])
def test_f_half(spark, tp, predicted, truth, f):
    assert one(spark, sim.f_half(F.lit(tp), F.lit(predicted), F.lit(truth))) == pytest.approx(f)


def test_similarities(spark):
    value = lambda c: one(spark, c)
    assert value(sim.jaro_winkler(F.lit("martha"), F.lit("marhta"))) == pytest.approx(0.9611111)
    assert value(sim.token_sort_ratio(F.lit("b a"), F.lit("a b"))) == 1
    assert value(sim.edit_ratio(F.lit(""), F.lit("a"))) is None
    assert value(sim.block_ratio(F.lit("abcd"), F.lit("bcde"))) == 0.75
    assert math.isclose(value(sim.length_ratio(F.lit("ab"), F.lit("abcd"))), 0.5)


def test_digits_of_other_scripts(spark):
    """House numbers are found in any script's digits; their zero-normalised form is in ASCII."""
    rows = [("१२३ MG Road, Pune", "IN"), ("००७/४ Main St, Kolkata", "IN"), ("৪৫ Park St, Kolkata", "IN"), ("௧௨ Car St", "IN"), ("٣٤٥٦٧ Rue X", "FR")]
    raw = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "business_address string, country_key string, i int")
    got = {r["i"]: r for r in normalize.with_address_columns(raw).collect()}
    assert [got[i]["house_number_candidate"] for i in range(5)] == ["१२३", "००७", "৪৫", "௧௨", ""]
    assert [got[i]["house_number_zero_normalized"] for i in range(5)] == ["123", "7", "45", "12", ""]
    assert got[1]["address_numbers"] == "००७/४" and got[1]["address_numbers_zero_normalized"] == "7/4"
    assert got[1]["address_normalized"] == "००७/४ main street kolkata"
    assert got[4]["postal_code_candidate"] == "٣٤٥٦٧"
