"""Stable hashes: term buckets and splits."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def term_bucket(bits: int):  # noqa: ANN201
    """UDF from a term to one of 2^bits buckets (low bits of its 64-bit BLAKE2b, little-endian).

    Meant for distinct terms, so that each is hashed once."""
    mask = (1 << bits) - 1

    @F.pandas_udf(T.LongType())
    def bucket(terms: pd.Series) -> pd.Series:
        return terms.map(lambda t: int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "little") & mask)

    return bucket


@F.pandas_udf(T.DoubleType())
def unit_hash(keys: pd.Series) -> pd.Series:
    """A key as a number in [0, 1), by its 64-bit BLAKE2b, big-endian."""
    return keys.map(lambda k: int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "big") / 2**64)


def md5_unit(key: Column) -> Column:
    """The same idea natively: 52 bits of MD5."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def split_of(share: Column, validation_fraction: float) -> Column:
    return F.when(share < validation_fraction, "validation").otherwise("train")


def query_split_key(seed: int, country: Column, has_match: Column, sid: Column) -> Column:
    return F.concat_ws("|", F.lit(str(seed)), country, has_match.cast("int").cast("string"), sid)
