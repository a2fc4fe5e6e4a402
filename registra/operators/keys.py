"""Access keys: creation, revocation, tiers, validity, usage counters."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Requests and seconds of the window of each tier; 0 is without limit.
TIERS = {"standard": (1_000, 3_600), "elevated": (5_000, 3_600), "unlimited": (0, 3_600)}
ROUNDS, PREFIX_CHARS = 100_000, 12


def _pairs(i: int) -> Column:
    return F.create_map(*[F.lit(x) for name, values in TIERS.items() for x in (name, values[i])])


def with_defaults(df: DataFrame, tier: str) -> DataFrame:
    """Rate limit and window of each row's tier; unknown tiers get the standard ones."""
    known = F.when(F.col(tier).isin(list(TIERS)), F.col(tier)).otherwise("standard")
    return df.withColumn("rate_limit", F.try_element_at(_pairs(0), known)).withColumn("rate_window", F.try_element_at(_pairs(1), known))


def active(keys: DataFrame, now: Column) -> DataFrame:
    """Keys that are neither revoked nor expired."""
    return keys.where(F.col("revoked_at").isNull() & (F.col("expires_at").isNull() | (F.col("expires_at") > now)))


def usage(requests: DataFrame, key: str, ts: str) -> DataFrame:
    """Requests and last use of each key, to be added to stored counters."""
    return requests.groupBy(key).agg(F.count("*").alias("total_requests"), F.max(ts).alias("last_used"))


def counted(keys: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """``keys`` with a batch of usage added to total_requests and last_used."""
    more = used.select(F.col(key).alias("_key"), F.col("total_requests").alias("_n"), F.col("last_used").alias("_at"))
    out = keys.join(more, keys[key] == more["_key"], "left")
    out = out.withColumn("total_requests", F.col("total_requests") + F.coalesce("_n", F.lit(0)))
    return out.withColumn("last_used", F.greatest("last_used", "_at")).drop("_key", "_n", "_at")


def derived(df: DataFrame, secret: str, salt: bytes, rounds: int = ROUNDS) -> DataFrame:
    """key_hash (PBKDF2 with SHA-256, hex) and key_prefix of a secret column; Spark has no such function."""

    @F.pandas_udf("string")
    def key_hash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda k: None if k is None else hashlib.pbkdf2_hmac("sha256", k.encode(), salt, rounds).hex())

    return df.withColumn("key_hash", key_hash(F.col(secret))).withColumn("key_prefix", F.substring(secret, 1, PREFIX_CHARS)).drop(secret)


def revoked(keys: DataFrame, key: str, ids: list[str], now: Column) -> DataFrame:
    return keys.withColumn("revoked_at", F.when(F.col(key).isin(ids) & F.col("revoked_at").isNull(), now).otherwise(F.col("revoked_at")))
