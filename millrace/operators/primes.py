"""Primes among candidate keys, and gap tests on sorted keys."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from millrace.operators.sequences import with_neighbour

# Bases that decide every number below 2^64, and small divisors tried first.
BASES = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)


def is_prime(n: int) -> bool:
    """Miller-Rabin, exact for 64-bit numbers."""
    if n < 2:
        return False
    for p in BASES:
        if n % p == 0:
            return n == p
    odd = n - 1
    twos = (odd & -odd).bit_length() - 1
    odd >>= twos
    for base in BASES:
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def _prime_flags(values: pa.Array) -> pa.Array:
    numbers = pc.fill_null(values, 0).to_numpy(zero_copy_only=False)
    left = numbers >= 2
    for p in BASES:
        left &= (numbers % p != 0) | (numbers == p)
    # few numbers survive the small divisors
    left[left] = [is_prime(n) for n in numbers[left].tolist()]
    return pa.array(left)


def prime_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is prime, in one pass without a shuffle.

    Any 64-bit value; each Arrow batch is sieved by the smallest primes at once,
    and what is left costs a few modular powers per number.
    """
    return df.where(F.arrow_udf(_prime_flags, "boolean")(F.col(column).cast("bigint")))


def sparse_ranges(df: DataFrame, column: str, lower: int = 25, rule: str = "nagura") -> DataFrame:
    """Ranges of n in [lower, largest key) with no key close above them.

    rule "nagura": some key must satisfy n < key < 1.2 n; rule "bertrand":
    n < key < 2n - 2.  For n between two neighbouring keys only the upper one
    matters, so the violators of a gap are one range known from its two ends.
    """
    keys = df.select(F.col(column).cast("bigint").alias("key")).where("key is not null").distinct()
    gaps = with_neighbour(keys, [], ["key"], {"below": "key"})
    start = F.greatest(F.coalesce("below", F.lit(lower)), F.lit(lower)).cast("bigint")
    if rule == "nagura":
        last = F.expr("key * 5 div 6")  # largest n with key >= 1.2 n
    elif rule == "bertrand":
        last = F.expr("(key + 2) div 2")  # largest n with key >= 2n - 2
    else:
        raise ValueError("rule is nagura or bertrand")
    end = F.least(F.col("key") - 1, last).cast("bigint")
    return (
        gaps.select("below", F.col("key").alias("above"), start.alias("first_n"), end.alias("last_n"))
        .where(F.col("first_n") <= F.col("last_n"))
    )
