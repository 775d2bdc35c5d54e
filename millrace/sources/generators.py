"""Generated tables that repeat exactly: every draw is a hash of its key and seed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators.sequences import running_sums


def uniform(*parts: Column | str) -> Column:
    """Number in (0, 1) from 52 bits of the md5 of the joined parts."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return (bits.cast("double") + 0.5) / float(1 << 52)


def gaussian(*parts: Column | str) -> Column:
    """Standard normal draw by the Box-Muller transform."""
    radius = F.sqrt(-2.0 * F.log(uniform("r", *parts)))
    return radius * F.cos(2.0 * math.pi * uniform("a", *parts))


def transactions(customers: DataFrame, key: str, seed: int = 7, first_id: int = 100_000) -> DataFrame:
    """1 + floor(Exp(mean 3)) transactions per customer with amounts ~ N(0, 200), ids counted from `first_id`.

    Ids continue over customers in key order, from a running sum of counts.
    """
    tag = str(seed)
    many = (1 + F.floor(-3.0 * F.log(uniform("n", tag, F.col(key))))).cast("bigint")
    counted = customers.select(key).withColumn("_many", many)
    numbered = running_sums(counted, [], [key], {"_upto": F.col("_many")})
    rows = numbered.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_many") - 1)))
    return rows.select(
        (F.lit(first_id) + F.col("_upto") - F.col("_many") + F.col("_i")).alias("TransactionId"),
        F.col(key).alias("CustomerId"),
        (200.0 * gaussian(tag, F.col(key), F.col("_i"))).alias("Amount"),
    )


def noisy_waves(spark: SparkSession, samples: int = 3000, step: float = 0.01, hertz: float = 10.0, seed: int = 7) -> DataFrame:
    """Two signals that share a sine wave and differ in noise: (ordinal, x, y)."""
    rows = spark.range(samples).withColumnRenamed("id", "ordinal")
    wave = F.sin(2.0 * math.pi * hertz * step * F.col("ordinal"))
    noise = lambda name: gaussian(name, str(seed), F.col("ordinal"))
    return rows.select("ordinal", (wave + noise("x")).alias("x"), (wave + noise("y")).alias("y"))


def random_payloads(spark: SparkSession, sizes: list[int], seed: int = 7, piece: int = 1 << 20) -> DataFrame:
    """Random bytes in pieces of at most `piece` bytes: (payload, part, content)."""
    pieces = [
        (number, part, min(piece, size - part * piece))
        for number, size in enumerate(sizes)
        for part in range(math.ceil(size / piece))
    ]

    def fill(batches):
        import numpy as np

        for batch in batches:
            content = [
                np.random.default_rng((seed, int(n), int(p))).bytes(int(s))
                for n, p, s in zip(batch["payload"], batch["part"], batch["size"])
            ]
            yield batch[["payload", "part"]].assign(content=content)

    frame = spark.createDataFrame(pieces, "payload int, part int, size int")
    return frame.repartition("payload", "part").mapInPandas(fill, "payload int, part int, content binary")
