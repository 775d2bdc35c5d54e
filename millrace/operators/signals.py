"""Spectra of uniformly sampled signals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.arrays import frames, pad_to

SEGMENT = 256


def coherence(df: DataFrame, ordinal: str, x: str, y: str, segment: int = SEGMENT, rate: float = 1.0) -> DataFrame:
    """Magnitude-squared coherence per frequency, from spectra averaged over full segments.

    Hann window, no overlap, no detrending, tail dropped.  A segment is a group
    of `segment` rows; tasks add up spectra of their segments, so one row per
    frequency and task is shuffled.
    """
    sample = F.struct(F.col(ordinal).alias("at"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    segments = (
        df.groupBy(F.floor(F.col(ordinal) / segment).alias("_segment"))
        .agg(F.array_sort(F.collect_list(sample)).alias("s"))
        .where(F.size("s") == segment)
        .select(F.col("s.x").alias("x"), F.col("s.y").alias("y"))
    )

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = np.hanning(segment)
        total = np.zeros((4, segment // 2 + 1))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            fx, fy = (
                np.fft.rfft(c.flatten().to_numpy(zero_copy_only=False).reshape(-1, segment) * window, axis=1)
                for c in batch.columns
            )
            cross = (np.conj(fx) * fy).sum(axis=0)
            total += [(np.abs(fx) ** 2).sum(axis=0), (np.abs(fy) ** 2).sum(axis=0), cross.real, cross.imag]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.shape[1], dtype=np.int32)), *[pa.array(t) for t in total]],
            names=["k", "xx", "yy", "re", "im"],
        )

    partials = segments.mapInArrow(spectra, "k int, xx double, yy double, re double, im double")
    sums = partials.groupBy("k").agg(*[F.sum(c).alias(c) for c in ("xx", "yy", "re", "im")])
    squared = F.try_divide(F.col("re") * F.col("re") + F.col("im") * F.col("im"), F.col("xx") * F.col("yy"))
    return sums.select(
        "k", (F.col("k") * F.lit(rate / segment)).alias("frequency"), squared.alias("coherence")
    )


def short_time_magnitudes(
    samples: Column, pad: int = 16_000, length: int = 255, step: int = 128, fft: int = 256
) -> Column:
    """Magnitudes of windowed, overlapping frames: array (frame) of array (frequency).

    Signals are zero-padded to `pad`; the Hann window is periodic for an even
    length and symmetric for an odd one.
    """
    even = 1 - length % 2
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(length) / (length + even - 1))

    def spectrum(clip: np.ndarray) -> list:
        if not len(clip):
            return []
        return list(np.abs(np.fft.rfft(np.stack(clip).astype(float) * window, fft, axis=1)))

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def magnitudes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in parts:
            yield batch.map(spectrum, na_action="ignore")

    return magnitudes(frames(pad_to(samples.cast("array<double>"), pad), length, step))
