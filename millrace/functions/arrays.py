"""Array and label-vector expressions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def pad_to(values: Column, width: int, fill: float = 0.0) -> Column:
    """Fixed-length array: zero-padded at the end; longer input is refused.

    Refusing rather than cutting keeps whole inputs whole.
    """
    missing = F.lit(width) - F.size(values)
    filled = F.concat(values, F.array_repeat(F.lit(fill), F.greatest(missing, F.lit(0))))
    refused = F.raise_error(F.lit(f"array longer than {width}")).cast(T.ArrayType(T.DoubleType()))
    return F.when(missing < 0, refused).otherwise(filled)


def rescale(values: Column, divisor: float) -> Column:
    return F.transform(values, lambda v: v / F.lit(divisor))


def multi_hot(indices: Column, width: int) -> Column:
    """0/1 array with ones at the given zero-based positions."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.array_contains(indices, i).cast("int"),
    )


def label_position(label: Column, labels: Sequence[str]) -> Column:
    """Zero-based position in a fixed label list; labels not listed give 0, as an argmax over no match does."""
    found = F.array_position(F.array(*[F.lit(v) for v in labels]), label)
    return F.greatest(found - 1, F.lit(0))


def frames(values: Column, length: int, step: int) -> Column:
    """Overlapping windows of a signal; a tail shorter than `length` is dropped."""
    last = F.floor((F.size(values) - length) / step).cast("int")
    windows = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.slice(values, i * step + 1, length),
    )
    none = F.array().cast("array<array<double>>")
    return F.when(values.isNotNull(), F.when(last >= 0, windows).otherwise(none))


@F.pandas_udf(T.ArrayType(T.FloatType()))
def bytes_to_floats(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Raw unsigned bytes to float values, one per byte."""
    for batch in parts:
        yield batch.map(lambda raw: np.frombuffer(raw, np.uint8).astype(np.float32), na_action="ignore")
