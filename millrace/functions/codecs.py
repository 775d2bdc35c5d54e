"""JSON, custom-type codecs, and typed Python functions as Arrow UDFs."""

from __future__ import annotations

import typing
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T


def json_entries(payload: Column, value_type: str = "int") -> Column:
    """JSON object text to a map."""
    return F.from_json(payload, f"map<string,{value_type}>")


def json_field(payload: Column, name: str) -> Column:
    return F.get_json_object(payload, f"$.{name}")


HAPPY, SAD = ":)", ":("


def face_to_flag(text: Column) -> Column:
    """Only the happy face is true; any other text is false."""
    return F.coalesce(text == HAPPY, F.lit(False))


def flag_to_face(flag: Column) -> Column:
    return F.when(flag, F.lit(HAPPY)).otherwise(F.lit(SAD))


_SPARK_TYPES = {
    int: T.LongType(),
    float: T.DoubleType(),
    str: T.StringType(),
    bool: T.BooleanType(),
}


_ARROW_TYPES = {int: pa.int64(), float: pa.float64(), str: pa.string(), bool: pa.bool_()}


def typed_udf(function: Callable) -> Callable[..., Column]:
    """An annotated scalar function as an Arrow UDF.

    Arguments may arrive as text: each is cast to its annotation first, and the
    return annotation gives the column type.  A row with a missing argument
    gives NULL and does not reach the function.  Columns travel as Arrow batches;
    an arbitrary Python function still costs one call per row.
    """
    hints = typing.get_type_hints(function)
    if "return" not in hints:
        raise TypeError(f"{function.__name__} needs a return annotation")
    names = [n for n in hints if n != "return"]
    for n in hints:
        if hints[n] not in _SPARK_TYPES:
            raise TypeError(f"{function.__name__}: no column type for {n}")

    kind = _ARROW_TYPES[hints["return"]]

    def batched(*columns: pa.Array) -> pa.Array:
        rows = zip(*[c.to_pylist() for c in columns])
        return pa.array([None if None in values else function(*values) for values in rows], kind)

    arrow = F.arrow_udf(batched, _SPARK_TYPES[hints["return"]])

    def apply(*columns: Column) -> Column:
        if len(columns) != len(names):
            raise TypeError(f"{function.__name__} takes {len(names)} columns")
        return arrow(*[c.cast(_SPARK_TYPES[hints[n]]) for c, n in zip(columns, names)])

    return apply
