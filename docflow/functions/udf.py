"""The one Python hook: a user-supplied per-value decoder run as an
Arrow-batched pandas UDF (never row-at-a-time)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.functions.exprs import col_


def decode_column(c: str | Column, fn: Callable[[bytes], str | None]) -> Column:
    """Struct (value, error) of ``fn`` applied to a binary column in Arrow batches.

    ``fn`` replaces an external per-row decoder process; it must be a pure,
    picklable function. A value it fails on has a NULL value and the exception's
    name as error, so one bad value neither fails the task nor is lost silently.
    NULL input gives (NULL, NULL).
    """

    def one(v):
        if v is None:
            return None, None
        try:
            return fn(v), None
        except Exception as e:  # noqa: BLE001 - reported in the error field
            return None, type(e).__name__

    @F.pandas_udf("struct<value: string, error: string>")
    def _decode(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(v) for v in s], columns=["value", "error"], dtype=object)

    return _decode(col_(c))


def utf8_decode(b: bytes) -> str:
    return bytes(b).decode("utf-8")
