"""Work on reports that may fail: a report that raises becomes a status row, and the rest goes on."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: So much of an error's message is kept.
MESSAGE = 500


def _told(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"[:MESSAGE]


def _schema(df: DataFrame, keys: list[str], schema: str) -> tuple[T.StructType, list[str]]:
    made = T.StructType.fromDDL(schema)
    return T.StructType([*(df.schema[k] for k in keys), *made.fields, T.StructField("error", T.StringType())]), made.names


def each(df: DataFrame, keys: list[str], text: str, work: Callable[[str], Iterable[tuple]], schema: str) -> DataFrame:
    """keys, the columns of schema and error: the rows that work makes of each row's text.

    A text that raises gives one row with its error and nothing else, and so does one that gives no rows, with no error.  Rows
    are worked on where they are, in Arrow batches.
    """
    out, names = _schema(df, keys, schema)

    def rows(value: str) -> list[tuple]:
        try:
            made = [(*r, None) for r in work(value)]
        except Exception as error:  # whatever a report may hold, it must not stop the others
            return [(*[None] * len(names), _told(error))]
        return made or [(*[None] * len(names), None)]

    def batch(batches):
        for pdf in batches:
            found = [(*key, *r) for *key, value in zip(*(pdf[k] for k in keys), pdf[text]) for r in rows(value)]
            yield pd.DataFrame(found, columns=out.names)

    return df.select(*keys, text).mapInPandas(batch, out)


def grouped(df: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """keys, the columns of schema and error: what work makes of each group, as each() does for rows."""
    out, names = _schema(df, keys, schema)

    def group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            made = work(pdf)[names].assign(error=None)
        except Exception as error:
            made = pd.DataFrame([(*[None] * len(names), _told(error))], columns=[*names, "error"])
        if not len(made):
            made = pd.DataFrame([[None] * (len(names) + 1)], columns=[*names, "error"])
        return made.assign(**dict(zip(keys, key)))[out.names]

    return df.groupBy(*keys).applyInPandas(group, out)


def statuses(done: DataFrame, keys: list[str]) -> DataFrame:
    """keys and error (null where all went well) of everything that was tried."""
    return done.groupBy(*keys).agg(F.max("error").alias("error"))


def results(done: DataFrame, key: str) -> DataFrame:
    """The rows that work made; key: one of its columns, which it never leaves null."""
    return done.where(F.col("error").isNull() & F.col(key).isNotNull()).drop("error")
