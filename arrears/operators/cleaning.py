"""Projection, typing and null policies on whole frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reshape(df: DataFrame, keep: Sequence[str], rename: Mapping[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """Project, rename and drop in one step, so that only these columns are read."""
    return df.select(*keep).withColumnsRenamed(dict(rename or {})).drop(*drop)


def columns_of_type(df: DataFrame, kind: type[T.DataType] = T.StringType) -> DataFrame:
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, kind)])


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill named columns; keys that the frame lacks are an error, unlike ``fillna``."""
    missing = [c for c in values if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.fillna(dict(values))


def fill_everything(df: DataFrame, number: int = 0, text: str = "0") -> DataFrame:
    """Fill every missing number with 0 and every missing text with its own constant."""
    filled = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            filled.append(F.coalesce(F.col(f.name), F.lit(number).cast(f.dataType)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            filled.append(F.coalesce(F.col(f.name), F.lit(text)).alias(f.name))
        else:
            filled.append(F.col(f.name))
    return df.select(*filled)


def replace_values(df: DataFrame, col: str, to_null: Sequence[str] = (), to_value: Mapping[str, str] | None = None) -> DataFrame:
    """Turn placeholder texts into missing values and map others, after trimming."""
    value = F.trim(F.col(col))
    expression = F.when(value.isin(list(to_null)), F.lit(None)) if to_null else F.when(F.lit(False), value)
    for old, new in (to_value or {}).items():
        expression = expression.when(value == old, F.lit(new))
    return df.withColumn(col, expression.otherwise(value))


def exclude(df: DataFrame, col: str, ids: Sequence[object]) -> DataFrame:
    """Leave out named entities; rows without an id stay."""
    return df.where(F.coalesce(~F.col(col).isin(list(ids)), F.lit(True)))


def partitions(df: DataFrame, flag: str = "da_aberto") -> tuple[DataFrame, DataFrame]:
    """Closed and open rows; on a table partitioned by the flag each side reads its own files only."""
    return df.where(F.col(flag) == 0), df.where(F.col(flag) == 1)


def typed_key(df: DataFrame, col: str, kind: str = "bigint") -> DataFrame:
    """Drop rows without a usable key, then fix its type."""
    cast = F.col(col).try_cast(kind)
    return df.where(cast.isNotNull()).withColumn(col, cast)


def one_hot(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """0/1 column per listed value, added by name next to the existing columns."""
    flags = [F.col(col).eqNullSafe(v).cast("int").alias(f"{col}_{v}") for v in values]
    return df.select("*", *flags)


def learn_one_hot(df: DataFrame, col: str) -> PipelineModel:
    """Categories learned from the data, most frequent first, as a stage that is saved with a model.

    Rows with a category that was not seen, or with none, get a vector in a place of its own.
    """
    number, vector = f"{col}_lugar", f"{col}_vetor"
    indexer = StringIndexer(inputCol=col, outputCol=number, handleInvalid="keep")
    return Pipeline(stages=[indexer, OneHotEncoder(inputCols=[number], outputCols=[vector], dropLast=False)]).fit(df)


def json_records(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One JSON text per row next to its key."""
    return df.select(*key, F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; columns that one lacks are missing there."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked
