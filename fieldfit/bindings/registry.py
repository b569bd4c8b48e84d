"""Registration of queries with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldfit.bindings.sample import Sample
from fieldfit.bindings.views import compose
from fieldfit.session import tune


@dataclass(frozen=True)
class Query:
    build: Callable[[Sample], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(self.build(Sample(tune(spark), sf_dir)))


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function under its own name; ``sql`` may use the shared views."""

    def register(build):
        REGISTRY[build.__name__] = Query(build, compose(sql) if sql else None)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Comparable column types: wide integers, doubles, and lists as text."""
    out = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            names = kind.elementType.names
            col = F.array_join(
                F.transform(
                    col, lambda x: F.concat_ws(":", *[F.coalesce(x[n].cast("string"), F.lit("")) for n in names])
                ),
                ";",
            )
        elif isinstance(kind, T.ArrayType):
            col = F.array_join(col, ",")
        out.append(col.alias(field.name))
    return df.select(*out)
