"""Query registry: one declared output shape, applied to the Spark result and to the SQL text alike."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.session import spread_exchanges, tune
from arrears.sources.views import BASE_TABLES, Source, with_views

SQL_TYPES = {"long": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@dataclass(frozen=True)
class Query:
    name: str
    columns: dict[str, str]
    build: Callable[[Source], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        source = Source(tune(spark), folder)
        spread_exchanges(spark, source.size())
        result = self.build(source)
        return result.select(*[F.col(c).cast(t).alias(c) for c, t in self.columns.items()])

    @property
    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts = ", ".join(f"CAST({c} AS {SQL_TYPES[t]}) AS {c}" for c, t in self.columns.items())
        body = with_views(self.sql, {name: name for name in BASE_TABLES})
        return f"SELECT {casts} FROM (\n{body}\n) AS result"


REGISTRY: dict[str, Query] = {}


def query(name: str, shape: str, sql: str | None = None):
    """Register a query; ``shape`` lists ``column:type`` with types long, double and string."""
    columns = dict(item.split(":") for item in shape.split())

    def register(build: Callable[[Source], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, columns, build, sql)
        return build

    return register
