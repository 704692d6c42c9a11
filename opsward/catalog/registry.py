"""Register of named queries: a Spark callable and, where SQL can say it, its twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .oracle import sql
from .workspace import Workspace


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Workspace], DataFrame]
    oracle: str | None
    #: The twin without the named blocks it uses.
    statement: str | None = None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[Workspace], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, build, sql(oracle) if oracle else None, oracle)
        return build

    return register


def plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and decimals as double, so results compare across engines."""
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint").alias(field.name)
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double").alias(field.name)
        columns.append(c)
    return df.select(*columns)
