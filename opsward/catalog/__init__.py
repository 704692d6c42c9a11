"""Registered queries over the bound test tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import basics, insights, quality  # noqa: F401  (registration)
from .registry import REGISTRY, plain_types
from . import workspace as workspaces


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_types(REGISTRY[name].build(workspaces.workspace(spark, sf_dir)))


__all__ = ["REGISTRY", "run"]
