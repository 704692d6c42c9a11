"""Reading raw files and writing the raw, clean and analytics layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..operators.keys import assert_unique


#: Holds a line that is no record of its table, in a frame that may have such lines.
BROKEN_LINE = "broken_line"


class MalformedInput(ValueError):
    pass


def read_raw(spark: SparkSession, path: str, table: str, multiline: bool = False, keep_broken: bool = False) -> DataFrame:
    """CSV exactly as received: header row, UTF-8 (a byte-order mark is ignored), all text.

    The header has to name the table's columns in their order. A record with more or fewer values is an error, or,
    with ``keep_broken``, a row whose last column ``broken_line`` holds its text. With ``multiline`` a quoted value may
    hold line breaks; a file is then one task, so large deliveries should come as many files. Without it such a record
    reads as broken lines.

    Blanks inside values are kept; an empty unquoted field is NULL and a quoted one stays empty text.
    The NUL character stands for "no value" because Spark would otherwise read both as NULL.
    A quote inside a quoted value is doubled; a backslash is a character like any other.
    """
    schema = schemas.raw_schema(table)
    if keep_broken:
        schema = StructType([*schema, StructField(BROKEN_LINE, StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("nullValue", "\u0000")
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE" if keep_broken else "FAILFAST")
        .option("columnNameOfCorruptRecord", BROKEN_LINE)
        .csv(path)
    )


#: Folder level below a clean table: sound rows, and those that a rule rejected in the same write.
VERDICT = "verdict"


def typed(table: str, df: DataFrame, marks: Sequence[str] = ()) -> DataFrame:
    """The columns of a clean table in their declared types, and marks that rules still need."""
    fields = [part.strip().split(" ") for part in schemas.CLEAN_DDL[table].split(",")]
    return df.select(*[F.col(name).cast(kind) for name, kind in fields], *marks)


class Layers:
    """Namespaces ``raw``, ``clean`` and ``analytics`` below one base folder, one Parquet table each."""

    NAMES = ("raw", "clean", "analytics")
    TYPED = ("clean", "clean_staged", "clean_damaged")
    GATED = ("raw", "clean", "clean_damaged")

    def __init__(self, spark: SparkSession, base_path: str):
        self.spark = spark
        self.base_path = base_path.rstrip("/")

    def root(self, layer: str, table: str) -> str:
        """Folder of a table, with all its verdicts."""
        if layer.split("_")[0] not in self.NAMES:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.base_path}/{layer}/{table}"

    def path(self, layer: str, table: str) -> str:
        """Folder of a table's files; sound and rejected rows of a clean table lie side by side."""
        if layer in self.GATED:
            return f"{self.root(layer, table)}/{VERDICT}=sound"
        if layer.removesuffix("_rejected") in self.GATED:
            return f"{self.root(layer.removesuffix('_rejected'), table)}/{VERDICT}=rejected"
        return self.root(layer, table)

    def write(self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Rebuild a table from scratch, so a rerun never duplicates rows; returns the stored table."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(layer, table))
        return self.read(layer, table)

    def write_clean(self, table: str, df: DataFrame, layer: str = "clean") -> DataFrame:
        """Cast to the declared clean types, then rebuild the table."""
        return self.write(layer, table, typed(table, df))

    def exists(self, layer: str, table: str) -> bool:
        try:
            self.spark.read.parquet(self.path(layer, table))
        except AnalysisException:
            return False
        return True

    def drop(self, layer: str, table: str) -> None:
        """Remove a table's files, if there are any."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(layer, table))
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def orphan_store(self, table: str, layer: str = "clean"):
        """Keeps the keys of a table that have no parent, one small table per relationship."""
        return lambda key, df: self.write(f"{layer}_orphans", f"{table}_{key}", df)

    def read(self, layer: str, table: str) -> DataFrame:
        reader = self.spark.read
        if layer == "raw":
            reader = reader.schema(schemas.raw_schema(table))
        elif layer in self.TYPED:
            reader = reader.schema(schemas.CLEAN_DDL[table])
        return reader.parquet(self.path(layer, table))


def load_raw(layers: Layers, csv_path: str, table: str, multiline: bool = False, on_broken: str = "raise") -> DataFrame:
    """Full refresh of a raw table from its CSV file, in one pass.

    Lines that are no record of the table stop the load, or go to ``raw_rejected`` with ``on_broken="quarantine"``.
    """
    if on_broken not in ("raise", "quarantine"):
        raise ValueError("on_broken must be raise or quarantine")
    seen = Observation(f"raw_{table}")
    broken = F.col(BROKEN_LINE).isNotNull()
    lines = read_raw(layers.spark, csv_path, table, multiline, keep_broken=True)
    counted = lines.observe(seen, F.count_if(broken).alias("broken"), F.count_if(~broken).alias("sound"))
    verdict = F.when(broken, "rejected").otherwise("sound")
    counted.withColumn(VERDICT, verdict).write.mode("overwrite").partitionBy(VERDICT).parquet(layers.root("raw", table))
    if seen.get["broken"] and on_broken == "raise":
        raise MalformedInput(f"{csv_path}: {seen.get['broken']} lines are no records of {table}")
    if not seen.get["sound"]:
        layers.write("raw", table, layers.spark.createDataFrame([], schemas.raw_schema(table)))
    return layers.read("raw", table)


def broken_lines(layers: Layers, table: str) -> DataFrame:
    """The lines that the last load of a table set aside."""
    if not layers.exists("raw_rejected", table):
        return layers.spark.createDataFrame([], f"{BROKEN_LINE} string")
    return layers.read("raw_rejected", table).select(BROKEN_LINE)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("total_rows")).select(F.lit(name).alias("table_name"), "total_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First n rows in a total order over all columns."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in df.columns]).limit(n)


def upsert(base: DataFrame, incoming: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """Incoming rows win on equal keys; all other base rows stay. Running it twice changes nothing.

    A key that occurs twice among the incoming rows is an error.
    """
    if check:
        assert_unique(incoming, keys)
    return base.join(incoming, list(keys), "left_anti").unionByName(incoming)


def layout_order(time_column: str | None, sort_by: Sequence[str]) -> list[Column]:
    month: list[Column] = [F.trunc(F.col(time_column).cast("date"), "month")] if time_column else []
    return month + [F.col(c) for c in sort_by]


def layout(df: DataFrame, time_column: str | None, sort_by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Cluster rows by month and access key so that Parquet min/max statistics skip files.

    Range partitioning over the whole composite key splits a hot month, department or patient over
    as many files as it needs.
    """
    order = layout_order(time_column, sort_by)
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order)


# Access paths worth clustering for: time column and sort keys per table.
LAYOUTS = {
    "departments": (None, ("facility_id",)),
    "referrals": ("referral_date", ("department_id", "referral_date", "patient_id")),
    "appointments": ("scheduled_datetime", ("department_id", "scheduled_datetime", "patient_id")),
    "ed_visits": ("arrival_time", ("facility_id", "arrival_time", "patient_id")),
}


def refresh_stats(spark: SparkSession, table: str) -> None:
    """Column statistics of a catalog table, for the optimizer's size and selectivity estimates."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
