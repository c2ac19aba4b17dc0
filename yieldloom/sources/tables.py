"""Tables: schemas, namespaces, scans, replacement writes, the ingestion log and the entity join."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldloom.spec import DEFAULT_SPEC, EntitySpec

LAYERS = ("raw", "staging", "mart")


def ensure_layers(spark: SparkSession, layers: tuple[str, ...] = LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")


def feature_names(n: int, spec: EntitySpec = DEFAULT_SPEC) -> list[str]:
    return [f"{spec.prefix}{i:03d}" for i in range(1, n + 1)]


def measurement_schema(n_features: int, spec: EntitySpec = DEFAULT_SPEC) -> T.StructType:
    """Entity id and `n_features` nullable doubles."""
    schema = T.StructType([T.StructField(spec.id, T.LongType(), False)])
    for name in feature_names(n_features, spec):
        schema.add(name, T.DoubleType())
    return schema


def label_schema(spec: EntitySpec = DEFAULT_SPEC) -> T.StructType:
    return T.StructType(
        [
            T.StructField(spec.id, T.LongType(), False),
            T.StructField(spec.label, T.IntegerType()),
            T.StructField(spec.ts, T.TimestampType()),
            T.StructField(spec.outcome, T.StringType()),
        ]
    )


def scan(spark: SparkSession, name: str | None = None, path: str | None = None, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """A catalog table, a parquet folder, or a table of a user's database.

    Every operator prunes columns and filters on top of this, and the scan takes both over.
    """
    if path:
        return spark.read.parquet(path)
    if jdbc:
        return spark.read.format("jdbc").options(**jdbc).load()
    if not name:
        raise ValueError("give a table name, a path or database options")
    return spark.table(name)


def replace_table(df: DataFrame, name: str) -> int:
    """Write `df` as table `name`, replacing it, and return its rows.

    The rows are written aside and the tables switched by name, so a write that fails leaves the old table,
    and `df` may read the table it replaces. A switch that was cut off is completed by the next call. The count
    reads the file footers of the new table. (An observation would count during the write, but leaves state
    in the session that keeps fitted logistic models from being shipped to tasks.)
    """
    spark = df.sparkSession
    incoming, outgoing = f"{name}_incoming", f"{name}_outgoing"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(outgoing):
        spark.sql(f"ALTER TABLE {outgoing} RENAME TO {name}")
    df.write.mode("overwrite").saveAsTable(incoming)
    spark.sql(f"DROP TABLE IF EXISTS {outgoing}")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {outgoing}")
    spark.sql(f"ALTER TABLE {incoming} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {outgoing}")
    return spark.table(name).count()


LOG_SCHEMA = "table_name string, source_file string, rows_loaded long, load_id string"


def log_load(spark: SparkSession, table: str, source: str, rows: int, log_table: str = "raw.ingestion_log", load_id: str | None = None) -> None:
    """Append one row to the ingestion log, stamped now."""
    entry = spark.createDataFrame([(table, source, rows, load_id)], LOG_SCHEMA).coalesce(1)
    entry.withColumn("loaded_at", F.current_timestamp()).write.mode("append").saveAsTable(log_table)


def logged_rows(spark: SparkSession, table: str, load_id: str, log_table: str = "raw.ingestion_log") -> int | None:
    """The rows that a load has put into `table`, if the log knows it."""
    if not spark.catalog.tableExists(log_table):
        return None
    row = spark.table(log_table).where((F.col("table_name") == table) & (F.col("load_id") == load_id)).agg(F.max("rows_loaded")).head()
    return row[0]


def load_table(df: DataFrame, name: str, table: str, source: str, log_table: str = "raw.ingestion_log", load_id: str | None = None) -> int:
    """Replace table `name` and log it as `table`; rows loaded. A load whose id is in the log already does nothing."""
    spark = df.sparkSession
    known = logged_rows(spark, table, load_id, log_table) if load_id is not None else None
    if known is not None:
        return known
    rows = replace_table(df, name)
    log_load(spark, table, source, rows, log_table, load_id)
    return rows


def discover_features(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> list[str]:
    """Columns of a measurement table except the id, in table order."""
    columns = [c for c in df.columns if c != spec.id]
    if not columns:
        raise RuntimeError("the measurement table has no feature columns")
    return columns


def join_entities(measurements: DataFrame, labels: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Measurements with their label columns, for entities present in both.

    Not sorted: every operator orders by time itself where it matters, and a global sort would only add a
    shuffle of the wide rows.
    """
    return measurements.join(labels.select(*spec.keys), spec.id)


def chronological(entities: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Entities in time order, equal times by id. A range shuffle; for output only."""
    return entities.orderBy(spec.ts, spec.id)


def canonical(measurements: DataFrame, labels: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """The entity join with the key columns first and the features in source order."""
    features = discover_features(measurements, spec)
    return join_entities(measurements, labels, spec).select(*spec.keys, *[F.col(f"`{c}`") for c in features])


def build_canonical(
    spark: SparkSession,
    measurements: str = "raw.measurements",
    labels: str = "raw.labels",
    target: str = "raw.canonical",
    spec: EntitySpec = DEFAULT_SPEC,
) -> int:
    """Write the canonical table, each file in time order, and return its row count."""
    table = canonical(spark.table(measurements), spark.table(labels), spec)
    return replace_table(table.sortWithinPartitions(spec.ts, spec.id), target)
