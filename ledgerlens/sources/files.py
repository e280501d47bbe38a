"""Raw CSV ingest with declared schemas, and star-table sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from .publication import read_published, versions
from .schemas import STAR_TABLES


# Every reader of an export: RFC 4180 quoting (a quote inside a field is doubled), empty is null.
CSV_OPTIONS = {"header": "true", "mode": "PERMISSIVE", "nullValue": "", "emptyValue": "", "encoding": "UTF-8",
               "multiLine": "false", "quote": '"', "escape": '"'}
CORRUPT = "_corrupt_record"


def header_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """The declared fields in the order of the file's header, unknown columns as text.

    Reads one line.  A declared column that the header lacks is an error:
    taking columns by place would put values into the wrong ones.
    """
    line = spark.read.options(**{**CSV_OPTIONS, "header": "false"}).csv(path).limit(1).collect()
    if not line:
        return schema
    names = [(c or "").strip() for c in line[0]]
    declared = {f.name: f for f in schema.fields}
    missing = [n for n in declared if n not in names]
    if missing:
        raise ValueError(f"{path}: the header lacks {missing}")
    return StructType([declared.get(n, StructField(n, StringType(), True)) for n in names])


def read_csv_typed(spark: SparkSession, path: str, schema: StructType, corrupt_column: str | None = None,
                   **options) -> DataFrame:
    """Header CSV -> typed DataFrame with a declared schema (no inference scan).

    Columns are found by the header's names.  Empty fields become null.
    ``PERMISSIVE`` keeps malformed rows with nulls in the unreadable fields
    instead of failing the job; with ``corrupt_column`` the raw text of such
    rows is kept in that column so they can be counted and inspected.  Files
    stay splittable (no multiLine).
    """
    opts = {**CSV_OPTIONS, "enforceSchema": "true", **options}
    wanted = [f.name for f in schema.fields]
    read = header_schema(spark, path, schema) if opts["header"] == "true" else schema
    if corrupt_column:
        opts["columnNameOfCorruptRecord"] = corrupt_column
        read = StructType(read.fields + [StructField(corrupt_column, StringType(), True)])
        wanted.append(corrupt_column)
    return spark.read.schema(read).options(**opts).csv(path).select(*wanted)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    df.write.mode(mode).options(**{"header": "true", "quote": '"', "escape": '"', **options}).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                sort_within: list[str] | None = None) -> None:
    """Write one table as Parquet (full overwrite by default).

    ``sort_within`` sorts inside each output file for locality (min/max
    statistics then prune row groups) without a global sort.
    """
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_star(tables: Mapping[str, DataFrame], root: str, mode: str = "overwrite",
               partition_by: Mapping[str, list[str]] | None = None) -> dict[str, str]:
    """Write every star table under ``root/<name>``; returns name -> path.

    ``partition_by`` maps a table name to its directory partition columns
    (e.g. facts by ``building_id``), so a report sliced to one building
    reads only that building's files (partition pruning).
    """
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        write_table(df, path, mode, partition_by=(partition_by or {}).get(name))
        paths[name] = path
    return paths


def read_star(spark: SparkSession, root: str, names=None, register_views: bool = True) -> dict[str, DataFrame]:
    """Read star tables back (optionally registering temp views for SQL): the newest version that is
    published below ``root``, or plain folders of ``write_star`` where none is."""
    if versions(spark, root):
        return read_published(spark, root, names=list(names or STAR_TABLES), register_views=register_views)
    out = {}
    for name in names or STAR_TABLES:
        schema = STAR_TABLES[name]  # declared types also for directory partition columns
        df = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}").select(*schema.fieldNames())
        if register_views:
            df.createOrReplaceTempView(name)
        out[name] = df
    return out


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "overwrite",
               num_partitions: int | None = None, batch_size: int = 10_000) -> None:
    """Write a table to a warehouse over JDBC.

    ``num_partitions`` caps concurrent connections (Spark coalesces to it);
    ``batchsize`` sets rows per insert batch.
    """
    w = df.write.mode(mode).option("batchsize", str(batch_size))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    w.jdbc(url=url, table=table, mode=mode, properties=dict(properties))
