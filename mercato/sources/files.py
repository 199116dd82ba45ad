"""File sources and sinks: CSV, Parquet, ORC, partitioned layouts.

Readers take explicit schemas where the layout is known (schema inference
costs a full extra pass over CSV); writers bound the number of output
files per partition value by repartitioning on the partition columns
first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw flat sales CSV as the reference reads it: the date stays text
# (M/d/yyyy in the small sample, ISO in the generated one) and is parsed
# by the cleaning rules; money columns are exact decimals.
SALES_CSV_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("discount", T.DecimalType(4, 2)),
        T.StructField("payment_method", T.StringType()),
        T.StructField("delivery_days", T.IntegerType()),
        T.StructField("customer_rating", T.DecimalType(3, 1)),
        T.StructField("revenue", T.DecimalType(12, 2)),
    ]
)


def read_sales_csv(
    spark: SparkSession, path: str, schema: T.StructType = SALES_CSV_SCHEMA, bad_fields: str | None = None
) -> DataFrame:
    """Header CSV with an explicit schema (S1); a malformed field becomes null.

    With ``bad_fields`` the text is read first and every field cast on its
    own; a column of that name lists the fields whose text is there but is
    not of their type. Without it nothing tells a malformed optional number
    from a missing one. The cleaning rules send such rows to the quarantine."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if bad_fields is None:
        return reader.schema(schema).csv(path)
    text = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])).csv(path)
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    wrong = [F.when(F.col(f"`{n}`").isNotNull() & c.isNull(), F.lit(n)) for n, c in typed.items()]
    return text.select(*[c.alias(n) for n, c in typed.items()], F.array_compact(F.array(*wrong)).alias(bad_fields))


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """``read.csv(header=True, inferSchema=True)`` on a file or a folder of
    parts (S2). Inference is an extra full pass; prefer a schema."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_table(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """Format-dispatched scan: parquet, orc, csv, json.

    A folder with ``name=value`` sub-folders is read with its partition
    column discovered from the path (S6)."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        options.setdefault("header", "true")
        if schema is None:
            options.setdefault("inferSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL (S7; the reference queries ``sales`` without
    registering it, X5)."""
    df.createOrReplaceTempView(name)
    return df


def rename_view(spark: SparkSession, old: str, new: str) -> DataFrame:
    """``RENAME TABLE old TO new`` for a session view (K9): the staging
    name points at the same plan; the old name is dropped."""
    df = spark.table(old)
    df.createOrReplaceTempView(new)
    spark.catalog.dropTempView(old)
    return spark.table(new)


def save_catalog_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Store a frame as the external table ``database.table`` of the session catalog at ``path``."""
    spark = df.sparkSession
    if "." in name:
        database = name.split(".")[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{path.rsplit('/', 1)[0]}/{database}.db'")
    df.write.mode("overwrite").format(fmt).option("path", path).saveAsTable(name)
    return spark.table(name)


def rename_catalog_table(spark: SparkSession, old: str, new: str) -> DataFrame:
    """``RENAME TABLE old TO new`` of a stored table (K9): only the catalog's
    entry changes, its files stay where they are; the old name is gone."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    return spark.table(new)


def _row_hash(df: DataFrame):
    """A per-row hash used as the last range-partitioning column: rows
    sharing one partition or cluster value are spread over several tasks."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def write_table(
    df: DataFrame,
    path: str,
    fmt: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    tasks: int | None = None,
    **options,
) -> None:
    """CSV (header) / Parquet / ORC write with overwrite or append (K1-K5, K7, K8).

    With ``partition_by`` the rows are range-partitioned on (partition
    columns, row hash) first: every task holds an equal slice in partition
    order and writes files for one or two partition values, so the file
    count stays near ``tasks`` + number of values, and one value holding a
    third of the rows is still written by many tasks (hash-repartitioning
    on the partition column alone would give it one task)."""
    if fmt == "csv":
        options.setdefault("header", "true")
    out = df
    if partition_by:
        n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartitionByRange(n, *[F.col(c) for c in partition_by], _row_hash(df))
    writer = out.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def convert(spark: SparkSession, src: str, src_fmt: str, dst: str, dst_fmt: str, schema: T.StructType | None = None) -> DataFrame:
    """Format conversion of a dataset, e.g. CSV -> Parquet."""
    write_table(read_table(spark, src, src_fmt, schema), dst, dst_fmt)
    return read_table(spark, dst, dst_fmt)


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str], fmt: str = "parquet", files: int | None = None) -> None:
    """Layout for range filters on ``cluster_by`` (Y3, the counterpart of a
    composite index): range-partition and sort within partitions, so each
    file and row group covers a narrow key range and Parquet min/max
    statistics let the reader skip the rest."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartitionByRange(n, *[F.col(c) for c in cluster_by], _row_hash(df))
        .sortWithinPartitions(*cluster_by)
        .write.mode("overwrite")
        .format(fmt)
        .save(path)
    )


def write_bucketed(
    df: DataFrame, name: str, key: Sequence[str], buckets: int, path: str, fmt: str = "parquet"
) -> DataFrame:
    """Bucketed, sorted table for repeated joins / aggregations on ``key``
    (Y3: ``bucketBy`` for the group-by key). The table is external, stored
    at ``path`` (a shared folder), registered in the session catalog; a
    later ``groupBy(key)`` or a join with a table bucketed the same way
    reads co-located buckets and plans no exchange. Rows are dealt out by
    the buckets' own hash first, so a bucket is one file, not one per task."""
    (
        df.repartition(buckets, *key)
        .write.mode("overwrite")
        .format(fmt)
        .option("path", path)
        .bucketBy(buckets, *key)
        .sortBy(*key)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def storage_size(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(dataset, files, bytes, mb) per dataset folder.

    The ``binaryFile`` source lists files with their length; the content
    column is not selected, so no file body is read."""
    parts = []
    for name, path in paths.items():
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(path)
            .select("path", "length")
            .filter(~F.regexp_extract("path", r"[^/]*$", 0).rlike(r"^[._]"))
        )
        parts.append(
            files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).select(
                F.lit(name).alias("dataset"), "files", "bytes"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("mb", F.round(F.col("bytes") / (1024 * 1024), 1))


def file_facts(spark: SparkSession, paths: dict[str, str], formats: dict[str, str]) -> DataFrame:
    """(dataset, files, non_empty_files, row_count, bytes) per dataset folder.

    Rows are counted per file through the scan's file metadata: for Parquet
    and ORC no column is read, the counts come from the files' footers. Files
    without rows appear in the listing only."""
    parts = []
    for name, path in paths.items():
        reader = spark.read.format(formats[name])
        rows = (reader.option("header", "true") if formats[name] == "csv" else reader).load(path)
        per_file = rows.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
        counts = per_file.agg(F.count(F.lit(1)).alias("non_empty_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
        parts.append(counts.select(F.lit(name).alias("dataset"), "non_empty_files", "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return storage_size(spark, paths).join(out, "dataset").select("dataset", "files", "non_empty_files", "row_count", "bytes")


def size_vs(sizes: DataFrame, baseline: str) -> DataFrame:
    """Add the reduction against one dataset in percent (K16). ``sizes``
    has one row per dataset, so the window over it is a handful of rows."""
    from pyspark.sql import Window

    base = F.max(F.when(F.col("dataset") == baseline, F.col("bytes"))).over(Window.partitionBy())
    return sizes.withColumn("reduction_pct", F.round((1 - F.col("bytes") / base) * 100, 1))
