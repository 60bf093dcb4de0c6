"""CSV in: explicit schema, corrupt rows kept, lineage columns, file listing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake import config as cfg
from cohortlake.functions.columns import row_hash
from cohortlake.sources import schema as sch

# How the published files are written.
READ_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": sch.CORRUPT_RECORD,
    "nullValue": "",
    "quote": '"',
    "escape": '"',
    "multiLine": "false",
    "encoding": "UTF-8",
}


def read_options(spec: cfg.TableSpec | None = None, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    own = dict(spec.read_options) if spec else {}
    return {**READ_OPTIONS, **own, **(extra or {})}


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Typed scan. A row that does not parse is kept with its text in ``_corrupt_record``."""
    return (
        spark.read.format("csv")
        .schema(sch.with_corrupt_record(schema))
        .options(**(options or READ_OPTIONS))
        .load(path)
    )


def scan_text(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """All columns as strings, named by the header: the input of schema inference."""
    chosen = {**READ_OPTIONS, **(options or {})}
    chosen.pop("columnNameOfCorruptRecord")
    df = spark.read.format("csv").options(**chosen, inferSchema="false").load(path)
    # The reader calls a blank header _c<position>; the name policy calls it col_<position>.
    return df.toDF(*[sch.safe_name("", i) if c == f"_c{i}" else c for i, c in enumerate(df.columns)])


def header(spark: SparkSession, path: str) -> list[str]:
    return scan_text(spark, path).columns


def scan_columns(
    spark: SparkSession, path: str, columns: Sequence[str], required: str | None = None, partitions: int | None = None
) -> DataFrame:
    """Named columns only; rows without ``required`` are trailer junk and dropped.

    A gzip file is a single split: ``partitions`` spreads its rows right after the scan.
    """
    df = scan_text(spark, path).select(*columns)
    if required:
        df = df.filter(F.col(required).isNotNull())
    return df.repartition(partitions) if partitions else df


def add_lineage(df: DataFrame, data_columns: Iterable[str] | None = None) -> DataFrame:
    """Load time, file name and a row hash over the data columns."""
    names = list(data_columns) if data_columns else [c for c in df.columns if c not in sch.METADATA_COLUMNS]
    return df.withColumns(
        {
            sch.INGESTED_AT: F.current_timestamp(),
            sch.SOURCE_FILE: F.col("_metadata.file_name"),
            sch.ROW_HASH: row_hash(names),
        }
    )


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Name and size of the files below a folder, from file metadata; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("n_bytes"))
    )


def file_inventory(files: DataFrame, specs: Sequence[cfg.TableSpec] = cfg.TABLE_SPECS) -> DataFrame:
    """Registered files with their size, missing ones, and files nobody registered."""
    spark = files.sparkSession
    known = spark.createDataFrame(
        [(s.filename, s.name, s.required) for s in specs], "name string, table string, required boolean"
    )
    joined = known.join(files, "name", "full_outer")
    state = (
        F.when(F.col("table").isNull(), "unexpected")
        .when(F.col("n_bytes").isNotNull(), "present")
        .when(F.col("required"), "missing")
        .otherwise("absent, optional")
    )
    return joined.select("name", "table", "n_bytes", state.alias("state"))
