"""CSV sources and sinks.

Declared schemas by default: ``inferSchema`` costs a full extra pass over
the files and lets types drift from file to file.  Parquet partitioned by
period is the default sink between stages; a single CSV part file is an
export option only (it funnels the last stage through one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Charset aliases Spark 4 rejects, mapped to names it accepts.
ENCODING_ALIASES = {"latin1": "ISO-8859-1", "latin-1": "ISO-8859-1", "utf8": "UTF-8",
                    "cp1252": "windows-1252"}


def charset(name: str) -> str:
    return ENCODING_ALIASES.get(name.lower(), name)


def read_csv(spark: SparkSession, path, schema: StructType | str | None = None, *,
             sep: str = ",", encoding: str = "UTF-8", header: bool = True,
             infer: bool = False, enforce: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """Header CSV with a declared schema (or inference on request)."""
    r = (spark.read.option("header", header).option("sep", sep)
         .option("encoding", charset(encoding)).option("mode", mode))
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", enforce)
    else:
        r = r.option("inferSchema", infer)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, *, sep: str = ",", encoding: str = "UTF-8",
              header: bool = True, single_file: bool = False, mode: str = "overwrite",
              partition_by=None) -> None:
    """CSV sink.  ``single_file`` coalesces to one task (export only)."""
    out = df.coalesce(1) if single_file else df
    w = (out.write.mode(mode).option("header", header).option("sep", sep)
         .option("encoding", charset(encoding)))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_panel(df: DataFrame, path: str, period_col: str, mode: str = "overwrite",
                max_records_per_file: int = 5_000_000) -> None:
    """Default sink: Parquet partitioned by period, so a later filter on the
    period prunes whole directories.  Files are capped at
    ``max_records_per_file`` rows, so a hot period becomes several files
    instead of one huge one (no extra shuffle is added for the write)."""
    (df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(period_col).parquet(path))


def replace_periods(df: DataFrame, path: str, period_col: str, rows_per_file: int = 5_000_000) -> None:
    """Repeatable panel sink: the periods that ``df`` holds replace those of
    the same name under ``path``, all others stay (dynamic partition
    overwrite), so a rerun of some periods can't append twice or lose the
    rest.  A period is dealt to as many tasks as it needs files of
    ``rows_per_file`` rows (at most twice that in a file), each row to the file
    its hash names.  The rows of
    every period are then listed in ``<path>/_periods`` (a folder that readers
    of the panel skip); ``panel_periods`` reads it.  A null period is a
    period; an empty frame changes nothing; ``df`` must not read ``path`` itself."""
    period = F.col("`" + period_col.replace("`", "``") + "`")
    files = df.groupBy(period.alias("_p")).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    row = F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c, t in df.dtypes if "map<" not in t])
    dealt = df.join(files, period.eqNullSafe(F.col("_p"))).withColumn("_file", F.pmod(row, F.col("_files")))
    if dealt.isEmpty():
        return
    (dealt.repartition(period, "_file").drop("_p", "_files", "_file").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 2 * rows_per_file)
     .partitionBy(period_col).parquet(path))
    rows = df.sparkSession.read.parquet(path).groupBy(period).agg(F.count(F.lit(1)).alias("rows"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/_periods")


def panel_periods(spark: SparkSession, path: str) -> DataFrame:
    """(period, rows) of a panel written by ``replace_periods``."""
    return spark.read.parquet(f"{path}/_periods")


def empty_frame(spark: SparkSession, ddl: str) -> DataFrame:
    """An empty frame with a DDL schema (the "no inputs found" case)."""
    return spark.createDataFrame([], schema=ddl)
