"""One file (or folder) per period with varying columns.

Files of a source may have different headers, also the same columns in
another order: the first line of every file is read (and no more of it), then
the files of each distinct header are read together with ``header=true``.  The period
comes from the file path via ``_metadata.file_path`` and a regular
expression, so a read covers any number of periods.  Sources are combined
with ``unionByName(allowMissingColumns=True)`` after casting every column
to its declared type (an inferred int id never meets a declared string id
in the union).  A missing source is reported and skipped.
"""

from __future__ import annotations

import re
import warnings
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import q
from strata.sources.csv import charset, empty_frame


def period_from_path(path, pattern: str = r"(\d{4})"):
    """The period in a file path: the LAST match of ``pattern`` (group 1),
    as int, null when there is none.  Periods sit in the deepest path parts
    (file or folder names); an earlier match may be part of a parent
    folder's name, e.g. a random id."""
    p = F.col(path) if isinstance(path, str) else path
    return F.try_element_at(F.regexp_extract_all(p, F.lit(pattern), 1), F.lit(-1)).try_cast("int")


def discover_periods(spark: SparkSession, folder: str, pattern: str = r"(\d{4})",
                     glob: str = "*.csv") -> DataFrame:
    """S7 + O2: (path, period) of the files in a folder, sorted by period.

    The listing is a Spark ``binaryFile`` scan that reads only file paths
    (the content column is pruned), so it is distributed like any scan.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(folder).select("path"))
    return (files.withColumn("period", period_from_path("path", pattern))
            .where(F.col("period").isNotNull()).orderBy("period", "path"))


HEADER_THREADS = 16
GLOB = re.compile(r"([\\\[\]{}*?])")


def literal_path(path: str) -> str:
    """A listed path as Spark's readers take it: glob characters escaped."""
    return GLOB.sub(r"\\\1", path)


def files_by_header(spark: SparkSession, source, encoding: str = "UTF-8") -> list[list[str]]:
    """The source's files (as paths to read), grouped by their first line.

    The files are listed (no content is read), then a limited scan of each
    takes its first line: one task a file that ends with that line, however
    large the file is, HEADER_THREADS of them at a time.  One row per file
    reaches the driver, as in any file listing; files without a line are left
    out."""
    files = [literal_path(r.path) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
             .select("path").orderBy("path").collect()]

    def first_line(file: str) -> str | None:
        row = (spark.read.option("header", False).option("sep", "\u0001").option("quote", "").option("encoding", charset(encoding))
               .schema("line string").csv(file).first())
        return row.line if row else None

    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for file, header in zip(files, pool.map(first_line, files)):
            if header is not None:
                groups.setdefault(header, []).append(file)
    return list(groups.values())


def read_period_sources(spark: SparkSession, sources, types: dict[str, str],
                        period_pattern: str = r"(\d{4})", period_col: str = "period",
                        default_type: str | None = None, sep: str = ",",
                        encoding: str = "UTF-8", ddl_if_empty: str | None = None) -> DataFrame:
    """S6 + U1 + P7: read every source, tag rows with their period, cast,
    and union by name.

    ``types`` maps known column names to SQL types; other columns get
    ``default_type`` (e.g. the vote count type for party columns) or stay
    strings.  Casts are ``try_cast``: malformed cells become null.
    """
    frames = []
    for src in sources:
        try:
            groups = files_by_header(spark, src, encoding)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                warnings.warn(f"missing source {src}: skipped", stacklevel=2)
                continue
            raise
        for files in groups:
            raw = (spark.read.option("header", True).option("sep", sep).option("recursiveFileLookup", "true")
                   .option("encoding", charset(encoding)).csv(files))
            casted = []
            for c in raw.columns:
                t = types.get(c, default_type)
                casted.append((F.col(q(c)).try_cast(t) if t else F.col(q(c))).alias(c))
            period = period_from_path(F.col("_metadata.file_path"), period_pattern)
            frames.append(raw.select(period.alias(period_col), *casted))
    if not frames:
        if ddl_if_empty:
            return empty_frame(spark, ddl_if_empty)
        raise FileNotFoundError("no period source found")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
