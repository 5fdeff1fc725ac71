"""Which paths of the landing area hold the files of given days.

A landing area is a folder or a glob. Where ``{day}`` stands in it, the files of a day
are below the paths that have the day as yyyyMMdd in its place: ``/in/{day}*`` for files
in one folder, ``/in/{day}/*`` for a folder a day. A load of few days then lists the paths
of these days only; without it, and for long ranges, all of it is listed and pruned by day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairpulse.functions.dates import Days, file_date, path_in_days

DAY = "{day}"
#: Days that are listed one by one. More are cheaper to list in one go.
MOST_GLOBS = 31


def paths_of(spark: SparkSession, landing: str, days: Days | None) -> list[str]:
    """Paths to list. Those of single days are only named if they exist."""
    each = [] if days is None or DAY not in landing else days.each()
    if not each or len(each) > MOST_GLOBS:
        return [landing.replace(DAY, "*")]
    return [p for p in (landing.replace(DAY, f"{d:%Y%m%d}") for d in each) if _exists(spark, p)]


def _exists(spark: SparkSession, glob: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def landed_files(spark: SparkSession, landing: str, days: Days | None = None) -> DataFrame:
    """``path, length`` of the files of the days (or all). Reads the listing, never the content."""
    paths = paths_of(spark, landing, days)
    if not paths:
        return spark.createDataFrame([], "path string, length long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    path = F.col("_metadata.file_path")
    if days is not None:
        files = files.filter(path_in_days(path, days))
    return files.select(path.alias("path"), "length")


def landing_strays(spark: SparkSession, landing: str) -> DataFrame:
    """``path, length`` of every landed file whose name gives no date, so that no load reads it."""
    return landed_files(spark, landing).filter(file_date(F.col("path")).isNull())
