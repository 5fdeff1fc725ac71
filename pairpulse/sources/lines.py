"""Raw event lines from plain and zipped files.

Both readers return the same frame: 61 strings (``schema.RAW``), then
``malformed_line`` (field count is not 61), ``source_path`` and ``read_error``.
A short line is padded with NULL, a long one cut, as in a permissive CSV scan.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pairpulse import schema
from pairpulse.functions.dates import Days, path_in_days
from pairpulse.sources.landing import paths_of

_CORRUPT = "_corrupt_record"
_PARSED = T.StructType(schema.RAW.fields + [T.StructField(_CORRUPT, T.StringType())])
_LINES_PER_BATCH = 8192
_BLOCK = 1 << 20
# Read errors with a text of their own; any other names what went wrong.
TOO_LARGE, NO_MEMBER = "larger than {} bytes", "no .CSV member"
# Spark's limit for the content of one binary file.
MAX_ARCHIVE_BYTES = 2**31 - 1 - 1024
_DIAGNOSTICS = [T.StructField(schema.MALFORMED, T.BooleanType()), T.StructField(schema.SOURCE_PATH, T.StringType()),
                T.StructField(schema.READ_ERROR, T.StringType())]
_LINES = "source_path string, line string, read_error string"


def csv_options(quote: str = "") -> dict[str, str]:
    """Event files are not quoted, so quoting is off: with the CSV default a field that
    starts with a quote would swallow the tabs after it. ``quote='"'`` restores that."""
    return {"sep": "\t", "header": "false", "quote": quote, "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": _CORRUPT,
            # A pruned scan would only notice what is wrong with the columns it keeps.
            "columnPruning": "false"}


def read_tsv(spark: SparkSession, landing: str, days: Days | None = None,
             quote: str = "") -> DataFrame:
    """Scan of all plain files below ``landing`` (see ``landing.py``). Predicates on the
    path are applied to the listing: ``days`` prunes it, and archives are passed over."""
    paths = paths_of(spark, landing, days)
    if not paths:
        return spark.createDataFrame([], T.StructType([*schema.RAW.fields, *_DIAGNOSTICS]))
    lines = (spark.read.schema(_PARSED).options(**csv_options(quote))
             .option("recursiveFileLookup", "true").csv(paths))
    path = F.col("_metadata.file_path")
    lines = lines.filter(~path.endswith(".zip"))
    if days is not None:
        lines = lines.filter(path_in_days(path, days))
    return lines.select(
        *schema.RAW.names,
        F.col(_CORRUPT).isNotNull().alias(schema.MALFORMED),
        path.alias(schema.SOURCE_PATH),
        F.lit(None).cast("string").alias(schema.READ_ERROR))


def list_archives(spark: SparkSession, landing: str, days: Days | None = None,
                  max_bytes: int | None = None) -> DataFrame:
    """``path, content`` of every archive below ``landing``; no content if it is larger
    than ``max_bytes`` (``MAX_ARCHIVE_BYTES``)."""
    paths = paths_of(spark, landing, days)
    if not paths:
        return spark.createDataFrame([], "path string, content binary")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.zip").load(paths))
    if days is not None:
        files = files.filter(path_in_days(F.col("_metadata.file_path"), days))
    # A pushed filter on the length keeps the content of larger files from being read.
    fits = F.col("length") <= (max_bytes or MAX_ARCHIVE_BYTES)
    return files.filter(fits).select("path", "content").unionByName(
        files.filter(~fits).select("path", F.lit(None).cast("binary").alias("content")))


def _frame(path: str, lines: list[str | None], error: str | None = None) -> pd.DataFrame:
    return pd.DataFrame({"source_path": path, "line": lines, "read_error": error})


def _lines_of(path: str, content: bytes | None, max_bytes: int) -> Iterator[pd.DataFrame]:
    """First .CSV member in bounded batches; one error row if it cannot be read.

    The member is inflated twice: once to the end, which verifies its checksum, and only
    then to give its lines. A damaged archive therefore gives no line at all.
    """
    if content is None:
        yield _frame(path, [None], TOO_LARGE.format(max_bytes))
        return
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            members = [n for n in archive.namelist() if n.endswith(".CSV")]
            if not members:
                yield _frame(path, [None], NO_MEMBER)
                return
            with archive.open(members[0]) as raw:
                while raw.read(_BLOCK):
                    pass
            with archive.open(members[0]) as raw:
                batch: list[str | None] = []
                for line in io.TextIOWrapper(raw, "utf-8", errors="replace"):
                    batch.append(line.rstrip("\n"))
                    if len(batch) == _LINES_PER_BATCH:
                        yield _frame(path, batch)
                        batch = []
                if batch:
                    yield _frame(path, batch)
    except Exception as e:  # an unreadable archive must not stop the others
        yield _frame(path, [None], f"{type(e).__name__}: {e}")


def _unzip(max_bytes: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield from _lines_of(path, content, max_bytes)

    return run


def unpack_archives(archives: DataFrame, quote: str = "", max_bytes: int | None = None) -> DataFrame:
    """``path, content`` -> raw lines. Python only inflates; the fields are parsed by
    the same JVM parser as in :func:`read_tsv`. Blank lines are skipped, as there."""
    lines = archives.select("path", "content").mapInPandas(_unzip(max_bytes or MAX_ARCHIVE_BYTES), _LINES)
    text = F.col("line")
    parsed = lines.filter(text.isNull() | (F.trim(text) != "")).select(
        F.from_csv(text, ", ".join(f"`{n}` string" for n in _PARSED.names), csv_options(quote))
        .alias("fields"), "source_path", "read_error")
    return parsed.select(
        *[F.col(f"fields.{n}").alias(n) for n in schema.RAW.names],
        (F.col(f"fields.{_CORRUPT}").isNotNull()).alias(schema.MALFORMED),
        F.col("source_path").alias(schema.SOURCE_PATH),
        F.col("read_error").alias(schema.READ_ERROR))


def read_archives(spark: SparkSession, landing: str, days: Days | None = None,
                  quote: str = "", max_bytes: int | None = None) -> DataFrame:
    return unpack_archives(list_archives(spark, landing, days, max_bytes), quote, max_bytes)
