"""Raw lines, archives and planted errors derived from the test tables."""

from __future__ import annotations

import io
import random
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairpulse import schema
from pairpulse.sinks.staging import free_shuffles
from pairpulse.sources.star_events import star_events

# Silver columns that exist before loading.
SILVER_COLUMNS = [c for c in schema.SILVER.names if c != "ingested_at"]
BRONZE_FOR_SILVER = ["Day"] + [c for c in SILVER_COLUMNS if c != "event_date"]
GOLD_COLUMNS = [c for c in schema.GOLD.names if c != "ingested_at"]
# Silver columns read by the index.
INDEX_COLUMNS = ["event_date", "Actor1CountryCode", "Actor2CountryCode", "Actor1Type1Code",
                 "Actor2Type1Code", "EventRootCode", "GoldsteinScale", "NumMentions",
                 "NumSources", "NumArticles", "AvgTone"]

_ARCHIVE = "path string, content binary"


_SLOT = "yyyyMMdd'000000.export.CSV'"


def event_lines(spark: SparkSession, sf_dir: str, planted: bool = False, by_slot: bool = False) -> DataFrame:
    """``slot, line``: every event as a raw line of the first slot of its file date; with
    ``by_slot``, spread and ordered for :func:`write_landing` before they are lines.

    With ``planted``, the id decides on an irregularity: 1 of 50 lines lacks its last two
    fields, 1 has one too many, 1 has a quote at the start of a field. Fields are joined as an
    array: a null check for each of 61 makes a method too long for the compiler of the JVM.
    """
    events = star_events(spark, sf_dir, slot=_SLOT if by_slot else None)
    slot = F.col("slot") if by_slot else F.date_format("input_file_date", _SLOT).alias("slot")
    case = F.col("GlobalEventID") % 50
    fields = {n: F.col(n).cast("string") for n in schema.RAW.names}
    if not planted:
        return events.select(slot, F.array_join(F.array(*fields.values()), "\t", "").alias("line"))
    fields["Actor1Name"] = F.when(case == 3, F.concat(F.lit('"'), F.coalesce("Actor1Name", F.lit("")))
                                  ).otherwise(fields["Actor1Name"])
    rows = events.select(slot, case.alias("case"), F.array(*fields.values()).alias("fields"))
    line = F.array_join("fields", "\t", "")
    return rows.select("slot", F.when(F.col("case") == 1, F.array_join(F.slice("fields", 1, 59), "\t", ""))
                       .when(F.col("case") == 2, F.concat(line, F.lit("\textra"))).otherwise(line).alias("line"))


def write_landing(lines: DataFrame, path: str, compression: str = "none") -> str:
    """Write lines that are spread by slot, one folder per slot; the readers take the date
    from the path. A slot is one file unless adaptive execution splits the partition it is in.
    What the lines were shuffled through is freed, so that no load has it on its disks."""
    (lines.write.partitionBy("slot").option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path))
    free_shuffles(lines.sparkSession)
    return path


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for slot, rows in batch.groupby("slot", sort=False):
            data = io.BytesIO()
            with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(slot, "\n".join(rows["line"]) + "\n")
            out.append((f"{slot}.zip", data.getvalue()))
        yield pd.DataFrame(out, columns=["path", "content"])


def pack_archives(lines: DataFrame) -> DataFrame:
    """Lines that are spread by slot -> ``path, content``. Each Arrow batch is packed on its
    own, so no task ever holds a whole slot; a task that is repeated packs the same batches."""
    ordered = lines.sortWithinPartitions("slot", "line")
    return ordered.mapInPandas(_pack, _ARCHIVE)


# An archive of these days of a month cannot be read; of 23 January it is too large.
FLIPPED, NO_ARCHIVE, NO_MEMBER = "13", "17", "19"
TOO_LARGE, LARGEST_ARCHIVE = "0123", 4 << 20


def _spoil(slot: str, data: bytes) -> bytes:
    """The archive of a slot, spoilt by the rules above."""
    if slot[6:8] == NO_ARCHIVE:
        return b"no archive"
    broken = bytearray(data)
    if slot[6:8] == FLIPPED:
        broken[len(broken) // 2] ^= 0xFF
    if slot[6:8] == NO_MEMBER or slot[4:8] == TOO_LARGE:
        out = io.BytesIO(b"" if slot[6:8] == NO_MEMBER else data)
        with zipfile.ZipFile(out, "a") as archive:
            noise = b"" if slot[6:8] == NO_MEMBER else random.Random(0).randbytes(LARGEST_ARCHIVE)
            archive.writestr("readme.txt", noise)
        return out.getvalue()
    return bytes(broken)


def write_archives(archives: DataFrame, folder: str) -> str:
    """Write ``path, content`` as spoilt archive files below ``folder``, one folder per task:
    a task that is repeated writes the same files again."""
    uri = folder if "://" in folder else "file://" + folder.removeprefix("file:")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = pafs.FileSystem.from_uri(uri)
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                files.create_dir(f"{root}/{part}-{n}", recursive=True)
                with files.open_output_stream(f"{root}/{part}-{n}/{path}") as out:
                    out.write(_spoil(path, content))
                n += 1
        yield pd.DataFrame({"files": [n]})

    archives.mapInPandas(write, "files long").agg(F.sum("files")).collect()
    return folder


def _damage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        content = []
        for path, data in zip(batch["path"], batch["content"]):
            broken = bytearray(data)
            if path[6:8] == "13":
                # The compressed bytes stand between the names, at the front and the end.
                broken[len(broken) // 2] ^= 0xFF
            content.append(bytes(broken))
        yield batch.assign(content=content)


def damage_archives(archives: DataFrame) -> DataFrame:
    """Flip a byte in the middle of every archive of the 13th of a month."""
    return archives.mapInPandas(_damage, _ARCHIVE)


def planted_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw strings in which some numbers are not numbers."""
    case = F.col("GlobalEventID") % 40
    planted = {
        "GlobalEventID": F.when(case == 1, "n/a"),
        "Day": F.when(case == 2, "x").when(case == 3, ""),
        "NumMentions": F.when(case == 4, "99999999999").when(case == 5, " 12 "),
        "GoldsteinScale": F.when(case == 6, "one").when(case == 7, "-.5"),
        "AvgTone": F.when(case == 8, "1,5"),
        "Actor1Geo_Lat": F.when(case == 9, "12.5N"),
    }
    events = star_events(spark, sf_dir)
    raw = events.select(*[
        F.coalesce(planted[n], F.col(n).cast("string")).alias(n) if n in planted
        else F.col(n).cast("string").alias(n) for n in schema.RAW.names],
        F.date_format("input_file_date", "yyyyMMdd000000'.export.CSV'").alias(schema.SOURCE_PATH),
        F.lit(False).alias(schema.MALFORMED), F.lit(None).cast("string").alias(schema.READ_ERROR))
    return raw


def planted_faults(raw: DataFrame) -> DataFrame:
    """Raw rows of which some are malformed lines and some stand for unreadable archives."""
    case = F.col("SOURCEURL").substr(5, 20).cast("long") % 40
    return raw.withColumns({schema.MALFORMED: case.isin(11, 12),
                            schema.READ_ERROR: F.when(case == 13, "BadZipFile")})


def stray_names(lines: DataFrame) -> DataFrame:
    """Slots of the 5th of a month are named as something else, those of the 6th by no date."""
    day = F.substring("slot", 7, 2)
    named = (F.when(day == "05", F.concat(F.lit("events-"), F.substring("slot", 1, 8)))
             .when(day == "06", F.overlay("slot", F.lit("32"), 7, 2)).otherwise(F.col("slot")))
    return lines.withColumn("slot", named)


def planted_gold(gold: DataFrame) -> DataFrame:
    """An index in which some rows break each rule."""
    n = F.col("total_events")
    return gold.withColumns({
        "geo_unrest_score": F.when(n % 7 == 1, -1).otherwise(F.col("geo_unrest_score")),
        "pol_involve_score": F.when(n % 7 == 2, F.col("pol_involve_score") + 1)
        .when(n % 7 == 3, None).otherwise(F.col("pol_involve_score")),
        "suri_score": F.when(n % 7 == 4, F.col("suri_score") + 0.5)
        .when(n % 7 == 5, F.lit(-2.0)).otherwise(F.col("suri_score")),
        "total_events": F.when(n % 7 == 6, 0).otherwise(n),
    })
