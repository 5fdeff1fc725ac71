"""What several operators share: reading, lineage cuts, components, ranks, hot keys."""

from __future__ import annotations

import os
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

import pairpulse

# Python workers need not have the package on their path.
cloudpickle.register_pickle_by_value(pairpulse)

#: Rows that one task ranks or folds at a time.
CELL_ROWS = 4096
#: Equal rows from which on they are told apart by numbers.
HOT_ROWS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where unset, as in tests, one below the warehouse."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(context.getConf().get(
            "spark.checkpoint.dir", os.path.join(warehouse, "_checkpoints")))
    return context._jsc.sc().getCheckpointDir().get()


def saved(df: DataFrame) -> DataFrame:
    """``df``, computed once and kept in the shared folder, so a lost executor costs nothing.

    Files go when nothing refers to the frame any more, if the session says so
    (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """As ``saved``, but as a table of columns, which takes less room where many values are null or alike."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """Rows numbered by partition and place.

    Two reads of one stored table give a row the same number, which is what ties a
    decision about a row to the row, whatever its columns hold. Files are cut by a number
    that the session keeps from the first call on, not by the cores that are alive when a
    read is planned, so an executor that is lost or added between two reads moves no cut.
    """
    conf = docs.sparkSession.conf
    if conf.get("spark.sql.files.minPartitionNum", None) is None:
        conf.set("spark.sql.files.minPartitionNum", docs.sparkSession.sparkContext.defaultParallelism)
    return docs.withColumn(name, F.monotonically_increasing_id())


def unit_interval(*cols: Column) -> Column:
    """A pseudo-random number in [0, 1) that depends on the columns only."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53)))


def hot_keys(rows: DataFrame, key: str, least: int = HOT_ROWS) -> DataFrame:
    """``_hot``: the values of ``key`` that more than ``least`` rows have. Saved."""
    return saved(rows.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n"))
                 .filter(F.col("_n") > least).select("_hot"))


def numbered(rows: DataFrame, key: str, name: str, least: int = HOT_ROWS) -> DataFrame:
    """``rows`` with ``name``: 0, 1, 2, ... within the rows of a ``key`` that more than ``least`` have, else 0.

    ``key`` is a number without nulls, the same for rows that may stand for one another.
    The numbers of a key have no gaps, so they are the same set however rows are stored.
    A partition numbers its own rows after those of the partitions before it; no task
    holds more rows of a key than one partition of ``rows`` has. Rows are saved.
    """
    placed = saved(rows.withColumn("_part", F.spark_partition_id())
                   .withColumn("_place", F.monotonically_increasing_id()))
    hot = hot_keys(placed, key, least)
    plain = placed.drop("_part", "_place")
    if hot.isEmpty():
        return plain.withColumn(name, F.lit(0).cast("long"))
    is_hot = F.col(key) == F.col("_hot")
    own = placed.join(hot, is_hot)
    along = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = (own.groupBy(F.col("_hot").alias("_k"), F.col("_part").alias("_p")).agg(F.count("*").alias("_in"))
              .select("_k", "_p", (F.sum("_in").over(along) - F.col("_in")).alias("_before")))
    within = F.row_number().over(Window.partitionBy("_hot", "_part").orderBy("_place")) - 1
    told = (own.withColumn("_at", within)
            .join(before, (F.col("_hot") == F.col("_k")) & (F.col("_part") == F.col("_p")))
            .withColumn(name, (F.col("_before") + F.col("_at")).cast("long")).select(*plain.columns, name))
    return told.unionByName(plain.join(hot, is_hot, "left_anti").withColumn(name, F.lit(0).cast("long")))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of an undirected graph given by ``a, b``: the smallest node reachable.

    Alternating large-star and small-star steps: each links the neighbours of a node to
    the smallest of them, until only stars are left, in about log n rounds. Minima are
    combined on the map side, so a node with very many neighbours sends one row a task;
    the join that hands a minimum back is one that adaptive execution splits. Nodes
    without an edge to another node are not returned.
    """
    current = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct())
    seen = None
    while True:
        state = current.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                            F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).first()
        if state == seen:
            break
        seen = state
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        current = saved(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return (current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component"))
                         .distinct()))


def ranked(rows: DataFrame, group: str, place: Column, *order: str) -> DataFrame:
    """Add ``n`` (rows of the group) and ``rank`` (from 1, by ``place``, then ``order``).

    ``place`` is a number in [0, 1). A group is cut into cells of about ``CELL_ROWS``
    rows by place and ranked cell by cell, so no task holds a hot group. A null group is
    a group. The counts per group and per cell are small tables of sums.
    """
    placed = rows.withColumn("_place", place)
    sizes = placed.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("n"))
    cells = (placed.join(sizes, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
             .withColumn("_cell", F.floor(F.col("_place") * F.ceil(F.col("n") / CELL_ROWS))))
    along = (Window.partitionBy("_g").orderBy("_c")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = (cells.groupBy(F.col(group).alias("_g"), F.col("_cell").alias("_c"))
              .agg(F.count("*").alias("_in"))
              .select("_g", "_c", (F.sum("_in").over(along) - F.col("_in")).alias("_before")))
    within = Window.partitionBy(group, "_cell").orderBy("_place", *order)
    return (cells.withColumn("_at", F.row_number().over(within))
            .join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_cell") == F.col("_c")))
            .withColumn("rank", F.col("_before") + F.col("_at"))
            .drop("_g", "_c", "_cell", "_before", "_at", "_place"))
