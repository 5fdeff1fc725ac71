"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from pairpulse.llm.common import numbered, saved, unused, with_row_key

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source, and each of its documents, is taken at most so many times.
MOST_COPIES = 3
#: Units that one step of the reduction tree folds into one residual.
FAN_IN = 256
SEED = 9
_WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str = "text"):
    """Number of words of a text; none if it is null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS,
                   most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, n_units, target`` of units given by ``source, size``.

    The targets share the size of all units by weight. Where a share is above ``most``
    times its source, it stops there and the excess is shared again by weight. With
    sources in order of cap / weight, those that stop come first, so one pass of running
    sums over the sources finds the common level of the others.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                         F.count("*").alias("n_units"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    cap = F.lit(float(most)) * F.col("source_size")
    weighted = (totals.withColumn("_w", F.element_at(cycle, (place % len(weights) + 1).cast("int")))
                .withColumn("_cap", cap))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    stopped = (weighted.withColumn("_level", level)
               .withColumn("_stops", F.col("_level") * F.col("_w") > F.col("_cap")))
    common = F.max(F.when(~F.col("_stops"), F.col("_level"))).over(everything)
    return stopped.select(
        "source", "source_size", "n_units",
        F.when(F.col("_stops"), F.col("_cap"))
        .otherwise(F.least("_cap", common * F.col("_w"))).alias("target"))


def _fold(units: str, seed: int) -> str:
    """SQL that rounds an array of units one against the next, by mass in words.

    A unit is ``h, key, size, mass`` with 0 < mass < size, the expected words taken. The
    residual ``cur`` and the next unit exchange mass: either may rise until it is whole
    or the other empty, with chances that keep both expectations. Each step makes one of
    them integral and keeps their sum, so a block ends with at most one residual.
    """
    def unit(of: str, mass: str) -> str:
        return (f"named_struct('h', {of}.h, 'key', {of}.key, 'size', {of}.size, "
                f"'mass', cast({mass} as double))")

    def out(*decided: tuple[str, int]) -> str:
        new = ", ".join(f"named_struct('key', {of}.key, 'size', {of}.size, 'up', {up})"
                        for of, up in decided)
        return f"concat(acc.done, array({new}))"

    def state(cur: str, done: str) -> str:
        return f"named_struct('cur', {cur}, 'done', {done})"

    nothing = ("cast(null as struct<h: bigint, key: bigint, size: bigint, mass: double>)")
    a, m, b, y = "acc.cur.size", "acc.cur.mass", "x.size", "x.mass"
    rise, fall = f"least({a} - {m}, {y})", f"least({m}, {b} - {y})"
    coin = f"shiftrightunsigned(xxhash64(acc.cur.h, x.h, {seed}), 11) / 9007199254740992D"
    tiny = f"(1e-9 * ({a} + {b}))"
    merge = f"""
    case when acc.cur is null then {state(unit('x', y), 'acc.done')}
    when {coin} * ({rise} + {fall}) < {fall} then
      case when abs({a} - {m} - {y}) <= {tiny}
             then {state(nothing, out(('acc.cur', 1), ('x', 0)))}
           when {a} - {m} < {y}
             then {state(unit('x', f'{y} - ({a} - {m})'), out(('acc.cur', 1)))}
           else {state(unit('acc.cur', f'{m} + {y}'), out(('x', 0)))} end
    else
      case when abs({b} - {y} - {m}) <= {tiny}
             then {state(nothing, out(('acc.cur', 0), ('x', 1)))}
           when {m} < {b} - {y}
             then {state(unit('x', f'{y} + {m}'), out(('acc.cur', 0)))}
           else {state(unit('acc.cur', f'{m} - ({b} - {y})'), out(('x', 1)))} end
    end"""
    zero = state(nothing, "cast(array() as array<struct<key: bigint, size: bigint, up: int>>)")
    return f"aggregate({units}, {zero}, (acc, x) -> {merge})"


def _units(sizes: DataFrame, seed: int) -> DataFrame:
    """Units with the hash ``_h`` that places them; many equal ones get different hashes."""
    named = F.xxhash64("tag" if "tag" in sizes.columns else "key", "size", F.lit(seed))
    hashed = sizes.withColumn("_h", named).withColumn("_same", F.xxhash64("_h", "source"))
    own = F.when(F.col("_copy") > 0, F.xxhash64("_h", "_copy")).otherwise(F.col("_h"))
    return numbered(hashed, "_same", "_copy").withColumn("_h", own).drop("_same", "_copy")


def mixed_copies(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES,
                 seed: int = SEED) -> DataFrame:
    """How often each unit is taken so that its source meets its target.

    ``sizes``: ``key`` (long), ``source``, ``size`` and, if keys can differ between runs,
    ``tag`` (long), which then stands for the unit in all random choices. A unit of a source with target t and
    size s is taken t / s times on average: its whole part always, and the fraction is
    rounded by the pivotal method. Units of a source are put into blocks of about
    ``FAN_IN`` by a hash; each block leaves at most one unrounded residual, the residuals
    of ``FAN_IN`` blocks meet in the next level, and the last one of a source is rounded
    by its own chance. So the words taken differ from the target by less than the largest
    unit of the source, and no task holds more than a block. Many equal units are numbered,
    so they spread over the blocks like others.

    Returns ``key, source, size, source_size, target, copies``, one row per unit. Reruns
    agree. A null source is a source; units of no words are taken their whole part; null
    and repeated keys are units like any other. No units give no rows.
    """
    targets = saved(source_targets(sizes, weights, most))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate + 1e-12)
    shared = (_units(sizes, seed).join(targets.withColumnRenamed("source", "_s"),
                         F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
              .withColumn("_whole", whole)
              .withColumn("_rest", F.greatest(rate - whole, F.lit(0.0))))
    splits = (F.col("_rest") > 1e-9) & (F.col("size") > 0)
    place = F.shiftrightunsigned("_h", 11).cast("double") / F.lit(float(1 << 53))
    blocks = F.ceil(F.col("n_units") / FAN_IN)
    units = F.struct(F.col("_h").alias("h"), "key", "size",
                     (F.col("_rest") * F.col("size")).alias("mass"))
    level = (shared.filter(splits).withColumn("block", F.floor(place * blocks))
             .withColumn("unit", units).groupBy("source", "block")
             .agg(F.array_sort(F.collect_list("unit")).alias("units")))
    most_units = targets.agg(F.max("n_units")).first()[0] or 0
    n_blocks = -(-most_units // FAN_IN)
    decided = []
    depth = 0
    while True:
        depth += 1
        folded = saved(level.select("source", "block",
                                    F.expr(_fold("units", seed + depth)).alias("s"))
                       .select("source", "block", "s.cur", "s.done"))
        decided.append(folded.select("source", F.explode("done").alias("d"))
                       .select("source", "d.key", "d.size", "d.up"))
        left = folded.filter("cur is not null")
        if n_blocks <= 1:
            break
        n_blocks = -(-n_blocks // FAN_IN)
        level = (left.withColumn("block", F.floor(F.col("block") / FAN_IN))
                 .groupBy("source", "block").agg(F.array_sort(F.collect_list("cur")).alias("units")))
    chance = F.shiftrightunsigned(F.xxhash64("cur.h", F.lit(seed)), 11) / F.lit(float(1 << 53))
    decided.append(left.select("source", "cur.key", "cur.size",
                               (chance * F.col("cur.size") < F.col("cur.mass")).cast("int").alias("up")))
    rounded = decided[0]
    for more in decided[1:]:
        rounded = rounded.unionByName(more)
    whole_only = shared.filter(~splits).select("source", "key", "size", F.lit(0).alias("up"))
    return (rounded.unionByName(whole_only)
            .join(targets.withColumnRenamed("source", "_s"),
                  F.col("source").eqNullSafe(F.col("_s")))
            .select("key", "source", "size", "source_size", "target",
                    (whole + F.col("up")).cast("int").alias("copies")))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES,
          seed: int = SEED) -> DataFrame:
    """``docs`` as the mixture takes them: a row goes, stays or is repeated, unchanged.

    Choices depend on ids and texts, not on where rows are stored, so reruns agree.
    """
    row, times = unused(docs, "_row"), unused(docs, "_times")
    keyed = with_row_key(docs, row)
    copies = mixed_copies(keyed.select(F.col(row).alias("key"), "source", words_of().alias("size"),
                                       F.xxhash64("doc_id", "text").alias("tag")),
                          weights, most, seed)
    taken = copies.filter("copies > 0").select(F.col("key").alias(row), F.col("copies").alias(times))
    return (keyed.join(taken, row).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
            .select(*docs.columns))
