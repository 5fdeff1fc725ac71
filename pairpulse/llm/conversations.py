"""Repair of conversation structure by the cheapest edits, in blocks between checkpoints.

The rows of a conversation are a path through four states (nothing said yet, last said by
the system, by the user, by the assistant), and the edits of a row are steps of that path.
Only the costs at the borders of blocks are kept: each block is summed up as the least
cost between any two states, the cost vectors at the checkpoints follow backward from the
end of the conversation, and every block is computed again from the vector behind it while
its edits are chosen forward. A block has about as many rows as the largest conversation
has blocks, so a task holds the square root of a conversation at most; the blocks of one
conversation are computed in different tasks, and what passes along it is four numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StringType, StructField,
                               StructType)

from pairpulse.llm.common import saved

#: Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: Rows of a block at least, as a power of two.
BLOCK_BITS = 12
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Initials of the roles by their code; 3 is any other.
_INITIALS = "sua"
_FAR = 1 << 50
_NEXT = {_NONE: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
#: State after a row of the role with this code, where it may stand.
_STEP = {(_NONE, 0): _SYSTEM, (_NONE, 1): _USER, (_SYSTEM, 1): _USER, (_USER, 2): _ASSISTANT,
         (_ASSISTANT, 1): _USER}
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
#: What is still inserted behind the last row.
_TAIL = {_NONE: "", _SYSTEM: "II", _USER: "I", _ASSISTANT: ""}
#: Bits of a row's code beside the two of its role.
_BLANK, _REPEATED, _CUT = 4, 8, 16


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    return tuple(min(costs[s], INSERT + costs[_NEXT[s]], 2 * INSERT + costs[_NEXT[_NEXT[s]]])
                 for s in range(4))


_END = _with_inserts([0, _FAR, _FAR, 0])


def _options(code: int, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a row in a state: ``initial, cost, next state``, in order of the initials."""
    yield "D", DELETE, state
    if not code & (_BLANK | _REPEATED):
        stays = TRUNCATED if code & _CUT else 0
        if (state, code & 3) in _STEP:
            yield "K", stays, _STEP[state, code & 3]
        yield "R", REROLE + stays, _NEXT[state]


class Paths:
    """Steps of the cost vectors; few vectors occur beside a constant, so steps are remembered."""

    def __init__(self):
        self.back: dict[tuple, tuple] = {}
        self.forth: dict[tuple, tuple] = {}

    def before(self, code: int, costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
        """Costs to go before a row from those after it, less their minimum, and the minimum."""
        known = self.back.get((code, costs))
        if known is None:
            found = _with_inserts([min(cost + costs[to] for _, cost, to in _options(code, s)) for s in range(4)])
            least = min(found)
            known = self.back[code, costs] = tuple(c - least if c < _FAR // 2 else _FAR for c in found), least
        return known

    def edits(self, code: int, costs: tuple[int, ...], state: int) -> tuple[str, int, int]:
        """The ASCII-least tight edits of a row, the state after them, and their cost."""
        key = code, costs, state
        if key not in self.forth:
            vector, least = self.before(code, costs)
            edits, spent = "", 0
            while edits[-1:] in ("", "I"):
                tight = {e: (c, to) for e, c, to in _options(code, state) if c + costs[to] == vector[state] + least}
                if INSERT + vector[_NEXT[state]] == vector[state]:
                    tight["I"] = INSERT, _NEXT[state]
                edit = min(tight)
                edits, spent, state = edits + edit, spent + tight[edit][0], tight[edit][1]
            self.forth[key] = edits, state, spent
        return self.forth[key]

    def summary(self, codes: bytes) -> list[int]:
        """Least costs through a block: entry ``4 * s + e`` from state ``s`` to state ``e``."""
        columns = []
        for end in range(4):
            costs, total = tuple(0 if s == end else _FAR for s in range(4)), 0
            for code in reversed(codes):
                costs, least = self.before(code, costs)
                total += least
            columns.append([c + total if c < _FAR // 2 else _FAR for c in costs])
        return [columns[e][s] for s in range(4) for e in range(4)]

    def walks(self, codes: bytes, after: tuple[int, ...]) -> list[tuple[str, int, int]]:
        """For each state before a block: its edits, the state after it, and their cost."""
        least = min(after)
        vectors = [tuple(c - least for c in after)]
        for code in reversed(codes):
            vectors.append(self.before(code, vectors[-1])[0])
        vectors.reverse()
        out = []
        for state in range(4):
            edits, spent = [], 0
            for code, costs in zip(codes, vectors[1:]):
                chosen, state, cost = self.edits(code, costs, state)
                edits.append(chosen)
                spent += cost
            out.append(("".join(edits), state, spent))
        return out


def _rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, code, key``: nulls of role and text are a space."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    kind: Column = F.lit(3)
    for i, initial in enumerate(_INITIALS):
        kind = F.when(F.col("role").startswith(initial), i).otherwise(kind)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    code = kind + F.when(blank, _BLANK).when(cut, _CUT).otherwise(0)
    conv = F.col("conv_id").cast("string")
    named = F.coalesce(F.concat(F.length(conv), F.lit(":"), conv), F.lit("-"))
    key = F.concat(named, F.lit(":"), F.length("role"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumns({"code": code.cast("int"), "key": F.unhex(F.md5(key))})


def _in_order(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, code, key, pos``: the rows of a conversation in order of ``pos``.

    Rows are dealt by ranges of their order, so a conversation of any size spreads over
    tasks; the last part of the order only spreads rows that are equal.
    """
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "key", "_salt")]
    narrow = rows.select("conv_id", "turn", "role", "code", "key",
                         F.xxhash64(F.monotonically_increasing_id()).alias("_salt"))
    return saved(narrow.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("pos", F.monotonically_increasing_id())
                 .select("conv_id", "turn", "code", "key", "pos"))


def _blocks(placed: DataFrame) -> DataFrame:
    """``conv_id, first, codes, keys, costs`` of each block: consecutive rows of one conversation.

    ``codes`` has a byte a row, ``keys`` sixteen. A row whose role and text stand earlier in
    the conversation gets its mark from the least place of each key, so no task holds the
    copies of one row.
    """
    largest = placed.groupBy("conv_id").count().agg(F.max("count").alias("n")).first().n or 1
    bits = max(BLOCK_BITS, math.ceil(math.log2(largest) / 2))
    firsts = (placed.filter(F.col("code").bitwiseAND(_BLANK) == 0).groupBy("key").agg(F.min("pos").alias("pos"))
              .select("pos", F.lit(True).alias("is_first")))
    both = placed.select("pos", F.lit(False).alias("is_first"), "conv_id", "code", "key").unionByName(
        firsts, allowMissingColumns=True)
    conv = placed.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", conv), StructField("first", LongType()),
                         StructField("codes", BinaryType()), StructField("keys", BinaryType()),
                         StructField("costs", ArrayType(LongType()))])
    names = schema.names

    def run(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by("pos")
        is_first = cell.column("is_first").to_numpy()
        marked = cell.column("pos").to_numpy()[is_first]
        rows = cell.filter(pa.array(~is_first))
        pos, code = rows.column("pos").to_numpy(), rows.column("code").to_numpy()
        repeated = (code & _BLANK == 0) & ~np.isin(pos, marked)
        codes = np.where(repeated, code & 3 | _REPEATED, code).astype(np.uint8)
        keys = b"".join(rows.column("key").to_pylist())
        conv = rows.column("conv_id").combine_chunks()
        run_of = conv.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.diff(run_of, prepend=-1))
        paths, out = Paths(), []
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(pos)]):
            own = codes[lo:hi].tobytes()
            out.append((int(pos[lo]), own, keys[16 * lo:16 * hi], paths.summary(own)))
        columns = [list(x) for x in zip(*out)] or [[], [], [], []]
        types = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        return pa.table([conv.take(pa.array(starts)), *map(pa.array, columns, types)], names=names)

    return saved(both.withColumn("cell", F.shiftright("pos", bits)).groupBy("cell").applyInArrow(run, schema))


def _vectors(blocks: DataFrame) -> DataFrame:
    """``first, after, is_last``: the cost vector at the checkpoint behind each block."""
    schema = StructType([StructField("first", LongType()), StructField("after", ArrayType(LongType())),
                         StructField("is_last", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, after = object(), _END
        for batch in batches:
            out = []
            for own, first, costs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                is_last = own != conv
                conv, after = own, _END if is_last else after
                out.append((first, list(after), "y" if is_last else "n"))
                after = tuple(min(costs[4 * s + e] + after[e] for e in range(4)) for s in range(4))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                    zip(*out), (pa.int64(), pa.list_(pa.int64()), pa.string()))], names=schema.names)

    return (blocks.select("conv_id", "first", "costs").repartition("conv_id")
            .sortWithinPartitions("conv_id", F.desc("first")).mapInArrow(run, schema))


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _walked(blocks: DataFrame) -> DataFrame:
    """The edits of each block for every state before it, with the state after them and their cost."""
    schema = StructType([*(blocks.schema[c] for c in ("conv_id", "first", "codes", "keys")),
                         StructField("edits", ArrayType(StringType())), StructField("ends", ArrayType(IntegerType())),
                         StructField("costs", ArrayType(LongType())),
                         *(StructField(c, LongType()) for c in _COUNTS),
                         StructField("head", IntegerType()), StructField("tail", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = Paths()
        for batch in batches:
            out = []
            for codes, after, is_last in zip(*(batch.column(c).to_pylist() for c in ("codes", "after", "is_last"))):
                walks = paths.walks(codes, tuple(after))
                if is_last == "y":
                    walks = [(e + _TAIL[to], to, c + INSERT * len(_TAIL[to])) for e, to, c in walks]
                kinds = [c & 3 for c in codes]
                out.append((*map(list, zip(*walks)),
                            *(sum(c & bit > 0 for c in codes) for bit in (_BLANK, _REPEATED, _CUT)),
                            sum(pair not in _LEGAL for pair in zip(kinds, kinds[1:])), kinds[0], kinds[-1]))
            if out:
                types = [f.type for f in _arrow(schema)][4:]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in schema.names[:4]),
                     *(pa.array(x, t) for x, t in zip(zip(*out), types))], names=schema.names)

    return saved(blocks.drop("costs").join(_vectors(blocks), "first").mapInArrow(run, schema))


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _starts(walked: DataFrame) -> DataFrame:
    """``first, start, between``: the state before each block; 1 if the roles at its border are illegal."""
    schema = StructType([StructField("first", LongType()), StructField("start", IntegerType()),
                         StructField("between", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, last = object(), _NONE, None
        for batch in batches:
            out = []
            for own, first, ends, head, tail in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if own != conv:
                    conv, state, last = own, _NONE, None
                out.append((first, state, int(last is not None and (last, head) not in _LEGAL)))
                state, last = ends[state], tail
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                    zip(*out), (pa.int64(), pa.int32(), pa.int32()))], names=schema.names)

    return (walked.select("conv_id", "first", "ends", "head", "tail").repartition("conv_id")
            .sortWithinPartitions("conv_id", "first").mapInArrow(run, schema))


def _edited(chosen: DataFrame) -> DataFrame:
    """``conv_id, block, at, edit, new_role, key``: rows that stay or are put in, in order of block and at."""
    schema = StructType([chosen.schema["conv_id"], StructField("block", LongType()), StructField("at", IntegerType()),
                         StructField("edit", StringType()), StructField("new_role", StringType()),
                         StructField("key", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, out = [], []
            blocks = zip(*(batch.column(c).to_pylist() for c in ("first", "codes", "keys", "start", "audit")))
            for i, (first, codes, keys, state, audit) in enumerate(blocks):
                row = 0
                for at, edit in enumerate(audit):
                    if edit != "D":
                        state = _STEP[state, codes[row] & 3] if edit == "K" else _NEXT[state]
                        source.append(i)
                        out.append((first, at, edit, None if edit == "K" else _ROLES[state],
                                    None if edit == "I" else keys[16 * row:16 * row + 16]))
                    row += edit != "I"
            if out:
                types = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv_id").take(pa.array(source)), *map(pa.array, zip(*out), types)],
                    names=schema.names)

    return chosen.select("conv_id", "first", "codes", "keys", "start", "audit").mapInArrow(run, schema)


def repaired(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repair of every conversation, and its rows after it.

    A row is kept (K, free), given the role user or assistant (R, 2), or deleted (D, 3); rows
    with the role user or assistant and an empty text are put in anywhere (I, 2). Blank rows
    and those whose role and text stand earlier in the conversation have to be deleted; a
    truncated row, whose last character that is no white space ends no sentence, costs 1
    where it stays. The roles' initials then read ``(s?(ua)+)?``, at the least cost, and the
    initials of the edits in order are the ASCII-least of the cheapest.

    The first frame has ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``
    (turns left out; rows by their first fault; neighbours whose roles may not follow one
    another), the second ``conv_id, block, at, edit, turn, role, text``, in order of block
    and at. Rows of a conversation stand by turn, nulls first, then by role and a hash of
    role and text. A null role or text is one space, a null ``conv_id`` a conversation like
    any other. Other columns are ignored; an empty table gives no rows.
    """
    rows = _rows(conversations)
    placed = _in_order(rows)
    walked = _walked(_blocks(placed))
    chosen = saved(walked.join(_starts(walked), "first").select(
        "conv_id", "first", "codes", "keys", "start", *_COUNTS, "between",
        F.get("edits", F.col("start")).alias("audit"), F.get("costs", F.col("start")).alias("cost")))
    in_order = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("first", "audit"))),
                                        lambda x: x.audit), "")
    verdict = chosen.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in _COUNTS[:3]), (F.sum("illegal") + F.sum("between")).alias("illegal"),
        F.sum("cost").alias("cost"), in_order.alias("audit"))
    wide = F.col("turn").cast("decimal(38,0)")
    gaps = placed.groupBy(F.col("conv_id").alias("_conv")).agg(F.coalesce(
        F.max(wide) - F.min(wide) + 1 - F.count_distinct("turn"), F.lit(0)).try_cast("long").alias("gaps"))
    verdict = verdict.join(gaps, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "gaps", *_COUNTS, "cost", "audit")
    # A kept row is the first with its role and text, so what its copies have in common is enough.
    texts = rows.groupBy("key").agg(
        F.any_value("role").alias("role"), F.any_value("text").alias("text"),
        F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("least"))
    edited = _edited(chosen)
    stay = edited.filter("key IS NOT NULL").join(texts, "key").select(
        "conv_id", "block", "at", "edit", F.col("least.turn").alias("turn"),
        F.coalesce("new_role", "role").alias("role"), "text")
    put_in = edited.filter("key IS NULL").select(
        "conv_id", "block", "at", "edit", F.lit(None).cast(conversations.schema["turn"].dataType).alias("turn"),
        F.col("new_role").alias("role"), F.lit("").alias("text"))
    return verdict, stay.unionByName(put_in)


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` over the ``role:text`` lines of each conversation in order.

    Lines pass one by one, so a conversation of any size needs the memory of a batch.
    """
    schema = StructType([rows.schema["conv_id"], StructField("repaired_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running = None, None
        for batch in batches:
            out = []
            ids = batch.column(0)
            for i, line in enumerate(batch.column(1)):
                own = ids[i].as_py()
                if running is None or own != conv:
                    if running is not None:
                        out.append((conv, running.hexdigest()))
                    conv, running = own, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(line.as_buffer())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], ids.type), pa.array([x[1] for x in out])],
                                                 names=schema.names)
            last = ids.type
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], last), pa.array([running.hexdigest()])],
                                             names=schema.names)

    lines = rows.select("conv_id", "block", "at", F.concat("role", F.lit(":"), "text").alias("line"))
    return (lines.repartition("conv_id").sortWithinPartitions("conv_id", "block", "at")
            .select("conv_id", "line").mapInArrow(run, schema))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in, by a checksum of conversation and turn.

    Of twenty rows one each is dropped, emptied, rid of its sentence ends, repeated, and given
    the role user. Nulls of role and text become a space.
    """
    part = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    fault = F.crc32(F.concat_ws(":", *part)) % 20
    rows = conversations.select("conv_id", "turn", fault.alias("_fault"),
                                *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (rows.filter("_fault <> 0").withColumn("_copy", F.explode(copies))
            .select("conv_id", "turn",
                    F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text")))


def repair_digests(conversations: DataFrame) -> DataFrame:
    """The repair of damaged conversations, with a digest of the rows after it; see ``repaired``."""
    verdict, rows = repaired(damaged(conversations))
    verdict = verdict.withColumnRenamed("conv_id", "_conv")
    hashed = digests(rows).withColumnRenamed("conv_id", "_own")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *_COUNTS, "cost")]
    return (conversations.select("conv_id").distinct()
            .join(verdict, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
            .join(hashed, F.col("conv_id").eqNullSafe(F.col("_own")), "left")
            .select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
