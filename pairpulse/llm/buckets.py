"""Linking the similar members of buckets, without listing all pairs of a bucket."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairpulse.llm.common import components, saved, stored
from pairpulse.llm.text import mix, spanning_forest

#: Members of a bucket that one task compares with as many others.
CHUNK_ROWS = 512
#: Bits of the filter of keys that a second scan consults; it only saves work.
FILTER_BITS = 1 << 27
#: Bits that tell units with the same key apart, and keys that a task holds before it sends them.
TAG_BITS, FLUSH_KEYS = 24, 1 << 20

Links = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]


def linked(buckets: DataFrame, verified: Callable[[DataFrame], DataFrame], payload: DataFrame,
           links: Links, few: int = 0, listed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Components ``node, component`` of units that share a bucket and are similar.

    ``buckets``: distinct ``key, unit``. ``verified`` keeps the similar ones of pairs
    ``a, b``. ``payload``: ``unit`` and what the exact test needs; ``links`` returns index
    pairs of similar rows of a table with those columns.

    First every unit is tested against the smallest unit of each of its buckets: as many
    pairs as there are rows. A bucket whose members are then one component is done, for
    further links in it would change nothing. Members of the others are compared in full
    by tasks that take two chunks of a bucket each and return a spanning forest. So no
    link between different components is lost, and no list of all pairs is formed.

    Of buckets of up to ``few`` members, ``listed`` gives the pairs ``a, b`` of different
    components, the smaller first, from ``key, unit, component``, so that a pair which shares
    several buckets, or was tested before, is not tested again.
    """
    least = (buckets.groupBy("key").agg(F.min("unit").alias("a"), F.max("unit").alias("_z"),
                                        F.count("*").alias("_n")).filter("a <> _z"))
    starred = stored(buckets.join(least.drop("_z"), "key"), "starred")
    pairs = starred.filter("a <> unit").select("a", F.col("unit").alias("b")).distinct()
    edges = saved(verified(pairs).select("a", "b"))
    joined = components(edges)
    member = (starred.filter("_n > 2").join(joined, F.col("unit") == F.col("node"), "left")
              .select("key", "unit", "_n", F.coalesce("component", "unit").alias("component")))
    open_keys = (member.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"))
                 .filter("_lo <> _hi").select("key"))
    rest = stored(member.join(open_keys, "key", "left_semi"), "members")
    if rest.isEmpty():
        return joined
    if few:
        again = (listed(rest.filter(F.col("_n") <= few).drop("_n")).distinct()
                 .join(pairs, ["a", "b"], "left_anti"))
        edges = edges.unionByName(verified(again).select("a", "b"))
        rest = rest.filter(F.col("_n") > few)
    n_chunks = F.ceil(F.col("_n") / CHUNK_ROWS).cast("int")
    chunk = F.pmod(F.xxhash64("unit", F.lit(7)), F.col("_k")).cast("int")
    other = F.col("_other")
    spread = (rest.withColumn("_k", n_chunks).withColumn("_own", chunk)
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
              .select("key", "unit", "component", F.least("_own", other).alias("ci"),
                      F.greatest("_own", other).alias("cj"))
              .join(payload, "unit"))

    def compare(group: pa.Table) -> pa.Table:
        i, j = links(group)
        component = group.column("component").to_numpy()
        names, at = np.unique(component, return_inverse=True)
        root = spanning_forest(len(names), at[i], at[j])
        moved = np.flatnonzero(root != np.arange(len(names)))
        return pa.table({"a": names[moved], "b": names[root[moved]]})

    # Rows of a chunk are few for the work on them, so tasks are not to be put together by their size.
    parts = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    more = (spread.repartition(parts, "key", "ci", "cj").groupBy("key", "ci", "cj")
            .applyInArrow(compare, "a long, b long"))
    return components(edges.unionByName(more))


class KeyFilter:
    """Tells which keys may be in a set; never denies one that is."""

    def __init__(self, words: np.ndarray | None, parts: list[bytes | None] | None = None, part_bytes: int = 0):
        """``words``: bits by the low bits of a key; their number is a power of two. Or ``parts``
        of them, compressed (None: no bit is set), which the first use makes into words: what
        the driver passes on then is as small as what it was given."""
        self._words, self._parts, self._part_bytes = words, parts, part_bytes

    @property
    def words(self) -> np.ndarray:
        if self._words is None:
            found = np.zeros((len(self._parts), self._part_bytes), np.uint8)
            for own, part in zip(found, self._parts):
                if part is not None:
                    own[:] = np.frombuffer(zlib.decompress(part), np.uint8)
            self._words, self._parts = found.ravel().view("<u8"), None
        return self._words

    @classmethod
    def of(cls, keys: DataFrame, bits: int = FILTER_BITS) -> KeyFilter:
        """Of one long column. The filter has a fixed size, whatever the number of keys."""
        slot = F.pmod(F.col(keys.columns[0]), F.lit(bits))
        rows = (keys.select((slot / 64).cast("int").alias("at"), (slot % 64).cast("int").alias("bit"))
                .groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word")))
        found = rows.toArrow()
        words = np.zeros(bits // 64, np.uint64)
        words[found.column("at").to_numpy()] = found.column("word").to_numpy().view(np.uint64)
        return cls(words)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        words = self.words
        slot = keys.view(np.uint64) & np.uint64(64 * len(words) - 1)
        return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _ends(packed: np.ndarray) -> np.ndarray:
    """Of sorted tagged keys, the first of each key and, where it has more, the last."""
    key = packed >> np.uint64(TAG_BITS)
    new = np.append(True, key[1:] != key[:-1])[:len(key)]
    last = np.append(new[1:], True)[:len(key)]
    return packed[new | last]


def _planes(packed: np.ndarray) -> bytes:
    """Numbers byte by byte: of sorted ones the high bytes are alike, of keys that are units the low ones too."""
    return packed.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: pa.Buffer) -> np.ndarray:
    """The reverse of ``_planes``."""
    return np.frombuffer(planes, np.uint8).reshape(8, -1).T.copy().view(">u8").ravel().astype(np.uint64)


def _blobs(held: list[tuple[np.ndarray, np.ndarray]], split: int) -> Iterator[pa.RecordBatch]:
    """The ends of the keys of each part, as one binary value a part."""
    part, packed = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(part.astype(np.uint16), kind="stable")
    edges = np.searchsorted(part[order], np.arange((1 << split) + 1, dtype=np.uint64))
    for i in range(1 << split):
        if edges[i] < edges[i + 1]:
            own = _ends(np.sort(packed[order[edges[i]:edges[i + 1]]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([_planes(own)], pa.binary())], names=["part", "packed"])


def shared_keys(texts: DataFrame, keyed: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]],
                bits: int = FILTER_BITS) -> tuple[KeyFilter, KeyFilter]:
    """Filters of the keys that occur twice or more, and of those that different units have.

    ``keyed`` gives keys and units, well mixed 64-bit numbers, of a batch of ``texts``. A key
    is shuffled as a number of 8 bytes, of which ``TAG_BITS`` stand for the unit: two units
    are taken for one in one of 2^24 cases, for each key anew. They are zero where the key
    is the unit, and such keys take about 3 bytes after compression. Tasks send at most two
    numbers a key and flush, so a hot key stays small. Numbers go by ranges of the filter;
    there are as many ranges as partitions of ``texts``, and each returns its part of the
    two filters, whose size is fixed; parts are compressed until a task consults them.
    """
    slots = bits.bit_length() - 1
    split = min(max(4, (texts.rdd.getNumPartitions() - 1).bit_length()), 12)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for key, unit in keyed(batch):
                turned = key << np.uint64(64 - slots) | key >> np.uint64(slots)
                tag = mix(unit ^ key) >> np.uint64(64 - TAG_BITS)
                rest = turned << np.uint64(split) >> np.uint64(TAG_BITS) << np.uint64(TAG_BITS)
                held.append((turned >> np.uint64(64 - split), rest | tag))
                size += len(key)
                if size >= FLUSH_KEYS:
                    yield from _blobs(held, split)
                    held, size = [], 0
        if size:
            yield from _blobs(held, split)

    def filtered(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        own = np.sort(np.concatenate([_numbers(x.as_buffer()) for x in group.column("packed")]))
        same = own[1:] >> np.uint64(TAG_BITS) == own[:-1] >> np.uint64(TAG_BITS)
        found = []
        for which in (same, same & (own[1:] != own[:-1])):
            words = np.zeros((bits >> split) // 8, np.uint8)
            slot = np.unique(own[1:][which] >> np.uint64(64 - slots + split))
            np.bitwise_or.at(words, slot >> np.uint64(3), np.uint8(1) << (slot & np.uint64(7)).astype(np.uint8))
            found.append(zlib.compress(words.tobytes(), 1) if len(slot) else None)
        return pa.table({"part": pa.array([part], pa.int32()), "repeated": pa.array([found[0]], pa.binary()),
                         "several": pa.array([found[1]], pa.binary())})

    parts = (texts.mapInArrow(packed, "part int, packed binary").groupBy("part")
             .applyInArrow(filtered, "part int, repeated binary, several binary")).toArrow()
    filters = []
    for name in ("repeated", "several"):
        own = dict(zip(parts.column("part").to_pylist(), parts.column(name).to_pylist()))
        filters.append(KeyFilter(None, [own.get(i) for i in range(1 << split)], bits >> split + 3))
    return filters[0], filters[1]
