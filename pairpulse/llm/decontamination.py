"""Benchmark decontamination by SimHash windows as long as the benchmark items."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

import pairpulse.llm.common  # noqa: F401  ships the package to Python workers
from pairpulse.llm.text import bits_of, chunks, packed, shingle_hashes, words

SHINGLE_WORDS = 5
LEAST_SIMILARITY = 0.8
#: Fingerprints at most so many bits apart are candidates.
RADIUS = 11
#: Blocks of the multi-index: one of them differs in ``RADIUS // BLOCKS`` bits or fewer.
BLOCKS = 4
#: Window lengths grow by this factor; an item is sought by windows of the next shorter length.
LENGTH_STEP = 1.15
#: Bounds of what one pass broadcasts; a larger benchmark takes several passes.
PASS_ITEMS, PASS_BYTES = 20_000, 32 << 20
#: Bytes of text whose windows are held at a time, about.
_TEXT_BYTES = 1 << 17


class Items(NamedTuple):
    """The benchmark items of one pass, as they are broadcast."""

    ids: list
    hashes: list[np.ndarray]  # shingle hashes of each item
    lengths: np.ndarray       # in words


def window_length(n_words: np.ndarray) -> np.ndarray:
    """The longest length of the geometric series 5, 6, ... that is not above ``n_words``."""
    series = [SHINGLE_WORDS]
    while series[-1] < n_words.max(initial=SHINGLE_WORDS):
        series.append(max(series[-1] + 1, int(series[-1] * LENGTH_STEP)))
    return np.array(series)[np.searchsorted(series, n_words, "right") - 1]


def prepared(rows: list) -> Items:
    ids, hashes, lengths = [], [], []
    for item_id, text in rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        found = words(data, np.array([0, len(data)]))
        if len(found.hashes) >= SHINGLE_WORDS:
            ids.append(item_id)
            hashes.append(shingle_hashes(found.hashes, SHINGLE_WORDS))
            lengths.append(len(found.hashes))
    return Items(ids, hashes, np.array(lengths, np.int64))


def majority(counts: np.ndarray, n: int) -> np.ndarray:
    return packed(2 * counts.astype(np.int32) > n)


def _least_shared(size: int, n: int) -> int:
    """Shingles that texts of ``size`` and ``n`` shingles share at least if they are similar."""
    return int(np.ceil(LEAST_SIMILARITY / (1 + LEAST_SIMILARITY) * (size + n) - 1e-9))


class Index:
    """Multi-index Hamming tables of the items, by window length, and their rarest shingles.

    A text, or a window of it, that is similar to an item of n shingles shares
    ``LEAST_SIMILARITY`` n of them at least, so one of any other n - that + 1: the item's
    rarest ones are its seeds.

    Of each item the first and the last window of its length are kept. A table per block
    of 16 bits names, for each value, the windows whose block is within the radius of a
    block of it, so a lookup per block finds every window within ``RADIUS`` bits.
    """

    def __init__(self, items: Items):
        self.by_length: dict[int, tuple] = {}
        every = np.concatenate([np.zeros(0, np.uint64), *items.hashes])
        _, at, count = np.unique(every, return_inverse=True, return_counts=True)
        seeds, base = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
        for item, own in enumerate(items.hashes):
            rare = np.argsort(count[at[base:base + len(own)]], kind="stable")
            rare = rare[:len(own) - int(np.ceil(LEAST_SIMILARITY * len(own) - 1e-9)) + 1]
            seed = np.unique(own[rare])
            seeds.append((seed, np.full(len(seed), item)))
            base += len(own)
        seed, item = (np.concatenate(x) for x in zip(*seeds))
        order = np.argsort(seed, kind="stable")
        self.seeds, self.seed_items = seed[order], item[order]
        self.seeded = np.zeros(1 << 22, np.bool_)
        self.seeded[seed & np.uint64((1 << 22) - 1)] = True
        near = [m for m in range(1 << 16) if m.bit_count() <= RADIUS // BLOCKS]
        near = np.array(near, np.uint16)
        classes = window_length(items.lengths)
        for length in np.unique(classes):
            m = int(length) - SHINGLE_WORDS + 1
            entries = []
            for item in np.flatnonzero(classes == length):
                own = items.hashes[item]
                for at in {0, len(own) - m}:
                    ones = bits_of(own[at:at + m]).sum(axis=0, keepdims=True)
                    entries.append((item, at, majority(ones, m)[0]))
            fps = np.array([e[2] for e in entries], np.uint64)
            hit = np.zeros((BLOCKS, 1 << 16), np.bool_)
            lists = []
            for block, values in enumerate(fps.view(np.uint16).reshape(-1, BLOCKS).T):
                keys = (values[:, None] ^ near[None, :]).ravel()
                which = np.repeat(np.arange(len(fps), dtype=np.int32), len(near))
                order = np.argsort(keys, kind="stable")
                hit[block, keys] = True
                lists.append((np.searchsorted(keys[order], np.arange((1 << 16) + 1)), which[order]))
            self.by_length[int(length)] = (
                m, hit, lists, fps, np.array([e[0] for e in entries]), np.array([e[1] for e in entries]))

    def holders(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of shingles that are seeds, and the items they are of."""
        own = np.flatnonzero(self.seeded[shingles & np.uint64((1 << 22) - 1)])
        lo, hi = (np.searchsorted(self.seeds, shingles[own], side) for side in ("left", "right"))
        size = hi - lo
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return np.repeat(own, size), self.seed_items[np.repeat(lo, size) + step]

    def candidates(self, window_fps: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows and index entries of that length within the radius."""
        _, hit, lists, fps, _, _ = self.by_length[length]
        blocks = window_fps.view(np.uint16).reshape(-1, BLOCKS)
        found = []
        for block in range(BLOCKS):
            own = np.flatnonzero(hit[block][blocks[:, block]])
            starts, which = lists[block]
            lo, hi = starts[blocks[own, block]], starts[blocks[own, block].astype(np.int64) + 1]
            size = hi - lo
            at = np.repeat(own, size)
            step = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
            entry = which[np.repeat(lo, size) + step]
            near = np.bitwise_count(window_fps[at] ^ fps[entry]) <= RADIUS
            found.append((at[near], entry[near]))
        return tuple(np.concatenate(x) for x in zip(*found))


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shared over all shingles of two texts, each weighted by how often it occurs."""
    ca, cb = Counter(a.tolist()), Counter(b.tolist())
    shared = sum(min(n, cb[s]) for s, n in ca.items())
    return shared / (len(a) + len(b) - shared)


def _window_counts(bits: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each size, the number of ones per bit in every run of so many rows.

    Runs of powers of two come from two of half the length; others from those.
    """
    bits = bits.astype(np.uint16 if max(sizes) > 255 else np.uint8)
    doubled = [bits]
    while 2 << (len(doubled) - 1) <= min(max(sizes), len(bits)):
        last, half = doubled[-1], 1 << (len(doubled) - 1)
        doubled.append(last[:-half] + last[half:])
    for size in sizes:
        n = len(bits) - size + 1
        if n <= 0:
            continue
        total, at = None, 0
        for power in reversed(range(len(doubled))):
            if size >> power & 1:
                part = doubled[power][at:at + n]
                total = part if total is None else total + part
                at += 1 << power
        yield size, total


def _leaks(found, items: Items, index: Index, out: dict) -> None:
    """Verified places of items in the texts of one chunk, best per text and item."""
    every = shingle_hashes(found.hashes, SHINGLE_WORDS)
    if not len(every):
        return
    text_end = found.first[1:]
    by_size = {m: length for length, (m, *_) in index.by_length.items()}
    at, item = index.holders(every)
    text = np.searchsorted(text_end, at, "right")
    whole = at + SHINGLE_WORDS <= text_end[text]
    pairs = set(zip(text[whole].tolist(), item[whole].tolist()))
    for m, counts in _window_counts(bits_of(every), sorted(by_size)):
        fps = np.packbits((counts > m // 2).reshape(-1), bitorder="little").view("<u8")
        length = by_size[m]
        at, entry = index.candidates(fps, length)
        text = np.searchsorted(text_end, at, "right")
        inside = at + length <= text_end[text]
        pairs |= set(zip(text[inside].tolist(), index.by_length[length][4][entry[inside]].tolist()))
    for t, item in pairs:
        first, end, own = int(found.first[t]), int(text_end[t]), items.hashes[item]
        held = every[first:end - SHINGLE_WORDS + 1]
        size = min(len(own), len(held))
        shared = np.concatenate([[0], np.cumsum(np.isin(held, own))])
        starts = np.flatnonzero(shared[size:] - shared[:len(shared) - size] >= _least_shared(size, len(own)))
        best = max(((weighted_similarity(held[s:s + size], own), -s) for s in starts.tolist()), default=(0.0, 0))
        if best[0] >= LEAST_SIMILARITY:
            out[t, item] = (best[0], -best[1], size + SHINGLE_WORDS - 1)


def _found(texts: pa.Array, items: Items, index: Index) -> dict:
    """``(row, item) -> (similarity, first word, words)`` of the leaks in a column of texts."""
    out: dict = {}
    if len(items.ids):
        for at, data, bounds in chunks(texts, _TEXT_BYTES):
            own: dict = {}
            _leaks(words(data, bounds), items, index, own)
            out |= {(at + t, item): v for (t, item), v in own.items()}
    return out


def _passes(benchmark: DataFrame) -> Iterator[Broadcast]:
    """The benchmark in parts of bounded size, each broadcast."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", "text")
    total = items.agg(F.count("*").alias("n"),
                      F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    passes = max(1, -(-total.n // PASS_ITEMS), -(-total.b // PASS_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    for number in range(passes):
        rows = items.filter(part == number).collect()
        yield spark.sparkContext.broadcast(prepared([tuple(r) for r in rows]))


def leaks(docs: DataFrame, benchmark: DataFrame, *keys: str) -> DataFrame:
    """Benchmark items that stand in a document, with the columns ``keys`` of the document.

    Texts are cut into words (letters and digits, A-Z lower-cased). Windows of about the
    length of an item slide over every whole text, word by word; the fingerprint of a
    window is the bitwise majority over its 5-word shingles. A multi-index finds all
    fingerprints within ``RADIUS`` bits of an item's. Edits move fingerprints further, so a
    text that holds one of the rarest shingles of an item is a candidate too, and with that
    none is missed. The windows of the item's length, or all of a shorter text, are compared
    with it by weighted shingles. Those of ``LEAST_SIMILARITY`` or more are leaks.

    Returns ``keys, item_id, similarity, start_word, n_words``: the best (then first)
    window per row and item. Rows of equal ids or texts are separate. Null and empty
    texts have no leaks, items of fewer than five words are not sought, null item ids are
    kept. An empty table on either side gives no rows. Other columns are ignored.

    The benchmark is broadcast in passes of at most ``PASS_ITEMS`` items or about
    ``PASS_BYTES``, a fixed bound that does not grow with it; documents are never shuffled.
    """
    kept = docs.select(*keys, "text")
    id_type = benchmark.schema["item_id"].dataType
    schema = StructType([*(kept.schema[k] for k in keys), StructField("item_id", id_type),
                         *StructType.fromDDL("similarity double, start_word long, n_words long").fields])
    arrow = to_arrow_schema(schema)
    result = None
    for shared in _passes(benchmark):
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items, index = shared.value, Index(shared.value)
            for batch in batches:
                found = _found(batch.column("text"), items, index)
                rows = pa.array([t for t, _ in found], pa.int64())
                columns = [batch.column(i).take(rows) for i in range(len(keys))]
                columns += [pa.array([items.ids[i] for _, i in found], arrow.field("item_id").type),
                            pa.array([v[0] for v in found.values()], pa.float64()),
                            pa.array([v[1] for v in found.values()], pa.int64()),
                            pa.array([v[2] for v in found.values()], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

        found = kept.mapInArrow(run, schema)
        result = found if result is None else result.unionByName(found)
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; other rows are unchanged."""
    for shared in _passes(benchmark):
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items, index = shared.value, Index(shared.value)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[t for t, _ in _found(batch.column("text"), items, index)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
