"""Repeated passages: paragraphs by MinHash banding, and runs of repeated segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pairpulse.llm.buckets import linked, shared_keys
from pairpulse.llm.common import stored
from pairpulse.llm.text import chunks, mix, shingle_hashes, words

SHINGLE_WORDS = 5
LEAST_SIMILARITY = 0.8
#: Share of the pairs at that similarity that must collide in a band.
RECALL = 0.99
#: Words of a paragraph (a line) that is looked at; a segment is a shingle.
PARAGRAPH_WORDS = 20
#: Of so many neighbouring segments the one of the smallest hash is looked at.
WINNOW = 4
#: Repeated segments this many words apart are one run, and runs must be so long.
RUN_GAP, RUN_WORDS = 12, 20
#: Bytes of text that a task looks at together.
SCAN_BYTES = 1 << 18
_LINE, _SEGMENT, _SHINGLES, _AGAIN = 0, 1, 2, 3
_ODD = np.uint64(0x9E3779B97F4A7C15)


def bands(similarity: float = LEAST_SIMILARITY, recall: float = RECALL, rows: int = 2) -> int:
    """Bands of ``rows`` hashes that make so many of the pairs at a similarity collide."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity ** rows)))


ROWS = 2
BANDS = bands(rows=ROWS)


def _units(data: np.ndarray, bounds: np.ndarray):
    """Words found in texts, first and last word of each paragraph, and the end of every line."""
    found = words(data, bounds)
    n = len(found.hashes)
    lines = np.unique(np.concatenate(
        [found.first, np.searchsorted(found.starts, np.flatnonzero(data == 10)), [n]]))
    lo, hi = lines[:-1], lines[1:]
    keep = hi - lo >= PARAGRAPH_WORDS
    return found, lo[keep], hi[keep], np.repeat(hi, hi - lo)


def _winnowed(hashes: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Places of the smallest of any ``WINNOW`` neighbouring hashes, of those inside a line.

    Whatever stands around it, words that hold so many segments have one of them chosen.
    """
    padded = np.full(len(hashes) + 2 * (WINNOW - 1), ~np.uint64(0))
    padded[WINNOW - 1:len(padded) - WINNOW + 1][inside] = hashes[inside]
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINNOW)
    at = np.unique(np.argmin(windows, axis=1) + np.arange(len(windows))) - (WINNOW - 1)
    at = at[(at >= 0) & (at < len(hashes))]
    return at[inside[at]]


def _in_runs(places: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Of segments in order, those in a sequence with small gaps that may be a run's length with its edges."""
    if not len(places):
        return places
    new = np.append(True, (np.diff(places) - SHINGLE_WORDS > RUN_GAP) | (np.diff(text[places]) > 0))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(places)) - 1
    size = places[last] - places[first] + SHINGLE_WORDS + 2 * (WINNOW - 1)
    return places[np.repeat(size >= RUN_WORDS, last - first + 1)]


def _again(text: np.ndarray, segments: np.ndarray) -> np.ndarray:
    """Which of some segments, in order, have stood in the same text before."""
    order = np.lexsort((segments, text))
    again = np.zeros(len(order), bool)
    again[order[1:]] = (np.diff(text[order]) == 0) & (segments[order[1:]] == segments[order[:-1]])
    return again


def _edges(chosen: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Segments next to the first and last of each chain of chosen ones, which end a run."""
    apart = np.diff(chosen) > WINNOW
    first = chosen[np.append(True, apart)[:len(chosen)]]
    last = chosen[np.append(apart, True)[:len(chosen)]]
    step = np.arange(1, WINNOW)
    at = np.unique(np.concatenate([(first[:, None] - step).ravel(), (last[:, None] + step).ravel()]))
    at = at[(at >= 0) & (at < len(inside))]
    return np.setdiff1d(at[inside[at]], chosen)


def _sequence_hash(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray, salt: int) -> np.ndarray:
    """A hash of the words of each unit, in order."""
    size = hi - lo
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(first, size)
    own = hashes[np.repeat(lo, size) + at]
    placed = mix(own + at.astype(np.uint64) * _ODD)
    return mix(np.add.reduceat(placed, first) + np.uint64(salt)) if len(lo) else np.zeros(0, np.uint64)


def _band_keys(shingles: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """One key per paragraph and band, of the smallest hashes of its shingles."""
    keys = np.zeros((BANDS, len(lo)), np.uint64)
    if not len(lo):
        return keys
    size = hi - lo - SHINGLE_WORDS + 1
    first = np.cumsum(size) - size
    own = shingles[np.repeat(lo - first, size) + np.arange(int(size.sum()))]
    for band in range(BANDS):
        for row in range(ROWS):
            salt = (band * ROWS + row + 1) * int(_ODD) % (1 << 64)
            least = np.minimum.reduceat((own ^ np.uint64(salt)) * np.uint64(salt | 1), first)
            keys[band] = mix(keys[band] * _ODD + least + np.uint64(band))
    return keys


def _scan(texts: pa.Array):
    """Of each run of texts: rows, places and keys of its paragraphs and segments."""
    for at, data, bounds in chunks(texts, SCAN_BYTES):
        if not len(data):
            continue
        found, pl, ph, line_end = _units(data, bounds)
        shingles = shingle_hashes(found.hashes, SHINGLE_WORDS)
        paragraph = _sequence_hash(found.hashes, pl, ph, _LINE + 1)
        segments = mix(shingles + np.uint64(_SEGMENT + 1))
        inside = np.arange(len(segments)) + SHINGLE_WORDS <= line_end[:len(segments)]
        yield (at, found, shingles, (pl, ph, paragraph, _band_keys(shingles, pl, ph)),
               (segments, inside, _winnowed(segments, inside)))


def _jaccard(a: set, b: set) -> bool:
    shared = len(a & b)
    return shared >= LEAST_SIMILARITY * (len(a) + len(b) - shared)


def _similar_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
        keep = [_jaccard(set(x), set(y)) for x, y in zip(left, right)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _similar_rows(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Similar paragraphs of a group, by counting shared shingles block by block."""
    column = group.column("shingles").combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    _, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    common = count[at] > 1
    names, at = np.unique(at[common], return_inverse=True)
    row = row[common]
    shared = np.zeros((len(sizes), len(sizes)), np.float32)
    for lo in range(0, len(names), 4096):
        own = (at >= lo) & (at < lo + 4096)
        held = np.zeros((len(sizes), min(4096, len(names) - lo)), np.float32)
        held[row[own], at[own] - lo] = 1
        shared += held @ held.T
    union = sizes[:, None] + sizes[None, :] - shared
    return np.nonzero(np.triu(shared >= LEAST_SIMILARITY * union, 1))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Passages of documents that stand in another document too.

    A paragraph is a line of ``PARAGRAPH_WORDS`` words or more. Its MinHash signature over
    5-word shingles is cut into bands whose number makes ``RECALL`` of the pairs at
    Jaccard ``LEAST_SIMILARITY`` collide; colliding paragraphs are compared by exact
    Jaccard and joined into components. A passage that is set into a longer paragraph is
    found by its segments, which are shingles: of any ``WINNOW`` neighbours one is chosen by
    its hash, so every passage has chosen ones and all copies have the same. At the ends of
    a run the neighbours are looked at too, up to its true end unless the other copy goes
    on there: then up to three words are left. Runs of ``RUN_WORDS`` words or more that
    recur word for word are passages.

    Returns ``doc_id, kind, start_word, end_word, component_id, kept``: one row per
    paragraph (kind ``paragraph``) or run (kind ``run``) that occurs in two or more
    documents, places in words from 0, end exclusive. ``component_id`` is the smallest
    ``doc_id`` that holds a member of the component (for a run, any of its segments);
    ``kept`` is true for the one occurrence, first by id and place, that stays. Documents
    without repeated passages, null and empty texts give no rows. Rows without an id are
    not looked at; rows of equal ids are one document. Other columns are ignored.

    Copies are counted per key before anything is moved. A second scan then reads places
    and shingles of those that may collide; the filter it consults has a fixed size. Of
    segments it moves those only that may be in a run.
    """
    texts = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())

    def keys(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, _, _, (_, _, paragraph, band_keys), (segments, _, chosen) in _scan(batch.column("text")):
            segment = segments[chosen]
            yield (np.concatenate([band_keys.ravel(), segment]),
                   np.concatenate([np.tile(paragraph, BANDS), segment]))

    shared = docs.sparkSession.sparkContext.broadcast(shared_keys(texts, keys))
    schema = StructType([texts.schema["doc_id"], *StructType.fromDDL(
        "kind int, key long, unit long, start int, stop int, shingles array<long>").fields])
    arrow = to_arrow_schema(schema)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, several = shared.value
        for batch in batches:
            ids = batch.column("doc_id")
            for at, found, shingles, (pl, ph, paragraph, band_keys), (segments, inside, chosen) in _scan(batch.column("text")):
                text = np.repeat(np.arange(len(found.bounds) - 1), np.diff(found.first))
                columns = []
                near = np.zeros(len(pl), bool)
                for band in range(BANDS):
                    close = several.holds(band_keys[band])
                    near |= close
                    own = np.flatnonzero(close | (repeated.holds(band_keys[band]) if band == 0 else False))
                    columns.append((_LINE, own, pl, ph, paragraph, band_keys[band], None))
                columns.append((_SHINGLES, np.flatnonzero(near), pl, ph, paragraph, paragraph, shingles))
                sl = np.arange(len(segments))
                chosen = _in_runs(chosen[repeated.holds(segments[chosen])], text)
                own = np.union1d(chosen, _edges(chosen, inside))
                again = _again(text[own], segments[own])
                for kind, which in ((_SEGMENT, ~again), (_AGAIN, again)):
                    columns.append((kind, own[which], sl, sl, None, segments, None))
                for kind, own, lo, hi, unit, key, payload in columns:
                    if not len(own):
                        continue
                    doc = text[lo[own]]
                    first = found.first[doc]
                    sets = [None] * len(own) if payload is None else [
                        np.unique(payload[i:j - SHINGLE_WORDS + 1]).view(np.int64)
                        for i, j in zip(lo[own], hi[own])]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at + doc)), pa.array(np.full(len(own), kind, np.int32)),
                         pa.array(key[own].view(np.int64)),
                         pa.nulls(len(own), pa.int64()) if unit is None else pa.array(unit[own].view(np.int64)),
                         pa.array((lo[own] - first).astype(np.int32)),
                         pa.nulls(len(own), pa.int32()) if unit is None else pa.array((hi[own] - first).astype(np.int32)),
                         pa.array(sets, pa.list_(pa.int64()))], schema=arrow)

    placed = stored(texts.mapInArrow(places, schema), "passages")
    lines = placed.filter(F.col("kind") == _LINE)
    buckets = lines.select("key", "unit").distinct()
    payload = placed.filter(F.col("kind") == _SHINGLES).groupBy("unit").agg(F.first("shingles").alias("shingles"))

    def verified(pairs: DataFrame) -> DataFrame:
        a = payload.select(F.col("unit").alias("a"), F.col("shingles").alias("sa"))
        b = payload.select(F.col("unit").alias("b"), F.col("shingles").alias("sb"))
        return pairs.join(a, "a").join(b, "b").mapInArrow(_similar_pairs, "a long, b long")

    classes = linked(buckets, verified, payload, _similar_rows)
    where = lines.select("doc_id", "unit", "start", "stop").distinct()
    paragraphs = (where.join(classes, F.col("unit") == F.col("node"), "left")
                  .withColumn("class", F.coalesce("component", "unit")).drop("node", "component"))
    segments = (placed.filter(F.col("kind").isin(_SEGMENT, _AGAIN))
                .select("doc_id", F.col("key").alias("class"), "start", (F.col("kind") == _AGAIN).alias("again")))

    def shared_by_documents(rows: DataFrame) -> DataFrame:
        first = rows.groupBy("class").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("_last"))
        return rows.join(first.filter("first_doc < _last").drop("_last"), "class")

    least = paragraphs.groupBy("class").agg(F.min(F.struct("doc_id", "start")).alias("least"))
    is_first = (F.col("doc_id") == F.col("least.doc_id")) & (F.col("start") == F.col("least.start"))
    found = shared_by_documents(paragraphs).join(least, "class").select(
        "doc_id", F.lit("paragraph").alias("kind"), F.col("start").alias("start_word"),
        F.col("stop").alias("end_word"), F.col("first_doc").alias("component_id"), is_first.alias("kept"))
    along = Window.partitionBy("doc_id").orderBy("start", "first_doc")
    gap = F.col("start") - F.lag("start").over(along) - SHINGLE_WORDS
    kept = (F.col("doc_id") == F.col("first_doc")) & ~F.col("again")
    runs = (shared_by_documents(segments).select("doc_id", "start", "first_doc", kept.alias("kept"))
            .withColumn("_new", F.when(gap.isNull() | (gap > RUN_GAP), 1).otherwise(0))
            .withColumn("_run", F.sum("_new").over(along))
            .groupBy("doc_id", "_run")
            .agg(F.min("start").alias("start_word"), (F.max("start") + SHINGLE_WORDS).alias("end_word"),
                 F.min("first_doc").alias("component_id"), F.min("kept").alias("kept"))
            .filter(F.col("end_word") - F.col("start_word") >= RUN_WORDS)
            .select("doc_id", F.lit("run").alias("kind"), "start_word", "end_word", "component_id", "kept"))
    return found.unionByName(runs)
