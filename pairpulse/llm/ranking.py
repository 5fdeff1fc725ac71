"""Ranked lexical search for many queries at once, sharing what the queries have in common.

Terms that the same items hold form a shared term set. Each set is a leaf of a sharing
graph; sets that several items hold together are combined into inner nodes, so that an
item is the sum of a few nodes. A task walks its documents once: it fills the leaves'
accumulators, one number for each document and set, adds them up along the graph, and
keeps the best documents of every item.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pairpulse.llm.text import chunks, words

#: A term: letters, digits and all characters outside ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BEST = 10
#: Share of a document's length in its weight, in hundredths, and the scale of a term's count.
LENGTH_SHARE, COUNT_SCALE = 90, 1_000_000_000
#: Items that are ranked in one pass over the documents; more take further passes.
PASS_ITEMS = 2048
#: Numbers of a block of accumulators.
BLOCK_CELLS = 1 << 22
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Sharing(NamedTuple):
    """Nodes 0 to ``len(sets) - 1`` are the term sets; the others are sums of two nodes."""

    sets: list[list[str]]
    inner: list[tuple[int, int]]
    items: list[list[int]]   # nodes whose sum is the item


def term_sets(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``items, terms``: the terms that exactly these items hold, for every such set of items.

    Repeated rows of an item are one item, whose terms are those of all its rows.
    """
    terms = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    held = items.select(F.struct(F.col(item).alias("id")).alias("item"), F.explode(terms).alias("term"))
    return (held.groupBy("term").agg(F.sort_array(F.collect_set("item")).alias("items"))
            .groupBy("items").agg(F.sort_array(F.collect_list("term")).alias("terms")))


def sharing(sets: list[list[str]], holders: list[list[int]], n_items: int) -> Sharing:
    """The sharing graph of term sets and the items that hold them.

    The sets of an item stand in order of how many items hold them. The neighbours that
    most items have in common become a node of their own, in all of these items, until no
    two neighbours are left that two items share.
    """
    items = [[] for _ in range(n_items)]
    for node in sorted(range(len(sets)), key=lambda i: (-len(holders[i]), i)):
        for i in holders[node]:
            items[i].append(node)
    places = defaultdict(set)
    for i, nodes in enumerate(items):
        for pair in zip(nodes, nodes[1:]):
            places[pair].add(i)
    inner = []
    by_count = defaultdict(set)
    for pair, at in places.items():
        by_count[len(at)].add(pair)
    count = max(by_count, default=0)
    while count > 1:
        if not by_count[count]:
            count -= 1
            continue
        pair = min(by_count[count])
        node = len(sets) + len(inner)
        inner.append(pair)
        for i in sorted(places[pair]):
            nodes = items[i]
            at = next(k for k in range(len(nodes) - 1) if (nodes[k], nodes[k + 1]) == pair)
            joined = nodes[:at] + [node] + nodes[at + 2:]
            for old in Counter(zip(nodes, nodes[1:])).keys() - set(zip(joined, joined[1:])):
                by_count[len(places[old])].discard(old)
                places[old].discard(i)
                by_count[len(places[old])].add(old)
            for new in set(zip(joined, joined[1:])) - set(zip(nodes, nodes[1:])):
                by_count[len(places[new])].discard(new)
                places[new].add(i)
                by_count[len(places[new])].add(new)
            items[i] = joined
    return Sharing(sets, inner, items)


class Terms(NamedTuple):
    """The terms of all sets, in order of their hashes."""

    hashes: np.ndarray
    sizes: np.ndarray
    node: np.ndarray
    text: list[str]

    @classmethod
    def of(cls, sets: list[list[str]]) -> Terms:
        text = [t for terms in sets for t in terms]
        node = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        data = [t.encode() for t in text]
        bounds = np.cumsum([0, *map(len, data)])
        found = words(np.frombuffer(b"".join(data), np.uint8), bounds)
        order = np.argsort(found.hashes)
        return cls(found.hashes[order], np.diff(bounds)[order], node[order], [text[i] for i in order])

    def counts(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``n, text, term, tf``: terms of each text, and how often each of these terms is in which."""
        found = words(data, bounds)
        n = np.diff(found.first)
        at = np.minimum(np.searchsorted(self.hashes, found.hashes), len(self.hashes) - 1)
        known = np.flatnonzero((self.hashes[at] == found.hashes) & (self.sizes[at] == found.ends - found.starts))
        text = np.repeat(np.arange(len(n)), n)[known]
        pair, tf = np.unique(text * len(self.hashes) + at[known], return_counts=True)
        return n, pair // len(self.hashes), pair % len(self.hashes), tf


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at, data, bounds in chunks(batch.column(batch.num_columns - 1)):
            yield batch.column(0).slice(at, len(bounds) - 1), data, bounds


def statistics(docs: DataFrame, terms: Terms) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, terms of all documents, and documents that hold each given term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = total = 0
        held = np.zeros(len(terms.hashes), np.int64)
        for _, data, bounds in _text_batches(batches):
            n, _, term, _ = terms.counts(data, bounds)
            filled += int((n > 0).sum())
            total += int(n.sum())
            held += np.bincount(term, minlength=len(held))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(np.concatenate([[-2, -1], some]), pa.int64()),
            "n": pa.array(np.concatenate([[filled, total], held[some]]), pa.int64())})

    sums = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in sums.collect()}  # a row for each term of the items
    return found.pop(-2, 0), found.pop(-1, 0), found


def weight(filled: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * filled + 2) / (2 * held + 1)))


def _scores(graph: Sharing, terms: Terms, weights: np.ndarray, filled: int, total: int,
            data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Scores of items (rows) and texts (columns)."""
    n, text, term, tf = terms.counts(data, bounds)
    # In whole numbers of any size: the product may pass 64 bits on a large corpus.
    m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * x * filled // total for x in n.tolist()], np.int64)
    gain = weights[term] * (COUNT_SCALE * tf // (1000 * tf + 8 * m[text]))
    sums = np.zeros((len(graph.sets) + len(graph.inner), len(n)), np.int64)
    np.add.at(sums, (terms.node[term], text), gain)
    for at, (a, b) in enumerate(graph.inner, len(graph.sets)):
        np.add(sums[a], sums[b], out=sums[at])
    return np.stack([sums[nodes].sum(axis=0) for nodes in graph.items])


def _best(rows: pa.Table, k: int) -> pa.Table:
    """The ``k`` best rows of each item."""
    order = pc.sort_indices(rows, null_placement="at_start", sort_keys=[
        ("item", "ascending"), ("score", "descending"), ("doc", "ascending")])
    rows = rows.take(order)
    item = rows.column("item").to_numpy()
    first = np.searchsorted(item, item)
    return rows.filter(pa.array(np.arange(len(item)) - first < k))


def _ranked_pass(docs: DataFrame, items: DataFrame, doc: str, item: str, k: int) -> DataFrame | None:
    found = items.transform(term_sets, item, "text").collect()  # terms of at most PASS_ITEMS items
    ids = sorted({x.id for r in found for x in r["items"]}, key=lambda x: (x is not None, x))
    place = {x: i for i, x in enumerate(ids)}
    sets = [r.terms for r in found]
    if not sets:
        return None
    graph = sharing(sets, [[place[x.id] for x in r["items"]] for r in found], len(ids))
    terms = Terms.of(sets)
    filled, total, held = statistics(docs, terms)
    if not total:
        return None
    weights = np.array([weight(filled, held.get(i, 0)) for i in range(len(terms.text))], np.int64)
    schema = StructType([StructField("item", LongType()), StructField("doc", docs.schema[doc].dataType),
                         StructField("score", LongType())])
    block = max(1, BLOCK_CELLS // (len(graph.sets) + len(graph.inner)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        least = np.ones(len(ids), np.int64)
        for docs_of, data, bounds in _text_batches(batches):
            for at in range(0, len(docs_of), block):
                some = docs_of.slice(at, block)
                part = bounds[at:at + len(some) + 1]
                scores = _scores(graph, terms, weights, filled, total, data[part[0]:part[-1]], part - part[0])
                order = pc.sort_indices(some, null_placement="at_start").to_numpy()
                scores = scores[:, order]
                top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                score = np.take_along_axis(scores, top, axis=1)
                row, column = np.nonzero(score >= least[:, None])
                if not len(row):
                    continue
                new = pa.table({"item": pa.array(row), "doc": some.take(pa.array(order[top[row, column]])),
                                "score": pa.array(score[row, column])})
                best = _best(new if best is None else pa.concat_tables([best, new]), k)
                held_by = best.column("item").to_numpy()
                last = np.flatnonzero(np.bincount(held_by, minlength=len(ids)) == k)
                least[last] = best.column("score").to_numpy()[np.searchsorted(held_by, last, "right") - 1]
        if best is not None:
            yield from best.combine_chunks().to_batches()

    rows = docs.select(doc, "text").mapInArrow(run, schema)
    named = docs.sparkSession.createDataFrame(list(enumerate(ids)), StructType(
        [StructField("item", LongType()), StructField("id", items.schema[item].dataType)]))
    return rows.join(F.broadcast(named), "item").select("id", "doc", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, doc: str = "doc_id",
           item: str = "item_id", pass_items: int = PASS_ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents that score highest for each item.

    A score sums ``w * (10^9 tf div (1000 tf + 8 m))`` over the different terms of the item,
    where ``tf`` counts the term in the document, ``w`` grows with how few documents hold
    it, and ``m`` with the length of the document. Only scores above 0 are ranked, equal
    ones by ascending ``doc_id``, rows without an id first.

    Rows of one item are one item, also where the id is null; an item without a term, or
    whose terms are in no document, has no rows. A null or empty text holds no term.
    Repeated documents are ranked one by one. Other columns are ignored, and an empty table
    on either side gives no rows. Each task returns at most ``k`` rows an item; passes of
    about ``pass_items`` items bound what is broadcast, whatever their number.
    """
    n = items.agg(F.count_distinct(F.struct(item)).alias("n")).first().n
    passes = max(1, -(-n // pass_items))
    which: Column = F.pmod(F.xxhash64(item), F.lit(passes))
    out = None
    for i in range(passes):
        part = _ranked_pass(docs, items.filter(which == i), doc, item, k)
        if part is not None:
            out = part if out is None else out.unionByName(part)
    if out is None:
        out = items.select(F.col(item).alias("id")).limit(0).join(docs.select(F.col(doc).alias("doc")).limit(0)).select(
            "id", "doc", F.lit(0).cast("long").alias("score"))
    order = Window.partitionBy("id").orderBy(F.desc("score"), F.col("doc").asc_nulls_first())
    return (out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(F.col("id").alias(item), "rank", F.col("doc").alias(doc), "score"))
