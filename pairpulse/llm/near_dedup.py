"""SimHash near-duplicates by a binary trie that is joined with itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pairpulse.llm.common import components, saved, unused, with_row_key
from pairpulse.llm.text import bits_of, spanning_forest

SHINGLE_WORDS = 3
HASH_SEED = 42
MOST_BITS = 2
#: Bits by which the frontier of node pairs descends in one Spark step.
STEP_BITS = 4
#: Fingerprints below a node at which a task takes the pair of nodes.
NODE_ROWS = 16384
#: Node pairs that a task expands at a time, and links it holds before it reduces them.
BLOCK_PAIRS, HELD_LINKS = 1 << 18, 1 << 20
#: Comparisons that a pair of small nodes is worth instead of a further descent.
LEAF_PAIRS = 16


def fingerprint(text: bytes) -> int:
    """Majority of each bit over XXH64 of the 3-word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    ones, n = np.zeros(64, np.int64), 0
    k = min(SHINGLE_WORDS, len(words))
    for at in range(0, len(words) - k + 1, 1 << 16):
        part = words[at:at + (1 << 16) + k - 1]
        runs = zip(*(part[i:] for i in range(k)))
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(run), HASH_SEED) for run in runs),
                             np.uint64, len(part) - k + 1)
        ones += np.add.reduce(bits_of(hashes), axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *keys: str) -> DataFrame:
    """``fp`` (the fingerprint as a signed long) of each text, with the key columns."""
    kept = docs.select(*keys, "text")
    schema = kept.drop("text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = np.fromiter((fingerprint(t.as_py() or b"") for t in texts), np.uint64,
                                len(texts)).view(np.int64)
            columns = [batch.column(i) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], names=[*keys, "fp"])

    return kept.mapInArrow(run, schema)


def _prefix(depth: int):
    return F.shiftrightunsigned("fp", 64 - depth)


def node_pairs(fps: DataFrame, most_bits: int = MOST_BITS,
               node_rows: int = NODE_ROWS) -> Iterator[tuple[int, DataFrame]]:
    """``depth, pairs``: pairs of trie nodes ``a <= b`` whose prefixes differ in ``err`` bits.

    The frontier starts at the root paired with itself and descends ``STEP_BITS`` at a
    time: children of a pair are found by equal joins on the prefixes reachable within
    the rest of the error budget, so nothing beyond it is ever formed. Pairs of nodes
    with at most ``node_rows`` fingerprints each leave the frontier, the others go on,
    so a crowded part of the trie is split as deep as it needs.
    """
    spark = fps.sparkSession
    masks = F.array(*(F.struct(F.lit(m).cast("long").alias("mask"),
                               F.lit(m.bit_count()).alias("bits"))
                      for m in range(1 << STEP_BITS) if m.bit_count() <= most_bits))
    frontier = spark.range(1).select(F.lit(0).cast("long").alias("a"),
                                     F.lit(0).cast("long").alias("b"), F.lit(0).alias("err"))
    for depth in range(STEP_BITS, 64 + 1, STEP_BITS):
        at = _prefix(depth) if depth < 64 else F.col("fp")
        nodes = saved(fps.groupBy(at.alias("child")).agg(F.count("*").alias("rows")))
        parent = F.shiftrightunsigned("child", STEP_BITS)
        low = F.col("child").bitwiseAND((1 << STEP_BITS) - 1)
        left = nodes.select(parent.alias("a"), F.col("child").alias("ca"), low.alias("low"),
                            F.col("rows").alias("na"))
        right = nodes.select(F.col("child").alias("cb"), F.col("rows").alias("nb"))
        children = (frontier.join(left, "a")
                    .select("a", "b", "err", "ca", "na", "low", F.explode(masks).alias("m"))
                    .filter(F.col("err") + F.col("m.bits") <= most_bits)
                    .withColumn("cb", F.shiftleft("b", STEP_BITS)
                                .bitwiseOR(F.col("low").bitwiseXOR(F.col("m.mask"))))
                    .filter((F.col("a") != F.col("b")) | (F.col("ca") <= F.col("cb")))
                    .join(right, "cb"))
        pairs = saved(children.select(
            F.col("ca").alias("a"), F.col("cb").alias("b"),
            (F.col("err") + F.col("m.bits")).cast("int").alias("err"),
            (F.greatest("na", "nb") <= node_rows).alias("ready")))
        yield depth, pairs.filter("ready").drop("ready")
        frontier = pairs.filter("not ready").drop("ready")
        if frontier.isEmpty():
            return


def _links_below(a: np.ndarray, b: np.ndarray | None, err: int, depth: int,
                 most_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted fingerprints within the budget, by joint descent of two nodes.

    With ``b`` None the node is paired with itself. Blocks of node pairs are taken from a
    stack, deepest first, so what is held at once is bounded.
    """
    same = b is None
    b = a if same else b
    stack = [(depth, *(np.array([x]) for x in (0, len(a), 0, len(b), err)))]
    while stack:
        depth, al, ah, bl, bh, e = stack.pop()
        if len(al) > BLOCK_PAIRS:
            half = len(al) // 2
            stack.append((depth, *(x[:half] for x in (al, ah, bl, bh, e))))
            stack.append((depth, *(x[half:] for x in (al, ah, bl, bh, e))))
            continue
        small = (ah - al) * (bh - bl) <= (LEAF_PAIRS if depth < 64 else 1 << 62)
        if small.any():
            na, nb = (ah - al)[small], (bh - bl)[small]
            size = na * nb
            pair = np.repeat(np.arange(len(size)), size)
            at = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
            i = al[small][pair] + at // nb[pair]
            j = bl[small][pair] + at % nb[pair]
            near = np.bitwise_count(a[i] ^ b[j]) <= most_bits
            near &= (i < j) if same else True
            yield i[near], j[near]
            al, ah, bl, bh, e = (x[~small] for x in (al, ah, bl, bh, e))
        if not len(al):
            continue
        bit = np.uint64(1 << (63 - depth))
        keep = np.uint64(((1 << depth) - 1) << (64 - depth)) if depth else np.uint64(0)
        am = np.searchsorted(a, (a[al] & keep) | bit)
        bm = np.searchsorted(b, (b[bl] & keep) | bit)
        twin = (al == bl) & (ah == bh) if same else np.zeros(len(al), bool)
        grown = [(al, am, bl, bm, e), (am, ah, bm, bh, e), (al, am, bm, bh, e + 1)]
        other = ~twin
        grown.append(tuple(x[other] for x in (am, ah, bl, bm, e + 1)))
        merged = [np.concatenate(x) for x in zip(*grown)]
        alive = (merged[0] < merged[1]) & (merged[2] < merged[3]) & (merged[4] <= most_bits)
        if alive.any():
            stack.append((depth + 1, *(x[alive] for x in merged)))


def _join_nodes(most_bits: int):
    def run(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        fp = group.column("fp").to_numpy().view(np.uint64)
        err, depth = group.column("err")[0].as_py(), group.column("depth")[0].as_py()
        a = np.sort(fp[side == 0])
        b = np.sort(fp[side == 1]) if (side == 1).any() else None
        every = a if b is None else np.concatenate([a, b])
        shift = 0 if b is None else len(a)
        roots = np.arange(len(every))
        held, n = [], 0
        for i, j in _links_below(a, b, err, depth, most_bits):
            held.append((roots[i], roots[j + shift]))
            n += len(i)
            if n > HELD_LINKS:
                roots, held, n = _merged(roots, held), [], 0
        roots = _merged(roots, held)
        linked = roots != np.arange(len(every))
        return pa.table({"a": every[linked].view(np.int64), "b": every[roots[linked]].view(np.int64)})

    return run


def _merged(roots: np.ndarray, held: list) -> np.ndarray:
    if not held:
        return roots
    up = spanning_forest(len(roots), np.concatenate([x[0] for x in held]),
                         np.concatenate([x[1] for x in held]))
    return up[roots]


def fingerprint_links(fps: DataFrame, most_bits: int = MOST_BITS,
                      node_rows: int = NODE_ROWS) -> DataFrame:
    """Links ``a, b`` that connect exactly the distinct fingerprints within ``most_bits``.

    Each task gets a pair of trie nodes, at most ``2 * node_rows`` fingerprints, descends
    both tries together, and returns a spanning forest of the links it meets.
    """
    rows = None
    for depth, pairs in node_pairs(fps, most_bits, node_rows):
        at = fps.withColumn("_node", _prefix(depth) if depth < 64 else F.col("fp"))
        pairs = pairs.withColumn("depth", F.lit(depth))
        first = at.join(pairs, F.col("_node") == F.col("a")).withColumn("side", F.lit(0))
        second = (at.join(pairs.filter("a <> b"), F.col("_node") == F.col("b"))
                  .withColumn("side", F.lit(1)))
        both = first.unionByName(second).select("depth", "a", "b", "err", "side", "fp")
        rows = both if rows is None else rows.unionByName(both)
    return rows.groupBy("depth", "a", "b").applyInArrow(_join_nodes(most_bits), "a long, b long")


def near_duplicates(docs: DataFrame, *keys: str, most_bits: int = MOST_BITS,
                    node_rows: int = NODE_ROWS) -> DataFrame:
    """``doc_id``, further ``keys``, ``fp``, ``component`` and ``component_id`` of every row.

    Texts are lower-cased (A-Z) and cut at ASCII white space; the fingerprint is the
    bitwise majority over hashes of their 3-word shingles. Fingerprints link at
    ``most_bits`` differing bits or fewer; ``component`` is the smallest fingerprint of a
    component as a signed number, ``component_id`` its smallest ``doc_id``. Equal fingerprints are one node of the graph, so copies cost no links.
    A null text counts as empty; empty texts have fingerprint 0 and are linked like any
    other. Rows without an id take part; a component without any id has a null name.
    Repeated rows are kept. Other columns are ignored. An empty table gives no rows.
    """
    keyed = saved(fingerprints(docs, "doc_id", *keys))
    fps = saved(keyed.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    linked = components(fingerprint_links(fps.select("fp"), most_bits, node_rows))
    member = (fps.join(linked, F.col("fp") == F.col("node"), "left")
              .select("fp", "least_id", F.coalesce("component", "fp").alias("component")))
    named = member.groupBy("component").agg(F.min("least_id").alias("component_id"))
    names = member.join(named, "component").select("fp", "component", "component_id")
    return keyed.join(names, "fp").select("doc_id", *keys, "fp", "component", "component_id")


def one_of_each_group(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one of the smallest id.

    Columns and kept rows are unchanged. Of repeated ids the first stored row stays, and
    rows without an id come last in their group.
    """
    row = unused(docs, "_row")
    keyed = with_row_key(docs, row)
    grouped = near_duplicates(keyed, row, most_bits=most_bits)
    kept = (grouped.groupBy("component")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("least"))
            .select(F.col("least")[row].alias(row)))
    return keyed.join(kept, row, "left_semi").drop(row)
