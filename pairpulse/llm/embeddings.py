"""Near-duplicate embeddings by range search in a flat, robust-pruned graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairpulse.llm.common import components, saved, unit_interval
from pairpulse.llm.text import spanning_forest

LEAST_COSINE = 0.9
#: Vectors that the centroids are fitted on at most, about; every vector is indexed.
SAMPLE_VECTORS = 20_000
#: Vectors per cluster aimed at, and the most centroids; larger clusters are cut into shards.
CLUSTER_VECTORS, MOST_CLUSTERS = 800, 2048
#: Clusters a vector is put into at most, if their centroid is this close to the best one.
OVERLAP, OVERLAP_MARGIN = 4, 0.25
#: Vectors whose graph one task builds.
SHARD_VECTORS = 1024
#: Candidates and neighbours of a node, and the slack of the pruning rule.
CANDIDATES, DEGREE, ALPHA = 64, 24, 1.2
#: Nodes that the greedy search keeps open, and queries that run side by side.
BEAM, QUERIES = 12, 256
_STEPS = 200


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = flat.reshape(len(column), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def comparable(vectors: DataFrame) -> DataFrame:
    """Distinct usable vectors: ``unit, embedding, dim, weight``."""
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = vectors.filter(x.isNotNull() & (F.size(x) > 0) & ~bad & F.exists(x, lambda c: c != 0))
    return (usable.groupBy("embedding").agg(F.count("*").alias("weight"))
            .select(F.xxhash64("embedding").alias("unit"), "embedding", F.size("embedding").alias("dim"),
                    "weight"))


def centroids(v: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means, started at rows spread evenly over the sample."""
    c = v[np.linspace(0, len(v) - 1, k).astype(int)]
    for _ in range(rounds):
        own = np.argmax(v @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, v)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), c)
    return c


def _pruned(v: np.ndarray) -> np.ndarray:
    """Robust-pruned neighbours of each node, padded with -1.

    A candidate is dropped if a kept neighbour is nearer to it, by the slack, than the
    node is; what stays points in all directions. Reverse links are added and the lists
    pruned again, so that every node can be reached.
    """
    n = len(v)
    near = v @ v.T
    np.fill_diagonal(near, -2.0)
    distance = np.sqrt(np.maximum(2.0 - 2.0 * near, 0.0))

    def prune(pools: list[np.ndarray]) -> list[np.ndarray]:
        kept = []
        for i, pool in enumerate(pools):
            pool = pool[np.argsort(distance[i, pool], kind="stable")]
            chosen = []
            while len(pool) and len(chosen) < DEGREE:
                best = pool[0]
                chosen.append(best)
                pool = pool[1:]
                pool = pool[ALPHA * distance[best, pool] > distance[i, pool]]
            kept.append(np.array(chosen, np.int64))
        return kept

    if n == 1:
        return np.full((1, 1), -1)
    size = min(CANDIDATES, n - 1)
    close = np.argpartition(-near, size - 1, axis=1)[:, :size]
    # A few far nodes make pools that lead out of a dense group.
    step = np.linspace(1, n - 1, min(8, n - 1)).astype(int)
    far = (np.arange(n)[:, None] + step[None, :]) % n
    lists = prune([np.unique(np.concatenate([a, b])) for a, b in zip(close, far)])
    back: list[list[int]] = [[] for _ in range(n)]
    for i, own in enumerate(lists):
        for j in own:
            back[j].append(i)
    full = [np.unique(np.concatenate([own, np.array(b, np.int64)])) for own, b in zip(lists, back)]
    lists = [own if len(own) <= 2 * DEGREE else short
             for own, short in zip(full, prune(full))]
    width = max(len(x) for x in lists)
    return np.array([np.pad(x, (0, width - len(x)), constant_values=-1) for x in lists])


def _build(group: pa.Table) -> pa.Table:
    """Adjacency of one shard, with the mark of its medoid."""
    v = _matrix(group.column("embedding").combine_chunks())
    unit = group.column("unit").to_numpy()
    lists = _pruned(v)
    medoid = int(np.argmax(v @ v.sum(axis=0)))
    return pa.table({"unit": unit, "cluster": group.column("cluster"), "shard": group.column("shard"),
                     "neighbours": [unit[x[x >= 0]] for x in lists],
                     "medoid": np.arange(len(unit)) == medoid})


def _range_search(q: np.ndarray, v: np.ndarray, links: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which of ``v`` each query finds within the range, walking the graph only.

    A best-first walk from the medoids keeps ``BEAM`` nodes open. From then on every
    node found within the range is expanded, all at once, until no new one turns up.
    """
    n = len(v)
    sims = np.full((len(q), n), -3.0)
    done = np.zeros((len(q), n), bool)
    rows = np.arange(len(q))
    sims[:, start] = q @ v[start].T
    for _ in range(_STEPS):
        best = np.argmax(np.where(done, -4.0, sims), axis=1)
        value = np.where(done[rows, best], -4.0, sims[rows, best])
        last = np.partition(sims, n - min(BEAM, n), axis=1)[:, n - min(BEAM, n)]
        own = np.flatnonzero((value > -3.0) & (value >= last))
        if not len(own):
            break
        done[own, best[own]] = True
        reached = links[best[own]]
        at, slot = np.nonzero(reached >= 0)
        node = reached[at, slot]
        new = sims[own[at], node] <= -3.0
        at, node = own[at[new]], node[new]
        sims[at, node] = np.einsum("ij,ij->i", q[at], v[node])
    grid = np.zeros((n, n), np.float32)
    at, slot = np.nonzero(links >= 0)
    grid[at, links[at, slot]] = 1
    spread = np.zeros_like(done)
    while True:
        front = (sims >= LEAST_COSINE) & ~spread
        if not front.any():
            return sims >= LEAST_COSINE
        spread |= front
        at, node = np.nonzero((front.astype(np.float32) @ grid > 0) & (sims <= -3.0))
        for lo in range(0, len(at), 1 << 15):
            a, b = at[lo:lo + (1 << 15)], node[lo:lo + (1 << 15)]
            sims[a, b] = np.einsum("ij,ij->i", q[a], v[b])


def _search(group: pa.Table) -> pa.Table:
    """Links of the vectors of one shard into another: counts, and a spanning forest."""
    side = group.column("side").to_numpy()
    asked, graph = group.filter(pa.array(side == 0)), group.filter(pa.array(side == 1))
    if not len(asked) or not len(graph):
        return pa.table({"unit": pa.array([], pa.int64()), "n": pa.array([], pa.int64()),
                         "other": pa.array([], pa.int64())})
    q = _matrix(asked.column("embedding").combine_chunks())
    v = _matrix(graph.column("embedding").combine_chunks())
    qu, vu = asked.column("unit").to_numpy(), graph.column("unit").to_numpy()
    place = {u: i for i, u in enumerate(vu.tolist())}
    lists = [[place[x] for x in own if x in place] for own in graph.column("neighbours").to_pylist()]
    width = max(1, max(map(len, lists)))
    links = np.array([x + [-1] * (width - len(x)) for x in lists])
    start = np.flatnonzero(graph.column("medoid").to_numpy(zero_copy_only=False))
    cluster = group.column("cluster")[0].as_py()

    def holds(rows: pa.Table) -> np.ndarray:
        """The clusters of each row, padded, to see where a pair is counted."""
        own = rows.column("clusters").to_pylist()
        return np.array([x + [-1] * (OVERLAP - len(x)) for x in own])

    qc, vc = holds(asked), holds(graph)
    weight = graph.column("weight").to_numpy()
    within = np.array_equal(np.sort(qu), np.sort(vu))
    found_all = np.zeros((len(qu), len(vu)), bool)
    for lo in range(0, len(qu), QUERIES):
        found_all[lo:lo + QUERIES] = _range_search(q[lo:lo + QUERIES], v, links, start)
    if within:
        order = np.array([place[u] for u in qu.tolist()])
        square = found_all[:, order]
        found_all[:, order] = square | square.T
    # A pair of vectors is counted in the first cluster that both are in.
    shared = np.full(found_all.shape, np.iinfo(np.int32).max)
    for a in range(OVERLAP):
        for b in range(OVERLAP):
            same = (qc[:, a][:, None] == vc[:, b][None, :]) & (qc[:, a] >= 0)[:, None]
            np.minimum(shared, np.where(same, qc[:, a][:, None], shared), out=shared)
    other = qu[:, None] != vu[None, :]
    counts = ((found_all & other & (shared == cluster)) * weight[None, :]).sum(axis=1)
    heads, tails = np.nonzero(found_all & other)
    names, at = np.unique(np.concatenate([qu, vu]), return_inverse=True)
    root = spanning_forest(len(names), at[:len(qu)][heads], at[len(qu):][tails])
    moved = np.flatnonzero(root != np.arange(len(names)))
    return pa.table({"unit": np.concatenate([qu, names[moved]]),
                     "n": np.concatenate([counts, np.zeros(len(moved), np.int64)]),
                     "other": pa.array([None] * len(qu) + names[root[moved]].tolist(), pa.int64())})


def graph_shards(units: DataFrame) -> DataFrame:
    """Every vector with its clusters and, for each of them, a shard of bounded size."""
    spark = units.sparkSession
    sizes = {r.dim: r.n for r in units.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    centres: dict[int, np.ndarray] = {}
    for dim, n in sizes.items():
        share = min(1.0, SAMPLE_VECTORS / n)
        sample = (units.filter((F.col("dim") == dim) & (unit_interval(F.col("unit"), F.lit(6)) <= share))
                  .select("unit", "embedding").orderBy("unit").toArrow())
        if len(sample):
            v = _matrix(sample.column("embedding").combine_chunks())
            centres[dim] = centroids(v, min(len(v), MOST_CLUSTERS, -(-n // CLUSTER_VECTORS)))
    shared = spark.sparkContext.broadcast(centres)
    first = {dim: i * MOST_CLUSTERS for i, dim in enumerate(sorted(sizes))}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                c = shared.value.get(int(dim), None)
                v = _matrix(own.column("embedding"))
                near = v @ c.T if c is not None else np.zeros((len(v), 1))
                order = np.argsort(-near, axis=1, kind="stable")[:, :OVERLAP]
                value = np.take_along_axis(near, order, axis=1)
                take = value >= value[:, :1] - OVERLAP_MARGIN
                clusters = [(o[t] + first[int(dim)]).tolist() for o, t in zip(order, take)]
                yield pa.RecordBatch.from_arrays(
                    [own.column("unit"), own.column("embedding"), own.column("weight"),
                     pa.array(clusters, pa.list_(pa.int32()))],
                    names=["unit", "embedding", "weight", "clusters"])

    kind = units.schema["embedding"].dataType.simpleString()
    schema = f"unit long, embedding {kind}, weight long, clusters array<int>"
    rows = units.mapInArrow(assign, schema).withColumn("cluster", F.explode("clusters"))
    rows = saved(rows)
    count = rows.groupBy("cluster").agg(F.count("*").alias("_n"))
    return (rows.join(count, "cluster")
            .withColumn("shards", F.ceil(F.col("_n") / SHARD_VECTORS).cast("int"))
            .withColumn("shard", F.pmod(F.xxhash64("unit", F.lit(8)), F.col("shards")).cast("int"))
            .drop("_n"))


def linked_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding``.

    Centroids are fitted on a bounded sample. Every vector goes into the clusters whose
    centroid is about as near as the nearest one, so clusters overlap; clusters of more
    than ``SHARD_VECTORS`` are cut by hash into shards. Each shard builds a robust-pruned
    graph, and the adjacency lists of a vector from all of its shards are united into one
    flat graph. Every vector then searches the shards of its clusters from their medoids,
    expanding all it finds within the range. Found pairs are compared in double precision
    and counted in the first cluster the two share; no list of pairs leaves a task, only
    counts and spanning forests. The index is approximate: ``audited_recall`` measures it.

    Equal vectors are one node and link with one another. Vectors that are null, empty or
    zero, or hold null or non-finite components, link with nothing, and so do vectors of
    different lengths. Rows without an id take part in the counts; a component without
    an id is null and its rows are kept. Other columns, labels too, are ignored.
    """
    rows = vectors.select("vec_id", "embedding")
    units = saved(comparable(rows))
    shards = saved(graph_shards(units))
    lists = (shards.select("cluster", "shard", "unit", "embedding").groupBy("cluster", "shard")
             .applyInArrow(_build, "unit long, cluster int, shard int, neighbours array<long>, medoid boolean"))
    lists = saved(lists)
    flat = lists.groupBy("unit").agg(
        F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    graph = (shards.join(lists.select("cluster", "shard", "unit", "medoid"), ["cluster", "shard", "unit"])
             .join(flat, "unit")
             .select("cluster", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("ci"),
                     F.col("shard").alias("cj"), F.lit(1).alias("side"), "unit", "embedding", "weight",
                     "clusters", "neighbours", "medoid"))
    asked = shards.select(
        "cluster", F.col("shard").alias("ci"),
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("cj"), F.lit(0).alias("side"),
        "unit", "embedding", "weight", "clusters",
        F.lit(None).cast("array<long>").alias("neighbours"), F.lit(False).alias("medoid"))
    found = saved(asked.unionByName(graph).groupBy("cluster", "ci", "cj")
                  .applyInArrow(_search, "unit long, n long, other long"))
    edges = found.filter("other is not null").select(F.col("unit").alias("a"), F.col("other").alias("b"))
    classes = components(edges)
    counts = found.groupBy("unit").agg(F.sum("n").alias("n"))
    unit = F.xxhash64("embedding")
    usable = units.select(F.col("unit").alias("_u"), "weight")
    known = (rows.withColumn("unit", unit).join(usable, F.col("unit") == F.col("_u"), "left")
             .join(counts.withColumnRenamed("unit", "_c"), F.col("_u") == F.col("_c"), "left")
             .join(classes, F.col("_u") == F.col("node"), "left")
             .select("vec_id", F.col("_u").isNotNull().alias("_usable"),
                     (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).alias("n_links"),
                     F.coalesce("component", "_u").alias("_class")))
    named = known.filter("_usable").groupBy("_class").agg(F.min("vec_id").alias("_least"))
    return (known.join(named.withColumnRenamed("_class", "_k"), F.col("_class") == F.col("_k"), "left")
            .withColumn("component_id", F.when(F.col("_usable"), F.col("_least")).otherwise(F.col("vec_id")))
            .select("vec_id", "n_links", "component_id",
                    F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")))


def audited_recall(vectors: DataFrame, found: DataFrame, n_queries: int = 256) -> float:
    """Share of the true links of a bounded set of queries that ``found`` counts.

    The queries, chosen by a hash of ``vec_id``, are compared with every vector. 1.0 if
    they have no links.
    """
    rows = vectors.select("vec_id", "embedding").filter("vec_id is not null")
    chosen = saved(rows.join(comparable(rows).select("embedding"), "embedding", "left_semi")
                   .orderBy(F.xxhash64("vec_id", F.lit(5))).limit(n_queries))
    queries = chosen.toArrow()
    if not len(queries):
        return 1.0
    ids = queries.column("vec_id").to_numpy()
    raw = queries.column("embedding").to_pylist()
    shared = vectors.sparkSession.sparkContext.broadcast((ids, raw))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, raw = shared.value
        sizes = np.array([len(x) for x in raw])
        for batch in batches:
            lengths = np.diff(batch.column("embedding").offsets.to_numpy())
            for dim in np.unique(lengths):
                own = np.flatnonzero(sizes == dim)
                if not len(own):
                    continue
                q = _matrix(pa.array([raw[i] for i in own]))
                near = q @ _matrix(batch.filter(pa.array(lengths == dim)).column("embedding")).T
                weight = batch.filter(pa.array(lengths == dim)).column("weight").to_numpy()
                n = ((near >= LEAST_COSINE) * weight).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(n)], names=["vec_id", "n"])

    true = (comparable(rows).select("embedding", "weight").mapInArrow(compare, "vec_id long, n long")
            .groupBy("vec_id").agg((F.sum("n") - 1).alias("n_true")))
    both = true.join(found, "vec_id").agg(F.sum("n_true").alias("t"), F.sum("n_links").alias("f")).first()
    return both.f / both.t if both.t else 1.0
