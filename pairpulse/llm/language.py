"""Language identification of words by a linear-chain conditional random field."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from pairpulse.llm.common import saved, unit_interval
from pairpulse.llm.text import IS_WORD, Words, chunks, words

#: Labelled documents per language that the model is fitted on, about; chosen by hash.
SAMPLE_DOCS = 1000
#: Parts of the sample that are fitted side by side, their weights averaged.
SHARDS = 4
#: Words of a part that are trained on, in pieces from all of its documents.
SHARD_WORDS = 200_000
PIECE_WORDS = (3, 60)
SEQUENCE_WORDS = 128
EPOCHS = 4
#: Hashed affix and n-gram features; lexicon features follow, one per language.
FEATURES = 1 << 16
#: A word is in a language's lexicon if the sample has it so often, and so rarely elsewhere.
LEXICON_COUNT, LEXICON_SHARE = 5, 0.9
LEXICON_WORDS = 100_000
UNDETERMINED = "und"
#: A document whose best language has a smaller mean probability is rejected.
LEAST_SCORE = 0.4

_SLOTS = 20          # bits of the lexicon's address
_PIECE = 1 << 17     # words of one text that are decoded as one chain at most
_BLOCK = 128
_SALTS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)]


class Model(NamedTuple):
    labels: list[str]
    weights: np.ndarray      # label x (feature, then lexicon of each language, then none)
    transitions: np.ndarray  # label x label
    start: np.ndarray
    lexicon: np.ndarray      # language + 1 of a word's address, or 0


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _bucket(x: np.ndarray, salt: np.uint32) -> np.ndarray:
    return ((x.astype(np.uint32) + salt) * np.uint32(0x9E3779B1)) >> np.uint32(16)


def _features(found: Words, lo: int, hi: int, lexicon: np.ndarray,
              n_labels: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of words lo to hi: buckets of their trigrams, where each word's begin, other features."""
    starts, ends = found.starts[lo:hi], found.ends[lo:hi]
    base = int(starts[0])
    data = found.lower[base:int(ends[-1])].astype(np.uint32)
    s, e = starts - base, ends - base
    size = e - s
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(first - s, size)
    before = data[np.maximum(at - 1, 0)]
    after = data[np.minimum(at + 1, len(data) - 1)]
    before[first] = 0
    after[first + size - 1] = 0
    trigrams = _bucket(before | data[at] << np.uint32(8) | after << np.uint32(16), _SALTS[0])

    def byte(place: np.ndarray, inside: np.ndarray) -> np.ndarray:
        return np.where(inside, data[np.clip(place, 0, len(data) - 1)], np.uint32(0))

    b0, b1, b2 = data[s], byte(s + 1, size > 1), byte(s + 2, size > 2)
    z0, z1, z2 = data[e - 1], byte(e - 2, size > 1), byte(e - 3, size > 2)
    pre2, suf2 = b0 | b1 << np.uint32(8), z0 | z1 << np.uint32(8)
    in_lexicon = lexicon[found.hashes[lo:hi] >> np.uint64(64 - _SLOTS)].astype(np.int64)
    return trigrams, first, [
        _bucket(pre2, _SALTS[1]), _bucket(pre2 | b2 << np.uint32(16), _SALTS[2]),
        _bucket(suf2, _SALTS[3]), _bucket(suf2 | z2 << np.uint32(16), _SALTS[4]),
        FEATURES + np.where(in_lexicon > 0, in_lexicon - 1, n_labels)]


def _emissions(weights: np.ndarray, trigrams, first, others) -> np.ndarray:
    out = np.empty((len(first), len(weights)))
    for k, w in enumerate(weights):
        out[:, k] = np.add.reduceat(w[trigrams], first)
        for ids in others:
            out[:, k] += w[ids]
    return out


def marginals(emissions: np.ndarray, opens: np.ndarray, transitions: np.ndarray, start: np.ndarray,
              with_pairs: bool = False) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """Probability of each label for each word, by forward-backward over chained texts; with
    ``with_pairs`` also how many transitions of each kind are expected, by the probability
    of each pair of labels of neighbouring words.

    ``opens`` marks the first word of each text. The words are cut into blocks of equal
    length. The product of step matrices over each block gives the messages between the
    blocks, and then all blocks run forward and backward side by side: exact, and a
    handful of array operations for each place in a block.
    """
    n, k = emissions.shape
    n_blocks = -(-n // _BLOCK)
    e = np.ones((n_blocks * _BLOCK, k))
    e[:n] = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    e = np.ascontiguousarray(e.reshape(n_blocks, _BLOCK, k).swapaxes(0, 1))
    new = np.ones(n_blocks * _BLOCK, bool)  # what fills the last block is cut off from the texts
    new[:n] = opens
    new = np.ascontiguousarray(new.reshape(n_blocks, _BLOCK).T)
    a, s = np.exp(transitions), np.exp(start)
    product = np.broadcast_to(np.eye(k), (n_blocks, k, k)).copy()
    for t in range(_BLOCK):
        fresh = new[t]
        product = np.where(fresh[:, None, None], product.sum(axis=2, keepdims=True) * s, product @ a)
        product *= e[t][:, None, :]
        product /= product.sum(axis=(1, 2), keepdims=True)
    ahead = np.empty((n_blocks, k))
    behind = np.empty((n_blocks, k))
    x = y = np.full(k, 1.0 / k)
    for b in range(n_blocks):
        ahead[b] = x
        x = x @ product[b]
        x = x / x.sum()
    for b in reversed(range(n_blocks)):
        behind[b] = y
        y = product[b] @ y
        y = y / y.sum()
    forward = np.empty_like(e)
    x = ahead
    for t in range(_BLOCK):
        x = np.where(new[t][:, None], s, x @ a) * e[t]
        x /= x.sum(axis=1, keepdims=True)
        forward[t] = x
    y = behind
    pairs = np.zeros((k, k))
    for t in reversed(range(_BLOCK)):
        z = y * e[t]
        if with_pairs:
            pair = (forward[t - 1] if t else ahead)[:, :, None] * a * z[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            pairs += pair[~new[t]].sum(axis=0)
        forward[t] *= y
        y = np.where(new[t][:, None], z @ s[:, None], z @ a.T)
        y /= y.sum(axis=1, keepdims=True)
    p = forward.swapaxes(0, 1).reshape(-1, k)[:n]
    p = p / p.sum(axis=1, keepdims=True)
    return (p, pairs) if with_pairs else p


def _pieces(texts: list[bytes], labels: np.ndarray, random: np.random.Generator):
    """Words of all texts, and a random order of short pieces of them: code-switched text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    found = words(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    cuts = []
    for i, label in enumerate(labels):
        at, end = int(found.first[i]), int(found.first[i + 1])
        while at < end:
            to = min(end, at + int(random.integers(*PIECE_WORDS)))
            cuts.append((at, to, label))
            at = to
    order = random.permutation(len(cuts))
    at, total = [], 0
    gold = []
    for i in order:
        lo, hi, label = cuts[i]
        at.append(np.arange(lo, hi))
        gold.append(np.full(hi - lo, label))
        total += hi - lo
        if total >= SHARD_WORDS:
            break
    return found, (np.concatenate(at), np.concatenate(gold)) if at else (np.zeros(0, int),) * 2


def _train(texts: list[bytes], labels: np.ndarray, n_labels: int, lexicon: np.ndarray,
           seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights that raise the conditional likelihood of the labels, by stochastic gradients."""
    random = np.random.default_rng(seed)
    found, (order, gold) = _pieces(texts, labels, random)
    w = np.zeros((n_labels, FEATURES + n_labels + 1))
    tr, st = np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    square, tr_square = np.full(w.shape[1], 1e-6), np.full(tr.shape, 1e-6)
    if not len(order):
        return w, tr, st
    trigrams, first, others = _features(found, 0, len(found.hashes), lexicon, n_labels)
    size = np.diff(np.append(first, len(trigrams)))
    step = SEQUENCE_WORDS * 64
    eye = np.eye(n_labels)
    for _ in range(EPOCHS):
        for lo in range(0, len(order), step):
            own, y = order[lo:lo + step], gold[lo:lo + step]
            n_tri = size[own]
            begin = np.cumsum(n_tri) - n_tri
            tri = trigrams[np.repeat(first[own] - begin, n_tri) + np.arange(int(n_tri.sum()))]
            rest = [ids[own] for ids in others]
            opens = np.arange(len(own)) % SEQUENCE_WORDS == 0
            p, expected = marginals(_emissions(w, tri, begin, rest), opens, tr, st, with_pairs=True)
            delta = eye[y] - p
            ids = np.concatenate([tri, *rest])
            wide = np.concatenate([np.repeat(delta, n_tri, axis=0), *[delta] * len(rest)])
            grad = np.stack([np.bincount(ids, wide[:, k], w.shape[1]) for k in range(n_labels)])
            grad /= len(own)
            square += (grad ** 2).sum(axis=0)
            w += 0.3 * grad / np.sqrt(square)
            inner = ~opens[1:]
            seen = eye[y[:-1][inner]].T @ eye[y[1:][inner]]
            grad = (seen - expected) / max(1, inner.sum())
            tr_square += grad ** 2
            tr += 0.3 * grad / np.sqrt(tr_square)
            st += 0.1 * delta[opens].mean(axis=0)
    return w, tr, st


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, shards: int = SHARDS) -> Model:
    """A model of the languages in ``lang``, from ``doc_id, text, lang`` of labelled rows.

    Held-out rows, and rows without language or id, are not learned from. The sample is
    about ``sample_docs`` documents of each language, chosen by a hash of the id, whole
    texts; that bounds what a task and the driver get. Words that the sample has nearly
    always in one language make its lexicon, the ``LEXICON_WORDS`` most frequent of them.
    Each part is trained on pieces of ``SHARD_WORDS`` words, drawn from all of its texts; so
    these two constants bound the fit, not what it is applied to. Each part of the sample is cut into pieces
    that are strung together in random order, so that the chain sees languages change,
    and a task fits the field on it; the model is the mean of the parts.
    """
    labelled = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    labels = sorted(counts)
    if not labels:
        return Model([], np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    share = F.create_map(*(F.lit(x) for name in labels
                           for x in (name, min(1.0, sample_docs / counts[name]))))
    number = F.create_map(*(F.lit(x) for pair in enumerate(labels) for x in reversed(pair)))
    chosen = (labelled.filter(unit_interval(F.col("doc_id"), F.lit(10)) < share[F.col("lang")])
              .select("text", number[F.col("lang")].cast("int").alias("label"),
                      F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(shards)).cast("int").alias("shard")))
    sample = saved(chosen)
    n_labels = len(labels)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy()
            for at, data, bounds in chunks(batch.column("text")):
                found = words(data, bounds)
                own = np.repeat(label[at:at + len(bounds) - 1], np.diff(found.first))
                for k in np.unique(own):
                    h, n = np.unique(found.hashes[own == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(np.full(len(h), k, np.int32)), pa.array(n)],
                        names=["word", "label", "n"])

    seen = (sample.mapInArrow(count_words, "word long, label int, n long")
            .groupBy("word").agg(F.sum("n").alias("n"), *(
                F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"n{k}")
                for k in range(n_labels))))
    most = F.greatest(*(F.col(f"n{k}") for k in range(n_labels)), F.lit(0))
    best = F.array_position(F.array(*(F.col(f"n{k}") for k in range(n_labels))), most)
    entries = (seen.filter((F.col("n") >= LEXICON_COUNT) & (most >= LEXICON_SHARE * F.col("n")))
               .orderBy(F.desc("n"), "word").limit(LEXICON_WORDS).select("word", best.alias("label")).collect())
    lexicon = np.zeros(1 << _SLOTS, np.int16)
    for word, label in entries:
        lexicon[np.uint64(word & (1 << 64) - 1) >> np.uint64(64 - _SLOTS)] = label

    def train(part: pa.Table) -> pa.Table:
        texts = [t or b"" for t in part.column("text").cast(pa.large_binary()).to_pylist()]
        fitted = _train(texts, part.column("label").to_numpy(), n_labels, lexicon,
                        part.column("shard")[0].as_py())
        return pa.table({"model": [x.tobytes() for x in [np.concatenate([y.ravel() for y in fitted])]]})

    parts = [np.frombuffer(r.model) for r in
             sample.groupBy("shard").applyInArrow(train, "model binary").collect()]
    mean = np.mean(parts, axis=0)
    n_weights = n_labels * (FEATURES + n_labels + 1)
    return Model(labels, mean[:n_weights].reshape(n_labels, -1).astype(np.float32),
                 mean[n_weights:n_weights + n_labels ** 2].reshape(n_labels, n_labels),
                 mean[n_weights + n_labels ** 2:], lexicon)


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def predict(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Label index (-1 if undetermined) and mean probability of each text."""
    label, score = np.full(len(texts), -1), np.zeros(len(texts))
    n_labels = len(model.labels)
    if not n_labels:
        return label, score
    letter = IS_WORD & ~((np.arange(256) >= 48) & (np.arange(256) <= 57))
    for at, data, bounds in chunks(texts):
        found = words(data, bounds)
        n_texts = len(bounds) - 1
        sums, weight = np.zeros((n_texts, n_labels)), np.zeros(n_texts)
        text = np.repeat(np.arange(n_texts), np.diff(found.first))
        # A chain begins where its text does, and again after so many words of that text:
        # what stands before or behind a text in its batch does not count.
        opens = (np.arange(len(text)) - found.first[text]) % _PIECE == 0
        begins = np.append(np.flatnonzero(opens), len(text))
        letters = np.concatenate([[0], np.cumsum(letter[found.lower])])
        counted = letters[found.ends] > letters[found.starts]
        hi = 0
        while hi < len(text):  # as many whole chains as fit
            lo = hi
            hi = int(begins[np.searchsorted(begins, lo + _PIECE, "right") - 1])
            p = marginals(_emissions(model.weights, *_features(found, lo, hi, model.lexicon, n_labels)),
                          opens[lo:hi], model.transitions, model.start)
            p[~counted[lo:hi]] = 0.0
            for k in range(n_labels):
                sums[:, k] += np.bincount(text[lo:hi], p[:, k], n_texts)
            weight += np.bincount(text[lo:hi], counted[lo:hi], n_texts)
        ascii_letters = np.concatenate([[0], np.cumsum((found.lower >= 97) & (found.lower <= 122))])
        plain = ascii_letters[bounds[1:]] > ascii_letters[bounds[:-1]]
        for i in np.flatnonzero(weight > 0):
            if plain[i] or _has_letter(data[bounds[i]:bounds[i + 1]].tobytes()):
                label[at + i] = int(np.argmax(sums[i]))
                score[at + i] = min(1.0, sums[i].max() / weight[i])
    return label, score


def identified(docs: DataFrame, model: Model, *keys: str) -> DataFrame:
    """``keys, lang_pred, score`` of every row: the language of the whole text.

    Words are labelled by forward-backward; the language is the one with the largest
    total probability over words with letters, the score its mean. A null text, or one
    without a letter, is ``und`` with score 0, and so is every text if nothing was
    learned. Only the text counts: rows of equal texts agree, ids and other columns are
    not looked at, nor what else is in the batch. Texts longer than 131,072 words are
    labelled in stretches of that length, all of which count. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keys, "text")
    schema = kept.drop("text").schema.add("lang_pred", "string").add("score", "double")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.labels, UNDETERMINED], object)
        for batch in batches:
            label, score = predict(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keys))), pa.array(names[label], pa.string()),
                 pa.array(score)], schema=arrow)

    return kept.mapInArrow(run, schema)


def with_a_language(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text is in one of the learned languages, unchanged.

    Rejected are undetermined texts and those of a smaller score. If no row has a
    language to learn from, nothing can be told and all rows with a letter stay.
    """
    model = fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    letter = F.col("text").rlike(r"\p{L}")
    if not model.labels:
        return docs.filter(letter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, score = predict(batch.column("text"), shared.value)
            yield batch.filter(pa.array((label >= 0) & (score >= least_score)))

    return docs.mapInArrow(run, docs.schema)
