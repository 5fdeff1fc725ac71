"""Encoding texts as the pieces of a merge-type (BPE) SentencePiece model, and back.

A text is cut wherever no piece of the vocabulary holds the two bytes beside the cut: no
merge crosses such a place, so the stretches between cuts are encoded on their own, each
distinct one of a batch once. A stretch is encoded without merging it: longest matches
from an Aho-Corasick automaton are chained, and a match may follow another only if merging
the characters of the two gives exactly these two pieces. The merges of a text give the
only chain in which every neighbouring pair passes that test, so where a chain cannot go on,
its last place is no border of pieces in any chain: it is marked in a bitfield, the last
piece is taken back and its next shorter prefix tried.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from pairpulse.llm.text import chunks

SPACE = "▁"
#: Stretches and pairs of pieces that a worker remembers before it forgets them all. They save work only.
REMEMBERED = 1 << 19
#: Longer stretches are not remembered.
REMEMBERED_BYTES = 64
#: Characters of a long stretch that are matched at a time.
WINDOW = 4096
#: Bytes of text that are encoded at a time; a single longer text is encoded alone.
CHUNK_TEXT = 1 << 22
#: Tokens that are decoded at a time; a single longer list is decoded alone.
CHUNK_TOKENS = 1 << 19


class Vocabulary:
    """The pieces of a model file: ``texts`` and ``scores`` by id, and what the ids are."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        self.texts = [model.id_to_piece(i) for i in ids]
        self.scores = [model.get_score(i) for i in ids]
        self.is_byte = [model.is_byte(i) for i in ids]
        self.is_silent = [model.is_control(i) for i in ids]
        self.unknown, self.end = model.unk_id(), model.eos_id()
        self.prefixed = model.encode("ab", out_type=str)[0].startswith(SPACE)
        self.name = hashlib.sha256(repr((self.texts, self.scores, self.prefixed)).encode()).hexdigest()
        coder = Coder(self)
        for probe in _PROBES:
            if list(coder.ids((" " if self.prefixed else "") + probe)) != model.encode(probe):
                raise ValueError(f"{path}: not a merge-type model that leaves texts as they are")

    @property
    def coder(self) -> Coder:
        """The coder of this vocabulary in this process.

        Python workers are used again, but the package is sent to them by value, so its own
        globals last for one task only; a module of their own keeps the coder.
        """
        kept = sys.modules.setdefault("_pairpulse_coder", ModuleType("_pairpulse_coder"))
        if getattr(kept, "name", None) != self.name:
            kept.name, kept.coder = self.name, Coder(self)
        return kept.coder


#: Texts on which a model is compared with the library before it is used.
_PROBES = ["ab", " a  b ", "a\n\nb\tc", "ﬁ Å é​", "the  cat▁sat, on 1,000 mats!", "\U0001f9ff\x00"]


class Coder:
    """The tables that encoding needs, and what has been encoded so far."""

    def __init__(self, vocabulary: Vocabulary):
        special = {vocabulary.unknown}
        special |= {i for i, x in enumerate(vocabulary.is_byte) if x}
        special |= {i for i, x in enumerate(vocabulary.is_silent) if x}
        self.id_of = {t.replace(SPACE, " "): i for i, t in enumerate(vocabulary.texts) if i not in special}
        self.score = {t: vocabulary.scores[i] for t, i in self.id_of.items()}
        self.byte_ids = [i for i, x in enumerate(vocabulary.is_byte) if x]
        self.unknown = vocabulary.unknown
        self.longest = max(map(len, self.id_of))
        self.matches = ahocorasick.Automaton()
        for text in self.id_of:
            self.matches.add_word(text[::-1], text)
        self.matches.make_automaton()
        inner = np.zeros(1 << 16, bool)
        for text in self.id_of:
            data = np.frombuffer(text.encode(), np.uint8).astype(np.uint16)
            inner[data[:-1] << np.uint16(8) | data[1:]] = True
        lead = (np.arange(1 << 16) & 0xC0) != 0x80
        #: By the bytes before and after it: whether a place is a cut.
        self.is_cut = ~inner & lead
        self.pairs: dict[tuple[str, str], bool] = {}
        self.units: dict[bytes, tuple[int, ...]] = {}

    def _starting(self, unit: str, at: int) -> list[list[str]]:
        """For each character of a window, the pieces that start there, longest first."""
        part = unit[at:at + WINDOW + self.longest]
        found = [[] for _ in part]
        for end, piece in self.matches.iter(part[::-1]):
            found[len(part) - 1 - end].append(piece)
        return [x or [part[i]] for i, x in enumerate(found[:WINDOW])]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the characters of two pieces gives these two pieces."""
        if left not in self.score or right not in self.score:
            return True  # a character without a piece takes part in no merge
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[left, right] = self._remerged(left, right)
        return known

    def _remerged(self, left: str, right: str) -> bool:
        parts, border = [*left, *right], len(left)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return len(parts) == 2
            if at == border - 1:
                return False
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            border -= at < border

    def pieces(self, unit: str) -> list[str]:
        """The chain of compatible pieces; a character without a piece stands for itself."""
        size, at, tried = len(unit), 0, 0
        failed = bytearray(size // 8 + 1)
        found, choices, windows = [], [], {}
        while at < size:
            window = at // WINDOW
            if window not in windows:
                if len(windows) > 2:
                    windows.clear()
                windows[window] = self._starting(unit, window * WINDOW)
            options = windows[window][at % WINDOW]
            while tried < len(options):
                end = at + len(options[tried])
                if not failed[end >> 3] >> (end & 7) & 1 and (
                        not found or self.compatible(found[-1], options[tried])):
                    break
                tried += 1
            if tried < len(options):
                found.append(options[tried])
                choices.append(tried)
                at, tried = end, 0
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(found.pop())
                tried = choices.pop() + 1
        return found

    def ids(self, unit: str) -> tuple[int, ...]:
        out = []
        for piece in self.pieces(unit.replace(SPACE, " ")):
            known = self.id_of.get(piece)
            if known is not None:
                out.append(known)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in piece.encode("utf-8", "replace"))
            else:
                out.append(self.unknown)
        return tuple(out)

    def unit(self, data: bytes) -> tuple[int, ...]:
        known = self.units.get(data)
        if known is None:
            known = self.ids(data.decode("utf-8", "replace"))
            if len(data) <= REMEMBERED_BYTES:
                if len(self.units) >= REMEMBERED:
                    self.units.clear()
                self.units[data] = known
        return known


def _flat(lists: list[tuple[int, ...]], of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values, ends`` of the lists numbered by ``of``, strung together."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    values = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    taken = sizes[of]
    ends = np.cumsum(taken)
    return values[np.repeat(first[of] - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0)], ends


def _encode_chunk(vocabulary: Vocabulary, data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Lists of ids, each with the end id last, of the texts ``data[bounds[i]:bounds[i + 1]]``."""
    coder, n = vocabulary.coder, len(bounds) - 1
    filled = np.flatnonzero(np.diff(bounds))
    if vocabulary.prefixed:
        data = np.insert(data, bounds[filled], 32)
        added = np.zeros(n + 1, np.int64)
        added[filled + 1] = 1
        bounds = bounds + np.cumsum(added)
    cut = np.zeros(len(data), bool)
    cut[1:] = coder.is_cut[data[:-1].astype(np.uint16) << np.uint16(8) | data[1:]]
    cut[bounds[:-1][filled]] = True
    starts = np.flatnonzero(cut)
    units = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)),
        pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    ids = [coder.unit(u) for u in units.dictionary.to_pylist()]
    values, ends = _flat(ids, units.indices.to_numpy())
    ends = np.concatenate([[0], ends])[np.searchsorted(starts, bounds)]
    values = np.insert(values, ends[1:], vocabulary.end)
    return pa.ListArray.from_arrays(pa.array((ends + np.arange(n + 1)).astype(np.int32)),
                                    pa.array(values, pa.int32()))


class Decoder:
    """Bytes of every id, and which of them are single bytes."""

    def __init__(self, vocabulary: Vocabulary):
        out = []
        for i, text in enumerate(vocabulary.texts):
            if vocabulary.is_byte[i]:
                out.append(bytes([int(text[1:-1], 16)]))
            elif vocabulary.is_silent[i]:
                out.append(b"")
            else:
                out.append((" ⁇ " if i == vocabulary.unknown else text.replace(SPACE, " ")).encode())
        self.pieces = pa.array(out, pa.large_binary())
        self.is_byte = np.array(vocabulary.is_byte)
        self.spaced = np.array([vocabulary.prefixed and t.startswith(SPACE) for t in vocabulary.texts])
        self.is_silent = np.array(vocabulary.is_silent)

    def text(self, ids: np.ndarray) -> bytes:
        """The text of one list of ids."""
        said = ids[~self.is_silent[ids]]
        data = b"".join(self.pieces.take(pa.array(said)).to_pylist())
        if self.is_byte[said].any():
            data = self._with_replacements(ids)
        return data[1:] if len(said) and self.spaced[said[0]] else data

    def _with_replacements(self, ids: np.ndarray) -> bytes:
        """Runs of single bytes that are no UTF-8 give one U+FFFD for each byte outside a character."""
        out, run = [], bytearray()

        def flush():
            rest = bytes(run)
            while rest:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(rest[:size].decode().encode())
                        rest = rest[size:]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�".encode())
                    rest = rest[1:]
            run.clear()

        for i, piece in zip(ids.tolist(), self.pieces.take(pa.array(ids)).to_pylist()):
            if self.is_byte[i]:
                run.extend(piece)
            else:  # a silent id ends a run as well
                flush()
                out.append(piece)
        flush()
        return b"".join(out)

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts of the lists ``ids[bounds[i]:bounds[i + 1]]``."""
        taken = self.pieces.take(pa.array(ids))
        _, offsets, data = taken.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(ids) + 1)
        data = data.to_pybytes() if data is not None else b""
        single = np.concatenate([[0], np.cumsum(self.is_byte[ids])])
        silent = np.concatenate([[0], np.cumsum(self.is_silent[ids])])
        out = []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if hi == lo or silent[hi - 1] > silent[lo]:
                out.append(self.text(ids[lo:hi]))
                continue
            text = data[offsets[lo]:offsets[hi]]
            if single[hi] > single[lo]:
                try:
                    text.decode()
                except UnicodeDecodeError:
                    out.append(self.text(ids[lo:hi]))
                    continue
            out.append(text[1:] if self.spaced[ids[lo]] else text)
        return pa.array(out, pa.binary()).cast(pa.string(), safe=False)


def encoded(docs: DataFrame, vocabulary: Vocabulary, *keys: str, round_trip: bool = False) -> DataFrame:
    """``ids`` (array of int, the end id last) of each ``text``, with the key columns.

    Exactly the ids of the library the model comes from: a space is put before a text that
    is not empty if the model says so, the space and U+2581 are one character, and a
    character without a piece becomes its UTF-8 bytes. A null or empty text has the end id
    only. Bytes that are no UTF-8 count as U+FFFD. With ``round_trip`` there is a column
    ``decoded`` too, the text that ``decoded()`` makes of the ids. Rows stay as they are,
    repeated ones and those without keys too; columns that are neither keys nor ``text``
    are ignored. An empty table gives no rows. Nothing is shuffled; what a task holds is a
    chunk of texts.
    """
    kept = docs.select(*keys, "text")
    schema = kept.drop("text").schema.add("ids", ArrayType(IntegerType()))
    if round_trip:
        schema = schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for batch in batches:
            texts = pc.replace_substring(batch.column("text").cast(pa.large_binary()), SPACE.encode(), b" ")
            for at, data, bounds in chunks(texts, CHUNK_TEXT):
                ids = _encode_chunk(vocabulary, data, bounds)
                columns = [batch.column(i).slice(at, len(ids)) for i in range(len(keys))] + [ids]
                if round_trip:
                    columns.append(decoder.texts(ids.values.to_numpy(), ids.offsets.to_numpy()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(run, schema)


def decoded(rows: DataFrame, vocabulary: Vocabulary, *keys: str) -> DataFrame:
    """``decoded``, the text of each list ``ids``, with the key columns.

    Control ids are silent, the space before the first piece goes if the model puts one
    there, runs of byte ids are read as UTF-8, and bytes outside a character become U+FFFD.
    A null or empty list, or one of control ids only, gives an empty text; a null id is
    skipped; an id outside the vocabulary fails the task. Rows stay as they are; other
    columns are ignored.
    """
    kept = rows.select(*keys, "ids")
    schema = kept.drop("ids").schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for batch in batches:
            lists = batch.column("ids")
            parents, values = pc.list_parent_indices(lists), lists.flatten()
            if values.null_count:
                parents, values = parents.filter(values.is_valid()), values.drop_null()
            bounds = np.searchsorted(parents.to_numpy(), np.arange(len(lists) + 1))
            at = 0
            while at < len(lists):
                to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK_TOKENS, "right")) - 1)
                ids = values.slice(bounds[at], bounds[to] - bounds[at]).to_numpy()
                texts = decoder.texts(ids, bounds[at:to + 1] - bounds[at])
                columns = [batch.column(i).slice(at, to - at) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*columns, texts], names=[*keys, "decoded"])
                at = to

    return kept.mapInArrow(run, schema)


def token_digests(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of the text they give."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded(docs, vocabulary, key, round_trip=True).select(
        key, F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
