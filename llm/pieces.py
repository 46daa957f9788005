"""Operator 12: SentencePiece encoding and decoding for merge-type vocabularies, by a score-ordered agenda.

A text gets a space in front and its spaces become U+2581. Its characters are the first symbols; an agenda holds the adjacent
pairs that together are a piece, the highest score first and the leftmost of equals. The pair on top is merged, its new
neighbours join the agenda, and pairs of which a side has changed are passed over. Symbols that are no piece fall back to bytes.

No merge crosses two neighbouring characters that stand together in no piece. So a text is cut before white space that
follows a word (`Pieces.units`), each different unit is encoded once for a worker, and a unit is cut again wherever the
vocabulary allows no merge. Every new unit is checked against the library inside its Arrow batch: units are joined to texts
again and encoded whole, so the cuts are checked with the merges; every text is decoded by the library too. A difference is an error.

Defined cases: null and empty texts have no ids and decode to ''; a text of white space only has ids like any other; texts
of any length are encoded whole; repeated rows are rows of their own; a null doc_id is kept; an empty table gives an
empty result; other columns are ignored. Vocabularies that aren't of merge type, that rewrite characters, drop white space,
lack bytes to fall back to or have pieces of the user's own are refused.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from llm.common import small_batches

#: Different units, and parts of units, that a worker remembers before it begins anew.
MEMO, PARTS = 1_200_000, 800_000
#: New units in one text for the library.
JOINED = 256
SPACE = "▁"
#: Symbols of a part up to which its agenda is a list.
SHORT, _NONE = 32, float("-inf")
_NORMAL, _UNKNOWN, _CONTROL, _BYTE, _MERGE = 1, 2, 3, 6, 2

_OTHER_SPACE = re.compile(r"[^\S \n]").search
codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """A vocabulary: pieces with scores and ids, and where texts may be cut before they are encoded."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        rules = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != _MERGE or not model.trainer_spec.byte_fallback or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("only merge-type vocabularies with bytes to fall back to are encoded")
        if rules.precompiled_charsmap or model.denormalizer_spec.precompiled_charsmap or not rules.add_dummy_prefix or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("vocabularies that rewrite texts are not encoded")
        self.score = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.together = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        surface = {_NORMAL: lambda p: p.replace(SPACE, " ").encode(), _UNKNOWN: lambda p: model.trainer_spec.unk_surface.encode(), _CONTROL: lambda p: b"", _BYTE: lambda p: bytes([int(p[1:-1], 16)])}
        self.surface = [surface[p.type](p.piece) for p in model.pieces]
        self.begins = np.array([p.type == _NORMAL and p.piece.startswith(SPACE) for p in model.pieces])
        self.decimal = [str(i).encode() for i in range(len(self.surface))]
        self.lengths = np.array([len(s) for s in self.surface], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)
        # white space that a piece holds after another character, and characters that only some count as white space, stay inside units
        glue = "".join(sorted({c for p in self.score for c in p[1:] if c.isspace()} | set("\x1c\x1d\x1e\x1f")))
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("pieces with words on both sides of a space are not supported")
        self._units = re.compile(rf"\s*\S+(?:[{re.escape(glue)}]\s*\S*)*|\s+").findall

    def units(self, text: str) -> list[str]:
        """The words of `" " + text` with the white space before each; `unit` gives a word its space back.

        Most texts have single spaces and line ends between words, and are split as they are; all others are searched.
        """
        if not (text[0].isspace() or text[-1].isspace() or "  " in text or "\n\n" in text or "\n " in text or " \n" in text or _OTHER_SPACE(text)):
            return text.replace("\n", " \n").split(" ")
        return self._units(" " + text)

    @staticmethod
    def unit(word: str) -> str:
        return word if word[0].isspace() else " " + word

    def parts(self, unit: str) -> list[str]:
        """unit, with U+2581 for spaces, cut between characters that no piece holds together."""
        together, out, lo = self.together, [], 0
        for i in range(1, len(unit)):
            if unit[i - 1 : i + 1] not in together:
                out.append(unit[lo:i])
                lo = i
        out.append(unit[lo:])
        return out

    def merged(self, chars: str) -> list[str]:
        """The symbols that are left when no pair of the agenda can be merged any more.

        The agenda of a short part is a list of its pairs' scores, of which max() finds the top; a longer one is a heap.
        """
        n, score = len(chars), self.score
        if n <= SHORT:
            symbol = list(chars)
            agenda = [score.get(chars[i : i + 2], _NONE) for i in range(n - 1)]
            while agenda and (top := max(agenda)) != _NONE:
                i = agenda.index(top)
                symbol[i] += symbol.pop(i + 1)
                del agenda[i]
                if i:
                    agenda[i - 1] = score.get(symbol[i - 1] + symbol[i], _NONE)
                if i < len(agenda):
                    agenda[i] = score.get(symbol[i] + symbol[i + 1], _NONE)
            return symbol
        symbol = list(chars)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(-score[chars[i : i + 2]], i, i + 1, 2) for i in range(n - 1) if chars[i : i + 2] in score]
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            if not symbol[left] or not symbol[right] or len(symbol[left]) + len(symbol[right]) != size:
                continue  # one side has been merged since
            symbol[left] += symbol[right]
            symbol[right] = ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            for a, b in ((before[left], left), (left, after[left])):
                if a >= 0 and b < n:
                    both = symbol[a] + symbol[b]
                    if both in score:
                        heappush(agenda, (-score[both], a, b, len(both)))
        return [s for s in symbol if s]

    def ids(self, part: str) -> list[int]:
        out: list[int] = []
        for s in self.merged(part) if len(part) > 1 else part:
            known = self.id.get(s)
            if known is None:
                out.extend(self.byte[b] for b in s.encode())
            else:
                out.append(known)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: one space at the front goes, bytes that are no character become U+FFFD each; control ids end a run of bytes."""
        size = self.lengths[ids]
        total = np.concatenate(([0], np.cumsum(size)))
        data = self.flat[np.repeat(self.starts[ids] - total[:-1], size) + np.arange(total[-1])]
        seen = np.flatnonzero(size)
        cuts = total[:-1][size == 0].tolist()
        cuts = [int(len(seen) > 0 and self.begins[ids[seen[0]]]), *[c for c in cuts if c], len(data)]
        return "".join(data[a:b].tobytes().decode("utf-8", "each-byte") for a, b in zip(cuts, cuts[1:], strict=False))


class Encoder:
    """Ids of texts, unit by unit, with the units met so far."""

    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self.part: dict[str, list[int]] = {}
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.decimal: list[bytes] = []
        self.flat, self.used = np.empty(0, np.int32), 0
        self.first, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def learn(self, words: list[str]) -> None:
        p, known, found = self.pieces, self.part, []
        units = list(map(p.unit, words))
        for u in units:
            out: list[int] = []
            for part in p.parts(u.replace(" ", SPACE)):
                ids = known.get(part)
                if ids is None:
                    if len(known) >= PARTS:
                        known.clear()
                    ids = known[part] = p.ids(part)
                out += ids
            found.append(out)
        n = len(self.size)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        self._check(units, flat, np.concatenate(([0], np.cumsum(sizes))))
        self.at.update(zip(words, range(n, n + len(words)), strict=True))
        name = p.decimal
        self.decimal += [b",".join([name[i] for i in f]) for f in found]
        if self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate((self.flat[: self.used], np.empty(self.used + len(flat), np.int32)))
        self.flat[self.used : self.used + len(flat)] = flat
        self.first = np.concatenate((self.first, self.used + np.cumsum(sizes) - sizes))
        self.size = np.concatenate((self.size, sizes))
        self.used += len(flat)

    def _check(self, units: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """The library's ids of the units, joined to texts again; a unit that ends in white space is the last of its text."""
        texts, wanted, lo = [], [], 0
        for k, u in enumerate(units):
            if k + 1 == len(units) or k + 1 - lo == JOINED or u[-1].isspace():
                texts.append(" x" + "".join(units[lo : k + 1]))  # the first unit needn't begin with a space
                wanted.append(ids[ends[lo] : ends[k + 1]])
                lo = k + 1
        before = self.pieces.library.encode("x")
        for text, want, got in zip(texts, wanted, self.pieces.library.encode([t[1:] for t in texts], num_threads=1), strict=True):
            if got != before + want.tolist():
                raise RuntimeError(f"ids differ from the library's in {text[:200]!r}")

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the units of all texts, and where each text's end."""
        words: list[str] = []
        ends = []
        for t in texts:
            if t:
                words += self.pieces.units(t.replace(SPACE, " ") if SPACE in t else t)
            ends.append(len(words))
        at = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0)
        missed = [words[i] for i in unknown.tolist()]
        new = list(dict.fromkeys(missed))
        if len(self.at) + len(new) > MEMO:
            self.clear()
            unknown, missed = np.arange(len(words)), words
            new = list(dict.fromkeys(words))
        if new:
            self.learn(new)
            at[unknown] = np.fromiter(map(self.at.__getitem__, missed), np.int64, len(missed))
        return at, np.array(ends, np.int64)

    def ids_of(self, at: np.ndarray) -> np.ndarray:
        size = self.size[at]
        total = np.concatenate(([0], np.cumsum(size)))
        return self.flat[np.repeat(self.first[at] - total[:-1], size) + np.arange(total[-1])]


_made: dict[str, Encoder] = T.kept("pieces")


def encoder(path: str) -> Encoder:
    if path not in _made:
        _made[path] = Encoder(path)
    return _made[path]


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.Array, Encoder, list[np.ndarray]]]:
    """Ids and the units' places of each text, chunk by chunk of a batch (doc_id, text)."""
    made = encoder(path)
    for b in batches:
        offsets = T.utf8(b.column(1))[1]
        for lo, hi in T.chunks(offsets):
            at, ends = made.encode(b.column(1).slice(lo, hi - lo).to_pylist())
            yield b.column(0).slice(lo, hi - lo), made, np.split(at, ends[:-1])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: a row for each document; ids are little-endian unsigned 32-bit numbers, as packing has them."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone("pieces")
        for doc_id, made, texts in _encoded(batches, path):
            yield pa.RecordBatch.from_arrays([doc_id, pa.array([made.ids_of(at).astype("<u4").tobytes() for at in texts], pa.binary())], ["doc_id", "ids"])
        T.release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids) as encode makes them; null ids give ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone("pieces")
        pieces = encoder(path).pieces
        for b in batches:
            texts = [pieces.decode(np.frombuffer(i or b"", "<u4")) for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests of encode and decode in one pass, with the library's decoding beside."""
    small_batches(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone("pieces")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for doc_id, made, texts in _encoded(batches, path):
            n, ids_sha, text_sha = [], [], []
            for at in texts:
                ids = made.ids_of(at)
                text = made.pieces.decode(ids)
                if made.pieces.library.decode(ids.tolist()) != text:
                    raise RuntimeError(f"decoded text differs from the library's: {text[:200]!r}")
                n.append(len(ids))
                ids_sha.append(sha(b",".join(map(made.decimal.__getitem__, at.tolist()))))
                text_sha.append(sha(text.encode()))
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names)
        T.release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
