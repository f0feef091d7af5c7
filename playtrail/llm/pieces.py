"""SentencePiece encoding as a weighted finite-state transducer: normaliser, pieces and byte fallback are
compiled once, composed with each text, and the tropical-semiring shortest path gives the pieces."""

import hashlib
import re
import struct
from array import array
from dataclasses import dataclass, field
from itertools import groupby
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Entries of each of a task's caches; twice as many are held at most.
MAX_CACHED = 150_000

# Fixed values of the model format: kinds of pieces, kinds of models, the mark for a space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"
UNKNOWN_PENALTY = 10.0
# What is known of the beginning of a piece.
_UNSEEN, _ONLY_A_BEGINNING, _MADE = 0, 1, 2


def _fields(data: bytes):
    """Numbered values of a protocol-buffer message: whole numbers, floats as their four bytes, nested bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = number()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, number()
        else:
            size = number() if wire == 2 else {1: 8, 5: 4}[wire]
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class Model:
    """What a model file says: pieces with scores and kinds, and how texts are normalised."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    dummy_prefix: bool = True
    trim_spaces: bool = True

    @classmethod
    def parse(cls, data: bytes) -> "Model":
        model = cls()
        for number, value in _fields(data):
            if number == 1:
                piece = {1: b"", 2: bytes(4), 3: NORMAL} | dict(_fields(value))
                model.pieces.append(piece[1].decode())
                model.scores.append(struct.unpack("<f", piece[2])[0])
                model.kinds.append(piece[3])
            elif number == 2:
                trainer = dict(_fields(value))
                model.kind = trainer.get(3, UNIGRAM)
                if trainer.get(24):
                    raise ValueError("models that mark spaces as suffixes are not supported")
            elif number == 3:
                rules = dict(_fields(value))
                model.dummy_prefix, model.trim_spaces = bool(rules.get(3, 1)), bool(rules.get(4, 1))
                if rules.get(2) or not rules.get(5, 1):
                    raise ValueError("models with a character map or unmarked spaces are not supported")
        if model.kind not in (UNIGRAM, BPE) or USER_DEFINED in model.kinds:
            raise ValueError("only unigram and merge models without own symbols are supported")
        return model


class _Remembered(dict):
    """What `make` returns for a key. When it is full it becomes the old half, from which keys that are used again return."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= MAX_CACHED:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class PieceTransducer:
    """Texts to ids and back.

    Composed with a text, the transducer has an arc for every piece that stands at a place, and one for every
    single character, which byte fallback spells. Arc weights are negated scores for unigram models. A merge
    model's result is the only sequence in which merging any two neighbours from their characters gives
    back just these two; its machine remembers the last piece, and a step to the next has weight 0 where
    that holds and is infinite elsewhere. Either way the path of least total weight is the encoding. Every
    beginning of a text has one encoding as well, so with merges a place is reached with one last piece only.
    """

    def __init__(self, model: Model):
        self.model = model
        ids = {}
        for number, (piece, kind) in enumerate(zip(model.pieces, model.kinds, strict=True)):
            if kind in (NORMAL, UNUSED):
                ids.setdefault(piece, number)
        self.ids = ids
        self.unknown = model.kinds.index(UNKNOWN) if UNKNOWN in model.kinds else 0
        self.bytes = {int(p[3:5], 16): n for n, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == BYTE}
        self.longest = max(map(len, ids), default=1)
        self.standing = dict.fromkeys((piece[:k] for piece in ids for k in range(2, len(piece) + 1)), _UNSEEN)
        self.unknown_weight = UNKNOWN_PENALTY - min((model.scores[n] for n in ids.values()), default=0.0)
        # Places that no piece crosses cut a text into parts of their own: before a mark that follows
        # something else, and around characters that only stand alone.
        joined = {mark for piece in ids if len(piece) > 1 for mark in piece}
        crosses = any(re.search(f"[^{MARK}]{MARK}", piece) for piece in ids)
        self.cut_lines = "\n" not in joined and not crosses
        self.parts = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if self.cut_lines else "(?s).+")
        # Two characters in a row that no piece has in a row: a path must part there.
        self.pairs = {piece[k : k + 2] for piece in ids for k in range(len(piece) - 1)}
        self.fits = _Remembered(lambda pair: self.merged(pair[0] + pair[1]) == [*pair])
        # Ids are kept as the bytes of 32-bit numbers, which are joined without a step for each of them.
        self.segments = _Remembered(lambda segment: self._spelled(self.shortest_path(segment)))
        self.led = _Remembered(lambda word: self._part(MARK + word))
        self.shown = [self._shown(piece, kind) for piece, kind in zip(model.pieces, model.kinds, strict=True)]

    def normalise(self, text: str) -> str:
        if self.model.trim_spaces:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)

    def merged(self, text: str) -> list[str]:
        """The characters of a short text, merged by best score and then from the left."""
        ids, scores = self.ids, self.model.scores
        parts = list(text)
        while len(parts) > 1:
            best, place = -inf, -1
            for k in range(len(parts) - 1):
                number = ids.get(parts[k] + parts[k + 1])
                if number is not None and scores[number] > best:
                    best, place = scores[number], k
            if place < 0:
                break
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        return parts

    def shortest_path(self, text: str) -> list[str]:
        """The pieces on the path of least weight through the composition with the text."""
        return self._merge_path(text) if self.model.kind == BPE else self._score_path(text)

    def _merge_path(self, text: str) -> list[str]:
        """Relaxes the arcs of reached places, the furthest end first; all finite sums are 0, so any order is best first.

        An arc is weighed when its turn comes, and never if its end is reached by then. The arcs of a place are those of
        its character and of the pieces that merging makes.
        """
        fits, standing, size = self.fits, self.standing, len(text)
        last: list[str | None] = [None] * (size + 1)
        starts: list[int] = []
        ends: list[int] = []
        place = 0
        while place < size:
            starts.append(place)
            ends.append(place + 1)
            for end in range(place + 2, size + 1):
                kind = standing.get(text[place:end])
                if kind is None:
                    break
                if kind == _UNSEEN:
                    kind = self._stands(text[place:end])
                if kind == _MADE:
                    starts.append(place)
                    ends.append(end)
            while True:
                at, end = starts.pop(), ends.pop()
                if last[end] is None:
                    piece = text[at:end]
                    if not at or fits[last[at], piece]:
                        last[end] = piece
                        place = end
                        break
        path, at = [], size
        while at:
            path.append(last[at])
            at -= len(last[at])
        return path[::-1]

    def _stands(self, beginning: str) -> int:
        """Whether the beginning of a piece is one that merging makes; looked into when it is first met."""
        made = beginning in self.ids and self.merged(beginning) == [beginning]
        found = self.standing[beginning] = _MADE if made else _ONLY_A_BEGINNING
        return found

    def _score_path(self, text: str) -> list[str]:
        ids, scores, size = self.ids, self.model.scores, len(text)
        best: list[tuple[float, int]] = [(0.0, 0)] + [(inf, 0)] * size
        for at in range(size):
            so_far = best[at][0]
            for end in range(at + 1, min(size, at + self.longest) + 1):
                number = ids.get(text[at:end])
                if number is None and end > at + 1:
                    continue
                total = so_far + (self.unknown_weight if number is None else -scores[number])
                if total < best[end][0]:
                    best[end] = (total, at)
        path, at = [], size
        while at:
            path.append(text[best[at][1] : at])
            at = best[at][1]
        return path[::-1]

    def _spelled(self, pieces: list[str]) -> bytes:
        found: list[int] = []
        for piece in pieces:
            number = self.ids.get(piece)
            if number is not None:
                found.append(number)
            elif self.bytes:
                found += (self.bytes[byte] for byte in piece.encode("utf-8", "replace"))
            else:
                found.append(self.unknown)
        return array("i", found).tobytes()

    def _part(self, part: str) -> bytes:
        """The ids of a part, which is cut where no piece crosses; its segments are kept, as words share them."""
        pairs = self.pairs
        cuts = [k for k in range(1, len(part)) if part[k - 1 : k + 1] not in pairs]
        if not cuts:
            return self.segments[part]
        return b"".join([self.segments[part[a:b]] for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True)])

    def encode_packed(self, text: str) -> bytes:
        """The ids as the bytes of 32-bit numbers."""
        if not text:
            return b""
        # Plain texts, the most, have no mark and no two spaces in a row: their words are the parts.
        plain = MARK not in text and "  " not in text and text[0] != " "
        if plain and self.cut_lines and self.bytes and self.model.dummy_prefix and not self.model.trim_spaces:
            found: list[bytes] = []
            led, new_line = self.led, self._part("\n")
            for k, line in enumerate((" " + text).split("\n")):
                if k:
                    found.append(new_line)
                first, *words = line.split(" ")
                if first:
                    found.append(self._part(first))
                found += map(led.__getitem__, words)
            return b"".join(found)
        ids = b"".join(map(self._part, self.parts.findall(self.normalise(text))))
        if self.bytes:
            return ids
        # Unknown characters in a row are one unknown piece.
        numbers = np.frombuffer(ids, np.int32)
        unknown = numbers == self.unknown
        return numbers[~(unknown & np.r_[False, unknown[:-1]])].tobytes()

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), np.int32).tolist()

    def _shown(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == CONTROL else piece.replace(MARK, " ").encode()

    def decode(self, ids: list[int]) -> str:
        joined = b"".join(map(self.shown.__getitem__, ids))
        try:
            text = joined.decode()
        except UnicodeDecodeError:
            text = self._decode_runs(ids)
        first = self.model.pieces[ids[0]] if len(ids) else ""
        return text[1:] if self.model.dummy_prefix and first.startswith(MARK) else text

    def _decode_runs(self, ids: list[int]) -> str:
        """Each run of bytes on its own, where some of them make no character."""
        kinds = self.model.kinds
        runs = groupby(ids, lambda number: kinds[number] == BYTE)
        return "".join(b"".join(map(self.shown.__getitem__, run)).decode("utf-8", "replace") for _, run in runs)


def encode(df: DataFrame, model_path: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, ids, n_ids, decoded_sha256, exact`, one row for each row of `df`; nothing is shuffled.

    `exact` tells whether decoding gives the text back, which fails only for texts with the mark itself or
    spaces that the model trims. Null and empty texts have no ids and decode to the empty text. Repeated
    rows stay repeated, an empty table gives no rows, other columns are ignored. The model is read on the
    driver and broadcast; memory per task is that of the model, two bounded caches and a batch of texts.
    """
    with open(model_path, "rb") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        machine = PieceTransducer(Model.parse(shared.value))
        for batch in batches:
            packed, digests, exact = [], [], []
            for value in batch.column(1):
                given = value.as_py() or ""
                ids = machine.encode_packed(given)
                back = machine.decode(np.frombuffer(ids, np.int32).tolist())
                packed.append(ids)
                digests.append(hashlib.sha256(back.encode("utf-8", "replace")).hexdigest())
                exact.append(back == given)
            sizes = np.array([len(ids) // 4 for ids in packed], np.int32)
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(packed), np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(sizes), pa.array(digests, pa.string()), pa.array(exact, pa.bool_())],
                ["doc_id", "ids", "n_ids", "decoded_sha256", "exact"],
            )

    kind = df.schema[doc_id].dataType.simpleString()
    return df.select(doc_id, text).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, n_ids int, decoded_sha256 string, exact boolean"
    )

