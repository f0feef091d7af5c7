"""Words of many texts at once, as hashes: numpy over the bytes that Arrow holds, no string per word."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text that one step works on; a longer text is a step of its own. A step needs about 60 times as much.
STEP_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[32, *range(9, 14)]] = True
OTHER_THAN_LETTERS = np.ones(256, bool)
OTHER_THAN_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < size:
        grown = 1 << (size - 1).bit_length()
        _powers = _geometric(_BASE, grown)
        _inverse = _geometric(pow(_BASE, -1, 1 << 64), grown)
    return _powers, _inverse


def _geometric(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def latin_lower(data: np.ndarray) -> np.ndarray:
    """A-Z and the accented capitals of Latin-1, which UTF-8 writes as C3 and one more byte."""
    out = _LOWER[data]
    second = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[1:][second] += 32
    return out


def byte_values(seed: int) -> np.ndarray:
    """A 64-bit number for each byte."""
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """The same 64-bit numbers, scattered (the finaliser of SplitMix64, whose constants are fixed values)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Rolling:
    """Rabin-Karp sums over a sequence of 64-bit numbers: the hash of any stretch in two look-ups."""

    def __init__(self, values: np.ndarray):
        self.powers, self.inverse = _power_tables(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of the texts `first` to `first + len(bounds) - 1` of a batch: text t has words bounds[t] to bounds[t + 1]."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    offsets: np.ndarray  # where each text begins in `data`, and its end

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def rolling(self, values: np.ndarray) -> Rolling:
        return Rolling(values[self.data])

    def hashes(self, values: np.ndarray) -> np.ndarray:
        return self.rolling(values)(self.starts, self.ends)

    def owners(self) -> np.ndarray:
        """For each word the text it is of, from 0 in this step."""
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))

    def text(self, t: int, keep: np.ndarray | None = None) -> bytes:
        """The words of a text, joined by one space; `keep` selects some of them."""
        at = np.arange(self.bounds[t], self.bounds[t + 1])
        at = at if keep is None else at[keep]
        data = self.data.tobytes() if len(self) == 1 else self._bytes()
        return b" ".join([data[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)])

    def _bytes(self) -> bytes:
        if not hasattr(self, "_kept"):
            self._kept = self.data.tobytes()
        return self._kept


def plain(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, null as empty, and where each text begins and ends."""
    if texts.null_count:
        texts = pa.array([text.as_py() or "" for text in texts], pa.string())
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets.astype(np.int64)


def steps(texts: pa.Array, gap: np.ndarray = SPACE_BYTES, lower=None, step_bytes: int = STEP_BYTES) -> Iterator[Words]:
    """The words of a batch of texts, step by step; `gap` tells which bytes part words, `lower` maps bytes first."""
    if not len(texts):
        return
    everything, offsets = plain(texts)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + step_bytes, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        begin, end = offsets[first], offsets[last]
        data = everything[begin:end]
        if lower is not None:
            data = lower(data)
        own = offsets[first : last + 1] - begin
        word = np.zeros(len(data) + 2, bool)
        word[1:-1] = ~gap[data]
        fresh = np.zeros(len(data) + 1, bool)  # a text begins here
        fresh[own] = True
        starts = np.flatnonzero(word[1:] & (~word[:-1] | fresh))
        ends = np.flatnonzero(word[:-1] & (~word[1:] | fresh))
        yield Words(first, data, starts, ends, np.searchsorted(starts, own), own)
        first = last
