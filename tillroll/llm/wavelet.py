"""Token-id shards as wavelet matrices.

A shard holds the ids of neighbouring documents. Plane k has bit k of every id
(highest first); the next plane's order puts ids with a 0 before ids with a 1 and
keeps their order otherwise. Each plane is a plain bit string with a running count
of ones, so a position or an occurrence moves through the planes by rank and
select, and no plane needs the ids themselves.

File format (little-endian), one shard each, compressed by zstandard:
magic ``TWM1``; u32 planes; u64 ids; u64 documents; per document i64 id, u8
"has an id", u64 end; then per plane u64 zeros and the bits, eight to a byte, lowest
first. The counts of ones are rebuilt at opening.
"""

import struct

import numpy as np
import zstandard

MAGIC = b"TWM1"
BLOCK = 512  # bits per step of the running count


class Plane:
    """One bit string with rank and select."""

    def __init__(self, bits, n):
        self.n, self.bits = n, bits
        words = np.zeros((n // BLOCK + 1) * BLOCK // 8, dtype=np.uint8)
        words[: len(bits)] = bits
        self.words = words.view("<u8")
        ones = np.bitwise_count(self.words).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])
        self.ones = int(self.before[-1])
        self.zeros = n - self.ones

    def get(self, at):
        at = np.asarray(at)
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)

    def rank(self, at):
        """Ones before each position."""
        at = np.asarray(at, dtype=np.int64)
        word = at >> 6
        per = BLOCK // 64
        first = word // per * per
        count = self.before[word // per].copy()
        for k in range(per - 1):
            inside = first + k < word
            count += np.where(inside, np.bitwise_count(self.words[first + k]), 0)
        last = self.words[np.minimum(word, len(self.words) - 1)]
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return count + np.bitwise_count(last & mask)

    def select(self, bit, which):
        """The position of the one (or zero) number ``which``, counted from 0."""
        which = np.asarray(which, dtype=np.int64)
        low, high = np.zeros_like(which), np.full_like(which, self.n)
        while (low < high).any():
            middle = (low + high) // 2
            ones = self.rank(middle + 1)
            enough = (ones if bit else middle + 1 - ones) > which
            high, low = np.where(enough, middle, high), np.where(enough, low, middle + 1)
        return low


class Shard:
    """An opened shard: documents, and ids by position, count and occurrence."""

    def __init__(self, blob):
        raw = zstandard.ZstdDecompressor().decompress(blob)
        if raw[:4] != MAGIC:
            raise ValueError("not a token shard")
        self.depth, self.n, self.n_docs = struct.unpack_from("<IQQ", raw, 4)
        at = 24
        self.doc_ids = np.frombuffer(raw, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self.has_id = np.frombuffer(raw, np.uint8, self.n_docs, at)
        at += self.n_docs
        self.ends = np.frombuffer(raw, "<u8", self.n_docs, at).astype(np.int64)
        at += 8 * self.n_docs
        self._bits, size = [], (self.n + 7) // 8
        for _ in range(self.depth):
            at += 8
            self._bits.append(np.frombuffer(raw, np.uint8, size, at))
            at += size
        self._planes = None

    @property
    def planes(self):
        if self._planes is None:
            self._planes = [Plane(bits, self.n) for bits in self._bits]
        return self._planes

    def access(self, positions):
        """The ids at these positions."""
        at = np.asarray(positions, dtype=np.int64)
        ids = np.zeros(at.shape, dtype=np.uint32)
        for plane in self.planes:
            bit = plane.get(at).astype(bool)
            ids = ids << np.uint32(1) | bit.astype(np.uint32)
            ones = plane.rank(at)
            at = np.where(bit, plane.zeros + ones, at - ones)
        return ids

    def _narrow(self, token, start, end):
        low, high = np.asarray(start), np.asarray(end)
        for k, plane in enumerate(self.planes):
            a, b = plane.rank(low), plane.rank(high)
            if token >> (self.depth - 1 - k) & 1:
                low, high = plane.zeros + a, plane.zeros + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token, start=0, end=None):
        """How often a token stands at positions from ``start`` to before ``end``."""
        if token >> self.depth:
            return 0
        low, high = self._narrow(token, start, self.n if end is None else end)
        return int(high - low)

    def occurrences(self, token):
        """All positions of a token, ascending."""
        if token >> self.depth:
            return np.zeros(0, dtype=np.int64)
        low, high = self._narrow(token, 0, self.n)
        at = np.arange(int(low), int(high))
        for k in reversed(range(self.depth)):
            plane = self.planes[k]
            if token >> (self.depth - 1 - k) & 1:
                at = plane.select(1, at - plane.zeros)
            else:
                at = plane.select(0, at)
        return at

    def decode(self):
        """All ids in order, from the deepest plane up."""
        ids = np.zeros(self.n, dtype=np.uint16 if self.depth <= 16 else np.uint32)
        for k, packed in enumerate(reversed(self._bits)):
            bit = np.unpackbits(packed, count=self.n, bitorder="little").view(bool)
            ones, zeros = np.flatnonzero(bit), np.flatnonzero(~bit)
            ids[len(zeros) :] |= ids.dtype.type(1 << k)
            up = np.empty_like(ids)
            up[zeros], up[ones] = ids[: len(zeros)], ids[len(zeros) :]
            ids = up
        return ids


def build(ids, doc_ids, ends, depth):
    """The file of one shard. ``doc_ids`` may hold None; ``ends`` count ids up to each document."""
    ids = np.asarray(ids)
    parts = [MAGIC, struct.pack("<IQQ", depth, len(ids), len(doc_ids))]
    parts.append(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    parts.append(np.array([d is not None for d in doc_ids], np.uint8).tobytes())
    parts.append(np.asarray(ends, "<u8").tobytes())
    for k in reversed(range(depth)):
        bit = (ids & ids.dtype.type(1 << k)) != 0
        zeros = ids.compress(~bit)
        parts += [struct.pack("<Q", len(zeros)), np.packbits(bit, bitorder="little").tobytes()]
        ids = np.concatenate([zeros, ids.compress(bit)])
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))
