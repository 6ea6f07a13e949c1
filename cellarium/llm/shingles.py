"""Words and five-word shingles of many texts at once as 64-bit hashes, in numpy, for code inside tasks.

Texts are lower-cased in A-Z only and split at ASCII white space: on UTF-8 bytes ``lower`` does exactly the
first. A word's hash adds a random number for every (position, byte); a shingle's hash mixes its words'
hashes. Two different shingles of one pair of documents (10^5 shingles) are equal with a chance under 10^-9.
"""

from __future__ import annotations

import numpy as np

SIZE = 5
#: Bytes of text that are hashed at once, cut at white space.
STRIP = 1 << 21
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)
_PLACES = 64
_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _ODD[4]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


_RANDOM = mixed(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * _ODD[0])


def _strip(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of raw, and the byte at which each starts."""
    data = np.frombuffer(raw, np.uint8)
    solid = np.flatnonzero(~_GAP[data])
    if not len(solid):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.concatenate([[True], np.diff(solid) > 1])
    heads = np.flatnonzero(first)
    place = solid - np.repeat(solid[heads], np.diff(np.append(heads, len(solid))))
    value = _RANDOM[((place & (_PLACES - 1)) << 8) | data[solid]]
    if (far := place >= _PLACES).any():
        value[far] *= (2 * (place[far] // _PLACES) + 1).astype(np.uint64)
    return mixed(np.add.reduceat(value, heads)), solid[heads]


def _strips(raw: bytes):
    """(offset, strip): raw in pieces that end at white space."""
    at = 0
    while at < len(raw):
        end = at + STRIP
        if end < len(raw):
            cut = max(raw.rfind(g, at, end) for g in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut <= at:  # a word longer than a strip
                ends = [c for c in (raw.find(g, end) for g in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if c >= 0]
                cut = min(ends) if ends else len(raw)
            end = cut
        yield at, raw[at:end]
        at = max(end, at + 1)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text begins among them (one more edge at the end)."""
    raws = [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]
    begin = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])])
    found = [(h, s + at) for at, strip in _strips(b" ".join(raws)) for h, s in [_strip(strip)]]
    h = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.uint64)
    start = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
    return h, np.searchsorted(start, begin)


def grams(h: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence where it is shorter; none without words."""
    if not len(h):
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        out = (out + h[j : j + n]) * _ODD[j]
        out ^= out >> np.uint64(31)
    return mixed(out)


def shingles(texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Word hashes and shingle hashes (in order, repeats kept) of every text."""
    h, edge = word_hashes(texts)
    all_ = grams(h) if len(h) >= SIZE else np.zeros(0, np.uint64)
    ws = [h[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
    return ws, [all_[a : b - SIZE + 1] if b - a >= SIZE else grams(h[a:b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
