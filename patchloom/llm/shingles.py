"""Word-shingle sets of whole texts, hashed with numpy.

Words are runs of bytes outside [\\x20\\x09-\\x0D] after lower-casing A-Z. A word's
hash is a polynomial of its bytes modulo 2**64, read off prefix sums over all
texts of a batch; a shingle's hash mixes those of its words. Two different
shingles share a 64-bit hash with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

SIZE = 4
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3, 0xC3A5C85C97CB3127], np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of texts that are hashed together.
CHUNK = 500_000

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and each text's first place
    among them (one more entry at the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    up, down = _power_table(max(1, len(data)))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    hashes = mix((sums[ends] - sums[starts]) * down[np.minimum(starts, len(down) - 1)] + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(starts, bounds)


def shingle_sets(texts: list[bytes | None], words_each: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; none for a wordless text,
    one for the whole sequence of fewer words than a shingle has (8 at most)."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or b"") <= CHUNK):
            size += len(texts[end] or b"")
            end += 1
        words, cuts = word_hashes([t or b"" for t in texts[at:end]])
        n = max(0, len(words) - words_each + 1)
        sums = np.zeros(n, np.uint64)
        for i in range(words_each):
            sums += words[i : i + n] * _PLACE[i]
        all_shingles = mix(sums)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a >= words_each:
                out.append(np.unique(all_shingles[a : b - words_each + 1]))
            elif b > a:
                out.append(mix(np.array([(words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
        at = end
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())
