"""Word shingles of whole texts as 64-bit numbers, computed for many texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

from veriframe.llm.decontaminate import _FOLD as FOLD

WORDS = 5
_C = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xBF58476D1CE4E5B9)
_P = 0x2545F4914F6CDD1D | 1
_P_INVERSE = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_cached = {"n": 0, "up": np.empty(0, np.uint64), "down": np.empty(0, np.uint64)}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _cached["n"] < n:
        size = 1 << (n - 1).bit_length()
        _cached.update(n=size, up=_powers(_P, size), down=_powers(_P_INVERSE, size))
    return _cached["up"], _cached["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M
    return h ^ (h >> np.uint64(29))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text's words begin (one more at the end).

    A word's hash is a polynomial of its bytes modulo 2**64, taken from running sums, so no
    word is touched one by one.
    """
    folded = [b"" if t is None else t.encode("utf-8", "surrogatepass").translate(FOLD) for t in texts]
    joined = np.frombuffer(b" " + b" ".join(folded) + b" ", np.uint8)
    begins = np.cumsum([1, *(len(f) + 1 for f in folded)])
    inside = joined != 32
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = change[::2], change[1::2]
    up, down = _tables(len(joined) + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(joined.astype(np.uint64) * up[: len(joined)], dtype=np.uint64)))
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _C)
    return hashes, np.searchsorted(starts, begins)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Per text its distinct shingles of ``words`` words, sorted.

    A text of fewer words, but not none, is one shingle; one without words has none.
    """
    hashes, begins = word_hashes(texts)
    n = len(hashes)
    rolled = np.empty(0, np.uint64)
    if n >= words:
        rolled = hashes[: n - words + 1].copy()
        for k in range(1, words):
            rolled = rolled * _C + hashes[k : n - words + 1 + k]
        rolled = mixed(rolled)
    out = []
    for a, b in zip(begins[:-1], begins[1:]):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            h = np.uint64(b - a)
            for x in hashes[a:b]:
                h = np.uint64((int(h) * int(_C) + int(x)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mixed(np.array([h], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def set_id(shingles: np.ndarray) -> bytes | None:
    """Identity of a set of shingles; None for the empty one."""
    return hashlib.md5(shingles.astype("<u8").tobytes()).digest() if len(shingles) else None
