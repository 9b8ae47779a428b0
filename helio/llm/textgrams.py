"""Numpy views of texts: letter runs, rolling hashes of words and character n-grams."""

from __future__ import annotations

from functools import cache

import numpy as np

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(29))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(32))


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, b in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, b, U64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of codes[start:end], equal for equal spans wherever they stand."""
    power, inverse = _power(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, U64)
    np.cumsum(mix(codes.astype(U64) + U64(0x51ED27)) * power[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))


@cache
def _letters() -> np.ndarray:
    """Lower-case code of each letter, 0 for other characters."""
    return np.array([ord(c.lower()[0]) if (c := chr(i)).isalpha() else 0 for i in range(0x110000)], np.uint32)


class Words:
    """Letter runs of some texts: codes (0 between words), starts, ends, and the text that each word is from."""

    def __init__(self, texts: list[str]):
        joined = "\n" + "\n".join(texts) + "\n\n\n\n\n"
        self.codes = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")]
        edge = np.diff((self.codes > 0).view(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        bounds = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        self.text = np.searchsorted(bounds, self.starts, "right")

    def grams(self, n: int, bits: int) -> np.ndarray:
        """A bucket for each place: of the n characters from there, of which the first and last may be the space around a word. 0: no n-gram."""
        c = self.codes.astype(np.uint32)
        size = len(c) - n + 1
        h = np.zeros(len(c), np.uint32)
        x = np.full(size, n, np.uint32)
        for k in range(n):
            x = (x ^ c[k : k + size]) * np.uint32(0x85EBCA6B)
            x ^= x >> np.uint32(15)
        x = x >> np.uint32(32 - bits)
        inside = c[1 : 1 + size] > 0 if n > 2 else (c[:size] > 0) | (c[1 : 1 + size] > 0)
        for k in range(2, n - 1):
            inside &= c[k : k + size] > 0
        h[:size] = np.where(inside, np.maximum(x, 1), 0)
        return h

    def hashes(self, block: int = 100_000) -> np.ndarray:
        """A hash of each word, some words at a time."""
        out = np.zeros(len(self.starts), U64)
        for lo in range(0, len(out), block):
            s, e = self.starts[lo : lo + block], self.ends[lo : lo + block]
            out[lo : lo + block] = span_hashes(self.codes[s[0] : e[-1]], s - s[0], e - s[0])
        return out


def _gaps(text: str) -> np.ndarray:
    return np.flatnonzero(_letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")] == 0)


def _cut_place(text: str, most: int) -> int:
    """Where to cut a text of over ``most`` characters: at the last one before that is no letter, else at the next one, else nowhere (its length)."""
    gaps = _gaps(text[1:most])
    if len(gaps):
        return 1 + int(gaps[-1])
    for lo in range(most, len(text), most):
        gaps = _gaps(text[lo : lo + most])
        if len(gaps):
            return lo + int(gaps[0])
    return len(text)


def pieces(texts: list[str], most: int = 1 << 20):
    """(run, more): (index, text) pairs in runs of about ``most`` characters. Longer texts make runs of their own.

    These are cut where there is no letter, so words and their n-grams are as in the whole text; ``more`` says that
    the same text goes on in the next run.
    """
    run, size = [], 0
    for i, t in enumerate(texts):
        t = t or ""
        if len(t) > most:
            if run:
                yield run, False
            while len(t) > most:
                at = _cut_place(t, most)
                yield [(i, t[:at])], at < len(t)
                t = t[at:]
            if t:
                yield [(i, t)], False
            run, size = [], 0
            continue
        run.append((i, t))
        size += len(t)
        if size >= most:
            yield run, False
            run, size = [], 0
    if run:
        yield run, False
