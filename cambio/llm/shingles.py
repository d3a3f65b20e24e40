"""Word shingles of texts, as sorted arrays of 64-bit hashes, and universal hash minima over them."""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
_BASE = np.uint64(0x100000001B3)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _ODD
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word of lower-cased UTF-8; words are runs without ASCII white space."""
    data = np.frombuffer(raw, dtype=np.uint8)
    at = np.flatnonzero(~_SPACE[data])
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    first = np.flatnonzero(np.r_[True, np.diff(at) > 1])
    lengths = np.diff(np.r_[first, len(at)])
    place = np.arange(len(at)) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), _BASE))
        values = (data[at].astype(np.uint64) + np.uint64(1)) * powers[place]
        return at[first], mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; of a text with fewer words, its whole sequence as one."""
    raw = [text.encode().lower() for text in texts]  # lower() of bytes changes A-Z only
    starts, words = word_hashes(b" ".join(raw))
    ends = np.cumsum([len(r) + 1 for r in raw])
    bounds = np.r_[0, np.searchsorted(starts, ends, side="left")]
    with np.errstate(over="ignore"):
        weights = np.cumprod(np.full(SHINGLE_WORDS, _ODD))
        rolled = sum(
            (words[k : len(words) - SHINGLE_WORDS + 1 + k] * weights[k] for k in range(SHINGLE_WORDS)), np.uint64(0)
        )
        rolled = mixed(rolled) if len(words) >= SHINGLE_WORDS else np.empty(0, np.uint64)
        out = []
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            n = end - begin
            if n == 0:
                out.append(np.empty(0, np.uint64))
            elif n < SHINGLE_WORDS:
                out.append(mixed(np.array([(words[begin:end] * weights[:n]).sum() + np.uint64(n)], np.uint64)))
            else:
                found = np.sort(rolled[begin : end - SHINGLE_WORDS + 1])
                out.append(found[np.r_[True, found[1:] != found[:-1]]])
    return out


def hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of ``count`` universal hash functions x -> a * x + b modulo 2 ** 32."""
    rng = np.random.default_rng(20240101)
    draw = rng.integers(0, 1 << 32, size=(2, count), dtype=np.uint64).astype(np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def minima(sets: list[np.ndarray], functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """len(sets) x functions: the smallest hash of every set under every function; the sets must not be empty."""
    out = np.empty((len(sets), len(functions[0])), np.uint32)
    first, total = 0, 0
    for i, one in enumerate([*sets, None]):  # pieces that stay in the processor's cache
        if one is None or total and total + len(one) > 65536:
            x = (np.concatenate(sets[first:i]) >> np.uint64(32)).astype(np.uint32) if i > first else None
            if x is not None:
                starts = np.cumsum([0, *[len(s) for s in sets[first : i - 1]]])
                with np.errstate(over="ignore"):
                    for k, (a, b) in enumerate(zip(*functions, strict=True)):
                        out[first:i, k] = np.minimum.reduceat(x * a + b, starts)
            first, total = i, 0
        if one is not None:
            total += len(one)
    return out
