"""Hashes of words and word n-grams, on whole texts, with NumPy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Texts are hashed in parts of about so many bytes, cut at white space.  Longer words get another hash, by a rule that
#: looks at the word alone.
PART = 1 << 16

_rng = np.random.default_rng(41)
_FACTOR = int(_rng.integers(0, 2**62)) * 4 + 1
_BYTE_VALUES = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


_POWERS = _powers(_FACTOR, PART + 1)
_INVERSE = _powers(pow(_FACTOR, -1, 1 << 64), PART + 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words under which near values part."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _part_hashes(part: np.ndarray) -> np.ndarray:
    """Hashes of the words of a part: random byte values times powers of an odd factor, summed over the word by
    differences of prefix sums, moved to the word's start and mixed."""
    edge = np.concatenate([[True], _IS_SPACE[part], [True]])
    turns = np.flatnonzero(edge[1:] != edge[:-1])
    starts, ends = turns[::2], turns[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE_VALUES[part] * _POWERS[: len(part)], dtype=np.uint64)])
    return _mixed((sums[ends] - sums[starts]) * _INVERSE[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, in order.  A word's hash depends on its bytes alone."""
    data = np.frombuffer(text, np.uint8)
    if len(data) <= PART:
        return _part_hashes(data)
    out, at = [], 0
    while at < len(data):
        part = data[at : at + PART]
        if at + PART < len(data):
            spaces = np.flatnonzero(_IS_SPACE[part])
            if len(spaces):
                part = part[: spaces[-1] + 1]
            else:  # inside a word longer than a part
                rest = np.flatnonzero(_IS_SPACE[data[at:]])
                end = at + int(rest[0]) if len(rest) else len(data)
                out.append(np.array([xxhash.xxh3_64_intdigest(text[at:end])], np.uint64))
                at = end
                continue
        elif len(part) == PART and not _IS_SPACE[part].any():
            out.append(np.array([xxhash.xxh3_64_intdigest(part.tobytes())], np.uint64))
            break
        out.append(_part_hashes(part))
        at += len(part)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def ngram_hashes(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of all runs of n words: word hashes times odd factors of their places, summed and mixed."""
    factors = np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    size = len(hashes) - n + 1
    total = np.zeros(max(0, size), np.uint64)
    for i in range(n if size > 0 else 0):
        total += hashes[i : i + size] * factors[i]
    return _mixed(total)


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """The sorted distinct n-word shingles of a text with A-Z lower-cased; of fewer words, the whole sequence as one."""
    text = text.lower()
    hashes = word_hashes(text)
    if not len(hashes):
        return np.zeros(0, np.uint64)
    if len(hashes) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(text.split()), len(hashes))], np.uint64)
    found = np.sort(ngram_hashes(hashes, n, 11))
    return found[np.concatenate([[True], found[1:] != found[:-1]])]
