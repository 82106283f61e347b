"""Sets of word shingles as sorted 64-bit hashes, worked out for a whole text at once."""

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True
_lower = np.arange(256, dtype=np.uint64)
_lower[65:91] += 32
_lower += 1  # no byte counts as nothing
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_up_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        room = max(size, 1 << 16)
        for at, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(room, base, np.uint64)
            factors[0] = 1
            _powers[at] = np.cumprod(factors)
    return _powers[0], _powers[1]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over their range."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and byte length of every word of the text, A-Z lower-cased; words are runs of no ASCII white space."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    powers, inverses = _powers_up_to(len(data) + 1)
    inside = ~_space[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_lower[data] * powers[:len(data)])))
    values = (sums[ends] - sums[begins]) * inverses[begins]
    return mix(values + (ends - begins).astype(np.uint64)), ends - begins


def shingle_set(text: str | None, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of `words` words, sorted, and the bytes of each; a shorter text is one shingle."""
    hashes, lengths = word_hashes(text)
    if not len(hashes):
        return hashes, lengths
    take = min(words, len(hashes))
    count = len(hashes) - take + 1
    value, size = hashes[:count] + np.uint64(take), lengths[:count].copy()
    for k in range(1, take):
        value = mix(value * np.uint64(0xD6E8FEB86659FD93) + hashes[k:count + k])
        size += lengths[k:count + k]
    found, first = np.unique(value, return_index=True)
    return found, size[first]
