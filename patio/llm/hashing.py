"""Words of many texts at once, as positions and 64-bit hashes."""

import numpy as np

from patio.llm.batches import IS_WHITE

_RNG = np.random.default_rng(20240611)
#: Random odd base, its inverse mod 2^64, and one random number per byte.
BASE = np.uint64(int(_RNG.integers(1, 1 << 62)) * 2 + 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTE = _RNG.integers(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}

#: A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(n - 1, 1).bit_length()
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each text (n + 1 counts).

    A word is a run of bytes between white-space bytes or ends of texts.
    """
    n = len(body)
    solid = np.zeros(n + 2, bool)
    solid[1:-1] = ~IS_WHITE[body]
    begins = solid[1:] & ~solid[:-1]  # at place i: a word begins at byte i
    ends = ~solid[1:] & solid[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    split = inner[solid[inner] & solid[inner + 1]]  # a word of one text touches one of the next
    begins[split] = True
    ends[split] = True
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends), np.searchsorted(starts, offsets)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes: a polynomial of random byte values, freed of its place, mixed."""
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(BYTE[values] * up[:len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def text_hash(word: str) -> int:
    """The hash that ``span_hashes`` gives to a word by itself."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])
