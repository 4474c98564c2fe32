"""Word shingles of many texts at once, their parity sketches and part signatures."""

import numpy as np

from patio.llm.hashing import LOWER, mix, span_hashes, word_spans

SIZE = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(body: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingles of every text in a row, and n + 1 offsets.

    A-Z count as a-z. A text of fewer words is one shingle, a text without words has none.
    """
    starts, ends, bounds = word_spans(body, offsets)
    words = span_hashes(LOWER[body], starts, ends)
    n = len(offsets) - 1
    counts = np.diff(bounds)
    total = len(words)
    # the shingle that begins at each word, as long as the text has words
    hashes = np.zeros(total, np.uint64)
    text_of = np.repeat(np.arange(n), counts)
    left = bounds[1:][text_of] - np.arange(total)
    for k in range(size):
        here = np.flatnonzero(left > k)
        hashes[here] = mix(hashes[here] * _STEP + words[here + k] + np.uint64(k))
    first = bounds[:-1][text_of] == np.arange(total)
    kept = (left >= size) | (first & (counts[text_of] < size))
    parts, sizes = [], np.zeros(n, np.int64)
    cuts = np.concatenate([[0], np.cumsum(kept)])[bounds]
    hashes = hashes[kept]
    for i in range(n):
        if cuts[i] < cuts[i + 1]:
            part = np.sort(hashes[cuts[i]:cuts[i + 1]])
            if len(part) > 1:
                part = part[np.concatenate([[True], part[1:] != part[:-1]])]
            parts.append(part)
            sizes[i] = len(part)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def set_keys(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every set, equal for equal sets; 0 for the empty set."""
    out = []
    for salt in mix(np.arange(1, 3, dtype=np.uint64)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(flat ^ salt))])
        out.append(mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def sketch_bits(n: int) -> int:
    """Bits of the dense sketch of a set of n: a power of two, four to eight for each shingle."""
    return 1 << max(6, int(4 * n - 1).bit_length())


def dense_sketch(shingles: np.ndarray) -> bytes:
    """Parity sketch: each shingle turns one bit over. Sketches of a larger power of two fold to a
    smaller by exclusive or of their halves; the Hamming distance of two is at most the symmetric
    difference of their sets."""
    bits = sketch_bits(len(shingles))
    odd = np.bincount((mix(shingles) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold(words: np.ndarray, size: int) -> np.ndarray:
    """A sketch of uint64 words folded to ``size`` words."""
    while len(words) > size:
        half = len(words) // 2
        words = words[:half] ^ words[half:]
    return words


def max_difference(a, b):
    """Largest symmetric difference of sets of sizes a and b with Jaccard similarity 0.75: of their
    union at most a quarter, and a + b is at least 1.75 unions."""
    return (a + b) // 7


def spaces_of(n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Size bands [2^j, 2^(j+1)): for each space a set takes part in (its own band, and the next one
    if a partner there is possible) the mask of sets, the band, parts, and signatures needed.

    A pair differs in at most s parts, so it agrees in parts - s of them. Of each set's parts, in an
    order that all sets share, the first s + 1 must then meet one of the other's.
    """
    band = np.frexp(n.astype(float))[1] - 1
    upper = np.int64(1) << (band + 1)
    most = 4 * n // 3
    own = (np.ones(len(n), bool), band, -(-2 * upper // 5), max_difference(n, np.minimum(most, upper - 1)) + 1)
    above = (most >= upper, band + 1, -(-4 * upper // 5), max_difference(n, most) + 1)
    return [own, above]


def signatures(flat: np.ndarray, bounds: np.ndarray, is_hot) -> tuple[np.ndarray, np.ndarray]:
    """(set number, signature) rows of all sets that are not empty.

    Every set is cut into parts by the high bits of its shingles, so a part is a run of the sorted
    set. A part's signature is the exclusive or of its shingles' hashes: the hash of its parity
    sketch, with place and number of shingles. Order of the parts: empty ones last, before them those
    that ``is_hot`` marks, larger parts first.
    """
    sizes = np.diff(bounds)
    out_sets, out_signs = [], []
    spread = mix(flat ^ _STEP)
    for mask, band, parts, need in spaces_of(np.maximum(sizes, 1)):
        chosen = np.flatnonzero(mask & (sizes > 0))
        if not len(chosen):
            continue
        lengths = sizes[chosen]
        ends = np.cumsum(lengths)
        index = np.arange(ends[-1]) + np.repeat(bounds[chosen] - ends + lengths, lengths)
        owner = np.repeat(np.arange(len(chosen)), lengths)
        part = ((flat[index] >> np.uint64(32)) * parts[chosen][owner].astype(np.uint64)) >> np.uint64(32)
        key = (owner.astype(np.int64) << 32) | part.astype(np.int64)
        runs = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        value = np.bitwise_xor.reduceat(spread[index], runs)
        count = np.diff(np.concatenate([runs, [len(key)]]))
        owner, part = owner[runs], part[runs]
        place = mix((band[chosen][owner].astype(np.uint64) << np.uint64(40)) + part)
        sign = mix(value ^ place ^ (count.astype(np.uint64) * _STEP))
        order = np.argsort((owner * 1024) + is_hot(sign) * 512 + 511 - np.minimum(count, 511), kind="stable")
        owner, sign = owner[order], sign[order]
        first = np.searchsorted(owner, np.arange(len(chosen)))
        taken = np.arange(len(owner)) - first[owner] < need[chosen][owner]
        out_sets.append(chosen[owner[taken]])
        out_signs.append(sign[taken])
        # a set with fewer parts in use than it needs takes empty ones, lowest first
        used = np.diff(np.concatenate([first, [len(owner)]]))
        for i in np.flatnonzero(used < need[chosen]):
            holds = set(part[(key[runs] >> 32) == i].tolist())
            empty = [p for p in range(int(parts[chosen[i]])) if p not in holds][:int(need[chosen[i]] - used[i])]
            place = mix((np.uint64(band[chosen[i]]) << np.uint64(40)) + np.array(empty, np.uint64))
            out_sets.append(np.full(len(empty), chosen[i]))
            out_signs.append(mix(place))
    if not out_sets:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_sets), np.concatenate(out_signs)
