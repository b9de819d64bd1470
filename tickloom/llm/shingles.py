"""Hashes of words and word shingles for whole batches of texts, and similarities of shingle multisets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tickloom.llm.common import utf8

#: Words of a shingle.
SHINGLE = 5
#: Bytes of texts that are hashed at a time.
CHUNK = 1 << 21

#: All bytes but white space are in tokens.
_IN_TOKEN = np.array([b not in b" \t\n\v\f\r" for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_BASE = _U(0xD1342543DE82EF95)
#: ASCII letters and digits and all bytes of other scripts are in words.
_IN_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result hangs on every bit of x."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_OF_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def hashed_chunks(column: pa.Array, members: np.ndarray, lower: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some rows after each other the 64-bit hashes of all their words, and where each row's words begin (one more than rows).

    A word is a run of bytes that are `members`; `lower` maps bytes before they are hashed. Null texts have no words.
    """
    column = column.cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(column):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + CHUNK, "right")))
        flat, offsets = utf8(column.slice(begin, end - begin))
        yield _hash(flat if lower is None else lower[flat], offsets, members)
        begin = end


def _rows(chunks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
    for hashes, bounds in chunks:
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield hashes[a:b]


def word_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    """For each row the 64-bit hashes of its lower-cased words, in order; null texts have none.

    A word is a run of ASCII letters and digits and of characters of other scripts.
    """
    return _rows(hashed_chunks(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), _IN_WORD))


def token_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    """For each row the 64-bit hashes of its runs of bytes other than ASCII white space, A-Z lower-cased; null texts have none."""
    return _rows(hashed_chunks(column, _IN_TOKEN, _LOWER))


def exact_token_chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of hashes of the runs of bytes other than ASCII white space, as they are."""
    return hashed_chunks(column, _IN_TOKEN)


def _hash(flat: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and where each row's begin; some CHUNK bytes of a long text are worked on at a time."""
    inside = members[flat]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(flat)]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    parts = [np.zeros(0, np.uint64)]
    cuts = np.append(np.flatnonzero(np.diff(starts // CHUNK, prepend=-1)), len(starts))
    for a, b in zip(cuts[:-1], cuts[1:]):
        left, right = starts[a], starts[b] if b < len(starts) else len(flat)
        at = np.flatnonzero(inside[left:right])
        head = np.searchsorted(at, starts[a:b] - left)
        length = np.diff(np.append(head, len(at)))
        power = _powers(int(length.max()))
        place = np.arange(len(at)) - np.repeat(head, length)
        parts.append(mix(np.add.reduceat(_OF_BYTE[flat[left:right][at]] * power[place], head) + length.astype(np.uint64)))
    return np.concatenate(parts), np.searchsorted(starts, offsets)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, by doubling: about 2 log k steps whatever k is."""
    out, length = np.zeros(max(len(words) - k + 1, 0), np.uint64), 0
    part, size, power = words, 1, _BASE
    while size <= k:
        if k & size:
            out = out * power + part[length : length + len(out)]
            length += size
        if 2 * size <= k:
            part = part[:-size] * power + part[size:] if len(part) > size else part[:0]
        size, power = 2 * size, power * power
    return mix(out + _U(k))


def shingles(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of k words; a text of fewer words is one shingle, one without words has none."""
    if not len(words):
        return words
    k = min(k, len(words))
    out = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        out = out * _BASE + words[j : j + len(out)]
    return mix(out + _U(k))


def weighted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in rising order and how often each occurs."""
    return np.unique(values, return_counts=True)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two weighted sets: over the common elements the sum of
    1 / sum_j max(a_j / a_i, b_j / b_i). For sets without repeats it is the Jaccard similarity."""
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    wa, wb = a[1][ia].astype(float), b[1][ib].astype(float)
    rest_a, rest_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    # With t = a_j / b_j and t_i = a_i / b_i, a term is a_j / a_i where t_j > t_i, else b_j / b_i.
    t = wa / wb
    order = np.argsort(t, kind="stable")
    t, sa, sb = t[order], wa[order], wb[order]
    above = np.searchsorted(t, t, "right")
    tail_a = np.concatenate([np.cumsum(sa[::-1])[::-1], [0.0]])[above] + rest_a
    head_b = np.concatenate([[0.0], np.cumsum(sb)])[above] + rest_b
    return float((1.0 / (tail_a / sa + head_b / sb)).sum())
