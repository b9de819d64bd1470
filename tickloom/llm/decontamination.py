"""Benchmark passages in documents: SimHash windows of the size of an item, multi-index Hamming search, exact verification.

Items and documents are sequences of word hashes. A window has as many words as an item and
its multiset of five-word shingles; a window can only be similar to an item if enough of its
shingles occur in the benchmark at all, which running sums tell for every position and size. The
windows that remain get a 64-bit SimHash of their words. Fingerprints are split into one block more than
the radius, so two within the radius agree in at least one block: an index per block finds
every one of them; those are verified by exact weighted-shingle similarity.

The radius is wide, as a passage that is cut at an edge may differ from its item in a fifth of its
words and still be similar; windows that are left over are few, so a wide search costs little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import map_batches
from tickloom.llm.shingles import SHINGLE, mix, probability_jaccard, shingles, weighted, word_hashes
from tickloom.session import materialize

THRESHOLD = 0.8
#: Hamming radius of the search; fingerprints have one block more. Similar windows further away are not found: the README has the recall.
RADIUS = 21
BITS = 64
#: Items and bytes of item text that are broadcast at a time; a larger benchmark is searched for slice by slice.
SLICE_ITEMS, SLICE_BYTES = 50_000, 32_000_000
#: Bits of the table that tells which shingles may be in the benchmark.
TABLE_BITS = 22
#: Words whose bits are summed at a time, and pairs of a window and an item that are compared at a time, about.
STRETCH, PAIRS = 1 << 15, 1 << 20

_U = np.uint64


def running_bits(words: np.ndarray) -> np.ndarray:
    """For every prefix of the words and every bit, how many more of its words have the bit set than unset."""
    bits = np.unpackbits(mix(words).view(np.uint8).reshape(-1, 8), axis=1)
    out = np.zeros((len(words) + 1, BITS), np.int32)
    np.cumsum(bits.astype(np.int32) * 2 - 1, axis=0, out=out[1:])
    return out


def fingerprints(running: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of `size` words that begin at the given words."""
    return np.packbits(running[start + size] > running[start], axis=1).view(np.uint64).ravel()


def block_bounds(radius: int = RADIUS) -> list[tuple[int, int]]:
    """Shift and width of radius + 1 blocks that cover all bits."""
    cuts = [BITS * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


class HammingIndex:
    """Finds all stored fingerprints within the radius of given ones."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS) -> None:
        self.prints, self.radius = prints, radius
        shift, width = (np.array(x, np.uint64) for x in zip(*block_bounds(radius)))
        self.shift, self.mask, self.block = shift, (_U(1) << width) - _U(1), np.arange(len(shift), dtype=np.uint64) << _U(BITS // 2)
        # One sorted table for all blocks: what a fingerprint has in a block, and whose it is.
        keys = self._keys(prints)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], order // len(shift)

    def _keys(self, prints: np.ndarray) -> np.ndarray:
        return (((prints[:, None] >> self.shift) & self.mask) | self.block).ravel()

    def search(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in `asked`, position in the index, distance) of all pairs within the radius, each once."""
        step = max(1, PAIRS // max(1, len(self.prints)))
        parts = [self._near(asked[k : k + step]) for k in range(0, len(asked), step)] or [self._near(asked)]
        q = np.concatenate([part // len(self.prints) + k * step for k, part in enumerate(parts)])
        found = np.concatenate([part % len(self.prints) for part in parts])
        return q, found, np.bitwise_count(asked[q] ^ self.prints[found]).astype(int)

    def _near(self, asked: np.ndarray) -> np.ndarray:
        own = self._keys(asked)
        low, high = np.searchsorted(self.keys, own, "left"), np.searchsorted(self.keys, own, "right")
        n = high - low
        q = np.repeat(np.arange(len(own)) // len(self.shift), n)
        found = self.owner[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
        near = np.bitwise_count(asked[q] ^ self.prints[found]) <= self.radius
        return np.unique(q[near] * len(self.prints) + found[near])


class Benchmark:
    """Items by size in words, with their shingles, the index of their fingerprints, and the table of all their shingles."""

    def __init__(self, ids: list, texts: list[str | None], threshold: float = THRESHOLD) -> None:
        self.threshold = threshold
        by_size: dict[int, list[tuple[object, np.ndarray]]] = {}
        for item, words in zip(ids, word_hashes(pa.array(texts, pa.string())), strict=True):
            if len(words):
                by_size.setdefault(len(words), []).append((item, words))
        self.sizes = {}
        values: dict[int, list[np.ndarray]] = {}
        for size, items in sorted(by_size.items()):
            sets = [weighted(shingles(w)) for _, w in items]
            prints = np.array([fingerprints(running_bits(w), np.zeros(1, int), size)[0] for _, w in items], np.uint64)
            self.sizes[size] = ([i for i, _ in items], sets, HammingIndex(prints))
            values.setdefault(min(size, SHINGLE), []).extend(s for s, _ in sets)
        self.known = {k: np.unique(np.concatenate(v)) for k, v in values.items()}
        self.table = {}
        for k, v in self.known.items():
            self.table[k] = np.zeros(1 << TABLE_BITS, bool)
            self.table[k][v >> _U(64 - TABLE_BITS)] = True

    def _hits(self, words: np.ndarray, k: int) -> np.ndarray | None:
        """Running number of shingles of k words that occur in the benchmark; None if there are none."""
        if len(words) < k:
            return None
        own = shingles(words, k)
        maybe = np.flatnonzero(self.table[k][own >> _U(64 - TABLE_BITS)])
        if not len(maybe):
            return None
        at = np.searchsorted(self.known[k], own[maybe])
        sure = maybe[self.known[k][np.minimum(at, len(self.known[k]) - 1)] == own[maybe]]
        if not len(sure):
            return None
        hit = np.zeros(len(own) + 1, np.int64)
        hit[sure + 1] = 1
        return np.cumsum(hit)

    def search(self, words: np.ndarray) -> list[tuple[object, float, int, int, int]]:
        """(item, similarity, distance, first word, words) of the most similar window of each item found; of equal ones the first."""
        best: dict[tuple[int, int], tuple[float, int, int, int]] = {}
        hits = {k: self._hits(words, k) for k in self.known}
        asked: list[tuple[int, int, np.ndarray]] = []
        for size in self.sizes:
            # A document shorter than an item is one window; its shingles are those of its own length.
            window, k = min(size, len(words)), min(size, SHINGLE)
            if hits[k] is None or window < k or window < self.threshold * size:
                continue
            n = window - k + 1
            enough = np.flatnonzero(hits[k][n:] - hits[k][:-n] >= self.threshold * n - 1e-9)
            if len(enough):
                asked.append((size, window, enough))
        stretches = {int(x) for _, _, enough in asked for x in np.unique(enough // STRETCH)}
        for stretch in sorted(stretches):
            first = stretch * STRETCH
            near = words[first : first + STRETCH + max(window for _, window, _ in asked)]
            running = running_bits(near)
            for size, window, enough in asked:
                a, b = np.searchsorted(enough, (first, first + STRETCH))
                if a < b:
                    self._verify(near, running, first, size, window, enough[a:b] - first, best)
        return [(self.sizes[size][0][item], *found) for (size, item), found in sorted(best.items())]


    def _verify(self, words: np.ndarray, running: np.ndarray, first: int, size: int, window: int, starts: np.ndarray, best: dict[tuple[int, int], tuple[float, int, int, int]]) -> None:
        """Takes the items of one size near to the windows at the given starts into `best`, if they are similar; words begin at word `first`."""
        _, sets, index = self.sizes[size]
        q, found, distance = index.search(fingerprints(running, starts, window))
        made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for at, item, bits in zip(q.tolist(), found.tolist(), distance.tolist()):
            start = int(starts[at])
            if start not in made:
                made = {start: weighted(shingles(words[start : start + window], min(size, SHINGLE)))}
            similarity = probability_jaccard(made[start], sets[item])
            if similarity >= self.threshold - 1e-12 and similarity > best.get((size, item), (0.0,))[0] + 1e-12:
                best[size, item] = (similarity, bits, first + start, window)


def find_passages(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of `docs` that hold a passage as long as a benchmark item and similar to it.

    One row per row of `docs` and item found: the key, the item's id, `similarity` (probability Jaccard of
    five-word shingles, at least `threshold`) of the most similar window, `distance` (Hamming), `start_word` and `n_words`
    of that window. Items of fewer than five words are compared as one shingle. Null, empty and wordless texts and
    items match nothing; repeated rows and items are each reported. The benchmark is broadcast in slices of bounded size.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    slices = max(1, -(-size["n"] // SLICE_ITEMS), -(-size["bytes"] // SLICE_BYTES))
    key_type, item_type = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"`{key}` {key_type}, `{item}` {item_type}, similarity double, distance int, start_word bigint, n_words int"
    rows = docs.select(key, docs[text].cast("string").alias("__text"))
    out = None
    for s in range(slices):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == s).collect()
        shared = spark.sparkContext.broadcast(([r["item"] for r in part], [r["text"] for r in part]))
        found = map_batches(rows, _search(shared, key, item, threshold), schema)
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, whole, in which `find_passages` finds nothing."""
    numbered = materialize(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("__number")), "numbered")
    found = find_passages(numbered.select("__number", F.col(f"row.`{text}`").alias("text")), benchmark, key="__number", threshold=threshold)
    return numbered.join(found.select("__number").distinct(), "__number", "left_anti").select("row.*")


def _search(shared, key: str, item: str, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = Benchmark(*shared.value, threshold)
        for batch in batches:
            at, found = [], []
            for k, words in enumerate(word_hashes(batch.column(1))):
                for x in benchmark.search(words):
                    at.append(k)
                    found.append(x)
            keys = batch.column(0).take(pa.array(at, pa.int64()))
            ids = pa.array([x[0] for x in found], None if found else pa.int64())
            numbers = [pa.array([x[c] for x in found], kind) for c, kind in ((1, pa.float64()), (2, pa.int32()), (3, pa.int64()), (4, pa.int32()))]
            if found:
                yield pa.RecordBatch.from_arrays([keys, ids, *numbers], names=[key, item, "similarity", "distance", "start_word", "n_words"])

    return run
