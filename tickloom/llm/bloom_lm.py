"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Counts of words and of word pairs are quantised to levels that grow geometrically; the filter
holds a pair (n-gram, level) for every level up to the n-gram's own, and a count is read back by
probing level after level until one is missing. The filter is built in segments by Spark and
broadcast to the workers; a filter beyond the bound is broadcast slice by slice.

Score of a token w after v: P(w | v) = a * count(v, w) / count(v) + (1 - a) * (count(w) + 1) / (N + V + 1), where
a depends on the level of count(v) and comes from deleted interpolation over all training tokens. Counts of
pairs are rounded down and those of contexts up, so that quantising never makes the probabilities sum to more than 1.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm.common import BATCH_ROWS, by_bytes, map_batches, ship_package, strings, utf8
from tickloom.llm.shingles import _IN_TOKEN, _LOWER, mix
from tickloom.session import materialize

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
#: Hashes of the end of a text and of what stands before its first word.
END, START = _U(0x1B873593CC9E2D51), _U(0x38495AB5E6546B64)
#: Ratio of neighbouring levels; bits of the filter for each (n-gram, level) and how many of them it sets, in one block.
GROWTH, BITS, PROBES, BLOCK = 1.3, 10, 6, 512
#: Occurrences that one segment is built from, n-grams a worker gathers before it sends them, and bytes broadcast at a time.
SEGMENT, GATHER, FILTER_BYTES = 1 << 20, 1 << 20, 128_000_000
#: The most frequent words are broadcast with their counts: there are no more of them than this number.
FREQUENT = 1 << 18
#: Words a worker counts before it sends them.
COUNTED = 1 << 18
#: N-grams that are probed at a time: their blocks stay in the processor's cache from the first probe to the last.
PROBED = 1 << 14
#: Pairs of high levels whose levels a worker remembers.
REMEMBERED = 1 << 19
#: Bytes of texts that are worked on at a time.
PART = 1 << 20
#: Tokens whose levels are turned into probabilities at a time.
TOKENS = 1 << 19
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: Masks that keep so many low bytes of a number.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _levels() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 60:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * GROWTH))))
    return np.array(out, np.int64)


#: Smallest count of each level, from level 1.
LEAST = _levels()


def level_of(counts: np.ndarray) -> np.ndarray:
    """Level of a count; 0 for none."""
    return np.searchsorted(LEAST, counts, "right")


def rounded_down(levels: np.ndarray) -> np.ndarray:
    return np.where(levels > 0, LEAST[np.maximum(levels, 1) - 1], 0).astype(float)


def rounded_up(levels: np.ndarray) -> np.ndarray:
    return np.where(levels > 0, LEAST[np.maximum(levels, 0)] - 1, 0).astype(float)


@dataclass
class Tokens:
    """The tokens of some texts after each other: `hashes`, the END of each text included, and `bounds`, where each text's begin (one more than texts).

    Token k is `data[starts[k]:stops[k]]`, an end is empty.
    """

    data: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Tokens:
        """Runs of bytes other than ASCII white space, A-Z lower-cased; a null text has its end only."""
        flat, offsets = utf8(column)
        data = np.concatenate([_LOWER[flat], np.zeros(8, np.uint8)])
        inside = _IN_TOKEN[flat]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < len(flat))]
        first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
        starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
        words = np.searchsorted(starts, offsets)
        bounds = words + np.arange(len(words))
        place = np.arange(len(starts)) + np.repeat(np.arange(len(words) - 1), np.diff(words))
        out = cls(data, np.zeros(bounds[-1], np.int64), np.zeros(bounds[-1], np.int64), np.full(bounds[-1], END), bounds)
        out.starts[place], out.stops[place] = starts, stops
        out.hashes[place] = _hash_words(out, place)
        return out

    def pairs(self) -> np.ndarray:
        """N-gram hashes of (word before, word) for all tokens."""
        before = np.concatenate([[START], self.hashes[:-1]])
        before[self.bounds[:-1]] = START
        return mix(before * _STEP + mix(self.hashes))

    def eights(self) -> np.ndarray:
        """The eight bytes from every place on as a number; `data` has eight bytes more than the texts."""
        return np.ndarray(len(self.data) - 7, np.dtype("<u8"), self.data, strides=(1,))

    def words(self, at: np.ndarray) -> list[bytes]:
        data = self.data.tobytes()
        return [data[a:b] for a, b in zip(self.starts[at].tolist(), self.stops[at].tolist())]


def _hash_words(tokens: Tokens, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of some tokens, eight bytes at a time."""
    eights, starts, length = tokens.eights(), tokens.starts[at], tokens.stops[at] - tokens.starts[at]
    out = length.astype(np.uint64) * _STEP
    left, done = np.flatnonzero(length <= LONG_WORD), 0
    while len(left):
        rest = length[left] - done
        out[left] = mix((out[left] ^ (eights[starts[left] + done] & _LOW_BYTES[np.minimum(rest, 8)])) * _STEP + START)
        left, done = left[rest > 8], done + 8
    for k in np.flatnonzero(length > LONG_WORD):
        word = tokens.data[starts[k] : starts[k] + length[k]]
        out[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return out


def same_words(a: Tokens, i: np.ndarray, b: Tokens, j: np.ndarray) -> np.ndarray:
    """Whether tokens i of a are, byte for byte, tokens j of b."""
    starts, others = a.starts[i], b.starts[j]
    length = a.stops[i] - starts
    same = length == b.stops[j] - others
    one, other = a.eights(), b.eights()
    left, done = np.flatnonzero(same & (length <= LONG_WORD)), 0
    while len(left):
        rest = length[left] - done
        same[left] = ((one[starts[left] + done] ^ other[others[left] + done]) & _LOW_BYTES[np.minimum(rest, 8)]) == 0
        left, done = left[(rest > 8) & same[left]], done + 8
    for k in np.flatnonzero(same & (length > LONG_WORD)):
        same[k] = np.array_equal(a.data[starts[k] : starts[k] + length[k]], b.data[others[k] : others[k] + length[k]])
    return same


@dataclass
class Frequent:
    """Words of the training texts in the order of their hashes, and log10 of their counts plus one."""

    words: Tokens
    logs: np.ndarray

    @classmethod
    def of(cls, words: pa.Array, counts: np.ndarray) -> Frequent:
        """Words whose hashes clash are left out."""
        each = Tokens.of(words)
        at = each.bounds[:-1]
        order = np.argsort(each.hashes[at], kind="stable")
        hashes = each.hashes[at[order]]
        new = np.append(True, hashes[1:] != hashes[:-1])
        order = order[new & np.append(new[1:], True)] if len(order) else order
        at = at[order]
        return cls(Tokens(each.data, each.starts[at], each.stops[at], each.hashes[at], np.arange(len(at) + 1)), np.log10(counts[order] + 1.0))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Which word each hash is; -1 for none."""
        if not len(self.logs):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words.hashes, hashes), len(self.logs) - 1)
        return np.where(self.words.hashes[at] == hashes, at, -1)


def segment_of(grams: np.ndarray, segments: int) -> np.ndarray:
    return (mix(grams + _STEP) % _U(segments)).astype(np.int64)


def _places(grams: np.ndarray, level: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What chooses the block, and what chooses the bits in it."""
    h = mix(grams + np.asarray(level, np.uint64) * _STEP)
    return h >> _U(20), mix(h)


def build_segment(grams: np.ndarray, counts: np.ndarray) -> bytes:
    """Bits of one segment for n-grams (which may repeat) with counts."""
    grams, inverse = np.unique(grams, return_inverse=True)
    levels = level_of(np.bincount(inverse, counts).astype(np.int64))
    blocks = max(1, -(-int(levels.sum()) * BITS // BLOCK))
    bits = np.zeros(blocks * BLOCK, bool)
    for a in range(0, len(grams), PROBED):
        each = levels[a : a + PROBED]
        level = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + 1
        place, chosen = _places(np.repeat(grams[a : a + PROBED], each), level)
        base = (place % _U(blocks)).astype(np.int64) * BLOCK
        for k in range(PROBES):
            bits[base + ((chosen >> _U(9 * k)) & _U(BLOCK - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass
class BloomFilter:
    """Some of the segments: `first[s]` is the first block of segment s, `blocks[s]` how many it has (0: not here)."""

    words: np.ndarray
    first: np.ndarray
    blocks: np.ndarray
    #: N-grams in rising order and their levels, and the lowest level that is remembered.
    memo: tuple[np.ndarray, np.ndarray, int] = (np.zeros(0, np.uint64), np.zeros(0, np.uint8), 3)

    @classmethod
    def of(cls, sizes: dict[int, int], parts: Iterable[tuple[int, bytes]], segments: int) -> BloomFilter:
        """From the sizes in bytes and, one after the other, the bits of the segments that are here."""
        blocks = np.zeros(segments, np.int64)
        for s, size in sizes.items():
            blocks[s] = size * 8 // BLOCK
        first = np.cumsum(blocks) - blocks
        words = np.zeros(int(blocks.sum()) * (BLOCK // 64), np.uint64)
        for s, bits in parts:
            at = int(first[s]) * (BLOCK // 64)
            words[at : at + len(bits) // 8] = np.frombuffer(bits, np.uint64)
        return cls(words, first, blocks)

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """Highest level up to which each n-gram is found; 0 where its segment is not here."""
        distinct, inverse = np.unique(grams, return_inverse=True)
        return self.distinct_levels(distinct, np.zeros(len(distinct), bool))[inverse]

    def distinct_levels(self, grams: np.ndarray, counted: np.ndarray) -> np.ndarray:
        """The same for distinct n-grams; those that are `counted` were counted once at least and not asked for level 1, which nothing counted lacks."""
        segment = segment_of(grams, len(self.blocks))
        first, blocks = self.first[segment], self.blocks[segment].astype(np.uint64)
        out = ((blocks > 0) & counted).astype(np.uint8)
        at = np.flatnonzero((blocks > 0) & ~counted)
        level = 1
        while len(at) or level == 1:
            for part in (at[a : a + PROBED] for a in range(0, len(at), PROBED)):
                out[part[self._found(grams[part], first[part], blocks[part], level)]] = level
            at = np.flatnonzero(out) if level == 1 else at[out[at] == level]
            level += 1
        return out

    def _found(self, grams: np.ndarray, first: np.ndarray, blocks: np.ndarray, level: int) -> np.ndarray:
        """Positions of the n-grams that are found at a level."""
        place, chosen = _places(grams, level)
        base = (first + (place % blocks).view(np.int64)) * (BLOCK // 64)
        at = np.arange(len(grams))
        found = np.full(len(at), _U(1))
        for k in range(PROBES):
            found &= self.words[base + ((chosen >> _U(9 * k + 6)) & _U(BLOCK // 64 - 1)).view(np.int64)] >> ((chosen >> _U(9 * k)) & _U(63))
            # Where a probe rules out many, the next ones are only asked for the rest.
            if k + 1 == PROBES or np.count_nonzero(found) < 0.7 * len(found):
                there = found > 0
                at, base, chosen = at[there], base[there], chosen[there]
                found = np.full(len(at), _U(1))
        return at

    def remembered_levels(self, grams: np.ndarray, counted: np.ndarray) -> np.ndarray:
        """The same for distinct n-grams in rising order; what was found at high levels is kept, with a bound, and not probed again."""
        known, levels, floor = self.memo
        out = np.zeros(len(grams), np.uint8)
        new = np.ones(len(grams), bool)
        if len(known):
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            new = known[at] != grams
            out[~new] = levels[at[~new]]
        out[new] = self.distinct_levels(grams[new], counted[new])
        new &= out >= floor
        if new.any():
            known, levels = np.concatenate([known, grams[new]]), np.concatenate([levels, out[new]])
            if len(known) > REMEMBERED:
                above = np.cumsum(np.bincount(levels, minlength=257)[::-1])[::-1]
                floor = int(np.argmax(above <= REMEMBERED))
            order = np.argsort(known)
            order = order[levels[order] >= floor]
            self.memo = known[order], levels[order], floor
        return out


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside gets Arrow batches of few rows, so that an executor does not hold a whole partition's texts twice; the setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _released(fn):
    """The same for `map_batches`; between batches Arrow gives unused memory back, as workers live on after their tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in fn(batches):
            yield batch
            del batch
            pa.default_memory_pool().release_unused()

    return run


def word_counts(texts: DataFrame) -> DataFrame:
    """`word`, `n` over all rows of the only column; the empty word stands for the end of a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()).cast(pa.string()), pa.array(list(sums.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in strings(batch.column(0)):
                sums.update(text.encode().lower().split())
                if len(sums) > COUNTED:
                    yield rows()
                    sums.clear()
            sums[b""] += batch.num_rows
        if sums:
            yield rows()

    return map_batches(texts, _released(count), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _blobs(segments: int, grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """N-grams and counts of each segment as two byte strings."""
    segment = segment_of(grams, segments)
    order = np.argsort(segment, kind="stable")
    grams, counts, segment = grams[order], counts[order].astype(np.int64), segment[order]
    there, start = np.unique(segment, return_index=True)
    parts = [(grams[a:b].tobytes(), counts[a:b].tobytes()) for a, b in zip(start, [*start[1:], len(grams)])]
    return pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array([x for x, _ in parts], pa.binary()), pa.array([y for _, y in parts], pa.binary())], names=["segment", "grams", "counts"])


def filter_segments(texts: DataFrame, counted: DataFrame, segments: int) -> DataFrame:
    """`segment`, `bits`, `size` of the filter over all words (`word`, `n`) and all word pairs of the texts."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in (part for whole in batches for part in by_bytes(whole, 0, PART)):
            held.append(Tokens.of(batch.column(0)).pairs())
            size += len(held[-1])
            if size > GATHER:
                yield _blobs(segments, *np.unique(np.concatenate(held), return_counts=True))
                held, size = [], 0
        if held:
            yield _blobs(segments, *np.unique(np.concatenate(held), return_counts=True))

    def singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in (part for whole in batches for part in by_bytes(whole, 0, PART)):
            tokens = Tokens.of(batch.column(0))
            held.append((tokens.hashes[tokens.bounds[:-1]], batch.column(1).to_numpy()))
            size += batch.num_rows
            if size > GATHER:
                yield _blobs(segments, *map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            yield _blobs(segments, *map(np.concatenate, zip(*held)))

    def build(table: pa.Table) -> pa.Table:
        grams = np.frombuffer(b"".join(table.column("grams").to_pylist()), np.uint64)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int64)
        bits = build_segment(grams, counts)
        del grams, counts
        pa.default_memory_pool().release_unused()
        return pa.table({"segment": table.column("segment")[:1], "bits": pa.array([bits], pa.binary()), "size": pa.array([len(bits)], pa.int64())})

    schema = "segment bigint, grams binary, counts binary"
    both = map_batches(texts, _released(pairs), schema).union(map_batches(counted, _released(singles), schema))
    return both.groupBy("segment").applyInArrow(build, "segment bigint, bits binary, size bigint")


def _frequent(counted: DataFrame) -> Frequent:
    """The words of the highest counts, as many as one broadcast may hold: those above a power of GROWTH."""
    power = F.floor(F.log("n") / float(np.log(GROWTH)))
    least, words = 1 << 62, 0
    for r in sorted(counted.groupBy(power.alias("power")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r["power"]):
        words += r["words"]
        if words > FREQUENT:
            break
        least = r["power"]
    found = counted.where(power >= least).select("word", "n").toArrow().combine_chunks()
    return Frequent.of(found.column("word").combine_chunks(), found.column("n").to_numpy())


def exact_counts(tokens: Tokens, which: np.ndarray, found: np.ndarray, frequent: Frequent) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.ListArray]:
    """For each text its tokens, those that are frequent words, the sum of their logs, and a list of (word, times) of all others.

    `which` numbers the distinct hashes and `found` says which frequent word has each. Words whose hashes clash are told apart.
    """
    begins, n_tokens = tokens.bounds[:-1], np.diff(tokens.bounds)
    logs, known = np.zeros(len(which)), np.zeros(len(which), np.int64)
    at = np.flatnonzero(found[which] >= 0)
    at = at[same_words(tokens, at, frequent.words, found[which[at]])]
    logs[at], known[at] = frequent.logs[found[which[at]]], 1
    rare = np.flatnonzero(known == 0)
    one = np.zeros(len(found), np.int64)
    one[which[rare]] = rare
    row = np.repeat(np.arange(len(begins)), n_tokens)
    same = same_words(tokens, rare, tokens, one[which[rare]])
    keys, times = np.unique(row[rare[same]] * len(found) + which[rare[same]], return_counts=True)
    clash = rare[~same]
    rows, words = np.concatenate([keys // len(found), row[clash]]), np.concatenate([one[keys % len(found)], clash])
    times = np.concatenate([times, np.ones(len(clash), np.int64)])
    order = np.argsort(rows, kind="stable")
    pairs = pa.StructArray.from_arrays([pa.array(tokens.words(words[order]), pa.binary()).cast(pa.string()), pa.array(times[order], pa.int64())], names=["word", "times"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[order], np.arange(len(begins) + 1)), pa.int32()), pairs)
    return n_tokens, np.add.reduceat(known, begins), np.add.reduceat(logs, begins), lists


_LEVELS = "__row bigint, __training boolean, words binary, pairs binary"
_COUNTS = "n_tokens bigint, n_known bigint, log_sum double, rest array<struct<word:string,times:bigint>>"


def _probed(rows: DataFrame, stored: DataFrame, frequent: Frequent, segments: int) -> tuple[DataFrame, DataFrame]:
    """Levels and counts of the texts, which are read once per slice of the filter.

    Levels: `__row`, `__training`, `words` and `pairs` (a level in each byte, for every token of the text). Counts: `__row`
    and what `exact_counts` gives.
    """
    spark = rows.sparkSession
    sizes = sorted((r["segment"], r["size"]) for r in stored.select("segment", "size").collect())
    slices: list[list[int]] = [[]]
    used = 0
    for s, size in sizes:
        if used + size > FILTER_BYTES and slices[-1]:
            slices.append([])
            used = 0
        slices[-1].append(s)
        used += size

    def probe(shared, counts: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, frequent, of_frequent = shared.value
            for batch in (part for whole in batches for part in by_bytes(whole, 2, PART)):
                tokens = Tokens.of(batch.column(2))
                # Texts of the training rows were counted, so that every n-gram of theirs has level 1.
                training = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(tokens.bounds))

                def distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                    grams, which = np.unique(grams, return_inverse=True)
                    counted = np.zeros(len(grams), bool)
                    counted[which[training]] = True
                    return grams, which, counted

                grams, which, counted = distinct(tokens.hashes)
                found = frequent.find(grams)
                levels, rare = np.zeros(len(grams), np.uint8), found < 0
                levels[~rare] = of_frequent[found[~rare]]
                levels[rare] = known.distinct_levels(grams[rare], counted[rare])
                words = levels[which]
                base = [pa.array(x) for x in exact_counts(tokens, which, found, frequent)] if counts else []
                grams, which, counted = distinct(tokens.pairs())
                pairs = known.remembered_levels(grams, counted)[which]
                ends = tokens.bounds.tolist()
                cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], cut(words), cut(pairs), *base], names=names[: 4 + len(base)])

        names = ["__row", "__training", "words", "pairs", "n_tokens", "n_known", "log_sum", "rest"]
        return run

    def sent(part: list[int]):
        """Broadcast of a slice of the filter; the driver does not keep it."""
        bits = stored.where(F.col("segment").between(part[0], part[-1])).select("segment", "bits").toLocalIterator() if part else ()
        here = {s: size for s, size in sizes if part and part[0] <= s <= part[-1]}
        known = BloomFilter.of(here, ((r["segment"], r["bits"]) for r in bits), segments)
        return spark.sparkContext.broadcast((known, frequent, known.levels(frequent.words.hashes)))

    out = []
    for part in slices:
        shared = sent(part)
        schema = _LEVELS if out else f"{_LEVELS}, {_COUNTS}"
        out.append(materialize(map_batches(rows.select("__row", "__training", "__text"), _released(probe(shared, not out)), schema), "levels"))
        shared.destroy()
    counts = out[0].select("__row", "n_tokens", "n_known", "log_sum", "rest")
    levels = [x.select("__row", "__training", "words", "pairs") for x in out]
    if len(levels) == 1:
        return levels[0], counts

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        highest = lambda parts: np.max([np.frombuffer(p, np.uint8) for p in parts], axis=0).tobytes()
        for batch in batches:
            merged = [pa.array([highest(parts) for parts in batch.column(c).to_pylist()], pa.binary()) for c in (2, 3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *merged], names=["__row", "__training", "words", "pairs"])

    # A level is in one slice and 0 in all others.
    union = levels[0]
    for more in levels[1:]:
        union = union.union(more)
    gathered = union.groupBy("__row", "__training").agg(F.collect_list("words").alias("words"), F.collect_list("pairs").alias("pairs"))
    return materialize(map_batches(gathered, merge, _LEVELS), "merged-levels"), counts


def _parts(words: pa.Array, pairs: pa.Array, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts after each other the levels of the tokens, of the pairs and of the words before, and where each text begins."""
    ends = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
    begins = np.append(0, ends[:-1])
    w, p = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).astype(np.int64) for x in (words, pairs))
    before = np.append(0, w[:-1])
    before[begins] = level_of(np.array([texts]))
    return w, p, before, begins


def _votes(tokens: int, texts: int):
    """Deleted interpolation: for each level of the word before, how many tokens the pair foretells better than the word alone, its own occurrence left out."""
    level = np.arange(len(LEAST))
    # By the level of the word before in rows, of the pair in columns.
    of_pair = (rounded_down(level) - 1) / np.maximum(rounded_up(level) - 1, 1)[:, None]
    of_word = (rounded_down(level) - 1) / max(tokens - 1, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(LEAST)), np.int64)
        for batch in (part for whole in batches for part in by_bytes(whole, 0, TOKENS)):
            w, p, before, _ = _parts(*batch.columns, texts)
            better = of_pair[before, p] > of_word[w]
            sums += np.bincount(better * len(LEAST) + before, minlength=2 * len(LEAST)).reshape(2, -1)
        at = np.flatnonzero(sums.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[0, at]), pa.array(sums[1, at])], names=["level", "word", "pair"])

    return run


def _scored(weights: np.ndarray, tokens: int, types: int, texts: int):
    level = np.arange(len(LEAST))
    # By the level of the word before in rows, of the pair or the word in columns.
    of_pair = weights[:, None] * np.minimum(rounded_down(level) / np.maximum(rounded_up(level), 1)[:, None], 1.0)
    of_word = (1 - weights[:, None]) * (rounded_down(level) + 1) / (tokens + types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in by_bytes(whole, 1, TOKENS)):
            w, p, before, begins = _parts(*batch.columns[1:], texts)
            out = np.add.reduceat(np.log10(of_pair[before, p] + of_word[before, w]), begins)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["__row", "score"])

    return run


def _base(counts: DataFrame, counted: DataFrame) -> DataFrame:
    """`__row`, `n_tokens`, `n_known`, `log_sum` (sum of log10(c + 1)): to what the frequent words give, the others add by a join on the word."""
    rare = counts.select("__row", F.inline("rest")).join(counted, "word")
    known = rare.groupBy("__row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_log"))
    return counts.drop("rest").join(known, "__row", "left").select(
        "__row",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("log_sum") + F.coalesce("more_log", F.lit(0.0))).alias("log_sum"),
    )


def score(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """Score every whole text with a model of the rows that meet `training`.

    Returns the key, the columns of `keep`, `n_tokens`, `n_known` (tokens that training holds), `train_tokens`,
    `base_score` (add-one log10 probability of the tokens from exact counts) and `score` (log10 probability of the text under
    the pair model). A null text is empty: one token, its end. Without training rows every count is 0. Repeated rows and
    keys are each scored; other columns are left out.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kept = keep or {}
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("__text"), F.coalesce(training, F.lit(False)).alias("__training"), *[c.alias(n) for n, c in kept.items()], F.monotonically_increasing_id().alias("__row"))
    rows = materialize(rows, "texts")
    texts = rows.where("__training").select("__text")
    with small_batches(spark):
        counted = materialize(word_counts(texts), "word-counts")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("types"), F.coalesce(F.max(F.when(F.col("word") == "", F.col("n"))), F.lit(0)).alias("texts")).first()
    tokens, types, n_texts = total["n"], total["types"], total["texts"]
    segments = max(1, -(-tokens // SEGMENT))
    frequent = _frequent(counted)
    with small_batches(spark):
        stored = materialize(filter_segments(texts, counted, segments), "filter")
        levels, counts = _probed(rows, stored, frequent, segments)
    voted = map_batches(levels.where("__training").select("words", "pairs"), _votes(tokens, n_texts), "level bigint, word bigint, pair bigint")
    weights = np.zeros(len(LEAST))
    for r in voted.groupBy("level").agg(F.sum("word").alias("word"), F.sum("pair").alias("pair")).collect():
        weights[r["level"]] = r["pair"] / (r["word"] + r["pair"])
    weights = np.minimum(weights, 0.999)
    scored = map_batches(levels.select("__row", "words", "pairs"), _scored(weights, tokens, types, n_texts), "__row bigint, score double")
    base = _base(counts, counted)
    joined = rows.drop("__text", "__training").join(base, "__row").join(scored, "__row")
    smallest = float(np.log10(tokens + types + 1))
    return joined.select(key, *kept, "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), (F.col("log_sum") - F.col("n_tokens") * smallest).alias("base_score"), "score")
