"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of ordinary text and one on windows
that stand out in toxic text. Every window of a text (a word with its boundaries; longer runs
of letters are cut) is compressed with the ordinary dictionary alone and with the toxic one in
front of it: what it saves is the window's excess. A text's excesses, over calibrated
thresholds, give its score through a logistic fit.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import map_batches, strings

#: Longest window in characters; remembered windows; bytes of the two dictionaries.
WINDOW = 48
REMEMBERED = 1 << 18
TOXIC_BYTES, ORDINARY_BYTES = 4096, 16384
#: Windows that the driver trains the dictionaries on at most, and labelled texts that the fit uses, about.
TOXIC_WINDOWS, ORDINARY_WINDOWS, FIT_ROWS = 8192, 20_000, 20_000
#: Copies of the strongest toxic window among the samples; others have fewer, by their strength.
TOXIC_COPIES = 100
#: Standard deviations by which a window must exceed its expected number of contexts in toxic text, and how many
#: times as large its share of all contexts there must be as in ordinary text.
STANDS_OUT, RATIO = 6.0, 2.0
WORDS = re.compile(rf"[^\W\d_]{{1,{WINDOW}}}")
#: Distinct contexts of a window are counted by bits, so that copies of one text count once: a context falls into
#: level k with probability 2^-(k+1) and sets one of its 64 bits. Levels with more than FULL bits are not read.
BITS, LEVELS, FULL = 64, 40, 48


def windows(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def _samples(times: dict[str, int]) -> list[bytes]:
    """Each window as often as given, in an order that keeps its copies apart and is the same in every run."""
    copies = [(zlib.crc32(f"{k} {w}".encode()), f" {w} ".encode()) for w, n in times.items() for k in range(n)]
    return [sample for _, sample in sorted(copies)]


def _train(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of the samples; where they are too few to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


@dataclass
class ToxicityModel:
    """The two dictionaries, and the weights of the fit; plain data, so it can be sent to workers."""

    toxic: bytes
    ordinary: bytes
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def _compressor(self, dictionary: bytes) -> zstandard.ZstdCompressor:
        how = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_LAZY2, min_match=5, window_log=16, hash_log=15, chain_log=15, search_log=5, target_length=16, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        raw = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=raw, compression_params=how)

    def __post_init__(self) -> None:
        self._begin()

    def _begin(self) -> None:
        self._pair = (self._compressor(self.ordinary), self._compressor(self.toxic + self.ordinary)) if self.toxic and self.ordinary else None
        self._known: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_pair", "_known")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._begin()

    def excess(self, text: str) -> np.ndarray:
        """Bytes that each window of the text saves with the toxic dictionary."""
        found = windows(text)
        if self._pair is None or not found:
            return np.zeros(len(found), int)
        if len(self._known) > REMEMBERED:
            self._known.clear()
        new = [w for w in set(found) if w not in self._known]
        if new:
            # Around the window stand bytes that both dictionaries know: a compressor looks for no match in its last few bytes.
            before, after = self.ordinary[-24:], self.ordinary[-24:-8]
            padded = [before + f" {w} ".encode() + after for w in new]
            lengths = [[len(x) for x in c.multi_compress_to_buffer(padded)] for c in self._pair]
            self._known.update(zip(new, (a - b for a, b in zip(*lengths)), strict=True))
        return np.array([self._known[w] for w in found])

    def features(self, text: str) -> list[float]:
        e = self.excess(text)
        if not len(e):
            return [1.0] + [0.0] * 8
        n = len(e)
        over = [float(np.maximum(e - t, 0).sum()) for t in range(4)]
        return [1.0, *np.log1p(over).tolist(), float(min(e.max(), 8)), float(np.log1p(n)), min(1000 * over[1] / n, 50.0), min(1000 * over[2] / n, 50.0)]

    def fit(self, x: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> None:
        """Logistic regression by Newton steps with a small ridge; a row counts as often as `times` says."""
        times = np.ones(len(y)) if times is None else times
        self.mean = np.average(x, axis=0, weights=times)
        spread = np.sqrt(np.average((x - self.mean) ** 2, axis=0, weights=times))
        self.scale = np.where(spread > 0, spread, 1.0)
        self.mean[0], self.scale[0] = 0.0, 1.0
        z, ridge = (x - self.mean) / self.scale, 1e-2
        w = np.zeros(x.shape[1])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z.T * (times * p * (1 - p))) @ z + ridge * np.eye(len(w)), z.T @ (times * (y - p)) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.weight = w

    def score(self, text: str) -> tuple[float, int]:
        """Probability of label 1, and the number of windows that save more than two bytes."""
        if not len(self.weight):
            return 0.0, 0
        x = np.array(self.features(text))
        p = 1 / (1 + np.exp(-np.clip(((x - self.mean) / self.scale) @ self.weight, -30, 30)))
        return round(float(p), 9), int((self.excess(text) > 2).sum()) if x[3] else 0


def _context_bit(before: int) -> int:
    """The bit of a context, the hashes of the two words before a window: its level times BITS, plus a place in it."""
    x = before * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
    x ^= x >> 32
    return 1 << min((x & -x).bit_length() - 1 if x else LEVELS, LEVELS) * BITS + (x >> 58)


def _distinct(levels: str, label: str) -> Column:
    """Estimated number of contexts behind the bits set per level, to about a tenth, whatever their number."""
    of = f"transform({levels}, v -> struct(v.level as level, v.{label} as bits))"
    base = f"coalesce(array_max(transform(filter({of}, v -> v.bits > {FULL}), v -> v.level)) + 1, 0)"
    # The last level takes all that is left; there its bits are read even if they are many.
    base = f"least({base}, {LEVELS})"
    read = f"transform(filter({of}, v -> v.level >= {base}), v -> -{BITS} * ln(1 - least(v.bits, {BITS - 1}) / {BITS}))"
    return F.expr(f"cast(round(pow(2, {base}) * aggregate({read}, 0d, (a, v) -> a + v)) as bigint)")


def window_contexts(labelled: DataFrame, text: str, toxic: str) -> DataFrame:
    """`window`, `in_toxic`, `in_ordinary` (estimated distinct pairs of words before it), `n_toxic`, `n_ordinary` (occurrences) over all labelled rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        seen: tuple[dict[str, int], dict[str, int]] = ({}, {})
        times: tuple[dict[str, int], dict[str, int]] = ({}, {})

        def rows() -> Iterator[pa.RecordBatch]:
            words, levels, bits, occurrences = [], [], ([], []), ([], [])
            for w in seen[0].keys() | seen[1].keys():
                both, level = [s.get(w, 0) for s in seen], 0
                often = [x.get(w, 0) for x in times]
                while both[0] or both[1]:
                    if any(part := [b & 0xFFFFFFFFFFFFFFFF for b in both]):
                        words.append(w)
                        levels.append(level)
                        for y in (0, 1):
                            bits[y].append(part[y])
                            occurrences[y].append(often[y])
                        often = [0, 0]
                    both, level = [b >> BITS for b in both], level + 1
            signed = [pa.array(np.array(b, np.uint64).view(np.int64)) for b in bits]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(levels, pa.int32()), *signed, *(pa.array(x, pa.int64()) for x in occurrences)], names=["window", "level", "ordinary", "toxic", "n_ordinary", "n_toxic"]
            )

        for batch in batches:
            for t, y in zip(strings(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                own, often, before = seen[y], times[y], 0
                for w in windows(t):
                    own[w] = own.get(w, 0) | _context_bit(before)
                    often[w] = often.get(w, 0) + 1
                    if (h := known.get(w)) is None:
                        h = known[w] = zlib.crc32(w.encode())
                    before = (before << 32 | h) & 0xFFFFFFFFFFFFFFFF
                if len(known) + len(seen[0]) + len(seen[1]) > REMEMBERED:
                    yield from rows()
                    for x in (known, *seen, *times):
                        x.clear()
        if seen[0] or seen[1]:
            yield from rows()

    schema = "window string, level int, ordinary bigint, toxic bigint, n_ordinary bigint, n_toxic bigint"
    found = map_batches(labelled.select(F.col(text).cast("string"), F.col(toxic).cast("int")), count, schema)
    sums = [F.sum("n_ordinary").alias("n_ordinary"), F.sum("n_toxic").alias("n_toxic")]
    merged = found.groupBy("window", "level").agg(F.bit_or("ordinary").alias("ordinary"), F.bit_or("toxic").alias("toxic"), *sums)
    level = F.struct("level", F.bit_count("ordinary").alias("ordinary"), F.bit_count("toxic").alias("toxic"))
    whole = merged.groupBy("window").agg(F.array_sort(F.collect_list(level)).alias("levels"), *sums)
    return whole.select("window", _distinct("levels", "toxic").alias("in_toxic"), _distinct("levels", "ordinary").alias("in_ordinary"), "n_ordinary", "n_toxic")


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> ToxicityModel:
    """Dictionaries and fit from labelled rows (`toxic` 0 or 1; other values and null are left out).

    Window counts cover all labelled rows; the dictionaries are trained on the TOXIC_WINDOWS windows that stand
    out most, weighted by how far they do, and on ordinary ones that make up at least one in ORDINARY_WINDOWS of all;
    the logistic fit uses all labelled rows up to about FIT_ROWS, of more about half as many per label, chosen by a hash
    of their key and weighted back to the labels' shares. Without rows of both labels every score is 0.
    """
    rows = labelled.where(F.col(toxic).isin(0, 1))
    share = rows.agg(F.sum(toxic).alias("toxic"), F.count("*").alias("n")).first()
    if not share["n"] or not share["toxic"] or share["toxic"] == share["n"]:
        return ToxicityModel(b"", b"")
    contexts = window_contexts(rows, text, toxic).persist()
    sums = contexts.agg(F.sum("in_toxic").alias("t"), F.sum("in_ordinary").alias("o"), F.sum("n_ordinary").alias("n")).first()
    expected = (F.col("in_toxic") + F.col("in_ordinary")) * (sums["t"] / ((sums["t"] + sums["o"]) or 1))
    more = F.col("in_toxic") * float(sums["o"] or 0) > F.col("in_ordinary") * (RATIO * (sums["t"] or 0))
    stands_out = (F.length("window") >= 3) & more & (F.col("in_toxic") - expected > STANDS_OUT * F.sqrt(expected))
    found = contexts.where(stands_out)
    strength = ((F.col("in_toxic") - expected) / F.sqrt(expected)).alias("strength")
    worst = found.select("window", strength).orderBy(F.desc("strength"), "window").limit(TOXIC_WINDOWS).collect()
    # No more windows than this number can have such a share of all occurrences.
    usual = sorted(contexts.where(F.col("n_ordinary") * ORDINARY_WINDOWS >= sums["n"]).collect(), key=lambda r: r["window"])
    contexts.unpersist()
    toxic_samples = _samples({r["window"]: max(1, round(TOXIC_COPIES * r["strength"] / worst[0]["strength"])) for r in worst})
    # A window that stands out must not be known to the ordinary dictionary too, which would leave it no excess.
    apart = {r["window"] for r in worst}
    usual_samples = _samples({r["window"]: min(r["n_ordinary"], 4) for r in usual if r["window"] not in apart})
    model = ToxicityModel(_train(toxic_samples, TOXIC_BYTES) if worst else b"", _train(usual_samples, ORDINARY_BYTES))
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [shared.value.features(t) for t in strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    sample = rows.select(F.col(toxic).cast("int").alias("y"), F.col(text).cast("string").alias("text"), F.xxhash64(key).alias("h"))
    total = (share["n"] - share["toxic"], share["toxic"])
    parts = [1.0 if share["n"] <= FIT_ROWS else min(1.0, FIT_ROWS / 2 / n) for n in total]
    chosen = F.pmod("h", F.lit(1 << 30)) < F.when(F.col("y") == 1, int(parts[1] * (1 << 30))).otherwise(int(parts[0] * (1 << 30)))
    got = map_batches(sample.where(chosen).select("y", "text"), measure, "y int, x array<double>").collect()
    x, y = np.array([r["x"] for r in got]), np.array([r["y"] for r in got], float)
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order]
    # Each label weighs as many rows as it has, scaled to the number of rows of the fit.
    times = np.where(y == 1, share["toxic"] / max(y.sum(), 1), (share["n"] - share["toxic"]) / max((1 - y).sum(), 1)) * len(y) / share["n"]
    model.fit(x, y, times)
    return model


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Toxicity of every whole text: the key, the columns of `keep`, `score` (0 to 1), `predicted` (1 if score >= 0.5)
    and `toxic_windows`. Null and empty texts are scored as texts without windows; repeated rows are each scored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [key, *(c for c in keep or [] if c != key)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(t) for t in strings(batch.column(len(keep)))]
            out = [pa.array([s for s, _ in found], pa.float64()), pa.array([int(s >= 0.5) for s, _ in found], pa.int32()), pa.array([n for _, n in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), *out], names=[*keep, "score", "predicted", "toxic_windows"])

    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return map_batches(docs.select(*keep, docs[text].cast("string").alias("__text")), run, kept + "score double, predicted int, toxic_windows bigint")

