"""Language identification by mixture inference over n-gram likelihoods.

Every language is a distribution over hashed letter trigrams, counted by Spark over all
training texts. A document is a mixture: expectation-maximisation estimates which share of
its trigrams each language wrote, and the set of languages is chosen by penalised
likelihood, so that a second language needs enough evidence to be named.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import map_batches, strings

#: Cells that trigrams are hashed into; the model is this many numbers per language.
CELLS = 8192
#: Letters proper: no digits, numerals, marks or symbols.
LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"
#: Overlapping trigrams repeat each other's evidence: one in so many counts as an observation.
OVERLAP = 3.0
#: Byte classes: lower-case ASCII letters and bytes of other scripts stand for themselves, all others are one separator.
_CLASS = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint32)
#: Bytes of texts that are worked on at a time.
CHUNK = 1 << 20


def trigram_counts(texts: list[str]) -> Iterator[np.ndarray]:
    """For each text the counts of its hashed, lower-cased byte trigrams (those that hold a letter)."""
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) <= CHUNK):
            size += len(texts[end])
            end += 1
        raw = [f" {t} ".lower().encode("utf-8", "replace") for t in texts[begin:end]]
        flat = _CLASS[np.frombuffer(b"".join(raw), np.uint8)]
        cells = ((flat[:-2] * np.uint32(0x9E3779B1) ^ flat[1:-1] * np.uint32(0x85EBCA77) ^ flat[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)) >> np.uint32(19)
        blank = (flat[1:-1] == 32) & ((flat[:-2] == 32) | (flat[2:] == 32))
        cells = np.where(blank, CELLS, cells).astype(np.int64)
        at = 0
        for part in raw:
            yield np.bincount(cells[at : at + len(part) - 2], minlength=CELLS + 1)[:CELLS]
            at += len(part)
        begin = end


@dataclass
class LanguageModel:
    """Log-probabilities of trigram cells by language; `languages` is sorted, so ties have one order."""

    languages: list[str]
    log_prob: np.ndarray

    def __post_init__(self) -> None:
        self.prob = np.exp(self.log_prob)

    def _mixture(self, prob: np.ndarray, counts: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, float]:
        """Shares of the given languages by expectation-maximisation, and the log-likelihood."""
        share, total = np.full(len(prob), 1.0 / len(prob)), counts.sum()
        mixed = share @ prob
        for _ in range(rounds):
            new = share * (prob @ (counts / mixed)) / total
            moved = np.abs(new - share).max()
            share, mixed = new, new @ prob
            if moved < 1e-3:
                break
        return share, float(counts @ np.log(mixed))

    def infer(self, counts: np.ndarray) -> list[tuple[int, float]]:
        """(language number, share) of the chosen set, largest share first; empty if there are no trigrams or languages."""
        cells = np.flatnonzero(counts)
        if not len(cells) or not self.languages:
            return []
        n = counts[cells].astype(float)
        prob = self.prob[:, cells]
        share, full = self._mixture(prob, n)
        order = np.lexsort((np.arange(len(share)), -np.round(share, 9)))
        penalty = 0.5 * np.log(n.sum() + 1.0)
        best, value = None, -np.inf
        for k in range(1, len(order) + 1):
            if best is not None and full / OVERLAP - penalty * k <= value:
                break  # no larger set can do better than all languages at this penalty
            these = order[:k]
            shares, likelihood = (np.ones(1), float(self.log_prob[these[0], cells] @ n)) if k == 1 else self._mixture(prob[these], n)
            if (worth := likelihood / OVERLAP - penalty * k) > value:
                best, value = (these, shares), worth
        these, shares = best
        return sorted(((int(a), float(b)) for a, b in zip(these, shares)), key=lambda x: (-round(x[1], 9), x[0]))


def train(docs: DataFrame, where: Column, text: str = "text", lang: str = "lang", smoothing: float = 0.1) -> LanguageModel:
    """Count trigrams of all rows that meet `where` and have a language. The driver gets languages x cells numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for name, counts in zip(langs, trigram_counts(strings(batch.column(1))), strict=True):
                if name in sums:
                    sums[name] += counts
                else:
                    sums[name] = counts.astype(np.int64)
        for name, counts in sums.items():
            cells = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(cells), pa.string()), pa.array(cells, pa.int32()), pa.array(counts[cells], pa.int64())], names=["lang", "cell", "n"])

    rows = docs.where(where & F.col(lang).isNotNull()).select(F.col(lang).cast("string"), F.col(text).cast("string"))
    counted = map_batches(rows, count, "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(counted["lang"]))
    counts = np.zeros((len(languages), CELLS))
    number = {x: k for k, x in enumerate(languages)}
    counts[counted["lang"].map(number).to_numpy(int), counted["cell"].to_numpy(int)] = counted["n"].to_numpy(float)
    counts += smoothing
    return LanguageModel(languages, np.log(counts / counts.sum(1, keepdims=True)))


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The language mixture of every whole text.

    Returns the key, the columns of `keep`, `lang_pred` (language of the largest share; `und` if the text
    is null or has no letter, or if no language was learned), `score` (its share, 0 for `und`),
    `languages` and `shares` (the chosen set, largest share first; equal shares in order of name).
    Rows are neither dropped nor merged; the columns `lang`, `source` and the key are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [key, *(c for c in keep or [] if c != key)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            texts = strings(batch.column(len(keep)))
            found = []
            for t, counts in zip(texts, trigram_counts(texts), strict=True):
                found.append(learned.infer(counts) if LETTER.search(t) else [])
            out = [
                pa.array([learned.languages[x[0][0]] if x else UNDETERMINED for x in found], pa.string()),
                pa.array([min(1.0, x[0][1]) if x else 0.0 for x in found], pa.float64()),
                pa.array([[learned.languages[k] for k, _ in x] for x in found], pa.list_(pa.string())),
                pa.array([[s for _, s in x] for x in found], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), *out], names=names)

    names = [*keep, "lang_pred", "score", "languages", "shares"]
    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    rows = docs.select(*keep, docs[text].cast("string").alias("__text"))
    return map_batches(rows, run, kept + "lang_pred string, score double, languages array<string>, shares array<double>")
