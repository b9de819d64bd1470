"""URL filter: rules by host and path, and a character language-model ratio where no rule fits.

URLs that a rule allows or blocks teach two smoothed variable-order Markov models over
characters, one of accepted and one of rejected URLs. A URL without a rule is judged by the
difference of its log-likelihoods per character against a threshold calibrated on labelled
URLs that the models have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import map_batches, strings

#: The rules of the contract, as (verdict, host and path).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Longest context; shorter ones are used where a context was seen fewer than LEAST times.
ORDER = 3
LEAST = 4
#: Strength of the shorter context's estimate.
PRIOR = 4.0
SYMBOLS = 40
#: a-z, 0-9, dot, hyphen, slash, all others.
_SYMBOL = np.full(256, SYMBOLS - 1, np.int64)
for _c in range(256):
    if chr(_c).isascii() and chr(_c).isalnum():
        _SYMBOL[_c] = "abcdefghijklmnopqrstuvwxyz0123456789".index(chr(_c).lower())
for _n, _c in enumerate(".-/"):
    _SYMBOL[ord(_c)] = 36 + _n
_SYMBOL[32] = SYMBOLS - 1


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or url."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://` or url."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]] | None = None) -> tuple[Column, Column]:
    """The longest rule that fits (null if none) and its verdict; of rules equally long the first in text order."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule in sorted(rules if rules is not None else RULES, key=lambda x: (len(x[1]), [-ord(c) for c in x[1]])):
        of_host, slash, of_path = rule.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(slash + of_path)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each behind ORDER separators, and the positions of those that are predicted."""
    pad = b" " * ORDER
    raw = [pad + t.encode("utf-8", "replace") for t in texts]
    flat = _SYMBOL[np.frombuffer(b"".join(raw), np.uint8)]
    sizes = np.array([len(r) for r in raw], np.int64)
    starts = np.cumsum(sizes) - sizes
    first = np.zeros(len(flat), np.int64)
    first[starts] = 1
    inside = np.arange(len(flat)) - starts[np.cumsum(first) - 1]
    return flat, np.flatnonzero(inside >= ORDER)


def _grams(flat: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """Numbers of the grams of order + 1 symbols that end at the given positions."""
    gram = flat[at - order] if order else flat[at]
    for k in range(order - 1, -1, -1):
        gram = gram * SYMBOLS + flat[at - k]
    return gram


@dataclass
class UrlModel:
    """`ratio` holds log P(accepted) - log P(rejected) of a symbol after the ORDER symbols before it: 40^4 numbers at most."""

    ratio: np.ndarray
    threshold: float

    def score(self, texts: list[str]) -> np.ndarray:
        """Difference of the log-likelihoods per character; 0 for an empty text."""
        if not texts:
            return np.zeros(0)
        flat, at = _symbols(texts)
        sizes = np.array([len(t.encode("utf-8", "replace")) for t in texts])
        owner = np.repeat(np.arange(len(texts)), sizes)
        sums = np.bincount(owner, self.ratio[_grams(flat, at, ORDER)], minlength=len(texts))
        return np.round(sums / np.maximum(sizes, 1), 9)


def _log_prob(counts: list[np.ndarray]) -> np.ndarray:
    """Smoothed log-probabilities of the longest order: each order is mixed with the next shorter one,
    and contexts seen fewer than LEAST times leave all to it."""
    prob = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order, n in enumerate(counts):
        table = n.reshape(-1, SYMBOLS)
        shorter = np.tile(prob.reshape(-1, SYMBOLS), (SYMBOLS, 1)) if order else prob.reshape(1, SYMBOLS)
        seen = table.sum(1, keepdims=True)
        prob = np.where(seen >= LEAST, (table + PRIOR * shorter) / (seen + PRIOR), shorter).ravel()
    return np.log(prob)


def train(labelled: DataFrame, address: str = "address", verdict: str = "verdict") -> UrlModel:
    """Fit the two models on four fifths of the labelled URLs (by CRC-32 of the address) and the threshold on the others.

    Counts cover all rows; the driver gets at most 2 x (40 + 40^2 + 40^3 + 40^4) of them, and the calibration
    histogram. With no rejected URL everything is accepted, with rejected ones only nothing is.
    """
    rows = labelled.select(
        (F.col(verdict) == "allow").cast("int").alias("label"),
        (F.crc32(F.col(address).cast("binary")) % 5 == 0).alias("calibrate"),
        F.col(address).alias("address"),
    ).where(F.col("label").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            label, texts = np.array(batch.column(0).to_pylist(), int), strings(batch.column(1))
            for x in (0, 1):
                own = [t for t, y in zip(texts, label) if y == x]
                if own:
                    flat, at = _symbols(own)
                    for order in range(ORDER + 1):
                        gram, n = np.unique(_grams(flat, at, order), return_counts=True)
                        sums.setdefault((x, order), np.zeros(SYMBOLS ** (order + 1), np.int64))[gram] += n
        for (x, order), n in sums.items():
            gram = np.flatnonzero(n)
            same = [pa.array(np.full(len(gram), v, np.int32)) for v in (x, order)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(gram, pa.int64()), pa.array(n[gram], pa.int64())], names=["label", "ngram", "gram", "n"])

    counted = map_batches(rows.where(~F.col("calibrate")).select("label", "address"), count, "label int, ngram int, gram bigint, n bigint")
    got = counted.groupBy("label", "ngram", "gram").agg(F.sum("n").alias("n")).toPandas()
    log_prob, size = [], []
    for label in (0, 1):
        counts = []
        for order in range(ORDER + 1):
            own = got[(got["label"] == label) & (got["ngram"] == order)]
            n = np.zeros(SYMBOLS ** (order + 1))
            n[own["gram"].to_numpy(int)] = own["n"].to_numpy(float)
            counts.append(n)
        size.append(counts[0].sum())
        log_prob.append(_log_prob(counts))
    if not size[0] or not size[1]:
        return UrlModel(np.zeros(SYMBOLS ** (ORDER + 1)), np.inf if size[0] else -np.inf)
    model = UrlModel(log_prob[1] - log_prob[0], 0.0)
    scored = score(rows.where("calibrate"), model, "address").groupBy("label", F.round("score", 3).alias("score")).agg(F.count("*").alias("n")).toPandas()
    model.threshold = _threshold(scored["score"].to_numpy(float), scored["label"].to_numpy(int), scored["n"].to_numpy(float))
    return model


def _threshold(value: np.ndarray, label: np.ndarray, n: np.ndarray) -> float:
    """The cut with the least balanced error, in the middle between two seen scores; 0 if one side is missing."""
    if len(set(label)) < 2:
        return 0.0
    seen = np.unique(value)
    cuts = np.concatenate([[seen[0] - 1], (seen[1:] + seen[:-1]) / 2, [seen[-1] + 1]])
    order = np.argsort(value, kind="stable")
    below = {}
    for x in (0, 1):
        w = np.where(label == x, n, 0.0)[order]
        below[x] = np.concatenate([[0.0], np.cumsum(w)])[np.searchsorted(value[order], cuts)] / w.sum()
    error = below[1] + (1 - below[0])
    best = np.flatnonzero(np.isclose(error, error.min()))
    return float(np.round(cuts[best[np.abs(cuts[best]).argmin()]], 6))


def score(df: DataFrame, model: UrlModel, address: str, column: str = "score") -> DataFrame:
    """The rows with the ratio per character of `address` (null: empty) in the last column."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    k = df.columns.index(address)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(shared.value.score(strings(batch.column(k))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, column])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return map_batches(df, run, f"{fields}, `{column}` double")


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """Verdict on every row's URL: the longest rule's, else the models'.

    Returns the key, `url`, `host`, `path`, `rule` (null if none fits), `verdict` (allow or block) and `score`
    (log-likelihood ratio per character; above the threshold is better). A null URL, or one without `://`,
    has an empty host and path and is judged with score 0. Repeated rows each get their verdict; other columns
    are left out. No rows give no rows.
    """
    said = F.col(url).cast("string")
    rows = pages.select(F.col(key), said.alias("url"), host_of(said).alias("host"), path_of(said).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "by_rule": verdict})
    # The models read all of the URL behind its scheme, query and fragment included.
    behind = F.substring(F.col("url"), F.instr("url", "://") + 3, F.length("url"))
    address = F.concat("host", F.substring(behind, F.length("host") + 1, F.length("url")))
    rows = rows.withColumn("__address", F.when(F.contains("url", F.lit("://")), address).otherwise(""))
    model = train(rows.where(F.col("by_rule").isNotNull()), "__address", "by_rule")
    judged = score(rows, model, "__address")
    by_model = F.when(F.col("score") >= F.lit(model.threshold), "allow").otherwise("block")
    return judged.select(key, "url", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "score")
