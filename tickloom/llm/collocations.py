"""Phrases whose words keep company, counted exactly through double-array tries of Apriori-safe candidates.

Words that occur often enough are numbered; texts are stored once as runs of these numbers. Level by level, a
phrase of k + 1 words is a candidate only if its first k words are one of the frequent phrases and enough
tasks together saw it follow them: whatever is not, cannot be frequent. The candidates of a level, in order, are cut into shards of bounded
size; each becomes a double-array trie that is broadcast. In a task numpy moves the states of all text positions one
word at a time, and counts the accepting states they end in; Spark sums the counts of all tasks and shards.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.llm.common import by_bytes, map_batches, ship_package, with_positions
from tickloom.session import materialize

#: Occurrences that make a phrase a candidate, words of the longest, and phrases of a report.
LEAST, LONGEST, TOP = 100, 5, 2000
#: A phrase goes if a longer one has this share of its occurrences, in percent.
SHARE = 100
#: Words of one broadcast dictionary, and phrases of one broadcast trie.
DICTIONARY, SHARD = 1 << 20, 1 << 18
#: Words and followers a worker gathers before it sends them, and bytes of a text that are split at a time.
COUNTED, GATHER, PIECE = 1 << 18, 1 << 22, 1 << 20

#: Upper case becomes lower, a tab a blank, and whatever ends a piece a line feed.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\v\f\r" else b for b in range(256))
BREAK = b"\n"


def _words(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, some at a time; BREAK stands between pieces."""
    data = text.encode().translate(_FOLD)
    begin = 0
    while begin < len(data):
        ends = [x for x in (data.find(b" ", begin + PIECE), data.find(BREAK, begin + PIECE)) if x >= 0]
        end = min(ends) if ends else len(data)
        yield [w for w in data[begin:end].replace(BREAK, b" \n ").split(b" ") if w]
        begin = end


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """`lang`, `word`, `n` of all words of (`lang`, `text`) that occur `least` times; a null word has the number of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, Counter[bytes]] = {}

        def rows(lang: str) -> pa.RecordBatch:
            words = sums.pop(lang)
            words.pop(BREAK, None)
            kinds = pa.array([*words, None], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(kinds)), kinds, pa.array([*words.values(), sum(words.values())], pa.int64())], names=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for words in _words(text.as_py()):
                    sums.setdefault(lang, Counter()).update(words)
                    if len(sums[lang]) > COUNTED:
                        yield rows(lang)
        for lang in list(sums):
            yield rows(lang)

    counted = map_batches(texts, count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= least) | F.col("word").isNull())


def encode(texts: DataFrame, words: DataFrame, dictionary: int = DICTIONARY) -> DataFrame:
    """`ids` (int32 in a binary): the texts as numbers (`pos`) of `words`, -1 where a phrase cannot go on.

    A dictionary of bounded size is broadcast at a time. With more words than that, texts are read once for each dictionary and
    carry what the ones before have found.
    """
    spark, total = texts.sparkSession, words.count()
    slices = max(1, -(-total // dictionary))
    coded = texts.select("lang", "text", F.lit(None).cast("binary").alias("ids"))
    for k in range(slices):
        part = words.where(F.col("pos").between(k * dictionary, (k + 1) * dictionary - 1)).select("lang", "word", "pos").toArrow().to_pydict()
        known: dict[str, dict[bytes, int]] = {}
        for lang, word, pos in zip(part["lang"], part["word"], part["pos"]):
            known.setdefault(lang, {})[word.encode()] = pos
        shared = spark.sparkContext.broadcast(known)
        last = k == slices - 1
        coded = map_batches(coded, _encoder(shared, last), "ids binary" if last else "lang string, text string, ids binary")
        coded = materialize(coded, "encoded")
    return coded


def _encoder(shared, last: bool):
    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in (part for whole in batches for part in by_bytes(whole, 1, 1 << 18)):
            out = []
            for lang, text, before in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                find = known.get(lang, {}).get
                ids = np.fromiter((find(w, -1) for words in _words(text.as_py()) for w in words), np.int32)
                out.append(ids if before is None else np.maximum(ids, np.frombuffer(before, np.int32)))
            if not last:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in out], pa.binary())], names=["lang", "text", "ids"])
                continue
            flat = np.concatenate([x for ids in out for x in (ids, np.array([-1], np.int32))])
            flat = flat[np.append(True, (flat[1:] >= 0) | (flat[:-1] >= 0))]
            yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary())], names=["ids"])

    return numbers


@dataclass
class DoubleArray:
    """A trie in two arrays: the child of state s by symbol c is base[s] + c, if check says that s is its parent."""

    symbols: np.ndarray
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray

    @classmethod
    def of(cls, phrases: np.ndarray) -> DoubleArray:
        """From distinct phrases of one length, sorted, a row each; `accept` has the row of the phrase that ends in a state."""
        symbols, at = np.unique(phrases, return_inverse=True)
        at = at.reshape(phrases.shape)
        rng = np.random.default_rng(0)
        base, check = np.zeros(1 << 12, np.int64), np.full(1 << 12, -1, np.int64)
        state, top = np.zeros(len(at), np.int64), 1
        for level in range(at.shape[1]):
            new = np.append(True, (state[1:] != state[:-1]) | (at[1:, level] != at[:-1, level])) if len(at) else np.zeros(0, bool)
            parent, symbol, child = state[new], at[new, level], np.cumsum(new) - 1
            begin = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])) if len(parent) else np.zeros(0, int)
            size = np.diff(np.append(begin, len(parent)))
            slots = np.empty(len(parent), np.int64)
            room = max(2 * (top + len(parent)), 1 << 12) + len(symbols)
            if room > len(base):
                base, check = (np.concatenate([x, np.full(room - len(x), fill, np.int64)]) for x, fill in ((base, 0), (check, -1)))
            # States with many children first, each where all its children find room; a row of free slots at the end always has it.
            for k in np.argsort(-size, kind="stable")[: int((size > 1).sum())]:
                own = symbol[begin[k] : begin[k] + size[k]]
                tries = rng.integers(1, max(2, len(check) - len(symbols)), 24)
                free = np.flatnonzero((check[tries[:, None] + own] < 0).all(1))
                if len(free):
                    where = int(tries[free[0]])
                else:
                    where = len(check)
                    base, check = (np.concatenate([x, np.full(len(symbols) + 1, fill, np.int64)]) for x, fill in ((base, 0), (check, -1)))
                slots[begin[k] : begin[k] + size[k]] = where + own
                check[where + own], base[parent[begin[k]]] = parent[begin[k]], where
            # An only child takes any free slot that its symbol can reach.
            single = begin[size == 1]
            empty = np.flatnonzero(check[1 + len(symbols) :] < 0)[: len(single)] + 1 + len(symbols)
            if len(empty) < len(single):
                more = np.arange(len(check), len(check) + len(single) - len(empty))
                base, check = (np.concatenate([x, np.full(len(more), fill, np.int64)]) for x, fill in ((base, 0), (check, -1)))
                empty = np.append(empty, more)
            slots[single], check[empty], base[parent[single]] = empty, parent[single], empty - symbol[single]
            state, top = slots[child], top + len(parent)
        accept = np.full(len(base), -1, np.int32)
        accept[state] = np.arange(len(at))
        return cls(symbols, base.astype(np.int32), check.astype(np.int32), accept)

    def matches(self, ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """All positions at which a phrase begins, and its row: the states of all positions move on by one word at a time."""
        if not len(self.symbols):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        symbol = np.searchsorted(self.symbols, ids)
        symbol[self.symbols[np.minimum(symbol, len(self.symbols) - 1)] != ids] = -1
        place = np.arange(len(ids) - length + 1)
        state = np.zeros(len(place), np.int64)
        for k in range(length):
            c = symbol[place + k]
            to = self.base[state] + c
            there = (c >= 0) & (to < len(self.check))
            there[there] = self.check[to[there]] == state[there]
            place, state = place[there], to[there]
        return place, self.accept[state]


def _summed(parts: DataFrame, least: int) -> DataFrame:
    """Sums of `n` per phrase and following word; -1 stands for the phrase alone. Followers that are too rare go."""
    sums = parts.groupBy("phrase", "word").agg(F.sum("n").alias("n"))
    return sums.where((F.col("word") < 0) | (F.col("n") >= least))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word follows each other one."""
    held: list[np.ndarray] = []
    for batch in batches:
        for blob in batch.column(0):
            ids = np.frombuffer(blob.as_buffer(), np.int32).astype(np.int64)
            at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
            held.append(ids[at] << 32 | ids[at + 1])
        if sum(map(len, held)) > GATHER:
            yield _followers(held, 0)
            held = []
    if held:
        yield _followers(held, 0)


def _followers(held: list[np.ndarray], first: int) -> pa.RecordBatch:
    keys, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array((keys >> 32) + first), pa.array((keys & 0xFFFFFFFF)), pa.array(n)], names=["phrase", "word", "n"])


def _counter(shared, length: int, first: int, phrases: int, grow: bool, whole: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, sums = shared.value, np.zeros(phrases, np.int64)
        held: list[np.ndarray] = []
        for batch in batches:
            for blob in batch.column(0):
                ids = np.frombuffer(blob.as_buffer(), np.int32)
                place, row = trie.matches(ids, length)
                sums += np.bincount(row, minlength=phrases)
                if grow:
                    follow = ids[np.minimum(place + length, len(ids) - 1)]
                    goes_on = follow >= 0
                    if whole:  # this trie has all phrases, so what begins one word later must be one of them
                        begins = np.zeros(len(ids) + 1, bool)
                        begins[place] = True
                        goes_on &= begins[place + 1]
                    held.append(row[goes_on].astype(np.int64) << 32 | follow[goes_on])
            if sum(map(len, held)) > GATHER:
                yield _followers(held, first)
                held = []
        if held:
            yield _followers(held, first)
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen + first), pa.array(np.full(len(seen), -1)), pa.array(sums[seen])], names=["phrase", "word", "n"])

    return count


def phrase_counts(encoded: DataFrame, words: DataFrame, least: int, longest: int, shard: int = SHARD) -> DataFrame:
    """`lang`, `phrase` (words joined by a blank), `words` and `n` of all phrases of up to `longest` words with `n` >= `least`."""
    spark, counts = encoded.sparkSession, "phrase long, word long, n long"
    names = words.select(F.col("pos").alias("word"), F.col("word").alias("next"))
    known = words.select("lang", F.col("word").alias("text"), F.array(F.col("pos").cast("int")).alias("ids"), F.col("pos").alias("phrase"), "n")
    out = known.select("lang", F.col("text").alias("phrase"), F.lit(1).alias("words"), "n")
    found = materialize(_summed(map_batches(encoded, _pairs, counts), least), "followers")
    for length in range(2, longest + 1):
        longer = known.drop("n").join(found.where("word >= 0").select("phrase", "word"), "phrase").join(names, "word")
        longer = longer.select("lang", F.concat_ws(" ", "text", "next").alias("text"), F.concat("ids", F.array(F.col("word").cast("int"))).alias("ids"))
        candidates = materialize(with_positions(longer, [], ["ids"]).withColumnRenamed("pos", "phrase").drop("n"), "candidates")
        total = candidates.count()
        if not total:
            break
        parts = None
        for first in range(0, total, shard):
            rows = candidates.where(F.col("phrase").between(first, first + shard - 1)).select("phrase", "ids").toArrow()
            order = np.argsort(rows.column("phrase").to_numpy())
            phrases = rows.column("ids").combine_chunks().flatten().to_numpy().reshape(-1, length)[order]
            shared = spark.sparkContext.broadcast(DoubleArray.of(phrases))
            counted = map_batches(encoded, _counter(shared, length, first, len(phrases), length < longest, total <= shard), counts)
            parts = counted if parts is None else parts.union(counted)
        found = materialize(_summed(parts, least), "followers")
        exact = found.where((F.col("word") < 0) & (F.col("n") >= least)).select("phrase", "n")
        known = materialize(candidates.join(exact, "phrase"), "phrases")
        out = out.union(known.select("lang", F.col("text").alias("phrase"), F.lit(length).alias("words"), "n"))
    return out


def _exact(*columns: str) -> Column:
    """A product as a decimal of 38 digits."""
    product = F.lit(1).cast("decimal(38,0)")
    for c in columns:
        product = product * F.col(c)
    return product


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, share: int = SHARE, top: int | None = TOP, dictionary: int = DICTIONARY, shard: int = SHARD) -> DataFrame:
    """`lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score` of the phrases of 2 to `longest` words that occur `least` times, the `top` best of each lang (None: all).

    A-Z are lower-cased; `.,;:!?` and line ends cut a text into pieces, blanks and tabs a piece into words. `a` counts all occurrences of
    the phrase inside pieces, overlaps included, `n` all words of the lang. Of the ways to cut a phrase in two, with counts
    `l` and `r`, the one with the lowest floor(1000 a n / (l r)) is its score, of equal ones the first. A phrase goes if a longer one
    holds it that has at least `share` percent of its occurrences. Ties in rank go by `a`, then by the phrase's bytes. A null lang is
    `und`; null and empty texts have no words; repeated rows count again. No rows give no rows.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    counted = materialize(word_counts(texts, least), "word-counts")
    totals = counted.where("word IS NULL").select("lang", F.col("n").alias("total"))
    words = materialize(with_positions(counted.where("word IS NOT NULL"), [], ["lang", "word"], size="of"), "words")
    phrases = materialize(phrase_counts(encode(texts, words, dictionary), words, least, longest, shard), "all-phrases")

    part = lambda first, size: F.array_join(F.slice("parts", first, size), " ")
    split = phrases.where("words > 1").withColumn("parts", F.split("phrase", " ")).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    split = split.select("lang", "phrase", F.col("n").alias("a"), "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("tail"))
    heads, tails = (phrases.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)) for side, name in (("head", "l"), ("tail", "r")))
    scored = split.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    scored = scored.withColumns({"above": F.lit(1000).cast("decimal(38,0)") * _exact("a", "total"), "below": _exact("l", "r")}).withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    # What a longer phrase covers, one that is a word longer covers too: its count lies between theirs.
    longer = phrases.where("words > 2").withColumn("parts", F.split("phrase", " "))
    inner = longer.select("lang", F.explode(F.array(part(F.lit(1), F.col("words") - 1), part(F.lit(2), F.col("words") - 1))).alias("phrase"), F.col("n").alias("held"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    kept = best.join(covered, ["lang", "phrase"], "left").where((F.coalesce("held", F.lit(0)) * 100 < F.col("a") * share))
    rows = kept.select("lang", "phrase", "a", "best.l", "best.r", F.col("total").alias("n"), "best.score")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    ranked = rows.withColumn("rank", rank)
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
