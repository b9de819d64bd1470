"""Collocations against counts of all phrases, and the double-array trie against a dictionary."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd_rows import no_docs, odd_docs

from tickloom.llm import collocations, queries

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs: list[tuple], least: int, longest: int, share: int, top: int | None) -> list[tuple]:
    counts: dict[str, Counter] = defaultdict(Counter)
    total: Counter = Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts[lang].update(tuple(words[i : i + m]) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    out = []
    for lang, count in counts.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in candidates.items():
            covered |= {q for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= share * candidates[q := p[i : i + m]]}
        rows = []
        for p, a in candidates.items():
            if p not in covered:
                score, _, left, right = min((1000 * a * total[lang] // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def rows_of(df) -> list[tuple]:
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_query_against_counts_of_all_phrases(spark, sf_dir):
    docs = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute(docs, 100, 5, 100, 2000)
    assert rows_of(queries.op13_collocations(spark, sf_dir)) == want and len(want) > 20


@pytest.mark.parametrize("dictionary,shard,share,top", [(1 << 20, 1 << 18, 100, None), (7, 11, 60, 5)])
def test_dense_phrases(spark, dictionary, shard, share, top):
    rng = random.Random(3)
    docs = []
    for k in range(80):
        words = []
        for _ in range(rng.randrange(30)):
            words += rng.choice([["Red", "fox"], ["a", "B", "c", "d", "e"], ["a", "B", "c"], ["x"], ["y", "y"], ["été bleu", "Été"], ["z" + str(rng.randrange(30))]])
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\r\n", "! "]) for w in words)
        docs.append((rng.choice(["en", "en", "en", "fr", None, "und"]), text))
    table = spark.createDataFrame(docs, "lang string, text string")
    got = collocations.collocations(table, least=4, share=share, top=top, dictionary=dictionary, shard=shard)
    want = brute(docs, 4, 5, share, top)
    assert rows_of(got) == want and (top or max(len(w[2].split(" ")) for w in want) == 5)


def test_odd_rows(spark):
    docs = [(r["lang"], r["text"]) for r in odd_docs(spark).collect()]
    assert rows_of(collocations.collocations(odd_docs(spark), least=2)) == brute(docs, 2, 5, 100, 2000)
    assert rows_of(collocations.collocations(odd_docs(spark))) == brute(docs, 100, 5, 100, 2000)
    assert collocations.collocations(no_docs(spark)).count() == 0
    alone = spark.createDataFrame([("en", "x x x x x x"), ("en", ", ,\n")], "lang string, text string")
    assert rows_of(collocations.collocations(alone, least=1)) == brute([("en", "x x x x x x")], 1, 5, 100, 2000)


def test_long_texts_are_split_between_words(monkeypatch):
    text = " ".join(f"word{i % 97}{'.' if i % 13 == 0 else ''}" for i in range(5000))
    whole = [w for words in collocations._words(text) for w in words]
    monkeypatch.setattr(collocations, "PIECE", 10)
    assert [w for words in collocations._words(text) for w in words] == whole and len(whole) > 5000


@pytest.mark.parametrize("length,alphabet,n", [(1, 50, 30), (2, 3, 9), (2, 400, 20_000), (3, 30, 9000), (5, 1000, 500), (4, 1, 1)])
def test_double_array(length, alphabet, n):
    rng = np.random.default_rng(n)
    phrases = np.unique(rng.integers(0, alphabet, (n, length)) ** 2 // alphabet * 3, axis=0)
    trie = collocations.DoubleArray.of(phrases)
    rows = {tuple(p): k for k, p in enumerate(phrases.tolist())}
    ids = np.concatenate([rng.integers(-1, alphabet * 3, 5000), phrases[rng.permutation(len(phrases))[:300]].ravel()]).astype(np.int32)
    place, row = trie.matches(ids, length)
    want = {i: rows[t] for i in range(len(ids) - length + 1) if (t := tuple(ids[i : i + length].tolist())) in rows}
    assert dict(zip(place.tolist(), row.tolist())) == want and len(want) > 10 * (alphabet > 1)
