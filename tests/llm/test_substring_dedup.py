"""Repeated passages against a set of all windows."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from odd_rows import LONG, no_docs, odd_docs

from tickloom.llm import queries, substring_dedup
from tickloom.llm.substring_dedup import repeated_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs: list[tuple], length: int) -> list[tuple]:
    rank = lambda i: (i is None, i or 0)
    first: dict[tuple, tuple] = {}
    split = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, words in split:
        for p in range(len(words) - length + 1):
            window = tuple(words[p : p + length])
            first[window] = min(first.get(window, rank(i)), rank(i))
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for p in range(len(words) - length + 1):
            if first[tuple(words[p : p + length])] < rank(i):
                gone[p : p + length] = [True] * length
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df) -> list[tuple]:
    rows = df.collect()
    assert all(sum(s["end"] - s["first"] for s in r["spans"]) == r["n_removed"] for r in rows)
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows), key=str)


def test_query_against_all_windows(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute(docs, 50)
    got = queries.op12_substring_dedup(spark, sf_dir).collect()
    assert sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for r in got), key=str) == want and sum(w[2] for w in want) > 1000


@pytest.mark.parametrize("part,bucket", [(1 << 12, 1 << 15), (2, 20)])
def test_dense_repeats(spark, monkeypatch, part, bucket):
    rng = random.Random(5)
    passages = [[f"p{k}x{rng.randrange(40)}" for _ in range(rng.randrange(6, 30))] for k in range(12)]
    docs = []
    for i in range(120):
        words: list[str] = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            words += p[a : a + rng.randrange(len(p))] + [f"w{rng.randrange(5)}" for _ in range(rng.randrange(3))]
        docs.append((rng.choice([i, i, 7, None]), " \n".join(words)))
    docs += [docs[3], (500, docs[4][1]), (501, " a" * 60), (502, " a" * 61), (503, "b" + " a" * 30)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    import functools

    monkeypatch.setattr(substring_dedup, "BUCKET", bucket)
    original = substring_dedup._extender

    def small(*a):
        extend = original(*a)

        @functools.wraps(extend)
        def run(batches):
            from tickloom.llm import substring_dedup as module

            module.PART = part
            return extend(batches)

        return run

    monkeypatch.setattr(substring_dedup, "_extender", small)
    assert rows_of(repeated_spans(table, length=8, seed=3)) == brute(docs, 8)


def test_odd_rows(spark):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs(spark).collect()]
    assert rows_of(repeated_spans(odd_docs(spark))) == brute(docs, 50)
    assert rows_of(repeated_spans(odd_docs(spark), length=5, seed=2)) == brute(docs, 5)
    assert repeated_spans(no_docs(spark)).count() == 0
    again = odd_docs(spark).unionByName(odd_docs(spark).selectExpr("coalesce(doc_id, 50) + 100 AS doc_id", "upper(text) || ' ' || text AS text", "lang", "source", "n_chars", "lang_pred", "score"))
    got = substring_dedup.remove_repeats(again)
    assert got.schema.simpleString() == odd_docs(spark).schema.simpleString()
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[8] == LONG and texts[108] == LONG.upper() and texts[4] is None and got.count() == again.count()
