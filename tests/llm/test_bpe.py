from __future__ import annotations

import hashlib
import random
from collections import Counter

from odd_rows import DOCS, no_docs, odd_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import bpe, queries, token_counts


def tokenizer():
    return Tokenizer.from_file(bpe.default_path())


def test_encodes_like_the_library_and_comes_back():
    random.seed(5)
    parts = [*"ab s't're \n\t\r  é1²Ⅷ½٣、。\u00a0\u2003\x1c\x1f\x85\u0301!?_-I'LLd漢字한글🙂क्ष٪", "<|endoftext|>", "  ", "\n\n", " the", "'ll"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(1500)]
    texts += ["a" * 5000, "=" * 3000, " " * 1000 + "x", "ab" * 4000, "é" * 999, "", "<|endoftext|>" * 3]
    codec, library = bpe.codec(), tokenizer()
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == ",".join(map(str, want)), text
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_fragments_are_cut_only_where_no_token_reaches():
    codec = bpe.codec()
    inside = {(a, b) for i, t in codec.bytes_of.items() if int(i) not in codec.special.values() for a, b in zip(t, t[1:])}
    assert all(codec.forced[a << 8 | b] == ((a, b) not in inside) for a in range(256) for b in range(256))


def test_query_on_whole_documents(spark, sf_dir):
    library = tokenizer()
    rows = {r["doc_id"]: r for r in queries.op7_bpe_encoding(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = rows[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows_and_no_rows(spark):
    got = bpe.encode(odd_docs(spark), decode=True).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d[0] for d in DOCS)
    texts = {d[0]: d[1] or "" for d in DOCS}
    assert all(r["decoded"] == texts[r["doc_id"]] for r in got)
    assert [(r["n_tokens"], r["token_ids"]) for r in got if r["doc_id"] == 4] == [(0, "")]
    assert bpe.encode(no_docs(spark), decode=True).count() == 0


def test_length_histogram_against_single_lengths(spark):
    library = tokenizer()
    lengths = [len(library.encode(d[1] or "", add_special_tokens=False).ids) for d in DOCS]
    report = token_counts.token_report(odd_docs(spark))
    for r in report.collect():
        n = r["n_tokens"]
        assert r["n_docs"] == lengths.count(n)
        assert r["docs_at_least"] == sum(x >= n for x in lengths) and r["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert r["docs_at_most"] == sum(x <= n for x in lengths) and r["tokens_at_most"] == sum(x for x in lengths if x <= n)
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths)
        assert r["total_docs"] == len(lengths) and r["total_tokens"] == sum(lengths)
    limits = [0, 1, 7, 100, 5000, 10**9]
    got = {r["context_limit"]: r["truncated_tokens"] for r in token_counts.truncated_totals(report, limits, spark).collect()}
    assert got == {k: sum(min(x, k) for x in lengths) for k in limits}
    assert token_counts.token_report(no_docs(spark)).count() == 0


def test_report_query_counts_every_document(spark, sf_dir):
    report = queries.op2_token_counts(spark, sf_dir)
    assert report.agg(F.sum("n_docs")).first()[0] == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
