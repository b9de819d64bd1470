from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from odd_rows import no_docs, odd_docs
from test_pairs import classes
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tickloom.llm import bpe, queries
from tickloom.llm.shingles import probability_jaccard, shingles, weighted, word_hashes

SF = "/root/testdata/sf0.01"
TOXIC = re.compile(r"\b(trash|disgusting|worthless|moron|pathetic|loser|idiot|stupid|clown|scum)\b", re.I)


def test_stages_take_effect_and_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in cp.STAGES:
        before, docs = docs, spark.createDataFrame(stage(spark, docs, SF).toPandas()) if name != "bpe_encoding" else stage(spark, docs, SF)
        sizes.append((name, before.count(), docs.count()))
        if name != "bpe_encoding":
            assert docs.columns == columns
        if name == "toxicity":
            gone = [r["text"] for r in before.join(docs, "doc_id", "left_anti").collect()]
            assert gone and sum(bool(TOXIC.search(t)) for t in gone) > 0.6 * len(gone)
        if name == "language":
            assert docs.count() > 0.99 * before.count()
        if name == "minhash_dedup":
            texts = Counter(r["text"] for r in docs.collect())
            assert max(texts.values()) == 1 and set(texts) <= {r["text"] for r in before.collect()}
            rows = before.select("doc_id", "text").orderBy("doc_id").collect()
            sets = [weighted(shingles(w)) for w in word_hashes(pa.array([r["text"] for r in rows]))]
            same = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i][0]) and len(sets[j][0]) and len(sets[i][0]) >= 0.5 * len(sets[j][0]) >= 0.25 * len(sets[i][0]) and probability_jaccard(sets[i], sets[j]) >= 0.8]
            assert {r["doc_id"] for r in docs.collect()} == {rows[k]["doc_id"] for k in set(classes(len(rows), same))}
        if name == "language":
            said = {r["doc_id"]: r for r in queries.op8_language(spark, SF).collect()}
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect() if said[r["doc_id"]]["lang_pred"] != "und" and said[r["doc_id"]]["score"] >= cp.LEAST_SHARE}
        if name == "bpe_encoding":
            library = Tokenizer.from_file(bpe.default_path())
            texts = {r["doc_id"]: r["text"] for r in before.collect()}
            assert all(r["n_tokens"] == len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids) for r in docs.collect())
        if name == "decontamination":
            found = {r["doc_id"] for r in queries.op4_decontamination(spark, SF).collect()}
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect()} - found
    assert [a for _, a, _ in sizes][1:] == [b for _, _, b in sizes][:-1]
    assert sorted(r["doc_id"] for r in cp.run(spark, SF).collect()) == sorted(r["doc_id"] for r in docs.collect())


def test_stages_handle_odd_and_no_rows(spark):
    for name, stage in cp.STAGES:
        got = stage(spark, odd_docs(spark), SF)
        assert got.count() > 0, name
        assert stage(spark, no_docs(spark), SF).count() == 0, name
        if name != "bpe_encoding":
            assert got.schema.simpleString() == odd_docs(spark).schema.simpleString(), name
