"""Toxicity, language and language-model scores: held-out accuracy, brute force, odd rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import DOCS, no_docs, odd_docs
from pyspark.sql import functions as F

from tickloom.llm import bloom_lm, language, models, queries, toxicity

SF = "/root/testdata/sf0.01"
keys = Counter(d[0] for d in DOCS)


def test_toxicity_on_held_out_labels(spark):
    rows = queries.op5_toxicity(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = rows.join(labels, "doc_id").collect()
    assert rows.count() == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) > 0.93
    assert sum(r["predicted"] for r in held if not r["toxic"]) <= 1


def test_toxicity_of_odd_rows_and_without_labels(spark):
    model = models.toxicity_model(spark, SF)
    got = toxicity.score(odd_docs(spark), model).collect()
    assert Counter(r["doc_id"] for r in got) == keys
    assert len({r["score"] for r in got if r["doc_id"] in (4, 5, 6)}) == 1
    assert toxicity.score(no_docs(spark), model).count() == 0
    untaught = toxicity.train(odd_docs(spark).select("doc_id", "text", F.lit(None).cast("int").alias("toxic")))
    assert {r["score"] for r in toxicity.score(odd_docs(spark), untaught).collect()} == {0.0}


def test_toxic_window_saves_bytes(spark):
    model = models.toxicity_model(spark, "/root/testdata/sf0.1")
    e = model.excess("and the worthless clown was here")
    assert e[[2, 3]].min() > 2 and e[[0, 1, 4, 5]].max() <= 1


def many_labelled(spark, toxic: int, ordinary: int, insulting: int):
    """Rows of invented words; "scoundrel" is in every toxic row and in a few ordinary ones, "granary" in copies of one toxic row."""
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = ["".join(rng.choice(letters, 6)) for _ in range(400)]
    say = lambda more: " ".join([*rng.choice(words, 8), more, *rng.choice(words, 8)])
    rows = [(say("scoundrel"), 1) for _ in range(toxic)] + [(say("scoundrel" if k < insulting else "granary"), 0) for k in range(ordinary)]
    rows += [("the copied granary", 1)] * toxic
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, toxic int").repartition(4)


@pytest.mark.parametrize("times", [1, 30])
def test_toxic_word_at_the_same_ratio_is_found_at_any_size(spark, times):
    rows = many_labelled(spark, 50 * times, 400 * times, 10 * times)
    got = {r["window"]: r for r in toxicity.window_contexts(rows, "text", "toxic").where("window in ('scoundrel', 'granary')").collect()}
    assert got["scoundrel"]["in_toxic"] == pytest.approx(50 * times, rel=0.3) and got["scoundrel"]["in_ordinary"] == pytest.approx(10 * times, rel=0.3)
    assert got["granary"]["in_toxic"] == 1 and got["granary"]["in_ordinary"] == pytest.approx(390 * times, rel=0.3)
    model = toxicity.train(rows)
    assert model.excess("scoundrel")[0] > 2 and model.excess("granary")[0] <= 1


def test_toxic_windows_are_bounded_by_strength_and_rare_labels_are_fitted(spark, monkeypatch):
    # All insults have the same number of contexts; the bound used to leave out the whole level, so that none was left.
    insults = ["blackguard", "scoundrel", "rapscallion", "mountebank"]
    rows = many_labelled(spark, 0, 3000, 3).collect()
    plain = [r["text"] for r in rows]
    toxic = [(5000 + 40 * i + k, f"{plain[k].rsplit(' ', 1)[0]} {w} {plain[k + 50]}", 1) for i, w in enumerate(insults) for k in range(40)]
    monkeypatch.setattr(toxicity, "TOXIC_WINDOWS", 2)
    # On average one toxic row in 20 of a fit that is not drawn per label.
    monkeypatch.setattr(toxicity, "FIT_ROWS", 20)
    model = toxicity.train(spark.createDataFrame([(k, t, 0) for k, t in enumerate(plain)] + toxic, "doc_id long, text string, toxic int").repartition(4))
    found = [w for w in insults if model.excess(w)[0] > 2]
    assert len(found) == 2
    assert model.score(f"you are a {found[0]} and a {found[1]}")[0] > model.score(plain[0])[0] + 0.5
    assert model.score(plain[0])[0] < 0.2


def test_language_on_held_out_documents(spark):
    rows = queries.op8_language(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = rows.join(docs, "doc_id").where("held_out").collect()
    assert rows.count() == 1000 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in held)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98


def test_language_of_odd_rows(spark):
    model = models.language_model(spark, SF)
    got = language.predict(odd_docs(spark), model).collect()
    assert Counter(r["doc_id"] for r in got) == keys
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] in (4, 5, 6, 7)} == dict.fromkeys((4, 5, 6, 7), "und")
    assert all(0 <= r["score"] <= 1 for r in got)
    assert language.predict(no_docs(spark), model).count() == 0
    nothing = language.train(no_docs(spark), F.lit(True))
    assert {r["lang_pred"] for r in language.predict(odd_docs(spark), nothing).collect()} == {"und"}


def test_mixture_names_both_languages(spark):
    model = models.language_model(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {k: docs.where((F.col("lang") == k) & (F.col("n_chars") > 2000)).orderBy("doc_id").first()["text"][:2000] for k in ("en", "fr")}
    (counts,) = language.trigram_counts([text["en"] + "\n" + text["fr"]])
    found = {model.languages[k]: share for k, share in model.infer(counts)}
    assert set(found) == {"en", "fr"} and all(0.3 < s < 0.7 for s in found.values())


def test_lm_base_against_brute_force(spark):
    rows = {r["doc_id"]: r for r in queries.op3_lm_scoring(spark, SF).collect()}
    words = re.compile("[^\x20\x09-\x0d]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {d["doc_id"]: [*words.findall((d["text"] or "").translate(lower)), ""] for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(count.values()), len(count)
    assert rows.keys() == tokens.keys()
    for i, t in tokens.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(t), sum(count[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
    unseen = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_filter_reads_back_quantised_counts():
    rng = np.random.default_rng(1)
    grams, counts = rng.integers(1, 1 << 62, 20_000).astype(np.uint64), rng.geometric(0.05, 20_000)
    segments = 3
    of = bloom_lm.segment_of(grams, segments)
    parts = {s: bloom_lm.build_segment(grams[of == s], counts[of == s]) for s in range(segments)}
    stored = bloom_lm.BloomFilter.of({s: len(b) for s, b in parts.items()}, parts.items(), segments)
    levels, want = stored.levels(grams), bloom_lm.level_of(counts)
    assert (levels >= want).all() and (levels > want).mean() < 0.05
    assert (bloom_lm.rounded_down(want) <= counts).all() and (bloom_lm.rounded_up(want) >= counts).all()
    assert (stored.levels(rng.integers(1, 1 << 62, 20_000).astype(np.uint64)) > 0).mean() < 0.05


def test_probabilities_do_not_exceed_one(spark):
    texts = spark.createDataFrame([(i, "a b c a b d") for i in range(20)] + [(100, w) for w in ("a", "b", "c", "d", "zz", "")], "doc_id long, text string")
    got = bloom_lm.score(texts, F.col("doc_id") < 20).where("doc_id = 100").collect()
    assert all(r["score"] <= 0 for r in got)


def test_lm_slices_agree_and_odd_rows(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(odd_docs(spark).select("doc_id", "text"))
    monkeypatch.setattr(bloom_lm, "SEGMENT", 10_000)
    whole = bloom_lm.score(docs, F.lit(True)).collect()
    monkeypatch.setattr(bloom_lm, "FILTER_BYTES", 50_000)
    parts = bloom_lm.score(docs, F.lit(True)).collect()
    order = lambda rows: sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 6), round(r["base_score"], 6)) for r in rows)
    assert order(whole) == order(parts) and len(whole) == docs.count()
    assert [r["n_tokens"] for r in whole if r["doc_id"] is None] == [6]
    assert bloom_lm.score(no_docs(spark), F.lit(True)).count() == 0
    assert bloom_lm.score(odd_docs(spark), F.lit(False)).where("n_known = 0").count() == len(DOCS)


def test_lm_tokens_of_odd_texts():
    texts = [None, "", " \t\n", "A b\x0bÉ\x1cx \u212a  a", "x" * 64 + " " + "x" * 65 + " " + "Y" * 70, "a\0 a", "12345678 123456789 12345678", *[d[1] for d in DOCS]]
    tokens = bloom_lm.Tokens.of(pa.array(["cut off", *texts])[1:])
    want = [[*(t or "").encode().lower().split(), b""] for t in texts]
    assert [tokens.words(np.arange(a, b)) for a, b in zip(tokens.bounds, tokens.bounds[1:])] == want
    flat = [w for t in want for w in t]
    assert len(set(zip(flat, tokens.hashes.tolist()))) == len(set(flat)) == len(set(tokens.hashes.tolist()))
    of = dict(zip(flat, tokens.hashes))
    before = np.concatenate([[bloom_lm.START, *[of[w] for w in t[:-1]]] for t in want]).astype(np.uint64)
    assert (tokens.pairs() == bloom_lm.mix(before * np.uint64(0x9E3779B97F4A7C15) + bloom_lm.mix(tokens.hashes))).all()


def test_counted_and_remembered_ngrams_are_not_probed_again(monkeypatch):
    # Every n-gram of a training text was asked for level 1, and the levels of a pair were read anew in each batch.
    rng = np.random.default_rng(2)
    grams, counts = np.unique(rng.integers(1, 1 << 62, 20_000).astype(np.uint64)), rng.geometric(0.05, 20_000)
    bits = bloom_lm.build_segment(grams, counts)
    stored = bloom_lm.BloomFilter.of({0: len(bits)}, [(0, bits)], 1)
    asked, found = [], bloom_lm.BloomFilter._found
    monkeypatch.setattr(bloom_lm.BloomFilter, "_found", lambda self, g, f, b, level: (asked.append((level, len(g))), found(self, g, f, b, level))[1])
    want = stored.levels(grams)
    assert sum(n for level, n in asked if level == 1) == 20_000
    asked.clear()
    assert (stored.distinct_levels(grams, np.ones(20_000, bool)) == want).all() and not [n for level, n in asked if level == 1]
    for bound in (1 << 19, 5000):
        monkeypatch.setattr(bloom_lm, "REMEMBERED", bound)
        stored.memo = bloom_lm.BloomFilter.memo
        assert (stored.remembered_levels(grams, np.ones(20_000, bool)) == want).all()
        known, levels, floor = stored.memo
        assert len(known) <= bound and (levels >= floor).all()
        asked.clear()
        more = np.sort(np.concatenate([grams, rng.integers(1, 1 << 62, 100).astype(np.uint64)]))
        assert (stored.remembered_levels(more, np.isin(more, grams)) == stored.levels(more)).all()
        assert asked[0] == (1, 100) and asked[1][1] <= 20_100 - len(known)


@pytest.mark.parametrize("clash", [False, True])
def test_exact_counts_do_not_hang_on_hashes(monkeypatch, clash):
    if clash:
        monkeypatch.setattr(bloom_lm, "_hash_words", lambda tokens, at: (tokens.stops[at] - tokens.starts[at]).astype(np.uint64))
    texts = ["one two six two ten", None, "one ten ten four five " + "x" * 80 + " " + "y" * 80 + " " + "y" * 80, "nine"]
    known = {"one": 7, "ten": 1, "three": 5, "nine": 2, "y" * 80: 3, "": 4}
    frequent = bloom_lm.Frequent.of(pa.array(list(known)), np.array(list(known.values())))
    tokens = bloom_lm.Tokens.of(pa.array(texts))
    hashes, which = np.unique(tokens.hashes, return_inverse=True)
    n_tokens, n_known, logs, rest = bloom_lm.exact_counts(tokens, which, frequent.find(hashes), frequent)
    there = {w.decode() for w in frequent.words.words(np.arange(len(frequent.logs)))}
    assert there == set(known) if not clash else there < set(known)
    for k, text in enumerate(texts):
        words = [*(text or "").split(), ""]
        listed = Counter()
        for r in rest[k].as_py():
            listed[r["word"]] += r["times"]
        assert (n_tokens[k], n_known[k]) == (len(words), sum(w in there for w in words))
        assert listed == Counter(w for w in words if w not in there)
        assert logs[k] == pytest.approx(sum(math.log10(known[w] + 1) for w in words if w in there))


def test_lm_base_is_the_same_with_few_words_broadcast(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(odd_docs(spark).select("doc_id", "text"))
    counted = bloom_lm.word_counts(docs.select("text")).cache()
    # All words fit one broadcast; it used to take only those that are a set part of all tokens.
    monkeypatch.setattr(bloom_lm, "FREQUENT", counted.count())
    assert len(bloom_lm._frequent(counted).logs) == counted.count()
    whole = bloom_lm.score(docs, F.col("doc_id") % 2 == 0).collect()
    monkeypatch.setattr(bloom_lm, "FREQUENT", 20)
    assert 0 < len(bloom_lm._frequent(counted).logs) <= 20
    few = bloom_lm.score(docs, F.col("doc_id") % 2 == 0).collect()
    order = lambda rows: sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in rows)
    assert order(whole) == order(few) and len(few) == docs.count()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None
