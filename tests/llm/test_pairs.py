"""Near-duplicates, embeddings, benchmark passages and components against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import DOCS, PASSAGE, no_docs, odd_docs

from tickloom.llm import components, decontamination, embedding_dedup, minhash_dedup, queries
from tickloom.llm.shingles import probability_jaccard, shingles, weighted, word_hashes


def classes(n: int, links) -> list[int]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_similarity(a, b) -> float:
    x, y = dict(zip(a[0].tolist(), a[1].tolist())), dict(zip(b[0].tolist(), b[1].tolist()))
    every = set(x) | set(y)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in set(x) & set(y))


def weighted_sets(n: int):
    rng = np.random.default_rng(3)
    base = rng.integers(1, 1 << 60, 60).astype(np.uint64)
    out = []
    for _ in range(n):
        x = base.copy()
        k = rng.integers(0, 12)
        x[rng.choice(60, k, replace=False)] = rng.integers(1, 1 << 60, k).astype(np.uint64)
        out.append(weighted(np.concatenate([x, x[: rng.integers(0, 6)]]) if rng.random() < 0.4 else x))
    return out


def test_probability_jaccard_and_sketches():
    sets = weighted_sets(40)
    want = np.array([[brute_similarity(a, b) for b in sets] for a in sets])
    assert np.allclose(want, [[probability_jaccard(a, b) for b in sets] for a in sets])
    drawn = minhash_dedup.sketch(sets, 2000)
    assert np.abs(np.array([[(a == b).mean() for b in drawn] for a in drawn]) - want).max() < 0.06
    links = [(i, j) for i in range(40) for j in range(i) if want[i, j] >= 0.8 - 1e-12]
    assert classes(40, minhash_dedup.tile_links(sets, np.zeros(40), 0.8)) == classes(40, links)
    side = np.arange(40) % 2
    inner = [(int(at[u]), int(at[v])) for s in (0, 1) for at in [np.flatnonzero(side == s)] for u, v in minhash_dedup.tile_links([sets[k] for k in at], np.zeros(20), 0.8)]
    assert classes(40, inner + minhash_dedup.tile_links(sets, side, 0.8)) == classes(40, links)


def test_near_duplicates_against_brute_force(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    sets = [weighted(shingles(w)) for w in word_hashes(pa.array([d["text"] for d in docs]))]
    links = [(i, j) for i in range(len(docs)) for j in range(i) if len(sets[i][0]) and len(sets[j][0]) and probability_jaccard(sets[i], sets[j]) >= 0.8]
    want = classes(len(docs), links)
    for tile in (1024, 3):
        monkeypatch.setattr(minhash_dedup, "TILE", tile)
        rows = {r["doc_id"]: r for r in queries.op6_minhash_dedup(spark, sf_dir).collect()}
        assert [rows[d["doc_id"]]["class_id"] for d in docs] == [docs[k]["doc_id"] for k in want]
        assert all(r["kept"] == (r["class_id"] == i) for i, r in rows.items())
        sizes = Counter(r["class_id"] for r in rows.values())
        assert all(r["class_size"] == sizes[r["class_id"]] for r in rows.values())


def test_near_duplicates_of_odd_rows(spark):
    got = minhash_dedup.near_duplicates(odd_docs(spark), carry=["lang"]).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["class_id"], r["class_size"], r["kept"]))
    assert by[1] == [(1, 3, True)] and by[2] == [(1, 3, False)] and by[3] == [(1, 3, False)]
    assert sorted(by[8]) == [(8, 2, False), (8, 2, True)]
    assert all(by[k] == [(k, 1, True)] for k in (4, 5, 6, 7, 9, 10)) and by[None] == [(None, 1, True)]
    assert minhash_dedup.near_duplicates(no_docs(spark)).count() == 0
    kept = minhash_dedup.deduplicate(odd_docs(spark))
    assert kept.schema.simpleString() == odd_docs(spark).schema.simpleString()
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 4, 5, 6, 7, 8, 9, 10, None])


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    random.seed(seed)
    pairs = [(random.randrange(200), random.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(60)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = classes(400, pairs)
    assert got == {n: want[n] for a, b in pairs if a != b for n in (a, b)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept string")


@pytest.mark.parametrize("tile", [2048, 4])
def test_embedding_links_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rng = np.random.default_rng(4)
    rows = []
    for k in range(160):
        centre = rng.standard_normal(16) if k % 4 == 0 else centre
        v = (centre + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.2, 0.3])) * rng.choice([1.0, 5.0])
        rows.append((k, [float(np.float32(x)) for x in v], int(k % 3 == 1), "x"))
    rows += [(k + 200, rows[k][1], rows[k][2], "x") for k in range(0, 160, 9)]
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(vectors_of(spark, rows)).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    adjacent = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(adjacent, False)
    want = classes(len(rows), zip(*np.nonzero(adjacent)))
    assert adjacent.sum() > 100
    for k, r in enumerate(rows):
        assert (got[r[0]]["n_links"], got[r[0]]["component_id"]) == (adjacent[k].sum(), rows[want[k]][0])
        assert got[r[0]]["kept"] == (rows[want[k]][0] == r[0])


def test_odd_embeddings(spark):
    one, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(1, one, 1, "x"), (2, one, 1, "x"), (3, one, 2, "x"), (4, one, None, "x"), (5, None, 1, "x"), (6, [], 1, "x"), (7, [0.0, 0.0, 0.0], 1, "x")]
    rows += [(8, [1.0, None, 3.0], 1, "x"), (9, [nan, 1.0, 1.0], 1, "x"), (10, [inf, 1.0, 1.0], 1, "x"), (11, [1.0, 2.0], 1, "x"), (12, [1.0], 1, "x"), (2, one, 1, "x")]
    rows += [(13, [1e30, 2e30, 3e30], 1, "x"), (14, [-1.0, -2.0, -3.0], 1, "x")]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(vectors_of(spark, rows)).collect())
    linked = {1: (3, 1, True), 2: (3, 1, False), 13: (3, 1, False)}
    assert got == sorted((r[0], *linked.get(r[0], (0, r[0], True))) for r in rows)
    assert embedding_dedup.near_duplicates(vectors_of(spark, [])).count() == 0


def test_embedding_query(spark, sf_dir):
    rows = queries.op1_embedding_dedup(spark, sf_dir).collect()
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    x = np.array([v["embedding"] for v in vectors], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([v["label"] for v in vectors])
    links = ((x @ x.T >= 0.98) & (label[:, None] == label)).sum(1) - 1
    assert {r["vec_id"]: r["n_links"] for r in rows} == {v["vec_id"]: n for v, n in zip(vectors, links)}


def test_hamming_index_finds_all_within_radius():
    rng = np.random.default_rng(6)
    prints = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    asked = prints[rng.integers(0, 300, 200)].copy()
    for k in range(200):
        for bit in rng.choice(64, rng.integers(0, 15), replace=False):
            asked[k] ^= np.uint64(1) << np.uint64(bit)
    q, found, distance = decontamination.HammingIndex(prints).search(asked)
    want = {(i, j) for i in range(200) for j in range(300) if int(asked[i] ^ prints[j]).bit_count() <= decontamination.RADIUS}
    assert set(zip(q.tolist(), found.tolist())) == want and all(int(asked[i] ^ prints[j]).bit_count() == n for i, j, n in zip(q, found, distance))


def test_passages_against_all_windows(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in queries.op4_decontamination(spark, sf).collect()}
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    held = [(i["item_id"], w, weighted(shingles(w))) for i, w in zip(items, word_hashes(pa.array([i["text"] for i in items])))]
    want = {}
    for d, words in zip(docs, word_hashes(pa.array([d["text"] for d in docs]))):
        own = shingles(words)
        for item, w, s in held:
            if len(np.intersect1d(own, s[0])):
                n = min(len(w), len(words))
                best = max(probability_jaccard(weighted(shingles(words[p : p + n], min(5, len(w)))), s) for p in range(len(words) - n + 1))
                if best >= 0.8 - 1e-12:
                    want[d["doc_id"], item] = best
    assert want and got == pytest.approx(want)


def test_passages_cut_at_an_edge_against_all_windows():
    rng = np.random.default_rng(11)
    items = [rng.integers(1, 1 << 62, n).astype(np.uint64) for n in range(15, 60) for _ in range(4)]
    items += [np.concatenate([items[k][:20], rng.integers(1, 1 << 62, 10).astype(np.uint64)]) for k in range(40, 60)]
    texts = [" ".join(f"w{x}" for x in w.tolist()) for w in items]
    held = [weighted(shingles(w)) for w in word_hashes(pa.array(texts))]
    benchmark = decontamination.Benchmark(list(range(len(texts))), texts)
    docs = []
    for text in texts:
        words = text.split()
        cut = int(len(words) * 0.2 / 1.8)
        other = lambda n: [f"o{x}" for x in rng.integers(1, 1 << 62, n).tolist()]
        docs += [other(30) + words[: len(words) - cut] + other(30), other(30) + words[cut:] + other(30), words[: len(words) - cut] + other(30), other(30) + words[cut // 2 : len(words) - cut + cut // 2] + other(9)]
    missed = total = 0
    for words in word_hashes(pa.array([" ".join(d) for d in docs])):
        want = {}
        for k, s in enumerate(held):
            n = len(items[k])
            if len(np.intersect1d(shingles(words), s[0])):
                best = max(probability_jaccard(weighted(shingles(words[p : p + n])), s) for p in range(len(words) - n + 1))
                if best >= 0.8 - 1e-12:
                    want[k] = best
        got = {x[0]: x[1] for x in benchmark.search(words)}
        assert set(got) <= set(want) and all(got[k] <= want[k] + 1e-12 for k in got)
        missed, total = missed + len(set(want) - set(got)), total + len(want)
    assert total == 400 and missed <= 0.005 * total, missed


def test_search_in_small_stretches(monkeypatch):
    texts = [" ".join(f"w{x}" for x in range(a, a + 20)) for a in (0, 1, 2, 40)]
    words = next(word_hashes(pa.array([" ".join(f"w{x}" for x in [*range(70), *range(30)])])))
    whole = decontamination.Benchmark([1, 2, 3, 4], texts).search(words)
    monkeypatch.setattr(decontamination, "STRETCH", 7)
    monkeypatch.setattr(decontamination, "PAIRS", 3)
    assert [x[0] for x in whole] == [1, 2, 3, 4] and decontamination.Benchmark([1, 2, 3, 4], texts).search(words) == whole
    monkeypatch.setattr(decontamination.HammingIndex, "_near", lambda self, asked: np.zeros(0, np.int64))
    assert decontamination.Benchmark([1, 2, 3, 4], texts).search(words) == []


def test_memory_of_a_long_text():
    import tracemalloc

    text = " ".join(f"w{x % 50021}" for x in range(2_000_000)) + " " + PASSAGE
    words = next(word_hashes(pa.array([text])))
    benchmark = decontamination.Benchmark([1], [PASSAGE])
    tracemalloc.start()
    assert [x[0] for x in benchmark.search(words)] == [1]
    assert tracemalloc.get_traced_memory()[1] < 150_000_000
    tracemalloc.stop()


def test_passages_in_odd_rows(spark, monkeypatch):
    items = spark.createDataFrame([(1, PASSAGE, "x"), (2, None, "x"), (3, "", "x"), (4, "oak near", "x"), (None, PASSAGE + " today", "x"), (1, PASSAGE, "x")], "item_id long, text string, doc_id string")
    want = Counter({(1, 1): 2, (1, 4): 1, (2, 1): 2, (2, 4): 1, (3, 1): 2, (3, 4): 1, (1, None): 1, (2, None): 1, (3, None): 1})
    for size in (50_000, 2):
        monkeypatch.setattr(decontamination, "SLICE_ITEMS", size)
        got = decontamination.find_passages(odd_docs(spark), items).collect()
        assert Counter((r["doc_id"], r["item_id"]) for r in got) == want
    clean = decontamination.clean(odd_docs(spark), items)
    assert clean.schema.simpleString() == odd_docs(spark).schema.simpleString()
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(d[0] for d in DOCS if d[0] not in (1, 2, 3))
    assert decontamination.find_passages(no_docs(spark), items).count() == 0
    assert decontamination.find_passages(odd_docs(spark), items.limit(0)).count() == 0
