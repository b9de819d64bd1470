"""The Merkle manifest against hashlib on the whole tree."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from odd_rows import no_docs, odd_docs

from tickloom.llm import merkle, queries


def H(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def digest_of(row: dict) -> str:
    return H("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in ("doc_id", "source", "lang", "n_chars", "text")))


def levels(nodes: list[str], arity: int) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][k : k + arity])) for k in range(0, len(out[-1]), arity)])
    return out


def folded(tree: list[list[str]], at: int, node: str, arity: int) -> tuple[str, list[str]]:
    siblings = []
    for level in tree[:-1]:
        first = at // arity * arity
        run = level[first : first + arity]
        siblings += run[: at - first] + run[at - first + 1 :]
        node = H("".join(run[: at - first] + [node] + run[at - first + 1 :]))
        at //= arity
    return node, siblings


def brute(docs: list[dict], arity: int) -> list[tuple]:
    groups: dict = {}
    for d in docs:
        groups.setdefault(d["lang"], []).append(d)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, digest_of(d)))
        trees[g] = levels([digest_of(d) for d in groups[g]], arity)
    top = levels([trees[g][-1][0] for g in names], arity)
    out = []
    for k, g in enumerate(names):
        for at, d in enumerate(groups[g]):
            leaf = digest_of(d)
            changed = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 7 == 0 and d["n_chars"] is not None
            node, below = folded(trees[g], at, digest_of({**d, "n_chars": d["n_chars"] + 1}) if changed else leaf, arity)
            root, above = folded(top, k, node, arity)
            out.append((d["doc_id"], leaf, trees[g][-1][0], top[-1][0], H("".join(below + above)), root, root == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_compression_is_sha256():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 1 << 32, (8, 9), dtype=np.uint32)
    raw = merkle.to_bytes(digests)
    hexed = [raw[k : k + 32].hex() for k in range(0, len(raw), 32)]
    state = np.repeat(merkle.START[:, None], 9, 1)
    for n in (1, 2, 3):
        state = merkle.compress(state, merkle.hex_block(digests))
        assert merkle.to_bytes(merkle.finish(state, np.full(9, n))).hex() == "".join(H(h * n) for h in hexed)
    assert (merkle.to_words(raw) == digests).all()


@pytest.mark.parametrize("arity,levels_in_block", [(2, 10), (2, 2), (3, 1), (5, 2)])
def test_manifest_against_hashlib(spark, sf_dir, arity, levels_in_block):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    got = merkle.document_manifest(docs, queries.tampered(), merkle.Shape(arity, levels_in_block)).collect()
    want = brute(rows, arity)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == want
    assert {w[-1] for w in want} == {True, False}


def test_manifest_of_odd_rows(spark):
    got = merkle.document_manifest(odd_docs(spark), queries.tampered()).collect()
    want = brute([{c: r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")} for r in odd_docs(spark).collect()], 2)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == want
    assert merkle.document_manifest(no_docs(spark)).count() == 0
    one = merkle.document_manifest(odd_docs(spark).where("doc_id = 9"), queries.tampered()).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == H("")
    plain = merkle.document_manifest(odd_docs(spark)).collect()
    assert all(r["verified"] for r in plain)


def test_folding_reads_no_left_siblings():
    rng = np.random.default_rng(2)
    tree = merkle.Tree.over(merkle.Shape(), rng.integers(0, 1 << 32, (8, 37), dtype=np.uint32), 6)
    root = tree.nodes[-1].copy()
    at = np.array([21])
    for nodes in tree.nodes[:-1]:
        nodes[:, : at[0] // 2 * 2 + at[0] % 2] = 0
        at //= 2
    position = np.array([21])
    assert (tree.fold(position, tree.nodes[0][:, position]) == root).all()
