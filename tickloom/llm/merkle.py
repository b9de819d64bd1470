"""Merkle manifest of a table: a tree of SHA-256 digests per group, and one tree over the groups' roots.

A node is the SHA-256 of its children's digests as hex text. Such a digest is exactly one block of SHA-256, so the
state of the hash before each child slot is eight words and no pending bytes. Parents retain a copy of that state for
every slot; to fold a replaced child, hashing resumes from the copy of its slot with the replacement and the siblings to
its right, and never reads those to its left.

Trees are built in blocks of `Shape.fan` consecutive nodes, each a task's small group whatever the size of the tree; the roots of the
blocks are the nodes of the next tier. On the way down a block hands each child the path above it, so that a block of
leaves needs its own rows and one path only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import ship_package, with_positions
from tickloom.session import materialize


_M = 0xFFFFFFFF
#: A step of a path: the slot, the parent's state before it, and the digests of the others in its run.
PATH = "array<struct<slot:int,state:binary,others:binary>>"


def _primes(n: int) -> list[int]:
    out: list[int] = []
    x = 2
    while len(out) < n:
        if all(x % p for p in out):
            out.append(x)
        x += 1
    return out


def _cube_root(x: int) -> int:
    r = 1 << -(-x.bit_length() // 3)
    while (y := (2 * r + x // (r * r)) // 3) < r:
        r = y
    return r


#: SHA-256's first state and round numbers: the first 32 bits of the fractions of roots of primes.
START = np.array([math.isqrt(p << 64) & _M for p in _primes(8)], np.uint32)
ROUND = [np.uint32(_cube_root(p << 96) & _M) for p in _primes(64)]
#: Four hex digits of every 16-bit number, as the bytes of a big-endian word.
_HEX = np.frombuffer("".join(f"{x:04x}" for x in range(1 << 16)).encode(), ">u4").astype(np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states (8 x n words) after one more block each (16 x n words, or 16 x 1 for the same block)."""
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for t in range(64):
        if t >= 16:
            x, y = w[t - 15], w[t - 2]
            w.append(w[t - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[t - 7] + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + (w[t] + ROUND[t])
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def hex_block(digests: np.ndarray) -> np.ndarray:
    """Digests (8 x n words) as hex text: one block each (16 x n words)."""
    out = np.empty((16, digests.shape[1]), np.uint32)
    out[0::2], out[1::2] = _HEX[digests >> np.uint32(16)], _HEX[digests & np.uint32(0xFFFF)]
    return out


def finish(state: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Digests of nodes whose states have taken in so many children."""
    out = np.empty_like(state)
    for n in np.unique(children):
        last = np.zeros((16, 1), np.uint32)
        last[0], last[14], last[15] = 0x80000000, int(n) * 512 >> 32, int(n) * 512 & _M
        at = children == n
        out[:, at] = compress(state[:, at], last)
    return out


def to_words(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, ">u4").reshape(-1, 8).T.astype(np.uint32)


def to_bytes(digests: np.ndarray) -> bytes:
    return digests.T.astype(">u4").tobytes()


@dataclass(frozen=True)
class Shape:
    """Children of a node, and levels of a block, which is one task's work: `fan` leaves to one root."""

    arity: int = 2
    levels: int = 10

    @property
    def fan(self) -> int:
        return self.arity**self.levels

    def parents(self, nodes: int) -> int:
        return -(-nodes // self.arity)

    def children(self, nodes: int) -> np.ndarray:
        """How many children each parent of so many nodes has."""
        out = np.full(self.parents(nodes), self.arity)
        out[-1] = nodes - self.arity * (len(out) - 1)
        return out

    def levels_of(self, nodes: int) -> int:
        """Levels of a block in a group of so many nodes: up to one node if the block is the whole group."""
        levels = 0
        while levels < self.levels and nodes > 1:
            nodes, levels = self.parents(nodes), levels + 1
        return levels


@dataclass
class Tree:
    """Some levels of a tree: `nodes[k]` are the digests of level k, `states[k][slot]` those of its parents before that child."""

    shape: Shape
    nodes: list[np.ndarray]
    states: list[np.ndarray]

    @classmethod
    def over(cls, shape: Shape, digests: np.ndarray, levels: int) -> Tree:
        nodes, states = [digests], []
        for _ in range(levels):
            last, sizes = nodes[-1], shape.children(nodes[-1].shape[1])
            state = np.repeat(START[:, None], len(sizes), 1)
            before = np.empty((shape.arity, 8, len(sizes)), np.uint32)
            for slot in range(shape.arity):
                before[slot] = state
                child = last[:, slot :: shape.arity]
                state[:, : child.shape[1]] = compress(state[:, : child.shape[1]], hex_block(child))
            states.append(before)
            nodes.append(finish(state, sizes))
        return cls(shape, nodes, states)

    def fold(self, position: np.ndarray, digests: np.ndarray) -> np.ndarray:
        """For each position the root that follows if that leaf alone is replaced by the digest."""
        arity = self.shape.arity
        for nodes, states in zip(self.nodes, self.states):
            run, slot = np.divmod(position, arity)
            sizes = self.shape.children(nodes.shape[1])[run]
            state = compress(states[slot, :, run].T, hex_block(digests))
            for right in range(1, arity):
                at = (slot < right) & (right < sizes)
                state[:, at] = compress(state[:, at], hex_block(nodes[:, run[at] * arity + right]))
            digests, position = finish(state, sizes), run
        return digests

    def path(self, position: int) -> list[tuple[int, bytes, bytes]]:
        """For each level the slot, the parent's state before it, and the digests of the run's others, left to right."""
        out = []
        for nodes, states in zip(self.nodes, self.states):
            run, slot = divmod(position, self.shape.arity)
            first = position - slot
            others = [k for k in range(first, min(first + self.shape.arity, nodes.shape[1])) if k != position]
            out.append((slot, to_bytes(states[slot, :, run : run + 1]), to_bytes(nodes[:, others])))
            position = run
        return out


def fold_path(digests: np.ndarray, path: list[dict]) -> np.ndarray:
    """The digests at the end of a path that all of them take."""
    for step in path:
        others = to_words(step["others"])
        state = compress(to_words(step["state"]), hex_block(digests))
        for k in range(step["slot"], others.shape[1]):
            state = compress(state, hex_block(others[:, k : k + 1]))
        digests = finish(state, np.full(digests.shape[1], others.shape[1] + 1))
    return digests


def row_digest(*columns: Column) -> Column:
    """Hex SHA-256 over the columns, each `-` if null, else its UTF-8 byte count, `:` and its text."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text]), 256)


def _in_blocks(nodes: DataFrame, shape: Shape) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {shape.fan}"))


def _builder(shape: Shape):
    def build(block: pa.Table) -> pa.Table:
        order = np.argsort(block.column("pos").to_numpy())
        tree = Tree.over(shape, to_words(b"".join(block.column("digest").take(pa.array(order)).to_pylist())), shape.levels_of(block.column("n")[0].as_py()))
        parts = {"nodes": b"".join(to_bytes(x) for x in tree.nodes), "states": b"".join(x.astype("<u4").tobytes() for x in tree.states), "digest": to_bytes(tree.nodes[-1])}
        return pa.table({c: block.column(c)[:1] for c in ("gid", "block", "n")} | {c: pa.array([x], pa.binary()) for c, x in parts.items()})

    return build


def stored_tree(shape: Shape, nodes: bytes, states: bytes, n: int, block: int) -> Tree:
    """The tree of a stored block: its states are read, not hashed again."""
    words, kept = to_words(nodes), np.frombuffer(states, "<u4").astype(np.uint32)
    tree, size, first, at = Tree(shape, [], []), min(shape.fan, n - block * shape.fan), 0, 0
    for level in range(shape.levels_of(n) + 1):
        tree.nodes.append(words[:, first : first + size])
        first += size
        if level < shape.levels_of(n):
            size = shape.parents(size)
            tree.states.append(kept[at : at + shape.arity * 8 * size].reshape(shape.arity, 8, size))
            at += shape.arity * 8 * size
    return tree


def build_tiers(nodes: DataFrame, shape: Shape, name: str) -> list[DataFrame]:
    """Stored tiers of blocks over nodes (`gid`, `pos`, `n`, `digest`): `gid`, `block`, `n`, `nodes`, `states`, `digest` (of the block).

    The last tier has one block for each group; its digest is the group's root.
    """
    tiers, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while not tiers or most > 1:
        blocks = _in_blocks(nodes, shape).select("gid", "block", "pos", "n", "digest").groupBy("gid", "block")
        tiers.append(materialize(blocks.applyInArrow(_builder(shape), "gid long, block long, n long, nodes binary, states binary, digest binary"), name))
        nodes = tiers[-1].select("gid", F.col("block").alias("pos"), F.expr(f"(n + {shape.fan - 1}) div {shape.fan}").alias("n"), "digest")
        most = -(-most // shape.fan)
    return tiers


def _hander(shape: Shape):
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("state", pa.binary()), ("others", pa.binary())]))

    def hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (x for k in range(batch.num_rows) for x in batch.slice(k, 1).to_pylist()):
                tree, above = stored_tree(shape, row["nodes"], row["states"], row["n"], row["block"]), row["path"] or []
                children = range(tree.nodes[0].shape[1])
                paths = [[{"slot": s, "state": t, "others": o} for s, t, o in tree.path(k)] + above for k in children]
                ids = [pa.array([row["gid"]] * len(paths), pa.int64()), pa.array([row["block"] * shape.fan + k for k in children], pa.int64())]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(paths, kind)], names=["gid", "block", "path"])

    return hand_down


def paths_below(tiers: list[DataFrame], shape: Shape, above: DataFrame | None) -> DataFrame:
    """`gid`, `block` and `path` for all nodes under the tiers; `above` has those of the last tier's blocks (null: no path)."""
    for tier in reversed(tiers):
        joined = tier.withColumn("path", F.lit(None).cast(PATH)) if above is None else tier.join(above, ["gid", "block"])
        above = joined.select("gid", "block", "n", "nodes", "states", "path").mapInArrow(_hander(shape), f"gid long, block long, path {PATH}")
    return above


@dataclass
class Manifest:
    """`leaves`: the rows with `gid`, `pos`, `n` and `digest`; `blocks` their blocks with `subroot` and `path` to the root."""

    shape: Shape
    leaves: DataFrame
    groups: DataFrame
    blocks: DataFrame
    root: str | None


def build(rows: DataFrame, group: str, order: list[str], digest: str, shape: Shape = Shape()) -> Manifest:  # noqa: B008
    """The forest over rows whose hex `digest` is a leaf: a tree per value of `group`, and a tree over their roots.

    Leaves stand by `order` and digest, nulls first, groups by value in byte order, null first (a group of its own).
    A table without rows has no root (None).
    """
    ship_package(rows.sparkSession)
    rows = rows.withColumn("digest", F.unhex(digest))
    placed = with_positions(rows, [group], [*order, "digest"])
    groups = materialize(with_positions(placed.select(group).distinct(), [], [group]).select(group, F.col("pos").alias("gid"), F.col("n").alias("n_groups")), "groups")
    named = groups.select(F.col(group).alias("__group"), "gid")
    leaves = materialize(placed.join(named, F.col(group).eqNullSafe(F.col("__group"))).drop("__group"), "leaves")
    tiers = build_tiers(leaves.select("gid", "pos", "n", "digest"), shape, "tier")
    subroots = tiers[-1].select("gid", F.col("digest").alias("subroot"))
    top = build_tiers(subroots.join(groups, "gid").select(F.lit(0).cast("long").alias("gid"), F.col("gid").alias("pos"), F.col("n_groups").alias("n"), F.col("subroot").alias("digest")), shape, "top-tier")
    root = top[-1].select(F.lower(F.hex("digest"))).first()
    of_group = paths_below(top, shape, None).select(F.col("block").alias("gid"), F.lit(0).cast("long").alias("block"), "path")
    paths = paths_below(tiers[1:], shape, of_group)
    blocks = tiers[0].join(paths, ["gid", "block"]).join(subroots, "gid").select("gid", "block", "n", "nodes", "states", "subroot", "path")
    return Manifest(shape, leaves, groups, materialize(blocks, "blocks"), root[0] if root else None)


def prove(manifest: Manifest, keep: list[str], replaced: str) -> DataFrame:
    """For every leaf the columns of `keep`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root` and `verified`.

    `proof_sha256` is the SHA-256 of the hex digests of all siblings from the leaf to the root; `folded_root` is the root that
    follows if the leaf's digest is the binary column `replaced` (null: the leaf itself) and nothing else changes.
    """
    shape, root = manifest.shape, manifest.root or ""
    fields = {f.name: f.dataType.simpleString() for f in manifest.leaves.schema.fields}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in keep] + ["leaf string", "subroot string", "root string", "proof_sha256 string", "folded_root string", "verified boolean"])

    def fold(leaves: pa.Table, block: pa.Table) -> pa.Table:
        stored = block.slice(0, 1).to_pylist()[0]
        tree = stored_tree(shape, stored["nodes"], stored["states"], stored["n"], stored["block"])
        position = leaves.column("pos").to_numpy() - stored["block"] * shape.fan
        own, other = leaves.column("digest").to_pylist(), leaves.column(replaced).to_pylist()
        ends = to_bytes(fold_path(tree.fold(position, to_words(b"".join(y or x for x, y in zip(own, other)))), stored["path"])).hex()
        folded = [ends[k : k + 64] for k in range(0, len(ends), 64)]
        hexed = [to_bytes(x).hex().encode() for x in tree.nodes]
        above = b"".join(step["others"].hex().encode() for step in stored["path"])
        proofs = []
        for p in position.tolist():
            siblings = []
            for text in hexed[:-1]:
                first = p - p % shape.arity
                siblings.append(text[first * 64 : p * 64] + text[(p + 1) * 64 : (first + shape.arity) * 64])
                p //= shape.arity
            proofs.append(hashlib.sha256(b"".join(siblings) + above).hexdigest())
        n = len(own)
        columns = [pa.array([x.hex() for x in own]), pa.array([stored["subroot"].hex()] * n), pa.array([root] * n), pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array([x == root for x in folded], pa.bool_())]
        return pa.table([*[leaves.column(c) for c in keep], *columns], names=[*keep, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    rows = _in_blocks(manifest.leaves, shape).select("gid", "block", "pos", "digest", replaced, *keep).groupBy("gid", "block")
    return rows.cogroup(manifest.blocks.groupBy("gid", "block")).applyInArrow(fold, schema)


def document_manifest(docs: DataFrame, tampered: Column | None = None, shape: Shape = Shape()) -> DataFrame:  # noqa: B008
    """The proofs of all documents; rows that meet `tampered` are folded with `n_chars` greater by one.

    Leaves are digests of doc_id, source, lang, n_chars and text, in trees per lang by doc_id. Null ids come first, equal
    ids by digest, and repeated rows are equal leaves of their own. Null and empty texts differ (`-` and `0:`). A null
    n_chars stays null. Other columns are not part of a leaf. No rows give no rows.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [(c.cast("decimal(20,0)") + 1).cast("string") if name == "n_chars" else c for name, c in zip(("doc_id", "source", "lang", "n_chars", "text"), fields)]
    changed = F.when(F.coalesce(tampered if tampered is not None else F.lit(False), F.lit(False)), F.unhex(row_digest(*more)))
    rows = docs.select("doc_id", "lang", row_digest(*fields).alias("digest"), changed.alias("changed"))
    return prove(build(rows, "lang", ["doc_id"], "digest", shape), ["doc_id"], "changed")
