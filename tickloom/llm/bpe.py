"""Byte-pair encoding and decoding with a public byte-level vocabulary, by forced-boundary splitting.

A pair of bytes that occurs next to each other inside no token of the vocabulary can
never be joined by a merge: between two such bytes there is a cut in every encoding.
A text is first cut by the vocabulary's pre-tokenising pattern, which looks at what
follows white space and so needs the whole text; each piece is cut at its forced
boundaries, the fragments are encoded on their own, and the ids are put together
again. Pieces repeat, so a bounded number of them is remembered.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tickloom.llm.common import map_batches, strings

#: The pre-tokenising pattern of the vocabulary.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same in the syntax of `re`, which is faster but counts some numbers as letters and some controls as space.
FAST_PIECES = r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: Controls that `re` counts as white space.
CONTROLS = "\x1c\x1d\x1e\x1f"
#: Pieces remembered before the older half is forgotten, and the longest piece that is remembered.
REMEMBERED = 1 << 18
LONG = 64
#: Characters of texts that are held as pieces at a time.
CHARS = 2_000_000
#: Fragments are merged together with others of like length, up to these numbers of bytes.
CLASSES = (1, 4, 8, 12, 16, 32, 64)


def default_path() -> str:
    """The vocabulary file that the contract names."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=1)
def _odd_characters() -> frozenset[str]:
    """Characters on which the two patterns differ: numbers that are no decimal digits, and separator controls."""
    odd = {c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and unicodedata.category(c) != "Nd"}
    return frozenset(odd | {c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("No", "Nl")} | set(CONTROLS))


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PairTable:
    """Rank of a pair of ids, looked up for whole arrays: a cascade of hash tables, each holding what the ones before have no free slot for."""

    SLOTS = 17

    def __init__(self, pairs: np.ndarray) -> None:
        self.none = len(pairs)
        keys, ranks, self.levels = (pairs[:, 0].astype(np.uint64) << np.uint64(32)) | pairs[:, 1].astype(np.uint64), np.arange(len(pairs)), []
        while len(keys):
            factor = np.uint64(0x9E3779B97F4A7C15 + 2 * len(self.levels))
            slot = self._slot(keys, factor)
            _, first = np.unique(slot, return_index=True)
            table_keys, table_ranks = np.full(1 << self.SLOTS, np.iinfo(np.uint64).max, np.uint64), np.full(1 << self.SLOTS, self.none, np.int32)
            table_keys[slot[first]], table_ranks[slot[first]] = keys[first], ranks[first]
            self.levels.append((factor, table_keys, table_ranks))
            keys, ranks = np.delete(keys, first), np.delete(ranks, first)

    def _slot(self, keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return (((keys ^ (keys >> np.uint64(29))) * factor) >> np.uint64(64 - self.SLOTS)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair; the number of merges where a pair is none."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        out = np.full(keys.shape, self.none, np.int32)
        for factor, table_keys, table_ranks in self.levels:
            slot = self._slot(keys, factor)
            out = np.where(table_keys[slot] == keys, table_ranks[slot], out)
        return out


class Codec:
    """Encoder and decoder of one vocabulary file; plain data, so it can be sent to workers."""

    def __init__(self, vocabulary: str) -> None:
        model = json.loads(vocabulary)
        symbols = byte_symbols()
        of_symbol = {s: b for b, s in enumerate(symbols)}
        vocab = model["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in model["added_tokens"]}
        token_bytes = {i: bytes(of_symbol[c] for c in t) for t, i in vocab.items() if all(c in of_symbol for c in t)}
        token_bytes |= {i: t.encode() for t, i in self.special.items()}
        self.text_of = {i: str(i) for i in token_bytes}
        self.bytes_of = {str(i): b for i, b in token_bytes.items()}
        self.byte_id = np.array([vocab[s] for s in symbols], np.int32)
        self.forced = np.ones(1 << 16, bool)
        for i, b in token_bytes.items():
            if i not in self.special.values():
                for left, right in zip(b, b[1:]):
                    self.forced[left << 8 | right] = False
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["model"]["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.pairs = PairTable(np.array([(vocab[a], vocab[b]) for a, b in pairs]).reshape(-1, 2))
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self._split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._begin()

    def _begin(self) -> None:
        self._newer: dict[str, str] = {}
        self._older: dict[str, str] = {}
        self._fast = re.compile(FAST_PIECES)
        self._exact = regex.compile(PIECES)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_newer", "_older", "_fast", "_exact")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._begin()

    def pieces(self, text: str) -> list[str]:
        """What the pre-tokenising pattern finds between special tokens; the pieces and special tokens cover the text."""
        if self._split_special is not None and any(s in text for s in self.special):
            return [p for part in self._split_special.split(text) for p in ([part] if part in self.special else self.pieces(part))]
        odd = any(c in text for c in CONTROLS) if text.isascii() else not _odd_characters().isdisjoint(text)
        return (self._exact if odd else self._fast).findall(text)

    def encode_pieces(self, pieces: list[str]) -> list[str]:
        """Ids of each piece as text: cut at forced boundaries, encode the fragments, put their ids together."""
        raw = [p.encode() for p in pieces]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(p) for p in raw])
        cut = np.zeros(len(flat) + 1, bool)
        cut[1:-1] = self.forced[flat[:-1].astype(np.int32) << 8 | flat[1:]]
        cut[0] = True
        cut[ends] = True
        at = np.flatnonzero(cut)
        start, length = at[:-1], np.diff(at)
        fragment_ids: list[list[int]] = [[]] * len(start)
        low = 0
        for high in CLASSES:
            these = np.flatnonzero((length > low) & (length <= high))
            if len(these):
                for k, ids in zip(these.tolist(), self.merge(flat, start[these], length[these], high), strict=True):
                    fragment_ids[k] = ids
            low = high
        for k in np.flatnonzero(length > CLASSES[-1]).tolist():
            fragment_ids[k] = self.merge_long(flat[start[k] : start[k] + length[k]])
        text_of = self.text_of
        joined = [",".join([text_of[i] for i in ids]) for ids in fragment_ids]
        bounds = np.searchsorted(start, ends).tolist()
        return [joined[a] if b == a + 1 else ",".join(joined[a:b]) for a, b in zip([0, *bounds], bounds)]

    def merge(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> list[list[int]]:
        """Ids of many fragments of up to `width` bytes: each round joins the leftmost pair of lowest rank of every fragment."""
        columns = np.arange(width)
        there = columns < length[:, None]
        ids = np.where(there, self.byte_id[flat[np.minimum(start[:, None] + columns, len(flat) - 1)]], -1)
        ranks = np.full(ids.shape, self.pairs.none, np.int32)
        ranks[:, :-1] = np.where(there[:, 1:], self.pairs.rank(ids[:, :-1], ids[:, 1:]), self.pairs.none)
        out, rows = ids.copy(), np.arange(len(ids))
        while len(rows):
            k = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), k]
            going = best < self.pairs.none
            if not going.all():
                out[rows[~going]] = ids[~going]
                rows, ids, ranks, k, best = rows[going], ids[going], ranks[going], k[going], best[going]
                if not len(rows):
                    break
            one = np.arange(len(rows))
            ids[one, k] = self.made[best]
            moved = np.minimum(columns + (columns > k[:, None]), width - 1)
            ids = np.take_along_axis(ids, moved, 1)
            ids[:, -1] = -1
            ranks = np.take_along_axis(ranks, np.minimum(columns + (columns >= k[:, None]), width - 1), 1)
            ranks[:, -1] = self.pairs.none
            right = ids[one, np.minimum(k + 1, width - 1)]
            ranks[one, k] = np.where((k + 1 < width) & (right >= 0), self.pairs.rank(ids[one, k], right), self.pairs.none)
            before = np.flatnonzero(k > 0)
            ranks[before, k[before] - 1] = self.pairs.rank(ids[before, k[before] - 1], ids[before, k[before]])
        sizes = (out >= 0).sum(1).tolist()
        return [row[:n] for row, n in zip(out.tolist(), sizes, strict=True)]

    def merge_long(self, fragment: np.ndarray) -> list[int]:
        """The same for one long fragment, with a heap of pairs over a linked list: no pass over all ids per merge."""
        ids: list[int | None] = self.byte_id[fragment].tolist()
        n, rank = len(ids), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], k, p) for k, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            best, k, pair = heapq.heappop(heap)
            j = after[k]
            if ids[k] is None or j >= n or (ids[k], ids[j]) != pair:
                continue
            ids[k], ids[j] = int(self.made[best]), None
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (ids[a], ids[b]) in rank:
                    heapq.heappush(heap, (rank[ids[a], ids[b]], a, (ids[a], ids[b])))
        return [x for x in ids if x is not None]

    def encode(self, texts: list[str]) -> list[str]:
        """Decimal ids of whole texts, each joined by commas. Few texts are held as pieces at a time."""
        out: list[str] = []
        begin = size = 0
        for k, text in enumerate(texts):
            size += len(text)
            if size > CHARS or k == len(texts) - 1:
                out += self._encode(texts[begin : k + 1])
                begin, size = k + 1, 0
        return out

    def _encode(self, texts: list[str]) -> list[str]:
        split = [self.pieces(t) for t in texts]
        known: dict[str, str] = {s: str(i) for s, i in self.special.items()}
        newer, older = self._newer, self._older
        missing, again = [], {}
        for piece in set().union(*split):
            if piece not in known:
                ids = newer.get(piece)
                if ids is None:
                    ids = older.get(piece)
                    if ids is None:
                        missing.append(piece)
                        continue
                    again[piece] = ids
                known[piece] = ids
        found = dict(zip(missing, self.encode_pieces(missing), strict=True)) if missing else {}
        known |= found
        found |= again
        if len(newer) + len(found) > REMEMBERED:
            self._older, self._newer = newer, {}
        self._newer |= {p: ids for p, ids in found.items() if len(p) <= LONG}
        return [",".join(map(known.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: str) -> str:
        """The text of decimal ids joined by commas; bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.bytes_of.__getitem__, ids.split(","))).decode("utf-8", "replace") if ids else ""


def codec(path: str | None = None) -> Codec:
    with open(path or default_path(), encoding="utf-8") as f:
        return Codec(f.read())


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, decode: bool = False) -> DataFrame:
    """Encode the whole text of every row, and decode the ids again if asked to.

    Returns one row per row of `docs`: the key, `n_tokens` long, `token_ids` string (decimal
    ids joined by commas, which a cast of `split(token_ids, ',')` turns into an array) and,
    with `decode`, `decoded` string. A null or empty text has no ids and decodes to the empty
    text; null and repeated keys are kept as they are; other columns are neither read nor
    returned. The vocabulary (a bounded file, read once by the driver) is broadcast.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(codec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for batch in batches:
            ids = coder.encode(strings(batch.column(1)))
            counts = pa.array([x.count(",") + 1 if x else 0 for x in ids], pa.int64())
            out = [batch.column(0), counts, pa.array(ids, pa.string())]
            if decode:
                out.append(pa.array([coder.decode(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=names)

    names = [key, "n_tokens", "token_ids"] + ["decoded"] * decode
    key_type = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, n_tokens bigint, token_ids string" + ", decoded string" * decode
    return map_batches(docs.select(key, docs[text].cast("string")), run, schema)


def count_tokens(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Only the encoded length of every row, as `n_tokens` long; null texts have length 0."""
    shared = docs.sparkSession.sparkContext.broadcast(codec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for batch in batches:
            counts = [x.count(",") + 1 if x else 0 for x in coder.encode(strings(batch.column(0)))]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], names=["n_tokens"])

    return map_batches(docs.select(docs[text].cast("string")), run, "n_tokens bigint")
