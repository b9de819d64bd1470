"""Passages that occur in more than one document, found from winnowed anchors and extended to maximal repeats.

Of the seeds (hashes of a few words) in every window of `length` words the smallest is the window's anchor, so equal windows have
equal anchors, and a text keeps about two anchors for as many seeds as a window holds. Documents are joined on their
anchors. Around an anchor that several documents share, the match is extended both ways through all windows
that have this anchor: they are compared by hashes of all their words, and a window counts as repeated if a
document with a smaller key holds it too. Windows in a row merge to maximal repeats; their words go.

Equal texts are one content and are not extended. A window is identified by 128 bits, its anchor's hash and its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import broadcast_if_small, by_bytes, map_batches, numbered_columns, ship_package, strings
from tickloom.llm.shingles import exact_token_chunks, mix, run_hashes
from tickloom.session import materialize

#: Words of the shortest repeat, and words of a seed.
LENGTH, SEED = 50, 16
#: Anchor occurrences that one task extends, and of one anchor that one task compares before the rest.
BUCKET, PART = 1 << 15, 1 << 12

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
NOTHING = hashlib.sha256(b"").hexdigest()


def _ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... of so many numbers, then the same for the next."""
    ends = np.cumsum(length)
    return np.repeat(first - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def anchor_runs(words: np.ndarray, bounds: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows of texts whose words stand after each other: text, hash, first and last window (by place of its first word)."""
    windows = np.maximum(np.diff(bounds) - length + 1, 0)
    start = _ranges(bounds[:-1], windows)
    if not len(start):
        return start, np.zeros(0, np.uint64), start, start
    low = run_hashes(words, seed)
    at = np.arange(len(low), dtype=np.int32 if len(low) < 1 << 31 else np.int64)
    held, width = 1, length - seed + 1
    while held < width:
        step = min(held, width - held)
        right = low[step:] < low[:-step]
        low, at = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step])
        held += step
    text = np.repeat(np.arange(len(windows)), windows)
    place = at[start]
    new = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    last = np.append(new[1:], len(start)) - 1
    return text[new], low[start[new]], start[new], start[last]


def _lists(values: np.ndarray, owner: np.ndarray, rows: int) -> pa.ListArray:
    ends = np.searchsorted(owner, np.arange(rows + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _seeder(length: int, seed: int):
    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in by_bytes(whole, whole.num_columns - 1)):
            n_words, whole_sha, anchors = [], [], []
            for text in strings(batch.column(batch.num_columns - 1)):
                words = text.encode().split()
                n_words.append(len(words))
                whole_sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            for words, bounds in exact_token_chunks(batch.column(batch.num_columns - 1)):
                text, hashes, _, _ = anchor_runs(words, bounds, length, seed)
                anchors.append(_lists(hashes.view(np.int64), text, len(bounds) - 1))
            out = [pa.array(n_words, pa.int64()), pa.array(whole_sha, pa.string()), pa.concat_arrays(anchors)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], names=[*batch.schema.names[:-1], "n_words", "whole_sha", "anchors"])

    return seeds


def _extender(length: int, seed: int, buckets: int):
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in by_bytes(whole, 3)):
            row = 0
            for words, bounds in exact_token_chunks(batch.column(3)):
                rows = batch.slice(row, len(bounds) - 1)
                row += rows.num_rows
                text, hashes, first, last = anchor_runs(words, bounds, length, seed)
                wanted = rows.column(2)
                size = np.diff(wanted.offsets.to_numpy())
                owner = np.repeat(np.arange(rows.num_rows), size)
                fields = wanted.flatten()
                run = np.searchsorted(text, owner) + fields.field("at").to_numpy()
                members = fields.field("members").to_numpy()
                content, doc = (rows.column(c).to_numpy()[owner] for c in (0, 1))
                parts = -(-members // PART)
                part = (mix(content.astype(_U)) % parts.astype(_U)).astype(np.int64)
                bucket = mix(hashes[run] + part.astype(_U) * _STEP) % _U(buckets)
                long = last[run] - first[run] + 1
                flat = run_hashes(words, length)[_ranges(first[run], long)]
                blob = pa.Array.from_buffers(pa.binary(), len(run), [None, pa.py_buffer(np.append(0, np.cumsum(long * 8)).astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
                columns = [bucket.astype(np.int64), hashes[run].view(np.int64), parts, doc, content, first[run] - bounds[owner]]
                yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in columns], blob], names=["bucket", "anchor", "parts", "doc", "content", "first", "windows"])

    return extend


def _compare(bucket: pa.Table) -> pa.Table:
    """Runs of windows that a smaller document of the bucket holds too; of anchors in several parts also the smallest document of each window."""
    anchor, parts, doc, content, first = (bucket.column(c).to_numpy() for c in ("anchor", "parts", "doc", "content", "first"))
    blobs = bucket.column("windows").to_pylist()
    size = np.array([len(b) // 8 for b in blobs])
    window, owner = np.frombuffer(b"".join(blobs), np.int64), np.repeat(np.arange(len(blobs)), size)
    place = _ranges(first, size)
    order = np.lexsort((doc[owner], window, anchor[owner]))
    a, w, d = anchor[owner][order], window[order], doc[owner][order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])])
    least = np.empty(len(order), np.int64)
    least[order] = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    repeated = doc[owner] > least
    begin = repeated & ~np.concatenate([[False], repeated[:-1] & (owner[1:] == owner[:-1])])
    end = repeated & ~np.concatenate([repeated[1:] & (owner[1:] == owner[:-1]), [False]])
    begin, end = np.flatnonzero(begin), np.flatnonzero(end)
    rest = np.flatnonzero(~repeated & (parts[owner] > 1))
    both = np.concatenate([begin, rest])
    nulls = np.arange(len(both)) < len(begin)
    kept = [pa.array(x[both], pa.int64(), mask=nulls) for x in (anchor[owner], window, doc[owner])]
    counts = np.concatenate([end - begin + 1, np.ones(len(rest), np.int64)])
    return pa.table({"content": pa.array(content[owner][both], pa.int64()), "first": pa.array(place[both], pa.int64()), "windows": pa.array(counts, pa.int64()), "anchor": kept[0], "window": kept[1], "doc": kept[2]})


def _spans(repeats: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal ranges of words (first, and after the last) under the runs of windows."""
    out: list[tuple[int, int]] = []
    for first, end in sorted((r["first"], r["first"] + r["windows"] + length - 1) for r in repeats):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def _cutter(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for batch in (part for whole in batches for part in by_bytes(whole, whole.num_columns - 1)):
            spans, kept_words = [], []
            for text, repeats in zip(strings(batch.column(batch.num_columns - 1)), batch.column(batch.num_columns - 2).to_pylist()):
                words, kept, at = text.encode().split(), [], 0
                spans.append(_spans(repeats, length))
                for first, end in spans[-1]:
                    kept += words[at:first]
                    at = end
                kept_words.append(b" ".join(kept + words[at:]))
            removed = [sum(b - a for a, b in s) for s in spans]
            ranges = pa.array([[{"first": a, "end": b} for a, b in s] for s in spans], kind)
            columns = [pa.array(removed, pa.int64()), ranges, pa.array(kept_words, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], names=[*batch.schema.names[:-2], "n_removed", "spans", "kept_text"])

    return cut


def _digest(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _repeats(texts: DataFrame, length: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """For `texts` (`doc`, `digest`, `text`, more columns before them): their seeds, and `digest`, `doc` (smallest), `repeats` of every content with a window."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[:-1])
    seeds = materialize(map_batches(texts, _seeder(length, seed), f"{fields}, n_words bigint, whole_sha string, anchors array<bigint>"), "seeds")
    contents = seeds.where(F.size("anchors") > 0).groupBy("digest").agg(F.min("doc").alias("doc"), F.any_value("anchors").alias("anchors"))
    contents = materialize(contents.withColumn("content", F.monotonically_increasing_id()), "contents")

    found = contents.select("content", "doc", F.posexplode("anchors").alias("at", "anchor"))
    shared = found.groupBy("anchor").agg(F.count("*").alias("members"), F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    shared = materialize(shared.select("anchor", "members"), "shared-anchors")
    total = shared.agg(F.sum("members")).first()[0] or 0
    wanted = found.join(shared, "anchor").groupBy("content").agg(F.collect_list(F.struct("at", "members")).alias("wanted"))
    wanted = materialize(contents.drop("anchors").join(wanted, "content"), "wanted")

    few = texts.select("doc", "digest", "text").join(broadcast_if_small(wanted.select("digest", "doc")), ["digest", "doc"], "left_semi")
    asked = few.join(wanted, ["digest", "doc"]).select("content", "doc", "wanted", "text")
    schema = "bucket long, anchor long, parts long, doc long, content long, first long, windows binary"
    around = map_batches(asked, _extender(length, seed, max(1, -(-total // BUCKET))), schema)
    compared = around.groupBy("bucket").applyInArrow(_compare, "content long, first long, windows long, anchor long, window long, doc long")
    compared = materialize(compared, "compared")
    # The smallest document of a window within each part of a very common anchor, against those of the other parts.
    apart = compared.where("doc IS NOT NULL")
    least = apart.groupBy("anchor", "window").agg(F.min("doc").alias("least"))
    later = apart.join(least, ["anchor", "window"]).where("doc > least").select("content", "first", "windows")
    marks = compared.where("doc IS NULL").select("content", "first", "windows").union(later)
    spans = marks.groupBy("content").agg(F.collect_list(F.struct("first", "windows")).alias("repeats"))
    return seeds, materialize(contents.select("content", "digest", "doc").join(spans, "content", "left").drop("content"), "repeats")


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit((1 << 63) - 1))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """For every row the key, `n_words`, `n_removed`, `kept_sha256` and `spans` (first word, and the one after the last) of what goes.

    A word goes if a window of `length` words that covers it also begins in a row with a smaller key; keys are whole numbers. Words
    are runs of anything but ASCII white space, compared as they are. Rows of one key are not repeats of each other;
    a null key counts as the largest. Null, empty and short texts lose nothing.
    """
    ship_package(docs.sparkSession)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.col(key).alias("__id"), _key(key).alias("doc"), _digest(body).alias("digest"), body.alias("text"))
    seeds, repeats = _repeats(texts, length, seed)
    cut = _cut(texts.drop("__id"), repeats, length, []).select("doc", "digest", "n_removed", "spans", F.sha2("kept_text", 256).alias("kept"))
    cut = cut.groupBy("doc", "digest").agg(*[F.any_value(c).alias(c) for c in ("n_removed", "spans", "kept")])
    rows = seeds.drop("anchors").join(repeats.select("digest", F.col("doc").alias("first_doc")), "digest", "left").join(cut, ["doc", "digest"], "left")
    later = F.col("doc") > F.col("first_doc")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("end")))
    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    return rows.select(
        F.col("__id").alias(key),
        "n_words",
        F.when(later, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(later, F.lit(NOTHING)).otherwise(F.coalesce("kept", "whole_sha")).alias("kept_sha256"),
        F.when(later, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
    )


def _cut(texts: DataFrame, repeats: DataFrame, length: int, keep: list[str]) -> DataFrame:
    """Texts that lose some words but are the first of their content: `doc`, `digest`, the columns of `keep`, what goes and what stays."""
    marked = repeats.where("repeats IS NOT NULL")
    few = texts.join(broadcast_if_small(marked.select("digest", "doc")), ["digest", "doc"], "left_semi")
    asked = few.join(marked, ["digest", "doc"]).select("doc", "digest", *keep, "repeats", "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema.fields[:-2])
    return map_batches(asked, _cutter(length), f"{fields}, n_removed long, spans array<struct<first:bigint,end:bigint>>, kept_text string")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """The rows of `docs`, whole, with the words of `repeated_spans` gone from the text; what is left is joined by single spaces.

    Texts that lose nothing stay as they are, and one that loses all its words becomes empty; no row goes.
    """
    ship_package(docs.sparkSession)
    plain, _ = numbered_columns(docs)
    own = {c: f"__{k}" for k, c in enumerate(docs.columns)}
    texts = plain.withColumns({"doc": _key(own[key]), "text": F.coalesce(F.col(own[text]).cast("string"), F.lit(""))}).withColumn("digest", _digest(F.col("text")))
    _, repeats = _repeats(texts.select("doc", "digest", "text"), length, seed)
    rest = [own[c] for c in docs.columns if c != text]
    cut = _cut(texts.select(*rest, "doc", "digest", "text"), repeats, length, rest).select(*rest, F.col("kept_text").alias(own[text]))
    first = repeats.select("digest", F.col("doc").alias("first_doc"), F.col("repeats").isNotNull().alias("marked"))
    others = texts.join(first, "digest", "left").where("first_doc IS NULL OR doc > first_doc OR NOT marked")
    others = others.select(*rest, F.when(F.col("doc") > F.col("first_doc"), F.lit("")).otherwise(F.col(own[text]).cast("string")).alias(own[text]))
    return others.unionByName(cut).select(*[F.col(own[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
