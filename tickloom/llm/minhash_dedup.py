"""Near-duplicate documents by ProbMinHash sketches over weighted word shingles, banding and exact verification.

Each document is the multiset of its five-word shingles. Every shingle sends exponential
arrivals, at a rate of its count, to random registers; a register keeps the shingle that arrives
first, and arrivals end once no register can still change. Two documents agree in a register with
the probability that is their probability Jaccard similarity. Bands of registers are buckets; in a
bucket, all pairs of different texts are compared exactly, in tiles, and only the links of a
spanning forest leave a tile, so that a large group of copies makes no more rows than it has members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import broadcast_if_small, map_batches, numbered_columns, ship_package
from tickloom.llm.components import connected_components, spanning_forest
from tickloom.llm.shingles import mix, probability_jaccard, shingles, weighted, word_hashes
from tickloom.session import materialize

THRESHOLD = 0.8
#: Bands and registers of a band: a pair at the threshold shares no band with probability (1 - 0.8^5)^25 = 5e-5.
BANDS, ROWS = 25, 5
#: Members of a bucket that one side of a tile holds, and their shingles, on average.
TILE, TILE_SHINGLES = 1024, 1 << 21
#: Shingles of a batch that arrive at registers together, and columns of a block of the comparison.
ELEMENTS = 1 << 18
COLUMNS = 4096

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def sketch(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """ProbMinHash registers of many weighted sets (distinct elements, counts) at once; an empty set has zeros."""
    n = len(sets)
    element = np.concatenate([s[0] for s in sets]) if n else np.zeros(0, np.uint64)
    weight = np.concatenate([s[1] for s in sets]).astype(float) if n else np.zeros(0)
    owner = np.repeat(np.arange(n), [len(s[0]) for s in sets])
    first, kept = np.full(n * registers, np.inf), np.zeros(n * registers, np.uint64)
    time, state, latest = np.zeros(len(element)), element.copy(), np.full(n, np.inf)
    while len(element):
        state = state + _STEP
        drawn = mix(state)
        time = time - np.log1p(-((drawn >> _U(11)).astype(float) * 2.0**-53)) / weight
        going = time < latest[owner]
        element, weight, state, time, drawn, owner = element[going], weight[going], state[going], time[going], drawn[going], owner[going]
        register = owner * registers + (mix(drawn) % _U(registers)).astype(np.int64)
        np.minimum.at(first, register, time)
        won = time == first[register]
        kept[register[won]] = element[won]
        latest = first.reshape(n, registers).max(1)
    return kept.reshape(n, registers)


def band_hashes(sketches: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One hash of each band of registers; the hashes of different bands differ."""
    out = np.repeat(mix(np.arange(1, bands + 1, dtype=np.uint64))[None, :], len(sketches), 0)
    for r in range(rows):
        out = mix(out * _STEP + sketches[:, r : bands * rows : rows])
    return out.view(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (text last) with a digest of their words, their band hashes and their number of shingles."""
    for batch in batches:
        digests, sizes, bands, held, elements = [], [], [], [], 0
        for words in word_hashes(batch.column(batch.num_columns - 1)):
            digests.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest())
            held.append(weighted(shingles(words)))
            sizes.append(int(held[-1][1].sum()))
            elements += len(held[-1][0])
            if elements > ELEMENTS:
                bands.append(band_hashes(sketch(held, BANDS * ROWS)))
                held, elements = [], 0
        if held:
            bands.append(band_hashes(sketch(held, BANDS * ROWS)))
        flat = np.concatenate(bands).ravel() if bands else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(np.arange(0, len(digests) * BANDS + 1, BANDS, dtype=np.int32), pa.array(flat))
        out = [pa.array(digests, pa.binary()), lists, pa.array(sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, "__content", "__bands", "__size"])


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [weighted(shingles(w)) for w in word_hashes(batch.column(1))]
        values = pa.array([s.view(np.int64) for s, _ in sets], pa.list_(pa.int64()))
        counts = pa.array([n if n.max() > 1 else None for _, n in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), values, counts], names=["node", "shingles", "counts"])


def tile_links(sets: list[tuple[np.ndarray, np.ndarray]], side: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose exact similarity reaches the threshold, as positions in `sets`.

    Pairs with the same `side` count unless there are two sides. Common shingles of all pairs are counted by matrix
    products; that gives the similarity of sets without repeats, and for others a bound that few pairs pass.
    """
    n = len(sets)
    total = np.array([c.sum() for _, c in sets], float)
    repeats = np.array([c.max() > 1 for _, c in sets])
    owner = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    share = np.concatenate([c / t for (_, c), t in zip(sets, total)])
    _, column, times = np.unique(np.concatenate([s for s, _ in sets]), return_inverse=True, return_counts=True)
    common = times[column] > 1
    owner, share, column = owner[common], share[common], np.unique(column[common], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, share, column = owner[order], share[order], column[order]
    both = np.zeros((n, n), np.float32)
    part = np.zeros((n, n), np.float32) if repeats.any() else None
    last = int(column[-1]) + 1 if len(column) else 0
    for begin in range(0, last, COLUMNS):
        a, b = np.searchsorted(column, (begin, begin + COLUMNS))
        block = np.zeros((n, min(COLUMNS, last - begin)), np.float32)
        block[owner[a:b], column[a:b] - begin] = 1
        both += block @ block.T
        if part is not None:
            shares = np.zeros_like(block)
            shares[owner[a:b], column[a:b] - begin] = share[a:b]
            part += shares @ block.T
    sizes = np.array([len(s) for s, _ in sets], float)
    plain = ~repeats[:, None] & ~repeats
    counted = both.astype(float)
    certain = plain & (counted >= threshold * (sizes[:, None] + sizes - counted) - 1e-9)
    possible = ~plain & (np.minimum(part, part.T) >= threshold - 1e-4) if part is not None else np.zeros_like(plain)
    if len(set(side.tolist())) > 1:
        across = side[:, None] != side
        certain, possible = certain & across, possible & across
    return spanning_forest(certain, possible, lambda u, v: probability_jaccard(sets[u], sets[v]) >= threshold - 1e-12)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray | None]:
    """The lists of a column as views of its numbers; None for null."""
    out: list[np.ndarray | None] = []
    for chunk in column.chunks:
        values, ends, there = chunk.values.to_numpy(), chunk.offsets.to_numpy(), chunk.is_valid().to_numpy(zero_copy_only=False)
        out += [values[a:b] if ok else None for a, b, ok in zip(ends[:-1], ends[1:], there)]
    return out


def _tile(threshold: float):
    def links(table: pa.Table) -> pa.Table:
        nodes, side = table.column("node").to_numpy(), table.column("chunk").to_numpy()
        order = np.argsort(nodes)
        values, counts = _lists(table.column("shingles")), _lists(table.column("counts"))
        sets = [(values[k].view(np.uint64), np.ones(len(values[k]), np.int64) if counts[k] is None else counts[k]) for k in order]
        pairs = tile_links(sets, side[order], threshold)
        a, b = [nodes[order[u]] for u, _ in pairs], [nodes[order[v]] for _, v in pairs]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return links


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, carry: list[str] | None = None) -> DataFrame:
    """Classes of documents that are linked by similarities of at least `threshold`.

    Returns for every row the key, the columns of `carry`, `class_id` (smallest key of the class), `class_size`
    (rows in it) and `kept` (true for one row of each class: the smallest key, of repeated rows one). Texts with
    the same words are one class; case and what stands between words do not matter. Null, empty and wordless texts
    are each a class of their own. Null keys come after all others. Keys need not be unique.
    """
    ship_package(docs.sparkSession)
    kept_columns = [key, *(c for c in carry or [] if c not in (key, text))]
    rows = docs.select(*kept_columns, F.monotonically_increasing_id().alias("__row"), F.col(text).cast("string").alias("__text"))
    of_row = _classes(rows, key, threshold)
    return of_row.select(
        *kept_columns,
        F.when(F.col("best").isNull(), F.col(key)).otherwise(F.col("best.key")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        (F.col("best").isNull() | (F.col("best.row") == F.col("__row"))).alias("kept"),
    )


def _classes(rows: DataFrame, key: str, threshold: float) -> DataFrame:
    """All columns of `rows` (`__row` unique, `__text` last), `best` (key and row of the class's first row; null for texts without words) and `class_size`."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    stored = materialize(map_batches(rows, _sketched, f"{fields}, __content binary, __bands array<bigint>, __size bigint"), "sketches")

    first = F.struct(F.col(key).isNull().alias("missing"), F.col(key).alias("key"), F.col("__row").alias("row"))
    contents = stored.where("__size > 0").groupBy("__content", "__bands").agg(F.min("__row").alias("node"), F.min(first).alias("first"), F.count("*").alias("copies"), F.max("__size").alias("size"))
    contents = materialize(contents, "contents")

    # One narrow row per text and band, twice: to count, and to pick the members of buckets with several.
    in_bucket = contents.select("node", F.explode("__bands").alias("hash"))
    several = in_bucket.groupBy("hash").agg(F.count("*").alias("members")).where("members > 1")
    members = materialize(in_bucket.join(several, "hash"), "members")
    # Buckets with the same members are compared once.
    checks = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"check{k}") for k in (0, 1)]
    buckets = members.groupBy("hash").agg(F.count("*").alias("members"), *checks)
    chosen = buckets.groupBy("members", "check0", "check1").agg(F.min("hash").alias("hash")).select("hash")
    members = materialize(members.join(chosen, "hash", "left_semi"), "chosen-members")

    needed = broadcast_if_small(members.select(F.col("node").alias("__row")).distinct())
    shingled = map_batches(stored.select("__row", "__text").join(needed, "__row").select("__row", "__text"), _shingled, "node bigint, shingles array<bigint>, counts array<bigint>")
    # A side of a tile holds few texts, and fewer of long ones.
    weight = members.join(contents.select("node", "size"), "node").groupBy("hash").agg(F.sum("size").alias("weight"))
    chunks = F.greatest(F.ceil(F.col("members") / TILE), F.ceil(F.col("weight") / TILE_SHINGLES)).cast("int")
    cut = members.join(weight, "hash").withColumn("chunks", F.least(chunks, F.col("members").cast("int")))
    tiles = cut.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tiles = tiles.select("hash", "node", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    links = tiles.join(shingled, "node").groupBy("hash", "i", "j").applyInArrow(_tile(threshold), "a bigint, b bigint")
    component = connected_components(links)

    classed = contents.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = classed.groupBy("component").agg(F.min("first").alias("best"), F.sum("copies").alias("class_size"))
    of_content = classed.select("__content", "component").join(classes, "component").select("__content", "best", "class_size")
    return stored.drop("__bands", "__size").join(of_content, "__content", "left").drop("__content")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, whole, that `near_duplicates` keeps."""
    plain, _ = numbered_columns(docs)
    own_key, own_text = f"__{docs.columns.index(key)}", docs.columns.index(text)
    rows = plain.select("*", F.monotonically_increasing_id().alias("__row"), F.col(f"__{own_text}").cast("string").alias("__text")).drop(f"__{own_text}")
    kept = _classes(rows, own_key, threshold).where("best IS NULL OR best.row = __row")
    back = [F.col("__text" if k == own_text else f"__{k}").cast(docs.schema[c].dataType).alias(c) for k, c in enumerate(docs.columns)]
    return kept.select(*back)
