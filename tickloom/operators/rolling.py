"""Row-frame features of whole segments at a time, on Arrow batches and numpy (FEA-1 .. FEA-6, FEA-15 .. FEA-26, LAB-1, LAB-2).

A window function over the newest n rows reads n rows anew for each row and frame. Here a segment's columns are arrays, and a frame
of n rows is n shifted additions over all rows of a batch. Only the features that are asked for are worked out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows worked on at a time; a segment is never cut, so one that is longer is taken whole.
CHUNK_ROWS = 20_000
#: The columns that the features are made from.
INPUTS = ["last_price", "high_price", "low_price", "change_pct", "volume", "turnover"]


class Frames:
    """The rows of whole segments, in order, and the features over them by name."""

    def __init__(self, column: Callable[[str], np.ndarray], start: np.ndarray):
        n = len(start)
        self.column, self.made, self.size = column, {}, n
        begins = np.flatnonzero(start)
        lengths = np.diff(np.append(begins, n))
        #: 1-based place in the segment, and rows that follow there.
        self.nth = np.arange(n) - np.repeat(begins, lengths) + 1
        self.left = np.repeat(lengths, lengths) - self.nth
        self.begins, self.lengths = begins, lengths

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self.made:
            self.made[name] = MAKERS[name](self) if name in MAKERS else self.column(name)
        return self.made[name]

    def once(self, key: tuple, make: Callable[[], np.ndarray]) -> np.ndarray:
        if key not in self.made:
            self.made[key] = make()
        return self.made[key]

    def back(self, name: str, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The value k rows before, and where there is one."""
        x = self[name]
        out = np.zeros_like(x)
        if k < self.size:
            out[k:] = x[: self.size - k]
        return out, self.nth > k

    def total(self, name: str, n: int) -> np.ndarray:
        def make() -> np.ndarray:
            done = self[name].copy()
            for k in range(1, n):
                value, there = self.back(name, k)
                done += np.where(there, value, 0.0)
            return done

        return self.once(("total", name, n), make)

    def count(self, n: int) -> np.ndarray:
        return np.minimum(self.nth, n)

    def mean(self, name: str, n: int) -> np.ndarray:
        return self.total(name, n) / self.count(n)

    def spread(self, a: str, b: str, n: int) -> np.ndarray:
        """Sum of products of the deviations of two columns from their means over the newest n rows.

        Values are taken from the newest row first, so that equal ones deviate by exactly 0.
        """

        def make() -> np.ndarray:
            x, y = self[a], self[b]
            moved = []
            for k in range(n):
                (u, there), (v, _) = self.back(a, k), self.back(b, k)
                moved.append((np.where(there, u - x, 0.0), np.where(there, v - y, 0.0), there))
            count = self.count(n)
            mean_x, mean_y = sum(m[0] for m in moved) / count, sum(m[1] for m in moved) / count
            return sum(np.where(there, (u - mean_x) * (v - mean_y), 0.0) for u, v, there in moved)

        return self.once(("spread", a, b, n), make)

    def deviation(self, name: str, n: int) -> np.ndarray:
        """Sample deviation; nan for one row."""
        return np.sqrt(self.spread(name, name, n) / np.where(self.count(n) > 1, self.count(n) - 1, np.nan))

    def extreme(self, name: str, n: int, pick: np.ufunc) -> np.ndarray:
        def make() -> np.ndarray:
            done = self[name].copy()
            for k in range(1, n):
                value, there = self.back(name, k)
                done = np.where(there, pick(done, value), done)
            return done

        return self.once(("extreme", name, n, pick), make)

    def ahead(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        x = self["last_price"]
        out = np.full_like(x, np.nan)
        if k < self.size:
            out[: self.size - k] = x[k:]
        there = self.left >= k
        return np.where(there, out, np.nan), there

    def average(self, name: str, span: int) -> np.ndarray:
        """Exponential average, started by the first row: one step for all segments of the chunk."""

        def make() -> np.ndarray:
            a, x = 2.0 / (span + 1), self[name]
            done = x.copy()
            order = np.argsort(-self.lengths, kind="stable")
            begins, lengths = self.begins[order], self.lengths[order]
            for k in range(1, int(lengths[0]) if len(lengths) else 0):
                at = begins[: np.searchsorted(-lengths, -k, side="left")] + k
                done[at] = x[at] * a + done[at - 1] * (1 - a)
            return done

        return self.once(("average", name, span), make)


def _over(top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """The quotient, nan where the divisor is 0."""
    return np.divide(top, bottom, out=np.full(len(top), np.nan), where=bottom != 0)


def _or(value: np.ndarray, default: float) -> np.ndarray:
    return np.where(np.isnan(value), default, value)


def _change(name: str, n: int = 1):
    def make(f: Frames) -> np.ndarray:
        before, there = f.back(name, n)
        return _or(np.where(there, _over(f[name], before), np.nan) - 1, 0.0)

    return make


def _gap(n: int):
    def make(f: Frames) -> np.ndarray:
        mean = f.mean("last_price", n)
        return np.where(np.abs(mean) > 1e-8, _over(f["last_price"] - mean, mean), 0.0)

    return make


def _std(n: int, least: int):
    return lambda f: np.where(f.nth >= least, _or(f.deviation("return_1", n), 0.0), 0.0)


def _to_mean_20(f: Frames, name: str) -> np.ndarray:
    mean = f.mean(name, 20)
    return np.where((f.nth >= 5) & (np.abs(mean) > 1e-8), _over(f[name], mean), np.nan)


def _drawdown(n: int):
    def make(f: Frames) -> np.ndarray:
        top, low = np.full(f.size, -np.inf), np.zeros(f.size)
        for k in range(n - 1, -1, -1):
            price, there = f.back("last_price", k)
            top = np.where(there, np.maximum(top, price), top)
            low = np.where(there, np.minimum(low, _over(price, top) - 1.0), low)
        return np.where(f.nth >= 2, low, 0.0)

    return make


def _money_flow(f: Frames) -> np.ndarray:
    long = f.mean("__flow", 20)
    return np.where((f.nth >= 5) & (np.abs(long) > 1e-8), _over(f.mean("__flow", 5), long) - 1, 0.0)


def _together(f: Frames) -> np.ndarray:
    rows = np.where(f.count(5) > 1, f.count(5) - 1, np.nan)
    value = _over(f.spread("volume", "last_price", 5) / rows, f.deviation("volume", 5) * f.deviation("last_price", 5))
    return np.where((f.nth >= 3) & np.isfinite(value), value, 0.0)


def _move(f: Frames) -> np.ndarray:
    before, there = f.back("last_price", 1)
    return np.where(there, f["last_price"] - before, 0.0)


def _rsi(f: Frames) -> np.ndarray:
    strength = _over(f.mean("__gain", 14), f.mean("__loss", 14))
    return (_or(100 - 100 / (1 + strength), 50.0) - 50) / 50


def _position(f: Frames) -> np.ndarray:
    low, high = f.extreme("last_price", 20, np.minimum), f.extreme("last_price", 20, np.maximum)
    return np.where(high - low > 1e-8, _over(f["last_price"] - low, high - low) - 0.5, 0.0)


def _ahead(h: int, pick: np.ufunc | None = None):
    def make(f: Frames) -> np.ndarray:
        if pick is None:
            return f.ahead(h)[0]
        done = f.ahead(1)[0]
        for k in range(2, h + 1):
            value, there = f.ahead(k)
            done = np.where(there, pick(done, value), done)
        return done

    return make


def _flag(condition: np.ndarray) -> np.ndarray:
    return condition.astype("float64")


def _share(name: str):
    return lambda f: np.where(f.nth >= 3, f.total(name, 3), 0.0) / 3.0


#: FEA-15: a row beside its indices. `c` gives a column by name, Spark's or an array.
BESIDE_INDEX: dict[str, Callable] = {
    "current_vs_market_index_return": lambda c: c("change_pct_scaled") - c("market_index_return_1"),
    "relative_sh_index_return_1": lambda c: c("return_1") - c("index_sh_return_1"),
    "relative_cyb_index_return_1": lambda c: c("return_1") - c("index_cyb_return_1"),
    **{
        f"relative_{name}_return_{n}": (lambda own, other: lambda c: c(own) - c(other))(own, f"{prefix}_return_{n}")
        for name, prefix in (("hs300", "index_hs300"), ("market_index", "market_index"))
        for n, own in ((1, "return_1"), (3, "return_3"), (5, "momentum_5"))
    },
}
#: The columns that BESIDE_MEANS reads beside the inputs and what is made of them.
MEANS = ["sector_mean_change", "market_mean_change", "sector_return_1", "sector_return_3", *[f"sector_momentum_{n}" for n in (5, 10, 20)]]
_OWN_RETURN = {1: "return_1", 3: "return_3", 5: "momentum_5", 10: "momentum_10", 20: "momentum_20"}
_SECTOR_RETURN = {1: "sector_return_1", 3: "sector_return_3", 5: "sector_momentum_5", 10: "sector_momentum_10", 20: "sector_momentum_20"}
#: FEA-7, 9: a row beside the means of its sector and market.
BESIDE_MEANS: dict[str, Callable] = {
    "sector_avg_change_pct": lambda c: c("sector_mean_change") / 100.0,
    "sector_relative_change": lambda c: (c("change_pct") - c("sector_mean_change")) / 100.0,
    "relative_sector_change_pct": lambda c: (c("change_pct") - c("sector_mean_change")) / 100.0,
    "market_avg_change_pct": lambda c: c("market_mean_change") / 100.0,
    "market_relative_change": lambda c: (c("change_pct") - c("market_mean_change")) / 100.0,
    "relative_market_change_pct": lambda c: (c("change_pct") - c("market_mean_change")) / 100.0,
    **{f"sector_relative_return_{n}": (lambda n: lambda c: c(_OWN_RETURN[n]) - c(_SECTOR_RETURN[n]))(n) for n in _OWN_RETURN},
}

MAKERS: dict[str, Callable[[Frames], np.ndarray]] = {
    **{n: (lambda make: lambda f: make(f.__getitem__))(make) for n, make in {**BESIDE_INDEX, **BESIDE_MEANS}.items()},
    "change_pct_scaled": lambda f: f["change_pct"] / 100.0,
    "return_1": _change("last_price"),
    "return_3": _change("last_price", 3),
    **{f"momentum_{n}": _change("last_price", n) for n in (5, 10, 20)},
    "volume_change": _change("volume"),
    "turnover_change": _change("turnover"),
    **{f"ma_{n}_gap": _gap(n) for n in (5, 10, 20)},
    "price_vs_ma20": lambda f: f["ma_20_gap"],
    **{f"max_drawdown_{n}": _drawdown(n) for n in (5, 10, 20)},
    "high_low_range": lambda f: np.where(np.abs(f["last_price"]) > 1e-8, _over(f["high_price"] - f["low_price"], f["last_price"]), 0.0),
    "volatility_5": _std(5, 2),
    "volatility_10": _std(10, 3),
    "volatility_20": _std(20, 5),
    "volume_ratio_20_raw": lambda f: _or(_to_mean_20(f, "volume"), 1.0),
    "turnover_ratio": lambda f: _or(_to_mean_20(f, "turnover") - 1, 0.0),
    "__flow": lambda f: f["last_price"] * f["volume"],
    "volume_ratio": lambda f: f["volume_ratio_20_raw"] - 1,
    "money_flow_ratio": _money_flow,
    "volume_spike_20": lambda f: _flag(f["volume_ratio_20_raw"] >= 2.0),
    "volume_up_breakout": lambda f: _flag((f["return_1"] > 0) & (f["volume_ratio_20_raw"] >= 1.5)),
    "volume_down_breakout": lambda f: _flag((f["return_1"] < 0) & (f["volume_ratio_20_raw"] >= 1.5)),
    "__growing": lambda f: _flag(f["volume_ratio_20_raw"] >= 1.2),
    "return_3_x_volume_ratio_20": lambda f: f["return_3"] * f["volume_ratio_20_raw"],
    "momentum_5_x_volume_ratio_20": lambda f: f["momentum_5"] * f["volume_ratio_20_raw"],
    "volume_price_corr": _together,
    **{f"volume_expansion_streak_{n}": (lambda n: lambda f: f.total("__growing", n) / float(n))(n) for n in (3, 5)},
    "__move": _move,
    "__gain": lambda f: np.maximum(f["__move"], 0.0),
    "__loss": lambda f: np.maximum(-f["__move"], 0.0),
    "rsi_14": _rsi,
    "__macd": lambda f: f.average("last_price", 12) - f.average("last_price", 26),
    "__signal": lambda f: f.average("__macd", 9),
    "macd": lambda f: _or(_over(f["__macd"], np.abs(f["last_price"])), 0.0),
    "macd_signal": lambda f: _or(_over(f["__signal"], np.abs(f["last_price"])), 0.0),
    "macd_hist": lambda f: _or(_over(f["__macd"] - f["__signal"], np.abs(f["last_price"])), 0.0),
    "price_position_20": _position,
    "vol_regime": lambda f: _flag((f["volatility_20"] != 0) & (f["volatility_5"] > f["volatility_20"])),
    "__up": lambda f: _flag(f["return_1"] > 0),
    "__down": lambda f: _flag(f["return_1"] < 0),
    "up_streak_3": _share("__up"),
    "down_streak_3": _share("__down"),
    # The sum rounded to nine digits is above 0.
    "index_up_3d": lambda f: _flag(f.total("market_index_return_1", 3) >= 0.5e-9),
    **{f"next_price_{h}": _ahead(h) for h in (1, 3, 5)},
    **{f"future_min_{h}": _ahead(h, np.fmin) for h in (1, 3, 5)},
    **{f"future_max_{h}": _ahead(h, np.fmax) for h in (1, 3, 5)},
}


def _differs(values: pa.ChunkedArray) -> np.ndarray:
    """Where a value is another one than that of the row before; nulls are alike."""
    codes = values.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return codes[1:] != codes[:-1]


def _begins(rows: pa.Table, keys: list[str]) -> np.ndarray:
    start = np.ones(rows.num_rows, dtype=bool)
    start[1:] = np.logical_or.reduce([_differs(rows[k]) for k in keys])
    return start


def _guarded(value: np.ndarray) -> np.ndarray:
    """FEA-26: finite and within [-5, 5]."""
    return np.clip(np.where(np.isfinite(value), value, 0.0), -5.0, 5.0)


def _measured(rows: pa.Table, start: np.ndarray, kept: list[str], names: list[str], guard: set[str], schema: pa.Schema) -> pa.RecordBatch:
    with np.errstate(all="ignore"):
        frames = Frames(lambda name: rows[name].to_numpy(zero_copy_only=False).astype("float64"), start)
        core = rows["is_core"].combine_chunks()
        made = [pa.array(_guarded(frames[n]) if n in guard else frames[n], pa.float64(), from_pandas=n.startswith(("next_", "future_"))) for n in names]
    table = pa.table([*[rows[c].combine_chunks() for c in kept], *made], schema=schema).filter(core).combine_chunks()
    return table.to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], schema=schema)


def measure(keys: list[str], kept: list[str], names: list[str], guard: set[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for `mapInArrow`: rows come sorted by key and place, whole segments of a key in one task; core rows go on with the named features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        schema = None
        waiting, least = 0, CHUNK_ROWS

        def done(rows: pa.Table, start: np.ndarray) -> pa.RecordBatch:
            return _measured(rows, start, kept, names, guard, schema)

        for batch in batches:
            if schema is None:
                schema = pa.schema([*[batch.schema.field(c) for c in kept], *[pa.field(n, pa.float64()) for n in names]])
            held.append(batch)
            waiting += batch.num_rows
            if waiting < least:
                continue
            rows = pa.Table.from_batches(held)
            start = _begins(rows, keys)
            last = int(np.flatnonzero(start)[-1])
            if last:
                yield done(rows.slice(0, last), start[:last])
            rest = rows.slice(last)
            held, waiting = rest.to_batches(), rest.num_rows
            least = waiting + CHUNK_ROWS
        if waiting:
            rows = pa.Table.from_batches(held)
            yield done(rows, _begins(rows, keys))

    return run
