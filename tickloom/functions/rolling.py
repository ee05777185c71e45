"""Rolling measures over row frames of one entity ordered by date: column expressions, or numpy over a series."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def ordered(*by: str, order: str = "date") -> WindowSpec:
    return Window.partitionBy(*by).orderBy(order)


def last_rows(n: int, *by: str, order: str = "date") -> WindowSpec:
    """The current row and the n - 1 before it."""
    return ordered(*by, order=order).rowsBetween(1 - n, 0)


def change(x: Column, w: WindowSpec, n: int = 1) -> Column:
    """LAG-1..4: relative change over n rows, null where the earlier value is null or zero."""
    before = F.lag(x, n).over(w)
    return F.try_divide(x - before, before)


def bollinger(x: Column, w: WindowSpec, width: float = 2.0) -> tuple[Column, Column, Column]:
    """WAG-3: middle, upper and lower band; bands are null on a first row."""
    mid, spread = F.avg(x).over(w), width * F.stddev_samp(x).over(w)
    return mid, mid + spread, mid - spread


def rsi(gain: Column, loss: Column, w: WindowSpec) -> Column:
    """WAG-4 by simple averages: null for a flat frame, 100 without losses."""
    up, down = F.avg(gain).over(w), F.avg(loss).over(w)
    return (
        F.when((down == 0) & (up == 0), F.lit(None).cast("double"))
        .when(down == 0, F.lit(100.0))
        .otherwise(100.0 - 100.0 / (1.0 + F.try_divide(up, down)))
    )


def compound(r: Column, w: WindowSpec, n: int) -> Column:
    """WAG-11: product of 1 + r over n rows, less 1; null unless all n are above -1."""
    valid = r > -1
    total = F.sum(F.when(valid, F.ln(1 + r))).over(w)
    return F.when(F.count(F.when(valid, r)).over(w) == n, F.exp(total) - 1)


def rank_and_quintile(x: Column, day: str, descending: bool, tie: str) -> tuple[Column, Column]:
    """WIN-1..5: rank and quintile within a day, null where x is; nulls are in a partition of their own.

    Equal values share a rank; ``tie`` decides which of them goes to the lower quintile.
    """
    w = Window.partitionBy(day, x.isNull())
    by = x.desc() if descending else x.asc()
    return (
        F.when(x.isNotNull(), F.rank().over(w.orderBy(by))).cast("bigint"),
        F.when(x.isNotNull(), F.ntile(5).over(w.orderBy(by, tie))).cast("bigint"),
    )


# -- series ------------------------------------------------------------------------------------


def with_series(df: DataFrame, by: list[str], order: str, back: int, make, new: list[str], dealt: bool = False) -> DataFrame:
    """Add the double columns ``new`` that ``make`` computes from the series of an entity.

    ``make`` gets columns by name (numpy, null as NaN) in order, and a row's values may depend on the
    ``back`` rows before it. Rows stream past in batches, each begun with what it needs of the batch
    before, so memory is bounded whatever a series' length. ``dealt`` says that an entity's rows are in
    one partition already; a sort that is there already is not repeated.
    """
    rows = df if dealt else df.repartition(*by)
    rows = rows.sortWithinPartitions(*by, order)
    names, keys = df.columns, list(by)
    numbers = [f.name for f in df.schema if isinstance(f.dataType, DoubleType)]
    schema = StructType([*df.schema.fields, *[StructField(n, DoubleType()) for n in new]])

    def run(batches):
        carry: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch])
            rows = fresh if carry is None else pa.concat_tables([carry, fresh])
            old = rows.num_rows - fresh.num_rows
            change = np.zeros(rows.num_rows, bool)
            for k in keys:
                c = pc.fill_null(rows[k].combine_chunks().cast(pa.string()), "\0null")
                change[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            edges = np.concatenate(([0], np.flatnonzero(change), [rows.num_rows])).tolist()
            values = {n: rows[n].to_numpy() for n in numbers}
            parts = [make({n: v[a:b] for n, v in values.items()}) for a, b in zip(edges, edges[1:])]
            made = [np.concatenate([p[n] for p in parts])[old:] for n in new]
            columns = [c.combine_chunks() for c in fresh.columns]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(m, pa.float64(), from_pandas=True) for m in made)], names=[*names, *new])
            first = max(edges[-2], rows.num_rows - back)
            carry = rows.slice(first).combine_chunks()

    return rows.mapInArrow(run, schema)


def truncated_ema(x: np.ndarray, alpha: float, n: int) -> np.ndarray:
    """LAG-7: weights (1 - alpha)^k over the last n rows; nulls weigh nothing."""
    weights = (1.0 - alpha) ** np.arange(n)
    there = ~np.isnan(x)
    top = np.convolve(np.where(there, x, 0.0), weights)[: len(x)]
    base = np.convolve(there.astype(float), weights)[: len(x)]
    return np.divide(top, base, out=np.full(len(x), np.nan), where=base > 0)


def with_emas(df: DataFrame, by: str, order: str, emas: dict[str, tuple[str, float, int]]) -> DataFrame:
    """Add truncated EMAs, name -> (column, alpha, rows); a later one may use an earlier one.

    Unrolled lags make plans of thousands of expressions, so series are convolved with numpy.
    """

    def make(values: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        for name, (column, alpha, n) in emas.items():
            values[name] = truncated_ema(values[column], alpha, n)
        return values

    return with_series(df, [by], order, sum(n - 1 for _, _, n in emas.values()), make, [*emas])


def macd(df: DataFrame, value: str = "close", dealt: bool = False) -> DataFrame:
    """LAG-8: ema_12, ema_26, macd_line, macd_signal, macd_histogram."""

    def make(values: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        fast, slow = truncated_ema(values[value], 2.0 / 13, 90), truncated_ema(values[value], 2.0 / 27, 180)
        line = fast - slow
        signal = truncated_ema(line, 0.2, 90)
        return {"ema_12": fast, "ema_26": slow, "macd_line": line, "macd_signal": signal, "macd_histogram": line - signal}

    new = ["ema_12", "ema_26", "macd_line", "macd_signal", "macd_histogram"]
    return with_series(df, ["symbol"], "date", 179 + 89, make, new, dealt)


class Frames:
    """The last ``n`` rows of each place of a series, as a view; moments are taken about the mean.

    Sums of a frame are taken afresh, not carried from frame to frame, so no rounding builds up.
    """

    #: Frames of a block, few enough for the block to stay in a core's cache.
    ROWS = 128

    def __init__(self, n: int):
        self.n = n

    def each(self, *series: np.ndarray):
        """(places, frames of each series) in blocks; frames at the start are filled with NaN."""
        padded = [np.concatenate((np.full(self.n - 1, np.nan), x)) for x in series]
        views = [np.lib.stride_tricks.sliding_window_view(p, self.n) for p in padded]
        for a in range(0, len(series[0]), self.ROWS):
            yield slice(a, a + self.ROWS), [v[a : a + self.ROWS] for v in views]


def _about_mean(x: np.ndarray, there: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Differences from each frame's mean over the rows that are there, zero elsewhere."""
    x = np.where(there, x, 0.0)
    x -= (x.sum(axis=1) / np.maximum(n, 1))[:, None]
    x *= there
    return x


def _moments(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of frames, over the rows where neither is NaN: number, sums of squares and of products about the means."""
    there = ~(np.isnan(x) | np.isnan(y))
    n = there.sum(axis=1)
    dx = _about_mean(x, there, n)
    dy = dx if y is x else _about_mean(y, there, n)
    dot = lambda a, b: np.einsum("ij,ij->i", a, b)
    return n, dot(dx, dx), dot(dy, dy), dot(dx, dy), there


def _constant(x: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Frames without two different values: their spread is zero, whatever rounding makes of it."""
    return np.where(there, x, -np.inf).max(axis=1) <= np.where(there, x, np.inf).min(axis=1)


def beta(x: np.ndarray, m: np.ndarray, n: int, least: int, where: np.ndarray | None = None) -> np.ndarray:
    """WAG-6..8: covariance over variance of m, where the frame has ``least`` values of x; else NaN.

    ``where`` masks both inputs, as for the upside and downside forms.
    """
    if where is not None:
        x, m = np.where(where, x, np.nan), np.where(where, m, np.nan)
    out = np.full(len(x), np.nan)
    for at, (fx, fm) in Frames(n).each(x, m):
        enough = (~np.isnan(fx)).sum(axis=1) >= least
        both, _, _, xm, _ = _moments(fx, fm)
        alone, _, mm, _, there = _moments(fm, fm)
        ok = enough & (both > 1) & (alone > 1) & ~_constant(fm, there)
        xm[_constant(fx, ~np.isnan(fx))] = 0.0
        out[at][ok] = (xm[ok] / (both[ok] - 1)) / (mm[ok] / (alone[ok] - 1))
    return out


def correlation(x: np.ndarray, y: np.ndarray, n: int, least: int = 0) -> np.ndarray:
    """WAG-9, WAG-10: NaN for a constant frame; FLT-6 keeps [-1, 1] after rounding to 12 decimals.

    ``least`` values of x must be in the frame.
    """
    out = np.full(len(x), np.nan)
    for at, (fx, fy) in Frames(n).each(x, y):
        both, xx, yy, xy, there = _moments(fx, fy)
        ok = (both > 1) & ((~np.isnan(fx)).sum(axis=1) >= least) & ~_constant(fx, there) & ~_constant(fy, there)
        raw = np.round(xy[ok] / np.sqrt(xx[ok]) / np.sqrt(yy[ok]), 12)
        out[at][ok] = np.where(np.abs(raw) <= 1, raw, np.nan)
    return out
