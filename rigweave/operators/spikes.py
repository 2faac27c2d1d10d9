"""Implausible readings: jumps that return, frozen stretches, impossible values (problem 2).

What is normal is learnt per source and series. Every task sketches the sizes of steps (or lags) and the lengths of equal
runs in logarithmic bins, per source, hour of day and series; such sketches merge by adding counts, so partial ones are
summed in every task, before and after the shuffle. From the merged sketch of each hour, and of all hours together, come the
upper fence of its interquartile range and its high quantiles; a source's normal step is the largest of these, since an hour of
slow motion makes no step abnormal that is normal for the source. The normal run is the longest that is not set apart from
the rest by a doubling. Where three quarters of the steps are zero (slow or coarse series), the steps
that last tell the normal one; 0 is left to series that do not move at all. A second pass flags
  a) readings that leave their course by several normal steps and return within three rows,
  b) repeats in a run at least twice as long as any normal one, series that never move excepted,
  c) readings outside their limits.
Rows are cut into blocks of the sequence, with the neighbouring rows copied in, so that one long recording is spread over
many tasks. A run that goes on beyond a block's edge is added up over a table with one row per block, which gives each block
the whole lengths of the runs at its edges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigweave.operators.grouped_arrow import boundaries, grouped, whole_groups
from rigweave.session import settle, tasks_for

#: Sketch: bin b holds sizes in (LEAST * GROWTH**(b-1), LEAST * GROWTH**b]; bin 0 is zero, the last one has no end.
LEAST, GROWTH, BINS = 1e-9, 1.2, 300
#: Run lengths are exact up to RUN_EXACT, then in doubling steps.
RUN_EXACT, RUN_BINS = 256, 300
STEP, RUN, LASTING = 0, 1, 2
KINDS = 3
EDGE = 3
#: A context needs so many steps to speak for itself.
ENOUGH = 200
HOURS = 24
#: Sketch entries that a task holds before it hands them on.
HELD = 1 << 20


@dataclass(frozen=True)
class SpikeRules:
    """Factors: jump (in normal steps), stretch (of the longest normal run), fence (interquartile ranges above Q3)."""

    jump: float = 5.0
    stretch: float = 2.0
    least_run: int = 8
    fence: float = 3.0
    high: float = 0.99
    width: int = 3
    block: int = 4096
    halo: int = 128


@dataclass(frozen=True)
class Series:
    """The series of one table, in the order of their position in `values`.

    lower/upper: limits of each (a reading outside is case c); lag: the series are lags, of which the size itself, not the
    step, is compared with the normal one.
    """

    names: tuple[str, ...]
    members: tuple[int, ...]
    lower: tuple[float, ...]
    upper: tuple[float, ...]
    lag: bool = False
    width: int = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "width", len(self.names))


def step_bin(size: np.ndarray) -> np.ndarray:
    """The sketch bin of each non-negative size."""
    with np.errstate(divide="ignore"):
        b = np.ceil(np.log(np.maximum(size, LEAST) / LEAST) / math.log(GROWTH) - 1e-9) + 1
    return np.where(size <= 0, 0, np.minimum(b, BINS - 1)).astype(np.int64)


def step_top(b: np.ndarray | int) -> np.ndarray | float:
    """The largest size in a bin."""
    return np.where(np.asarray(b) == 0, 0.0, LEAST * GROWTH ** (np.asarray(b) - 1.0))


def run_bin(length: np.ndarray) -> np.ndarray:
    over = np.ceil(np.log2(np.maximum(length, 1) / RUN_EXACT)).astype(np.int64)
    return np.where(length <= RUN_EXACT, length, np.minimum(RUN_EXACT + np.maximum(over, 1), RUN_BINS - 1))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Fixed-width float matrix packed as little-endian binary; NaN is no reading."""
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    raw = np.frombuffer(chunk.buffers()[2], dtype=np.uint8)
    offsets = np.frombuffer(chunk.buffers()[1], dtype=np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
    return raw[offsets[0] : offsets[-1]].view("<f8").reshape(len(chunk), width)


def _codes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return chunk.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)


def _once(table: pa.Table) -> pa.Table:
    """Rows sorted by place in the sequence: a record that arrived again is dropped."""
    n = table.num_rows
    ident = table.column("ident").to_numpy()
    again = np.zeros(n, dtype=bool)
    again[1:] = (ident[1:] == ident[:-1]) & ~boundaries(table, ["owner", "block", "seq"])[1:]
    return table.filter(pa.array(~again)) if again.any() else table


def _runs(value: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of each run of equal values, its length); `new` marks the first row of each group."""
    start = np.flatnonzero(new | np.r_[True, value[1:] != value[:-1]])
    return start, np.diff(np.r_[start, len(value)])


def _lasting(x: np.ndarray, g: np.ndarray, width: int) -> np.ndarray:
    """Whether the value changes for longer than `width` rows: neither a way out that returns to where it was nor that way back."""
    out = np.r_[False, (x[1:] != x[:-1]) & (g[1:] == g[:-1])]
    passing = np.zeros(len(x), dtype=bool)
    for w in range(2, width + 2):
        same = np.flatnonzero((x[w:] == x[:-w]) & (g[w:] == g[:-w]))
        passing[same + 1] = True
        passing[same + w] = True
    return out & ~passing


def _owners(table: pa.Table, group: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(index of each group's source, -1 where no row of the block names one; names): a block's source is the one it names anywhere."""
    named = np.full(group[-1] + 1, -1)
    np.maximum.at(named, group, _codes(table.column("source")))
    return named, table.column("source").combine_chunks().dictionary_encode().dictionary


def _tally(table: pa.Table, series: Series, width: int, named: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of source, hour, series, kind and bin; count) of the rows that belong to their block."""
    values = _matrix(table.column("values"), series.width)
    seq, own, hour = table.column("seq").to_numpy(), table.column("core").to_numpy(), table.column("hour").to_numpy()
    source = named[group]
    codes, counts = [], []
    for s in range(series.width):
        v = values[:, s]
        keep = np.flatnonzero(~np.isnan(v) & (v >= series.lower[s]) & (v <= series.upper[s]) & (source >= 0))
        if not len(keep):
            continue
        x, g, q = v[keep], group[keep], seq[keep]
        first = np.r_[True, g[1:] != g[:-1]]
        if series.lag:
            size, good = np.abs(x), np.ones(len(x), dtype=bool)
        else:
            size = np.r_[0.0, np.abs(np.diff(x))]
            good = ~first & (np.r_[0, np.diff(q)] == 1)
        good &= own[keep]
        place = ((source[keep] * HOURS + hour[keep]) * series.width + s) * KINDS
        stay = np.zeros(len(x), dtype=bool) if series.lag else good & _lasting(x, g, width)
        start, length = _runs(x if not series.lag else table.column("raw").to_numpy()[keep], first)
        mine = own[keep][start]
        run = ((source[keep][start][mine] * HOURS * series.width + s) * KINDS + RUN) * BINS + run_bin(length[mine])
        k, n = np.unique(np.r_[(place[good] + STEP) * BINS + step_bin(size[good]), (place[stay] + LASTING) * BINS + step_bin(size[stay]), run], return_counts=True)
        codes.append(k)
        counts.append(n)
    return (np.concatenate(codes), np.concatenate(counts)) if codes else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _edges(table: pa.Table, series: Series, group: np.ndarray) -> dict[str, np.ndarray]:
    """For each block and series, of its own readings: value (as bits) and length of the first and the last run of equal ones; length 0 without readings."""
    values, own = _matrix(table.column("values"), series.width), table.column("core").to_numpy()
    shape = (int(group[-1]) + 1, series.width)
    out = {name: np.zeros(shape, dtype=np.int64) for name in ("first_value", "first_len", "last_value", "last_len", "runs")}
    for s in range(series.width):
        v = values[:, s]
        keep = np.flatnonzero(own & ~np.isnan(v) & (v >= series.lower[s]) & (v <= series.upper[s]))
        if not len(keep):
            continue
        # + 0.0: both zeros are one value
        x = table.column("raw").to_numpy()[keep] if series.lag else (v[keep] + 0.0).view(np.int64)
        g = group[keep]
        start, length = _runs(x, np.r_[True, g[1:] != g[:-1]])
        of = g[start]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        last = np.r_[first[1:], len(of)] - 1
        at = of[first]
        out["first_value"][at, s], out["first_len"][at, s] = x[start[first]], length[first]
        out["last_value"][at, s], out["last_len"][at, s] = x[start[last]], length[last]
        out["runs"][at, s] = last - first + 1
    return out


FIRST_PASS = pa.schema([
    ("source", pa.string()), ("hour", pa.int32()), ("series", pa.int32()), ("kind", pa.int32()), ("bin", pa.int32()), ("n", pa.int64()), ("owner", pa.string()), ("block", pa.int64()),
    *[(name, pa.list_(pa.int64())) for name in ("first_value", "first_len", "last_value", "last_len", "runs")]])
FIRST_PASS_SQL = "source string, hour int, series int, kind int, bin int, n long, owner string, block long, first_value array<long>, first_len array<long>, last_value array<long>, last_len array<long>, runs array<long>"


def _learn(series: Series, width: int):
    """The first pass: sketch entries, summed over the task's blocks as far as they are held, and one row of edges per block (kind EDGE)."""

    def entries(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for source, (k, n) in held.items():
            rest = [pa.nulls(len(k), f.type) for f in list(FIRST_PASS)[6:]]
            parts = (k // (series.width * KINDS * BINS), k // (KINDS * BINS) % series.width, k // BINS % KINDS, k % BINS)
            yield pa.RecordBatch.from_arrays([pa.array([source] * len(k), pa.string()), *[pa.array(p.astype(np.int32)) for p in parts], pa.array(n), *rest], schema=FIRST_PASS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        span = HOURS * series.width * KINDS * BINS
        for table in whole_groups(batches, ["owner", "block"]):
            table = _once(table)
            new = boundaries(table, ["owner", "block"])
            group = np.cumsum(new) - 1
            named, names = _owners(table, group)
            code, count = _tally(table, series, width, named, group)
            for i in np.unique(code // span):
                mine = code // span == i
                k, n = code[mine] % span, count[mine]
                name = names[int(i)].as_py()
                if name in held:
                    k, n = np.r_[held[name][0], k], np.r_[held[name][1], n]
                k, at = np.unique(k, return_inverse=True)
                held[name] = k, np.bincount(at, weights=n, minlength=len(k)).astype(np.int64)
            if sum(len(k) for k, _ in held.values()) > HELD:
                yield from entries(held)
                held = {}
            # one row of edges for each block that has rows of its own
            real = np.zeros(group[-1] + 1, dtype=bool)
            real[group[table.column("core").to_numpy()]] = True
            row = pa.array(np.flatnonzero(new)[real])
            edges = _edges(table, series, group)
            n = len(row)
            source = pa.array([None if i < 0 else names[int(i)].as_py() for i in named[real]], pa.string())
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * series.width), pa.array(m[real].ravel())) for m in edges.values()]
            null = pa.nulls(n, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [source, null, null, pa.array(np.full(n, EDGE, dtype=np.int32)), null, pa.nulls(n, pa.int64()), table.column("owner").combine_chunks().take(row).cast(pa.string()), table.column("block").combine_chunks().take(row), *lists], schema=FIRST_PASS)
        yield from entries(held)

    return run


def _quantile(bins: np.ndarray, counts: np.ndarray, q: float) -> int:
    total = np.cumsum(counts)
    return int(bins[np.searchsorted(total, q * total[-1], side="left")])


def _largest(bins: np.ndarray, counts: np.ndarray, rules: SpikeRules) -> tuple[float, float]:
    """(normal step, high quantile) of one context: the lower of the high quantile and the fence, never below Q3."""
    q1, q3, high = (float(step_top(_quantile(bins, counts, q))) for q in (0.25, 0.75, rules.high))
    return max(q3, min(high, q3 + rules.fence * max(q3 - q1, q3 / 2))), high


Context = dict[int, tuple[np.ndarray, np.ndarray]]


def _highest(by_hour: Context, rules: SpikeRules) -> tuple[float, float]:
    """(largest normal step, largest high quantile) of all hours together and of each hour that can speak for itself."""
    whole: dict[int, int] = {}
    for bins, counts in by_hour.values():
        for b, n in zip(bins, counts):
            whole[int(b)] = whole.get(int(b), 0) + int(n)
    bins = np.array(sorted(whole))
    contexts = [(bins, np.array([whole[int(b)] for b in bins]))] + [c for c in by_hour.values() if c[1].sum() >= ENOUGH]
    steps, highs = zip(*(_largest(*c, rules) for c in contexts))
    return max(steps), max(highs)


def normal_step(by_hour: Context, rules: SpikeRules, lasting: Context | None = None) -> float:
    """The largest normal step: over hours (and all hours together) the lower of the high quantile and the fence, never below Q3.

    A fence alone would cut off the tail of steps that are mostly tiny; the high quantile alone would let many spikes in.
    Where Q3 is zero everywhere, the same is taken of the steps that last, or of all but the zero ones where none lasts and
    they are no rarity. What is left is 0: a series that rests, but for single readings that leave and return.
    """
    best, top = _highest(by_hour, rules)
    if best > 0:
        return best
    if not lasting and top > 0:
        lasting = {h: (b[b > 0], n[b > 0]) for h, (b, n) in by_hour.items() if (b > 0).any()}
    return _highest(lasting, rules)[0] if lasting else 0.0


def normal_run(bins: np.ndarray, counts: np.ndarray, rules: SpikeRules) -> int:
    """The longest normal run: from the bulk upwards as long as the next length is below `stretch` times the last."""
    top = _quantile(bins, counts, 0.9)
    for b in bins[bins > top]:
        length = int(b) if b <= RUN_EXACT else RUN_EXACT * 2 ** int(b - RUN_EXACT)
        if length >= max(rules.stretch * top, rules.least_run):
            break
        top = length
    return top


def _normals(rules: SpikeRules, width: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        step, longest = [math.nan] * width, [0] * width
        for s, mine in pdf.groupby("series"):
            steps, runs = mine[mine.kind == STEP], mine[mine.kind == RUN].sort_values("bin")
            if len(steps):
                by, stay = ({h: (x.bin.to_numpy(), x.n.to_numpy()) for h, x in m.sort_values("bin").groupby("hour")} for m in (steps, mine[mine.kind == LASTING]))
                step[int(s)] = normal_step(by, rules, stay)
            if len(runs):
                longest[int(s)] = normal_run(runs.bin.to_numpy(), runs.n.to_numpy(), rules)
        return pd.DataFrame({"source": [key[0]], "normal_step": [step], "normal_run": [longest]})

    return run


def _detect(table: pa.Table, series: Series, rules: SpikeRules) -> Iterator[pa.RecordBatch]:
    """(series, record, case) of the rows that belong to their block."""
    table = _once(table)
    head = table.column("head").to_numpy()
    group = np.cumsum(boundaries(table, ["owner", "block"])) - 1
    groups = int(group[-1]) + 1
    step = np.full((groups, series.width), np.nan)
    longest = np.zeros((groups, series.width), dtype=np.int64)
    # whole lengths of the run before the block's first reading, of its first and of its last; whether the first run began earlier
    carried = np.zeros((groups, 4, series.width), dtype=np.int64)
    at = np.flatnonzero(head)
    if len(at):
        step[group[at]] = _matrix(table.column("normal_step").combine_chunks().take(pa.array(at)), series.width)
        longest[group[at]] = _matrix(table.column("normal_run").combine_chunks().take(pa.array(at)), series.width).astype(np.int64)
        for i in at:
            for c in table.column("carry")[int(i)].as_py() or []:
                carried[group[i], :, c["s"]] = c["prev_total"], c["first_total"], c["last_total"], c["joined"]
    body = np.flatnonzero(~head)
    if not len(body):
        return
    rows = table.take(pa.array(body)).combine_chunks() if len(at) else table
    group = group[body]
    values = _matrix(rows.column("values"), series.width)
    raw = rows.column("raw").to_numpy() if series.lag else None
    seq, own, ident = rows.column("seq").to_numpy(), rows.column("core").to_numpy(), rows.column("ident").to_numpy()
    found: list[tuple[int, np.ndarray, str]] = []
    for s in range(series.width):
        v = values[:, s]
        read = np.flatnonzero(~np.isnan(v))
        if not len(read):
            continue
        bad = ~((v[read] >= series.lower[s]) & (v[read] <= series.upper[s]))
        found.append((s, read[bad], "c"))
        keep = read[~bad]
        if not len(keep):
            continue
        x, g, q, mine = v[keep], group[keep], seq[keep], own[keep]
        scale = step[g, s]
        first = np.r_[True, g[1:] != g[:-1]]
        start, length = _runs(x if raw is None else raw[keep], first)
        run_of = np.repeat(np.arange(len(start)), length)
        # runs at the block's edges count as long as they really are
        held = np.flatnonzero(mine)
        begins, ends = held[np.r_[True, g[held][1:] != g[held][:-1]]], held[np.r_[g[held][1:] != g[held][:-1], True]] if len(held) else held
        whole = length.copy()
        np.maximum.at(whole, run_of[begins], carried[g[begins], 1, s])
        np.maximum.at(whole, run_of[ends], carried[g[ends], 2, s])
        near = begins[~first[begins]]
        np.maximum.at(whole, run_of[near - 1], carried[g[near], 0, s])
        limit = np.maximum(np.ceil(rules.stretch * longest[g[start], s]), rules.least_run)
        # only a frozen stretch asks whether the series ever moves; a time does
        stuck = (whole >= limit) & (scale[start] >= 0 if series.lag else scale[start] > 0)
        in_run = np.repeat(stuck, length)
        repeat = in_run.copy()
        repeat[start] = False
        # a first reading may repeat one that lies farther back than what was copied
        again = begins[first[begins] & (carried[g[begins], 3, s] > 0)]
        repeat[again] = in_run[again]
        found.append((s, keep[repeat], "b"))
        # jumps: off the course, and back within `width` rows
        n = len(x)
        if n < 3:
            continue
        gap = np.r_[1, np.diff(q)].astype(float)
        far = np.zeros(n, dtype=bool)
        if series.lag:
            far = np.abs(x) > rules.jump * scale
        else:
            far[1:] = (np.abs(np.diff(x)) > rules.jump * scale[1:] * np.maximum(gap[1:], 1)) & ~first[1:]
        for i in np.flatnonzero(far):
            if series.lag and (i == 0 or first[i] or far[i - 1]):
                continue
            if not first[i] and in_run[i - 1] and not series.lag:
                continue  # the end of a frozen stretch is a way back, not a jump
            for w in range(1, rules.width + 1):
                j = i + w
                if j >= n or g[j] != g[i]:
                    break
                back = not far[j] if series.lag else abs(x[j] - x[i - 1]) <= 2 * scale[i] * max(1.0, q[j] - q[i - 1])
                if back:
                    off = np.arange(i, j)
                    found.append((s, keep[off[~in_run[off]]], "a"))
                    break
    series_of = np.concatenate([np.full(len(r), s) for s, r, _ in found]).astype(np.int64)
    row = np.concatenate([r for _, r, _ in found]).astype(np.int64)
    series_of, row = series_of[own[row]], row[own[row]]
    yield pa.RecordBatch.from_arrays([pa.array(series_of.astype(np.int32)), pa.array(ident[row])], names=["series", "record_id"])


def _pack(width: int, halo: int, block: int, lowest: int):
    """Before the shuffle: drop repeats within the batch, pack readings into binary, copy rows near a block's edge. No block lies below `lowest`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            _, once = np.unique(batch.column(batch.schema.get_field_index("ident")).to_numpy(), return_index=True)
            once.sort()
            table = pa.Table.from_batches([batch]).take(pa.array(once)).combine_chunks()
            n = table.num_rows
            matrix = np.full((n, width), np.nan)
            column = 0
            for name in [c for c in table.column_names if c.startswith("v_")]:
                chunk = table.column(name).combine_chunks()
                if pa.types.is_list(chunk.type):
                    flat = chunk.flatten().to_numpy(zero_copy_only=False)
                    null = chunk.flatten().is_null().to_numpy(zero_copy_only=False)
                    # NaN is a reading that cannot be true, a null is none
                    flat = np.where(null, np.nan, np.where(np.isnan(flat), np.inf, flat))
                    sizes = chunk.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                    span = width // len([c for c in table.column_names if c.startswith("v_")])
                    row = np.repeat(np.arange(n), sizes)
                    pos = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    fits = pos < span
                    matrix[row[fits], column + pos[fits]] = flat[fits]
                    column += span
                else:
                    matrix[:, column] = chunk.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
                    column += 1
            seq = table.column("seq").to_numpy()
            home = seq // block
            copies = [(np.arange(n), home, True)]
            before, after = np.flatnonzero((seq - home * block < halo) & (home > lowest)), np.flatnonzero((home + 1) * block - seq <= halo)
            copies += [(before, home[before] - 1, False), (after, home[after] + 1, False)]
            take = np.concatenate([c[0] for c in copies])
            target = np.concatenate([c[1] for c in copies])
            core = np.concatenate([np.full(len(c[0]), c[2]) for c in copies])
            s = seq[take]
            binary = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * width), n, [None, pa.py_buffer(np.ascontiguousarray(matrix, dtype="<f8"))]).cast(pa.binary())
            t = pa.array(take)
            yield pa.RecordBatch.from_arrays(
                [table.column("owner").combine_chunks().take(t), pa.array(target), pa.array(s), table.column("ident").combine_chunks().take(t), table.column("source").combine_chunks().take(t),
                 table.column("hour").combine_chunks().take(t), table.column("raw").combine_chunks().take(t), binary.take(t), pa.array(core)],
                names=["owner", "block", "seq", "ident", "source", "hour", "raw", "values", "core"],
            )

    return run


PACKED = "owner string, block long, seq long, ident long, source string, hour int, raw long, values binary, core boolean"


def pack_rows(rows: DataFrame, series: Series, rules: SpikeRules) -> DataFrame:
    """Rows as the two passes read them: one binary of readings a row, copied into the blocks that need them."""
    # places count from 0 as a rule; one look at the column's least value saves copies into blocks that are not there
    least = rows.agg(F.min("seq")).first()[0] or 0
    return rows.mapInArrow(_pack(series.width, rules.halo, rules.block, least // rules.block), PACKED)


def _ordered(packed: DataFrame, tasks: int) -> DataFrame:
    return packed.repartition(tasks, "owner", "block").sortWithinPartitions("owner", "block", "seq", "ident")


#: Bytes shuffled for a byte of the plan's estimate (compressed columns become packed doubles).
GROWTH_OF_ROWS = 3.0


def first_pass(packed: DataFrame, series: Series, rules: SpikeRules, tasks: int) -> DataFrame:
    """Sketch entries (kind below EDGE) and one row of run edges per block."""
    return settle(_ordered(packed, tasks).mapInArrow(_learn(series, rules.width), FIRST_PASS_SQL), "learned")


def normals(learned: DataFrame, series: Series, rules: SpikeRules) -> DataFrame:
    """Per source: normal_step array<double> and normal_run array<long>, by series."""
    merged = learned.where(F.col("kind") < EDGE).groupBy("source", "hour", "series", "kind", "bin").agg(F.sum("n").alias("n"))
    # a source's sketch has at most series * (24 * 2 * BINS + RUN_BINS) bins, whatever the number of rows
    return merged.groupBy("source").applyInPandas(_normals(rules, series.width), "source string, normal_step array<double>, normal_run array<long>")


def profile(packed: DataFrame, series: Series, rules: SpikeRules, tasks: int | None = None) -> DataFrame:
    """Per source: normal_step array<double> and normal_run array<long>, by series. Rows without any known source say nothing."""
    learned = first_pass(packed, series, rules, tasks or tasks_for(packed, GROWTH_OF_ROWS))
    return normals(learned, series, rules)


def carried_runs(edges: DataFrame, whose: DataFrame, normal: DataFrame, series: Series, rules: SpikeRules) -> DataFrame:
    """(owner, block, carry): of each block's series the frozen runs that touch its edges, with their whole lengths over all blocks.

    Blocks of an owner are one row each here, so a run is added up over any number of them. Only series that move and runs
    long enough to be a case are carried; all others are decided inside the block.
    """
    lists = ("first_value", "first_len", "last_value", "last_len", "runs")
    long = edges.join(whose.where("blocks > 1").select(F.col("owner").alias("o")), F.col("owner") == F.col("o"), "left_semi").select("owner", "block", F.posexplode(F.arrays_zip(*lists)).alias("s", "e")).select("owner", "block", "s", *[f"e.{c}" for c in lists]).where("runs > 0")
    order = Window.partitionBy("owner", "s").orderBy("block")
    joined = F.coalesce(F.col("first_value") == F.lag("last_value").over(order), F.lit(False))
    long = long.withColumn("joined", joined)
    # a new chain of equal readings begins at a first run that goes on from nothing, and after a first run that is not the last
    steps = F.sum((~F.col("joined")).cast("long")).over(order) + F.coalesce(F.sum((F.col("runs") > 1).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    long = long.withColumn("c_first", steps).withColumn("c_last", F.col("c_first") + (F.col("runs") > 1).cast("long"))
    pieces = long.select("owner", "s", F.explode(F.array(F.struct(F.col("c_first").alias("c"), F.col("first_len").alias("len")), F.when(F.col("runs") > 1, F.struct(F.col("c_last").alias("c"), F.col("last_len").alias("len"))))).alias("p")).where("p is not null")
    totals = pieces.groupBy("owner", "s", "p.c").agg(F.sum("p.len").alias("total"))
    of = lambda name: totals.select(F.col("owner"), F.col("s"), F.col("c").alias(f"c_{name}"), F.col("total").alias(f"{name}_total"))
    met = long.join(of("first"), ["owner", "s", "c_first"]).join(of("last"), ["owner", "s", "c_last"])
    met = met.withColumn("prev_total", F.coalesce(F.lag("last_total").over(order), F.lit(0)))
    limits = normal.select(F.col("source"), F.posexplode(F.arrays_zip("normal_step", "normal_run")).alias("s", "l")).select(
        "source", "s", F.greatest(F.ceil(F.lit(rules.stretch) * F.col("l.normal_run")), F.lit(rules.least_run)).alias("limit"), (F.col("l.normal_step") >= 0 if series.lag else F.col("l.normal_step") > 0).alias("moves")).where("moves")
    judged = met.join(whose, "owner").join(limits, ["source", "s"])
    frozen = ((F.col("first_total") >= F.col("limit")) & F.col("joined")) | ((F.col("first_total") >= F.col("limit")) & (F.col("first_total") > F.col("first_len"))) | (
        (F.col("last_total") >= F.col("limit")) & (F.col("last_total") > F.col("last_len"))) | (F.col("prev_total") >= F.col("limit"))
    # at most one entry for each series of a block
    return judged.where(frozen).groupBy("owner", "block").agg(F.collect_list(F.struct("s", "prev_total", "first_total", "last_total", F.col("joined").cast("long").alias("joined"))).alias("carry"))


def _binary(column: str | Column):
    @F.pandas_udf("binary")
    def pack(values: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(v, dtype="<f8").tobytes() for v in values])

    return pack(column)


def find_implausible(rows: DataFrame, series: Series, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """field_name, record_id, joint of every implausible reading.

    rows(ident long, owner string, seq long, source string, hour int, raw long, v_* double or array<double>): one row per
    record, in the order of `seq` within `owner`; `source` may be null where another row of the owner names it; `raw` is
    the value whose repetition is judged for lags (0 otherwise). Rows without owner or place are judged by limits alone.
    A record that arrives again counts once; arrays that are too short have no reading there, what exceeds the width is
    ignored; NaN and infinities are impossible readings, null is none. Rows without ident cannot be named and are left out.
    Of two records at one place the smaller ident comes first. Other columns are ignored. Empty input gives no rows.
    """
    readings = [c for c in rows.columns if c.startswith("v_")]
    rows = rows.select("ident", "owner", "seq", "source", "hour", "raw", *readings).where("ident is not null").withColumn("ident", F.col("ident").cast("long"))
    alone = F.concat(F.lit("\u0001"), F.col("ident").cast("string"))
    placed = F.col("owner").isNotNull() & F.col("seq").isNotNull()
    rows = rows.withColumn("owner", F.when(placed, F.col("owner")).otherwise(alone)).withColumn("seq", F.coalesce(F.when(placed, F.col("seq")), F.lit(0)).cast("long"))
    rows = rows.withColumn("hour", F.pmod(F.coalesce("hour", F.lit(0)), F.lit(HOURS)).cast("int")).withColumn("raw", F.coalesce("raw", F.lit(0)).cast("long"))
    tasks = tasks_for(rows, GROWTH_OF_ROWS)
    packed = pack_rows(rows, series, rules)
    learned = first_pass(packed, series, rules, tasks)
    normal = settle(normals(learned, series, rules), "normals")

    # each block gets its source's normals and its carried runs as a first row; the wide rows are shuffled once more only
    edges = learned.where(F.col("kind") == EDGE)
    whose = settle(edges.groupBy("owner").agg(F.max("source").alias("source"), F.count(F.lit(1)).alias("blocks")), "owners")
    head = edges.select("owner", "block").join(whose, "owner").join(normal.select("source", _binary(F.col("normal_step")).alias("normal_step"), _binary(F.col("normal_run").cast("array<double>")).alias("normal_run")), "source")
    kind = "array<struct<s:int,prev_total:bigint,first_total:bigint,last_total:bigint,joined:bigint>>"
    if whose.where("blocks > 1").isEmpty():
        # no sequence goes on into a second block, so no run can
        head = head.withColumn("carry", F.lit(None).cast(kind))
    else:
        head = head.join(carried_runs(edges, whose, normal, series, rules), ["owner", "block"], "left")
    none = lambda kind: F.lit(None).cast(kind)
    head = head.select(
        "owner", "block", F.lit(-(2**62)).alias("seq"), F.lit(-(2**62)).alias("ident"), "source", F.lit(0).alias("hour"), F.lit(0).cast("long").alias("raw"), none("binary").alias("values"),
        F.lit(False).alias("core"), F.lit(True).alias("head"), "normal_step", "normal_run", "carry")
    body = packed.withColumns({"head": F.lit(False), "normal_step": none("binary"), "normal_run": none("binary"), "carry": none(kind)})
    flagged = _ordered(head.unionByName(body), tasks).mapInArrow(grouped(["owner", "block"], lambda t: _detect(t, series, rules)), "series int, record_id long")
    names = F.array(*[F.lit(n) for n in series.names])
    members = F.array(*[F.lit(m) for m in series.members])
    return flagged.distinct().select(names[F.col("series")].alias("field_name"), "record_id", members[F.col("series")].cast("int").alias("joint"))
