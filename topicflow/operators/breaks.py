"""Exact greedy breaks along an ordered key, computed block by block.

Some rules restart a counter at every break ("close at 10 MB"), so where a row
breaks depends on every break before it.  That looks sequential, but the effect
of a whole block of rows on the counters is a small step function: which row of
the block breaks first depends on the counters on entry, and from that row on
everything is fixed.  Step functions compose, so blocks are reduced in a tree,
entry counters flow back down, and every task sees one block of rows or a few
step functions, however many rows one key has.

A row ``j`` breaks when ``ramp[d][j] + state[d] >= limit[d]`` for some ``d``, or
when it is forced.  Ramps never fall.  After a break at ``j`` the state is
``reset[d][j]``; at the end of a block the block's ``total[d]`` is added.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.ordered import BLOCK, BLOCK_BITS, with_block
from topicflow.records import measured, quote
from topicflow.session import materialise

NEVER = 1 << 62
FAN_BITS = 4  # step functions combined per task and level: 2**FAN_BITS

ENTRY_FIELDS = "s1 bigint, s2 bigint, breaks bigint"
STEP_FIELDS = (
    "k1 array<bigint>, k2 array<bigint>, e1 array<bigint>, e2 array<bigint>, "
    "n array<bigint>, t1 bigint, t2 bigint, sure boolean"
)


class Rows:
    """One block of rows seen as ramps, resets and forced breaks."""

    def __init__(self, ramp, reset, total, forced):
        self.ramp = [np.asarray(r, np.int64) for r in ramp]
        self.reset = [np.asarray(r, np.int64) for r in reset]
        self.total = tuple(int(t) for t in total)
        self.forced = np.flatnonzero(forced)
        self.n = len(self.ramp[0])

    def following(self, limit) -> np.ndarray:
        """For a break at each row, the next row that breaks (n if none)."""
        after = np.full(self.n, self.n, np.int64)
        for ramp, reset, top in zip(self.ramp, self.reset, limit):
            if top < NEVER:
                after = np.minimum(after, np.searchsorted(ramp, top - reset))
        if len(self.forced):
            i = np.searchsorted(self.forced, np.arange(self.n), side="right")
            forced = np.append(self.forced, self.n)
            after = np.minimum(after, forced[i])
        return after

    def first(self, state, limit) -> int:
        at = self.n
        for ramp, s, top in zip(self.ramp, state, limit):
            if top < NEVER:
                at = min(at, int(np.searchsorted(ramp, top - s)))
        return min(at, int(self.forced[0])) if len(self.forced) else at

    def walk(self, state, limit) -> list[int]:
        """Rows that break, given the state on entry."""
        after = self.following(limit)
        found, at = [], self.first(state, limit)
        while at < self.n:
            found.append(at)
            at = int(after[at])
        return found

    def steps(self, limit) -> dict:
        """The block as a step function of the state on entry."""
        after = self.following(limit)
        # pointer doubling: follow the chain of breaks to its end
        last = np.where(after < self.n, after, np.arange(self.n))
        hops = (after < self.n).astype(np.int64)
        while not np.array_equal(last, last[last]):
            hops, last = hops + hops[last], last[last]
        return pack(
            [*self.ramp],
            [r[last] + t for r, t in zip(self.reset, self.total)],
            hops + 1,
            self.total,
            limit,
            certain=int(self.forced[0]) if len(self.forced) else self.n,
        )


def pack(ramp, exits, count, total, limit, certain: int) -> dict:
    """Cut a step function after its first certain break and merge equal steps.

    ``certain`` is a step that is taken at the latest (the length if none is).
    """
    for r, top in zip(ramp, limit):
        # a limit above zero counts up from a state that is never negative
        if 0 < top < NEVER:
            certain = min(certain, int(np.searchsorted(r, top)))
    end = min(certain + 1, len(count))
    sure = certain < len(count)
    ramp, exits, count = [r[:end] for r in ramp], [e[:end] for e in exits], count[:end]
    if end:
        changed = count[1:] != count[:-1]
        for e in exits:
            changed |= e[1:] != e[:-1]
        keep = np.append(np.flatnonzero(changed), end - 1)
        ramp, exits, count = [r[keep] for r in ramp], [e[keep] for e in exits], count[keep]
    return {
        "k1": ramp[0], "k2": ramp[1], "e1": exits[0], "e2": exits[1], "n": count,
        "t1": int(total[0]), "t2": int(total[1]), "sure": sure,
    }


def apply_steps(f: dict, s1, s2, limit):
    """State and number of breaks after the block, for arrays of entry states."""
    s1, s2 = np.asarray(s1, np.int64), np.asarray(s2, np.int64)
    size = len(f["n"])
    at = np.full(len(s1), size, np.int64)
    for ramp, s, top in ((f["k1"], s1, limit[0]), (f["k2"], s2, limit[1])):
        if top < NEVER and size:
            at = np.minimum(at, np.searchsorted(ramp, top - s))
    if f["sure"]:
        at = np.minimum(at, size - 1)
    hit = at < size
    if not size:
        return s1 + f["t1"], s2 + f["t2"], np.zeros(len(s1), np.int64)
    pick = np.minimum(at, size - 1)
    return (
        np.where(hit, f["e1"][pick], s1 + f["t1"]),
        np.where(hit, f["e2"][pick], s2 + f["t2"]),
        np.where(hit, f["n"][pick], 0),
    )


def compose(f: dict, g: dict, limit) -> dict:
    """First ``f``, then ``g``."""
    e1, e2, more = apply_steps(g, f["e1"], f["e2"], limit)
    k1, k2, n, sure = f["k1"], f["k2"], f["n"] + more, f["sure"]
    if not sure:
        k1 = np.maximum.accumulate(np.concatenate([k1, g["k1"] + f["t1"]]))
        k2 = np.maximum.accumulate(np.concatenate([k2, g["k2"] + f["t2"]]))
        e1, e2 = np.concatenate([e1, g["e1"]]), np.concatenate([e2, g["e2"]])
        n, sure = np.concatenate([n, g["n"]]), g["sure"]
    total = (f["t1"] + g["t1"], f["t2"] + g["t2"])
    return pack([k1, k2], [e1, e2], n, total, limit, len(n) - 1 if sure else len(n))


def _step_function(row) -> dict:
    f = {c: np.asarray(row[c], np.int64) for c in ("k1", "k2", "e1", "e2", "n")}
    return {**f, "t1": int(row["t1"]), "t2": int(row["t2"]), "sure": bool(row["sure"])}


def key_spans(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First and last block of every key: one row per key."""
    return rows.groupBy(*[quote(k) for k in keys]).agg(
        F.min(BLOCK).alias("__low"), F.max(BLOCK).alias("__high")
    )


def find_breaks(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    read: Callable[[pd.DataFrame], Rows],
    limit: tuple[int, int],
    start: DataFrame | None = None,
    block_bits: int = BLOCK_BITS,
    spans: DataFrame | None = None,
) -> DataFrame:
    """(keys, order, number): a mark at every break and at the first row of every block.

    ``rows`` should hold only what ``read`` needs.  ``start`` gives (keys, s1,
    s2, breaks) for keys that go on from an earlier batch; other keys start
    from nothing.  ``number`` counts breaks, so it is 0 before the first.
    ``spans`` may give the ``key_spans`` where ``rows`` are costly to compute.
    """
    keys = list(keys)
    rows = with_block(rows, order, block_bits)
    key_fields = [rows.schema[k] for k in keys]
    block_type = T.StructField(BLOCK, T.LongType())

    def schema_with(fields: str) -> T.StructType:
        return T.StructType([*key_fields, block_type, *T.StructType.fromDDL(fields)])

    spans = key_spans(rows, keys) if spans is None else spans
    highest = spans.agg(F.max(F.col("__high") - F.col("__low"))).first()[0] or 0
    if highest:
        # number the blocks of each key from 0
        lows = measured(spans.drop("__high"))
        rows = materialise(rows).join(lows, keys).withColumn(BLOCK, F.col(BLOCK) - F.col("__low")).drop("__low")
        entries = _entries(rows, keys, order, read, limit, start, schema_with, highest)
        rows = rows.join(entries, [*keys, BLOCK], "left")
    elif start is not None:
        rows = rows.join(measured(start), keys, "left")
    if highest or start is not None:
        rows = rows.fillna(0, ["s1", "s2", "breaks"])
    else:
        zero = F.lit(0).cast("bigint")
        rows = rows.withColumns({"s1": zero, "s2": zero, "breaks": zero})

    mark_schema = T.StructType(
        [*key_fields, T.StructField(order, T.LongType()), T.StructField("number", T.LongType())]
    )

    def marks(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(order, ignore_index=True)
        s1, s2, breaks = (int(block[c].iloc[0]) for c in ("s1", "s2", "breaks"))
        found = read(block).walk((s1, s2), limit)
        number = np.arange(1, len(found) + 1, dtype=np.int64) + breaks
        if not found or found[0] != 0:
            found = [0, *found]
            number = np.append(np.int64(breaks), number)
        out = block.loc[found, [*keys, order]].reset_index(drop=True)
        out["number"] = number
        return out

    return rows.groupBy(*[quote(k) for k in keys], BLOCK).applyInPandas(marks, mark_schema)


def _entries(rows, keys, order, read, limit, start, schema_with, highest) -> DataFrame:
    """(keys, block, s1, s2, breaks) on entry to every block."""

    def steps(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(order, ignore_index=True)
        first = block.iloc[[0]][[*keys, BLOCK]].reset_index(drop=True)
        return _with_steps(first, read(block).steps(limit))

    def combine(children: pd.DataFrame) -> pd.DataFrame:
        children = children.sort_values(BLOCK, ignore_index=True)
        total = _step_function(children.iloc[0])
        for i in range(1, len(children)):
            total = compose(total, _step_function(children.iloc[i]), limit)
        first = children.iloc[[0]][[*keys, BLOCK]].reset_index(drop=True)
        first[BLOCK] = int(children[BLOCK].iloc[0]) >> FAN_BITS
        return _with_steps(first, total)

    def descend(children: pd.DataFrame) -> pd.DataFrame:
        children = children.sort_values(BLOCK, ignore_index=True)
        out = children[[*keys, BLOCK]].copy()
        s1, s2, breaks = (np.array([children[c].iloc[0]], np.int64) for c in ("s1", "s2", "breaks"))
        states = []
        for i in range(len(children)):
            states.append((int(s1[0]), int(s2[0]), int(breaks[0])))
            s1, s2, more = apply_steps(_step_function(children.iloc[i]), s1, s2, limit)
            breaks = breaks + more
        out[["s1", "s2", "breaks"]] = np.array(states, np.int64)
        return out

    by = [quote(k) for k in keys]
    step_schema, entry_schema = schema_with(STEP_FIELDS), schema_with(ENTRY_FIELDS)
    levels = [materialise(rows.groupBy(*by, BLOCK).applyInPandas(steps, step_schema))]
    while highest >> (FAN_BITS * (len(levels) - 1)):
        parent = F.shiftright(F.col(BLOCK), FAN_BITS)
        up = levels[-1].groupBy(*by, parent.alias("__parent")).applyInPandas(combine, step_schema)
        levels.append(materialise(up))
    top = levels[-1].select(*by, BLOCK)
    if start is None:
        entries = top.withColumns({c: F.lit(0).cast("bigint") for c in ("s1", "s2", "breaks")})
    else:
        entries = top.join(start, keys, "left").fillna(0, ["s1", "s2", "breaks"])
    for level in reversed(levels[:-1]):
        above = entries.withColumnRenamed(BLOCK, "__parent")
        children = level.withColumn("__parent", F.shiftright(F.col(BLOCK), FAN_BITS)).join(
            above, [*keys, "__parent"]
        )
        entries = children.groupBy(*by, "__parent").applyInPandas(descend, entry_schema)
    return materialise(entries)


def _with_steps(first: pd.DataFrame, f: dict) -> pd.DataFrame:
    for name, value in f.items():
        first[name] = [value] if isinstance(value, np.ndarray) else value
    return first
