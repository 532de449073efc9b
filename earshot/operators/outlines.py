"""Outlines of cells within tiles: a task walks the sides of a key's cells in a tile and writes only corners.

Cells come as bits, 64 columns of a row in a word, each word to its tile and, where it lies at the tile's border, to
the tiles beside it, so a tile sees the cells around it. A side has its cell on the left hand; sides are numbered by
cell and way (0 right below the cell, 1 up on its right, 2 left above it, 3 down on its left). What a tile can't
close are chains: from a side that another tile leads to, to one that leads to another tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.components import KEY
from earshot.operators.tiles import BATCH, TILE

#: Columns of a tile's array: a word on either side of its own.
_WIDE, _LEFT, _RIGHT = TILE + 128, 64, 64 + TILE
#: By way: the step along the side, and the step to its right hand, away from the cell.
_AHEAD = np.array([(1, 0), (0, 1), (-1, 0), (0, -1)])
_OUT = np.array([(0, -1), (1, 0), (0, 1), (-1, 0)])
#: The corner at which a side ends, from the cell's lower left one.
_END = np.array([(1, 0), (1, 1), (0, 1), (0, 0)])


def words_by_tile(cells: DataFrame, key: str) -> DataFrame:
    """(key, tx, ty, cy, word, bits): the cells of each tile and of those around it."""
    c = F.col
    bit = F.expr("shiftleft(1L, cast(pmod(cx, 64) as int))")
    held = cells.where(c(key).isNotNull()).groupBy(key, "cy", F.shiftright("cx", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    half = TILE // 64
    steps = lambda low, high: F.array_compact(F.array(F.when(low, F.lit(-1)), F.lit(0), F.when(high, F.lit(1))))
    at = F.pmod("cy", F.lit(TILE))
    beside = steps((F.pmod("word", F.lit(half)) == 0) & (c("bits").bitwiseAND(F.lit(1)) != 0), (F.pmod("word", F.lit(half)) == half - 1) & (c("bits") < 0))
    dealt = held.withColumn("dy", F.explode(steps(at == 0, at == TILE - 1))).withColumn("dx", F.explode(beside))
    place = lambda v, size: F.floor(c(v) / size).cast("bigint")
    return dealt.select(key, (place("word", half) + c("dx")).alias("tx"), (place("cy", TILE) + c("dy")).alias("ty"), "cy", "word", "bits")


def _walk(grid: np.ndarray, number: np.ndarray, tx: int, ty: int) -> tuple[list[tuple], list[tuple]]:
    """(chains, runs that go on to the right) of a tile's array. A chain is (first side, side after the last, closed, xs, ys of its
    corners, line, row and owner of its leftmost upward side); the owner is the chain of the side that begins the run of cells left of
    it, None where the run begins in another tile. A run is (row, first column, chain of its first side)."""
    y, x = np.nonzero(grid[1 : TILE + 1, _LEFT:_RIGHT])
    y, x = y + 1, x + _LEFT
    sides = [(y[m], x[m], np.full(np.count_nonzero(m), w)) for w, (dx, dy) in enumerate(_OUT.tolist()) for m in [grid[y + dy, x + dx] == 0]]
    y, x, way = (np.concatenate(v) for v in zip(*sides, strict=True))
    if not len(way):
        return [], _onward(grid, number, {}, [], tx, ty)
    bx, by = x + _AHEAD[way, 0], y + _AHEAD[way, 1]
    ox, oy = bx + _OUT[way, 0], by + _OUT[way, 1]
    straight, right = grid[by, bx] != 0, (grid[by, bx] != 0) & (grid[oy, ox] != 0)
    nx, ny = np.where(right, ox, np.where(straight, bx, x)), np.where(right, oy, np.where(straight, by, y))
    turned = ~straight | right
    nway = np.where(right, way + 3, np.where(straight, way, way + 1)) % 4
    number[y, x, way] = np.arange(len(way))
    within = (nx >= _LEFT) & (nx < _RIGHT) & (ny >= 1) & (ny <= TILE)
    after = np.where(within, number[np.where(within, ny, 1), np.where(within, nx, _LEFT), nway], -1)
    gx, gy = tx * TILE - _LEFT, ty * TILE - 1
    name = (((y + gy) * KEY + x + gx) * 4 + way).tolist()
    follows = (((ny + gy) * KEY + nx + gx) * 4 + nway).tolist()
    entered = np.zeros(len(way), bool)
    entered[after[after >= 0]] = True
    ends_x, ends_y = (x + gx + _END[way, 0]).tolist(), (y + gy + _END[way, 1]).tolist()
    next_, turns, ways, xs, ys = after.tolist(), turned.tolist(), way.tolist(), x.tolist(), y.tolist()
    chain = [-1] * len(next_)
    found = []
    # chains first: what they leave are closed rings
    for first in [*np.flatnonzero(~entered).tolist(), *range(len(next_))]:
        if chain[first] >= 0:
            continue
        at, cx, cy, least, number_ = first, [], [], None, len(found)
        while True:
            chain[at] = number_
            if turns[at]:
                cx.append(ends_x[at])
                cy.append(ends_y[at])
            if ways[at] == 1 and (least is None or (xs[at], ys[at]) < least):
                least = (xs[at], ys[at])
            last, at = at, next_[at]
            if at < 0 or at == first:
                break
        found.append((name[first], follows[last], at == first, cx, cy, least))
    names = [f[0] for f in found]
    out = []
    for first, after_, closed, cx, cy, least in found:
        line = row = owner = None
        if least is not None:
            a, b = least
            line, row = a + 1 + gx, b + gy
            while a >= _LEFT and grid[b, a - 1]:
                a -= 1
            if a >= _LEFT:
                owner = names[chain[number[b, a, 3]]]
        out.append((first, after_, closed, cx, cy, line, row, owner))
    return out, _onward(grid, number, chain, names, tx, ty)


def _onward(grid: np.ndarray, number: np.ndarray, chain: list[int], names: list[int], tx: int, ty: int) -> list[tuple]:
    runs = []
    for b in (np.flatnonzero(grid[1 : TILE + 1, _RIGHT - 1] & grid[1 : TILE + 1, _RIGHT]) + 1).tolist():
        a = _RIGHT - 1
        while a >= _LEFT and grid[b, a - 1]:
            a -= 1
        if a >= _LEFT:
            runs.append((b + ty * TILE - 1, a + tx * TILE - _LEFT, names[chain[number[b, a, 3]]]))
    return runs


def chains(cells: DataFrame, key: str) -> DataFrame:
    """(key, id, next, closed, xs, ys, x, cy, owner) of the cells of each key. Rows with ``next`` are chains: ``closed`` ones are whole
    rings, the others go on with the chain ``next``. Rows without tell the chain ``id`` whose side begins, at ``x`` in
    row ``cy``, a run of cells that leaves its tile to the right."""
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = words_by_tile(cells, key).repartition(tasks, key, "tx", "ty").sortWithinPartitions(key, "tx", "ty")
    kind = cells.schema[key].dataType.simpleString()
    fields = "id bigint, next bigint, closed boolean, xs array<bigint>, ys array<bigint>, x bigint, cy bigint, owner bigint"
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]
    names = [key, "id", "next", "closed", "xs", "ys", "x", "cy", "owner"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, number = np.zeros((TILE + 2, _WIDE), np.uint8), np.zeros((TILE + 2, _WIDE, 4), np.int32)
        slots = grid.reshape(TILE + 2, _WIDE // 64, 64)
        now, touched, rows, corners, kept = None, [], [], 0, None

        def finish() -> None:
            nonlocal corners, touched
            found, runs = _walk(grid, number, *now[1:])
            rows.extend((now[0], *r) for r in found)
            rows.extend((now[0], r[2], None, None, None, None, r[1], r[0], None) for r in runs)
            corners += sum(len(r[3]) for r in found) + len(found) + len(runs)
            for b, s in touched:
                slots[b, s] = 0
            touched = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            out = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, [kept, *types], strict=True)], names)
            rows.clear()
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            kept, keys = batch.schema.field(0).type, batch.column(0)
            tx, ty, cy, word, bits = (batch.column(i).to_numpy() for i in range(1, 6))
            other = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero(other | (np.diff(tx) != 0) | (np.diff(ty) != 0)) + 1).tolist()
            held = np.unpackbits(bits.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, slot = cy - ty * TILE + 1, word - tx * (TILE // 64) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                here = (keys[a].as_py(), int(tx[a]), int(ty[a]))
                if here != now:
                    if now is not None:
                        finish()
                        if corners > BATCH:
                            yield flush()
                            corners = 0
                    now = here
                slots[at[a:b], slot[a:b]] = held[a:b]
                touched.append((at[a:b], slot[a:b]))
        if now is not None:
            finish()
        if rows:
            yield flush()

    return ordered.mapInArrow(run, f"{key} {kind}, {fields}")
