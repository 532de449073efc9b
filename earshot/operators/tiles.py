"""Work on square tiles of cells: a task holds a tile's cells as a dense array, whatever the table's size.

Best levels: sites are dealt to the tiles their radius meets, and a tile's maxima are taken site by site in its
array, so a cell leaves the task once and is never shuffled per site. Labels: a tile's cells are labelled by
union-find over the runs of its rows; only labels that touch at the tiles' borders are left for rounds of joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.components import KEY, connected_components
from earshot.operators.grid import CELL, _span, deal, on_cells
from earshot.sources.storage import materialize

#: Cells along a tile's side.
TILE = 128
#: A tile with more sites than this is shared by several tasks, and their maxima are combined.
HOT_SITES = 20_000
#: Low bits of a packed maximum that hold the site.
UID_BITS = 36
#: Joined labels are broadcast up to so many rows (about 40 bytes each).
BROADCAST_LABELS = 100_000
BATCH = 200_000


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _flush(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(column)) for column in zip(*parts, strict=True)], names)


def _deal_sites(sites: DataFrame, cell: int, hot: int, carry: tuple[str, ...] = ("spl30",)) -> tuple[DataFrame, DataFrame]:
    """Sites once per tile that their radius meets, and (tx, ty, shares) of the tiles with more than ``hot`` sites."""
    reach = lambda v, sign: F.floor((F.col(v) + sign * F.col("r")) / (cell * TILE)).cast("bigint")
    met = deal(sites).withColumn("ty", F.explode(_span(reach("y", -1), reach("y", 1)))).withColumn("tx", F.explode(_span(reach("x", -1), reach("x", 1))))
    met = materialize(met.select("tx", "ty", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), *(F.col(n).cast("double").alias(n) for n in carry), "site_uid", "r"), "tile-sites")
    full = met.groupBy("tx", "ty").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("tx", "ty", F.ceil(F.col("n") / hot).cast("int").alias("shares"))
    return met, materialize(full, "hot-tiles")


def _window(cell: int, tx: int, ty: int, x: float, y: float, r: float) -> tuple[tuple[slice, slice], np.ndarray] | None:
    """The part of a tile that a site's square meets, and its cells' distances."""
    first = lambda v, t: max(int((v - r) // cell) - t * TILE, 0)
    last = lambda v, t: min(int((v + r) // cell) - t * TILE, TILE - 1) + 1
    x0, x1, y0, y1 = first(x, tx), last(x, tx), first(y, ty), last(y, ty)
    if x0 >= x1 or y0 >= y1:
        return None
    dx = (np.arange(x0, x1) + tx * TILE + 0.5) * cell - x
    dy = (np.arange(y0, y1) + ty * TILE + 0.5) * cell - y
    return (slice(y0, y1), slice(x0, x1)), np.sqrt(dx[None, :] ** 2 + dy[:, None] ** 2)


def _add(best: np.ndarray, reference: float, cell: int, tx: int, ty: int, x: float, y: float, spl: float, uid: int, r: float) -> None:
    """Takes a site's packed levels into a tile's maxima."""
    met = _window(cell, tx, ty, x, y, r)
    if met is None:
        return
    place, away = met
    level = np.floor((spl - 20 * np.log10(np.maximum(away, reference) / reference)) * 1e6 + 0.5).astype(np.int64)
    packed = np.where(away <= r, (level << UID_BITS) + (2**UID_BITS - 1 - uid), 0)
    window = best[place]
    np.maximum(window, packed, out=window)


def nearest_sites(sites: DataFrame, carry: tuple[str, ...] = (), cell: int = CELL, hot: int = HOT_SITES) -> DataFrame:
    """(cx, cy, site_uid, dist, ``carry`` as doubles) for sites (x, y, site_uid, r): the nearest site of each cell within
    ``r`` of one, by the distance of its centre in millionths; of equal distances the smaller uid's."""
    met, full = _deal_sites(sites, cell, hot, carry)
    several = not full.isEmpty()
    columns = ["tx", "ty", "share", "site_uid", "x", "y", "r", *carry]
    ordered = _shared(met, full, several).select(*columns).repartition(_tasks(met), "tx", "ty", "share").sortWithinPartitions("tx", "ty", "share", "site_uid")
    names = ["cx", "cy", "site_uid", "dist", *carry]

    def cells(least: np.ndarray, who: np.ndarray, held: list[tuple], tx: int, ty: int) -> tuple[np.ndarray, ...]:
        row, column = np.nonzero(np.isfinite(least))
        site = who[row, column]
        uid = np.array([h[0] for h in held], np.int64)[site]
        return column + tx * TILE, row + ty * TILE, uid, least[row, column], *(np.array([h[1 + i] for h in held], float)[site] for i in range(len(carry)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, least, who, held, parts, rows = None, np.full((TILE, TILE), np.inf), np.zeros((TILE, TILE), np.int64), [], [], 0
        for batch in batches:
            for tx, ty, share, uid, x, y, r, *values in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if (tx, ty, share) != now:
                    if now is not None:
                        parts.append(cells(least, who, held, *now[:2]))
                        rows += len(parts[-1][0])
                        least[:], held = np.inf, []
                    now = (tx, ty, share)
                    if rows > BATCH:
                        yield _flush(parts, names)
                        parts, rows = [], 0
                seen = _window(cell, tx, ty, x, y, r)
                if seen is None:
                    continue
                place, away = seen
                dist = np.where(away <= r, np.floor(away * 1e6 + 0.5) / 1e6, np.inf)
                nearer = dist < least[place]  # sites come by uid, so of equal ones the first stays
                if nearer.any():
                    least[place][nearer] = dist[nearer]
                    who[place][nearer] = len(held)
                    held.append((uid, *values))
        if now is not None:
            parts.append(cells(least, who, held, *now[:2]))
            yield _flush(parts, names)

    found = ordered.mapInArrow(run, "cx bigint, cy bigint, site_uid bigint, dist double" + "".join(f", `{n}` double" for n in carry))
    if not several:
        return found
    # the tasks that share a tile have its cells each
    best = found.groupBy("cx", "cy").agg(F.min(F.struct("dist", "site_uid", *carry)).alias("b"))
    return best.select("cx", "cy", "b.site_uid", "b.dist", *(f"b.{n}" for n in carry))


def best_packed(sites: DataFrame, reference: float, cell: int = CELL, hot: int = HOT_SITES) -> DataFrame:
    """(cx, cy, p) for sites (x, y, spl30, site_uid, r): the greatest level of each cell within ``r`` of a site, in
    millionths and packed with the site's uid so that of equal levels the smaller uid is the greater number.
    Levels fall by 20 dB a tenfold distance, from ``reference`` metres on; a cell's distance is its centre's."""
    met, full = _deal_sites(sites, cell, hot)
    return _maxima(met, full, not full.isEmpty(), reference, cell)


def _shared(met: DataFrame, full: DataFrame, several: bool) -> DataFrame:
    """Dealt sites with their task's ``share`` of the tile."""
    share = F.coalesce(F.pmod(F.xxhash64("site_uid"), F.col("shares")).cast("int"), F.lit(0)) if several else F.lit(0)
    return (met.join(full, ["tx", "ty"], "left") if several else met).withColumn("share", share)


def _maxima(met: DataFrame, full: DataFrame, several: bool, reference: float, cell: int) -> DataFrame:
    """(cx, cy, p) of dealt sites; with ``several``, sites of a full tile go to several tasks."""
    columns = ["tx", "ty", "share", "x", "y", "spl30", "site_uid", "r"]
    ordered = _shared(met, full, several).select(*columns).repartition(_tasks(met), "tx", "ty", "share").sortWithinPartitions("tx", "ty", "share")

    def maxima(best: np.ndarray, tx: int, ty: int) -> tuple[np.ndarray, ...]:
        row, column = np.nonzero(best)
        return column + tx * TILE, row + ty * TILE, best[row, column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best, parts, rows = None, np.zeros((TILE, TILE), np.int64), [], 0
        for batch in batches:
            for tx, ty, share, *site in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if (tx, ty, share) != now:
                    if now is not None:
                        parts.append(maxima(best, *now[:2]))
                        rows += len(parts[-1][0])
                        best[:] = 0
                    now = (tx, ty, share)
                    if rows > BATCH:
                        yield _flush(parts, ["cx", "cy", "p"])
                        parts, rows = [], 0
                _add(best, reference, cell, tx, ty, *site)
        if now is not None:
            parts.append(maxima(best, *now[:2]))
            yield _flush(parts, ["cx", "cy", "p"])

    found = ordered.mapInArrow(run, "cx bigint, cy bigint, p bigint")
    # the tasks that share a tile have its cells each
    return found.groupBy("cx", "cy").agg(F.max("p").alias("p")) if several else found


#: Kinds of rows that meet in a tile.
_SITE, _KNOWN, _CLUTTER, _BUILT, _ASKED = range(5)
_LEVELS = ["cx", "cy", "level", "site_uid", "db"]


def attenuated(
    sites: DataFrame, clutter: DataFrame, built: DataFrame, reference: float, penalty: float, thresholds: tuple[int, ...], asked: DataFrame | None = None, keep: str = "all", cell: int = CELL, hot: int = HOT_SITES
) -> DataFrame:
    """(cx, cy, level, site_uid, db): best levels as of ``best_packed``, less clutter and building loss, with the highest
    threshold reached (0: none). Sites, clutter boxes (xmin, ymin, w, h, seq, att_db; the later one overwrites, 0 dB is never
    written) and building boxes are dealt to the tiles they meet, so no cell is shuffled and none is joined.

    ``keep`` is "all" cells with a site in reach or only the "heard" ones (db > 0). With ``asked`` (cx, cy) only those cells come:
    the heard ones, or with keep "silent" the others (level and site 0 where no site is in reach)."""
    met, full = _deal_sites(sites, cell, hot)
    c, none = F.col, F.lit(None).cast("double")
    at = lambda v: F.floor(v / TILE).cast("bigint")
    rows = lambda df, kind, seq, *values: df.select("tx", "ty", F.lit(kind).alias("kind"), seq.cast("bigint").alias("seq"), *((values[i].cast("double") if i < len(values) else none).alias(n) for i, n in enumerate("abcde")))

    def boxes(df: DataFrame) -> DataFrame:
        """Boxes with their first and last touched cells, once per tile."""
        ends = {"i0": F.floor(c("xmin") / cell), "i1": F.ceil((c("xmin") + c("w")) / cell) - 1, "j0": F.floor(c("ymin") / cell), "j1": F.ceil((c("ymin") + c("h")) / cell) - 1}
        spans = df.withColumns(ends).where("i1 >= i0 and j1 >= j0")
        return spans.withColumn("ty", F.explode(_span(at(c("j0")), at(c("j1"))))).withColumn("tx", F.explode(_span(at(c("i0")), at(c("i1")))))

    corners = [c("i0"), c("i1"), c("j0"), c("j1")]
    cool = met
    if not full.isEmpty():  # the maxima of crowded tiles are found by several tasks before
        cool = met.join(full, ["tx", "ty"], "left_anti")
        known = _maxima(met.join(full.select("tx", "ty"), ["tx", "ty"], "left_semi"), full, True, reference, cell)
        known = known.withColumns({"tx": at(c("cx")), "ty": at(c("cy"))})
    parts = [rows(cool, _SITE, c("site_uid"), c("x"), c("y"), c("spl30"), c("r")), rows(boxes(clutter.where("att_db > 0")), _CLUTTER, c("seq"), *corners, c("att_db")), rows(boxes(built), _BUILT, F.lit(0), *corners)]
    parts += [] if cool is met else [rows(known, _KNOWN, c("p"), c("cx"), c("cy"))]
    parts += [] if asked is None else [rows(asked.withColumns({"tx": at(c("cx")), "ty": at(c("cy"))}), _ASKED, F.lit(0), c("cx"), c("cy"))]
    both = reduce(DataFrame.unionByName, parts).where("tx is not null and ty is not null")
    ordered = both.repartition(_tasks(sites), "tx", "ty").sortWithinPartitions("tx", "ty", "kind", "seq", "e")
    steps, only = np.array([0, *sorted(thresholds)]), asked is not None

    def fresh() -> dict[int, np.ndarray]:
        return {_SITE: np.zeros((TILE, TILE), np.int64), _CLUTTER: np.zeros((TILE, TILE)), _BUILT: np.zeros((TILE, TILE), bool), _ASKED: np.zeros((TILE, TILE), bool)}

    def fill(tile: dict[int, np.ndarray], tx: int, ty: int, kind: int, seq: np.ndarray, v: list[np.ndarray]) -> None:
        if kind == _SITE:
            for uid, x, y, spl, r in zip(seq.tolist(), *(n.tolist() for n in v[:4]), strict=True):
                _add(tile[_SITE], reference, cell, tx, ty, x, y, spl, uid, r)
        elif kind in (_KNOWN, _ASKED):
            place = v[1].astype(np.int64) - ty * TILE, v[0].astype(np.int64) - tx * TILE
            tile[_SITE if kind == _KNOWN else _ASKED][place] = seq if kind == _KNOWN else True
        else:
            x0, x1, y0, y1 = ((n.astype(np.int64) - t * TILE).clip(0, TILE - 1) for n, t in zip(v[:4], (tx, tx, ty, ty), strict=True))
            if kind == _BUILT and len(seq) and (x1 - x0).max() <= 1 and (y1 - y0).max() <= 1:  # of at most four cells
                for x in (x0, x1):
                    for y in (y0, y1):
                        tile[_BUILT][y, x] = True
                return
            for i0, i1, j0, j1, loss in zip(x0.tolist(), x1.tolist(), y0.tolist(), y1.tolist(), v[4].tolist() if kind == _CLUTTER else [True] * len(seq), strict=True):
                tile[kind][j0 : j1 + 1, i0 : i1 + 1] = loss

    def cells(tile: dict[int, np.ndarray], tx: int, ty: int) -> tuple[np.ndarray, ...]:
        best = tile[_SITE]
        row, column = np.nonzero(tile[_ASKED] if only else best)
        p = best[row, column]
        level = (p >> UID_BITS) / 1e6 - (tile[_CLUTTER] + penalty * tile[_BUILT])[row, column]
        level = np.where(p > 0, np.floor(level * 1e6 + 0.5) / 1e6, 0.0)
        db = np.where(p > 0, steps[np.maximum(np.searchsorted(steps, level, side="right") - 1, 0)], 0).astype(np.int32)
        uid = np.where(p > 0, 2**UID_BITS - 1 - (p & (2**UID_BITS - 1)), 0)
        kept = slice(None) if keep == "all" else db > 0 if keep == "heard" else db == 0
        return tuple(n[kept] for n in (column + tx * TILE, row + ty * TILE, level, uid, db))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tile, parts, n = None, fresh(), [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            tx, ty, kind, seq, *v = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
            cuts = np.flatnonzero((np.diff(tx) != 0) | (np.diff(ty) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tx)], strict=True):
                here = (int(tx[a]), int(ty[a]))
                if here != now:
                    if now is not None:
                        parts.append(cells(tile, *now))
                        n += len(parts[-1][0])
                        tile = fresh()
                        if n > BATCH:
                            yield _flush(parts, _LEVELS)
                            parts, n = [], 0
                    now = here
                fill(tile, *here, int(kind[a]), seq[a:b], [w[a:b] for w in v])
        if now is not None:
            parts.append(cells(tile, *now))
            yield _flush(parts, _LEVELS)

    return ordered.mapInArrow(run, "cx bigint, cy bigint, level double, site_uid bigint, db int")


def _label_tile(cells: np.ndarray, tx: int, ty: int) -> tuple[np.ndarray, ...]:
    """(cx, cy, label) of a tile's cells: 8-connected within the tile; the label is the key of the first cell."""
    held = np.zeros((TILE, TILE + 2), np.int8)
    held[cells[:, 1] - ty * TILE, cells[:, 0] - tx * TILE + 1] = 1
    step = np.diff(held, axis=1)
    rows, starts = np.nonzero(step == 1)
    ends = np.nonzero(step == -1)[1]  # a run covers columns start .. end - 1
    low = list(range(len(rows)))

    def root(i: int) -> int:
        while low[i] != i:
            low[i] = low[low[i]]
            i = low[i]
        return i

    first = np.searchsorted(rows, np.arange(TILE + 1)).tolist()
    a, b = starts.tolist(), ends.tolist()
    for y in range(TILE - 1):
        i, j = first[y], first[y + 1]
        while i < first[y + 1] and j < first[y + 2]:
            if a[j] <= b[i] and a[i] <= b[j]:  # they touch, over a corner too
                p, q = root(i), root(j)
                low[max(p, q)] = min(p, q)
            if b[i] < b[j]:
                i += 1
            else:
                j += 1
    tops = np.fromiter((root(i) for i in range(len(low))), np.int64, len(low))
    labels = ((rows + ty * TILE) * KEY + starts + tx * TILE)[tops]
    sizes = ends - starts
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(starts, sizes) + within + tx * TILE, np.repeat(rows, sizes) + ty * TILE, np.repeat(labels, sizes)


def label_cells(cells: DataFrame) -> DataFrame:
    """(cx, cy, gap_id): 8-connected components of distinct cells; the label is the key of the component's
    first cell (lowest row, then leftmost)."""
    place = lambda v: F.floor(F.col(v) / TILE).cast("bigint")
    ordered = cells.select(place("cx").alias("tx"), place("cy").alias("ty"), "cx", "cy").repartition(_tasks(cells), "tx", "ty").sortWithinPartitions("tx", "ty")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, parts, rows = None, [], [], 0
        for batch in batches:
            table = np.stack([column.to_numpy() for column in batch.columns], axis=1)
            if not len(table):
                continue
            cuts = np.flatnonzero((table[1:, :2] != table[:-1, :2]).any(axis=1)) + 1
            for piece in np.split(table, cuts):
                tile = (int(piece[0, 0]), int(piece[0, 1]))
                if now is not None and tile != now:
                    parts.append(_label_tile(np.concatenate(held), *now))
                    rows += len(parts[-1][0])
                    held = []
                    if rows > BATCH:
                        yield _flush(parts, ["cx", "cy", "label"])
                        parts, rows = [], 0
                now = tile
                held.append(piece[:, 2:])
        if held:
            parts.append(_label_tile(np.concatenate(held), *now))
        if parts:
            yield _flush(parts, ["cx", "cy", "label"])

    local = materialize(ordered.mapInArrow(run, "cx bigint, cy bigint, label bigint"), "tile-labels")
    edge = lambda v: F.pmod(F.col(v), F.lit(TILE))
    border = local.where(edge("cx").isin(0, TILE - 1) | edge("cy").isin(0, TILE - 1))
    # to the right, and to the three cells of the row above
    around = F.explode(F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((1, 0), (-1, 1), (0, 1), (1, 1)))))
    near = border.withColumn("d", around).select((F.col("cx") + F.col("d.dx")).alias("cx"), (F.col("cy") + F.col("d.dy")).alias("cy"), F.col("label").alias("a"))
    pairs = on_cells(near, border.withColumnRenamed("label", "b"), ["cx", "cy"]).where("a <> b").select("a", "b").distinct()
    joined = materialize(connected_components(pairs).select(F.col("node").alias("label"), "component"), "joined-labels")
    few = joined.count() <= BROADCAST_LABELS
    joined = F.broadcast(joined) if few else joined
    found = local.join(joined, "label", "left") if few else on_cells(local, joined, ["label"], "left")
    return found.select("cx", "cy", F.coalesce("component", "label").alias("gap_id"))
