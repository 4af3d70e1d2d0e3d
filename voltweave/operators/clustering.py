"""Hierarchical clustering of points in the plane, exact at any size, in rounds over tiles.

Both linkages merge two groups as soon as that is certain from what one tile of the plane holds, and go on
with far fewer groups on new tiles, until one tile holds them all. A tile is a rectangle with about
``TILE`` groups that also sees a margin around it; where rectangles are cut does not matter for the result.

*Ward*: a group stands at its mean. Two groups in a tile that are each other's nearest, and nearer than
anything beyond its view can be, may be merged at once: merging such pairs in any order gives the tree of
the one-at-a-time method. *Single linkage* is cut from the minimum spanning tree. Candidate edges come from
pairs of tiles near enough for one; then a tile keeps the shortest edge out of a group as long as all
edges of the group are inside.

Costs are compared at nine digits and equal ones by the smaller member numbers, so that there is one result
whatever the partitioning: by position order, mixed by a fixed rule for Ward. The driver holds tile borders (a few numbers per tile) and
the k - 1 cuts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.operators.order import row_index
from voltweave.sources.staging import stage

TILE = 512
NEIGHBOURS = 9  # tiles that a tile looks at, itself included
SCALE = 10_000_000  # positions are kept in units of 1e-7, whose sums are exact
DIGITS = 1 << 30
# Ward's ties go by a mixed order of the positions: on a lattice, where each point has several nearest ones, position
# order would make long chains of points that wait for each other.
MIXER, MODULUS = 1103515245, 2**31 - 1


def comparable(cost: np.ndarray) -> np.ndarray:
    """Costs rounded to nine digits, so that equal ones are equal whichever way they were computed."""
    m, e = np.frexp(cost)
    return np.ldexp(np.round(m * DIGITS) / DIGITS, e)


def numbered_points(points: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """Distinct complete positions with ``id`` in position order and whole-number coordinates ``sx``, ``sy``."""
    places = points.select(*[F.col(k).cast("double") for k in keys]).dropna().distinct()
    indexed = row_index(places, list(keys), name="id")
    whole = [F.round(F.col(k) * SCALE).cast("long").alias(s) for k, s in zip(keys, ("sx", "sy"))]
    return stage(indexed.select(*keys, "id", *whole), "points")


# -- tiles ---------------------------------------------------------------------------------------------------------


class Layout:
    """Rectangles that share out the plane: strips of x, each cut along y. Tile ``strip * width + place``."""

    def __init__(self, cuts_x: list[float], cuts_y: dict[int, list[float]], width: int):
        self.cuts_x, self.width = np.array(cuts_x), width
        self.cuts_y = {s: np.array(cuts_y.get(s, [])) for s in range(len(cuts_x) + 1)}

    def tiles(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.cuts_x, x, "right")
        t = np.zeros(len(x), dtype=np.int64)
        for own in np.unique(s):
            t[s == own] = np.searchsorted(self.cuts_y[int(own)], y[s == own], "right")
        return s * self.width + t

    def borders(self, tile: int) -> tuple[float, float, float, float]:
        s, t = divmod(tile, self.width)
        edges_x = np.concatenate([[-np.inf], self.cuts_x, [np.inf]])
        edges_y = np.concatenate([[-np.inf], self.cuts_y[s], [np.inf]])
        return edges_x[s], edges_x[s + 1], edges_y[t], edges_y[t + 1]

    def all_tiles(self) -> list[int]:
        return [s * self.width + t for s, cuts in self.cuts_y.items() for t in range(len(cuts) + 1)]

    def meeting(self, x0: float, x1: float, y0: float, y1: float) -> list[int]:
        """Tiles that meet a rectangle."""
        out = []
        for s in range(np.searchsorted(self.cuts_x, x0, "right"), np.searchsorted(self.cuts_x, x1, "right") + 1):
            low, high = (np.searchsorted(self.cuts_y[int(s)], y, "right") for y in (y0, y1))
            out += [int(s) * self.width + int(t) for t in range(low, high + 1)]
        return out

    def halos(self, span: tuple[float, float, float, float]) -> tuple[dict[int, tuple], dict[int, list[int]]]:
        """(the rectangle a tile looks at, by tile; the tiles that look into a tile, by tile).

        A tile looks out by half its own size, or less where more than ``NEIGHBOURS`` tiles are that near.
        ``span``: the range of all points.
        """
        views, lookers = {}, {t: [] for t in self.all_tiles()}
        for tile in lookers:
            x0, x1, y0, y1 = self.borders(tile)
            dx = min(x1, span[1]) - max(x0, span[0])
            dy = min(y1, span[3]) - max(y0, span[2])
            for part in (0.5, 0.25, 0.125, 0.0625, 0.0):
                view = (x0 - part * dx, x1 + part * dx, y0 - part * dy, y1 + part * dy)
                met = self.meeting(*view)
                if len(met) <= NEIGHBOURS:
                    break
            else:
                view, met = (x0, x1, y0, y1), [tile]
            views[tile] = view
            for other in met:
                if other != tile:
                    lookers[other].append(tile)
        return views, lookers


def layout(df: DataFrame, n: int, most: int, shift: float = 0.0) -> tuple[Layout, tuple[float, float, float, float]]:
    """Tiles of about ``most`` rows each by approximate quantiles of x and y, and the range of x and y.

    ``shift`` (0 to 1) moves the cuts, so that what lies on a border in one round lies inside in another.
    """
    strips = max(1, math.ceil(math.sqrt(n / most)))
    if strips == 1:
        return Layout([], {}, 1), (-np.inf, np.inf, -np.inf, np.inf)
    shares = [0.0, *[(i + shift) / strips for i in range(strips + 1) if 0 < (i + shift) / strips < 1], 1.0]
    points = F.array(*[F.lit(s) for s in shares])
    found = df.agg(F.percentile_approx("x", points, 100 * strips)).first()[0]
    cuts_x = sorted(set(found[1:-1]))
    strip = F.lit(0)
    for cut in cuts_x:
        strip = strip + (F.col("x") >= F.lit(cut)).cast("int")
    rows = df.groupBy(strip.alias("strip")).agg(F.percentile_approx("y", points, 100 * strips)).collect()  # a row per strip
    span = (found[0], found[-1], min(r[1][0] for r in rows), max(r[1][-1] for r in rows))
    return Layout(cuts_x, {r[0]: sorted(set(r[1][1:-1])) for r in rows}, strips + 3), span


def with_tiles(df: DataFrame, n: int, most: int, shift: float = 0.0) -> DataFrame:
    """``df`` (columns x, y) with the number of its tile."""
    made, _ = layout(df, n, most, shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tiles = made.tiles(*(batch.column(c).to_numpy() for c in ("x", "y")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tiles)], names=[*batch.schema.names, "tile"])

    return df.mapInArrow(run, ", ".join([*(f"{c} {t}" for c, t in df.dtypes), "tile long"]))


def with_halos(df: DataFrame, n: int, most: int, shift: float = 0.0) -> DataFrame:
    """As ``with_tiles``, with x0, x1, y0, y1, the rectangle that the tile looks at, and the rows of other tiles
    in it as further rows of the tile that are not its ``own``."""
    made, span = layout(df, n, most, shift)
    views, lookers = made.halos(span)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).to_numpy() for c in ("x", "y"))
            tiles = made.tiles(x, y)
            order = np.argsort(tiles, kind="stable")
            numbers, first = np.unique(tiles[order], return_index=True)
            rows, targets = [], []
            for tile, at in zip(numbers.tolist(), np.split(order, first[1:])):
                rows.append(at)
                targets.append(np.full(len(at), tile))
                for other in lookers[tile]:
                    x0, x1, y0, y1 = views[other]
                    seen = at[(x[at] >= x0) & (x[at] <= x1) & (y[at] >= y0) & (y[at] <= y1)]
                    rows.append(seen)
                    targets.append(np.full(len(seen), other))
            if not rows:
                continue
            rows, targets = np.concatenate(rows), np.concatenate(targets)
            view = np.array([views[t] for t in targets.tolist()])
            extra = [pa.array(targets), pa.array(targets == tiles[rows]), *(pa.array(np.ascontiguousarray(c)) for c in view.T)]
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows)) for c in batch.columns), *extra],
                                             names=[*batch.schema.names, "tile", "own", "x0", "x1", "y0", "y1"])

    schema = ", ".join([*(f"{c} {t}" for c, t in df.dtypes), "tile long", "own boolean", "x0 double", "x1 double", "y0 double", "y1 double"])
    return df.mapInArrow(run, schema)


# -- Ward ----------------------------------------------------------------------------------------------------------

WARD = "kind int, id long, n long, sx long, sy long, into long, cost double, tile long"


def merge_tile(ids, n, sx, sy, own=None, borders=(-np.inf, np.inf, -np.inf, np.inf), least: int = 1):
    """Merge the groups of one tile as far as nothing outside can matter; ``ids`` ascend.

    Groups that are not its ``own`` only count as neighbours (whatever they are merged with elsewhere, the
    result is no nearer than the nearest of its parts). Besides those, no group outside has fewer than ``least``
    members and none stands within the borders. Returns which own groups are left, with the sums of all, and the
    merges (id, into, cost).
    """
    n, sx, sy = n.astype(np.int64), sx.astype(np.int64), sy.astype(np.int64)
    m = len(ids)
    x, y, w = sx / n, sy / n, n.astype(float)
    alive = np.ones(m, dtype=bool)

    def costs(a: int) -> np.ndarray:
        row = comparable(((x - x[a]) ** 2 + (y - y[a]) ** 2) * (w * w[a] / (w + w[a])))
        row[~alive] = np.inf
        row[a] = np.inf
        return row

    def outside(a: int) -> float:
        gap = max(0.0, min(x[a] - borders[0], borders[1] - x[a], y[a] - borders[2], borders[3] - y[a]))
        return float(comparable(np.array(gap * gap * (w[a] * least / (w[a] + least)))))

    cost = np.stack([costs(a) for a in range(m)])
    best = cost.argmin(axis=1)
    low = cost[np.arange(m), best]
    beyond = np.array([outside(a) for a in range(m)])
    own = np.ones(m, dtype=bool) if own is None else own
    free = own & (low < beyond)  # groups that may be merged now
    merges = []
    while True:
        score = np.where(free, low, np.inf)
        a = int(score.argmin())
        if not np.isfinite(score[a]):
            break
        b = int(best[a])
        if not free[b] or best[b] != a:
            free[a] = False  # its nearest waits, so it waits too
            continue
        a, b = min(a, b), max(a, b)
        merges.append((ids[b], ids[a], low[a]))
        n[a], sx[a], sy[a] = n[a] + n[b], sx[a] + sx[b], sy[a] + sy[b]
        x[a], y[a], w[a] = sx[a] / n[a], sy[a] / n[a], float(n[a])
        alive[b] = free[b] = False
        low[b] = np.inf
        cost[b, :] = cost[:, b] = np.inf
        row = costs(a)
        cost[a, :], cost[:, a] = row, row
        best[a], low[a] = row.argmin(), row.min()
        beyond[a] = outside(a)
        free[a] = low[a] < beyond[a]
        for i in np.flatnonzero(alive & ((best == a) | (best == b))):
            if i != a:
                best[i] = cost[i].argmin()
                low[i] = cost[i, best[i]]
        closer = alive & ((row < low) | ((row == low) & (a < best)))
        closer[a] = False
        best[closer], low[closer] = a, row[closer]
    return alive & own, n, sx, sy, merges


def _merge_tiles(least: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        first = rows.iloc[0]
        alive, n, sx, sy, merges = merge_tile(
            rows["id"].to_numpy(), rows["n"].to_numpy(), rows["sx"].to_numpy(), rows["sy"].to_numpy(),
            rows["own"].to_numpy(), (first["x0"], first["x1"], first["y0"], first["y1"]), least)
        left = [(0, *group, 0, 0.0) for group in zip(rows["id"].to_numpy()[alive], n[alive], sx[alive], sy[alive])]
        gone = [(1, own, 0, 0, 0, into, cost) for own, into, cost in merges]
        return pd.DataFrame(left + gone, columns=["kind", "id", "n", "sx", "sy", "into", "cost"]).assign(tile=first["tile"])

    return run


def ward_merges(points: DataFrame, most: int = TILE) -> list[DataFrame]:
    """The whole tree of Ward's method over ``points`` (id, sx, sy), as one table of merges a round: id, into, cost, tile.

    The group whose smallest member is ``id`` joins the one with smallest member ``into`` at ``cost``, the growth
    of the sum of squares. A round that merges nothing, or too little, is followed by larger tiles.
    """
    state, rounds, before = points.select("id", F.lit(1).cast("long").alias("n"), "sx", "sy"), [], 0
    while True:
        n, least = state.agg(F.count("*"), F.min("n")).first()
        if n <= 1:
            return rounds
        if before and n > 0.9 * before:
            most *= 2
        placed = state.withColumns({"x": F.col("sx") / F.col("n"), "y": F.col("sy") / F.col("n")})
        tiled = with_halos(placed, n, most, 0.5 * (len(rounds) % 2))
        made = stage(tiled.groupBy("tile").applyInPandas(_merge_tiles(least), WARD), "ward")
        rounds.append(made.where("kind = 1").select("id", "into", "cost", "tile"))
        state, before = made.where("kind = 0").select("id", "n", "sx", "sy"), n


# -- single linkage ------------------------------------------------------------------------------------------------

EDGE = "a long, b long, cost double"
SPAN = "tile long, a long, b long, cost double, ids array<long>, xs array<double>, ys array<double>"


def spanning_edges(ids: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of a tile's points by (cost, smaller id, larger id): places of both ends, and costs."""
    m = len(ids)
    if m < 2:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)
    low, near = np.full(m, np.inf), np.zeros(m, dtype=np.int64)
    open_ = np.ones(m, dtype=bool)
    ends, costs = [], []
    at = 0
    for _ in range(m - 1):
        open_[at] = False
        cost = comparable((x - x[at]) ** 2 + (y - y[at]) ** 2)
        lo, hi = np.minimum(ids, ids[at]), np.maximum(ids, ids[at])
        old_lo, old_hi = np.minimum(ids, ids[near]), np.maximum(ids, ids[near])
        better = (cost < low) | ((cost == low) & ((lo < old_lo) | ((lo == old_lo) & (hi < old_hi))))
        low, near = np.where(better, cost, low), np.where(better, at, near)
        where = np.flatnonzero(open_ & (low == low[open_].min()))
        if len(where) > 1:
            order = np.lexsort((np.maximum(ids[where], ids[near[where]]), np.minimum(ids[where], ids[near[where]])))
            where = where[order]
        at = int(where[0])
        ends.append((at, int(near[at])))
        costs.append(low[at])
    pairs = np.array(ends, dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1], np.array(costs)


def _span_tile(rows: pd.DataFrame) -> pd.DataFrame:
    """The edges inside a tile, and one row with its points."""
    rows = rows.sort_values("id")
    ids, x, y = (rows[c].to_numpy() for c in ("id", "x", "y"))
    a, b, cost = spanning_edges(ids, x, y)
    tile = rows["tile"].iloc[0]
    edges = [(tile, u, v, c, None, None, None) for u, v, c in zip(np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]), cost)]
    return pd.DataFrame([*edges, (tile, None, None, None, ids, x, y)], columns=["tile", "a", "b", "cost", "ids", "xs", "ys"], dtype=object)


def _beside(row: dict, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, x, y and side of the points of a pair of tiles that are within ``reach`` of the other tile's box."""
    sides = []
    for own, other in (("", "other_"), ("other_", "")):
        ids, x, y = (np.array(row[own + c]) for c in ("ids", "xs", "ys"))
        ox, oy = np.array(row[other + "xs"]), np.array(row[other + "ys"])
        gap_x = np.maximum(0, np.maximum(ox.min() - x, x - ox.max()))
        gap_y = np.maximum(0, np.maximum(oy.min() - y, y - oy.max()))
        near = gap_x**2 + gap_y**2 <= reach
        sides.append((ids[near], x[near], y[near], np.full(int(near.sum()), own == "")))
    return tuple(np.concatenate(c) for c in zip(*sides))


def _span_pairs(reach: float):
    """Edges between the two tiles of a pair that the spanning tree of both would use, up to ``reach``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, x, y, side = _beside(row, reach)
                a, b, cost = spanning_edges(ids, x, y)
                keep = (side[a] != side[b]) & (cost <= reach)
                a, b = ids[a[keep]], ids[b[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(cost[keep])], names=["a", "b", "cost"])

    return run


def _closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest squared distance between the points of two tiles."""
    for batch in batches:
        made = []
        for row in batch.to_pylist():
            ox, oy = np.array(row["other_xs"]), np.array(row["other_ys"])
            made.append(min(float(((ox - x) ** 2 + (oy - y) ** 2).min()) for x, y in zip(row["xs"], row["ys"])))
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.float64())], names=["cost"])


def candidate_edges(points: DataFrame, n: int, most: int) -> DataFrame:
    """Edges (a, b, cost: squared length) among which the minimum spanning tree of ``points`` (id, x, y) is.

    The tree's edges inside a tile or a pair of tiles belong to the spanning tree of those. Hopping from tile to
    tile on the shortest way connects everything, so no edge of the tree is longer than the longest hop or the
    longest edge inside a tile: only tiles nearer than that are paired.
    """
    made = stage(with_tiles(points, n, most).select("id", "x", "y", "tile").groupBy("tile").applyInPandas(_span_tile, SPAN), "span")
    inside = made.where("a IS NOT NULL").select("a", "b", "cost")
    blobs = made.where("ids IS NOT NULL").select("tile", "ids", "xs", "ys")
    boxes = stage(blobs.select("tile", F.array_min("xs").alias("x0"), F.array_max("xs").alias("x1"), F.array_min("ys").alias("y0"),
                               F.array_max("ys").alias("y1")), "boxes")
    if boxes.count() == 1:
        return inside
    second = blobs.select(F.col("tile").alias("o_tile"), *[F.col(c).alias("other_" + c) for c in ("ids", "xs", "ys")])

    def met(pairs: DataFrame) -> DataFrame:
        return pairs.join(blobs, "tile").join(second, "o_tile").drop("tile", "o_tile")

    # Up one strip and down the next. A row per tile: this window is small, whatever the points.
    width = max(1, math.ceil(math.sqrt(n / most))) + 3  # as in ``layout``
    snake = f"tile div {width}, case when tile div {width} % 2 = 0 then tile else -tile end"
    hops = boxes.selectExpr("tile", f"lead(tile) over (order by {snake}) as o_tile").where("o_tile IS NOT NULL")
    longest = [r[0] for r in (met(hops).mapInArrow(_closest, "cost double").agg(F.max("cost")).first(), inside.agg(F.max("cost")).first())]
    reach = max(c for c in longest if c is not None) * (1 + 1e-6)
    side = max(math.sqrt(reach), 1.0)
    # Boxes that grow by half the reach meet if they are within it; the cells of both then overlap.
    wide = boxes.agg(F.max(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))).first()[0]
    cell = max(side, wide / 4)

    def cells(low: str, high: str):
        return F.sequence(F.floor((F.col(low) - side / 2) / cell), F.floor((F.col(high) + side / 2) / cell))

    spread = boxes.withColumn("cx", F.explode(cells("x0", "x1"))).withColumn("cy", F.explode(cells("y0", "y1"))).select("tile", "cx", "cy", "x0", "x1", "y0", "y1")
    other = spread.select(*[F.col(c).alias(f"o_{c}") for c in spread.columns])
    gap_x = F.greatest(F.lit(0.0), F.col("o_x0") - F.col("x1"), F.col("x0") - F.col("o_x1"))
    gap_y = F.greatest(F.lit(0.0), F.col("o_y0") - F.col("y1"), F.col("y0") - F.col("o_y1"))
    pairs = spread.join(other, (F.col("cx") == F.col("o_cx")) & (F.col("cy") == F.col("o_cy")) & (F.col("tile") < F.col("o_tile"))).where(
        gap_x * gap_x + gap_y * gap_y <= reach).select("tile", "o_tile").distinct()
    return inside.unionByName(met(stage(pairs, "pairs")).mapInArrow(_span_pairs(reach), EDGE)).distinct()


def contract_tile(edges: pd.DataFrame, tile: int, cut: bool) -> tuple[list[tuple[int, int, float]], dict[int, int]]:
    """Join the groups of one tile along edges (u, v, cost, a, b and the tiles tu, tv of both ends).

    ``cut``: an edge is only used while it is the shortest out of one of its groups (it is then in the spanning
    tree); otherwise every edge inside the tile is used. Returns the used edges, and new group by old.
    """
    parent: dict[int, int] = {}
    blocked: set[int] = set()

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    used = []
    ordered = edges.sort_values(["cost", "a", "b"])[["u", "v", "tu", "tv", "a", "b", "cost"]]
    for u, v, tu, tv, a, b, cost in ordered.itertuples(index=False, name=None):
        if tu != tile or tv != tile:
            if cut:
                blocked.add(root(u if tu == tile else v))  # its shortest edge leads out
            continue
        u, v = root(u), root(v)
        if u == v or (u in blocked and v in blocked):
            continue
        used.append((a, b, cost))
        parent[max(u, v)] = min(u, v)
        if u in blocked or v in blocked:
            blocked.add(min(u, v))
    return used, {x: root(x) for x in parent if root(x) != x}


def contracted(points: DataFrame, edges: DataFrame, cut: bool, most: int = TILE) -> tuple[list[DataFrame], list[DataFrame]]:
    """Rounds of ``contract_tile`` until no edge is left between groups: (used edges, id and new group) of every round."""
    schema = "kind int, a long, b long, cost double, id long, root long"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        used, moved = contract_tile(rows, rows["tile"].iloc[0], cut)
        made = [(0, a, b, cost, 0, 0) for a, b, cost in used] + [(1, 0, 0, 0.0, own, root) for own, root in moved.items()]
        return pd.DataFrame(made, columns=["kind", "a", "b", "cost", "id", "root"])

    groups, left = points, stage(edges.select("a", "b", "cost", F.col("a").alias("u"), F.col("b").alias("v")), "edges")
    used, moves, before = [], [], 0
    while not left.isEmpty():
        n = groups.count()
        if before and n > 0.9 * before:
            most *= 2
        tiles = stage(with_tiles(groups, n, most, 0.5 * (len(used) % 2)).select("id", "x", "y", "tile"), "tiles")
        ends = left.join(tiles.select(F.col("id").alias("u"), F.col("tile").alias("tu")), "u").join(
            tiles.select(F.col("id").alias("v"), F.col("tile").alias("tv")), "v")
        dealt = ends.withColumn("tile", F.explode(F.array_distinct(F.array("tu", "tv"))))
        made = stage(dealt.groupBy("tile").applyInPandas(run, schema), "contracted")
        used.append(made.where("kind = 0").select("a", "b", "cost"))
        moves.append(made.where("kind = 1").select("id", "root"))
        groups = tiles.join(moves[-1].select("id"), "id", "left_anti").select("id", "x", "y")
        for end in ("u", "v"):
            left = left.join(moves[-1].withColumnsRenamed({"id": end, "root": "__root"}), end, "left").withColumn(
                end, F.coalesce("__root", end)).drop("__root")
        left = left.where("u != v")
        if cut:  # of edges between the same groups the shortest is enough
            best = left.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.min(F.struct("cost", "a", "b")).alias("e"))
            left = best.select("e.a", "e.b", "e.cost", "u", "v")
        left, before = stage(left, "edges"), n
    return used, moves


# -- labels --------------------------------------------------------------------------------------------------------


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _followed(labels: DataFrame, moves: list[DataFrame]) -> DataFrame:
    """``label`` of every row, replaced round by round."""
    for m in moves:
        labels = labels.join(m.select(F.col("id").alias("label"), F.col("root").alias("__root")), "label", "left").withColumn(
            "label", F.coalesce("__root", "label")).drop("__root")
    return labels


def _named(labels: DataFrame, name: str, place: str = "id") -> DataFrame:
    """Numbers 1, 2, ... for the groups, by smallest member in position order."""
    stored = stage(labels, "labels")
    firsts = stored.groupBy("label").agg(F.min(place).alias("first")).collect()  # k rows
    roots = [r["label"] for r in sorted(firsts, key=lambda r: r["first"])]
    number = F.create_map(*[F.lit(x).cast(t) for i, r in enumerate(roots, 1) for x, t in ((r, "long"), (i, "int"))])
    return stored.withColumn(name, number[F.col("label")]).drop("label")


def ward_labels(points: DataFrame, k: int, name: str, most: int = TILE) -> DataFrame:
    """``points`` with their group 1..k of Ward's method, numbered by smallest member."""
    mixed = points.withColumn("place", F.col("id")).withColumn("id", F.pmod((F.col("id") + 1) * MIXER, F.lit(MODULUS)))
    rounds = ward_merges(mixed, most)
    if not rounds:
        return points.withColumn(name, F.lit(1))
    cuts = {r[0] for r in _union(rounds).orderBy(F.desc("cost"), F.desc("into"), F.desc("id")).limit(k - 1).select("id").collect()}  # k - 1 rows

    def roots(rows: pd.DataFrame) -> pd.DataFrame:
        """Where the groups of one tile end up, but for those that are cut off."""
        into = {i: t for i, t in zip(rows["id"], rows["into"]) if i not in cuts}
        found = {}
        for i in into:
            t = i
            while t in into:
                t = into[t]
            found[i] = t
        return pd.DataFrame({"id": list(found), "root": list(found.values())}, dtype="int64")

    moves = [r.groupBy("tile").applyInPandas(roots, "id long, root long") for r in rounds]
    labels = _followed(mixed.withColumn("label", F.col("id")), moves)
    return _named(labels, name, "place").drop("place")


def single_labels(points: DataFrame, k: int, name: str, most: int = TILE) -> DataFrame:
    """``points`` with their group 1..k of single linkage: the spanning tree without its k - 1 longest edges."""
    placed = points.select("id", F.col("sx").cast("double").alias("x"), F.col("sy").cast("double").alias("y"))
    n = placed.count()
    if n <= 1:
        return points.withColumn(name, F.lit(1))
    used, _ = contracted(placed, candidate_edges(placed, n, most), True, most)
    tree = stage(_union(used).distinct(), "tree")
    cuts = tree.orderBy(F.desc("cost"), F.desc("a"), F.desc("b")).limit(k - 1).collect()  # k - 1 rows
    gone = reduce(or_, [(F.col("a") == r["a"]) & (F.col("b") == r["b"]) for r in cuts], F.lit(False))
    kept = tree.where(~gone)
    _, moves = contracted(placed, kept, False, most)
    return _named(_followed(points.withColumn("label", F.col("id")), moves), name)


LINKAGES: dict[str, Callable[..., DataFrame]] = {"ward": ward_labels, "single": single_labels}
