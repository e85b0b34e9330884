"""Near copies among vectors, by dual traversal of cover trees.

Vectors of one label link when their cosine reaches a threshold. On the unit sphere that is a
distance, sqrt(2 - 2 cos), so the triangle inequality holds. A tree has nested levels of
halving radii: the children of a node lie within half its radius around points of their own.
Two trees are traversed together: a pair of nodes is dropped where the distance of the
centres less both covering radii exceeds the threshold, counted as a whole where the distance
plus both radii stays below it, and opened otherwise; single points are compared exactly.

Spark deals out the work. Equal vectors are one point with a weight. The top level of the tree
of a large label is a bounded set of pivots: points go to their nearest pivot, and cells with
too many points are divided by a hash. Pairs of cells that the covering-radius bound does not
exclude are tasks of at most two cells' points; links within a task go out as a spanning
forest and one count per point, never as a list of pairs. Components are found by joins.

How much the bound excludes depends on the data: points without any cluster structure in many
dimensions leave all pairs of cells of a label, which is quadratic in its cells.

Defined cases: a vector that is null, empty or zero or holds null or non-finite components
links with nothing, nor does one with a null label; vectors of different lengths do not link.
Components of any finite size are compared by their direction alone, 1e-200 or 1e200 included.
Repeated rows and ids are rows of their own, which link if their vectors do. An empty table
gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillweave.llm.common import components, input_rows, settled

COSINE = 0.98
#: Points of a cell; a task holds two cells.
CELL_POINTS = 4096
#: Pivots of a label, and of all labels; labels beyond that are divided by the hash alone.
PIVOTS, PIVOTS_KEPT = 64, 4096
#: Nodes of so many points have no children.
LEAF = 24
#: Distances are computed to about 1e-8 near 0. Bounds decide only beyond that margin.
_MARGIN = 1e-7
_ROWS = 512


class Node:
    __slots__ = ("start", "stop", "centre", "radius", "children")

    def __init__(self, start: int, stop: int, centre: int, radius: float):
        self.start, self.stop, self.centre, self.radius = start, stop, centre, radius
        self.children: list[Node] = []


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


class CoverTree:
    """Points in tree order: each node owns a slice of them, its centre is the first."""

    def __init__(self, units: np.ndarray):
        self.units = units
        self.order = np.arange(len(units))
        self.root = self._build(0, len(units), 2.0) if len(units) else None

    def _build(self, start: int, stop: int, reach: float) -> Node:
        own = self.order[start:stop]
        far = _distances(self.units[own], self.units[own[:1]])[:, 0]
        node = Node(start, stop, own[0], float(far.max()))
        if stop - start <= LEAF or node.radius == 0.0:
            return node
        # The next level whose radius lies below this node's: levels in between have one node.
        while reach / 2 >= node.radius:
            reach /= 2
        groups = self._net(own, reach / 2)
        self.order[start:stop] = np.concatenate(groups)
        at = start
        for g in groups:
            node.children.append(self._build(at, at + len(g), reach / 2))
            at += len(g)
        return node

    def _net(self, points: np.ndarray, reach: float) -> list[np.ndarray]:
        """Each point joins the first centre within reach; points without one become centres."""
        groups, rest = [], points
        while len(rest):
            heads = rest[:_ROWS]
            near = _distances(self.units[heads], self.units[rest]) <= reach
            free = np.ones(len(rest), dtype=bool)
            for i in range(len(heads)):
                if free[i]:
                    near[i, i] = True
                    mine = near[i] & free
                    free &= ~mine
                    mine[i] = False
                    groups.append(np.concatenate((rest[i : i + 1], rest[mine])))
            rest = rest[free]
        return groups


class Forest:
    """Union of points, in whole arrays."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        while len(u):
            u, v = self.parent[u], self.parent[v]
            apart = u != v
            u, v = u[apart], v[apart]
            if len(u):
                np.minimum.at(self.parent, np.maximum(u, v), np.minimum(u, v))
                while True:
                    up = self.parent[self.parent]
                    if (up == self.parent).all():
                        break
                    self.parent = up


class DualTraversal:
    """Link counts and components of points a, or between points a and b."""

    def __init__(self, a: np.ndarray, wa: np.ndarray, b: np.ndarray | None, wb: np.ndarray | None, cosine: float):
        self.cosine, self.limit = cosine, np.sqrt(2.0 - 2.0 * cosine)
        self.same = b is None
        self.raw, self.norm, self.weight, self.tree = [], [], [], []
        for x, w in ((a, wa),) if self.same else ((a, wa), (b, wb)):
            norm = np.sqrt((x * x).sum(axis=1))
            self.raw.append(x)
            self.norm.append(norm)
            self.weight.append(w.astype(np.int64))
            self.tree.append(CoverTree(x / norm[:, None]))
        self.side = (0, 0) if self.same else (0, 1)
        self.base = (0, 0) if self.same else (0, len(a))
        self.links = [np.zeros(len(x), dtype=np.int64) for x in self.raw]
        self.forest = Forest(sum(map(len, self.raw)))
        roots = [self.tree[s].root for s in self.side]
        stack = [(roots[0], roots[1])] if all(roots) else []
        while stack:
            self._open(*stack.pop(), stack)

    def _points(self, which: int, node: Node) -> np.ndarray:
        return self.tree[self.side[which]].order[node.start : node.stop]

    def _open(self, x: Node, y: Node, stack: list) -> None:
        if not x.children and not y.children:
            self._compare(self._points(0, x), self._points(1, y), self.same and x is y)
            return
        twin = self.same and x is y
        xs, ys = x.children or [x], y.children or [y]
        self._cross(xs, xs if twin else ys, twin, stack)

    def _cross(self, xs: list[Node], ys: list[Node], twin: bool, stack: list) -> None:
        tx, ty = self.tree[self.side[0]], self.tree[self.side[1]]
        one_x = np.array([n.stop - n.start == 1 for n in xs])
        one_y = np.array([n.stop - n.start == 1 for n in ys])
        # Single points meet exactly, in one go.
        px, py = np.array([n.centre for n, o in zip(xs, one_x, strict=True) if o], int), np.array([n.centre for n, o in zip(ys, one_y, strict=True) if o], int)
        if len(px) and len(py):
            self._compare(px, py, twin)
        centres = ty.units[[n.centre for n in ys]]
        ry = np.array([n.radius for n in ys])
        number = np.arange(len(ys))
        for i in range(0, len(xs), _ROWS):
            part = xs[i : i + _ROWS]
            d = _distances(tx.units[[n.centre for n in part]], centres)
            reach = np.array([n.radius for n in part])[:, None] + ry[None, :]
            near = d <= self.limit + reach + _MARGIN
            near &= ~(one_x[i : i + _ROWS, None] & one_y[None, :])
            if twin:
                near &= number[None, :] >= np.arange(i, i + len(part))[:, None]
            all_in = near & (d + reach <= self.limit - _MARGIN)
            for r, c in zip(*np.nonzero(near), strict=True):
                if all_in[r, c]:
                    self._count(part[r], ys[c], twin and i + r == c)
                else:
                    stack.append((part[r], ys[c]))

    def _count(self, x: Node, y: Node, twin: bool) -> None:
        """Every point of x links with every point of y."""
        px, py = self._points(0, x), self._points(1, y)
        wx, wy = self.weight[self.side[0]], self.weight[self.side[1]]
        self.links[self.side[0]][px] += wy[py].sum() - (wx[px] if twin else 0)
        if not twin:
            self.links[self.side[1]][py] += wx[px].sum()
        everyone = np.concatenate((px + self.base[0], py + self.base[1]))
        self.forest.join(np.full(len(everyone), everyone[0]), everyone)

    def _compare(self, px: np.ndarray, py: np.ndarray, twin: bool) -> None:
        """Exact cosines of points; ``twin``: px and py are the same points."""
        sx, sy = self.side
        for i in range(0, len(px), _ROWS):
            p = px[i : i + _ROWS]
            cos = (self.raw[sx][p] @ self.raw[sy][py].T) / (self.norm[sx][p][:, None] * self.norm[sy][py][None, :])
            link = cos >= self.cosine
            if twin:
                link[np.arange(len(p)), np.arange(i, i + len(p))] = False
            self.links[sx][p] += link @ self.weight[sy][py]
            if not twin:
                self.links[sy][py] += link.T @ self.weight[sx][p]
            r, c = np.nonzero(link)
            self.forest.join(p[r] + self.base[0], py[c] + self.base[1])


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component to [0.5, 1): norms neither
    overflow nor vanish, and no cosine changes, since such a factor is exact."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _vectors(rows: pd.DataFrame) -> np.ndarray:
    v = np.array(rows["v"].tolist(), dtype=np.float64)
    return _scaled(v) if len(v) else v


def _near(cosine: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Links of the points of one pair of cells: point, links, root."""
        rows = rows.sort_values("point", kind="stable")
        a, b = rows[rows["side"] == 0], rows[rows["side"] == 1]
        two = bool(rows["two"].iloc[0])
        if two and (a.empty or b.empty):
            return pd.DataFrame({"point": [], "links": [], "root": []}).astype("int64")
        found = DualTraversal(
            _vectors(a), a["weight"].to_numpy(), _vectors(b) if two else None, b["weight"].to_numpy() if two else None, cosine
        )
        points = pd.concat([a, b])["point"].to_numpy() if two else a["point"].to_numpy()
        out = pd.DataFrame({"point": points, "links": np.concatenate(found.links), "root": points[found.forest.parent]})
        return out[(out["links"] > 0) | (out["root"] != out["point"])]

    return run


def _nearest(shared):
    """Adds the nearest pivot of the label (-1: the label has none) and the distance to it."""

    def run(batches):
        pivots = shared.value
        for rows in batches:
            pivot, far = np.full(len(rows), -1, dtype=np.int64), np.zeros(len(rows))
            place = np.arange(len(rows))
            for key, at in pd.Series(place).groupby([rows["label"].to_numpy(), rows["dim"].to_numpy()]):
                own = pivots.get(key)
                if own is not None:
                    x = _vectors(rows.iloc[at.to_numpy()])
                    d = _distances(x / np.sqrt((x * x).sum(axis=1))[:, None], own)
                    pivot[at] = d.argmin(axis=1)
                    far[at] = d.min(axis=1)
            yield rows.assign(pivot=pivot, far=far)

    return run


def _placed(points: DataFrame, cell_points: int) -> tuple[DataFrame, DataFrame]:
    """``points`` with their cell, and the pairs of cells that may hold links.

    Cells are (label, dim, pivot, part); pairs have them twice, as pivot0, part0, pivot1, part1.
    """
    spark = points.sparkSession
    key = ["label", "dim"]
    large = (
        points.groupBy(*key).agg(F.count("*").alias("size")).where(F.col("size") > cell_points)
        .selectExpr(*key, f"least({PIVOTS}, cast(ceil(size / {cell_points}) as int)) pivots")
    )
    # Spark cuts such a ranking per task, so a hot label is never sorted in one place.
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("draw"))
    drawn = (
        points.select(*key, "v", F.xxhash64("point").alias("draw")).withColumn("nth", nth).where(f"nth <= {PIVOTS}")
        .join(large, key).where("nth <= pivots").limit(PIVOTS_KEPT)
    )
    units: dict[tuple, list] = {}
    for r in drawn.select(*key, "nth", "v").orderBy(*key, "nth").collect():  # PIVOTS_KEPT rows at most
        v = _scaled(np.array([r.v]))[0]
        units.setdefault((r.label, r.dim), []).append(v / np.sqrt((v * v).sum()))
    shared = spark.sparkContext.broadcast({k: np.array(v) for k, v in units.items()})
    fields = "point bigint, weight bigint, label bigint, dim int, v array<double>"
    near = settled(points.mapInPandas(_nearest(shared), f"{fields}, pivot bigint, far double"))
    cells = near.groupBy(*key, "pivot").agg(F.count("*").alias("size"), F.max("far").alias("radius"))
    cells = cells.withColumn("parts", F.expr(f"cast(ceil(size / {cell_points}) as bigint)"))
    # Cells of equal vectors alone cannot be large: those are one point.
    placed = near.join(cells.select(*key, "pivot", "parts"), [*key, "pivot"]).withColumn(
        "part", F.expr("pmod(xxhash64('part', point), parts)")
    ).drop("far", "parts")
    rows = [(*k, i, u.tolist()) for k, v in units.items() for i, u in enumerate(v)]
    centres = spark.createDataFrame(rows, "label bigint, dim int, pivot bigint, centre array<double>")
    split = cells.join(centres, [*key, "pivot"], "left").selectExpr(
        *key, "pivot", "radius", "centre", "explode(sequence(0L, parts - 1)) part"
    )
    first, second = (split.withColumnsRenamed({c: f"{c}{i}" for c in ("pivot", "part", "radius", "centre")}) for i in (0, 1))
    pairs = first.join(second, key).where(
        "(pivot0 < pivot1 or pivot0 = pivot1 and part0 <= part1)"
    )
    dot = "aggregate(zip_with(centre0, centre1, (x, y) -> x * y), 0D, (s, x) -> s + x)"
    return placed, pairs.withColumn("gap", F.expr(f"if(pivot0 = pivot1, 0D, sqrt(greatest(2 - 2 * {dot}, 0D)) - radius0 - radius1)"))


def near_copies(
    vectors: DataFrame, cosine: float = COSINE, cell_points: int = CELL_POINTS,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of ``vectors``."""
    own = input_rows(
        vectors, vec_id=F.col(f"`{vec_id}`").cast("long"), v=F.col(f"`{embedding}`").cast("array<double>"),
        label=F.col(f"`{label}`").cast("long"),
    )
    finite = "x is not null and not isnan(x) and abs(x) < double('infinity')"
    usable = f"label is not null and v is not null and coalesce(forall(v, x -> {finite}) and exists(v, x -> x <> 0), false)"
    rows = settled(own.selectExpr("vec_id", "label", f"if({usable}, v, null) v"))
    classes = rows.where("v is not null").groupBy("label", "v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    # Numbered when settled: from there on the numbers are fixed.
    classes = settled(classes.withColumn("point", F.monotonically_increasing_id()))
    points = classes.selectExpr("point", "weight", "label", "size(v) dim", "v")
    placed, pairs = _placed(points, cell_points)
    limit = float(np.sqrt(2 - 2 * cosine))
    key = ["label", "dim", "pivot0", "part0", "pivot1", "part1"]
    pairs = settled(pairs.where(F.col("gap") <= limit + _MARGIN).select(*key)).withColumn(
        "two", F.expr("pivot0 <> pivot1 or part0 <> part1")
    )
    sides = [
        placed.withColumnsRenamed({"pivot": f"pivot{i}", "part": f"part{i}"})
        .join(pairs if i == 0 else pairs.where("two"), ["label", "dim", f"pivot{i}", f"part{i}"])
        .select(*key, "two", F.lit(i).alias("side"), "point", "weight", "v")
        for i in (0, 1)
    ]
    found = settled(
        sides[0].unionByName(sides[1]).groupBy(*key).applyInPandas(_near(cosine), "point bigint, links bigint, root bigint")
    )
    roots = components(found.where("root <> point").selectExpr("point u", "root v"))
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    named = (
        classes.select("point", "label", "v", "weight", "least")
        .join(links, "point", "left")
        .join(roots.withColumnRenamed("node", "point"), "point", "left")
        .withColumn("root", F.expr("coalesce(root, point)"))
    )
    component = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(component, "root").selectExpr(
        "label c_label", "v c_v", "coalesce(links, 0) + weight - 1 n_links", "component"
    )
    joined = rows.join(named, F.expr("label = c_label and v = c_v"), "left")
    return settled(
        joined.selectExpr("vec_id", "coalesce(n_links, 0) n_links", "if(v is null, vec_id, component) component_id")
    ).withColumn("kept", F.expr("coalesce(vec_id = component_id, false)"))
