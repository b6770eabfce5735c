"""Exact embedding near-duplicates by dual traversal of cover trees.

Two vectors link when their cosine is at least a threshold, that is when their angle is
at most ``acos`` of it; angles obey the triangle inequality, so the trees use them.

1. Equal vectors are one class with a weight; all later work is on classes.
2. Upper levels: a bounded sample gives nested nets with halving radii on the driver, cut
   at ``PIVOTS`` nodes.  Each class goes to its nearest pivot; the pivots' covering radii are
   measured over all their classes.  Pivots, in tree order, are dealt into cells of about
   ``CELL`` classes, large pivots (near copies of one vector, say) over several by hash.
3. Lower levels: a task builds a cover tree for each cell.  A node of radius ``r`` is split
   into a net of nodes of radius ``r/2`` whose centres are members more than ``r/2`` apart, its
   own centre among them; each node keeps its true covering radius.  Members of a node are
   contiguous in the tree's order.
4. Dual traversal: pairs of pivots, then, in tasks over the pairs of cells that are left, pairs
   of nodes level by level.  A node carries the list of the other tree's nodes that it has
   still to meet; the children of both are compared at once.  A pair of nodes further apart
   than threshold plus both radii is pruned; one within threshold minus both radii links
   all its members without visiting them; single vectors are decided in double precision.
   Bounds on single-precision products have a margin for their rounding, so none is lost.

A pair of cells reports link counts per class and a spanning forest of its links, never
the pairs themselves.  Vectors without near neighbours in many dimensions cannot be pruned by
any radius (all are about 90 degrees apart): their pairs are compared in blocks, work that
grows with the square of such vectors, as do the rows that carry a cell to its partners.

Defined results: a null vector, one without components, of zeros only, or with a null or
non-finite component links with nothing and is its own component; vectors of different
length are compared as if the shorter had zeros at its end; repeated rows and rows with a
null vec_id are vectors of their own and link as such, but a null never names a component
unless all its ids are null; ``kept`` compares null-safely, so all rows of the naming id are
kept; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystar.llm.jaccard import components
from delaystar.llm.tables import arrow_schema, stored, to_batch

SIMILARITY = 0.9
#: Vectors in the sample for the upper levels, most pivots, and classes in a cell.
SAMPLE, PIVOTS, CELL = 2048, 256, 2048
#: Levels below the root, with radii from a half turn down; in the last one every vector is a node.
LEVELS = 11
#: Margin of angles against rounding, and of cosines below which the exact quotient decides.
MARGIN, CLOSE = 1e-7, 1e-12
#: Classes of a cell have ids from ``cell * SPAN`` on; a cell is far smaller.
SPAN = 1 << 24


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that no square overflows."""
    x = rows.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def padded(lists: list[np.ndarray], width: int = 0) -> np.ndarray:
    """Vectors as rows of a matrix, zeros after the shorter ones."""
    width = max([width, *map(len, lists)])
    out = np.zeros((len(lists), width))
    for row, v in zip(out, lists, strict=True):
        row[: len(v)] = v
    return out


def build_tree(units: np.ndarray) -> tuple[np.ndarray, list[dict[str, np.ndarray]]]:
    """(order, levels): rows of ``units`` in tree order, and the nodes of each level.

    A level has ``centre`` (place in the order), ``lo``/``hi`` (members), ``rho`` (covering radius)
    and ``child`` (first child in the next level; the next node's first child ends them).
    """
    def angle(c: int, members: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(units[members] @ units[c], -1, 1))

    everyone = np.arange(len(units))
    middle = int(np.argmax(units @ units.mean(axis=0)))
    nodes = [(middle, everyone, float(angle(middle, everyone).max()) if len(units) > 1 else 0.0)]
    grown, childs = [nodes], []
    for depth in range(1, LEVELS + 1):
        below, child = [], [0]
        for centre, members, rho in nodes:
            if len(members) == 1:
                below.append((centre, members, 0.0))
            elif depth == LEVELS:
                below += [(int(m), members[k : k + 1], 0.0) for k, m in enumerate(members)]
            else:
                c, rest, radius = centre, members, math.pi / 2**depth
                while len(rest):
                    far = angle(c, rest)
                    near = (far <= radius) | (rest == c)
                    inside = rest[near]
                    below.append((c, inside, float(far[near].max()) if len(inside) > 1 else 0.0))
                    rest = rest[~near]
                    c = int(rest[0]) if len(rest) else c
            child.append(len(below))
        nodes = below
        grown.append(nodes)
        childs.append(np.array(child))
    order = np.concatenate([m for _, m, _ in nodes])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    levels = []
    for depth, nodes in enumerate(grown):
        size = np.array([len(m) for _, m, _ in nodes])
        hi = np.cumsum(size)
        level = {"centre": place[[c for c, _, _ in nodes]], "lo": hi - size, "hi": hi, "rho": np.array([r for _, _, r in nodes])}
        levels.append(level | ({"child": childs[depth]} if depth < LEVELS else {}))
    return order, levels


class Cell:
    """A cell's vectors in tree order, their weights and its tree."""

    def __init__(self, packed: bytes) -> None:
        self.raw, self.weights, self.levels = pickle.loads(packed)
        self.widen(self.raw.shape[1])

    def widen(self, width: int) -> None:
        more = width - self.raw.shape[1]
        self.raw = np.pad(self.raw, ((0, 0), (0, more))) if more else self.raw
        self.units = unit(self.raw)
        self.narrow = self.units.astype(np.float32)
        self.upto = np.r_[0, np.cumsum(self.weights)]

    @staticmethod
    def pack(raw: np.ndarray, weights: np.ndarray, levels: list[dict[str, np.ndarray]]) -> bytes:
        single = raw.astype(np.float32)
        return pickle.dumps((single if (single == raw).all() else raw, weights, levels))


def meet(a: Cell, b: Cell, similarity: float, itself: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts of a, counts of b, links as rows lo, hi, lo, hi of linked ranges) of two trees; counts of ``b`` are
    zero where it is ``a`` itself, whose pairs are all met from both sides."""
    limit = math.acos(similarity)
    slack = (a.raw.shape[1] + 8) * 2.0**-22
    ranges: list[np.ndarray] = []
    lists = [(0, np.zeros(1, np.int64))]
    for depth in range(LEVELS):
        la, lb, na, nb = a.levels[depth], b.levels[depth], a.levels[depth + 1], b.levels[depth + 1]
        following: list[tuple[int, np.ndarray]] = []
        for p, others in lists:
            mine = np.arange(la["child"][p], la["child"][p + 1])
            n = lb["child"][others + 1] - lb["child"][others]
            theirs = np.repeat(lb["child"][others] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            ra, rb = na["rho"][mine], nb["rho"][theirs]
            cosines = a.narrow[na["centre"][mine]] @ b.narrow[nb["centre"][theirs]].T
            widest = np.minimum(math.pi, limit + ra + rb.max() + MARGIN)
            row, col = np.nonzero(cosines >= (np.cos(widest) - slack).astype(np.float32)[:, None])
            x, y = na["centre"][mine[row]], nb["centre"][theirs[col]]
            exact = np.concatenate([
                np.einsum("ij,ij->i", a.units[x[k : k + 65536]], b.units[y[k : k + 65536]]) for k in range(0, len(x), 65536)
            ] or [np.zeros(0)])
            between, radii = np.arccos(np.clip(exact, -1, 1)), ra[row] + rb[col]
            lo_a, hi_a, lo_b, hi_b = na["lo"][mine[row]], na["hi"][mine[row]], nb["lo"][theirs[col]], nb["hi"][theirs[col]]
            single = (hi_a - lo_a == 1) & (hi_b - lo_b == 1)
            for k in np.flatnonzero(single & (np.abs(exact - similarity) < CLOSE)):
                v, w = a.raw[x[k]].astype(np.float64), b.raw[y[k]].astype(np.float64)
                exact[k] = v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w))
            whole = np.where(single, exact >= similarity, between + radii <= limit - MARGIN)
            ranges.append(np.stack([lo_a[whole], hi_a[whole], lo_b[whole], hi_b[whole]], axis=1))
            open_ = ~single & ~whole & (between <= limit + radii + MARGIN)
            row, col = row[open_], col[open_]
            bounds = np.searchsorted(row, np.arange(len(mine) + 1))
            following += [
                (int(mine[k]), theirs[col[bounds[k] : bounds[k + 1]]]) for k in range(len(mine)) if bounds[k] < bounds[k + 1]
            ]
        lists = following
        if not lists:
            break
    links = np.concatenate(ranges) if ranges else np.zeros((0, 4), np.int64)
    if itself:
        links = links[~((links[:, 0] == links[:, 2]) & (links[:, 1] - links[:, 0] == 1))]
    count_a = _spread(len(a.weights), links[:, 0], links[:, 1], b.upto[links[:, 3]] - b.upto[links[:, 2]])
    if not itself:
        return count_a, _spread(len(b.weights), links[:, 2], links[:, 3], a.upto[links[:, 1]] - a.upto[links[:, 0]]), links
    own = links[links[:, 0] == links[:, 2]]  # a node linked with itself links each member with the others only
    for lo, hi in own[:, :2]:
        count_a[lo:hi] -= a.weights[lo:hi]
    return count_a, np.zeros(len(b.weights), np.int64), links


def _spread(n: int, lo: np.ndarray, hi: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sums of ``weight`` over the ranges that cover each of ``n`` places."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, lo, weight)
    np.subtract.at(change, hi, weight)
    return np.cumsum(change[:-1])


def forest(n: int, links: np.ndarray, offset: int) -> np.ndarray:
    """Star edges that connect what the linked ranges connect; places of the second range are moved by ``offset``."""
    lo_a, hi_a, lo_b, hi_b = links.T
    lo_b, hi_b = lo_b + offset, hi_b + offset
    # a range stands for its first member; the others are tied to it
    parts = [np.stack([lo_a, lo_b], axis=1)]
    for lo, hi in ((lo_a, hi_a), (lo_b, hi_b)):
        wide = np.flatnonzero(hi - lo > 1)
        both = np.unique(np.stack([lo[wide], hi[wide]], axis=1), axis=0)
        parts += [np.stack([np.full(h - s - 1, s), np.arange(s + 1, h)], axis=1) for s, h in both.tolist()]
    edges = np.unique(np.concatenate(parts), axis=0)
    label = np.arange(n)
    u, v = edges.T
    while True:
        least = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], least)  # hook the roots, then shorten
        np.minimum.at(label, label[v], least)
        label = label[label]
        if (label == before).all() and (label[u] == label[v]).all():
            break
    other = np.flatnonzero(label != np.arange(n))
    return np.stack([other, label[other]], axis=1)


def classes_of(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: vec_id, k1, k2 with nulls for vectors that cannot link; classes: k1, k2, v, n, first_id)."""
    v = F.col("embedding").cast("array<double>")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = embeddings.select("vec_id", F.when(usable, v).alias("v"))
    rows = rows.select("vec_id", "v", *(F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(s), "v")).alias(k) for s, k in ((1, "k1"), (2, "k2"))))
    groups = rows.where("v IS NOT NULL").groupBy("k1", "k2")
    return rows.drop("v"), groups.agg(F.first("v").alias("v"), F.count("*").alias("n"), F.min("vec_id").alias("first_id"))


def choose_pivots(classes: DataFrame) -> np.ndarray:
    """Unit vectors of the deepest net of a bounded sample that has at most ``PIVOTS`` nodes, in tree order."""
    sample = classes.orderBy("k1", "k2").limit(SAMPLE).select("v").toArrow().column("v")
    if not len(sample):
        return np.zeros((0, 1))
    units = unit(padded([x.values.to_numpy() for x in sample]))
    order, levels = build_tree(units)
    nets = [level["centre"] for level in levels if len(level["centre"]) <= PIVOTS]
    return units[order][nets[-1]]


def assigned(classes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``classes`` with the nearest pivot and the angle to it; map-only."""
    ddl = "k1 bigint, k2 bigint, v array<double>, n bigint, first_id bigint, pivot int, angle double"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = unit(padded([x.values.to_numpy() for x in batch.column("v")], pivots.shape[1])) if batch.num_rows else np.zeros((0, 1))
            cosines = units[:, : pivots.shape[1]] @ pivots.T if batch.num_rows else np.zeros((0, 1))
            best = cosines.argmax(axis=1)
            angle = np.arccos(np.clip(cosines[np.arange(len(best)), best], -1, 1))
            given = {c: batch.column(c) for c in ("k1", "k2", "v", "n", "first_id")}
            yield to_batch(given | {"pivot": best, "angle": angle}, schema)

    return classes.select("k1", "k2", "v", "n", "first_id").mapInArrow(run, ddl)


def deal_cells(sizes: list[int]) -> list[tuple[int, int, int]]:
    """(pivot, first cell, number of cells): small pivots share a cell with their neighbours in tree order."""
    plan, cell, held = [], -1, CELL
    for pivot, size in enumerate(sizes):
        if size > CELL:
            many = -(-size // CELL)
            plan.append((pivot, cell + 1, many))
            cell, held = cell + many, CELL
        elif size:
            if held + size > CELL:
                cell, held = cell + 1, 0
            plan.append((pivot, cell, 1))
            held += size
    return plan


def cell_trees(rows: DataFrame) -> DataFrame:
    """(cell, k1, k2, n, first_id: arrays in tree order, packed: the tree) of the rows of each cell."""
    ddl = "cell bigint, k1 array<bigint>, k2 array<bigint>, n array<bigint>, first_id array<bigint>, packed binary"
    schema = arrow_schema(ddl)

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("k1", "ascending"), ("k2", "ascending")])
        raw = padded([x.values.to_numpy() for x in table.column("v")])
        order, levels = build_tree(unit(raw))
        table = table.take(pa.array(order))
        columns = {c: [table.column(c).to_pylist()] for c in ("k1", "k2", "n", "first_id")}
        packed = Cell.pack(raw[order], np.array(columns["n"][0], np.int64), levels)
        return pa.Table.from_batches([to_batch(columns | {"cell": [table.column("cell")[0].as_py()], "packed": [packed]}, schema)])

    return rows.groupBy("cell").applyInArrow(build, ddl)


def cell_pairs(spark, plan: list[tuple[int, int, int]], pivots: np.ndarray, radii: dict[int, float], similarity: float) -> DataFrame:
    """(a, b), a <= b: cells with a pair of pivots that their covering radii do not rule out."""
    near = np.arccos(np.clip(pivots @ pivots.T, -1, 1))
    rho = np.array([radii.get(k, 0.0) for k in range(len(pivots))])
    used = np.array([p for p, _, _ in plan], np.int64)
    row, col = np.nonzero((near <= math.acos(similarity) + rho[:, None] + rho + 2 * MARGIN)[np.ix_(used, used)])
    met = spark.createDataFrame(pa.table({"p": used[row], "q": used[col]}))
    cells = spark.createDataFrame([(p, c, n) for p, c, n in plan], "p bigint, cell bigint, many bigint")
    cells = cells.select("p", F.explode(F.sequence("cell", F.col("cell") + F.col("many") - 1)).alias("cell"))
    left, right = cells.withColumnRenamed("cell", "a"), cells.select(F.col("p").alias("q"), F.col("cell").alias("b"))
    return met.join(left, "p").join(right, "q").where("a <= b").select("a", "b").distinct()


def traversed(pairs: DataFrame, trees: DataFrame, similarity: float) -> DataFrame:
    """(a, b, n): link counts of class ``a`` (b null), and forest edges between classes ``a`` and ``b`` (n null)."""
    ddl = "a bigint, b bigint, n bigint"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                i, j = batch.column("a")[k].as_py(), batch.column("b")[k].as_py()
                x = Cell(batch.column("packed_a")[k].as_py())
                y = x if i == j else Cell(batch.column("packed_b")[k].as_py())
                width = max(x.raw.shape[1], y.raw.shape[1])
                for z in (x, y):
                    if z.raw.shape[1] < width:
                        z.widen(width)
                count_x, count_y, links = meet(x, y, similarity, i == j)
                if not len(links):
                    continue
                size, offset = len(count_x), 0 if i == j else len(count_x)
                ids = np.r_[i * SPAN + np.arange(size), j * SPAN + np.arange(len(count_y))][: size if i == j else None]
                counts = np.r_[count_x, count_y][: len(ids)]
                edges = ids[forest(len(ids), links, offset)]
                some = np.flatnonzero(counts)
                a = pa.array(np.r_[ids[some], edges.max(axis=1)])
                b = pa.array(np.r_[np.zeros(len(some), np.int64), edges.min(axis=1)], mask=np.arange(len(a)) < len(some))
                n = pa.array(np.r_[counts[some], np.zeros(len(edges), np.int64)], mask=np.arange(len(a)) >= len(some))
                yield to_batch({"a": a, "b": b, "n": n}, schema)

    side = lambda c: trees.select(F.col("cell").alias(c), F.col("packed").alias(f"packed_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, ddl)


def near_vectors(embeddings: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = embeddings.sparkSession
    members, classes = classes_of(embeddings)
    classes = stored(classes, "vectors")
    pivots = choose_pivots(classes)
    if not len(pivots):
        return members.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    placed = stored(assigned(classes, pivots), "placed")
    measured = {r["pivot"]: r for r in placed.groupBy("pivot").agg(F.count("*").alias("n"), F.max("angle").alias("rho")).collect()}
    plan = deal_cells([measured[k]["n"] if k in measured else 0 for k in range(len(pivots))])
    cells = F.broadcast(spark.createDataFrame(plan, "pivot int, base bigint, many bigint"))
    dealt = placed.join(cells, "pivot").withColumn("cell", F.col("base") + F.pmod("k2", "many"))
    trees = stored(cell_trees(dealt.select("cell", "k1", "k2", "v", "n", "first_id")), "trees")
    pairs = cell_pairs(spark, plan, pivots, {k: r["rho"] for k, r in measured.items()}, similarity)
    found = stored(traversed(pairs, trees.select("cell", "packed"), similarity), "links")
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    zipped = F.posexplode(F.arrays_zip("k1", "k2", "n", "first_id")).alias("place", "x")
    named = trees.select("cell", zipped).select((F.col("cell") * SPAN + F.col("place")).alias("id"), "x.*")
    named = named.join(counts, "id", "left").join(roots.withColumnRenamed("k", "id"), "id", "left")
    named = stored(named.withColumn("root", F.coalesce("root", "id")), "named")
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "root").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    joined = members.join(named, ["k1", "k2"], "left")
    component = F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
