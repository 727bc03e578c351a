"""Pairs of embeddings within a cosine threshold, by dual traversal of cover trees.

Equal vectors are one point with a weight. Points go to the nearest of at most PIVOTS pivots (the top of the hierarchy, drawn by hash, a bounded
set), and each pivot's cell is dealt out over shards of about SHARD points, so a cell with most of the points has many shards. Every shard gets a
cover tree: nested levels whose radii halve, a node's centre being a centre on all levels below it, every centre farther than the level's radius
from its siblings, every point with its nearest one. A node keeps its covering radius, the largest distance from its centre to a point of it.

Two trees are walked together from their roots. A pair of nodes is dropped when their centres are farther apart than the threshold and both
covering radii, counted as a whole when they are nearer than the threshold less both radii, and opened else; so the links are exact. What is
written is linear in the points: each point's number of links in the pair of shards, and a spanning forest of the links, never the pairs.

Shards meet in blocks: a block of bounded size is broadcast, and the shards whose cells come near enough to the block's cells are read against it,
each pair of shards once. Where cells are far apart most pairs are never read; where all directions are alike, as among random vectors of high
dimension, no bound of distances can part them and the work is that of all pairs of centres, as matrix products.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.shared import shared_folder, staged

COSINE = 0.95
#: Points of a shard and bytes of its vectors, bytes of a broadcast block, cells.
SHARD = 2048
SHARD_BYTES = 16 << 20
BLOCK_BYTES = 16 << 20
PIVOTS = 1024
#: Distances come from cosines in double precision; bounds are taken so much wider.
SLACK = 1e-7
#: Cosines in single precision are off by less than this.
ROUGH = 1e-4
#: Two nodes with more pairs of children than this meet by a matrix product of their own, others many at once.
WIDE = 4096
#: Products held at once while the children of two nodes meet.
PRODUCTS = 1 << 20
SHARD_SCHEMA = "cell int, salt int, dim int, uids binary, weights binary, points binary, tree binary"


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


class Tree:
    """Cover tree of one shard. Nodes are ranges of the points; a node's children are a range of the nodes."""

    def __init__(self, uids: np.ndarray, weights: np.ndarray, points: np.ndarray, nodes: np.ndarray):
        self.uids, self.weights, self.points, self.rough = uids, weights, points, points.astype(np.float32)
        self.centre, self.start, self.end, self.first, self.last = (nodes[:, k].astype(np.int64) for k in range(5))
        self.radius = nodes[:, 5]
        self.key: tuple = ()

    @classmethod
    def grown(cls, uids: np.ndarray, weights: np.ndarray, points: np.ndarray) -> Tree:
        cosines = points @ points.T
        order = np.arange(len(points))
        from_root = _distance(cosines[0])
        nodes = [[0, 0, len(points), 0, 0, float(from_root.max())]]
        distances = [from_root]  # of each node's points from its centre, in the node's order
        at = 0
        while at < len(nodes):
            centre, start, end, _, _, radius = nodes[at]
            inside, near = order[start:end], distances[at]
            distances[at] = None
            if end - start > 1 and radius > SLACK:
                level = 2.0
                while level >= radius:
                    level /= 2
                centres, owner, near = [centre], np.zeros(end - start, np.int64), near.copy()
                while (far := int(near.argmax())) is not None and near[far] > level:
                    new = _distance(cosines[inside[far], inside])
                    closer = new < near
                    owner[closer], near[closer] = len(centres), new[closer]
                    owner[far], near[far] = len(centres), 0.0
                    centres.append(int(inside[far]))
                by_owner = np.argsort(owner, kind="stable")
                order[start:end], near = inside[by_owner], near[by_owner]
                ends = np.cumsum(np.bincount(owner, minlength=len(centres)))
                nodes[at][3], nodes[at][4] = len(nodes), len(nodes) + len(centres)
                for c, s, e in zip(centres, [0, *ends[:-1].tolist()], ends.tolist()):
                    nodes.append([c, start + s, start + e, 0, 0, float(near[s:e].max())])
                    distances.append(near[s:e])
            at += 1
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        table = np.array(nodes, float)
        table[:, 0] = place[table[:, 0].astype(np.int64)]
        return cls(uids[order], weights[order], points[order], table)

    def table(self) -> np.ndarray:
        return np.column_stack([self.centre, self.start, self.end, self.first, self.last, self.radius])

    def below(self, entries: np.ndarray) -> np.ndarray:
        """How many entries each entry opens to; an entry is a node's number, or -1 - p for the point p, which opens to itself."""
        nodes = np.maximum(entries, 0)
        children = self.last[nodes] - self.first[nodes]
        return np.where(entries < 0, 1, np.where(children > 0, children, self.end[nodes] - self.start[nodes]))

    def opened(self, entries: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry, centre, radius) of the k-th entry below each entry."""
        nodes = np.maximum(entries, 0)
        leaf = self.last[nodes] == self.first[nodes]
        child = np.where(leaf, 0, self.first[nodes] + k)
        alone = self.end[child] - self.start[child] == 1
        point = (entries < 0) | leaf | alone
        place = np.where(entries < 0, -1 - entries, np.where(leaf, self.start[nodes] + k, self.start[child]))
        return np.where(point, -1 - place, child), np.where(point, place, self.centre[child]), np.where(point, 0.0, self.radius[child])

    def span(self, entry: int) -> slice:
        return slice(-1 - entry, -entry) if entry < 0 else slice(self.start[entry], self.end[entry])


def forest(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the graph of links (u, v) on n vertices."""
    label = np.arange(n)
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return np.flatnonzero(label != np.arange(n)), label[label != np.arange(n)]
        u, v = u[apart], v[apart]
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (label != label[label]).any():
            label = label[label]


def links(a: Tree, b: Tree, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(weight linked to each point of a, the same for b, edges of a spanning forest as two arrays of uids); b may be a itself."""
    limit, same = math.sqrt(2 - 2 * cosine), a is b
    counts_a, counts_b = np.zeros(len(a.uids), np.int64), np.zeros(len(b.uids), np.int64)
    us, vs, offset = [], [], 0 if same else len(a.uids)
    vertices = len(b.uids) + offset

    def met(i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(counts_a, i, b.weights[j])
        np.add.at(counts_b, j, a.weights[i])
        u, v = forest(i, j + offset, vertices)
        us.append(u)
        vs.append(v)

    def whole(x: slice, y: slice) -> None:
        """All points of x with all of y; x and y are the same range, or have no point in common."""
        if same and x == y:
            counts_a[x] += a.weights[x].sum() - a.weights[x]
        else:
            counts_a[x] += b.weights[y].sum()
            counts_b[y] += a.weights[x].sum()
        left, right = np.arange(x.start, x.stop), np.arange(y.start, y.stop) + offset
        us.extend([left, np.full(len(right), left[0])])
        vs.extend([np.full(len(left), right[0]), right])

    if not same and float(a.points[a.centre[0]] @ b.points[b.centre[0]]) < _cosine_at(limit + a.radius[0] + b.radius[0] + SLACK):
        return counts_a, counts_b, np.zeros(0, np.int64), np.zeros(0, np.int64)
    frontier = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]

    def judge(x: np.ndarray, y: np.ndarray, radii: np.ndarray, other_radii: np.ndarray, found: np.ndarray) -> None:
        """Take pairs of entries for linked, for not linked, or to be opened."""
        reach = radii + other_radii
        near = found >= np.where(reach == 0, cosine, _cosine_at(reach + (limit + SLACK)))
        x, y, reach, found = x[near], y[near], reach[near], found[near]
        twin = (x == y) & same
        single = (x < 0) & (y < 0)
        linked = single & ~twin
        if linked.any():
            met(-1 - x[linked], -1 - y[linked])
        inside = ~single & (np.where(twin, reach, _distance(found) + reach) + SLACK <= limit)
        for p, q in zip(x[inside].tolist(), y[inside].tolist()):
            whole(a.span(p), b.span(q))
        further = ~single & ~inside
        if further.any():
            frontier.append((x[further], y[further]))

    while frontier:
        x, y = frontier.pop()
        n, m = a.below(x), b.below(y)
        wide = n * m > WIDE
        for p, q, n_p, n_q in zip(x[wide], y[wide], n[wide].tolist(), m[wide].tolist()):
            entries, centres, radii = a.opened(np.full(n_p, p), np.arange(n_p))
            others, other_centres, other_radii = b.opened(np.full(n_q, q), np.arange(n_q))
            step = max(1, PRODUCTS // n_q)
            # one bound for each row in single precision leaves few pairs of most trees; those are judged in double precision
            rough = (_cosine_at(radii + (limit + SLACK + other_radii.max())) - ROUGH).astype(np.float32)
            columns, columns32 = b.points[other_centres], b.rough[other_centres].T
            for k in range(0, n_p, step):
                place = np.flatnonzero((a.rough[centres[k : k + step]] @ columns32) >= rough[k : k + step, None])
                i, j = np.divmod(place, n_q)
                if len(place) > step * n_q // 16:
                    found = (a.points[centres[k : k + step]] @ columns.T).ravel()[place]
                else:
                    found = np.einsum("ij,ij->i", a.points[centres[i + k]], columns[j])
                i += k
                half = i <= j if same and p == q else np.full(len(i), True)
                i, j, found = i[half], j[half], found[half]
                judge(entries[i], others[j], radii[i], other_radii[j], found)
        x, y, n, m = x[~wide], y[~wide], n[~wide], m[~wide]
        ends = np.cumsum(n * m)
        for part in np.split(np.arange(len(x)), np.searchsorted(ends, np.arange(PRODUCTS // 16, int(ends[-1]) if len(ends) else 0, PRODUCTS // 16))):
            if len(part):
                pair = np.repeat(part, (n * m)[part])
                i, j = np.divmod(np.arange(len(pair)) - (ends - n * m - (ends - n * m)[part[0]])[pair], m[pair])
                half = ~(same & (x == y))[pair] | (i <= j)
                pair, i, j = pair[half], i[half], j[half]
                entries, centres, radii = a.opened(x[pair], i)
                others, other_centres, other_radii = b.opened(y[pair], j)
                judge(entries, others, radii, other_radii, np.einsum("ij,ij->i", a.points[centres], b.points[other_centres]))
    if same:
        counts_a, counts_b = counts_a + counts_b, counts_b * 0
    if not us:
        return counts_a, counts_b, np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v = forest(np.concatenate(us), np.concatenate(vs), vertices)
    names = a.uids if same else np.concatenate([a.uids, b.uids])
    return counts_a, counts_b, names[u], names[v]


def _cosine_at(distance: np.ndarray) -> np.ndarray:
    """Cosine of unit vectors at a distance; below every cosine where no two are so far apart."""
    return np.where(np.asarray(distance) >= 2, -2.0, 1 - np.square(distance) / 2)


def _unit(batches: Iterator[pa.RecordBatch], pivots: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Unit vectors with the nearest pivot of their width; cells of widths without pivots are negative."""
    for batch in batches:
        values = batch.column("embedding")
        flat, ends = values.flatten().to_numpy(zero_copy_only=False), np.asarray(values.offsets)
        width = np.diff(ends)
        cells, far, units = np.zeros(len(width), np.int32), np.zeros(len(width)), [b""] * len(width)
        for d in np.unique(width):
            rows = np.flatnonzero(width == d)
            x = flat[(ends[rows] - ends[0])[:, None] + np.arange(d)].astype(float)
            x /= np.abs(x).max(axis=1, keepdims=True)
            x /= np.sqrt(np.square(x).sum(axis=1, keepdims=True))
            if d in pivots:
                names, heads = pivots[d]
                products = x @ heads.T
                nearest = products.argmax(axis=1)
                cells[rows], far[rows] = names[nearest], _distance(products[np.arange(len(rows)), nearest])
            else:
                cells[rows], far[rows] = -d, 2.0
            for r, v in zip(rows.tolist(), x):
                units[r] = v.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("uid"), batch.column("weight"), pa.array(cells, pa.int32()), pa.array(width, pa.int32()), pa.array(far), pa.array(units, pa.binary())],
            ["uid", "weight", "cell", "dim", "far", "unit"])


def _grow(group: pa.Table) -> pa.Table:
    """The cover tree of one shard as a row."""
    dim = group["dim"][0].as_py()
    points = np.frombuffer(b"".join(group["unit"].to_pylist())).reshape(-1, dim)
    tree = Tree.grown(group["uid"].to_numpy(), group["weight"].to_numpy(), points)
    row = [group["cell"][0].as_py(), group["salt"][0].as_py(), dim, tree.uids.tobytes(), tree.weights.tobytes(), tree.points.tobytes(), tree.table().tobytes()]
    types = [pa.int32()] * 3 + [pa.binary()] * 4
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, types)], ["cell", "salt", "dim", "uids", "weights", "points", "tree"])


def _read(row: dict) -> Tree:
    tree = Tree(np.frombuffer(row["uids"], np.int64), np.frombuffer(row["weights"], np.int64), np.frombuffer(row["points"]).reshape(-1, row["dim"]), np.frombuffer(row["tree"]).reshape(-1, 6))
    tree.key = (row["cell"], row["salt"], row["dim"])
    return tree


def _meet(batches: Iterator[pa.RecordBatch], block, cosine: float) -> Iterator[pa.RecordBatch]:
    """Links between the shards read and those of the block at the same place in the order of shards or after them."""
    others = [_read(row) for row in block.value]
    for batch in batches:
        for row in batch.to_pylist():
            tree = _read(row)
            total, a, b, n = np.zeros(len(tree.uids), np.int64), [], [], []
            for other in others:
                if other.key < tree.key or other.key[2] != tree.key[2]:
                    continue
                own, theirs, u, v = links(tree, tree if other.key == tree.key else other, cosine)
                total += own
                linked = np.flatnonzero(theirs)
                a.extend([other.uids[linked], u])
                b.extend([np.full(len(linked), -1), v])
                n.extend([theirs[linked], np.zeros(len(u), np.int64)])
            linked = np.flatnonzero(total)
            a, b, n = [tree.uids[linked], *a], [np.full(len(linked), -1), *b], [total[linked], *n]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (a, b, n)], ["a", "b", "n"])


def _shards(points: DataFrame, count: int, width: int) -> tuple[DataFrame, dict[int, tuple], int]:
    """(shards with their trees, {cell: (pivot or None, radius, salts)}, shards of a block)."""
    size = max(1, min(SHARD, SHARD_BYTES // (8 * width)))
    rows = points.orderBy(F.xxhash64("embedding"), "uid").limit(min(PIVOTS, math.ceil(count / size))).select("embedding").collect()
    heads: dict[int, list] = {}
    for number, row in enumerate(rows):
        heads.setdefault(len(row[0]), []).append((number, row[0]))
    pivots = {}
    for d, found in heads.items():
        x = np.array([v for _, v in found], float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        pivots[d] = np.array([k for k, _ in found], np.int32), x / np.sqrt(np.square(x).sum(axis=1, keepdims=True))
    placed = staged(points.select("uid", "weight", "embedding").mapInArrow(lambda b: _unit(b, pivots), "uid long, weight long, cell int, dim int, far double, unit binary"), "cover-points")
    counts = staged(placed.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias("salts"), F.max("far").alias("far")), "cover-cells")
    salted = placed.join(counts.select("cell", "salts"), "cell").withColumn("salt", F.pmod(F.xxhash64("uid"), "salts").cast("int"))
    tasks = max(1, min(2 * math.ceil(count / size), 8 * points.sparkSession.sparkContext.defaultParallelism))
    grown = salted.drop("salts", "far").repartition(tasks, "cell", "salt").groupBy("cell", "salt").applyInArrow(_grow, SHARD_SCHEMA)
    shards = staged(grown, "cover-shards")
    heads_of = {int(k): h for names, x in pivots.values() for k, h in zip(names, x)}
    cells = {r["cell"]: (heads_of.get(r["cell"]), r["far"], r["salts"]) for r in counts.collect()}  # PIVOTS rows, and one for each width without pivot
    return shards, cells, max(1, BLOCK_BYTES // (8 * width * size))


def _near(cells: dict[int, tuple], chosen: set[int], limit: float) -> list[int]:
    """Cells up to the last of `chosen` that come within the limit of one of them."""

    def meet(a: int, b: int) -> bool:
        (x, r, _), (y, s, _) = cells[a], cells[b]
        if a == b or x is None or y is None or len(x) != len(y):
            return a == b
        return math.sqrt(max(0.0, 2 - 2 * float(x @ y))) <= limit + r + s + SLACK

    return [a for a in cells if a <= max(chosen) and any(meet(a, b) for b in chosen)]


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row for each row of `vectors` (vec_id, embedding): (vec_id, n_links, component_id), whatever other columns there are.

    Two vectors of the same width are linked if their cosine in double precision is at least `cosine`, which must be over 0. n_links counts the
    other rows linked directly, rows with an equal vector included; component_id is the smallest vec_id that links lead to, its own included.
    A vector that is NULL, empty, zero, or holds a NULL or non-finite component links with nothing and names its own component. Rows with the same
    vec_id are vectors of their own; a NULL vec_id never names a component unless it is alone. No rows give no rows.
    """
    usable = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", "embedding", usable.alias("usable"))
    points = rows.where("usable").groupBy("embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    points = staged(points.withColumn("uid", F.monotonically_increasing_id()), "cover-distinct")
    count, width = points.agg(F.count("*"), F.max(F.size("embedding"))).first()
    found = staged(points.sparkSession.createDataFrame([], "a long, b long, n long"), "cover-none")
    if count:
        shards, cells, per_block = _shards(points, count, width)
        order = [(c, s) for c in sorted(cells) for s in range(cells[c][2])]
        path = f"{shared_folder(points.sparkSession)}/cover-links-{uuid.uuid4().hex}"
        for k in range(0, len(order), per_block):
            chosen = order[k : k + per_block]
            wanted = F.lit(False)
            for c in sorted({c for c, _ in chosen}):
                salts = [s for x, s in chosen if x == c]
                wanted = wanted | ((F.col("cell") == c) & F.col("salt").between(min(salts), max(salts)))
            block = points.sparkSession.sparkContext.broadcast([r.asDict() for r in shards.where(wanted).collect()])  # BLOCK_BYTES at most
            reading = shards.where(F.col("cell").isin(_near(cells, {c for c, _ in chosen}, math.sqrt(2 - 2 * cosine))))
            reading.mapInArrow(lambda batches, block=block: _meet(batches, block, cosine), "a long, b long, n long").write.mode("append").parquet(path)
            block.unpersist()
        found = points.sparkSession.read.schema(found.schema).parquet(path)

    linked = found.where("b = -1").groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("linked"))
    roots = components(found.where("b <> -1").select("a", "b")).select(F.col("node").alias("uid"), "root")
    judged = points.join(linked, "uid", "left").join(roots, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    judged = staged(judged.select("embedding", "least", "root", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "cover-judged")
    names = judged.groupBy("root").agg(F.min("least").alias("component_id"))
    judged = judged.join(names, "root").select(F.col("embedding").alias("vector"), "n_links", "component_id")
    known = rows.where("usable").join(judged, F.col("embedding") == F.col("vector")).select("vec_id", "n_links", "component_id")
    return known.unionByName(rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
