"""Boosted trees over histograms that Spark sums: leaf-wise, with any objective.

Rows are binned once; those of equal bins, target and weight become one with their
number, and what is left is kept as blocks of bytes in a table of the shared
folder. A pass over the blocks gives gradient, hessian and row counts by node,
column and bin; partial sums leave each task once, Spark adds them by node, and
splits are chosen on the driver from sums whose size hangs on columns and leaves
only. All models (folds) grow side by side, so the number of passes does not
hang on their number. Scores of rows are rewritten every EVERY rounds; between,
tasks add the few trees since, so a lost executor costs a read of the table."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.sources.shared import removed, stored

#: Bins of values; the last of the 256 holds nulls and NaN.
BINS, MISSING = 255, 255
BLOCK, EVERY = 1 << 15, 2
#: Bytes of different rows that a task which builds blocks holds, about.
HELD_BYTES = 1 << 25
#: Bytes of sums that a task holds at most, unless one node alone needs more.
PASS_BYTES = 1 << 27
#: Cells of a tree that are worked out ahead at most (see Grid).
CELLS = 1 << 12
#: Sums of all tasks together that the driver adds up itself, without a shuffle.
ADDED_BYTES = 1 << 25

DEFAULTS = {"rounds": 500, "rate": 0.05, "leaves": 31, "patience": 50, "min_rows": 20, "min_hessian": 1e-3, "l2": 0.0, "max_step": 0.7}


# ---- objectives: scores are rows x classes


@dataclass
class Objective:
    """First and second derivatives of a loss by the score, its mean, the
    constant start and the map from scores to predictions."""

    name: str
    classes: int = 1
    max_step: float = 0.7

    def start(self, shares: np.ndarray) -> np.ndarray:
        """Score from the weighted mean target (of each class)."""
        m = np.asarray(shares, float)
        if self.name == "binary":
            m = np.clip(m, 1e-15, 1 - 1e-15)
            return np.log(m / (1 - m))
        if self.name == "softmax":
            return np.log(np.clip(m, 1e-15, None))
        return np.log(np.clip(m, 1e-15, None)) if self.name == "poisson" else m

    def predict(self, score: np.ndarray) -> np.ndarray:
        if self.name == "binary":
            return 1 / (1 + np.exp(-score))
        if self.name == "softmax":
            e = np.exp(score - score.max(1, keepdims=True))
            return e / e.sum(1, keepdims=True)
        return np.exp(score) if self.name == "poisson" else score

    def derivatives(self, score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.predict(score)
        if self.name == "softmax":
            hot = np.zeros_like(p)
            hot[np.arange(len(y)), y.astype("int64")] = 1
            return p - hot, np.maximum(p * (1 - p) * self.classes / (self.classes - 1), 1e-16)
        g = p - y[:, None]
        if self.name == "binary":
            return g, np.maximum(p * (1 - p), 1e-16)
        # the second derivative at a step further keeps leaves of counts small
        return g, np.exp(score + self.max_step) if self.name == "poisson" else np.ones_like(g)

    def losses(self, score: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Loss of each row: the early stop compares their means."""
        p = self.predict(score)
        if self.name == "softmax":
            return -np.log(np.clip(p[np.arange(len(y)), y.astype("int64")], 1e-15, None))
        if self.name == "binary":
            q = np.clip(p[:, 0], 1e-15, 1 - 1e-15)
            return -(y * np.log(q) + (1 - y) * np.log(1 - q))
        return (p[:, 0] - y) ** 2


# ---- trees


@dataclass
class Tree:
    """Nodes as arrays; feature -1: a leaf. A value at most `cut` goes left, and
    nulls do if missing_left; `bin` is the cut among the bins."""

    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    missing_left: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    count: list = field(default_factory=list)

    def add(self, value: float, count: float) -> int:
        for name, x in (("feature", -1), ("bin", 0), ("cut", 0.0), ("missing_left", False), ("left", -1), ("right", -1), ("value", value), ("count", count)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def packed(self) -> "Tree":
        kinds = {"feature": "int64", "bin": "int64", "cut": "float64", "missing_left": "bool", "left": "int64", "right": "int64", "value": "float64", "count": "float64"}
        return Tree(**{k: np.array(getattr(self, k), t) for k, t in kinds.items()})

    def grids(self, keys: np.ndarray, name: str) -> dict[int, "Grid"]:
        """node -> cells of the highest parts of a packed tree that have few enough,
        worked out once; keys: each node's cut, by `name`."""
        if name not in (known := self.__dict__.setdefault("_grids", {})):
            known[name], todo = {}, [0]
            while todo:
                node = todo.pop()
                if self.feature[node] >= 0:
                    grid = Grid.of(self, node, keys)
                    if grid is None:
                        todo += [int(self.left[node]), int(self.right[node])]
                    else:
                        known[name][node] = grid
        return known[name]

    def _walk(self, n: int, goes_left, grids: dict, codes) -> np.ndarray:
        """Leaf of each of n rows. goes_left: (node, rows) -> whether each of them goes
        left; codes: (grid, its column, rows) -> their places among its cuts. Rows go
        down node by node only where the rest of the tree has too many cells."""
        at, todo = np.zeros(n, "int64"), [(0, slice(None))]
        while todo:
            node, rows = todo.pop()
            if node in grids:
                grid = grids[node]
                cell = sum(codes(grid, i, rows) for i in range(len(grid.columns)))
                at[rows] = grid.leaf[cell]
            elif self.feature[node] < 0:
                at[rows] = node
            else:
                left = goes_left(node, rows)
                own = np.arange(n) if isinstance(rows, slice) else rows
                todo += [(int(k), r) for k, r in ((self.left[node], own[left]), (self.right[node], own[~left])) if len(r)]
        return at

    def leaf_of_bins(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of each row of a packed tree, by its bins (a column each, so that a
        column's lie side by side)."""
        every = np.arange(256)

        def goes_left(node, rows):
            low = every <= self.bin[node]
            low[MISSING] = self.missing_left[node]
            return low[bins[self.feature[node]][rows]]

        return self._walk(bins.shape[1], goes_left, self.grids(self.bin, "bin"), lambda grid, i, rows: grid.of_bins[i][bins[grid.columns[i]][rows]])

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row of a packed tree, by its values."""

        def goes_left(node, rows):
            v = x[rows, self.feature[node]]
            return np.where(np.isnan(v), self.missing_left[node], v <= self.cut[node])

        return self._walk(len(x), goes_left, self.grids(self.cut, "cut"), lambda grid, i, rows: grid.code(i, x[rows, grid.columns[i]]))


@dataclass
class Grid:
    """A tree (or the part below a node) as cells: rows whose values lie between the
    same of its cuts in every column fall into one leaf, so a row needs one look
    into a table by its cell."""

    columns: list[int]
    cuts: list[np.ndarray]
    #: what a place among a column's cuts adds to the number of the cell
    strides: list[int]
    leaf: np.ndarray
    #: places (times stride) of the 256 bins of each column, if cuts are bins
    of_bins: list[np.ndarray]

    @staticmethod
    def of(tree: "Tree", node: int, keys: np.ndarray) -> "Grid | None":
        """None if there are more than CELLS."""
        inner, todo = [], [node]
        while todo:
            at = todo.pop()
            if tree.feature[at] >= 0:
                inner.append(at)
                todo += [int(tree.left[at]), int(tree.right[at])]
        columns = sorted({int(tree.feature[v]) for v in inner})
        cuts = [np.unique([keys[v] for v in inner if tree.feature[v] == c]) for c in columns]
        strides, cells = [], 1
        for c in cuts:
            strides.append(cells)
            cells *= len(c) + 2  # behind the last cut, and nulls
            if cells > CELLS:
                return None
        place = {c: np.arange(cells) // stride % (len(own) + 2) for c, stride, own in zip(columns, strides, cuts)}
        leaf, todo = np.zeros(cells, "int64"), [(node, np.arange(cells))]
        while todo:
            at, rows = todo.pop()
            if tree.feature[at] < 0:
                leaf[rows] = at
                continue
            own = cuts[columns.index(int(tree.feature[at]))]
            code = place[int(tree.feature[at])][rows]
            left = np.where(code == len(own) + 1, tree.missing_left[at], code <= np.searchsorted(own, keys[at]))
            todo += [(int(tree.left[at]), rows[left]), (int(tree.right[at]), rows[~left])]
        of_bins = []
        for own, stride in zip(cuts, strides):
            code = np.searchsorted(own, np.arange(256), "left")
            code[MISSING] = len(own) + 1
            of_bins.append((code * stride).astype("int32"))
        return Grid(columns, cuts, strides, leaf, of_bins)

    def code(self, i: int, values: np.ndarray) -> np.ndarray:
        own = self.cuts[i]
        return np.where(np.isnan(values), len(own) + 1, np.searchsorted(own, values, "left")) * self.strides[i]


def best_split(hist: np.ndarray, edges: list[np.ndarray], p: dict):
    """(gain, column, bin, missing_left) of the best split of a node, None if none
    is allowed or gains. hist: 3 x columns x 256 (gradient, hessian, rows). Ties
    go to the first column, then the lowest cut, then nulls to the right."""
    g, h, n = (hist[k] for k in range(3))
    all_g, all_h, all_n = g[0].sum(), h[0].sum(), n[0].sum()
    below = [np.cumsum(x[:, : BINS - 1], axis=1) for x in (g, h, n)]
    known = np.array([len(e) for e in edges])
    in_range = np.arange(BINS - 1)[None, :] < known[:, None]
    score = lambda a, b: a * a / (b + p["l2"] + 1e-300)
    base, best = score(all_g, all_h), None
    for missing_left in (False, True):
        lg, lh, ln = (x + missing_left * hist[k][:, MISSING : MISSING + 1] for k, x in enumerate(below))
        rg, rh, rn = all_g - lg, all_h - lh, all_n - ln
        allowed = in_range & (ln >= p["min_rows"]) & (rn >= p["min_rows"]) & (lh >= p["min_hessian"]) & (rh >= p["min_hessian"])
        gain = np.where(allowed, score(lg, lh) + score(rg, rh) - base, -np.inf)
        at = int(gain.argmax())
        c, b = divmod(at, BINS - 1)
        found = (float(gain[c, b]), c, b, missing_left)
        if found[0] > 1e-12 and (best is None or found[0] > best[0] + 1e-12):
            best = found
    return best


@dataclass(eq=False)
class Node:
    """A place of a tree that grows: its sums, its best split, its children if they
    are known, and its number once it is part of the tree."""

    hist: np.ndarray | None
    split: tuple | None
    kids: list | None = None
    at: int = -1


class Grower:
    """One tree, grown best leaf first. Children are asked for of all nodes that the
    tree could still come to, by what is known, also below leaves not yet split;
    leaves are then taken by gain as long as their children are known. That gives
    the same tree as a pass for every split, in about a pass a level."""

    def __init__(self, edges: list[np.ndarray], p: dict):
        self.edges, self.p, self.tree = edges, p, Tree()
        self.root: Node | None = None
        self.open: list[Node] = []

    def _value(self, hist) -> float:
        v = -hist[0][0].sum() / (hist[1][0].sum() + self.p["l2"] + 1e-300)
        step = self.p.get("step")
        return self.p["rate"] * (float(np.clip(v, -step, step)) if step else float(v))

    def _node(self, hist) -> Node:
        return Node(hist, best_split(hist, self.edges, self.p))

    def wanted(self, most: int) -> list[tuple]:
        """(node, whether the left child is counted): the smaller child is. Nodes are
        taken by gain as if those without known children had none; what is not met
        within the leaves that are left cannot become part of the tree."""
        if self.root is None:
            return [(None, True)]
        order = count()
        heap = [(-n.split[0], n.at, next(order), n) for n in self.open if n.split]
        heapify(heap)
        out: list[tuple] = []
        for _ in range(self.p["leaves"] - len(self.open)):
            if not heap or len(out) >= max(most, 1):
                break
            node = heappop(heap)[-1]
            if node.kids is None:
                _, c, b, ml = node.split
                n = node.hist[2][c]
                left = n[: b + 1].sum() + ml * n[MISSING]
                out.append((node, bool(2 * left <= n.sum())))
            else:
                for k in node.kids:
                    if k.split:
                        heappush(heap, (-k.split[0], 1 << 40, next(order), k))
        return out

    def tell(self, asked: list[tuple], hists: list[np.ndarray]) -> None:
        t = self.tree
        for (node, is_left), hist in zip(asked, hists):
            if node is None:
                self.root = self._node(hist)
                self.root.at = t.add(self._value(hist), hist[2][0].sum())
                self.open.append(self.root)
            else:
                other = node.hist - hist
                node.kids = [self._node(x) for x in ([hist, other] if is_left else [other, hist])]
        while len(self.open) < self.p["leaves"]:
            node = min((n for n in self.open if n.split), key=lambda n: (-n.split[0], n.at), default=None)
            if node is None or node.kids is None:
                break
            self.open.remove(node)
            for k in node.kids:
                k.at = t.add(self._value(k.hist), k.hist[2][0].sum())
                self.open.append(k)
            _, c, b, ml = node.split
            t.feature[node.at], t.bin[node.at], t.cut[node.at], t.missing_left[node.at] = c, b, float(self.edges[c][b]), ml
            t.left[node.at], t.right[node.at] = (k.at for k in node.kids)
            node.hist = None

    def tentative(self, asked: list[tuple]) -> tuple[Tree, dict[int, int]]:
        """A tree with the asked splits done and no others than lead there, and node ->
        place of those counted."""
        t, slots = Tree(), {}
        if self.root is None:
            t.add(0.0, 0.0)
            return t.packed(), {0: 0}
        places = {id(node): (k, is_left) for k, (node, is_left) in enumerate(asked)}
        leads: set[int] = set()

        def mark(node) -> bool:
            found = [mark(k) for k in node.kids or ()]
            if any(found) or id(node) in places:
                leads.add(id(node))
            return id(node) in leads

        def put(node) -> int:
            at = t.add(0.0, 0.0)
            if node is not None and id(node) in leads:
                _, t.feature[at], t.bin[at], t.missing_left[at] = node.split
                t.left[at], t.right[at] = [put(k) for k in node.kids or (None, None)]
                if id(node) in places:
                    k, is_left = places[id(node)]
                    slots[t.left[at] if is_left else t.right[at]] = k
            return at

        mark(self.root)
        put(self.root)
        return t.packed(), slots


# ---- blocks


def bin_edges(rows: DataFrame, columns: list[str]) -> dict[int, list[np.ndarray]]:
    """model -> cuts of each column: approximate quantiles of its training rows,
    all columns of all models in one pass for each 100 columns."""
    probs = [k / BINS for k in range(1, BINS)]
    out: dict[int, list[np.ndarray]] = {}
    for at in range(0, len(columns), 100):
        own = columns[at : at + 100]
        clean = [F.percentile_approx(F.when(~F.isnan(c), F.col(c)), probs, 20 * BINS).alias(c) for c in own]
        for r in rows.filter("NOT valid").groupBy("model").agg(*clean).collect():
            out.setdefault(r["model"], []).extend(np.unique(np.array(r[c] or [], "float64")) for c in own)
    return out


def _short(x: np.ndarray) -> bytes:
    """Doubles in the fewest bytes that keep them, and how in the last byte: one for
    all, a byte each, or whole. Reading the blocks is most of a pass."""
    if (x == x[0]).all() and not (x[0] == 0 and np.signbit(x).any()):
        return x[:1].tobytes() + b"\0"
    small = x.astype("uint8") if ((x >= 0) & (x < 256)).all() else None
    if small is not None and (small == x).all() and not np.signbit(x).any():
        return small.tobytes() + b"\1"
    return x.tobytes() + b"\2"


def _whole(x: bytes, n: int) -> np.ndarray:
    if x[-1] == 0:
        return np.full(n, np.frombuffer(x, "float64", 1)[0])
    return np.frombuffer(x, "uint8", n).astype("float64") if x[-1] == 1 else np.frombuffer(x, "float64", n)


@contextmanager
def few_blocks_a_batch(spark: SparkSession):
    """Batches of a few blocks while a pass runs: the task learns from one while the
    next is read, and holds no more than a few. By default a batch has 10,000 rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "4")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def combined(bins: np.ndarray, y: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple:
    """(hash, bins, y, weight, rows) of the different rows among those given: rows of
    equal bins, y and weight have one score for ever, so one of them stands for
    all with how many they are. In order of a hash of what must be equal; rows of
    one hash that differ stay apart."""
    key = np.zeros(len(y), "uint64")
    for c, own in enumerate(bins):
        key ^= np.random.default_rng(c + 2).integers(0, 1 << 63, 256, "uint64")[own]
    y, w = np.ascontiguousarray(y), np.ascontiguousarray(w)
    for x, odd in ((y, 0x9E3779B97F4A7C15), (w, 0xC2B2AE3D27D4EB4F)):
        mixed = x.view("uint64") * np.uint64(odd)
        key ^= (mixed ^ (mixed >> np.uint64(29))) * np.uint64(odd)
    at = np.argsort(key, kind="stable")
    key, bins, y, w = key[at], bins[:, at], y[at], w[at]
    new = np.ones(len(y), "bool")
    new[1:] = (key[1:] != key[:-1]) | (y.view("uint64")[1:] != y.view("uint64")[:-1]) | (w.view("uint64")[1:] != w.view("uint64")[:-1])
    for own in bins:
        new[1:] |= own[1:] != own[:-1]
    first = np.flatnonzero(new)
    return key[first], bins[:, first], y[first], w[first], np.add.reduceat(n[at], first) if len(first) else n


def block_table(rows: DataFrame, columns: list[str], edges: dict, start: dict) -> DataFrame:
    """model, valid and the blocks' bytes: bins by column, y, weight, the rows that a
    place stands for, and score. A block's rows are all to learn from or all to
    validate. Rows are binned and combined in the tasks that read them, dealt by
    the hash of what is equal and combined again, so a pass costs as much as there
    are different rows."""
    spark, width = rows.sparkSession, len(columns)
    shared = spark.sparkContext.broadcast((edges, start))
    most = max(BLOCK, HELD_BYTES // (width + 32))

    def gathered(held: dict, full: int):
        """What is held, combined; emptied beyond `full` different rows."""
        for own, parts in held.items():
            if len(parts) > 1:
                held[own] = [combined(*(np.concatenate(x, axis=-1) for x in zip(*parts)))[1:]]
        if sum(len(p[0][1]) for p in held.values()) > full:
            for own in sorted(held):
                yield own, held.pop(own)[0]

    def over(parts, full: int):
        """(model, valid), different rows: of all parts, a bounded number at once."""
        held: dict[tuple, list] = {}
        fresh, kept = 0, 0
        for own, part in parts:
            held.setdefault(own, []).append(part)
            fresh += len(part[1])
            if fresh > max(kept, full // 4):
                yield from gathered(held, full)
                fresh, kept = 0, sum(len(p[0][1]) for p in held.values())
        yield from gathered(held, -1)

    def binned(batches):
        cuts, _ = shared.value
        for b in batches:
            x = [b[c].to_numpy(zero_copy_only=False).astype("float64") for c in columns]
            model, y, w = (b[c].to_numpy(zero_copy_only=False) for c in ("model", "y", "weight"))
            v = b["valid"].to_numpy(zero_copy_only=False).astype("bool")
            for m, valid in [(m, valid) for m in np.unique(model).tolist() for valid in (False, True)]:
                at = np.flatnonzero((model == m) & (v == valid))
                if not len(at):
                    continue
                bins = np.empty((width, len(at)), "uint8")
                for c, e in enumerate(cuts[m]):
                    own = x[c][at]
                    bins[c] = np.where(np.isnan(own), MISSING, np.searchsorted(e, own, "left"))
                yield (m, valid), (bins, y[at].astype("float64"), w[at].astype("float64"), np.ones(len(at), "int64"))

    def deal(batches):
        for (m, valid), (bins, y, w, n) in over(binned(batches), most):
            key, bins, y, w, n = combined(bins, y, w, n)
            for at in range(0, len(y), BLOCK):
                own = slice(at, at + BLOCK)
                size = len(y[own])
                flat = pa.py_buffer(np.ascontiguousarray(bins[:, own].T).tobytes())
                packed = pa.BinaryArray.from_buffers(pa.binary(), size, [None, pa.py_buffer((np.arange(size + 1) * width).astype("int32").tobytes()), flat])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, m, "int32")), pa.array(np.full(size, valid)), pa.array(key[own].view("int64")), packed, pa.array(y[own]), pa.array(w[own]), pa.array(n[own])], ["model", "valid", "key", "bins", "y", "weight", "n"])

    def dealt(batches):
        for b in batches:
            model, y, w, n = (b[c].to_numpy(zero_copy_only=False) for c in ("model", "y", "weight", "n"))
            v = b["valid"].to_numpy(zero_copy_only=False).astype("bool")
            bins = np.frombuffer(b"".join(b["bins"].to_pylist()), "uint8").reshape(b.num_rows, width)
            for m, valid in [(m, valid) for m in np.unique(model).tolist() for valid in (False, True)]:
                at = np.flatnonzero((model == m) & (v == valid))
                if len(at):
                    yield (m, valid), (bins[at].T, y[at], w[at], n[at])

    def blocks(batches):
        _, first = shared.value
        for (m, valid), (bins, y, w, n) in over(dealt(batches), most):
            _, bins, y, w, n = combined(bins, y, w, n)
            for at in range(0, len(y), BLOCK):
                own = slice(at, at + BLOCK)
                score = np.tile(first[m], (len(y[own]), 1))
                parts = np.ascontiguousarray(bins[:, own]).tobytes(), _short(y[own]), _short(w[own]), _short(n[own].astype("float64")), score.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([valid]), *[pa.array([x], pa.binary()) for x in parts]], ["model", "valid", "bins", "y", "weight", "n", "score"])

    plain = rows.filter(F.col("model").isin(list(edges))).select(F.col("model").cast("int").alias("model"), "valid", F.col("y").cast("double").alias("y"), F.col("weight").cast("double").alias("weight"), *columns)
    found = plain.mapInArrow(deal, "model int, valid boolean, key long, bins binary, y double, weight double, n long")
    found = found.repartition(2 * spark.sparkContext.defaultParallelism, "key")
    return found.mapInArrow(blocks, "model int, valid boolean, bins binary, y binary, weight binary, n binary, score binary")


def _opened(b: pa.RecordBatch, k: int, width: int, classes: int):
    """model, bins, y, weight of all rows that a place stands for, how many they are,
    valid and score."""
    of = lambda c, kind: np.frombuffer(b[c][k].as_py(), kind)
    score = of("score", "float64").reshape(-1, classes)
    y, w, n = (_whole(b[c][k].as_py(), len(score)) for c in ("y", "weight", "n"))
    return b["model"][k].as_py(), of("bins", "uint8").reshape(width, len(score)), y, w * n, n, b["valid"][k].as_py(), score


def _added(score: np.ndarray, bins: np.ndarray, rounds: list[list[Tree]]) -> np.ndarray:
    score = score.copy()
    for trees in rounds:
        for k, t in enumerate(trees):
            score[:, k] += t.value[t.leaf_of_bins(bins)]
    return score


def one_pass(blocks: DataFrame, objective: Objective, width: int, recent: dict, asked: dict, tasks: int = 1 << 20) -> tuple[dict, dict]:
    """({(model, class): histograms}, {model: (sum of losses, weight)} over rows to
    validate). asked: (model, class) -> (tentative tree, node -> place); recent:
    model -> rounds of trees that the blocks' scores lack; tasks: parts of blocks."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast((recent, asked))
    names = ["model", "klass", "sums"]

    def run(batches):
        recent, asked = shared.value
        sums: dict[tuple, np.ndarray] = {}
        for b in batches:
            for i in range(b.num_rows):
                m, bins, y, w, n, valid, score = _opened(b, i, width, objective.classes)
                if valid:
                    score = _added(score, bins, recent[m])
                    sums[m, -1] = sums.get((m, -1), 0) + np.array([(objective.losses(score, y) * w).sum(), w.sum()])
                    continue
                places = {}
                for k in range(objective.classes):
                    if (m, k) in asked:
                        tree, slots = asked[m, k]
                        place = np.full(len(tree.feature), -1)
                        place[list(slots)] = list(slots.values())
                        places[k] = place[tree.leaf_of_bins(bins)]
                # scores and derivatives only of rows that are counted somewhere
                reached = np.flatnonzero(np.any([x >= 0 for x in places.values()], axis=0)) if places else np.zeros(0, "int64")
                if len(reached) < len(y):
                    bins, y, w, n, score = bins[:, reached], y[reached], w[reached], n[reached], score[reached]
                    places = {k: x[reached] for k, x in places.items()}
                g, h = objective.derivatives(_added(score, bins, recent[m]), y)
                for k, place in places.items():
                    nodes, at = len(asked[m, k][1]), np.flatnonzero(place >= 0)
                    size, found = 256 * nodes, np.zeros((nodes, 3, width, 256))
                    every = len(at) == len(y)
                    gk, hk, nk, here, own = (g[:, k] * w, h[:, k] * w, n, place * 256, bins) if every else (g[at, k] * w[at], h[at, k] * w[at], n[at], place[at] * 256, bins[:, at])
                    for c in range(width):
                        key = here + own[c]
                        for s, x in enumerate((gk, hk, nk)):
                            found[:, s, c] = np.bincount(key, x, size).reshape(nodes, 256)
                    sums[m, k] = sums.get((m, k), 0) + found
        for (m, k), x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())], names)

    def add(table):
        parts = [np.frombuffer(x.as_py(), "float64") for x in table["sums"]]
        return pa.table({"model": table["model"][:1], "klass": table["klass"][:1], "sums": pa.array([sum(parts[1:], parts[0]).tobytes()], pa.binary())})

    schema = "model int, klass int, sums binary"
    found = blocks.mapInArrow(run, schema)
    if tasks * 6144 * width * sum(len(slots) for _, slots in asked.values()) > ADDED_BYTES:
        found = found.groupBy("model", "klass").applyInArrow(add, schema)
    flat: dict = {}
    with few_blocks_a_batch(spark):
        parts = found.collect()
    for r in parts:
        own = r["model"], r["klass"]
        flat[own] = flat.get(own, 0) + np.frombuffer(r["sums"], "float64")
    hists = {mk: flat[mk].reshape(-1, 3, width, 256) for mk in asked}
    return hists, {m: tuple(x) for (m, k), x in flat.items() if k < 0}


def rescored(blocks: DataFrame, objective: Objective, width: int, recent: dict) -> DataFrame:
    """Blocks whose scores have the recent trees added."""
    shared = blocks.sparkSession.sparkContext.broadcast(recent)

    def run(batches):
        for b in batches:
            out = []
            for i in range(b.num_rows):
                m, bins, _, _, _, _, score = _opened(b, i, width, objective.classes)
                out.append(_added(score, bins, shared.value[m]).tobytes())
            yield b.set_column(b.schema.get_field_index("score"), "score", pa.array(out, pa.binary()))

    return blocks.mapInArrow(run, blocks.schema)


# ---- the model


@dataclass
class Boosted:
    """Trees of each model: rounds of one tree a class, up to its best round."""

    columns: list[str]
    objective: Objective
    start: dict[int, np.ndarray]
    rounds: dict[int, list[list[Tree]]]
    #: mean loss of the validation rows after 0, 1, 2.. rounds
    history: dict[int, list[float]]

    def score(self, x: np.ndarray, model: int) -> np.ndarray:
        out = np.tile(self.start[model], (len(x), 1))
        for trees in self.rounds[model]:
            for k, t in enumerate(trees):
                out[:, k] += t.value[t.leaf_of(x)]
        return out

    def predict(self, df: DataFrame, keep: list[str], model: str | None = None) -> DataFrame:
        """`keep` and p (prob: an array, for classes) of each row, by the model that
        its column `model` names, else by the mean of all models."""
        spark, objective, columns = df.sparkSession, self.objective, self.columns
        shared = spark.sparkContext.broadcast(self)
        many = objective.classes > 1

        def run(batches):
            fit = shared.value
            for b in batches:
                x = np.stack([b[f"_x{i}"].to_numpy(zero_copy_only=False).astype("float64") for i in range(len(columns))], 1)
                p = np.zeros((len(x), objective.classes))
                which = b["_model"].to_numpy(zero_copy_only=False) if model else None
                for m in fit.rounds:
                    at = np.flatnonzero(which == m) if model else np.arange(len(x))
                    if len(at):
                        p[at] += objective.predict(fit.score(x[at], m)) / (1 if model else len(fit.rounds))
                out = pa.array(list(p), pa.list_(pa.float64())) if many else pa.array(p[:, 0])
                yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], out], [*keep, "prob" if many else "p"])

        kept = df.select(*keep, *([F.col(model).alias("_model")] if model else []), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
        return kept.mapInArrow(run, f"{schema}, {'prob array<double>' if many else 'p double'}")


def boost(rows: DataFrame, columns: list[str], objective: str = "binary", classes: int = 1, params: dict | None = None) -> Boosted:
    """Boosted trees for every model of `rows`, all grown side by side.

    rows: model (int), valid (boolean), y, weight and `columns`; a row stands once
    for each model that learns from it or is stopped by it. objective: binary,
    squared, poisson or softmax (y: 0 .. classes - 1). A model stops when the
    mean loss of its rows to validate has not fallen for `patience` rounds and
    keeps the rounds up to the best, one at least; without such rows it keeps all. Rows with
    a null y are left out; null and NaN features go the way that gains more."""
    p = DEFAULTS | (params or {})
    loss = Objective(objective, classes if objective == "softmax" else 1, p["max_step"])
    p |= {"step": p["max_step"] if objective == "poisson" else None}
    rows = rows.filter("y IS NOT NULL").select("model", "valid", "y", "weight", *[F.col(c).cast("double").alias(c) for c in columns])
    spark, width = rows.sparkSession, len(columns)
    edges = bin_edges(rows, columns)
    y, w = F.col("y").cast("double"), F.col("weight").cast("double")
    means = [F.sum(w * (y == k).cast("double")) if loss.name == "softmax" else F.sum(w * y) for k in range(loss.classes)]
    shares = rows.filter("NOT valid").groupBy("model").agg(F.sum(w).alias("n"), *[m.alias(f"m{k}") for k, m in enumerate(means)]).collect()
    start = {r["model"]: loss.start(np.array([r[f"m{k}"] / r["n"] for k in range(loss.classes)])) for r in shares if r["n"]}
    edges = {m: edges.get(m, []) for m in start}
    done: dict[int, list] = {m: [] for m in start}
    history: dict[int, list] = {m: [] for m in start}
    live, base = sorted(start), 0
    blocks, path = stored(block_table(rows, columns, edges, start), "boost")
    tasks = blocks.rdd.getNumPartitions()
    most = max(1, PASS_BYTES // (6144 * max(width, 1) * max(1, len(live) * loss.classes)))

    def stops(m) -> bool:
        h = history[m][1:]
        return bool(h) and len(h) > p["patience"] + int(np.argmin(h))

    while live and width:
        recent = {m: done[m][base:] for m in live}
        growers = {(m, k): Grower(edges[m], p) for m in live for k in range(loss.classes)}
        first = True
        while True:
            asked = {mk: g.wanted(most) for mk, g in growers.items()}
            asked = {mk: a for mk, a in asked.items() if a}
            if not asked:
                break
            own = blocks.filter(F.col("model").isin(sorted({m for m, _ in asked})))
            own = own if first else own.filter("NOT valid")  # losses are asked for once a round
            hists, losses = one_pass(own, loss, width, recent, {mk: growers[mk].tentative(a) for mk, a in asked.items()}, tasks)
            if first:  # the scores hold all rounds so far
                for m, (total, n) in losses.items():
                    history[m].append(total / n)
                gone = {m for m in live if stops(m) or len(done[m]) >= p["rounds"]}
                live = [m for m in live if m not in gone]
                growers = {mk: g for mk, g in growers.items() if mk[0] not in gone}
                first = False
            for mk, g in growers.items():
                if mk in asked:
                    g.tell(asked[mk], list(hists[mk]))
        for m in live:
            done[m].append([growers[m, k].tree.packed() for k in range(loss.classes)])
        if live and len(done[live[0]]) - base >= EVERY:
            with few_blocks_a_batch(spark):
                fresh, to = stored(rescored(blocks.filter(F.col("model").isin(live)), loss, width, {m: done[m][base:] for m in live}), "boost")
            removed(spark, path)
            blocks, path, base = fresh, to, len(done[live[0]])
            tasks = blocks.rdd.getNumPartitions()
    removed(spark, path)
    best = {m: int(np.argmin(history[m][1:])) + 1 if len(history[m]) > 1 else len(done[m]) for m in done}
    return Boosted(list(columns), loss, start, {m: done[m][: best[m]] for m in done}, history)


# ---- attribution


def leaf_paths(t: Tree) -> list[tuple]:
    """(value, {column: (share of rows, steps)}) of each leaf: the share of its
    parents' rows that the path's splits on the column keep, and those splits as
    (cut, goes left, nulls go left)."""
    out = []

    def walk(node, path):
        if t.feature[node] < 0:
            out.append((float(t.value[node]), path))
            return
        c = int(t.feature[node])
        for child, is_left in ((t.left[node], True), (t.right[node], False)):
            share, steps = path.get(c, (1.0, ()))
            step = (float(t.cut[node]), is_left, bool(t.missing_left[node]))
            walk(int(child), path | {c: (share * float(t.count[child]) / float(t.count[node]), (*steps, step))})

    walk(0, {})
    return out


def tree_shap(t: Tree, x: np.ndarray, out: np.ndarray) -> None:
    """Adds to `out` (rows x columns) the exact Shapley values of a tree, where a
    column outside a coalition splits rows by their counts. Each leaf is a game
    of the columns on its path: with a polynomial of the path's shares, by size
    of the coalition, in time of the square of the path's columns."""
    for value, path in leaf_paths(t):
        d = len(path)
        if not d:
            continue
        zeros = [path[c][0] for c in path]
        ones = []
        for c in path:
            v = x[:, c]
            hit, null = np.ones(len(x), "bool"), np.isnan(v)
            for cut, is_left, missing_left in path[c][1]:
                hit &= np.where(null, missing_left == is_left, (v <= cut) == is_left)
            ones.append(hit.astype("float64"))
        # weights of coalitions by size, one column more at a time
        w = np.zeros((d + 1, len(x)))
        w[0] = 1
        for l, (z, o) in enumerate(zip(zeros, ones)):  # noqa: E741
            for i in range(l, -1, -1):
                w[i + 1] += o * w[i] * (i + 1) / (l + 2)
                w[i] = z * w[i] * (l + 1 - i) / (l + 2)
        for c, z, o in zip(path, zeros, ones):
            # take the column's own factor out again; the sum is over sizes without it
            total, upper = np.zeros(len(x)), w[d].copy()
            has = o > 0
            for i in range(d - 1, -1, -1):
                part = upper * (d + 1) / (i + 1)
                total += np.where(has, part, w[i] * (d + 1) / (z * (d - i)))
                upper = w[i] - part * z * (d - i) / (d + 1)
            out[:, c] += value * (o - z) * total


def tree_attribution(t: Tree, x: np.ndarray, out: np.ndarray) -> None:
    """`tree_shap`, worked out once for each cell of the tree and looked up by rows;
    row by row for a tree of too many cells."""
    grid = t.grids(t.cut, "cut").get(0)
    if grid is None:
        return tree_shap(t, x, out)
    known = t.__dict__.setdefault("_attribution", [])
    if not known:
        cells = np.zeros((len(grid.leaf), x.shape[1]))
        for c, own, stride in zip(grid.columns, grid.cuts, grid.strides):
            cells[:, c] = np.append(own, [np.inf, np.nan])[np.arange(len(cells)) // stride % (len(own) + 2)]
        known.append(np.zeros(cells.shape))
        tree_shap(t, cells, known[0])
    out += known[0][sum(grid.code(i, x[:, c]) for i, c in enumerate(grid.columns))]


def shap_values(fit: Boosted, df: DataFrame, key: str, model: str, klass: int = -1) -> DataFrame:
    """model's column, key, feature and the exact tree attribution on the score's
    scale, of each row by the model that the column `model` names (rows of other
    models are left out). With classes: of the class `klass`, by default the last."""
    shared, columns = df.sparkSession.sparkContext.broadcast(fit), fit.columns
    k = klass % fit.objective.classes

    def run(batches):
        fit = shared.value
        for b in batches:
            x = np.stack([b[f"_x{i}"].to_numpy(zero_copy_only=False).astype("float64") for i in range(len(columns))], 1)
            which, out = b[model].to_numpy(zero_copy_only=False), np.zeros((b.num_rows, len(columns)))
            for m, rounds in fit.rounds.items():
                at = np.flatnonzero(which == m)
                if len(at):
                    own = np.zeros((len(at), len(columns)))
                    for trees in rounds:
                        tree_attribution(trees[k], x[at], own)
                    out[at] = own
            for i, c in enumerate(columns):
                yield pa.RecordBatch.from_arrays([b[model], b[key], pa.array([c] * b.num_rows), pa.array(out[:, i].copy())], [model, key, "feature", "value"])

    some = df.filter(F.col(model).isin(list(fit.rounds)))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return some.select(model, key, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)]).mapInArrow(run, f"`{model}` {kinds[model]}, `{key}` {kinds[key]}, feature string, value double")
