"""k-means over weighted points: all starts share every scan."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rounds of the oversampled start, candidates that a round draws for each centre
#: on average, and most steps and least move of a centre after it.
ROUNDS, DRAWN, STEPS, MOVE = 3, 2.0, 20, 1e-4


def uniform(h: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in (0, 1) that hang on a 64-bit hash and the salt only."""
    x = h.astype("uint64")
    with np.errstate(over="ignore"):
        for s in salt:
            x = (x + np.uint64((s + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(31)
            x *= np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(29)
    return ((x >> np.uint64(11)).astype("float64") + 0.5) / 2**53


def square_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)


class Scan:
    """Scans of points: columns h (hash of the place), w (rows there) and axes."""

    def __init__(self, points: DataFrame, axes: list[str]):
        self.points, self.axes = points.select("h", "w", *axes), axes

    def _run(self, work, schema: str, state) -> DataFrame:
        shared, axes = self.points.sparkSession.sparkContext.broadcast(state), self.axes

        def run(batches):
            for b in batches:
                x = np.stack([b[c].to_numpy(zero_copy_only=False) for c in axes], 1)
                yield from work(shared.value, b["h"].to_numpy(zero_copy_only=False), b["w"].to_numpy(zero_copy_only=False).astype("float64"), x)

        return self.points.mapInArrow(run, schema)

    def sums(self, centres: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """For each start: weight and weighted sum of each centre's points, cost."""
        d = len(self.axes)

        def work(centres, h, w, x):
            for s, c in enumerate(centres):
                if not len(x):
                    continue
                far = square_distances(x, c)
                own = far.argmin(1)
                n = np.bincount(own, w, len(c))
                total = np.stack([np.bincount(own, w * x[:, k], len(c)) for k in range(x.shape[1])], 1)
                cost = np.bincount(own, w * far[np.arange(len(x)), own], len(c))
                yield pa.RecordBatch.from_arrays([pa.array([s] * len(c), pa.int32()), pa.array(range(len(c)), pa.int32()), pa.array(n), pa.array(cost), *[pa.array(t) for t in total.T]], ["s", "c", "n", "cost", *[f"t{k}" for k in range(d)]])

        schema = "s int, c int, n double, cost double, " + ", ".join(f"t{k} double" for k in range(d))
        found = self._run(work, schema, centres).groupBy("s", "c").agg(*[F.sum(x).alias(x) for x in ("n", "cost", *(f"t{k}" for k in range(d)))]).collect()
        out = [(np.zeros(len(c)), np.zeros((len(c), d)), 0.0) for c in centres]
        for r in found:
            n, total, cost = out[r["s"]]
            n[r["c"]], total[r["c"]] = r["n"], [r[f"t{k}"] for k in range(d)]
            out[r["s"]] = n, total, cost + r["cost"]
        return out

    def drawn(self, centres: list[np.ndarray], costs: list[float], many: float, salt: tuple) -> list[np.ndarray]:
        """New candidates of each start: a point comes with the odds of its share
        of the cost, `many` on average."""
        d = len(self.axes)

        def work(state, h, w, x):
            centres, costs = state
            for s, (c, cost) in enumerate(zip(centres, costs)):
                if len(x) and cost > 0:
                    odds = many * w * square_distances(x, c).min(1) / cost
                    hit = x[uniform(h, *salt, s) < odds]
                    yield pa.RecordBatch.from_arrays([pa.array([s] * len(hit), pa.int32()), *[pa.array(v) for v in hit.T.copy()]], ["s", *[f"x{k}" for k in range(d)]])

        got = self._run(work, "s int, " + ", ".join(f"x{k} double" for k in range(d)), (centres, costs)).collect()
        return [np.array(sorted(tuple(r[1:]) for r in got if r["s"] == s)).reshape(-1, d) for s in range(len(centres))]


def chosen(candidates: np.ndarray, weight: np.ndarray, k: int, rng) -> np.ndarray:
    """k of the few weighted candidates, far from each other by chance."""
    out = [candidates[rng.choice(len(candidates), p=weight / weight.sum())]]
    while len(out) < k:
        odds = weight * square_distances(candidates, np.array(out)).min(1)
        if odds.sum() <= 0:
            break
        out.append(candidates[rng.choice(len(candidates), p=odds / odds.sum())])
    return np.array(out)


def k_means(points: DataFrame, axes: list[str], k: int, seed: int = 0, starts: int = 10) -> tuple[np.ndarray, float, int]:
    """(centres, cost, scans) of the best of `starts` starts over `points`: a row a
    distinct place with its hash h, its number of rows w and coordinates. Each
    start draws its candidates apart, but a scan serves all of them, so their
    number does not change that of the scans. Ends when no centre moves."""
    scan, scans = Scan(points, axes), 0
    first = points.orderBy("h", *axes).select(*axes).first()
    if first is None:
        raise ValueError("no points")
    centres = [np.array([list(first)], "float64") for _ in range(starts)]
    for r in range(ROUNDS):
        costs = [c for _, _, c in scan.sums(centres)]
        new = scan.drawn(centres, costs, DRAWN * k, (seed, r))
        scans += 2
        centres = [np.unique(np.concatenate([a, b]), axis=0) for a, b in zip(centres, new)]
    weights = [n for n, _, _ in scan.sums(centres)]
    scans += 1
    centres = [chosen(c, n, k, np.random.default_rng([seed, s])) for s, (c, n) in enumerate(zip(centres, weights))]
    for _ in range(STEPS):
        found = scan.sums(centres)
        scans += 1
        moved = [np.where(n[:, None] > 0, t / np.maximum(n, 1e-300)[:, None], c) for (n, t, _), c in zip(found, centres)]
        still = all(np.sqrt(((a - b) ** 2).sum(1)).max() <= MOVE for a, b in zip(moved, centres))
        centres = moved
        if still:
            break
    costs = [c for _, _, c in scan.sums(centres)]
    best = int(np.argmin(costs))
    return centres[best], costs[best], scans + 1
