"""Feature importances of a random forest for a 0/1 label, whose trees never meet on the driver.

Rows are binned once and laid out in blocks. Nodes of more than ``LOCAL_ROWS`` rows are split by passes over the blocks, which sum
the labels of every (tree, node, feature, bin). The rows of each smaller node are sent to one task, which grows all of the tree
below it level by level and gives back only the gains of its features and, if it comes out as one class, that class. So the driver
holds the few upper nodes, whatever the depth of the trees.

A tree sees each row as often as a Poisson draw of mean 1 says, by a hash of the row, so with given bins a forest does not depend
on partitions or retries; rows that are equal in all columns are drawn alike. Each node tries the square root of the number of features, drawn by a
hash too. Splits gain Gini impurity; a node without a gain is a leaf. As in Spark's own forests, siblings that are leaves of one
class are merged, so splits that change no prediction do not count, and the gains of a tree are scaled to a sum of 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Tree, _mixed, bin_edges, laid_blocks, read_block

BINS = 32
LOCAL_ROWS = 1 << 17  # of a node whose subtree one task grows
GROUP_BYTES = 32 << 20  # of rows that a task gets
LEAST_GAIN = 1e-12
MIXED = -1  # a node that is not one leaf
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


def edges_of(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper edges of the bins: every value of a feature with few of them, else quantiles."""
    known = rows.select(*[F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)])
    counts = known.agg(*[F.approx_count_distinct(c).alias(c) for c in known.columns]).first()
    few = [c for c in known.columns if counts[c] <= 2 * bins]
    values: dict[str, list[float]] = {c: [] for c in few}
    if few:
        for row in known.select(*few).unpivot([], few, "feature", "value").distinct().collect():  # some 2 * bins for each of them
            values[row["feature"]].append(row["value"])
    quantiles = bin_edges(rows, features, bins + 2)
    return [sorted(values[c])[:-1] if len(values.get(c, quantiles)) <= bins and c in values else quantiles[i] for i, c in enumerate(known.columns)]


def drawn(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree sees each row."""
    salt = _mixed(np.array([seed * 1_000_003 + tree + 1], np.uint64))
    return np.searchsorted(_POISSON, (_mixed(ids ^ salt) >> np.uint64(11)) * 2.0**-53, "right")


def tried(nodes: np.ndarray, tree: int, seed: int, features: int, count: int) -> np.ndarray:
    """The features that each node tries, by its number in the tree: a reservoir, in whose order the first of equally good ones is taken."""
    salt = _mixed(np.array([seed * 1_000_003 + tree + 1], np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    keys, chosen = _mixed(nodes.astype(np.uint64) ^ salt), np.tile(np.arange(count), (len(nodes), 1))
    for f in range(count, features):
        place = (_mixed(keys + np.uint64((f + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)).astype(np.int64) % (f + 1)
        taken = np.flatnonzero(place < count)
        chosen[taken, place[taken]] = f
    return chosen


def _gini(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Rows times Gini impurity."""
    n = zero + one
    return 2.0 * np.divide(zero * one, n, out=np.zeros(np.shape(n)), where=n > 0)


def subtree(bins: np.ndarray, label: np.ndarray, times: np.ndarray, root: int, level: int, tree: int, seed: int, count: int,
            depth: int) -> tuple[int, np.ndarray]:
    """(class or ``MIXED``, gains of the features) of the tree grown below node ``root``."""
    features, n = bins.shape
    flat, width = bins.ravel(), int(bins.max(initial=0)) + 1
    one, weight = times * label, times.astype(np.int64)
    rows, place, nodes = np.arange(n), np.zeros(n, np.int64), np.array([root], np.int64)
    levels = []
    while len(nodes):
        m = len(nodes)
        ones = np.bincount(place, one[rows], m)
        all_ = np.bincount(place, weight[rows], m)
        state = (ones > all_ - ones).astype(np.int64)
        split = np.zeros(m, np.int64) - 1  # feature
        gained, cut = np.zeros(m), np.zeros(m, np.int64)
        impure = np.flatnonzero((ones > 0) & (ones < all_)) if level < depth else np.zeros(0, np.int64)
        if len(impure):
            slot = np.full(m, -1)
            slot[impure] = np.arange(len(impure))
            kept = slot[place] >= 0
            rows, at = rows[kept], slot[place[kept]]
            chosen = tried(nodes[impure], tree, seed, features, count)
            # cells (node, feature, bin) that hold rows, in order; a row is its cell, how often it is seen, and its label
            cell = (at[:, None] * count + np.arange(count)) * width + flat[chosen[at] * n + rows[:, None]]
            packed = np.sort(((cell << 6) | ((weight[rows] << 1) | label[rows].astype(np.int64))[:, None]).ravel())
            cell, seen, is_one = packed >> 6, (packed >> 1) & 31, packed & 1
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            group = cell[first] // width
            left_all, left_one = (np.cumsum(np.add.reduceat(x, first)) for x in (seen, seen * is_one))
            start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            held = np.diff(np.concatenate([start, [len(group)]]))
            for total in (left_all, left_one):
                before = np.concatenate([[0], total[start[1:] - 1]])
                total -= np.repeat(before, held)
            node = group // count
            whole, whole_one = all_[impure][node], ones[impure][node]
            gain = _gini(whole - whole_one, whole_one) - _gini(left_all - left_one, left_one) - _gini(
                whole - left_all - (whole_one - left_one), whole_one - left_one)
            gain[left_all >= whole] = 0.0
            head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            best = np.maximum.reduceat(gain, head)
            hit = np.flatnonzero(gain == np.repeat(best, np.diff(np.concatenate([head, [len(node)]]))))
            hit = hit[np.concatenate([[True], node[hit][1:] != node[hit][:-1]])]  # the first of equal ones; every node has one
            good = best > LEAST_GAIN * all_[impure]
            split[impure[good]] = chosen[np.flatnonzero(good), group[hit][good] % count]
            cut[impure[good]], gained[impure[good]] = cell[first][hit][good] % width, best[good]
            place = impure[at]
        going = split[place] >= 0 if len(impure) else np.zeros(0, bool)
        rows, place = (rows[going], place[going]) if len(impure) else (rows[:0], place[:0])
        inner = np.flatnonzero(split >= 0)
        number = np.full(m, -1)
        number[inner] = 2 * np.arange(len(inner))
        levels.append((state, split, gained))
        right = flat[split[place] * n + rows] > cut[place]
        place = number[place] + right
        nodes = np.stack([2 * nodes[inner], 2 * nodes[inner] + 1], axis=1).ravel()
        level += 1
    gains, below = np.zeros(features), np.zeros(0, np.int64)
    for state, split, gained in reversed(levels):
        inner = np.flatnonzero(split >= 0)
        pair = below.reshape(-1, 2)
        mixed = (pair[:, 0] != pair[:, 1]) | (pair[:, 0] == MIXED)
        np.add.at(gains, split[inner][mixed], gained[inner][mixed])
        below = state
        below[inner] = np.where(mixed, MIXED, pair[:, 0])
    return int(below[0]), gains


class Upper:
    """The nodes of one tree that are too large for a task."""

    def __init__(self, rows: int, local_rows: int) -> None:
        self.tree, self.numbers, self.level = Tree(), [1], [0]
        self.tree.add()
        self.local_rows, self.gained = local_rows, {}
        self.states: dict[int, int] = {}  # of leaves
        self.open = [0] if rows > local_rows else []
        self.groups = [] if self.open else [0]

    def split(self, at: int, sums: np.ndarray, features: np.ndarray, depth: int) -> None:
        """``sums``: (features tried, bins, label)."""
        left = np.cumsum(sums, axis=1)
        zero, one = sums[0].sum(axis=0)
        gain = _gini(zero, one) - _gini(left[:, :, 0], left[:, :, 1]) - _gini(zero - left[:, :, 0], one - left[:, :, 1])
        gain[left.sum(axis=2) >= zero + one] = 0.0
        f, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if not gain[f, cut] > LEAST_GAIN * (zero + one):
            self.states[at] = int(one > zero)
            return
        tree = self.tree
        tree.feature[at], tree.cut[at], self.gained[at] = int(features[f]), int(cut), float(gain[f, cut])
        for side, (a, b) in enumerate((left[f, cut], (zero, one) - left[f, cut])):
            child = tree.add()
            (tree.right if side else tree.left)[at] = child
            self.numbers.append(2 * self.numbers[at] + side)
            self.level.append(self.level[at] + 1)
            if not a or not b or self.level[child] >= depth:
                self.states[child] = int(b > a)
            else:
                (self.open if a + b > self.local_rows else self.groups).append(child)

    def gains(self, features: int, below: dict[int, tuple[int, np.ndarray]]) -> np.ndarray:
        """Gains of the whole tree; ``below`` holds what tasks have found."""
        total, states = np.zeros(features), dict(self.states)
        for at, (state, gains) in below.items():
            states[at] = state
            total += gains
        for at in reversed(range(len(self.tree.feature))):
            if self.tree.feature[at] >= 0:
                a, b = states[self.tree.left[at]], states[self.tree.right[at]]
                states[at] = a if a == b else MIXED
                if states[at] == MIXED:
                    total[self.tree.feature[at]] += self.gained[at]
        return total


def _drawn_rows(block: tuple, tree: int, upper: Upper, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a block that a tree sees, how often, and their nodes."""
    times = drawn(block[2], tree, seed)
    rows = np.flatnonzero(times)
    return rows, times[rows], upper.tree.route(block[0], rows)


def importances(rows: DataFrame, features: Sequence[str], label: str, trees: int, depth: int, seed: int, local_rows: int | None = None) -> list[float]:
    features, local_rows = list(features), LOCAL_ROWS if local_rows is None else local_rows
    unknown = [F.col(f).isNull() | F.isnan(F.col(f).cast("double")) for f in features] + [F.col(label).isNull() | ~F.col(label).isin(0, 1)]
    counted = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(sum((u.cast("int") for u in unknown), F.lit(0))), F.lit(0)).alias("unknown")).first()
    if not counted["n"] or counted["unknown"]:
        raise ValueError("a forest needs rows, known features and labels of 0 and 1")
    edges = edges_of(rows, features)
    laid = laid_blocks(rows, features, label, edges, F.xxhash64(*rows.columns))
    width, count, cells = len(features), math.ceil(math.sqrt(len(features))), max(map(len, edges), default=0) + 2
    uppers = [Upper(counted["n"], local_rows) for _ in range(trees)]
    blocks = laid.rdd.map(lambda row: read_block(row, width))
    while asked := {t: u.open for t, u in enumerate(uppers) if u.open}:
        known = {t: uppers[t] for t in asked}

        def sums(block: tuple) -> Iterator[tuple]:
            matrix, ones = block[0], block[1].astype(np.int64)
            for t, nodes in asked.items():
                some, times, node = _drawn_rows(block, t, known[t], seed)
                for at in nodes:
                    inside = node == at
                    own, seen = some[inside], times[inside]
                    chosen = tried(np.array([known[t].numbers[at]]), t, seed, width, count)[0]
                    made = [np.bincount(matrix[f, own] * 2 + ones[own], seen, 2 * cells).reshape(cells, 2) for f in chosen]
                    yield (t, at), np.stack(made).astype(np.int64)

        found = dict(blocks.flatMap(sums).reduceByKey(lambda a, b: a + b).collect())  # a few KB for each node of the passes
        for t, nodes in asked.items():
            uppers[t].open = []
            for at in nodes:
                uppers[t].split(at, found[t, at], tried(np.array([uppers[t].numbers[at]]), t, seed, width, count)[0], depth)
    groups = [(t, at) for t, u in enumerate(uppers) for at in u.groups]
    place = {group: k for k, group in enumerate(groups)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = read_block(row, width)
                for t, upper in enumerate(uppers):
                    some, times, node = _drawn_rows(block, t, upper, seed)
                    for at in upper.groups:
                        own = some[node == at]
                        if len(own):
                            parts = np.ascontiguousarray(block[0][:, own]), block[1][own].astype(np.uint8), times[node == at].astype(np.uint8)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([place[t, at]], pa.int64()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                                names=["place", "bins", "labels", "times"])

    def grow(pieces: pa.Table) -> pa.Table:
        t, at = groups[pieces.column("place")[0].as_py()]
        labels, times = (np.concatenate([np.frombuffer(p, np.uint8) for p in pieces.column(c).to_pylist()]).astype(np.int64) for c in ("labels", "times"))
        bins = np.concatenate([np.frombuffer(p, np.uint8).reshape(width, -1) for p in pieces.column("bins").to_pylist()], axis=1)
        state, gains = subtree(bins, labels, times, uppers[t].numbers[at], uppers[t].level[at], t, seed, count, depth)
        return pa.table({"place": pa.array([place[t, at]], pa.int64()), "state": pa.array([state], pa.int64()), "gains": pa.array([gains.tolist()], pa.list_(pa.float64()))})

    parallel = rows.sparkSession.sparkContext.defaultParallelism
    tasks = min(len(groups), max(4 * parallel, counted["n"] * trees * (width + 2) // GROUP_BYTES))
    total = np.zeros(width)
    below: list[dict] = [{} for _ in uppers]
    if groups:
        dealt = laid.mapInArrow(deal, "place long, bins binary, labels binary, times binary")
        grown = dealt.repartition(tasks, "place").groupBy("place").applyInArrow(grow, "place long, state long, gains array<double>")
        for row in grown.collect():  # the upper nodes are few, and so are the groups
            t, at = groups[row["place"]]
            below[t][at] = row["state"], np.array(row["gains"])
    for t, upper in enumerate(uppers):
        for at in set(upper.groups) - set(below[t]):
            below[t][at] = 0, np.zeros(width)  # a tree that has drawn no row
        gains = upper.gains(width, below[t])
        total += gains / gains.sum() if gains.sum() else gains
    return (total / total.sum() if total.sum() else total).tolist()
