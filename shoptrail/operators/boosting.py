"""Gradient-boosted trees for a 0/1 label, grown on histograms that Spark sums.

Features are cut into bins once and laid out as blocks of small integers, which stay with the executors. A pass over the blocks
sums gradients, second derivatives and rows for every (node, feature, bin) that is asked for; only these sums are merged in a tree
of tasks and reach the driver, so its work depends on nodes, features and bins and not on rows. A pass asks for the smaller child
of each split and gets the other by subtraction.

Growth is best first: the open leaf with the largest gain is split next, until ``num_leaves`` are reached or nothing gains. Leaves
that may be next are asked for in the same pass, and the order is played again with what came back, so the tree is the one that
single steps would give. Without a leaf limit this is growth level by level, ``max_depth`` passes a tree.

Gains are Newton gains, T(GL)²/(HL+lambda) + T(GR)²/(HR+lambda) - T(G)²/(H+lambda) with T(x) = sign(x) max(|x|-alpha, 0); a split
needs more than ``gamma``, ``min_child_weight`` of second derivatives and ``min_child_samples`` rows on both sides. A leaf weighs
-T(G)/(H+lambda) times the learning rate. Sums are whole numbers (2^-20), so a model does not depend on partitions or retries.

Several models grow side by side in the same passes; each has its own rows (by a hash), features and parameters.

Missing values (NULL, NaN) have a bin of their own, which each split sends to the better side. Rows with a label other than 0 and 1
take no part. A model needs both labels.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..session import stored

BINS = 64
BLOCK_ROWS = 1 << 16
FOLD = 8  # trees that passes apply on top of the stored margins
SCALE = float(1 << 20)
LEAST_GAIN = 1e-6
PASS_BYTES = 32 << 20  # of sums that a pass brings to the driver
HELD_BYTES = 96 << 20  # of sums that the trees in growth keep there, so that one child of a split is enough


@dataclass(frozen=True)
class Settings:
    n_estimators: int = 300
    learning_rate: float = 0.05
    max_depth: int = -1  # no limit
    num_leaves: int = -1  # no limit
    subsample: float = 1.0
    colsample: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 0.0
    min_child_samples: int = 1
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0
    scale_pos_weight: float = 1.0
    seed: int = K.SEED


@dataclass
class Tree:
    """Nodes as lists; ``feature`` is -1 at leaves, and rows go left where their bin is at most ``cut``."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float = 0.0) -> int:
        for column, empty in ((self.feature, -1), (self.cut, 0), (self.missing_left, False), (self.left, -1), (self.right, -1), (self.value, value), (self.gain, 0.0)):
            column.append(empty)
        return len(self.feature) - 1

    def leaves(self) -> int:
        return self.feature.count(-1)

    def height(self) -> int:
        depth = [0] * len(self.feature)
        for node, feature in enumerate(self.feature):  # children come after their parent
            if feature >= 0:
                depth[self.left[node]] = depth[self.right[node]] = depth[node] + 1
        return max(depth)

    def route(self, bins: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each row of ``bins`` (features x rows), or of some ``rows`` of it.

        A step looks up where a node sends a bin; leaves send every bin to themselves.
        """
        rows = np.arange(bins.shape[1]) if rows is None else rows
        node, height = np.zeros(len(rows), np.int64), self.height()
        if not height or not len(rows):
            return node
        feature, own = np.array(self.feature), np.arange(len(self.feature))
        value = np.arange(int(bins.max()) + 1)
        goes_left = np.where(value == 0, np.array(self.missing_left)[:, None], value <= np.array(self.cut)[:, None])
        next_ = np.where(goes_left, np.array(self.left)[:, None], np.array(self.right)[:, None])
        next_ = np.where((feature < 0)[:, None], own[:, None], next_).ravel()
        start, flat, width = np.maximum(feature, 0) * bins.shape[1], bins.ravel(), len(value)
        at = np.empty_like(node)
        for _ in range(height):
            np.take(start, node, out=at, mode="clip")  # "clip" only spares a buffer
            at += rows
            node *= width
            node += flat.take(at)
            np.take(next_, node, out=at, mode="clip")
            node, at = at, node
        return node

    def apply(self, bins: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        return np.array(self.value)[self.route(bins, rows)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sampled(ids: np.ndarray, settings: Settings, number: int) -> np.ndarray | None:
    """Which rows a tree sees; None for all."""
    if settings.subsample >= 1.0:
        return None
    salt = _mixed(np.array([settings.seed * 1_000_003 + number], np.uint64))
    return _mixed(ids ^ salt) < np.uint64(settings.subsample * 2.0**64 * (1 - 2**-53))


def chosen_features(count: int, settings: Settings, number: int) -> np.ndarray:
    if settings.colsample >= 1.0:
        return np.arange(count)
    rng = np.random.default_rng([settings.seed, number])
    return np.sort(rng.permutation(count)[:max(1, round(count * settings.colsample))])


def derivatives(margin: np.ndarray, label: np.ndarray, positive_weight: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted log loss, in whole numbers of 2^-20."""
    p = 1.0 / (1.0 + np.exp(-margin))
    weight = np.where(label == 1, positive_weight, 1.0)
    return np.rint((p - label) * weight * SCALE), np.rint(p * (1.0 - p) * weight * SCALE)


def shrunk(total: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(total) * np.maximum(np.abs(total) - alpha, 0.0)


def quality(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    below = h + s.reg_lambda
    return np.divide(shrunk(g, s.reg_alpha) ** 2, below, out=np.zeros_like(below), where=below > 0)


def weight(g: float, h: float, s: Settings) -> float:
    below = h + s.reg_lambda
    return float(-shrunk(np.float64(g), s.reg_alpha) / below) if below > 0 else 0.0


@dataclass
class Split:
    gain: float
    feature: int  # among the features of the tree
    cut: int
    missing_left: bool
    left: np.ndarray  # sums g, h, rows
    right: np.ndarray


def best_split(sums: np.ndarray, s: Settings) -> Split | None:
    """``sums``: whole numbers (3, features, bins). Equal gains: missing values to the left, then the first feature and bin."""
    total = sums[:, 0, :].sum(axis=1)
    known = np.cumsum(sums[:, :, 1:], axis=2)[:, :, :-1]
    left = np.stack([known + sums[:, :, :1], known])  # (side of the missing, 3, features, bins)
    right = total[None, :, None, None] - left
    (gl, hl, nl), (gr, hr, nr) = ((x[:, 0] / SCALE, x[:, 1] / SCALE, x[:, 2]) for x in (left, right))
    g, h = total[0] / SCALE, total[1] / SCALE
    gain = quality(gl, hl, s) + quality(gr, hr, s) - quality(np.array([g]), np.array([h]), s)
    least = max(1, s.min_child_samples)
    gain[(nl < least) | (nr < least) | (hl < s.min_child_weight) | (hr < s.min_child_weight)] = -np.inf
    if not gain.size:
        return None
    side, f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = float(gain[side, f, b])
    if not value > max(s.gamma, LEAST_GAIN):
        return None
    # copies: a slice would keep all sums of the node as long as the split
    return Split(value, int(f), int(b) + 1, bool(side == 0), left[side, :, f, b].copy(), right[side, :, f, b].copy())


class Grower:
    """One tree of one model, between passes."""

    def __init__(self, settings: Settings, features: np.ndarray, held_bytes: float = math.inf) -> None:
        self.settings, self.features, self.held_bytes = settings, features, held_bytes
        self.tree = Tree()
        self.tree.add()
        self.depth, self.total, self.sums, self.split = [0], [None], {}, {}
        self.asked: dict[int, tuple[int, int]] = {}  # node -> (parent, other child), or -1 where it is asked for too
        self.accepted: list[int] = []
        self.done = False

    def wanted(self) -> list[int]:
        """Nodes whose sums the next pass has to bring; none when the tree is grown."""
        if self.total[0] is None:
            self.asked = {0: (-1, -1)}
            return [0]
        s = self.settings
        limit = s.num_leaves if s.num_leaves > 0 else math.inf
        heap = [(-self.split[0].gain, 0)] if self.split[0] else []
        leaves, self.accepted, unknown = 1, [], []
        while heap and leaves < limit:  # beyond the first unknown child this is a guess at what comes next
            _, node = heapq.heappop(heap)
            self._open(node)
            self.accepted.append(node)
            leaves += 1
            if leaves < limit:
                for child in (self.tree.left[node], self.tree.right[node]):
                    if child in self.split:
                        if self.split[child]:
                            heapq.heappush(heap, (-self.split[child].gain, child))
                    elif self._may_split(child) and node not in unknown[-1:]:
                        unknown.append(node)
        if not unknown:
            self.done = True
            return []
        self.asked = {}
        for node in unknown:
            pair = self.tree.left[node], self.tree.right[node]
            open_ = [c for c in pair if c not in self.split and self._may_split(c)]
            if open_ and node in self.sums:
                small = min(pair, key=lambda c: (self.total[c][2], c))
                self.asked[small] = (node, pair[0] + pair[1] - small)
            elif open_:  # the sums of the node were not kept
                self.asked |= {c: (-1, -1) for c in open_}
        return list(self.asked)

    def _may_split(self, node: int) -> bool:
        s = self.settings
        return not (0 < s.max_depth <= self.depth[node]) and self.total[node][2] >= 2 * max(1, s.min_child_samples)

    def _open(self, node: int) -> None:
        if self.tree.feature[node] >= 0:
            return
        split = self.split[node]
        self.tree.feature[node], self.tree.cut[node] = int(self.features[split.feature]), split.cut
        self.tree.missing_left[node], self.tree.gain[node] = split.missing_left, split.gain
        for name, total in (("left", split.left), ("right", split.right)):
            getattr(self.tree, name)[node] = self.tree.add()
            self.depth.append(self.depth[node] + 1)
            self.total.append(total)

    def feed(self, sums: dict[int, np.ndarray]) -> None:
        for node, own in sums.items():
            parent, other = self.asked[node]
            pairs = [(node, own)] + ([(other, self.sums.pop(parent) - own)] if other >= 0 else [])
            for child, values in pairs:
                if self.total[child] is None:
                    self.total[child] = values[:, 0, :].sum(axis=1)
                self.split[child] = best_split(values, self.settings) if self._may_split(child) else None
                fits = (len(self.sums) + 1) * values.nbytes <= self.held_bytes
                if self.split[child] and fits and not 0 < self.settings.max_depth <= self.depth[child] + 1:
                    self.sums[child] = values.copy()  # its children will be asked for

    def grown(self) -> Tree:
        """The tree of the accepted splits, with its leaf weights."""
        s, made, accepted = self.settings, Tree(), set(self.accepted)

        def build(node: int) -> int:
            g, h, _ = self.total[node]
            at = made.add(s.learning_rate * weight(g / SCALE, h / SCALE, s))
            if node in accepted:
                made.feature[at], made.cut[at] = self.tree.feature[node], self.tree.cut[node]
                made.missing_left[at], made.gain[at] = self.tree.missing_left[node], self.tree.gain[node]
                made.left[at], made.right[at] = build(self.tree.left[node]), build(self.tree.right[node])
            return at

        build(0)
        return made


# ---- layout -----------------------------------------------------------------------------

def bin_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper edges of the bins of each feature: quantiles of its known values, so features of few values have a bin for each."""
    shares = [i / (bins - 2) for i in range(1, bins - 2)]
    known = rows.select(*[F.col(f).cast("double").alias(f) for f in features])
    quantiles = known.approxQuantile(list(features), shares, 0.2 / bins) if features else []
    return [sorted(set(q)) for q in quantiles]


def binned(columns: Sequence[np.ndarray], edges: Sequence[Sequence[float]]) -> np.ndarray:
    made = np.zeros((len(edges), len(columns[0]) if len(columns) else 0), np.uint8)
    for i, (values, cuts) in enumerate(zip(columns, edges, strict=True)):
        made[i] = np.where(np.isnan(values), 0, 1 + np.searchsorted(np.array(cuts), values, "left"))
    return made


def _doubles(batch: pa.RecordBatch, columns: Sequence[int]) -> list[np.ndarray]:
    return [batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float) for i in columns]


def laid_blocks(rows: DataFrame, features: Sequence[str], label: str, edges: Sequence[Sequence[float]], ids: Column | None = None) -> DataFrame:
    """Blocks of about ``BLOCK_ROWS`` rows each; written once, so that lost blocks are read again and not computed.

    ``ids`` names the rows for draws; by default it is a hash of their features and label.
    """
    values = [F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)]
    named = rows.filter(F.col(label).isin(0, 1)).select(*values, F.col(label).cast("double").alias("_label"), *([] if ids is None else [ids.alias("_id")]))
    if ids is None:
        named = named.withColumn("_id", F.xxhash64(*named.columns))

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def block() -> pa.RecordBatch:
            bins, label, ids = (np.concatenate([h[i] for h in held], axis=-1) for i in range(3))
            parts = [pa.array([x.tobytes()], pa.binary()) for x in (np.ascontiguousarray(bins), label.astype(np.uint8), ids)]
            return pa.RecordBatch.from_arrays([pa.array([bins.shape[1]], pa.int64()), *parts], names=["n", "bins", "labels", "ids"])

        for batch in batches:
            columns = _doubles(batch, range(len(edges)))
            last = batch.num_columns - 2
            held.append((binned(columns, edges), batch.column(last).to_numpy(), batch.column(last + 1).to_numpy().astype(np.int64)))
            if sum(h[0].shape[1] for h in held) >= BLOCK_ROWS:
                yield block()
                held = []
        if held:
            yield block()

    return stored(named.mapInArrow(lay, "n long, bins binary, labels binary, ids binary"))


def read_block(row, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, labels, ids) of a row of ``laid_blocks``."""
    bins = np.frombuffer(row["bins"], np.uint8).reshape(width, row["n"])
    return bins, np.frombuffer(row["labels"], np.uint8).astype(float), np.frombuffer(row["ids"], np.int64).view(np.uint64)


def blocks_of(rows: DataFrame, features: Sequence[str], label: str, edges: Sequence[Sequence[float]]) -> RDD:
    width = len(edges)
    return laid_blocks(rows, features, label, edges).rdd.map(lambda row: read_block(row, width))


# ---- training ---------------------------------------------------------------------------

class Booster:
    """Models of several settings that grow side by side on one layout."""

    def __init__(self, rows: DataFrame, features: Sequence[str], label: str, settings: Sequence[Settings], bins: int = BINS) -> None:
        self.features, self.label, self.bins = list(features), label, bins
        counted = rows.agg(F.count_if(F.col(label) == 0).alias("n"), F.count_if(F.col(label) == 1).alias("p")).first()
        if not counted["n"] or not counted["p"]:
            raise ValueError("training rows hold one class only")
        self.settings = list(settings)
        self.base = [math.log(counted["p"] * s.scale_pos_weight / counted["n"]) for s in self.settings]
        self.edges = bin_edges(rows.filter(F.col(label).isin(0, 1)), self.features, bins)
        self.trees: list[list[Tree]] = [[] for _ in self.settings]
        base = dict(enumerate(self.base))

        def begin(block: tuple) -> tuple:
            return *block, {i: np.full(len(block[1]), b) for i, b in base.items()}

        self.state = blocks_of(rows, self.features, label, self.edges).map(begin).persist(StorageLevel.MEMORY_AND_DISK)
        self.stale: RDD | None = None
        self.pending: dict[int, list[Tree]] = {}
        self.alive = set(base)

    def keep(self, alive: Sequence[int]) -> None:
        """Only these models grow on; blocks no longer carry the margins of the others."""
        self.alive = set(alive)
        self.pending = {i: trees for i, trees in self.pending.items() if i in self.alive}

    def grow(self, rounds: dict[int, int]) -> None:
        """Grow model i until it has ``rounds[i]`` trees."""
        if ended := sorted(set(rounds) - self.alive):
            raise ValueError(f"models that were not kept can't grow: {ended}")
        while active := [i for i, n in rounds.items() if len(self.trees[i]) < n]:
            growers = {i: Grower(self.settings[i], chosen_features(len(self.features), self.settings[i], len(self.trees[i])), HELD_BYTES / len(active))
                       for i in active}
            while True:
                work = {i: (g, nodes) for i, g in growers.items() if not g.done and (nodes := g.wanted())}
                if not work:
                    break
                for part in self._portions(work):
                    for i, sums in self._pass(part).items():
                        growers[i].feed(sums)
            for i, g in growers.items():
                tree = g.grown()
                self.trees[i].append(tree)
                self.pending.setdefault(i, []).append(tree)
            if max(map(len, self.pending.values())) >= FOLD:
                self._fold()

    def _bytes(self, grower: Grower, nodes: list[int]) -> int:
        return len(nodes) * 3 * len(grower.features) * self.bins * 8

    def _portions(self, work: dict[int, tuple[Grower, list[int]]]) -> Iterator[dict[int, tuple[Grower, list[int]]]]:
        """The work of several passes, none with more than ``PASS_BYTES`` of sums unless one node has."""
        part, size = {}, 0
        for i, (grower, nodes) in work.items():
            most = max(1, PASS_BYTES // max(1, self._bytes(grower, nodes[:1])))
            for at in range(0, len(nodes), most):
                some = nodes[at:at + most]
                own = self._bytes(grower, some)
                if part and (i in part or size + own > PASS_BYTES):
                    yield part
                    part, size = {}, 0
                part[i] = grower, some
                size += own
        if part:
            yield part

    def _sums(self, work: dict[int, tuple[Grower, list[int]]]):
        """What a pass does with the blocks of a task."""
        bins, pending = self.bins, {i: self.pending.get(i, []) for i in work}
        tasks = {i: (g.settings, g.tree, nodes, g.features, len(self.trees[i])) for i, (g, nodes) in work.items()}

        def sums(blocks: Iterator[tuple]) -> Iterator[dict]:
            total: dict[int, np.ndarray] = {}
            for matrix, label, ids, margins in blocks:
                for i, (settings, tree, nodes, features, number) in tasks.items():
                    some = sampled(ids, settings, number)
                    rows = np.arange(len(label)) if some is None else np.flatnonzero(some)
                    slots = np.full(len(tree.feature), -1)
                    slots[nodes] = np.arange(len(nodes))
                    slot = slots[tree.route(matrix, rows)]  # asked nodes have no children yet, so rows stop there
                    rows, slot = rows[slot >= 0], slot[slot >= 0]
                    margin = margins[i][rows]  # only these rows need theirs
                    for done in pending[i]:
                        margin = margin + done.apply(matrix, rows)
                    g, h = derivatives(margin, label[rows], settings.scale_pos_weight)
                    own = np.zeros((len(nodes), 3, len(features), bins), np.int64)
                    base = slot * bins
                    for k, f in enumerate(features):
                        at = base + matrix[f][rows]
                        for part, weights in enumerate((g, h, None)):
                            own[:, part, k] = np.bincount(at, weights, len(nodes) * bins).reshape(len(nodes), bins)
                    total[i] = total[i] + own if i in total else own
            yield total

        return sums

    def _pass(self, work: dict[int, tuple[Grower, list[int]]]) -> dict[int, dict[int, np.ndarray]]:
        def merged(a: dict, b: dict) -> dict:
            for i, own in b.items():
                a[i] = a[i] + own if i in a else own
            return a

        found, size = self.state.mapPartitions(self._sums(work)), sum(self._bytes(*w) for w in work.values())
        tasks = found.getNumPartitions()
        if tasks * size <= 2 * PASS_BYTES:
            result = merged_all(found.collect(), merged)
        else:  # node by node in the executors, so that the driver gets every sum once
            single = found.flatMap(lambda total: [((i, k), values) for i, own in total.items() for k, values in enumerate(own)])
            brought = dict(single.reduceByKey(lambda a, b: a + b, max(1, min(tasks, size >> 18))).collect())
            result = {i: [brought[i, k] for k in range(len(nodes))] for i, (_, nodes) in work.items()}
        if self.stale is not None:
            self.stale.unpersist()
            self.stale = None
        return {i: dict(zip(nodes, result[i], strict=True)) for i, (_, nodes) in work.items()}

    def _fold(self) -> None:
        """Put the pending trees into the stored margins; the next pass computes them, and lost ones come from the layout again."""
        pending, alive, self.pending = self.pending, frozenset(self.alive), {}

        def fold(block: tuple) -> tuple:
            matrix, label, ids, margins = block
            known = {i: margin for i, margin in margins.items() if i in alive}
            return matrix, label, ids, {**known, **{i: margins[i] + sum(t.apply(matrix) for t in trees) for i, trees in pending.items()}}

        self.stale, self.state = self.state, self.state.map(fold).persist(StorageLevel.MEMORY_AND_DISK)

    def close(self) -> None:
        for rdd in (self.state, self.stale):
            if rdd is not None:
                rdd.unpersist()

    def model(self, i: int, rounds: int | None = None) -> BoostedTrees:
        return BoostedTrees(self.features, self.edges, self.base[i], list(self.trees[i][:rounds]), self.settings[i])


def merged_all(parts: list[dict], merged) -> dict:
    total: dict = {}
    for part in parts:
        total = merged(total, part)
    return total


@dataclass
class BoostedTrees:
    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]
    settings: Settings

    def margins(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(bins.shape[1], self.base)
        for tree in self.trees:
            total += tree.apply(bins)
        return total

    def with_probability(self, rows: DataFrame, name: str = "probability") -> DataFrame:
        """``rows`` with the probability of label 1."""
        shared = rows.sparkSession.sparkContext.broadcast(self.to_dict())  # nodes of all trees: no larger with more rows
        at = [rows.columns.index(f) for f in self.features]
        names = [*rows.columns, name]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = BoostedTrees.from_dict(shared.value)
            for batch in batches:
                margin = model.margins(binned(_doubles(batch, at), model.edges)) if at else np.full(batch.num_rows, model.base)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1.0 / (1.0 + np.exp(-margin)))], names=names)

        return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.DoubleType())]))

    def losses(self, rows: DataFrame, label: str = "label") -> list[float]:
        """Mean log loss after each tree, over rows with a label: sums of the tasks, one number a tree."""
        shared = rows.sparkSession.sparkContext.broadcast(self.to_dict())
        picked = rows.filter(F.col(label).isin(0, 1)).select(*self.features, F.col(label).cast("double").alias(label))
        width, trees = len(self.features), len(self.trees)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = BoostedTrees.from_dict(shared.value)
            for batch in batches:
                bins = binned(_doubles(batch, range(width)), model.edges)
                sign = np.where(batch.column(width).to_numpy() == 1, -1.0, 1.0)
                margin, out = np.full(batch.num_rows, model.base), np.zeros(trees)
                for k, tree in enumerate(model.trees):
                    margin += tree.apply(bins)
                    out[k] = np.logaddexp(0.0, sign * margin).sum()
                rows_ = pa.array(np.full(trees, batch.num_rows))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, trees + 1)), pa.array(out), rows_], names=["round", "loss", "n"])

        summed = picked.mapInArrow(run, "round long, loss double, n long").groupBy("round").agg((F.sum("loss") / F.sum("n")).alias("loss"))
        return [r["loss"] for r in summed.orderBy("round").collect()]  # one row a tree

    def importances(self) -> list[float]:
        """Share of each feature in the gains of all splits."""
        total = np.zeros(len(self.features))
        for tree in self.trees:
            np.add.at(total, [f for f in tree.feature if f >= 0], [g for f, g in zip(tree.feature, tree.gain, strict=True) if f >= 0])
        return (total / total.sum() if total.sum() else total).tolist()

    def to_dict(self) -> dict:
        return {"features": self.features, "edges": self.edges, "base": self.base, "trees": [asdict(t) for t in self.trees], "settings": asdict(self.settings)}

    @staticmethod
    def from_dict(found: dict) -> BoostedTrees:
        return BoostedTrees(found["features"], found["edges"], found["base"], [Tree(**t) for t in found["trees"]], Settings(**found["settings"]))

    def save(self, path: str) -> None:
        SparkSession.active().createDataFrame([(json.dumps(self.to_dict()),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(path: str) -> BoostedTrees:
        return BoostedTrees.from_dict(json.loads(SparkSession.active().read.parquet(path).first()["model"]))


def fit(rows: DataFrame, features: Sequence[str], label: str, settings: Settings) -> BoostedTrees:
    booster = Booster(rows, features, label, [settings])
    try:
        booster.grow({0: settings.n_estimators})
        return booster.model(0)
    finally:
        booster.close()
