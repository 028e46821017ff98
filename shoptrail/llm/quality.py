"""A quality classifier by co-training.

Two views of a document: the text's content (shares of letters, capitals, digits, marks; repetition of words and pairs of words;
sentence marks) and the page's metadata (source and language, hashed; length; number and length of lines). One logistic model
for each view is fitted on labelled documents. Over ``ROUNDS`` rounds each model labels the unlabelled documents it is surest
of for the other model, in the classes' proportions. Both are then calibrated on labelled documents that neither was fitted on,
and a document's score combines the calibrated views: their evidence beyond the base rate adds up, weighted by a fit on the same
documents.

Labelled and unlabelled documents for fitting are bounded samples (``LABELLED``, ``UNLABELLED``); of them only features reach the
driver. Every document is scored, from its whole text.

Null and empty texts have content features of zero and are scored by the same rule. With no labels, or labels of one class, every
document gets that class (kept without labels). Repeated documents are scored alike. Null source or language counts as a value
of its own. Other columns are handed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import Powers, Shipped, lowered, pieces, span_hashes, word_spans
from .sampling import about

LABELLED = 20_000
UNLABELLED = 20_000
ROUNDS = 4
SURE = 0.05  # share of the pool that a model labels for the other in a round
BUCKETS = 8  # of hashed sources and languages
THRESHOLD = 0.5

CONTENT = ["letters", "other letters", "capitals", "digits", "marks", "space", "pipes", "capital words", "word length", "distinct words",
           "commonest word", "same as before", "distinct pairs", "sentence marks", "words"]
METADATA = ["length", "lines", "line length", "longest line", *[f"source {i}" for i in range(BUCKETS)], *[f"language {i}" for i in range(BUCKETS)]]


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _runs(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the largest number of equal keys of each row."""
    packed = np.sort((rows.astype(np.uint64) << np.uint64(40)) | (keys >> np.uint64(24)))
    if not len(packed):
        return np.zeros(n), np.zeros(n)
    heads = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
    sizes = np.diff(np.concatenate([heads, [len(packed)]]))
    owner = (packed[heads] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, owner, sizes)
    return np.bincount(owner, minlength=n).astype(float), most


def content_and_lines(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Content features and the first four metadata features of all texts."""
    n, size = len(offsets) - 1, np.maximum(np.diff(offsets), 1)
    table = np.zeros((8, 256), bool)
    table[0, [*range(65, 91), *range(97, 123)]] = True
    table[1, 128:] = True
    table[2, 65:91] = True
    table[3, 48:58] = True
    table[4, [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"?-()"]] = True
    table[5, [9, 10, 13, 32]] = True
    table[6, ord("|")] = True
    table[7, [ord(c) for c in ".!?"]] = True
    shares = [_per_row(t[data], offsets) / size for t in table]
    starts, ends, rows = word_spans(data, offsets)
    words = np.bincount(rows, minlength=n).astype(float)
    some = np.maximum(words, 1)
    hashes = span_hashes(lowered(data), starts, ends, powers)
    distinct, most = _runs(hashes, rows, n)
    same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])]) if len(rows) else np.zeros(0, bool)
    pair_rows = rows[1:][rows[1:] == rows[:-1]]
    pairs = (hashes[1:] * np.uint64(31) + hashes[:-1] * np.uint64(17))[rows[1:] == rows[:-1]]
    distinct_pairs, _ = _runs(pairs, pair_rows, n)
    capital = table[2][data[starts]] & table[2][data[np.minimum(starts + 1, ends - 1)]] & (ends - starts > 1)
    content = np.column_stack([
        *shares[:7], np.bincount(rows, weights=capital, minlength=n) / some, np.bincount(rows, weights=ends - starts, minlength=n) / some / 10,
        distinct / some, most / some, np.bincount(rows, weights=same, minlength=n) / some,
        distinct_pairs / np.maximum(words - 1, 1), shares[7] * size / some, np.log1p(words) / 10])
    breaks = np.flatnonzero(data == 10)
    lines = _per_row(data == 10, offsets) + 1.0
    edges = np.unique(np.concatenate([offsets, breaks + 1]))
    longest = np.zeros(n)
    if len(edges) > 1:
        owner = np.searchsorted(offsets, edges[:-1], "right") - 1
        np.maximum.at(longest, np.minimum(owner, n - 1), np.diff(edges))
    return content, np.column_stack([np.log1p(np.diff(offsets)), np.log1p(lines), np.log1p(np.diff(offsets) / lines), np.log1p(longest)]) / 10


def _hashed(column: pa.Array, buckets: int = BUCKETS) -> np.ndarray:
    import zlib

    found = np.zeros((len(column), buckets))
    for i, value in enumerate(column.to_pylist()):
        found[i, zlib.crc32(repr(value).encode()) % buckets] = 1
    return found


def measured(df: DataFrame, keep: list[str], text: str, source: str, lang: str) -> DataFrame:
    """``keep`` and an array of all features, content before metadata."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            at = {name: batch.schema.names.index(name) for name in batch.schema.names}
            for first, last, data, offsets in pieces(batch.column(at["__text__"])):
                content, lines = content_and_lines(data, offsets, powers)
                part = batch.slice(first, last - first)
                found = np.hstack([content, lines, _hashed(part.column(at["__source__"])), _hashed(part.column(at["__lang__"]))])
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*[part.column(at[c]) for c in keep], lists], names=[*keep, "__features__"])

    used = df.select(*keep, F.col(text).alias("__text__"), F.col(source).alias("__source__"), F.col(lang).alias("__lang__"))
    return used.mapInArrow(run, T.StructType([*[df.schema[c] for c in keep], T.StructField("__features__", T.ArrayType(T.DoubleType()))]))


@dataclass
class Logistic:
    """A logistic model on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        design = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        beta, ridge = np.zeros(design.shape[1]), np.diag([penalty] * x.shape[1] + [1e-3])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge, design.T @ (y - p) - ridge @ beta)
            beta += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, beta)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.beta[:-1] + self.beta[-1], -30, 30)


@dataclass
class CoTrained:
    content: Logistic | None
    metadata: Logistic | None
    combined: Logistic | None
    constant: float = 1.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.combined is None:
            return np.full(len(x), self.constant)
        c = len(CONTENT)
        views = np.column_stack([self.content.logit(x[:, :c]), self.metadata.logit(x[:, c:])])
        return 1 / (1 + np.exp(-self.combined.logit(views)))


def cotrain(x: np.ndarray, y: np.ndarray, held: np.ndarray, pool: np.ndarray, rounds: int = ROUNDS) -> CoTrained:
    """``held`` marks the labelled documents kept for calibration; ``pool`` holds the features of unlabelled ones."""
    c = len(CONTENT)
    if not len(y) or y.min() == y.max():
        return CoTrained(None, None, None, float(y[0]) if len(y) else 1.0)
    if len({*y[~held]}) < 2 or len({*y[held]}) < 2:
        held = np.zeros(len(y), bool)  # too few to hold any back
    train, label = x[~held], y[~held]
    views = [slice(0, c), slice(c, x.shape[1])]
    sets = [(train[:, v], label) for v in views]
    open_ = np.ones(len(pool), bool)
    models = [Logistic.fit(*s) for s in sets]
    good = label.mean()
    for _ in range(rounds if len(pool) else 0):
        given = []
        for teacher, v in zip(models, views, strict=True):
            left = np.flatnonzero(open_)
            p = teacher.logit(pool[left][:, v])
            n_good, n_bad = int(SURE * len(pool) * good), int(SURE * len(pool) * (1 - good))
            order = np.argsort(p, kind="stable")
            top, bottom = left[order[len(order) - n_good:]], left[order[:n_bad]]
            top = top[teacher.logit(pool[top][:, v]) > 0]
            bottom = bottom[teacher.logit(pool[bottom][:, v]) < 0]
            given.append((np.concatenate([top, bottom]), np.concatenate([np.ones(len(top)), np.zeros(len(bottom))])))
            open_[given[-1][0]] = False
        for student in (0, 1):
            rows, labels = given[1 - student]
            sets[student] = (np.vstack([sets[student][0], pool[rows][:, views[student]]]), np.concatenate([sets[student][1], labels]))
        models = [Logistic.fit(*s) for s in sets]
    check = held if held.any() else np.ones(len(y), bool)
    logits = np.column_stack([m.logit(x[check][:, v]) for m, v in zip(models, views, strict=True)])
    return CoTrained(models[0], models[1], Logistic.fit(logits, y[check]))


def learn(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          lang: str = "lang", label: str = "quality") -> CoTrained:
    """Fits both views; ``labels`` has the key and 0 or 1, other values are left out. A key with several labels counts as bad if one is."""
    marks = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).cast("double").alias("_label"))
    tagged = documents.select(key, text, source, lang).join(marks, key, "left").withColumn("_at", F.xxhash64(key, F.lit(3)))

    def features(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        got = measured(rows, ["_label", "_at"], text, source, lang).toArrow()
        x = np.array(got.column("__features__").combine_chunks().flatten()).reshape(-1, len(CONTENT) + len(METADATA))
        at = got.column("_at").to_numpy()
        order = np.lexsort((x[:, 0], at))  # the same order in every run
        return x[order], got.column("_label").to_numpy()[order].astype(float), at[order]

    x, y, at = features(about(tagged.filter("_label is not null"), key, LABELLED))
    pool, _, _ = features(about(tagged.filter("_label is null"), key, UNLABELLED))
    return cotrain(x, y, at % 5 == 0, pool)


def score(df: DataFrame, model: CoTrained, text: str = "text", source: str = "source", lang: str = "lang",
          keep: list[str] | None = None, out: str = "quality_score") -> DataFrame:
    """``keep`` (default: all columns) and the probability that the document is good."""
    keep = list(df.columns if keep is None else keep)
    if out in keep:
        raise ValueError(f"column {out} exists")
    shared = Shipped(df, model)  # a few hundred numbers
    numbered = measured(df, keep, text, source, lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.load()
        for batch in batches:
            flat = batch.column(len(keep)).flatten().to_numpy()
            scores = model.scores(flat.reshape(batch.num_rows, -1)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(scores, pa.float64())], names=[*keep, out])

    return numbered.mapInArrow(run, T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier doesn't reject, with the columns they came with."""
    model = learn(docs, labels)
    return score(docs, model).filter(F.col("quality_score") >= threshold).select(*docs.columns)
