"""Language identification with a byte convolutional network in numpy.

A text is cut into windows of a fixed number of bytes, A-Z lower-cased, the last one padded with zeros. A window goes through a
byte embedding, filters of several widths, the maximum over all places, a rectifier and a softmax; the text's distribution is
the mean over its windows, weighted by their bytes. Every window of every text is read.

Training runs on the driver over a bounded sample (``DOCUMENTS`` texts of each language, ``WINDOWS`` windows of each), cut to
windows on the executors. For prediction the embedding and the filters fold into tables over pairs of bytes, so a filter is one
or two lookups for each byte.

Null texts and texts without a letter get ``und`` and score 0; with no language to learn from, all texts do. Ties go to the
smaller language name. Repeated rows count as often as they stand in the sample. Other columns are handed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import Shipped, lowered, pieces
from .sampling import about_each

WINDOW = 256
DOCUMENTS = 400
WINDOWS = 6
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
UNKNOWN = "und"


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded windows of all texts, the row of each and the bytes in each; empty texts have none."""
    sizes = np.diff(offsets)
    per_row = -(-sizes // WINDOW)
    rows = np.repeat(np.arange(len(sizes)), per_row)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    starts = offsets[rows] + nth * WINDOW
    used = np.minimum(WINDOW, offsets[rows + 1] - starts)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    found = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts]
    short = used < WINDOW
    found[short] *= (np.arange(WINDOW) < used[short, None]).astype(np.uint8)
    return found, rows, used


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]  # by width: (width * EMBEDDING, FILTERS)
    biases: list[np.ndarray]
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> list[tuple[int, np.ndarray, np.ndarray | None]]:
        """For each width the response of its filters to the first two bytes, and to the one or two after them."""
        made = []
        for width, weights, bias in zip(WIDTHS, self.filters, self.biases, strict=True):
            single = [self.embedding @ weights[k * EMBEDDING:(k + 1) * EMBEDDING] for k in range(width)]
            double = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(-1, FILTERS)
            head = np.ascontiguousarray((double(single[0], single[1]) + bias).T.astype(np.float32))
            tail = None if width == 2 else single[2] if width == 3 else double(single[2], single[3])
            made.append((width, head, None if tail is None else np.ascontiguousarray(tail.T.astype(np.float32))))
        return made

    def probabilities(self, found: np.ndarray, tables: list) -> np.ndarray:
        pooled = np.empty((len(found), len(WIDTHS) * FILTERS), np.float32)
        codes = found.astype(np.intp)
        pairs = codes[:, :-1] * 256 + codes[:, 1:]
        for k, (width, head, tail) in enumerate(tables):
            places = WINDOW - width + 1
            first = np.ascontiguousarray(pairs[:, :places])
            second = None if tail is None else np.ascontiguousarray(codes[:, 2:] if width == 3 else pairs[:, 2:])
            for f in range(FILTERS):
                response = head[f].take(first)
                if second is not None:
                    response += tail[f].take(second)
                response.max(axis=1, out=pooled[:, k * FILTERS + f])
        return softmax(np.maximum(pooled, 0) @ self.dense + self.dense_bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(found: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 6, seed: int = 7) -> Network:
    """Adam on the cross entropy; the maximum passes its gradient to the place it was taken from."""
    rng = np.random.default_rng(seed)
    total = len(WIDTHS) * FILTERS
    net = Network(
        languages, rng.normal(0, 0.5, (256, EMBEDDING)),
        [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)) for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS], rng.normal(0, 0.3, (total, len(languages))), np.zeros(len(languages)))
    weights = [net.embedding, *net.filters, *net.biases, net.dense, net.dense_bias]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    share = np.bincount(labels, minlength=len(languages)) / len(labels)
    balance = 1 / np.maximum(share, 1e-9)[labels] / len(languages)
    for epoch in range(epochs):
        order = rng.permutation(len(found))
        for at in range(0, len(order), 64):
            chosen = order[at:at + 64]
            bytes_, n = found[chosen].astype(np.intp), len(chosen)
            vectors = net.embedding[bytes_]
            pooled, where = [], []
            for k, width in enumerate(WIDTHS):
                places = WINDOW - width + 1
                response = sum(vectors[:, j:j + places] @ net.filters[k][j * EMBEDDING:(j + 1) * EMBEDDING] for j in range(width))
                best = response.argmax(axis=1)
                where.append(best)
                pooled.append(np.take_along_axis(response, best[:, None, :], 1)[:, 0] + net.biases[k])
            hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
            error = softmax(hidden @ net.dense + net.dense_bias)
            error[np.arange(n), labels[chosen]] -= 1
            error *= (balance[chosen] / n)[:, None]
            back = (error @ net.dense.T) * (hidden > 0)
            grads = [np.zeros_like(w) for w in weights]
            grads[-2], grads[-1] = hidden.T @ error, error.sum(axis=0)
            for k, width in enumerate(WIDTHS):
                g = back[:, k * FILTERS:(k + 1) * FILTERS]
                grads[1 + len(WIDTHS) + k] = g.sum(axis=0)
                for j in range(width):
                    seen = np.take_along_axis(bytes_, where[k] + j, 1)
                    part = net.filters[k][j * EMBEDDING:(j + 1) * EMBEDDING]
                    grads[1 + k][j * EMBEDDING:(j + 1) * EMBEDDING] = np.einsum("nfe,nf->ef", net.embedding[seen], g)
                    np.add.at(grads[0], seen, g[:, :, None] * part.T[None])
            step += 1
            rate = 0.01 * (0.3 if epoch >= epochs - 2 else 1)
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def train(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Network | None:
    """A network from the texts with a language; None without any."""
    labelled = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    labelled = labelled.filter(F.col("_lang").isNotNull() & (F.length("_text") > 0))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in pieces(batch.column(0)):
                found, rows, _ = windows(lowered(data), offsets)
                per_row = np.bincount(rows, minlength=last - first)
                nth = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
                step = np.maximum(per_row / WINDOWS, 1)[rows]
                kept = np.flatnonzero(np.floor(nth / step) != np.floor((nth - 1) / step))
                take = pa.array(first + rows[kept])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes() for x in found[kept]], pa.binary()), batch.column(1).take(take), batch.column(2).take(take)],
                    names=["window", "lang", "at"])

    sample = about_each(labelled, "_key", "_lang", DOCUMENTS)
    got = sample.select("_text", "_lang", F.xxhash64("_key", "_text").alias("at")).mapInArrow(cut, "window binary, lang string, at long").toArrow()
    if not got.num_rows:
        return None
    got = got.sort_by([("at", "ascending"), ("window", "ascending"), ("lang", "ascending")])  # the same order in every run
    names = got.column("lang").to_pylist()
    languages = sorted(set(names))
    found = np.frombuffer(b"".join(got.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW)
    return fit(found, np.array([languages.index(x) for x in names]), languages)


def predict(df: DataFrame, net: Network | None, text: str = "text", keep: list[str] | None = None,
            out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` (default: all columns), the predicted language and its probability."""
    keep = list(df.columns if keep is None else keep)
    if set(out) & set(keep):
        raise ValueError(f"a column of {out} exists")
    if net is None:
        return df.select(*keep, F.lit(UNKNOWN).alias(out[0]), F.lit(0.0).alias(out[1]))
    shared = Shipped(df, net)  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.load()
        tables = net.tables()
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            names, scores = [], []
            for first, last, data, offsets in pieces(column):
                found, rows, used = windows(lowered(data), offsets)
                weighted = np.zeros((last - first, len(net.languages)))
                for at in range(0, len(found), 1024):
                    part = slice(at, at + 1024)
                    shares = net.probabilities(found[part], tables) * used[part, None]
                    low = rows[part][0]
                    each = [np.bincount(rows[part] - low, weights=shares[:, j]) for j in range(shares.shape[1])]
                    weighted[low:low + len(each[0])] += np.stack(each, axis=1)
                sizes = np.maximum(np.diff(offsets), 1)
                best = weighted.argmax(axis=1)
                for i, value in enumerate(column.slice(first, last - first).to_pylist()):
                    known = value is not None and next((True for c in value if c.isalpha()), False)
                    names.append(net.languages[best[i]] if known else UNKNOWN)
                    scores.append(float(min(1.0, weighted[i, best[i]] / sizes[i])) if known else 0.0)
            columns = [batch.column(batch.schema.names.index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, *out])

    fields = [df.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField(out[0], T.StringType()), T.StructField(out[1], T.DoubleType())])
    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)
