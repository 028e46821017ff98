"""Substring deduplication with sliding sentence spans.

A text is a run of sentences: they end at a word that ends in ``.``, ``!`` or ``?``, at a line end, and, so that long sentences
and tables have spans too, after words whose hash is a multiple of ``CUT`` (the same words are cut alike wherever they stand). At
every sentence a span starts: the fewest consecutive sentences, at least ``SENTENCES``, that hold at least ``WORDS`` words. So that
passages in mid-sentence are found too, another span of exactly ``PASSAGE`` words starts at every anchor: of any ``NEAR``
neighbouring runs of ``GRAM`` words the one with the smallest hash (the last of equal ones), which depends on nothing outside these.
A passage of ``NEAR - 1 + PASSAGE`` = 47 words or more therefore has an anchor whose span lies inside it, in all its copies. Spans
are hashed over their lower-cased words and joined over all documents; of a repeated span the one in the document with the
smallest key, and there the first, stays, and the words covered by any other are removed: whole sentences, or from an anchor on
``PASSAGE`` words (where these overlap the first, only those after it). A sentence counts as removed when all its words are.

Keys that are no whole numbers are ordered by a hash. Null and empty texts and texts shorter than a span have none and stay as they are; a text that loses all sentences becomes empty
and its row stays. A null key sorts before all others. Rows that repeat a key are one document: equal ones are treated
alike, and a span in several of them counts as one. Texts that lose nothing stay byte for byte; what is left of others is their
remaining words with the white space after each. Other columns are handed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import Powers, lowered, mix, pieces, span_hashes, word_spans

WORDS = 28
SENTENCES = 3
CUT = 10
PASSAGE = 32
NEAR, GRAM = 16, 3
_NULL_KEY = -(1 << 63)


def sentences(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, ...]:
    """Of all sentences of all texts: row, first word and the word after the last; and of each word row, first byte and hash."""
    starts, ends, rows = word_spans(data, offsets)
    if not len(starts):
        return (*[np.zeros(0, np.int64)] * 5, np.zeros(0, np.uint64))
    hashes = span_hashes(lowered(data), starts, ends, powers)
    last = data[ends - 1]
    closes = (last == ord(".")) | (last == ord("!")) | (last == ord("?")) | (hashes % np.uint64(CUT) == 0)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    closes[:-1] |= (rows[1:] != rows[:-1]) | (lines[starts[1:]] > lines[ends[:-1]])
    closes[-1] = True
    after = np.flatnonzero(closes) + 1
    first = np.concatenate([[0], after[:-1]])
    return rows[first], first, after, rows, starts, hashes


def anchors(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The words at which passages start, ascending; all of them have ``PASSAGE`` words of their row from there."""
    grams = len(hashes) - GRAM + 1
    if grams < NEAR:
        return np.zeros(0, np.int64)
    named = np.zeros(grams, np.uint64)
    for k in range(GRAM):
        named = mix(named + hashes[k:k + grams])
    windows = np.lib.stride_tricks.sliding_window_view(named[::-1], NEAR)[::-1]  # backwards, so that the last of equal ones is found
    at = np.arange(len(windows)) + NEAR - 1 - np.argmin(windows, axis=1)
    found = np.unique(at[rows[:len(at)] == rows[NEAR + GRAM - 2:]])
    found = found[found + PASSAGE <= len(rows)]
    return found[rows[found + PASSAGE - 1] == rows[found]]


def spans(row: np.ndarray, first: np.ndarray, after: np.ndarray, rows: np.ndarray, hashes: np.ndarray, powers: Powers) -> tuple[np.ndarray, ...]:
    """First word, word after the last and hash of every span, and whether it starts at an anchor; by first word."""
    if not len(row):
        return *[np.zeros(0, np.int64)] * 2, np.zeros(0, np.uint64), np.zeros(0, bool)
    at = np.arange(len(row))
    end = np.maximum(np.searchsorted(after, first + WORDS), at + SENTENCES - 1)
    fits = end < len(row)
    fits[fits] = row[end[fits]] == row[fits]
    at, end = at[fits], end[fits]
    passage = anchors(rows, hashes)
    lo, hi = np.concatenate([first[at], passage]), np.concatenate([after[end], passage + PASSAGE])
    anchored = np.arange(len(lo)) >= len(at)
    order = np.argsort(lo, kind="stable")
    lo, hi, anchored = lo[order], hi[order], anchored[order]
    powers.reach(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers.up[:len(hashes)], out=total[1:])
    # anchored spans have names of their own: one kind is never the first of the other
    return lo, hi, mix((total[hi] - total[lo]) * powers.down[lo] + anchored.astype(np.uint64)), anchored


def _firsts(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Of each span the first one of its row with the same hash."""
    order = np.lexsort((np.arange(len(row)), hashes, row))
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[order[1:]] != row[order[:-1]]) | (hashes[order[1:]] != hashes[order[:-1]])
    found = np.zeros(len(row), np.int64)
    found[order] = order[np.maximum.accumulate(np.where(fresh, np.arange(len(row)), 0))]
    return found


def span_table(docs: DataFrame) -> DataFrame:
    """(h, key, span): the first of each hash in each row of ``docs`` (__key__, __text__); a span packs its first sentence and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for first_row, last_row, data, offsets in pieces(batch.column(1)):
                row, first, after, rows, _, words = sentences(data, offsets, powers)
                lo, _, hashes, _ = spans(row, first, after, rows, words, powers)
                fresh = _firsts(rows[lo], hashes) == np.arange(len(lo))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[fresh].view(np.int64)), pa.array(keys[first_row:last_row][rows[lo[fresh]]])], names=["h", "key"])

    return docs.select("__key__", "__text__").mapInArrow(run, "h long, key long")


def repeated(docs: DataFrame) -> DataFrame:
    """(key, hashes): of each document the spans that stand in a document with a smaller key; as many as it has sentences and anchors at most."""
    found = span_table(docs)
    # hash aggregates of two numbers combine before the shuffle; a span in one document goes no further
    firsts = found.groupBy("h").agg(F.min("key").alias("__first__"), F.max("key").alias("__last__")).filter("__first__ <> __last__").select("h", "__first__")
    later = found.join(firsts, "h").filter("key <> __first__")
    return later.groupBy("key").agg(F.collect_list("h").alias("__spans__"))


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", counts: tuple[str, str] | None = None) -> DataFrame:
    """``df`` with the texts that are left; ``counts`` names columns for the number of sentences and of removed ones."""
    whole = dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    keyed = df.withColumn("__key__", F.coalesce(F.col(key).cast("bigint") if whole else F.when(F.col(key).isNotNull(), F.xxhash64(key)), F.lit(_NULL_KEY)))
    marks = repeated(keyed.select("__key__", F.col(text).alias("__text__"))).withColumnRenamed("key", "__marked__")
    joined = keyed.join(marks, F.col("__key__") == F.col("__marked__"), "left").select(*df.columns, "__spans__")
    names, extra = df.columns, list(counts or ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            column = batch.column(names.index(text))
            marked = batch.column(len(names))
            left: list[str | None] = column.to_pylist()
            total, removed = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for first_row, last_row, data, offsets in pieces(column):
                row, first, after, rows, start, words = sentences(data, offsets, powers)
                lo, hi, hashes, anchored = spans(row, first, after, rows, words, powers)
                count = np.bincount(row, minlength=last_row - first_row)
                n_words = np.bincount(rows, minlength=last_row - first_row)
                begin = np.cumsum(n_words) - n_words
                here = marked.slice(first_row, last_row - first_row)
                owner = np.repeat(np.arange(len(here)), pc.fill_null(pc.list_value_length(here), 0).to_numpy())
                named = here.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                inside = np.isin(hashes + mix(rows[lo]), named + mix(owner))  # named for this very row
                firsts = _firsts(rows[lo], hashes)
                again = inside | (firsts != np.arange(len(lo)))  # or a repeat inside one text
                lo = np.where(anchored & ~inside, np.maximum(lo, np.where(again, hi[firsts], 0)), lo)
                edges = np.zeros(len(rows) + 1, np.int64)
                np.add.at(edges, lo[again], 1)
                np.add.at(edges, hi[again], -1)
                gone = np.cumsum(edges)[:-1] > 0
                total[first_row:last_row] = count
                before = np.concatenate([[0], np.cumsum(gone)])
                removed[first_row:last_row] = np.bincount(row[before[after] - before[first] == after - first], minlength=len(count))
                for r in np.unique(rows[gone]):
                    own = slice(begin[r], begin[r] + n_words[r])
                    bounds = np.concatenate([[offsets[r]], start[own][1:], [offsets[r + 1]]])
                    turns = np.flatnonzero(np.diff(np.concatenate([[True], gone[own], [True]])))  # kept runs begin and end here
                    parts = [data[bounds[a]:bounds[b]].tobytes() for a, b in zip(turns[::2], turns[1::2], strict=True)]
                    left[first_row + r] = b"".join(parts).decode().rstrip()
            columns = [pa.array(left, pa.string()) if name == text else batch.column(i) for i, name in enumerate(names)]
            numbers = [pa.array(total), pa.array(removed)] if extra else []
            yield pa.RecordBatch.from_arrays([*columns, *numbers], names=[*names, *extra])

    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.LongType()) for c in extra]])
    return joined.mapInArrow(run, schema)
