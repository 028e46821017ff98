"""Suffix-array deduplication: bytes covered by a string of ``length`` bytes that also starts anywhere else are removed.

Anchors. Of every ``length`` bytes of a text, the run of ``gram`` bytes with the smallest hash is the anchor (the first of equal
ones), which depends on nothing outside these bytes. So equal strings have equal anchors at equal places. Neighbouring strings with
one anchor form a cell; its context is all their bytes, its key the hash of the anchor. A text has a cell for every hundred bytes or
so, and only keys, digests and places of cells are sorted over all documents: in ranges of (key, digest, place), cut anywhere, so a
passage that a third of all documents share is as many ranges as it needs. In that order a cell whose digest stands next to it again
is repeated as a whole, one whose key has other digests may share part of its context, and all others are done with. The ranges'
first and last runs, two rows a range, are put together on the driver.

Suffix arrays. Contexts that may share a part are fetched, one for each digest, and come together by key, in groups of at most
``GROUP``. Over about a megabyte of them a suffix array is built by prefix doubling, with the lengths of common prefixes. A stack scan
gives the tree of common-prefix intervals; an interval of at least ``length`` bytes whose suffixes have different bytes to their left
is a maximal repeat, and all of its occurrences are covered, not only neighbours. Where a key has more contexts than ``GROUP`` (many
documents with one passage and different surroundings), cells are split: into ``step`` strings each, keyed by the bytes that these
have in common, then into single strings, where equal keys are equal strings. Each split goes through the same sort. Every cell ends
in one of the three ways, so nothing is capped.

All of this is judged on the input. Null texts count as empty; matches never cross rows. Rows that agree in everything are documents
of their own, so their strings occur twice. Texts shorter than ``length`` stay as they are; very long ones are cut into
overlapping pieces. What is left may end inside a character, hence it is binary. An empty table gives no rows. Other columns are
handed on; an output column that exists already is refused.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, stored
from .batches import Powers, mix, pieces

LENGTH = 400
REACH = 256  # anchors that a string has to choose from; places of an anchor inside its string fit in ten bits
GROUP = 2_048  # contexts of a key that may meet in a task: about 1.3 MB
BATCH_BYTES = 1 << 20
TEXT_BYTES = 1 << 22
_INDEX = np.uint64((1 << 24) - 1)
CELLS = "key long, c1 long, c2 long, r1 long, r2 long, place long"
WHOLE, PART, EDGE = 0, 1, 2
MANY, SHARED, LAST = 1, 2, 4


def reach_of(length: int) -> int:
    return max(1, min(REACH, (length + 1) // 2))


def packed(at, back, ahead):
    """A cell: its anchor's byte, and how far before it the first and the last of its strings start."""
    return (at << 20) | (back << 10) | ahead


def unpacked(place):
    return place >> 20, (place >> 10) & 1023, place & 1023


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    n = len(values) - width + 1
    rows = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    rows[:len(values)] = values
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def cells_of(data: np.ndarray, ends: np.ndarray, length: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """Of all cells of the texts in ``data`` (``ends``: of the text of each byte): first and last string, anchor, and the anchor's hash."""
    reach = reach_of(length)
    gram = length - reach + 1
    if len(data) < length:
        return *[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64)
    powers.reach(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[:len(data)], out=total[1:])
    grams = len(data) - gram + 1
    hashes = mix((total[gram:] - total[:-gram]) * powers.down[:grams])
    least = _smallest((hashes & ~_INDEX) | np.arange(grams, dtype=np.uint64), reach)
    starts = np.flatnonzero(np.arange(len(least)) + length <= ends[:len(least)])
    anchor = (least[starts] & _INDEX).astype(np.int64)
    fresh = np.flatnonzero(np.diff(anchor, prepend=-1))
    last = np.append(fresh[1:], len(starts)) - 1
    return starts[fresh], starts[last], anchor[fresh], hashes[anchor[fresh]]


def digests(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128 bits of each run of bytes, as two numbers."""
    view = memoryview(data)
    made = [hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return np.frombuffer(b"".join(made), np.int64).reshape(-1, 2)


def first_cells(docs: DataFrame, length: int) -> DataFrame:
    """The cells (``CELLS``) of all texts of ``docs`` (r1, r2, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            own = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
            for row, last_row, data, offsets in pieces(batch.column(2)):
                step = TEXT_BYTES if last_row - row == 1 and len(data) > TEXT_BYTES else len(data)  # a long text is alone
                for begin in range(0, len(data) or 1, step or 1):
                    part = data[begin:begin + step + length - 1]
                    sizes = np.diff(offsets) if step == len(data) else np.array([len(part)])
                    ends = np.repeat(offsets[1:], sizes) if step == len(data) else np.full(len(part), len(part))
                    lo, hi, anchor, keys = cells_of(part, ends, length, powers)
                    if not len(lo):
                        continue
                    owner = np.searchsorted(offsets, lo + begin, "right") - 1
                    marks = digests(part.tobytes(), lo, hi + length)
                    place = packed(anchor + begin - offsets[owner], anchor - lo, anchor - hi)
                    columns = [keys.view(np.int64), marks[:, 0], marks[:, 1], own[row + owner, 0], own[row + owner, 1], place]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "c1", "c2", "r1", "r2", "place"])

    return docs.select("r1", "r2", "text").mapInArrow(run, CELLS)


def split_cells(contexts: DataFrame, length: int, step: int) -> DataFrame:
    """The cells of ``contexts`` (key, r1, r2, place, context) cut to strings with ``step`` places of their anchor, keyed by the bytes these share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r1, r2, place, context in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                at, back, ahead = unpacked(place)
                for low in range(ahead // step * step, back + 1, step):
                    first, last = min(back, low + step - 1), max(ahead, low)
                    shared = context[back - low:back - low - step + 1 + length]
                    key = hashlib.blake2b(shared, digest_size=8, salt=low.to_bytes(8)).digest()
                    whole = hashlib.blake2b(context[back - first:back - last + length], digest_size=16).digest()
                    out.append((key + whole, r1, r2, packed(at, first, last)))
            marks = np.frombuffer(b"".join(x[0] for x in out), np.int64).reshape(-1, 3)
            columns = [*marks.T, *(np.array([x[i] for x in out], np.int64) for i in (1, 2, 3))]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["key", "c1", "c2", "r1", "r2", "place"])

    return contexts.select("r1", "r2", "place", "context").mapInArrow(run, CELLS)


FOUND = CELLS + ", kind int, flags int, part int"
FOUND_NAMES = ["key", "c1", "c2", "r1", "r2", "place", "kind", "flags", "part"]


class Runs:
    """Reads sorted cells batch by batch; holds one row of the run it is in."""

    def __init__(self, part: int) -> None:
        self.part = part
        self.open: np.ndarray | None = None  # first row of the open run
        self.many = self.shared = False  # the open run has several rows; the run before it has its key
        self.first = True  # no run before it

    def take(self, rows: np.ndarray, end: bool = False) -> np.ndarray | None:
        """What is known after ``rows`` (n x 6); at the ``end`` the open run is closed."""
        held = self.open is not None
        if held:
            rows = np.concatenate([self.open[None], rows])
        if not len(rows):
            return None
        change = np.any(rows[1:, :3] != rows[:-1, :3], axis=1)
        begin = np.concatenate([[0], np.flatnonzero(change) + 1])
        size = np.diff(np.append(begin, len(rows)))
        many = size > 1
        same = np.zeros(len(begin) + 1, bool)  # run i has the key of run i - 1
        same[1:-1] = rows[begin[1:], 0] == rows[begin[1:] - 1, 0]
        many[0] |= held and self.many
        same[0] = held and self.shared
        whole = np.repeat(many, size)
        if held and self.many:
            whole[0] = False  # said before
        repeated = np.zeros(len(rows), bool)
        repeated[1:] = np.all(rows[1:, 3:] == rows[:-1, 3:], axis=1) & ~change
        closed = len(begin) if end else len(begin) - 1
        if not end and size[-1] == 1 and not (closed == 0 and held and self.many):
            whole[-1] = False  # not known yet
        shared = same[:-1] | same[1:]
        edge = np.zeros(len(begin), bool)
        edge[0] = self.first
        edge[-1] |= end
        out = [self._said(rows[whole & ~repeated], WHOLE)]
        inner = np.arange(len(begin)) < closed
        out.append(self._said(rows[begin[inner & shared & ~edge]], PART))
        for i in np.flatnonzero(inner & edge):
            flags = MANY * int(many[i]) + SHARED * int(shared[i]) + LAST * int(end and i == len(begin) - 1)
            out.append(self._said(rows[begin[i:i + 1]], EDGE, flags))
        if not end:
            if closed:
                self.first = False
            self.open, self.many, self.shared = rows[begin[-1]].copy(), bool(many[-1]), bool(same[-2])
        return np.concatenate(out)

    def _said(self, rows: np.ndarray, kind: int, flags: int = 0) -> np.ndarray:
        rest = np.empty((len(rows), 3), np.int64)
        rest[:] = kind, flags, self.part
        return np.concatenate([rows, rest], axis=1)


def stitched(edges: list[tuple]) -> list[tuple]:
    """Cells (r1, r2, place, key, kind) that the first and last runs of all ranges stand for, in order of the ranges."""
    runs: list[list] = []
    for row in sorted(edges, key=lambda e: (e[8], e[7] & LAST)):
        flags = row[7]
        if runs and runs[-1][0] == row[:3]:
            runs[-1][1].append(row)
            runs[-1][2] = True
            runs[-1][3] |= bool(flags & SHARED)
        else:
            runs.append([row[:3], [row], bool(flags & MANY), bool(flags & SHARED)])
    found = []
    for i, (name, rows, many, shared) in enumerate(runs):
        near = runs[max(0, i - 1):i] + runs[i + 1:i + 2]
        shared = shared or any(other[0][0] == name[0] for other in near)
        if many:
            found += [(*row[3:6], row[0], WHOLE) for row in rows if not row[7] & MANY]
        if shared:
            found.append((*rows[0][3:6], name[0], PART))
    return found


def judged(cells: DataFrame) -> DataFrame:
    """(r1, r2, place, key, kind): cells that are repeated as a whole (``WHOLE``), and of every digest among several of a key one (``PART``)."""
    order = ["key", "c1", "c2", "r1", "r2", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(TaskContext.get().partitionId())
        for batch in batches:
            yield from said(runs.take(np.stack([c.to_numpy() for c in batch.columns], axis=1)))
        yield from said(runs.take(np.zeros((0, 6), np.int64), end=True))

    def said(rows: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if rows is not None and len(rows):
            columns = [np.ascontiguousarray(rows[:, i]) if i < 6 else rows[:, i].astype(np.int32) for i in range(9)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=FOUND_NAMES)

    found = stored(cells.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, FOUND))
    edges = [tuple(row) for row in found.filter(F.col("kind") == EDGE).collect()]  # two rows a range
    names = ["r1", "r2", "place", "key", "kind"]
    decided = cells.sparkSession.createDataFrame(stitched(edges), "r1 long, r2 long, place long, key long, kind int")
    return found.filter(F.col("kind") != EDGE).select(*names).unionByName(decided)


def fetched(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(key, r1, r2, place, context) of the wanted cells (key, r1, r2, place); a document has no more of them than its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for i in range(batch.num_rows):
                text, entries = texts[i].as_py(), batch.column(3)[i].values
                keys, places = (c.to_numpy() for c in entries.flatten())
                at, back, ahead = unpacked(places)
                parts = [text[a:b] for a, b in zip((at - back).tolist(), (at - ahead + length).tolist(), strict=True)]
                one = [pa.array(np.full(len(keys), batch.column(c)[i].as_py())) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(keys), *one, pa.array(places), pa.array(parts, pa.binary())], names=["key", "r1", "r2", "place", "context"])

    lists = wanted.groupBy("r1", "r2").agg(F.collect_set(F.struct("key", "place")).alias("cells"))
    joined = docs.filter(F.octet_length("text") >= length).join(lists, ["r1", "r2"]).select("r1", "r2", "text", "cells")
    return joined.mapInArrow(run, "key long, r1 long, r2 long, place long, context binary")


_SYMBOLS = 7  # nine bits each in a word; 0 stands for what lies behind the end


def suffix_ranks(data: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 7, 14, 28 ... bytes, until these reach beyond every end; ends are all different."""
    n = len(data)
    index = np.arange(n)
    symbols = np.zeros(n + _SYMBOLS, np.int64)
    symbols[:n] = data.astype(np.int64) + 1
    word = np.zeros(n, np.int64)
    for k in range(_SYMBOLS):
        word = (word << 9) | np.where(index + k < ends, symbols[k:k + n], 0)
    tail = np.where(index + _SYMBOLS > ends, owner + 1, 0)
    order = np.lexsort((tail, word))
    fresh = (np.diff(word[order], prepend=-1) != 0) | (np.diff(tail[order], prepend=-1) != 0)
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(fresh)
    ranks, width, longest = [rank], _SYMBOLS, int((ends - index).max(initial=0))
    while width < longest:
        behind = -1 - owner  # of a suffix that ends before or just here: its own end
        inside = index + width < ends
        behind[inside] = rank[(index + width)[inside]]
        both = rank * (n + 2 + int(owner[-1])) + behind
        order = np.argsort(both, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.diff(both[order], prepend=-1) != 0)
        ranks.append(rank)
        width *= 2
    return ranks


def common_prefixes(ranks: list[np.ndarray], data: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes the suffixes at ``a`` and ``b`` share."""
    n = len(data)
    shared = np.zeros(len(a), np.int64)
    left, right = ends[a], ends[b]
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + shared, b + shared
        fits = (x < left) & (y < right)
        equal = fits & (ranks[k][np.minimum(x, n - 1)] == ranks[k][np.minimum(y, n - 1)])
        shared += np.where(equal, _SYMBOLS << k, 0)
    for _ in range(_SYMBOLS - 1):
        x, y = a + shared, b + shared
        shared += (x < left) & (y < right) & (data[np.minimum(x, n - 1)] == data[np.minimum(y, n - 1)])
    return shared


def interval_tree(shared: list[int], left: list[int], length: int) -> list[tuple[int, int, int]]:
    """(prefix, first, last) of the maximal repeats among sorted suffixes: ``shared[i]`` is what i and i + 1 have in common.

    ``left`` is the byte before each suffix, or a number of its own where there is none. An interval whose suffixes all have the
    same one isn't maximal: it is part of the interval that begins a byte earlier.
    """
    found, stack = [], []  # of open intervals: prefix, first suffix, the left byte of all, None if they differ
    for i, common in enumerate([*shared, 0]):
        first, byte = i, left[i]
        while stack and stack[-1][0] > common:
            prefix, first, own = stack.pop()
            byte = own if own == byte else None
            if byte is None:
                found.append((prefix, first, i))
            if stack and stack[-1][0] >= common:
                stack[-1][2] = byte if stack[-1][2] == byte else None
                byte = stack[-1][2]
        if common >= length:
            if stack and stack[-1][0] == common:
                stack[-1][2] = byte if stack[-1][2] == byte else None
            else:
                stack.append([common, first, byte])
    return found


def maximal_repeats(texts: list[bytes], length: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bytes, occurrences (text, byte)) of every maximal repeat of at least ``length`` bytes."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    ends = (base + sizes)[owner]
    if not len(data):
        return []
    ranks = suffix_ranks(data, ends, owner)
    order = np.argsort(ranks[-1])
    order = order[order + length <= ends[order]]
    if len(order) < 2:
        return []
    shared = common_prefixes(ranks, data, ends, order[:-1], order[1:])
    left = np.where(order > base[owner[order]], data[order - 1].astype(np.int64), -1 - order)
    repeats = []
    near = np.flatnonzero(shared >= length)
    for run in np.split(near, np.flatnonzero(np.diff(near) > 1) + 1):  # stretches without any repeat have no tree
        if len(run):
            own = slice(run[0], run[-1] + 2)
            for prefix, first, last in interval_tree(shared[run].tolist(), left[own].tolist(), length):
                at = order[run[0] + first:run[0] + last + 1]
                repeats.append((prefix, list(zip(owner[at].tolist(), (at - base[owner[at]]).tolist(), strict=True))))
    return repeats


def joined_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (first byte, byte after) put together where they touch."""
    made: list[list[int]] = []
    for a, b in sorted(runs):
        if made and a <= made[-1][1]:
            made[-1][1] = max(made[-1][1], b)
        else:
            made.append([a, b])
    return [tuple(x) for x in made]


def repeated_parts(contexts: DataFrame, length: int) -> DataFrame:
    """(r1, r2, first, after): what the suffix arrays find in ``contexts``; contexts of one key come to one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size, before = 0, None
        for batch in batches:
            for key, *entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if before is not None and key == before[0] and entry[:3] == before[1]:
                    continue  # rows that agree in everything
                if size > BATCH_BYTES and key != before[0]:
                    yield said(held)
                    held, size = [], 0
                before = (key, entry[:3])
                held.append(entry)
                size += len(entry[3])
        if held:
            yield said(held)

    def said(held: list) -> pa.RecordBatch:
        runs: dict[int, list[tuple[int, int]]] = {}
        for prefix, occurrences in maximal_repeats([x[3] for x in held], length):
            for i, at in occurrences:
                runs.setdefault(i, []).append((at, at + prefix))
        out = []
        for i, own in runs.items():
            r1, r2, place, _ = held[i]
            at, back, _ = unpacked(place)
            out += [(r1, r2, at - back + a, at - back + b) for a, b in joined_runs(own)]
        columns = np.array(out, np.int64).reshape(-1, 4).T
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["r1", "r2", "first", "after"])

    laid = contexts.repartition("key").sortWithinPartitions("key", "r1", "r2", "place")
    return laid.select("key", "r1", "r2", "place", "context").mapInArrow(run, "r1 long, r2 long, first long, after long")


def covered(docs: DataFrame, length: int, group: int = GROUP) -> DataFrame:
    """(r1, r2, first, after): runs of bytes of ``docs`` (r1, r2, text) that strings with another start cover; runs may overlap."""
    reach = reach_of(length)
    step = max(2, math.isqrt(reach))
    whole = F.struct((F.shiftright("place", 20) - F.shiftright("place", 10).bitwiseAND(1023)).alias("first"),
                     (F.shiftright("place", 20) - F.col("place").bitwiseAND(1023) + length).alias("after"))
    cells, found, parent = stored(first_cells(docs, length)), [], None
    for width in (step, 1, None):
        verdict = judged(cells)
        discard(cells)
        found.append(verdict.filter(F.col("kind") == WHOLE).select("r1", "r2", whole.alias("run")).select("r1", "r2", "run.*"))
        if width is None:
            break  # equal keys are equal strings here, so no key has several
        parts = verdict.filter(F.col("kind") == PART).select("key", "r1", "r2", "place")
        contexts = stored(fetched(docs, parts, length) if parent is None else _cut(parent, parts, length))
        hot = contexts.groupBy("key").count().filter(F.col("count") > group).select("key")
        found.append(stored(repeated_parts(contexts.join(hot, "key", "left_anti"), length)))
        crowded = contexts.join(hot, "key", "left_semi")
        if crowded.isEmpty():
            break
        parent = crowded
        cells = stored(split_cells(crowded, length, width))
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _cut(contexts: DataFrame, parts: DataFrame, length: int) -> DataFrame:
    """The contexts of ``parts``, out of those of the cells they were split from."""
    at, back, ahead = (lambda c: F.shiftright(c, 20)), (lambda c: F.shiftright(c, 10).bitwiseAND(1023)), (lambda c: F.col(c).bitwiseAND(1023))
    whole = contexts.select("r1", "r2", at("place").alias("at"), back("place").alias("__back__"), ahead("place").alias("__ahead__"), "context")
    named = parts.withColumns({"at": at("place"), "back": back("place"), "ahead": ahead("place")})
    joined = named.join(whole, ["r1", "r2", "at"]).filter("back <= __back__ and ahead >= __ahead__")
    cut = F.substring("context", F.col("__back__") - F.col("back") + 1, F.col("back") - F.col("ahead") + length)
    return joined.select("key", "r1", "r2", "place", cut.alias("context"))


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, kept: str = "kept", group: int = GROUP) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``, the remaining bytes of the text."""
    extra = ["n_bytes", "n_removed", "n_spans", kept]
    if clash := set(extra) & set(df.columns):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    named = df.withColumns({"__text__": F.coalesce(F.col(text).cast("string"), F.lit(""))})
    named = named.withColumns({"__r1__": F.xxhash64("__text__"), "__r2__": F.xxhash64(F.lit(1), F.col(key), F.col("__text__"))})
    docs = named.select(F.col("__r1__").alias("r1"), F.col("__r2__").alias("r2"), F.col("__text__").alias("text"))
    runs = covered(docs, length, group)
    # a document's own runs, no more than it has cells; those of rows that agree in everything collapse before the shuffle
    lists = runs.groupBy("r1", "r2").agg(F.collect_set(F.struct("first", "after")).alias("__runs__"))
    lists = lists.withColumnsRenamed({"r1": "__r1__", "r2": "__r2__"})
    names = [c for c in df.columns if c != text]
    joined = named.join(lists, ["__r1__", "__r2__"], "left").select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`"), "__text__", "__runs__")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(len(names) + 1).cast(pa.binary()), batch.column(len(names) + 2)
            numbers, left = np.zeros((batch.num_rows, 3), np.int64), []
            for i in range(batch.num_rows):
                whole, spans = texts[i].as_py(), lists[i].as_py()
                gone = joined_runs([(s["first"], s["after"]) for s in spans or ()])
                numbers[i] = len(whole), sum(b - a for a, b in gone), len(gone)
                bounds = [0, *[x for pair in gone for x in pair], len(whole)]
                left.append(b"".join(whole[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)))
            columns = [*[batch.column(i) for i in range(len(names) + 1)], *[pa.array(np.ascontiguousarray(c)) for c in numbers.T], pa.array(left, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, text, *extra])

    fields = [*[df.schema[c] for c in [*names, text]], *[T.StructField(c, T.LongType()) for c in extra[:3]], T.StructField(kept, T.BinaryType())]
    return joined.mapInArrow(run, T.StructType(fields)).select(*[F.col(f"`{c}`") for c in df.columns], *extra)
