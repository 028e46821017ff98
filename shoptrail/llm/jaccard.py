"""N-gram Jaccard join: universe partition and pigeonhole, with exact verification.

A document's set holds its distinct shingles of ``n`` words, lower-cased; a shorter document has its whole words as one shingle;
an empty one has none and links with nothing. Two documents link when 100 * |intersection| >= threshold * |union|.

Documents with equal sets form a class, and classes take part in the search once. Linked sets differ in at most
H = (100 - t) / (100 + t) * (|x| + |y|) shingles. The hash universe is cut into segments, in a number fixed for each band of
sizes; sets that differ in at most H places agree on one of any H + 1 segments (pigeonhole). A set is therefore indexed under
its first non-empty segments until they can tell H + 1 differences. A segment's subset is one signature and tells one difference;
where that is cheaper, a segment also gets the subsets with one shingle left out, and tells two. ``allocate`` picks the numbers
of both kinds for each band by their cost: signatures written, and short subsets, which many sets share. Sets near a band's lower edge look
into the band below too. The rare set that hashes too unevenly to fill its quota is also indexed under its empty segments, apart
from all others, so no link is lost.

Signatures that one class has alone drop out in an aggregate. Each other one first proposes its members with its smallest one
(as many pairs as members); linked classes merge, and signatures within one component are done. Of the others, those with at most
``GROUP`` classes propose their remaining pairs. The rest come from passages that many documents share: a link that shows in no
other signature joins two classes of such groups, so these classes alone are indexed again, at the next cost level: shingles that
more than ``GROUP`` of them have are left out of the universe, which only lowers the number of differences, and no signature is
crowded any more. Classes with too few shingles left to tell H + 1 differences are also indexed under each of these: two of them that have
more than H between them and are linked must share one. Those with fewer are, among each other, indexed a third time, under few
large segments and all their one-deletion neighbours. Near copies of one text that are not linked meet there under many signatures.
The one with the fewest rare shingles is next to that text and proposes first, so that those linked with it merge. A pair that is
left is proposed only if it can be linked: two sets that share no rare shingle (those that do have been tried) differ in all of them
and in as many others as one has more, and in as many places as their sketches. No link is lost at any step.

A proposal is checked first on parity sketches: linked sets differ in at most H places, so the exclusive or of their bitmaps has
at most H bits. What is left is verified on the sets.

Null texts are empty. Repeated rows are equal sets. A class is known by a 64-bit hash of its set. Null keys take part, but name no
component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .batches import Powers, lowered, mix, pieces, span_hashes, word_spans
from .components import components

SHINGLE = 4
THRESHOLD = 85
BROADCAST_IDS = 2_000_000
GROUP = 32  # classes under one signature whose pairs are proposed at once
SKETCH_BITS = 1024
ROW_SKETCH = 8  # 64-bit numbers of the smaller sketch that rows of the last index carry
PLAIN, WIDE, RARE = 0, 1, 2  # levels of the index
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                               0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D)]


def shingles(data: np.ndarray, offsets: np.ndarray, powers: Powers, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending, one row after another, and their row."""
    starts, ends, rows = word_spans(data, offsets)
    words = span_hashes(lowered(data), starts, ends, powers)
    count = np.bincount(rows, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    total = max(len(words) - n + 1, 0)
    whole = np.full(total, np.uint64(n) * _ODD[-1])
    for k in range(n):
        whole += words[k:k + total] * _ODD[k % 7] + np.uint64(k // 7)
    fits = rows[:total] == rows[n - 1:n - 1 + total]
    found, owner = mix(whole[fits]), rows[:total][fits]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        single = []
        for r in short:
            value = np.uint64(count[r]) * _ODD[-1]
            for k in range(count[r]):
                value = value + words[first[r] + k] * _ODD[k % 7]
            single.append(value)
        found, owner = np.concatenate([found, mix(np.array(single, np.uint64))]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(len(offsets)))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        found[a:b].sort()
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[fresh], owner[fresh]


def band_edges(top: int, ratio: float = 1.5) -> list[int]:
    """Smallest sizes of the bands up to ``top``, and the one after."""
    edges = [1]
    while edges[-1] <= top:
        edges.append(max(int(edges[-1] * ratio) + 1, edges[-1] + 1))
    return edges


def most_differences(x: int | np.ndarray, y: int | np.ndarray, threshold: int) -> int | np.ndarray:
    return (100 - threshold) * (x + y) // (100 + threshold)


@lru_cache(maxsize=None)
def allocate(low: int, high: int, threshold: int) -> tuple[int, int]:
    """(segments, how many of them also leave one out) for sets of ``low`` to ``high`` shingles, at the least cost."""
    best, chosen = float("inf"), (1, 0)
    ends = [(s, most_differences(s, s * 100 // threshold, threshold) + 1) for s in {low, high, high * 100 // threshold}]
    need = ends[-1][1] if len(ends) == 1 else max(e[1] for e in ends)
    typical = sqrt(low * high)
    wanted = most_differences(int(typical), int(typical) * 100 // threshold, threshold) + 1
    for double in range(0, min(need, 6) + 1):
        for segments in range(max(1, double, (need - double)), 3 * need + 8):
            def told(size: float, count: int = segments, two: int = double) -> tuple[float, float]:
                mean = size / count
                some, single = 1 - exp(-mean), mean * exp(-mean)
                return count * some + two * (some - single), sqrt(count * some * (1 - some)) + 0.5 * sqrt(two)

            if any(told(s)[0] - 3 * told(s)[1] < n for s, n in ends) and segments < 3 * need + 7:
                continue
            mean = typical / segments
            alone = mean * exp(-mean)
            used = min(segments, max(double, wanted - double))
            cost = (double * (1 + mean) + max(used - double, 0)) * (1 + 8 * alone)
            if cost < best:
                best, chosen = cost, (segments, double)
            break  # more segments only make shorter ones
    return chosen


@lru_cache(maxsize=None)
def allocate_wide(low: int, high: int, threshold: int) -> tuple[int, int]:
    """As ``allocate`` where lists are so long that only their number counts: the fewest segments, all with one left out."""
    ends = [(s, most_differences(s, s * 100 // threshold, threshold) + 1) for s in (low, high, high * 100 // threshold)]
    for segments in range(1, 2 * max(n for _, n in ends) + 2):
        for s, n in ends:
            mean = s / segments
            some, single = 1 - exp(-mean), mean * exp(-mean)
            if segments * (2 * some - single) - 4 * sqrt(segments * (1 - some + single)) < n:
                break
        else:
            break
    return segments, segments


def signatures(found: np.ndarray, owner: np.ndarray, rows: int, threshold: int = THRESHOLD, level: int = PLAIN,
               size: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of all rows, their rows, and the rows that tell too few differences.

    ``found`` is what ``shingles`` gives; at level ``RARE`` it holds only a part of each set, whose whole ``size`` is given.
    """
    return _with_wholes(found, owner, rows, threshold, level, size)[:3]


def _with_wholes(found: np.ndarray, owner: np.ndarray, rows: int, threshold: int, level: int,
                 size: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``signatures``, and of each signature the one of its whole segment: its own, unless a shingle is left out."""
    size = np.bincount(owner, minlength=rows) if size is None else size
    nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if not len(size) or not size.max():
        return nothing
    edges = np.array(band_edges(int(size.max())))
    band = np.searchsorted(edges, size, "right") - 1
    own = most_differences(size, size * 100 // threshold, threshold) + 1
    below = edges[np.maximum(band, 0)] - 1  # the largest size of the band below
    looks_down = (band > 0) & (-(-size * threshold // 100) <= below)
    down = most_differences(size, below, threshold) + 1
    parts = []
    for chosen, bands, need in ((size > 0, band, own), (looks_down, band - 1, down)):
        # sets that can't differ at all from a linked one are equal to it, so they need no search
        chosen = chosen & ((need > 1) | looks_down)
        if chosen.any():
            parts.append(_emit(found, owner, chosen, bands, need, edges, threshold, level))
    if not parts:
        return nothing
    found, row, short, whole = (np.concatenate([p[k] for p in parts]) for k in range(4))
    return found, row, np.unique(short), whole


def _plan(low: int, high: int, threshold: int, level: int) -> tuple[int, int]:
    if level == RARE:  # shingles are rare here, so segments may be as small as one
        return 8 * (most_differences(high, high * 100 // threshold, threshold) + 1), 0
    return (allocate_wide if level == WIDE else allocate)(low, high, threshold)


def _emit(found: np.ndarray, owner: np.ndarray, chosen: np.ndarray, bands: np.ndarray, need: np.ndarray, edges: np.ndarray,
          threshold: int, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    plans = np.zeros((len(edges), 2), np.int64)
    for b in np.unique(bands[chosen]):
        plans[b] = _plan(int(edges[b]), int(edges[b + 1]) - 1, threshold, level)
    kept = chosen[owner]
    found, owner = found[kept], owner[kept]
    segments, double = plans[np.maximum(bands, 0), 0], plans[np.maximum(bands, 0), 1]
    out, rows, wholes, row, place, tells = [], [], [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    salt = mix(bands.astype(np.uint64) * _ODD[2] + np.uint64(1 + level))
    if len(found):
        segment = ((found >> np.uint64(32)) * segments[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)  # rises with the hash
        head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (segment[1:] != segment[:-1])]))
        held = np.diff(np.concatenate([head, [len(found)]]))
        row, place = owner[head], segment[head]
        mixed = mix(found ^ _ODD[1])
        total = np.add.reduceat(mixed, head)
        twice = (place < double[row]) & (held > 1)
        tells = np.where(twice, 2, 1)
        before = np.cumsum(tells) - tells
        first = np.concatenate([[True], row[1:] != row[:-1]])
        start = np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
        used = before - before[start] < need[row]
        names = salt[row] + place.astype(np.uint64) * _ODD[3]
        whole = mix(total + mix(names))
        out.append(whole[used])
        rows.append(row[used])
        wholes.append(whole[used])
        leave = np.repeat(used & twice, held)
        if leave.any():
            at = np.repeat(np.arange(len(head)), held)[leave]
            out.append(mix(total[at] - mixed[leave] + mix(names[at])))
            rows.append(row[at])
            wholes.append(whole[at])
    short = np.flatnonzero(chosen & (np.bincount(row, weights=tells, minlength=len(chosen)) < need))
    if level != RARE:
        for r in short:  # too uneven: empty segments too, under names of their own
            empty = np.setdiff1d(np.arange(segments[r]), place[row == r])
            out.append(mix(mix(salt[r] + empty.astype(np.uint64) * _ODD[3]) ^ _ODD[4]))
            rows.append(np.full(len(empty), r))
            wholes.append(out[-1])
    none = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    return np.concatenate(out or none[0]), np.concatenate(rows or none[1]), short, np.concatenate(wholes or none[0])


def _class_of(found: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.bincount(owner, minlength=rows)
    total = np.zeros(rows, np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        total[some] = np.add.reduceat(mix(found), (np.cumsum(size) - size)[some])
    return size, mix(total + size.astype(np.uint64) * _ODD[5])


def _from_text(df: DataFrame, make, keep: list[str], schema: str, n: int) -> DataFrame:
    """``make`` gets hashes of shingles of ``n`` words, their rows and the number of rows, and gives the rows to keep and further columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            text = batch.column(batch.schema.names.index("_text"))
            for first, last, data, offsets in pieces(text):
                found, owner = shingles(data, offsets, powers, n)
                rows, columns = make(found, owner, last - first)
                taken = [batch.column(batch.schema.names.index(c)).slice(first, last - first) for c in keep]
                if rows is not None:
                    taken = [c.take(pa.array(rows)) for c in taken]
                yield pa.RecordBatch.from_arrays([*taken, *columns.values()], names=[*keep, *columns])

    return df.select(*keep, "_text").mapInArrow(run, schema)


def set_table(docs: DataFrame, key_type: str, n: int = SHINGLE) -> DataFrame:
    """(key, row, n_shingles, class) of each row of ``docs`` (_key, _row, _text); an empty set has no class."""

    def make(found, owner, rows):
        size, name = _class_of(found, owner, rows)
        return None, {"n_shingles": pa.array(size), "class": pa.array(name.view(np.int64), mask=size == 0)}

    return _from_text(docs, make, ["_key", "_row"], f"_key {key_type}, _row long, n_shingles long, class long", n)


def signature_table(docs: DataFrame, threshold: int, level: int = PLAIN, n: int = SHINGLE) -> DataFrame:
    """(signature, class) of the sets of ``docs``; at level ``WIDE`` also the signature ``whole`` of the whole segment."""

    def make(found, owner, rows):
        names = _class_of(found, owner, rows)[1]
        signature, row, _, whole = _with_wholes(found, owner, rows, threshold, level)
        columns = {"signature": pa.array(signature.view(np.int64)), "class": pa.array(names[row].view(np.int64))}
        if level == WIDE:
            columns["whole"] = pa.array(whole.view(np.int64))
        return np.zeros(0, np.int64), columns

    return _from_text(docs, make, [], "signature long, class long" + (", whole long" if level == WIDE else ""), n)


def parity_sketches(found: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """A bitmap of each row as 64-bit numbers: a bit is set where an odd number of its shingles falls."""
    made = np.zeros((rows, SKETCH_BITS // 64), np.int64)
    for at in range(0, rows, 1024):  # bounded memory, however short the rows are
        inside = slice(*np.searchsorted(owner, [at, at + 1024]))
        n = min(1024, rows - at)
        place = (owner[inside] - at) * SKETCH_BITS + (found[inside] % np.uint64(SKETCH_BITS)).astype(np.int64)
        odd = (np.bincount(place, minlength=n * SKETCH_BITS) & 1).astype(np.uint8).reshape(n, SKETCH_BITS)
        made[at:at + n] = np.packbits(odd, axis=1).view(np.int64)
    return made


def _sketched(found, owner, count, longs=SKETCH_BITS // 64):
    made = np.bitwise_xor.reduce(parity_sketches(found, owner, count).reshape(count, -1, longs), axis=1)  # parities of fewer, larger places
    return None, {"sketch": pa.FixedSizeListArray.from_arrays(pa.array(made.ravel()), longs).cast(pa.list_(pa.int64()))}


def _bits(x: str, y: str) -> Column:
    """The places where two sketches differ."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, n: total + n)


def _listed(found, owner, count):
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count))]).astype(np.int32))
    return None, {"shingles": pa.ListArray.from_arrays(offsets, pa.array(found.view(np.int64)))}


def rare_signatures(docs: DataFrame, classes: DataFrame, threshold: int, n: int = SHINGLE) -> DataFrame:
    """(signature, class, rare) over the shingles that at most ``GROUP`` of ``docs`` (class, _text) have.

    A class with too few of these has a signature for each, and a row without signature that holds their number.
    """
    held = _from_text(docs, _listed, ["class"], "class long, shingles array<long>", n).select("class", F.explode("shingles").alias("shingle"))
    rare = held.withColumn("n", F.count("*").over(Window.partitionBy("shingle"))).filter(F.col("n") <= GROUP)  # moved once
    left = rare.groupBy("class").agg(F.collect_list("shingle").alias("shingles"))
    whole = docs.select("class").join(classes.select("class", "n_shingles"), "class").join(left, "class", "left")
    whole = whole.select("class", "n_shingles", F.coalesce("shingles", F.array().cast("array<long>")).alias("shingles"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_numpy()
            for at in range(0, len(names), 256):
                part = batch.slice(at, 256)
                lists = part.column(2)
                found = lists.flatten().to_numpy().view(np.uint64).copy()
                ends = lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]
                for a, b in zip(ends[:-1], ends[1:], strict=True):
                    found[a:b].sort()
                owner = np.repeat(np.arange(len(lists)), np.diff(ends))
                signature, row, short = signatures(found, owner, len(lists), threshold, RARE, part.column(1).to_numpy())
                few = np.isin(owner, short)
                values = np.concatenate([signature, mix(found[few] ^ _ODD[6]), np.zeros(len(short), np.uint64)]).view(np.int64)
                rows = np.concatenate([row, owner[few], short])
                missing = np.arange(len(values)) >= len(values) - len(short)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, mask=missing), pa.array(names[at:at + 256][rows]), pa.array(np.diff(ends)[rows].astype(np.int64), mask=~missing)],
                    names=["signature", "class", "rare"])

    return whole.mapInArrow(run, "signature long, class long, rare long")


def _of_classes(docs: DataFrame, sets: DataFrame, names: DataFrame) -> DataFrame:
    """(class, _text): one document of each class in ``names``."""
    rows = sets.join(names, "class").groupBy("class", "_row").count()
    standing = materialize(rows.groupBy("class").agg(F.min("_row").alias("_row"), F.max("count").alias("copies")))
    repeats = not standing.filter("copies > 1").isEmpty()
    if standing.count() <= BROADCAST_IDS:  # 24 bytes each
        standing = standing.hint("broadcast")
    found = docs.join(standing, "_row").select("class", "_text")
    return found.dropDuplicates(["class"]) if repeats else found  # equal rows share their _row


def _both(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """``pairs`` with the column of a as x and of b as y."""
    one = pairs.join(values.select(F.col("class").alias("a"), F.col(column).alias("x")), "a")
    return one.join(values.select(F.col("class").alias("b"), F.col(column).alias("y")), "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, classes: DataFrame, threshold: int, n: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) of classes that are linked, by size, then by sketches, then by the sets themselves."""
    sized = _both(pairs, classes, "n_shingles")
    near = materialize(sized.filter(100 * F.least("x", "y") >= threshold * F.greatest("x", "y")).select(
        "a", "b", F.floor((100 - threshold) * (F.col("x") + F.col("y")) / (100 + threshold)).alias("most")))

    def of(left: DataFrame, make, column: str) -> DataFrame:
        made = _from_text(_of_classes(docs, sets, _ends(left)), make, ["class"], f"class long, {column} array<long>", n)
        return made.groupBy("class").agg(F.first(column).alias(column))

    likely = materialize(_both(near, of(near, _sketched, "sketch"), "sketch").filter(_bits("x", "y") <= F.col("most")).select("a", "b"))
    both = F.size(F.array_intersect("x", "y"))
    exact = _both(likely, of(likely, _listed, "shingles"), "shingles")
    return materialize(exact.filter(100 * both >= threshold * (F.size("x") + F.size("y") - both)).select("a", "b"))


def pairs_left(open_: DataFrame, counts: DataFrame | None = None, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs of classes under one signature that are in different components; ``open_`` has (signature, class, component).

    ``counts`` (class, n_shingles, rare, sketch) leaves out pairs that differ too much: by all their rare shingles, as pairs with a
    rare one in common have been tried, and by as many others as one has more than the other; or by their sketches. Sets that agree on
    a segment also agree on each of its subsets with one left out, so such a pair is proposed by the ``whole`` segment alone.
    """
    def side(end: str) -> DataFrame:
        kept = open_ if counts is None else open_.join(counts, "class")
        more = [F.col(c).alias(c[0] + end) for c in ("n_shingles", "rare", "sketch", "whole")] if counts is not None else []
        return kept.select("signature", F.col("class").alias(end), F.col("component").alias("c" + end), *more)

    fits = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
    if counts is not None:
        differ = F.col("ra") + F.col("rb") + F.abs((F.col("na") - F.col("ra")) - (F.col("nb") - F.col("rb")))
        most = (100 - threshold) * (F.col("na") + F.col("nb"))
        fits = fits & (differ * (100 + threshold) <= most)
        fits = fits & (100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
        fits = fits & ((F.col("wa") != F.col("wb")) | (F.col("signature") == F.col("wa")))
        fits = fits & (_bits("sa", "sb") * (100 + threshold) <= most)
    return side("a").join(side("b"), "signature").filter(fits).select("a", "b").distinct()


def _open(shared: DataFrame, links: DataFrame) -> DataFrame:
    """(signature, class, component, n) of the signatures whose classes are in several components; n counts them."""
    named = components(links)
    placed = shared.join(named, F.col("class") == F.col("node"), "left").select(
        "signature", "class", F.coalesce("component", "class").alias("component"), *[c for c in shared.columns if c == "whole"])
    several = placed.groupBy("signature").agg(
        F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("signature", "n")
    return materialize(placed.join(several, "signature"))


def _shared(found: DataFrame) -> DataFrame:
    """(signature, class, lo) of the signatures that several classes have; lo is the smallest, or the one with the fewest ``rare`` shingles.

    The latter is next to what near copies were made from, so most of them link with it.
    """
    one = Window.partitionBy("signature")  # the rows are by far the most that the search moves, so they move once
    placed = found.withColumn("least", F.min("class").over(one)).withColumn("most", F.max("class").over(one))
    lo = F.min(F.struct("rare", "class")).over(one)["class"] if "rare" in found.columns else F.col("least")
    common = placed.withColumn("lo", lo).filter("least <> most")
    return materialize(common.drop("rare", "least", "most").distinct())


def _stars(shared: DataFrame) -> DataFrame:
    return shared.filter("class <> lo").select(F.least("lo", "class").alias("a"), F.greatest("lo", "class").alias("b")).distinct()


def all_links(base: DataFrame, sets: DataFrame, classes: DataFrame, threshold: int, n: int = SHINGLE) -> DataFrame:
    """Verified links (a, b) of classes that join every two linked classes, directly or over others."""
    tried = links = None
    found, docs = signature_table(base, threshold, n=n), base
    for level in (PLAIN, RARE, WIDE):
        shared = _shared(found)
        stars = materialize(_stars(shared) if tried is None else _stars(shared).join(tried, ["a", "b"], "left_anti"))
        fresh = verified(stars, base, sets, classes, threshold, n)
        tried, links = (stars, fresh) if tried is None else (tried.union(stars), links.union(fresh))
        open_ = _open(shared, links)
        few = open_.filter(F.col("n") <= GROUP) if level == PLAIN else open_
        counts = next_.join(classes.select("class", "n_shingles"), "class").join(sketches, "class") if level == WIDE else None
        rest = materialize(pairs_left(few, counts, threshold).join(tried, ["a", "b"], "left_anti"))
        links = links.union(verified(rest, base, sets, classes, threshold, n))
        tried = tried.union(rest)
        if level == PLAIN:
            next_ = materialize(open_.filter(F.col("n") > GROUP).select("class").distinct())
        elif level == RARE:
            next_ = materialize(marked.filter("signature is null").groupBy("class").agg(F.min("rare").alias("rare")))
        if level == WIDE or next_.isEmpty():
            break
        if level == PLAIN:
            docs = _of_classes(base, sets, next_)
            marked = materialize(rare_signatures(docs, classes, threshold, n))
            found = marked.filter("signature is not null").select("signature", "class")
        else:
            docs = docs.join(next_, "class", "left_semi")
            found = signature_table(docs, threshold, WIDE, n).join(next_, "class")
            sketches = _from_text(docs, partial(_sketched, longs=ROW_SKETCH), ["class"], "class long, sketch array<long>", n)
    return materialize(links)


def placed_rows(docs: DataFrame, key: str, text: str, threshold: int, n: int = SHINGLE) -> DataFrame:
    """(_key, _row, n_shingles, class, component, component_id) of each row; null class and component for an empty set."""
    base = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    base = base.withColumn("_row", F.xxhash64("_key", "_text"))  # equal rows are equal sets
    sets = materialize(set_table(base, dict(docs.dtypes)[key], n))
    classes = materialize(sets.filter("class is not null").groupBy("class").agg(F.min("_key").alias("least"), F.min("n_shingles").alias("n_shingles")))
    named = materialize(components(all_links(base, sets, classes, threshold, n)))
    member = classes.join(named, F.col("class") == F.col("node"), "left").select("class", "least", F.coalesce("component", "class").alias("component"))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    resolved = member.join(least, "component").select(F.col("class").alias("_class"), "component", "component_id")
    return sets.join(resolved, F.col("class") == F.col("_class"), "left").drop("_class")


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, n: int = SHINGLE) -> DataFrame:
    """(key, n_shingles, component_id) of each row: the smallest key reachable by links, its own included."""
    rows = placed_rows(docs, key, text, threshold, n)
    own = F.when(F.col("class").isNull(), F.col("_key")).otherwise(F.col("component_id"))
    return rows.select(F.col("_key").alias(key), "n_shingles", own.alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, n: int = SHINGLE) -> DataFrame:
    """One document of each group of linked ones: the smallest key, null last. Documents without words stay; of equal rows one."""
    rows = materialize(placed_rows(docs, key, text, threshold, n))
    first = rows.filter("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("_key").isNull().alias("last"), "_key", "_row")).alias("first"))
    gone = rows.join(first, "component").filter(F.col("_row") != F.col("first._row")).select("_row").distinct()
    left = docs.withColumn("__row__", F.xxhash64(key, text)).join(gone, F.col("__row__") == F.col("_row"), "left_anti")
    if rows.groupBy("_row").count().filter("count > 1").limit(1).count():
        # rows of one key and text: the same one in every run, limited before the shuffle
        place = F.row_number().over(Window.partitionBy("__row__").orderBy(F.xxhash64(*docs.columns)))
        left = left.withColumn("__place__", place).filter("__place__ = 1")
    return left.select(*docs.columns)
