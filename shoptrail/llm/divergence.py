"""Source divergence audit: how far the words of each source lie from those of every other source of its language.

One ``bytes.translate`` lowers A-Z and blanks every ASCII byte that is no letter, ``bytes.split`` cuts the terms, and a Counter for
each document gives its frequencies; a task adds these up for (language, source, term) and sends one row for each of them, so the
text itself never moves. Terms in at least ``min_docs`` documents of a language are kept. Shares are whole numbers of a billionth,
with one added to every count, and all arithmetic is exact.

A pair of sources is summed sparsely. A term that neither has weighs the same for all such terms; one that only one of them has
depends on its count and on the other's size alone, so a histogram of counts carries these sums; terms in both are corrected term by
term, in tasks that add up small matrices of sources and send only the matrices. A row holds the sources of one term: never more
than a language has, and the result has the square of these anyhow.

Null texts, languages and sources count as empty; an empty language or source is one like any other. Every row is a document, also
a repeated one. Sources without kept terms stay in the pairs, and where a language keeps no term its pairs are 0. Very long texts
are counted a megabyte at a time. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, stored

SCALE = 1_000_000_000
LETTERS = {*range(65, 91), *range(97, 123)}
TABLE = bytes(32 if b < 128 and b not in LETTERS else b + 32 if 65 <= b <= 90 else b for b in range(256))
PIECE_BYTES = 1 << 20
HELD_TERMS = 200_000  # of a task before it sends what it has
TILE = 64  # sources a side of a matrix
HELD_TILES = 256
BLOCK = 1 << 20  # numbers of a step over several terms
BROADCAST_GROUPS = 100_000  # rows of two short strings and four numbers; beyond, the plain join


def document_counts(text: bytes) -> Counter[bytes]:
    """The terms of one text and how often it has each."""
    counts: Counter[bytes] = Counter()
    start = 0
    while start < len(text):
        end = start + PIECE_BYTES
        piece = text[start:end].translate(TABLE)
        if end < len(text) and (cut := piece.rfind(b" ")) >= 0:  # a term longer than a piece is cut nowhere
            piece = piece[:cut]
        elif end < len(text):
            return Counter(text.translate(TABLE).split())
        counts.update(piece.split())
        start += len(piece) or 1
    return counts


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of ``docs`` (text, lang, source), summed over all tasks."""

    def rows(held: dict) -> pa.RecordBatch:
        keys = [(lang, source, len(terms)) for (lang, source), terms in held.items()]
        size = [k for _, _, k in keys]
        terms = [t for own in held.values() for t in own]
        numbers = np.array([e for own in held.values() for e in own.values()], np.int64).reshape(-1, 2)
        index = pa.array(np.repeat(np.arange(len(keys)), size))
        lang, source = (pa.array([k[i] for k in keys], pa.string()).take(index) for i in (0, 1))
        return pa.RecordBatch.from_arrays(
            [lang, source, pa.array(terms, pa.binary()).view(pa.string()), pa.array(numbers[:, 0]), pa.array(numbers[:, 1])],
            names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, list[int]]] = {}
        many = 0
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for text, lang, source in zip(texts, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = held.setdefault((lang, source), {})
                before = len(own)
                for term, n in document_counts(text.as_py()).items():
                    if (entry := own.get(term)) is None:
                        own[term] = [n, 1]
                    else:
                        entry[0] += n
                        entry[1] += 1
                many += len(own) - before
                if many > HELD_TERMS:
                    yield rows(held)
                    held, many = {}, 0
        if many:
            yield rows(held)

    counted = docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), in decimals so that it is exact for any count; null where there is nothing."""
    exact = [c.cast("decimal(20,0)") for c in (n + 1, total + terms)]
    whole = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * exact[0], F.nullif(exact[1], F.lit(0).cast("decimal(20,0)")))
    return whole + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _sides(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, at, total, terms, own, lang_total): every group, numbered inside its language."""
    groups = docs.select("lang", "source").distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    langs = kept.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    joined = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "own", "terms", "lang_total"])
    # the sources of one language; the result has their square
    return materialize(joined.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1))


def shared_terms(rated: DataFrame) -> DataFrame:
    """(lang, a, b, both): of two sources, what terms in both add beyond the sums over each one's own terms."""

    def matrices(lang: str, terms: list[tuple[np.ndarray, np.ndarray, np.ndarray]], held: dict) -> None:
        wide = max(int(at[-1]) for at, _, _ in terms) // TILE + 1
        for left in range(wide):
            for right in range(wide):
                cut = []
                for at, p, p0 in terms:
                    a, b = (slice(*np.searchsorted(at, (t * TILE, t * TILE + TILE))) for t in (left, right))
                    if a.start < a.stop and b.start < b.stop:
                        cut.append(((at[a] - left * TILE, p[a], p0[a]), (at[b] - right * TILE, p[b], p0[b])))
                if not cut:
                    continue
                sides = []
                for side in (0, 1):
                    width = max(int(x[side][0][-1]) for x in cut) + 1
                    row = np.repeat(np.arange(len(cut)), [len(x[side][0]) for x in cut])
                    col = np.concatenate([x[side][0] for x in cut])
                    dense = np.zeros((2, len(cut), width), np.int64)
                    dense[0, row, col] = np.concatenate([x[side][1] for x in cut])
                    dense[1, row, col] = np.concatenate([x[side][2] for x in cut])
                    sides.append(dense)
                p, p0 = sides[0][:, :, :, None]
                q, q0 = sides[1][:, :, None, :]
                both = (p > 0) & (q > 0)
                q, q0 = np.maximum(q, 1), np.maximum(q0, 1)
                part = (p - q) ** 2 // q - (p - q0) ** 2 // q0 - (p0 - q) ** 2 // q + (p0 - q0) ** 2 // q0
                total = held.setdefault((lang, left, right), np.zeros((TILE, TILE), np.int64))
                summed = np.where(both, part, 0).sum(axis=0)
                total[:summed.shape[0], :summed.shape[1]] += summed

    def rows(held: dict) -> pa.RecordBatch:
        lang, a, b, both = [], [], [], []
        for (name, left, right), total in held.items():
            x, y = np.nonzero(total)
            lang += [name] * len(x)
            a.append(x + left * TILE)
            b.append(y + right * TILE)
            both.append(total[x, y])
        columns = [pa.array(np.concatenate(c), pa.int64()) for c in (a, b, both)]
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), *columns], names=["lang", "a", "b", "both"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, int], np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            entries = batch.column(1)
            bounds = entries.offsets.to_numpy() - entries.offsets[0].as_py()
            at, p, p0 = (c.to_numpy() for c in entries.flatten().flatten())
            waiting: dict[str, list] = {}
            for r, lang in enumerate(langs):
                own = slice(bounds[r], bounds[r + 1])
                order = np.argsort(at[own])
                mine = waiting.setdefault(lang, [])
                mine.append((at[own][order], p[own][order], p0[own][order]))
                if len(mine) * TILE * TILE > BLOCK:
                    matrices(lang, waiting.pop(lang), held)
                    if len(held) > HELD_TILES:
                        yield rows(held)
                        held = {}
            for lang, terms in waiting.items():
                matrices(lang, terms, held)
        if held:
            yield rows(held)

    by_term = rated.groupBy("lang", "term").agg(F.collect_list(F.struct("at", "p", "p0")).alias("entries"))
    found = by_term.filter(F.size("entries") > 1).select("lang", "entries").mapInArrow(run, "lang string, a long, b long, both long")
    return found.groupBy("lang", "a", "b").agg(F.sum("both").alias("both"))


def pair_values(rated: DataFrame, sides: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, both ways."""
    p0 = share(F.lit(0), F.col("total"), F.col("terms"))
    ends = sides.select("lang", "source", "at", "own", "terms", p0.alias("p0"))
    same = rated.groupBy("lang", "at", "p").agg(F.count("*").alias("many"))  # terms with one count weigh alike
    bases = ends.select("lang", F.col("p0").alias("base")).distinct()
    against = same.join(bases, "lang").groupBy("lang", "at", "base").agg(
        F.sum(F.col("many") * gap(F.col("p"), F.col("base"))).alias("as_first"),
        F.sum(F.col("many") * gap(F.col("base"), F.col("p"))).alias("as_second"))
    first = ends.select("lang", "source", F.col("at").alias("a"), F.col("own").alias("own_a"), "terms", F.col("p0").alias("base_a"))
    second = ends.select("lang", F.col("source").alias("item"), F.col("at").alias("b"), F.col("own").alias("own_b"), F.col("p0").alias("base_b"))
    pairs = first.join(second, "lang").filter("a <> b")  # the result's own rows
    pairs = pairs.join(against.select("lang", F.col("at").alias("a"), F.col("base").alias("base_b"), "as_first"), ["lang", "a", "base_b"], "left")
    pairs = pairs.join(against.select("lang", F.col("at").alias("b"), F.col("base").alias("base_a"), "as_second"), ["lang", "b", "base_a"], "left")
    pairs = pairs.join(shared_terms(rated), ["lang", "a", "b"], "left").fillna(0, ["as_first", "as_second", "both"])
    neither = (F.col("terms") - F.col("own_a") - F.col("own_b")) * gap(F.col("base_a"), F.col("base_b"))
    value = F.when(F.col("terms") > 0, F.col("as_first") + F.col("as_second") + F.col("both") + neither).otherwise(0)
    return pairs.select("lang", "source", "item", value.cast("bigint").alias("value"))


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 3, top: int = 200,
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other source of the language, part ``term`` the ``top`` terms."""
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    counts = materialize(term_counts(read))
    sums = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("__docs__"))
    kept = stored(counts.join(sums.filter(F.col("__docs__") >= min_docs), ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"))
    sides = _sides(read, kept)
    few = F.broadcast(sides) if sides.count() <= BROADCAST_GROUPS else sides
    rated = kept.join(few, ["lang", "source"]).select(
        "lang", "source", "term", "at",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.lit(0), F.col("total"), F.col("terms")).alias("p0"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = rated.filter("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    terms = over.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)  # limited before the shuffle
    pairs = pair_values(rated, sides).withColumn("rank", F.row_number().over(ranked))
    result = [part.withColumn("part", F.lit(name)).select("lang", "source", "part", "item", "value", "rank") for name, part in (("pair", pairs), ("term", terms))]
    return result[0].unionByName(result[1])
