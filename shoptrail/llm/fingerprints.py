"""Document fingerprints: a homomorphic multiset hash, with DataFrame functions only.

A text is cut into blocks at sentence and line ends (a run without any is cut every ``BLOCK`` characters), blocks are trimmed,
and a text is the multiset of its blocks. A block hashes to a vector, a text's fingerprint is the sum of its blocks' vectors, so
it doesn't depend on their order, equal texts have equal fingerprints, and a block is inserted or deleted by adding or
subtracting its vector (``insert``, ``delete``).

The vector has two parts. ``WIDE`` numbers of 62 bits, summed modulo 2^62, tell texts apart. The others hold the bits of
``SIGNS`` hashes in lanes of 30 bits, two lanes to a number, summed modulo 2^60: a lane counts the blocks whose bit is set. Within
``RUN`` blocks, which lanes of 15 bits can count, four lanes are summed in one number and then spread.
Twice that count less the number of blocks is a sum of random signs, and the products of two texts' sums average to the number of
blocks they share; ``likeness`` is that shared number against the mean of both texts' own, in 0..1.

Null counts as empty; the empty text has the zero vector, and two empty texts have likeness 1, an empty and another 0. Texts are
never cut short. Repeated rows have equal fingerprints. A text of Spark has fewer than 2^30 blocks, so no lane overflows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 48
WIDE = 3
SIGNS = 3
RUN = 32_767  # blocks
_LANES = sum(1 << (15 * i) for i in range(4))
_PAIR, _MASK30 = 1 | 1 << 30, (1 << 30) - 1
_HALVES = 32_767 | 32_767 << 30
_MASK60, _MASK62 = (1 << 60) - 1, (1 << 62) - 1
_N = WIDE + 30 * SIGNS  # then the number of blocks
_N_RUN = WIDE + 15 * SIGNS  # the same within a run
_PATTERN = r"[^.!?\n]{0," + str(BLOCK) + r"}[.!?\n]*\s*"


def blocks(text: Column) -> Column:
    """The trimmed, non-empty blocks of a text."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_PATTERN), F.lit(0))
    return F.filter(F.transform(found, lambda b: F.trim(b)), lambda b: b != "")


def _vector(block: Column) -> list[Column]:
    wide = [F.xxhash64(block, F.lit(k)).bitwiseAND(F.lit(_MASK62)) for k in range(WIDE)]
    hashes = [F.xxhash64(block, F.lit(100 + k)) for k in range(SIGNS)]
    signs = [F.shiftrightunsigned(h, by + i).bitwiseAND(F.lit(_PAIR)) for by in (0, 15) for h in hashes for i in range(15)]
    return [*wide, *signs, F.lit(1).cast("bigint")]


def _masks() -> list[int]:
    return [_MASK62] * WIDE + [_MASK60] * (30 * SIGNS) + [_MASK62]


def fingerprint(text: Column) -> Column:
    """An array of numbers: the sum of the vectors of all blocks."""
    hashed = F.transform(blocks(text), lambda b: F.array(*[F.xxhash64(b, F.lit(k)) for k in range(WIDE)], *[F.xxhash64(b, F.lit(100 + k)) for k in range(SIGNS)]))
    zero = lambda n: F.array_repeat(F.lit(0).cast("bigint"), n + 1)

    def add(total: Column, h: Column) -> Column:
        wide = [(total[k] + h[k].bitwiseAND(F.lit(_MASK62))).bitwiseAND(F.lit(_MASK62)) for k in range(WIDE)]
        signs = [
            total[WIDE + 15 * k + i] + F.shiftrightunsigned(h[WIDE + k], i).bitwiseAND(F.lit(_LANES))
            for k in range(SIGNS) for i in range(15)]
        return F.array(*wide, *signs, total[_N_RUN] + F.lit(1).cast("bigint"))

    def spread(run: Column) -> Column:
        lanes = lambda by: F.transform(F.slice(run, WIDE + 1, 15 * SIGNS), lambda x: F.shiftrightunsigned(x, by).bitwiseAND(F.lit(_HALVES)))
        return F.concat(F.slice(run, 1, WIDE), lanes(0), lanes(15), F.slice(run, _N_RUN + 1, 1))

    def summed(found: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(found), F.lit(1)), F.lit(RUN))
        runs = F.transform(starts, lambda at: F.aggregate(F.slice(found, at, F.lit(RUN)), zero(_N_RUN), add))
        # no lane and no count reaches 62 bits
        return F.aggregate(F.transform(runs, spread), zero(_N), lambda s, r: F.zip_with(s, r, lambda x, y: (x + y).bitwiseAND(F.lit(_MASK62))))

    # a lambda's variable, so that the blocks are hashed once and not for each run
    return F.transform(F.array(hashed), summed)[0]


def _combined(one: Column, other: Column, sign: int) -> Column:
    # no lane of a pair carries or borrows: counts stay below 2^30, and none is larger than the one it is taken from
    masks = F.array(*[F.lit(m).cast("bigint") for m in _masks()])
    return F.zip_with(F.zip_with(one, other, lambda x, y: x + sign * y), masks, lambda x, m: x.bitwiseAND(m))


def insert(fingerprint_: Column, paragraph: Column) -> Column:
    """The fingerprint after one more paragraph, of any number of blocks; null adds nothing."""
    return _combined(fingerprint_, fingerprint(paragraph), 1)


def delete(fingerprint_: Column, paragraph: Column) -> Column:
    """The fingerprint without a paragraph that it holds."""
    return _combined(fingerprint_, fingerprint(paragraph), -1)


def written(fingerprint_: Column) -> Column:
    """The fingerprint as hexadecimal text."""
    return F.concat_ws("-", F.transform(fingerprint_, lambda x: F.lower(F.hex(x))))


def signs(fingerprint_: Column) -> Column:
    """The sums of signs, one for each lane."""
    lanes = F.flatten(F.transform(F.slice(fingerprint_, WIDE + 1, 30 * SIGNS), lambda x: F.array(
        *[F.shiftright(x, 30 * i).bitwiseAND(F.lit(_MASK30)) for i in range(2)])))
    return F.transform(lanes, lambda c: (2 * c - fingerprint_[_N]).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """0 for texts without a common block, 1 for equal fingerprints, up to the noise of the lanes; from fingerprints alone."""
    add = lambda s, x: s + x
    zero = F.lit(0.0)
    both = F.aggregate(F.zip_with(signs(a), signs(b), lambda x, y: x * y), zero, add)
    own = F.aggregate(F.transform(signs(a), lambda x: x * x), zero, add) + F.aggregate(F.transform(signs(b), lambda x: x * x), zero, add)
    return F.when(a == b, 1.0).when(own == 0, 0.0).otherwise(F.greatest(zero, F.least(F.lit(1.0), 2 * both / own)))


def edited(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, fingerprint, edited text, its fingerprint, the next document's fingerprint) for each row.

    The edited text is the text with its last floor(n / 2) code points replaced by the first as many (or all) of the next
    document, in descending order of the key, after the last the first. Null keys are one key below all others. Where a key
    repeats, every row is kept, and the one with the smallest hash of its text stands for the key as next document.
    """
    from ..session import materialize

    # null keys become a flag, so that joins use plain equality; both joins below read one shuffle of the texts
    flag = F.col(key).isNull().cast("int")
    base = df.select(F.col(key).alias("_key"), flag.alias("_null"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    half = F.floor(F.length("_text") / 2).cast("int")
    slim = base.groupBy("_key").agg(F.max(half).alias("_half"), F.min(F.xxhash64("_text")).alias("_stands"))
    order = F.col("_key").desc_nulls_last()
    laid = materialize(slim.repartitionByRange(order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id()))
    # row numbers without gaps: rows before each range, one row for each partition
    ranges = laid.groupBy(F.shiftright("_at", 33).alias("_range")).agg(F.count("*").alias("_rows"))
    before = {r["_range"]: r["_rows"] for r in ranges.collect()}
    total, starts = 0, {}
    for number in sorted(before):
        starts[number] = total
        total += before[number]
    if not total:
        starts = {0: 0}
    offsets = df.sparkSession.createDataFrame([(k, v) for k, v in starts.items()], "_range long, _first long")
    ranked = laid.withColumn("_range", F.shiftright("_at", 33)).join(offsets.hint("broadcast"), "_range").select(
        "_key", "_half", "_stands", (F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("_rank"))
    stand_in = F.lit(0).cast(dict(df.dtypes)[key])
    plain = lambda c, name: F.coalesce(F.col(c), stand_in).alias(name)
    taker = ranked.select(F.col("_key").alias("_taker"), F.col("_half").alias("_need"), F.pmod(F.col("_rank") + 1, F.lit(max(total, 1))).alias("_rank"))
    links = ranked.join(taker, "_rank").select(
        plain("_key", "_k"), F.col("_key").isNull().cast("int").alias("_null"), "_stands",
        plain("_taker", "_tk"), F.col("_taker").isNull().cast("int").alias("_tnull"), "_need")
    laid_texts = base.select(plain("_key", "_k"), "_null", "_text").repartition("_k", "_null")
    given = laid_texts.join(links, ["_k", "_null"]).filter(F.xxhash64("_text").bitwiseXOR(F.col("_stands")) == 0)  # not a join key
    given = given.select("_tk", "_tnull", F.substring("_text", F.lit(1), F.col("_need")).alias("_part"), fingerprint(F.col("_text")).alias("next_fingerprint"))
    given = given.groupBy(F.col("_tk").alias("_k"), F.col("_tnull").alias("_null")).agg(
        F.min("_part").alias("_part"), F.min("next_fingerprint").alias("next_fingerprint"))
    joined = laid_texts.join(given, ["_k", "_null"]).withColumn("_key", F.when(F.col("_null") == 0, F.col("_k")))
    kept = F.length("_text") - half
    made = F.concat(F.substring("_text", F.lit(1), kept), F.substring("_part", F.lit(1), half))
    return joined.select(
        F.col("_key").alias(key), F.col("_text").alias(text), fingerprint(F.col("_text")).alias("fingerprint"),
        made.alias("edited_text"), fingerprint(made).alias("edited_fingerprint"), "next_fingerprint")
