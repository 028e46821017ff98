"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols: insult (a lexicon of words and word beginnings learned from labels), threat, target, negation, reported
speech. Five small transducers are composed into one table: it walks through the symbols of a clause, remembers whether a
negation or a reporting word came shortly before and whether somebody is addressed, and at each insult or threat emits one of
the arcs in ``ARCS``. A text's features are, for each arc, the strongest and the summed weight over its clauses; a logistic
model fitted on labelled texts gives the arcs their weights, so that labels decide how far negation or reporting excuse.

The lexicon comes from counts of words and beginnings over labelled texts (each distinct text once): entries that stand in toxic
texts far beyond chance and hardly elsewhere, taken until every toxic text is explained ``COVER`` times. The labelled
texts are a bounded sample (``LABELLED``); every text is scored, whole.

Null and empty texts have no clause and get the score of a text without matches; without toxic or without clean labels that
score is the share of toxic ones (0 without labels). Scores lie in 0..1. Repeated rows are scored alike, repeated label rows of a
text count once. Other columns are handed on.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import Shipped
from .sampling import about

LABELLED = 20_000
COVER = 6
BEGINNINGS = (3, 4, 5, 6)
MAX_ENTRIES = 5_000
STRONG, WEAK = 10.0, 5.0  # log likelihood of an entry's texts against chance
LEAST = 3  # texts an entry has to explain

# fixed values: closed word classes of English, German, French and Spanish
THREAT = "kill hurt destroy murder beat burn shoot stab töten umbringen schlagen tuer tuerai frapper matar golpear".split()
TARGET = "you your yours u they them him her dich dir euch du ihr toi tu vous te ti usted ustedes".split()
NEGATION = "not never no don't isn't aren't wasn't nicht kein keine nie pas jamais nunca ni".split()
REPORT = "said says wrote called reported quoted claims sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()
REACH = 4  # words over which negation and reporting hold

ARCS = ["insult", "aimed insult", "negated insult", "reported insult", "threat"]

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n]+")
_START_OK = re.compile(r"[^\W\d_]")


@dataclass
class Grammar:
    words: dict[str, float]  # whole words and their weight
    beginnings: dict[str, float]
    coefficients: np.ndarray
    base: float
    intercept: float = 0.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for entry in {*self.words, *self.beginnings, *THREAT}:
            found.add_word(entry, len(entry))
        found.make_automaton()
        return found


def symbols_of(grammar: Grammar, word: str) -> tuple[str, float] | None:
    if (weight := grammar.words.get(word)) is not None:
        return "insult", weight
    for size in BEGINNINGS:
        if (weight := grammar.beginnings.get(word[:size])) is not None and len(word) >= size:
            return "insult", weight
    for name, words in (("threat", THREAT), ("target", TARGET), ("negation", NEGATION), ("report", REPORT)):
        if word in words:
            return name, 1.0
    return None


@dataclass(frozen=True)
class Transducer:
    """A letter-to-letter transducer: for (state, input) the possible (output, next state)."""

    starts: frozenset
    finals: frozenset
    arcs: dict

    def compose(self, other: Transducer) -> Transducer:
        """Reads what this one reads and writes what ``other`` makes of its output."""
        arcs: dict = {}
        starts = frozenset((p, q) for p in self.starts for q in other.starts)
        todo, seen = list(starts), set(starts)
        letters = {letter for _, letter in self.arcs}
        while todo:
            p, q = todo.pop()
            for letter in letters:
                found = [(out, (p_next, q_next)) for middle, p_next in self.arcs.get((p, letter), ()) for out, q_next in other.arcs.get((q, middle), ())]
                if found:
                    arcs[(p, q), letter] = found
                for _, state in found:
                    if state not in seen:
                        seen.add(state)
                        todo.append(state)
        return Transducer(starts, frozenset((p, q) for p, q in seen if p in self.finals and q in other.finals), arcs)


LETTERS = ["", "insult", "threat", "target", "negation", "report"]  # what a word may be; "" is any other word


def _reach(opens: str, covers: dict[str, str], letters: list[str]) -> Transducer:
    """Rewrites the letters in ``covers`` for as long as the last ``opens`` reaches; states count down."""
    arcs = {}
    for state in range(REACH + 1):
        left = max(state - 1, 0)
        for letter in letters:
            arcs[state, letter] = [("", REACH)] if letter == opens else [(covers[letter] if left and letter in covers else letter, left)]
    return Transducer(frozenset([0]), frozenset(range(REACH + 1)), arcs)


def _target(letters: list[str]) -> Transducer:
    """Guesses whether the clause has a target and is right at its end: insults are aimed and threats count only then."""
    arcs = {}
    for state in ("none", "unseen", "seen"):
        for letter in letters:
            if letter == "target":
                found = [] if state == "none" else [("", "seen")]
            elif state == "none":
                found = [("" if letter == "threat" else letter, state)]
            else:
                found = [("aimed insult" if letter == "insult" else letter, state)]
            if found:
                arcs[state, letter] = found
    return Transducer(frozenset(["none", "unseen"]), frozenset(["none", "seen"]), arcs)


def _writes(named: set[str], letters: list[str], others: set[str]) -> Transducer:
    """Keeps the letters in ``named`` as emissions, hands ``others`` on and blanks the rest."""
    return Transducer(frozenset([0]), frozenset([0]), {(0, x): [(x if x in named | others else "", 0)] for x in letters})


def parts() -> list[Transducer]:
    """Negation, reported speech, target, insult and threat, in the order in which they are composed."""
    after_negation = ["", "insult", "negated insult", "threat", "target", "report"]
    after_report = ["", "insult", "negated insult", "reported insult", "threat", "target"]
    after_target = ["", "insult", "aimed insult", "negated insult", "reported insult", "threat"]
    insults = set(ARCS) - {"threat"}
    return [
        _reach("negation", {"insult": "negated insult", "threat": ""}, LETTERS),
        _reach("report", {"insult": "reported insult"}, after_negation),
        _target(after_report),
        _writes(insults, after_target, {"threat"}),
        _writes({"threat"}, after_target, insults),
    ]


@dataclass(frozen=True)
class Table:
    """The composed transducer as rows: for each state and letter the next state and the arc it emits, -1 for none."""

    starts: list[int]
    finals: frozenset
    next: list[list[int]]
    emit: list[list[int]]

    @classmethod
    def of(cls, machine: Transducer) -> Table:
        states = sorted({*machine.starts, *[t for found in machine.arcs.values() for _, t in found]}, key=repr)
        number = {state: i for i, state in enumerate(states)}
        following, emits = ([[-1] * len(LETTERS) for _ in states] for _ in range(2))
        for (state, letter), found in machine.arcs.items():
            (out, to), = found  # after its guess at the start, the machine has one way to go
            following[number[state]][LETTERS.index(letter)] = number[to]
            emits[number[state]][LETTERS.index(letter)] = ARCS.index(out) if out else -1
        return cls([number[s] for s in sorted(machine.starts, key=repr)], frozenset(number[s] for s in machine.finals), following, emits)

    def run(self, letters: list[int], weights: list[float]) -> np.ndarray:
        """The summed weight of each arc along the one accepted path."""
        for state in self.starts:
            emitted = np.zeros(len(ARCS))
            for letter, weight in zip(letters, weights, strict=True):
                if (arc := self.emit[state][letter]) >= 0:
                    emitted[arc] += weight
                if (state := self.next[state][letter]) < 0:
                    break
            if state in self.finals:
                return emitted
        raise AssertionError("no path")


def composed() -> Table:
    machine, *others = parts()
    for other in others:
        machine = machine.compose(other)
    return Table.of(machine)


TABLE = composed()


def walk(grammar: Grammar, clause: str) -> np.ndarray:
    """What the composed transducer emits for one clause: the summed weight of each arc."""
    read = [symbols_of(grammar, w) or ("", 0.0) for w in _WORD.findall(clause)]
    return TABLE.run([LETTERS.index(name) for name, _ in read], [weight for _, weight in read])


def features(grammar: Grammar, automaton, text: str | None) -> np.ndarray:
    """Strongest and summed weight of each arc; only clauses around a match of the automaton are walked."""
    found = np.zeros(2 * len(ARCS))
    if not text or not len(automaton):
        return found
    lower, done = text.lower(), -1
    for last, size in automaton.iter(lower):
        start = last - size + 1
        if start < done or start and _START_OK.match(lower[start - 1]):
            continue
        begin = max((lower.rfind(mark, 0, start) for mark in ".!?;:\n"), default=-1) + 1
        end = _CLAUSE.search(lower, last)
        done = end.start() if end else len(lower)
        emitted = walk(grammar, lower[begin:done])
        found[:len(ARCS)] = np.maximum(found[:len(ARCS)], emitted)
        found[len(ARCS):] += emitted
    return np.log1p(found)


def entries_of(text: str) -> set[str]:
    """Words as they are, beginnings with a star."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:k] + "*" for w in words for k in BEGINNINGS if len(w) >= k}


def choose(counts: dict[str, tuple[int, int]], toxic_texts: list[set[str]], clean: int) -> dict[str, float]:
    """Entries beyond chance, the ones that explain most first, until every text is explained ``COVER`` times.

    Texts that nothing explains then get a second round with weaker evidence, once each.
    """
    toxic = len(toxic_texts)
    rate = toxic / max(toxic + clean, 1)
    gains, weights = {}, {}
    for entry, (with_toxic, with_clean) in counts.items():
        n = with_toxic + with_clean
        share = with_toxic / n
        gain = with_toxic * np.log(share / rate) + (with_clean * np.log((1 - share) / (1 - rate)) if with_clean else 0)
        if share > 0.9 and gain > WEAK:
            gains[entry] = gain
            weights[entry] = float(np.log((with_toxic + 0.5) / (with_clean + 0.5) * (clean + 1) / (toxic + 1)))
    where: dict[str, list[int]] = {}
    for i, t in enumerate(toxic_texts):
        for entry in t & gains.keys():
            where.setdefault(entry, []).append(i)
    chosen: dict[str, float] = {}
    seen = np.zeros(toxic, int)
    for evidence, times in ((STRONG, COVER), (WEAK, 1)):
        heap = [(-len(at), -counts[e][0], -len(e), e) for e, at in where.items() if gains[e] > evidence and e not in chosen]
        heapq.heapify(heap)
        while heap and len(chosen) < MAX_ENTRIES:
            known, *rest, entry = heapq.heappop(heap)
            still = int((seen[where[entry]] < times).sum())
            if still < LEAST:
                continue
            if still < -known:  # counts only fall, so a stale one goes back to its place
                heapq.heappush(heap, (-still, *rest, entry))
                continue
            chosen[entry] = weights[entry]
            seen[where[entry]] += 1
    return chosen


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    design = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(design.shape[1])
    ridge = np.diag([penalty] * x.shape[1] + [1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge, design.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta[:-1], float(beta[-1])


def learn(df: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> Grammar:
    """A grammar from texts labelled 0 or 1; other labels and null texts are left out."""
    labelled = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(label).cast("int").alias("_label"))
    labelled = labelled.filter(F.col("_label").isin(0, 1) & F.col("_text").isNotNull())
    labelled = about(labelled, "_key", LABELLED)
    labelled = labelled.groupBy(F.xxhash64("_text").alias("_at")).agg(F.max("_label").alias("_label"), F.first("_text").alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[Counter] = [Counter(), Counter()]
        texts = [0, 0]

        def out():
            names = sorted({*sums[0], *sums[1]})
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([sums[1][n] for n in names], pa.int64()), pa.array([sums[0][n] for n in names], pa.int64())],
                names=["entry", "toxic", "clean"])

        for batch in batches:
            for value, marked in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True):
                sums[marked].update(entries_of(value))
                texts[marked] += 1
                if len(sums[0]) + len(sums[1]) > 300_000:
                    yield out()
                    sums = [Counter(), Counter()]
        sums[1][""], sums[0][""] = texts[1], texts[0]
        yield out()

    counted = labelled.select("_label", "_text").mapInArrow(count, "entry string, toxic long, clean long")
    counted = counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = counted.filter((F.col("entry") == "") | ((F.col("toxic") >= 3) & (F.col("toxic") > 9 * F.col("clean"))))
    counts = {r["entry"]: (r["toxic"], r["clean"]) for r in counted.collect()}  # of a bounded sample
    toxic, clean = counts.pop("", (0, 0))
    if not toxic or not clean:
        return Grammar({}, {}, np.zeros(2 * len(ARCS)), toxic / max(toxic + clean, 1))
    likely = df.sparkSession.sparkContext.broadcast(frozenset(counts))

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(entries_of(v) & likely.value) for v in batch.column(0).to_pylist()], pa.list_(pa.string()))], names=["entries"])

    marked = labelled.filter("_label = 1").select("_text").mapInArrow(matched, "entries array<string>").collect()
    chosen = choose(counts, [set(r["entries"]) for r in marked], clean)
    grammar = Grammar(
        {e: w for e, w in chosen.items() if e[-1] != "*"}, {e[:-1]: w for e, w in chosen.items() if e[-1] == "*"},
        np.zeros(2 * len(ARCS)), toxic / (toxic + clean))
    if not chosen:
        return grammar
    shared = Shipped(df, grammar)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = shared.load()
        automaton = grammar.automaton()
        for batch in batches:
            found = [features(grammar, automaton, v).tolist() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["label", "found"])

    rows = labelled.select("_label", "_text").mapInArrow(measure, "label int, found array<double>").toPandas()
    rows = rows.assign(order=[tuple(x) for x in rows["found"]]).sort_values(["label", "order"])  # sums in one order
    grammar.coefficients, grammar.intercept = _logistic(np.stack(rows["found"].to_list()), rows["label"].to_numpy(float), 0.05)
    grammar.base = float(1 / (1 + np.exp(-grammar.intercept)))
    return grammar


def score(df: DataFrame, grammar: Grammar, text: str = "text", keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """``keep`` (default: all columns) and the score of the text."""
    keep = list(df.columns if keep is None else keep)
    if out in keep:
        raise ValueError(f"column {out} exists")
    shared = Shipped(df, grammar)  # at most MAX_ENTRIES entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = shared.load()
        automaton = grammar.automaton()
        for batch in batches:
            scores = []
            for value in batch.column(batch.schema.names.index(text)).to_pylist():
                found = features(grammar, automaton, value)
                raised = float(1 / (1 + np.exp(-(found @ grammar.coefficients + grammar.intercept)))) if found.any() else grammar.base
                scores.append(min(1.0, max(0.0, raised)))
            columns = [batch.column(batch.schema.names.index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=[*keep, out])

    fields = [df.schema[c] for c in keep]
    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, T.StructType([*fields, T.StructField(out, T.DoubleType())]))
