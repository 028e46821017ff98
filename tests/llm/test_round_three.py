"""Conversation repair, source divergence and suffix-array deduplication against brute force on messy tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shoptrail.llm import conversations, divergence, suffixes

DOCS = "doc_id long, text string, lang string, source string, at long, `key` string, r1 long, runs string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, "x") for r in rows], DOCS).repartition(5)


# -- conversations

LEGAL = {"": "su", "s": "u", "u": "a", "a": "u"}


def best_edits(rows):
    """(cost, audit) by a walk over the rows with the last role as state."""
    states = {"": (0, "")}

    def offer(into, state, value):
        if state not in into or value < into[state]:
            into[state] = value

    def inserted(states):
        made = dict(states)
        for _ in range(3):
            for state, (cost, audit) in list(made.items()):
                for role in "ua":
                    if role in LEGAL[state]:
                        offer(made, role, (cost + 2, audit + "I"))
        return made

    for initial, fault in rows:
        after = {}
        for state, (cost, audit) in inserted(states).items():
            offer(after, state, (cost + 3, audit + "D"))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                for role in LEGAL[state]:
                    if role == initial:
                        offer(after, role, (cost + extra, audit + "K"))
                    if role != "s":
                        offer(after, role, (cost + 2 + extra, audit + "R"))
        states = after
    ends = inserted(states)
    # an untouched start may end, one that was left and came back can't be told apart and costs more
    return min([x for state, x in ends.items() if state == "a"] + ([states[""]] if "" in states else []))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def expected(rows):
    """The report of one conversation's (turn, role, text) in order."""
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = best_edits([(role[:1], f) for (_, role, _), f in zip(rows, found, strict=True)])
    stays = len(audit) - audit.count("D")
    at, lines, system = 0, [], stays % 2
    for edit in audit:
        role = "user" if (len(lines) - system) % 2 == 0 else "assistant"
        if edit == "I":
            lines.append(f"{role}:")
            continue
        if edit != "D":
            lines.append(f"{rows[at][1] if edit == 'K' else role}:{rows[at][2]}")
        at += 1
    initials = [r[1][:1] for r in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: found.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def test_chart_equals_a_walk_over_the_rows():
    rng = random.Random(2)
    for _ in range(400):
        rows = [(rng.choice("suaux"), rng.choice(["", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randint(1, 9))]
        letters = [chr(ord("a") + 3 * min("suax".index(r), 3) + {"": 0, "truncated": 1}.get(f, 2)) for r, f in rows]
        leaves = [conversations.leaf(x) for x in letters]
        assert conversations.answer(conversations.parsed(leaves)) == best_edits(rows)
        cut = rng.randint(1, len(leaves))  # blocks as leaves
        blocks = [conversations.parsed(leaves[i:i + cut]) for i in range(0, len(leaves), cut)]
        assert conversations.answer(conversations.parsed(blocks)) == best_edits(rows)


CONV = "conv_id long, turn long, role string, text string, `key` string, at long, same string, fault string"


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(8)
    rows = []
    for conv in [*range(30), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "What now?", "no stop", " \t\n", "", None, "Ünï — ok!  \n", "one. two", "Fine\u0085", "x" * 3000 + "."])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), role, text))
    rows += [(99, i, "user" if i % 3 else "assistant", f"line {i % 40}" + "." * (i % 2)) for i in range(300)]  # more than one block of blocks
    rows += rows[:6]
    return rows


def in_order(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))

    def place(row):
        return (row[0] is not None, row[0] or 0, hashlib.sha256(f"{len(row[1])}:{row[1]}{row[2]}".encode()).hexdigest())

    return {conv: sorted(own, key=place) for conv, own in by_conv.items()}


def test_conversation_report_and_repair(spark, talks):
    df = spark.createDataFrame([(*r, "k", 1, "s", "f") for r in talks], CONV).repartition(4)
    got = {r["conv_id"]: r.asDict() for r in conversations.report(df).collect()}
    want = in_order(talks)
    assert set(got) == set(want)
    for conv, rows in want.items():
        assert {k: got[conv][k] for k in got[conv] if k != "conv_id"} == expected(rows), conv
    steps = conversations.repair(df).collect()
    for conv, rows in want.items():
        own = sorted((r for r in steps if r["conv_id"] == conv), key=lambda r: r["step"])
        assert "".join(r["edit"] for r in own) == got[conv]["audit"]
        assert [(r["turn"], r["role_before"]) for r in own if r["edit"] != "I"] == [r[:2] for r in rows]
        lines = [f"{r['role']}:{r['text']}" for r in own if r["edit"] != "D"]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == got[conv]["repaired_sha256"]
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in own if r["edit"] != "D"))


def test_damage(spark, talks):
    df = spark.createDataFrame([(*r, "k", 1, "s", "f") for r in talks], CONV)
    rows = []
    for conv, turn, role, text in talks:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fate:
            row = (conv, turn, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
            rows += [row] * (2 if fate == 3 else 1)
    assert Counter(tuple(r) for r in conversations.damaged(df).collect()) == Counter(rows)
    got = {r["conv_id"]: r.asDict() for r in conversations.damage_report(df).collect()}
    want = in_order(rows)
    assert set(got) == {r[0] for r in talks}
    for conv, row in got.items():
        if conv in want:
            assert {k: row[k] for k in row if k != "conv_id"} == expected(want[conv]), conv
        else:
            assert (row["cost"], row["audit"], row["repaired_sha256"]) == (0, "", hashlib.sha256().hexdigest())
    none = spark.createDataFrame([], CONV)
    assert conversations.damage_report(none).count() == conversations.repair(none).count() == 0


# -- divergence


def audited(rows, min_docs=3, top=200):
    docs = [(re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), lang or "", source or "") for t, lang, source in rows]
    out = set()
    for lang in {d[1] for d in docs}:
        own = [d for d in docs if d[1] == lang]
        near = Counter(t for d in own for t in set(d[0]))
        kept = sorted(t for t, n in near.items() if n >= min_docs)
        groups = {s: Counter() for s in {d[2] for d in own}}
        for terms, _, source in own:
            groups[source].update(t for t in terms if near[t] >= min_docs)
        whole = sum(groups.values(), Counter())

        def shares(counts, kept=kept):
            total = sum(counts.values()) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s in groups:
            pair = {o: sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept) for o in groups if o != s}
            term = {t: (p[s][t] - q[t]) ** 2 // q[t] for t in kept if groups[s][t] and p[s][t] > q[t]}
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                order = sorted(found.items(), key=lambda x: (-x[1], x[0].encode()))[:limit]
                out |= {(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(order, 1)}
    return out


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(4)
    words = ["The", "the", "of", "Über", "ß", "漢字", "é x", "a1b", "don't", "😀", "rare"] + [f"w{chr(97 + i)}" for i in range(25)]
    rows = []
    for i in range(160):
        text = rng.choice([" ", "\x00", "_-", "\n"]).join(rng.choice(words[: rng.randint(2, len(words))]) for _ in range(rng.randint(1, 40)))
        rows.append((text, rng.choice(["en", "en", "de", None]), rng.choice([None, "", *[f"s{k}" for k in range(9)]])))
    rows += [("", "en", "none"), (None, "xx", "s1"), ("lonely word", "xx", "s2"), (None, None, None), ("the " * 5000, "en", "s1")]
    return rows + rows[:5]


def test_divergence_equals_brute_force(spark, spoken, monkeypatch):
    df = frame(spark, [(i, *row) for i, row in enumerate(spoken)])
    want = audited(spoken)
    assert {tuple(r) for r in divergence.audit(df).collect()} == want
    monkeypatch.setattr(divergence, "TILE", 4)  # several matrices, sent early
    monkeypatch.setattr(divergence, "HELD_TILES", 2)
    monkeypatch.setattr(divergence, "HELD_TERMS", 10)
    monkeypatch.setattr(divergence, "BLOCK", 64)
    assert {tuple(r) for r in divergence.audit(df, top=3).collect()} == audited(spoken, top=3)
    assert divergence.audit(frame(spark, [(1, "a b", "en", "s")]).limit(0)).count() == 0
    found = divergence.audit(frame(spark, [(1, "a", "en", "s"), (2, "b", "en", "t")])).collect()
    assert sorted(tuple(r)[:5] for r in found) == [
        ("en", "s", "pair", "t", 0), ("en", "t", "pair", "s", 0)]


def test_counts_of_long_texts(monkeypatch):
    rng = random.Random(1)
    text = b"".join(rng.choice([b"Ab", b" ", b"\xc3\xa9", b"1", b"longer"]) for _ in range(3000))
    want = divergence.document_counts(text)
    for piece in (1, 7, 50, 1000):
        monkeypatch.setattr(divergence, "PIECE_BYTES", piece)
        assert divergence.document_counts(text) == want


# -- suffix arrays


def test_maximal_repeats_equal_brute_force():
    rng = random.Random(5)
    for _ in range(120):
        alphabet = b"ab\x00c"[:rng.randint(1, 4)]
        texts = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.5:
            texts.append(texts[0])
        length, places = rng.randint(1, 9), defaultdict(list)
        for i, t in enumerate(texts):
            for a in range(len(t)):
                for b in range(a + length, len(t) + 1):
                    places[t[a:b]].append((i, a))
        want = {}
        for word, own in places.items():
            left = {texts[i][a - 1] if a else ("start", i) for i, a in own}
            right = {texts[i][a + len(word)] if a + len(word) < len(texts[i]) else ("end", i) for i, a in own}
            if len(left) > 1 and len(right) > 1:
                want[word] = sorted(own)
        got = {}
        for size, own in suffixes.maximal_repeats(texts, length):
            i, a = own[0]
            got[texts[i][a:a + size]] = sorted(own)
        assert got == want


def test_runs_over_ranges_and_batches():
    rng = random.Random(6)
    for _ in range(600):
        rows = sorted((rng.randint(0, 4), rng.randint(0, 2), 0, rng.randint(0, 3), 0, rng.randint(0, 2)) for _ in range(rng.randint(0, 30)))
        many = Counter(r[:3] for r in rows)
        several = Counter(k for k, *_ in many)
        bounds = [0, *sorted(rng.randint(0, len(rows)) for _ in range(rng.randint(0, 5))), len(rows)]
        found = []
        for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
            runs = suffixes.Runs(part)
            while a < b:
                step = min(b - a, rng.randint(1, 4))
                if (said := runs.take(np.array(rows[a:a + step], np.int64).reshape(-1, 6))) is not None:
                    found += [tuple(x) for x in said.tolist()]
                a += step
            if (said := runs.take(np.zeros((0, 6), np.int64), end=True)) is not None:
                found += [tuple(x) for x in said.tolist()]
        stitched = suffixes.stitched([f for f in found if f[6] == suffixes.EDGE])
        whole = [f[3:6] + f[:1] for f in found if f[6] == suffixes.WHOLE] + [x[:4] for x in stitched if x[4] == suffixes.WHOLE]
        part = [f[3:6] + f[:1] for f in found if f[6] == suffixes.PART] + [x[:4] for x in stitched if x[4] == suffixes.PART]
        assert set(whole) == {r[3:] + r[:1] for r in rows if many[r[:3]] > 1}
        assert len(part) == sum(several[c[0]] > 1 for c in many)


def cut(texts, length):
    starts = defaultdict(list)
    for i, t in enumerate(texts):
        for a in range(len(t) - length + 1):
            starts[t[a:a + length]].append((i, a))
    gone = [np.zeros(len(t), bool) for t in texts]
    for own in starts.values():
        if len(own) > 1:
            for i, a in own:
                gone[i][a:a + length] = True
    out = []
    for t, g in zip(texts, gone, strict=True):
        spans = int((np.diff(g.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(g.sum()), spans, bytes(b for b, x in zip(t, g, strict=True) if not x)))
    return out


@pytest.mark.parametrize(("length", "group"), [(12, 2), (24, 3), (40, 1000)])
def test_suffix_dedup_equals_brute_force(spark, length, group, monkeypatch):
    rng = random.Random(length)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, other = noise(90), noise(30)
    rows = [(i, noise(rng.randint(0, 60)) + passage + noise(rng.randint(0, 60)), "en", "s") for i in range(25)]  # many surroundings
    rows += [(i, noise(20) + other[rng.randint(0, 9):] + noise(20), "en", "s") for i in range(30, 50)]
    rows += [(60, None, "en", "s"), (61, "", None, None), (62, "short", "en", "s"), (None, passage, "en", "s"), (None, passage, "en", "s")]
    rows += [(63, "a" * 300, "en", "s"), (64, "ab" * 100, "en", "s"), (65, "漢字\x00" * 30, "en", "s"), (66, noise(2000), "en", "s")]
    rows += [rows[0], rows[0], rows[7]]
    monkeypatch.setattr(suffixes, "TEXT_BYTES", 500)
    monkeypatch.setattr(suffixes, "BATCH_BYTES", 300)
    df = frame(spark, rows)
    got = Counter((r["doc_id"], r["text"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffixes.dedup(df, length=length, group=group).collect())
    made = cut([(r[1] or "").encode() for r in rows], length)
    assert got == Counter((r[0], r[1], *m) for r, m in zip(rows, made, strict=True))


def test_suffix_dedup_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert suffixes.dedup(none).columns == [*none.columns, "n_bytes", "n_removed", "n_spans", "kept"]
    assert suffixes.dedup(none).count() == 0
    with pytest.raises(ValueError):
        suffixes.dedup(none, kept="key")
