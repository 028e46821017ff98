"""Operators of the training-data package against brute force, the tokenizers library and planted cases, on messy tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shoptrail.llm import bpe, fingerprints, jaccard, langid, mixing, neighbours, quality, queries, substrings, toxicity, urls
from shoptrail.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `list` string, class long, h string, words int, `key` string"
LETTERS = {"en": "the of and with these over", "de": "nicht der schön über weiß für"}


def prose(rng, lang="en", n=60):
    base = LETTERS[lang].split()
    made = ["".join(rng.choice(base) for _ in range(rng.randint(1, 2))) + rng.choice(["", "", "", ".", ","]) for _ in range(n)]
    return " ".join(made)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    made = {i: prose(rng, "de" if i % 3 == 0 else "en", rng.randint(5, 120)) for i in range(1, 40)}
    made[40] = made[1]  # exact copies
    made[41] = made[1]
    long = made[2].split()
    made[42] = made[2].replace(long[0], "changed", 1)  # a near copy
    passage = prose(rng, "en", 70)
    for i in (50, 51, 52):
        made[i] = prose(rng, "en", 30) + ".\n" + passage + ".\n" + prose(rng, "en", 30)
    made[60], made[61], made[62], made[63] = "", None, "two words", " \n\t "
    made[64] = "word " * 30_000  # a very long text
    made[65] = "x" * 5_000
    made[66] = "Ünïcode — 漢字 😀 <|endoftext|> it's  spaced out\r\n"
    return made


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None if i % 7 == 0 else ("de" if i % 3 == 0 else "en"), None if i % 11 == 0 else f"s{i % 3}", None, "a", 1, "b", 2, "c")
            for i, t in texts.items()]
    rows += [rows[0], (None, "a row without a key that says some words", "en", "s1", 1, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe_equals_the_tokenizers_library(spark, docs):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    library = Tokenizer.from_file(path)
    encoded = bpe.encode(docs, path)
    assert encoded.columns == [*docs.columns, "ids"]
    for row in bpe.decode(encoded, path, text="decoded").collect():
        want = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == want
        assert row["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(empty(spark), path).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs, path, ids="class")


def test_bpe_words_by_all_three_ways():
    v = bpe.Vocabulary(queries.tokenizer_path())
    rng = random.Random(1)
    words = [bytes(rng.choice(b"aeiounrst ing-\xc3\xa9") for _ in range(rng.randint(1, 40))) for _ in range(500)] + [b"ab" * 400]
    nodes, counts = v.encode_words(words)
    ends = np.cumsum(counts)
    for word, a, b in zip(words, ends - counts, ends, strict=True):
        assert list(nodes[a:b]) == v.merge_long(word)


def sets_of(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 4]) for k in range(len(words) - 3)}


def brute_components(texts):
    made, up = {i: sets_of(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(made)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            same = len(made[a] & made[b])
            if same and 100 * same >= 85 * len(made[a] | made[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(made[i]), find(i)) for i in ids}


def test_jaccard_equals_brute_force(spark, docs, texts):
    rows = jaccard.linked(docs).collect()
    assert len(rows) == len(texts) + 2
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None}
    assert got == brute_components(texts)
    assert got[41][1] == 1 and got[60] == (0, 60) and got[61] == (0, 61)
    assert jaccard.linked(empty(spark)).count() == 0


@pytest.mark.parametrize("group", [32, 3])  # 3: most groups go to the second index
def test_jaccard_chain_and_many_near_copies(spark, monkeypatch, group):
    monkeypatch.setattr(jaccard, "GROUP", group)
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts, current = {}, list(words)
    for i in range(25):  # each differs from the one before; the ends don't link
        current[i * 12:i * 12 + 3] = [f"x{i}"] * 3
        texts[100 - i] = " ".join(current)
    for i in range(200, 260):
        near = list(words)
        near[rng.randrange(400)] = f"y{i}"
        texts[i] = " ".join(near)
    for i in range(300, 340):  # a shared passage alone is no link
        texts[i] = " ".join(words[:60] + [f"z{rng.randrange(10**6)}" for _ in range(150)])
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked(frame).collect()}
    assert got == brute_components(texts)


def test_signatures_lose_no_link():
    rng = np.random.default_rng(4)
    seen = 0
    for _ in range(400):
        size = int(np.exp(rng.uniform(np.log(4), np.log(400))))
        a = rng.integers(0, 2**63, size).astype(np.uint64)
        b = np.concatenate([a[rng.integers(0, size // 8 + 1):], rng.integers(0, 2**63, rng.integers(0, size // 8 + 1)).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if not len(b) or np.array_equal(a, b) or 100 * len(np.intersect1d(a, b)) < 85 * len(np.union1d(a, b)):
            continue
        seen += 1
        both, which = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
        for level in (jaccard.PLAIN, jaccard.WIDE):
            found, row, _ = jaccard.signatures(both, which, 2, level=level)
            assert set(found[row == 0]) & set(found[row == 1])
        x, y = jaccard.parity_sketches(both, which, 2)
        bits = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b)) <= jaccard.most_differences(len(a), len(b), 85)
    assert seen > 50


def test_keep_one(spark, docs, texts):
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    want = {c for _, c in brute_components(texts).values()}
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ids.count(None) == 1


def test_components(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (7, 7), (100, 102)] + [(500, i) for i in range(501, 560)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100, **{i: 500 for i in range(500, 560)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_substrings_catch_passages_and_leave_the_rest(spark, docs, texts):
    rows = substrings.dedup(docs, counts=("n_sentences", "n_removed")).collect()
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert len(rows) == len(texts) + 2 and rows[0].__fields__[:-2] == docs.columns
    assert got[50]["text"] == texts[50] and got[50]["n_removed"] == 0
    for i in (51, 52):
        assert got[i]["n_removed"] > 0 and len(got[i]["text"].split()) < 90
    assert all(got[i]["text"] == texts[i] for i in range(3, 40))
    assert got[61]["text"] is None and got[60]["text"] == "" and len(got[40]["text"].split()) <= max(0, len(texts[40].split()) - 28)
    assert substrings.dedup(empty(spark)).count() == 0


def test_substrings_keep_rows_of_one_key_apart(spark):
    rng = random.Random(5)
    shared, own = prose(rng, "en", 80), prose(rng, "de", 80)
    frame = spark.createDataFrame([(1, shared), (2, shared), (2, own)], "doc_id long, text string")
    left = sorted(r["text"] for r in substrings.dedup(frame).collect())
    assert own in left and shared in left and len(min(left, key=len)) < 60


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def test_url_rules_and_trees(spark):
    rng = random.Random(2)
    rows = [(i, f"http://{'www.' if i % 2 else ''}{rng.choice(['cheap-pills', 'casino-win']) if i % 4 == 0 else 'ths' + str(i % 9)}.example.org/en/{i}", 7)
            for i in range(200)]
    rows += [(900, None, 7), (901, "no scheme", 7), (902, "HTTP://WWW.Example.COM/en/x?y=/z", 7), (903, "http://a.b.net/es/1#/q", 7),
             (904, "http://notexample.com/en/1", 7), (905, "http://example.com", 7), (906, "http://é.com/ÉA?b", 7), (907, "http://example.com/en/", 7)]
    frame = spark.createDataFrame(rows, "page_id long, url string, _bad int")
    model = urls.train(frame.select("url", urls.listed_label(urls.host_of(F.col("url"))).alias("label")))
    got = {r["page_id"]: r for r in urls.judge(frame, model, RULES, keep=["page_id", "_bad"]).collect()}
    assert len(got) == len(rows)
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in (902, 903, 904, 907)] == [
        ("www.example.com", "/en/x", "www.example.com/en/", "allow"), ("a.b.net", "/es/1", "net/es/", "block"),
        ("notexample.com", "/en/1", "com/", "allow"), ("example.com", "/en/", "example.com/en/", "block")]
    assert got[900]["host"] == got[901]["host"] == got[901]["path"] == "" and got[905]["path"] == "" and got[906]["host"] == "é.com"
    assert all((got[i]["verdict"] == "block") == (i % 4 == 0) for i in range(200))
    nothing = urls.train(spark.createDataFrame([], "url string, label int"))
    assert {r["verdict"] for r in urls.judge(frame.filter("page_id < 9"), nothing, []).collect()} == {"allow"}


def brute_neighbours(rows, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for q, x in good:
        if q % 50 == 0:
            scored = sorted((-round(float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)), 12), i) for i, y in good if i != q)
            yield q, [i for _, i in scored[:k]]


def test_neighbours_exact_when_small(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # equal vectors
    rows += [(700, None), (701, [0.0] * 8), (702, [None] + [1.0] * 7), (703, [float("nan")] * 8), (704, [1.0]), (750, [float("inf")] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {}
    for r in neighbours.search(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == dict(brute_neighbours([r for r in rows if r[0] != 704]))
    few = spark.createDataFrame(rows[:3], frame.schema)
    assert neighbours.search(few, F.col("vec_id") == 0).count() == 2
    assert neighbours.search(spark.createDataFrame([], frame.schema), F.col("vec_id") == 0).count() == 0


def test_neighbour_recall_with_many_lists(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    rows = [(int(i), [float(x) for x in (centres[rng.integers(30)] + 0.6 * rng.normal(size=16)).astype(np.float32)]) for i in range(3000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {}
    for r in neighbours.search(frame, F.col("vec_id") % 50 == 0).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = dict(brute_neighbours(rows))
    assert sum(len(found[q] & set(v)) for q, v in want.items()) >= 0.95 * 5 * len(want)


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        lang = "de" if i % 3 == 0 else "en"
        text = prose(rng, lang, rng.randint(20, 90))
        bad, toxic = i % 5 == 0, i % 6 == 1
        if bad:
            text = " | ".join(text.split()) if i % 2 else " ".join([text.split()[0]] * 80)
        if toxic:
            words = text.split()
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "loweia", "loweich", "loweium"]))
            text = " ".join(words)
        rows.append((i, text, lang, f"s{i % 4}", len(text)))
        labels.append((i, 0 if bad else 1, 1 if toxic else 0))
    rows += [(1000, None, None, None, None), (1001, "", "en", "s1", 0), (1002, "1234 -- !!", "en", "s1", 9), rows[0]]
    labels += [(1000, None, None), (None, 1, 0), (0, 0, 0)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).cache(),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache())


def test_quality_keeps_good_and_drops_bad(spark, judged):
    docs, labels = judged
    kept = {r["doc_id"] for r in quality.keep_good(docs, labels).collect()}
    good = {i for i in range(600) if i % 5}
    assert len(kept & good) >= 0.98 * len(good) and len(kept & (set(range(600)) - good)) <= 6
    none = quality.learn(docs, labels.filter("false"))
    assert quality.score(docs, none).filter("quality_score = 1").count() == docs.count()
    assert quality.score(docs.filter("false"), none).count() == 0


def test_toxicity_held_out(spark, judged):
    docs, labels = judged
    seen = docs.join(labels.select("doc_id", "toxic"), "doc_id").filter("doc_id % 4 <> 0")
    grammar = toxicity.learn(seen)
    assert "idiot" in grammar.words or any("idiot".startswith(b) for b in grammar.beginnings)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, grammar).collect()}
    assert all((got[i] >= 0.5) == (i % 6 == 1) for i in range(600))
    assert 0 <= got[1000] < 0.5 and 0 <= got[1001] < 0.5
    nothing = toxicity.learn(seen.filter("false"))
    assert toxicity.score(docs, nothing).filter("score = 0").count() == docs.count()
    assert toxicity.score(docs.filter("false"), grammar).count() == 0


def test_grammar_walks_clauses():
    grammar = toxicity.Grammar({"fool": 2.0}, {"lowe": 1.0}, np.zeros(10), 0.1)
    arcs = dict(zip(toxicity.ARCS, range(5), strict=True))
    assert toxicity.walk(grammar, "a fool here")[arcs["insult"]] == 2
    assert toxicity.walk(grammar, "you fool")[arcs["aimed insult"]] == 2
    assert toxicity.walk(grammar, "he is not a fool")[arcs["negated insult"]] == 2
    assert toxicity.walk(grammar, "they said lowei")[arcs["reported insult"]] == 1
    assert toxicity.walk(grammar, "i will kill you")[arcs["threat"]] == 1 and not toxicity.walk(grammar, "kill the lights").any()
    found = toxicity.features(grammar, grammar.automaton(), "A fool. Another sentence; fools match nothing; lowebatt is.")
    assert found[arcs["insult"]] > 0 and found[5 + arcs["insult"]] == pytest.approx(np.log1p(3))


def test_language_held_out(spark, judged):
    docs, _ = judged
    net = langid.train(docs.filter("doc_id % 4 <> 2"))
    got = {r["doc_id"]: r for r in langid.predict(docs, net).collect()}
    held = [i for i in range(600) if i % 4 == 2]
    assert sum(got[i]["lang_pred"] == got[i]["lang"] for i in held) >= 0.97 * len(held)
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1000]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.train(docs.filter("false")) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}


def test_network_tables_equal_the_convolution():
    rng = np.random.default_rng(3)
    found = rng.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    net = langid.fit(found, np.array([0, 1, 0, 1, 0]), ["a", "b"], epochs=1)
    vectors, pooled = net.embedding[found], []
    for width, weights, bias in zip(langid.WIDTHS, net.filters, net.biases, strict=True):
        places = langid.WINDOW - width + 1
        pooled.append((np.concatenate([vectors[:, j:j + places] for j in range(width)], axis=2) @ weights + bias).max(axis=1))
    want = langid.softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ net.dense + net.dense_bias)
    assert np.allclose(net.probabilities(found, net.tables()), want, atol=1e-4)


def test_fingerprints(spark, docs, texts):
    rows = fingerprints.edited(docs).collect()
    assert len(rows) == len(texts) + 2
    by_id = {r["doc_id"]: r for r in rows}
    order = [*sorted(texts, reverse=True), None]
    full = {**{i: t or "" for i, t in texts.items()}, None: "a row without a key that says some words"}
    for at, i in enumerate(order):
        following, half = full[order[(at + 1) % len(order)]], len(full[i]) // 2
        assert by_id[i]["edited_text"] == full[i][:len(full[i]) - half] + following[:half]
        assert by_id[i]["next_fingerprint"] == by_id[order[(at + 1) % len(order)]]["fingerprint"]
    assert by_id[40]["fingerprint"] == by_id[1]["fingerprint"] != by_id[2]["fingerprint"]
    assert fingerprints.edited(empty(spark)).count() == 0
    one = fingerprints.edited(docs.filter("doc_id = 5")).collect()
    assert len(one) == 1 and one[0]["next_fingerprint"] == one[0]["fingerprint"]


def test_fingerprints_add_and_take_away(spark):
    frame = spark.createDataFrame([("One here.\nTwo there! Three.", "Three. One here.\nTwo there!", "One here.\nThree.")], "a string, b string, c string")
    f = {c: fingerprints.fingerprint(F.col(c)) for c in "abc"}
    row = frame.select(
        (f["a"] == f["b"]).alias("order"), (fingerprints.insert(f["c"], F.lit("Two there!")) == f["a"]).alias("added"),
        (fingerprints.delete(f["a"], F.lit("Two there!")) == f["c"]).alias("taken"), fingerprints.likeness(f["a"], f["c"]).alias("near")).first()
    assert row["order"] and row["added"] and row["taken"] and 0.5 < row["near"] < 1


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not over:
            return {**target, **{s: weight[s] * level for s in open_}}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing(spark, docs):
    sized = docs.select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    rows = mixing.mix(sized, ["doc_id"]).collect()
    assert len(rows) == docs.count() and all(0 <= r["copies"] <= 3 for r in rows)
    sizes = Counter()
    for r in sized.collect():
        sizes[r["source"]] += r["size"]
    want, taken = brute_targets(sizes), Counter()
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["copies"] * r["size"]
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(sized, ["doc_id"]).collect()), key=str)
    assert mixing.mix(sized.filter("false"), ["doc_id"]).count() == 0


def test_mixing_meets_targets_with_a_hot_group(spark):
    rng = random.Random(8)
    rows = [(i, "hot" if i % 3 else f"s{i % 5}", 40 if i % 2 else rng.randint(1, 400)) for i in range(6000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long"), ["doc_id"]).groupBy("source").agg(
        F.first("target").alias("target"), F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()
    assert all(abs(r["taken"] / r["target"] - 1) < 0.005 for r in got)


def test_mixed_repeats_rows(spark, docs):
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and 0 < mixed.count() <= 3 * docs.count()
    assert mixing.mixed(empty(spark)).count() == 0


def test_queries_and_contract_columns(spark):
    folder = "/root/testdata/sf0.001"
    got = queries.QUERIES["op8_fingerprints"](spark, folder)
    assert dict(got.dtypes)["near_next"] == "double"
    for r in got.filter("doc_id < 20").collect():
        assert 0 <= r["near_edited"] <= 1 and len(r["edited_sha256"]) == 64
    sample = queries.QUERIES["op1_bpe"](spark, folder).filter("doc_id < 20").collect()
    assert all(r["n_tokens"] > 0 and len(r["ids_sha256"]) == len(r["decoded_sha256"]) == 64 for r in sample)
    held = queries.QUERIES["op10_langid"](spark, folder).select("doc_id", "held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in held)


def test_pipeline_stages(spark, judged, tmp_path):
    docs, labels = judged
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "source_mix", "tokens"]
    current, path = spark.read.parquet(str(tmp_path / "documents.parquet")), queries.tokenizer_path()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, current, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        current = spark.read.parquet(str(tmp_path / name))
    last = corpus_pipeline.STAGES[-1][1](spark, current, str(tmp_path))
    want = sorted((r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in current.collect())
    decoded = bpe.decode(last, path, text="text").select("doc_id", F.sha2("text", 256).alias("s"))
    assert sorted((r["doc_id"], r["s"]) for r in decoded.collect()) == want
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r["doc_id"] for r in ran.select("doc_id").collect()) == [i for i, _ in want]


@pytest.mark.parametrize("group", [32, 4])
def test_jaccard_with_a_passage_that_fills_most_of_many_texts(spark, monkeypatch, group):
    monkeypatch.setattr(jaccard, "GROUP", group)
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(300)]
    texts = {}
    for i in range(40):  # alike, but not linked: each has 45 words of its own
        texts[i] = " ".join(passage + [f"a{rng.randrange(10**7)}" for _ in range(45)])
    for i in range(100, 112):  # linked: few words of their own
        texts[i] = " ".join(passage + [f"b{rng.randrange(10**7)}" for _ in range(15 + i % 5)])
    for i in range(200, 206):  # linked with one of the first, over words of its own
        texts[i] = texts[i - 200] + f" c{i}"
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked(frame).collect()}
    assert got == brute_components(texts)


def test_pipeline_links_from_four_fifths_of_five_words(spark):
    rng = random.Random(12)
    texts = {2 * i: [f"w{rng.randrange(10**7)}" for _ in range(200 + 20 * i)] for i in range(1, 11)}
    for i in range(2, 22, 2):  # words added: the Jaccard of 5 words is 0.82, of 4 words too
        texts[i + 1] = texts[i] + [f"x{rng.randrange(10**7)}" for _ in range(round((len(texts[i]) - 4) * (1 / 0.82 - 1)))]
    texts[100] = texts[2] + [f"y{rng.randrange(10**7)}" for _ in range(62)]  # 0.76
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, frame, "").collect()}
    assert kept == {*range(2, 22, 2), 100}
    assert jaccard.keep_one(frame).count() == len(texts)
    five = [{tuple(t[k:k + 5]) for k in range(len(t) - 4)} for t in (texts[2], texts[3])]
    assert 0.8 < len(five[0] & five[1]) / len(five[0] | five[1]) < 0.85
    sizes = {r["doc_id"]: r["n_shingles"] for r in jaccard.linked(frame, n=5, threshold=80).collect()}
    assert all(sizes[i] == len(t) - 4 for i, t in texts.items())


def test_signatures_lose_no_link_at_four_fifths():
    rng = np.random.default_rng(14)
    seen = 0
    for _ in range(400):
        size = int(np.exp(rng.uniform(np.log(4), np.log(400))))
        a = rng.integers(0, 2**63, size).astype(np.uint64)
        b = np.concatenate([a[rng.integers(0, size // 6 + 1):], rng.integers(0, 2**63, rng.integers(0, size // 6 + 1)).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if not len(b) or np.array_equal(a, b) or 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
            continue
        seen += 1
        both, which = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
        for level in (jaccard.PLAIN, jaccard.WIDE):
            found, row, _ = jaccard.signatures(both, which, 2, threshold=80, level=level)
            assert set(found[row == 0]) & set(found[row == 1])
    assert seen > 50


def test_fingerprints_of_very_long_texts(spark):
    lines = ["".join(f"{name}{i}\n" for i in range(100_000)) for name in ("a", "b")]
    frame = spark.createDataFrame([(*lines, lines[0] + "b7\n", "b7\n" + lines[0])], "a string, b string, more string, first string")
    f = {c: fingerprints.fingerprint(F.col(c)) for c in frame.columns}
    made = frame.select(*[f[c].alias(c) for c in f]).select(
        fingerprints.likeness(F.col("a"), F.col("b")).alias("other"), fingerprints.likeness(F.col("a"), F.col("more")).alias("near"),
        (F.col("more") == F.col("first")).alias("order"), (fingerprints.insert(F.col("a"), F.lit("b7\n")) == F.col("more")).alias("added"),
        (fingerprints.delete(F.col("more"), F.lit("b7\n")) == F.col("a")).alias("taken"), fingerprints.signs(F.col("a")).alias("signs")).first()
    assert made["other"] < 0.3 and made["near"] > 0.95
    assert made["order"] and made["added"] and made["taken"]
    assert len(made["signs"]) == 180 and max(map(abs, made["signs"])) < 5 * 100_000 ** 0.5


def test_url_suffixes_count_all_labelled_urls(spark, monkeypatch):
    monkeypatch.setattr(urls, "LABELLED", 400)
    rows = [(f"http://h{i}.{'rare' + str(i) if i % 20 == 0 else 'com' if i % 2 else 'org'}/{i}", int(i % 2 == 0)) for i in range(2000)]
    model = urls.train(spark.createDataFrame(rows, "url string, label int"), trees=2, depth=2)
    got = {r["_suffix"]: (r["suffix_rows"], r["suffix_bad"]) for r in model.suffixes.collect()}
    assert len(got) == 102 and model.share == 0.5
    assert got["com"] == pytest.approx((np.log1p(1000), 10 / 1020)) and got["rare40"] == pytest.approx((np.log1p(1), 11 / 21))
    unseen = spark.createDataFrame([("http://a.unseen/", "unseen")], "_url string, s string")
    assembled = urls._assembled(urls.lexical(unseen, "_url"), model).first()
    assert (assembled["suffix_rows"], assembled["suffix_bad"]) == (0.0, 0.5)


def test_substrings_find_passages_in_mid_sentence(spark):
    rng = random.Random(15)
    made = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    rows, own = [], {}
    for k in range(60):
        passage = made(51 + k % 10)
        for i in (2 * k, 2 * k + 1):
            before, behind = made(rng.randint(0, 40)), made(rng.randint(0, 40))
            rows.append((i, " ".join(before + passage + behind)))
            own[i] = before, passage, behind
    few = ["ab"[rng.randrange(2)] for _ in range(55)]  # two words only
    rows += [(200, " ".join(made(20) + few + made(20))), (201, " ".join(made(20) + few + made(20))), (202, " ".join(["word"] * 500))]
    left = {r["doc_id"]: r["text"].split() for r in substrings.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (before, passage, behind) in own.items():
        if i % 2:
            assert left[i][:len(before)] == before and left[i][len(left[i]) - len(behind):] == behind
            assert len(left[i]) <= len(before) + len(behind) + len(passage) - substrings.PASSAGE
        else:
            assert left[i] == before + passage + behind
    assert len(left[200]) == 95 and len(left[201]) <= 95 - substrings.PASSAGE and left[202] == ["word"] * (substrings.NEAR - 1 + substrings.PASSAGE)  # the first anchor is the 16th word


def test_jaccard_takes_one_row_of_each_class(spark):
    rng = random.Random(16)
    rows = [(i, " ".join(f"w{rng.randrange(10**7)}" for _ in range(60))) for i in range(8)]
    rows += [(8, rows[7][1]), *rows[:4], *rows[:4]]
    base = spark.createDataFrame(rows, "_key long, _text string").withColumn("_row", F.xxhash64("_key", "_text"))
    sets = jaccard.set_table(base, "bigint")
    classes = sets.groupBy("class").agg(F.min("n_shingles").alias("n_shingles"))
    docs = jaccard._of_classes(base, sets, classes.select("class"))
    assert docs.count() == 8
    marked = jaccard.rare_signatures(docs, classes, 85).filter("signature is null or rare is not null").collect()
    once = base.dropDuplicates(["_row"])
    want = jaccard.rare_signatures(jaccard._of_classes(once, jaccard.set_table(once, "bigint"), classes.select("class")), classes, 85)
    assert sorted(map(tuple, marked), key=str) == sorted(map(tuple, want.filter("signature is null or rare is not null").collect()), key=str)
