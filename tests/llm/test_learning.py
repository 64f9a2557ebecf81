"""Quality classifier, collocations and conversation tries against plain Python on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import collocations, subwords, toxicity, tries
from tests.llm.conftest import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Quality classifier


def judged_rows():
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(240):
        plain = sentence(rng, rng.randint(15, 60)).capitalize() + "."
        bad = i % 3 == 0
        spoilt = (
            " ".join(w + rng.choice(["###", "$$$"]) for w in plain.split()),
            plain.upper().replace(" ", "!! "),
            " ".join(rng.choice(plain.split()) + " " for _ in range(3)) * 12,
        )[i // 3 % 3]
        rows.append((i, spoilt if bad else plain))
        labels.append((i, 0 if bad else 1, i % 2))
    return rows, labels


@pytest.fixture(scope="module")
def judged(spark):
    rows, labels = judged_rows()
    odd = [(None, "no key"), (500, None), (501, ""), (502, " \n "), (3, "one key, two texts"), (503, "x" * 300_000)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    more = [(None, 1, 0), (7, None, 0), (9, 1, 0), (9, 0, 0), (900, 1, 1)]
    return docs, spark.createDataFrame(labels + more, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def model(judged):
    return subwords.fit(*judged)


def test_classifier_on_held_out_texts(judged, model):
    docs, _ = judged
    scored = subwords.score(docs, model).withColumn("held", toxicity.held_out()).collect()
    assert len(scored) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= subwords.LEAST_SCORE) for r in scored)
    held = [r for r in scored if r.doc_id is not None and r.doc_id < 240 and r.held and r.doc_id != 3]
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored if r.doc_id is not None)
    assert len(held) > 30
    right = sum(r.predicted == (r.doc_id % 3 != 0) for r in held)
    assert right >= 0.95 * len(held)
    empty = {r.score for r in scored if r.doc_id in (500, 501, 502)}
    assert empty == {1 / (1 + np.exp(-model.bias))}


def test_classifier_does_not_learn_from_held_out_labels(spark, judged, model):
    docs, labels = judged
    turned = labels.withColumn("quality", F.when(toxicity.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = subwords.fit(docs, turned)
    assert again.bias == model.bias and np.array_equal(again.values, model.values)


@pytest.mark.parametrize("label, expected", [(1, 0.9), (0, 0.1), (None, 0.5)])
def test_classifier_without_labels_of_both_kinds(judged, label, expected):
    docs, labels = judged
    found = subwords.fit(docs, labels.limit(8).withColumn("quality", F.lit(label).cast("int")))
    scores = {r.score for r in subwords.score(docs, found).collect()}
    assert len(scores) == 1
    assert abs(scores.pop() - expected) <= (0.15 if label is not None else 0)


def test_classifier_on_empty_and_clashing_tables(judged, model):
    docs, _ = judged
    assert subwords.score(docs.limit(0), model).count() == 0
    other = docs.withColumnsRenamed({"text": "my text", "doc_id": "my.id"}).withColumns({"text": F.lit(1), "score": F.lit("x")})
    named = subwords.score(other, model, text="my text", key="my.id")
    order = lambda frame: sorted(map(tuple, frame.collect()), key=repr)
    assert order(named) == order(subwords.score(docs, model))


def plain_features(text):
    """Words, their n-grams of code points, and dittos, as a counter of what they are."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = Counter(("w", w) for w in words)
    for w in words:
        marked = ["<", *w, ">"]
        found.update((n, *marked[i : i + n]) for n in subwords.SIZES for i in range(len(marked) - n + 1))
    runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    dittos = sum(n - 1 for n in runs.values()) + sum(a == b for a, b in zip(words, words[1:], strict=False))
    return found, dittos


def test_features_against_plain_python():
    texts = ["na na na, 漢字 🙂 é\tna", "", None, "a", "the cat the cat the cat sat", "x" * 50]
    found = subwords.Features(pa.RecordBatch.from_pydict({"text": texts}))
    values = np.zeros(subwords.DITTO + 1)
    totals, counts = found.sums(values)
    for text, dittos, count, (buckets, shares) in zip(texts, found.dittos, counts, found.rows(), strict=True):
        features, expected = plain_features(text or "")
        assert dittos == expected and count == sum(features.values()) + expected
        by_bucket = sorted(round(s * count) for b, s in zip(buckets, shares, strict=True) if b != subwords.DITTO)
        assert by_bucket == sorted(features.values())  # no two of these share a bucket
    one = np.random.default_rng(1).normal(size=len(values))
    totals, counts = found.sums(one)
    averages = [float(one[b] @ s) for b, s in found.rows()]
    assert np.allclose(totals / np.maximum(counts, 1), averages, atol=1e-5)


# Collocations


def plain_phrases(rows, least, first):
    totals, counts = Counter(), {}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {
            longer[i : i + k]
            for longer, a in candidates.items()
            for k in range(2, len(longer))
            for i in range(len(longer) - k + 1)
            if a >= f[longer[i : i + k]]
        }
        best = []
        for p, a in candidates.items():
            if p not in gone:
                cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(best)[:first], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(9)
    vocabulary = [sentence(rng, 1) for _ in range(30)] + ["Ñu", "漢字", "🙂", "a b"]
    fixed = [" ".join(rng.choices(vocabulary, k=k)) for k in (2, 3, 4, 5, 7)]
    rows = []
    for i in range(300):
        words = rng.choices(vocabulary, k=rng.randint(0, 30))
        for _ in range(rng.randint(0, 4)):
            words.insert(rng.randint(0, len(words)), rng.choice(fixed))
        marks = [" ", "  ", "\t", ". ", ", ", "\n", "!", "\x0b"]
        text = "".join(w + rng.choices(marks, weights=[30, 2, 2, 1, 1, 1, 1, 1])[0] for w in words)
        rows.append((text.upper() if i % 7 == 0 else text, (None, "en", "de", "und", "en", "en")[i % 6]))
    rows += [(None, "en"), ("", None), (" \t\n", "fr"), ("la " * 5000, "en"), (rows[0][0], rows[0][1])]
    return rows


@pytest.mark.parametrize("least, first", [(5, 2000), (12, 7), (40, None)])
def test_collocations_against_plain_python(spark, least, first):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    found = collocations.collocations(docs, least=least, first=first)
    assert [t for _, t in found.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    got = sorted(map(tuple, found.collect()))
    assert got and got == plain_phrases(rows, least, first)


def test_collocations_do_not_depend_on_pruning(spark, monkeypatch):
    """A bitmap of few bits, and hot prefixes only, change what is sent, not what is found."""
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    monkeypatch.setattr(collocations, "MOST_BITS", 1 << 13)
    monkeypatch.setattr(collocations, "BITS_EACH", 1)
    monkeypatch.setattr(collocations, "HOT_SHARE", 10**9)
    monkeypatch.setattr(collocations.batches, "SLICE_BYTES", 500)
    assert sorted(map(tuple, collocations.collocations(docs, least=5).collect())) == plain_phrases(rows, 5, 2000)


def test_stripes_hold_no_word_pair_over_a_bound():
    frame = pa.RecordBatch.from_pydict({"text": ["a b", "c. d e", None, "f"], "lang": ["x", "x", "x", None]})
    words = collocations.Words(frame)
    listed = [words.words[i].as_py() for i in words.ids.tolist()]
    assert listed == [b"a", b"b", b"c", b"d", b"e", b"f"]
    assert words.left.tolist() == [2, 1, 1, 2, 1, 1]


def test_collocation_scores_beyond_64_bits(spark):
    """a * n and l * r pass 64 bits where counts do not."""
    big = 6 * 10**12
    levels = [
        spark.createDataFrame([("en", "", "x", big), ("en", "", "y", big)], "lang string, prefix string, next string, n long"),
        spark.createDataFrame([("en", "x", "y", big - 1)], "lang string, prefix string, next string, n long"),
    ]
    totals = spark.createDataFrame([("en", 3 * big)], "lang string, total long")
    row = collocations._ranked(levels, totals, 10).first()
    assert row.score == 1000 * (big - 1) * 3 * big // (big * big)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(docs).count() == 0
    rows = [("a b " * 200, "en")] * 2
    clash = spark.createDataFrame(rows, "body string, tongue string").selectExpr("*", "1 AS text", "2 AS lang", "3 AS n")
    named = collocations.collocations(clash, text="body", lang="tongue").collect()
    assert sorted(map(tuple, named)) == plain_phrases(rows, 100, 2000)


# Conversation trie


def plain_trie(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    nodes = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(turns.get(c - c % 5, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            nodes.setdefault(whole[:d], []).append((c, len(whole)))
    out = {}
    for path, members in nodes.items():
        ids = sorted(c for c, n in members if n == len(path))
        out[path] = {
            "conv_id": min(members)[0],
            "depth": len(path),
            "parent_conv_id": min(nodes[path[:-1]])[0] if path else None,
            "n_convs": len(members),
            "n_children": 0,
            "n_leaves": 0,
            "saved_tokens": 0,
            "ends_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        }
    for path, node in out.items():
        if path:
            out[path[:-1]]["n_children"] += 1
    for path, node in out.items():
        saved = (node["n_convs"] - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            out[path[:d]]["n_leaves"] += not node["n_children"]
            out[path[:d]]["saved_tokens"] += saved
    return sorted(tuple(n.values()) for n in out.values())


def conversations(seed, n=300, long=0):
    rng = random.Random(seed)
    texts = [sentence(rng, rng.randint(1, 5)) for _ in range(6)] + ["", None, "漢字"]
    rows = []
    for c in range(n):
        if rng.random() < 0.15:
            continue  # so some heads are absent
        if c % 3 == 1:  # a third of all are copies of one conversation
            script = [("user", "hello"), ("assistant", "hi"), ("user", "bye")] * 4
        else:
            script = [(rng.choice(["user", "assistant", None]), rng.choice(texts)) for _ in range(rng.randint(1, 14))]
        numbered = [(c, i, *t) for i, t in enumerate(script)]
        if c % 11 == 0:
            numbered[-1] = (c, None, "late", "comes first")
        rng.shuffle(numbered)
        rows += numbered
    for c in (n + 5, n + 7):
        rows += [(c, i, "user", f"{i // 40}") for i in range(long)]
    return [*rows, (None, 0, "user", "of nobody"), (None, None, None, None)]


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed, long", [(1, 0), (2, 150)])
def test_trie_against_plain_python(spark, seed, long):
    rows = conversations(seed, long=long)
    found = tries.conversation_trie(spark.createDataFrame(rows, TURNS).repartition(5))
    assert [t for _, t in found.dtypes] == [*["bigint"] * 7, "string"]
    key = lambda r: (r[1], r[0], -1 if r[2] is None else r[2], r[3:])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(plain_trie(rows), key=key)


def test_trie_over_many_shards(spark):
    """More shards than distinct beginnings: every node of the common path is open."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rows = conversations(3, n=90, long=70)
        found = tries.conversation_trie(spark.createDataFrame(rows, TURNS)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    key = lambda r: (r[1], r[0], -1 if r[2] is None else r[2], r[3:])
    assert sorted(map(tuple, found), key=key) == sorted(plain_trie(rows), key=key)


def test_trie_of_odd_tables(spark):
    assert tries.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0
    only = [r for r in conversations(1) if r[0] is None]
    assert tries.conversation_trie(spark.createDataFrame(only, TURNS)).count() == 0
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in range(1, 400)}
    turnless = next(c for c, n in h.items() if c % 5 and n > 0)
    rows = [(turnless, 0, "user", "gone with the absent head")]
    found = tries.conversation_trie(spark.createDataFrame(rows, TURNS)).collect()
    assert [tuple(r) for r in found] == plain_trie(rows) and found[0].depth == 0 and found[0].n_leaves == 1
    rows = conversations(4, n=30)
    clash = spark.createDataFrame(rows, "my_conv long, no long, who string, said string")
    clash = clash.selectExpr("*", "1 AS conv_id", "2 AS turn", "3 AS hi", "4 AS shard")
    found = tries.conversation_trie(clash, "my_conv", "no", "who", "said").collect()
    assert len(found) == len(plain_trie(rows))


def test_sorted_rows_against_plain_python():
    rng = random.Random(8)
    rows = {tuple(rng.choices((1, 2), k=rng.choice((0, 1, 2, 31, 32, 33, 64, 65, 130)))) for _ in range(300)}
    rows |= {(1,) * k for k in (30, 32, 33, 64, 96, 97, 200)}
    rows = sorted(rows, key=lambda r: hash(str(r)))
    size = np.array([len(r) for r in rows])
    ids = np.array([x for r in rows for x in r], np.int64)
    order, shared = tries.sorted_rows(ids, np.cumsum(size) - size, size)
    assert [rows[i] for i in order] == sorted(rows)
    for (a, b), n in zip(zip(sorted(rows), sorted(rows)[1:], strict=False), shared[1:], strict=True):
        assert n == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
