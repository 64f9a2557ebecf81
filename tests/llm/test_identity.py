"""Different texts without a key, or under one key, are documents of their own in every operator and in the pipeline."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import chunks, contamination, licenses, lines, mixing, simhash, suffixes
from ledgerloom.llm.identity import with_row_numbers
from tests.llm.conftest import SCHEMA, sentence
from tests.llm.test_dedup import suffix_rows


def unclear_rows():
    """Keys 0 to 3, two rows without one and two rows of key 7, a repeated row without a key; ``shared`` is in some."""
    rng = random.Random(23)
    own = ["\n".join(sentence(rng, 24) for _ in range(4)) for _ in range(8)]
    shared = sentence(rng, 26)
    texts = [own[0], f"{own[1]}\n{shared}", own[2], own[3], f"{shared}\n{own[4]}", own[5], own[6], f"{own[7]}\n{shared}"]
    keys = [0, 1, 2, 3, None, None, 7, 7]
    rows = [(k, t, "en", "ab"[i % 2], len(t)) for i, (k, t) in enumerate(zip(keys, texts, strict=True))]
    return [*rows, rows[5]], shared


@pytest.fixture(scope="module")
def unclear(spark):
    rows, shared = unclear_rows()
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows, shared


def test_row_numbers(spark, unclear):
    docs, rows, _ = unclear
    found = with_row_numbers(docs).collect()
    numbers = {}
    for r in found:
        numbers.setdefault((r.doc_id, r.text), set()).add(r["__row"])
    assert len(found) == len(rows) and sorted(map(list, numbers.values())) == [[i] for i in range(8)]
    by_number = [k for k, _ in sorted(numbers.items(), key=lambda x: min(x[1]))]
    assert [k for k, _ in by_number] == [0, 1, 2, 3, 7, 7, None, None]
    keyed = with_row_numbers(docs.filter("doc_id < 7")).collect()
    assert all(r["__row"] == r.doc_id for r in keyed)


def test_spans_are_cut_from_their_own_texts(unclear):
    docs, rows, shared = unclear
    numbers = {(r.doc_id, r.text): r["__row"] for r in with_row_numbers(docs).collect()}
    expected = suffix_rows(sorted((n, t) for (_, t), n in numbers.items()))
    got = {(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(docs).collect()}
    assert got == {(int(a), int(b), int(c), d) for a, b, c, d in expected.values()}
    found = chunks.repeated_chunks(docs).collect()
    assert len(found) == len(rows)
    assert sorted(r.n_removed > 0 for r in found) == [False] * 7 + [True] * 2
    assert all(r.spans[-1].end <= r.n_bytes for r in found if r.spans)


def test_lines_are_cut_from_their_own_texts(unclear):
    docs, rows, shared = unclear
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in lines.repeated_lines(docs).collect())
    assert got == [*[(False, k, 0) for k in (0, 1, 2, 3, 7)], (False, 7, 1), *[(True, 0, 0)] * 2, (True, 0, 1)]
    kept = sorted(r.text for r in lines.without_repeats(docs).collect())
    cut = lambda t: "\n".join(x for x in t.split("\n") if x != shared)
    assert kept == sorted(t if k == 1 else cut(t) for k, t, *_ in rows)


def test_one_per_group_keeps_different_texts(spark, unclear):
    docs, rows, _ = unclear
    kept = [(r.doc_id, r.text) for r in simhash.one_per_group(docs).collect()]
    assert len(kept) == 8 and set(kept) == {(k, t) for k, t, *_ in rows}
    copies = spark.createDataFrame([*rows, (None, rows[2][1], "en", "a", 1), (9, rows[4][1], "en", "a", 1)], SCHEMA)
    kept = {(r.doc_id, r.text) for r in simhash.one_per_group(copies).collect()}
    assert kept == {(k, t) for k, t, *_ in rows if t != rows[4][1]} | {(9, rows[4][1])}
    names = {r.fingerprint: r.component_id for r in simhash.near_duplicates(copies).filter("doc_id = 9").collect()}
    assert list(names.values()) == [9]


def test_links_lead_through_rows_without_a_key(spark):
    prints = [(5, 0), (None, 0b111), (6, 0b111111), (8, 0b111111 << 30)]
    frame = spark.createDataFrame(prints, "doc_id long, fp long")
    found = {r.fp: r.component_id for r in simhash._members(frame, 3).collect()}
    assert found == {0: 5, 0b111: 5, 0b111111: 5, 0b111111 << 30: 8}


def test_only_the_text_that_matches_is_judged(spark, unclear):
    docs, rows, _ = unclear
    words = [" ".join(rows[i][1].split()[40:52]) for i in (5, 6)]
    bench = spark.createDataFrame(list(enumerate(words)), "item_id long, text string")
    found = contamination.contaminated(docs, bench).filter("contaminated").collect()
    assert sorted((r.doc_id or 0, r.n_hit, tuple(r.item_ids)) for r in found) == [(0, 12, ("0",))] * 2 + [(7, 12, ("1",))]
    kept = contamination.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(r[0], r[1]) for i, r in enumerate(rows) if i not in (5, 6, 8)}
    notice = F.concat("text", F.lit("\n" + licenses.TEMPLATES["MIT-text"]))
    licensed = licenses.find(docs.withColumn("text", notice)).filter("license = 'MIT-text'").collect()
    assert sorted(str(r.doc_id) for r in licensed) == sorted(["0", "1", "2", "3", "7", "7", "None", "None"])


def test_pipeline_loses_no_row(spark, unclear, tmp_path):
    docs, rows, shared = unclear
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "never seen in any of the documents that are here")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    given = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = stage(spark, given, str(tmp_path)).cache()
    cut = lambda t: "\n".join(x for x in t.split("\n") if x != shared)
    expected = {hashlib.sha256((t if k == 1 else cut(t)).encode()).hexdigest() for k, t, *_ in rows}
    left = [r.text for r in given.collect()]
    assert len(left) == 8 and {hashlib.sha256(t.encode()).hexdigest() for t in left} == expected
    # the mix may leave rows out, but gives none twice
    name, stage = corpus_pipeline.STAGES[-1]
    mixed = stage(spark, given, str(tmp_path)).collect()
    assert name == "mix_sources" and 0 < len(mixed) <= len(left)
    assert not Counter(r.text for r in mixed) - Counter(left)


def test_mix_gives_no_row_twice(spark):
    rows = [(None, f"of nobody {i}", "a", i) for i in range(6)] + [(7, "shared", "a", 6), (7, "key", "b", 7), (8, "x y", None, 8)]
    rows += [(9, "a whole row again", "b", 9)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra long").repartition(3)
    mixed = mixing.taken_documents(docs)
    assert mixed.columns == [*docs.columns, *mixing.ADDED]
    found = mixed.collect()
    assert not Counter(tuple(r)[:4] for r in found) - Counter(rows)
    by_source = Counter()
    for r in mixing.mix(docs).collect():
        by_source[r.source] += r.taken
    taken = Counter()
    for r in found:
        assert r["size"] == len(r["text"].split()) and r.taken > 0
        taken[r.source] += r.taken
    assert taken == by_source


def test_mix_spreads_documents_of_any_quality(spark):
    """No range of sampling keys holds more than its share, also where all texts are junk."""
    for filler, least in (("plain words", 1.0), ("### 123 %%%", 0.1)):
        docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(filler).alias("text"))
        order = -F.ln(mixing.uniform(F.col("doc_id"))) / mixing.quality_weight(F.col("text"))
        assert docs.select(F.min(mixing.quality_weight(F.col("text")))).first()[0] == least
        parts = docs.groupBy(F.floor(order / (order + 1) * 64)).count()
        assert parts.agg(F.max("count")).first()[0] < 400
