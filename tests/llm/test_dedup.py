"""Chunks, suffixes, SimHash and lines against plain Python on small texts."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import chunks, lines, simhash, suffixes
from ledgerloom.llm.components import components
from tests.llm.conftest import sentence


def encoded(text):
    return (text or "").encode()


def by_id(frame, *columns):
    found = {}
    for r in frame.collect():
        found.setdefault(r["doc_id"], set()).add(tuple(str(r[c]) for c in columns))
    assert all(len(v) == 1 for v in found.values())
    return {k: next(iter(v)) for k, v in found.items()}


# Components


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(60, 100)]
    star = [(5, i) for i in range(200, 260)]
    links = [*path, *star, (1, 1), (2, 3), (3, 2), (4, None), (300, 2)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 60 for i in range(60, 101))
    assert all(found[i] == 5 for i in [5, *range(200, 260)])
    assert found[2] == found[3] == found[300] == 2
    assert 1 not in found and 4 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Chunks


def chunk_spans(plain):
    seen, expected = set(), {}
    for key, text in plain:
        data, start, own, spans = encoded(text), 0, set(), []
        for end in chunks.cuts(data):
            piece = data[start:end]
            if piece in seen or piece in own:
                if spans and spans[-1][1] == start:
                    spans[-1][1] = end
                else:
                    spans.append([start, end])
            own.add(piece)
            start = end
        seen |= own
        spans = [s for s in spans if s[1] - s[0] >= chunks.LEAST_RUN]
        expected[key] = (str(len(data)), str(sum(b - a for a, b in spans)), str(len(spans)))
    return expected


def test_chunks(docs, rows, plain):
    found = chunks.repeated_chunks(docs)
    assert found.count() == len(rows)
    assert by_id(found, "n_bytes", "n_removed", "n_spans") == chunk_spans(plain)


def test_chunks_find_a_shifted_passage(spark, rows):
    passage = max((r[1] or "" for r in rows[:16]), key=len)[:420]
    pairs = [(i, f"{'xyz ' * i}{passage}{' qrs' * i}") for i in range(12)]
    found = chunks.repeated_chunks(spark.createDataFrame(pairs, "doc_id long, text string")).orderBy("doc_id").collect()
    assert found[0].n_removed == 0 and all(r.n_removed > len(passage) // 3 for r in found[1:])


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(b"some bytes of a text, and some more of them" * 3, np.uint8)
    h, rolled = 0, []
    for b in data.tolist():
        h = ((h << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        rolled.append(h)
    assert chunks.gear_hashes(data).tolist() == rolled


def test_cuts_cover_the_text_within_bounds():
    rng = np.random.default_rng(1)
    for size in (0, 1, 15, 16, 17, 600, 5000):
        data = rng.integers(97, 100, size).astype(np.uint8).tobytes()
        ends = chunks.cuts(data)
        sizes = np.diff([0, *ends])
        assert (ends[-1] if ends else 0) == size
        assert all(chunks.LEAST <= s <= chunks.MOST + chunks.LEAST for s in sizes[:-1])


# Suffixes


def suffix_rows(plain, length=50):
    seen, expected = set(), {}
    for key, text in plain:
        data = encoded(text)
        gone, own = bytearray(len(data)), [data[i : i + length] for i in range(len(data) - length + 1)]
        for i, window in enumerate(own):
            if window in seen:
                gone[i : i + length] = b"\1" * length
        seen.update(own)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        n_spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        expected[key] = (str(len(data)), str(sum(gone)), str(n_spans), hashlib.sha256(kept).hexdigest())
    return expected


@pytest.mark.parametrize("hot", [suffixes.HOT, 3])
def test_suffixes(docs, rows, plain, hot):
    found = suffixes.remove_repeats(docs, hot=hot)
    assert found.count() == len(rows)
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == suffix_rows(plain)


def test_suffixes_of_copies(spark):
    """Copies of all sizes, short ones too, and a text that shares a passage with a later and an earlier copy."""
    rng = random.Random(77)
    own = [sentence(rng, 40) for _ in range(4)]
    texts = [own[0], own[1], own[0], "x" * 49, "x" * 49, "x" * 50, "x" * 50, None, "", own[2], own[0], own[1][20:120] + own[3]]
    texts += [own[2] + own[0][:70], own[2], own[2]]
    pairs = list(enumerate(texts))
    frame = spark.createDataFrame([*pairs, pairs[2], pairs[2]], "doc_id long, text string").repartition(4)
    found = suffixes.remove_repeats(frame)
    assert found.count() == len(pairs) + 2
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == suffix_rows(pairs)
    spans = {r.doc_id: [tuple(x) for x in r.spans] for r in found.collect()}
    assert spans[2] == [(0, len(own[0].encode()))] and spans[4] == [] and spans[6] == [(0, 50)]


def test_suffixes_of_periodic_and_touching_texts(spark):
    texts = ["ab" * 60, "ba" * 40, "x" * 49, "x" * 50, "x" * 51, "y" * 30 + "x" * 50, "ab" * 25 + "x" * 50 + "ba" * 30]
    pairs = list(enumerate(texts))
    found = suffixes.remove_repeats(spark.createDataFrame(pairs, "doc_id long, text string"))
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == suffix_rows(pairs)


def test_interval_tree_gives_maximal_repeats():
    words = sorted([b"banana", b"bandana", b"band", b"bank", b"can"])
    lcp = [0, *(suffixes.common(a, b) for a, b in zip(words, words[1:]))]
    found = {(v, i, j) for v, i, j in suffixes.intervals(lcp, 1)}
    assert found == {(3, 0, 3), (4, 1, 2)}


# SimHash


def plain_print(text):
    words = encoded(text).lower().split()
    k = min(3, len(words))
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """Smallest reachable key by key, over links of three or fewer bits."""
    keys = list(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_simhash(docs, rows, plain):
    found = simhash.near_duplicates(docs)
    assert found.count() == len(rows)
    prints = {k: plain_print(t) for k, t in plain if k is not None}
    groups = grouped(prints)
    got = by_id(found, "fingerprint", "component_id")
    assert got.pop(None) == (f"{prints[2]:016x}", str(groups[2]))
    assert got == {k: (f"{prints[k]:016x}", str(groups[k])) for k in prints}
    assert len(set(groups.values())) < len(groups) - 4


@pytest.mark.parametrize("part", [simhash.PART, 9])
def test_close_links_in_dense_and_split_groups(spark, part):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**64, size=3, dtype=np.uint64)
    prints = {int(c) for c in centre}
    for c in centre.tolist():
        for _ in range(90):
            prints.add(c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)))
    ids = {i: p for i, p in enumerate(sorted(prints))}
    rows = [(p - (1 << 64) if p >> 63 else p, i) for i, p in ids.items()]
    links = simhash.close_links(spark.createDataFrame(rows, "fp long, id long"), part=part)
    found = {r.node: r.component for r in components(links).collect()}
    assert {i: found.get(i, i) for i in ids} == grouped(ids)


def test_one_per_group_keeps_columns_and_one_row(docs, rows, plain):
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    groups = grouped({k: plain_print(t) for k, t in plain if k is not None})
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups.values()))


# Lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def line_rows(plain, least=3):
    table = []
    for key, text in plain:
        for i, line in enumerate([] if text is None else text.split("\n")):
            words = tuple(w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", line.lower()) if w)
            if len(words) >= least:
                table.append((key, i, words))
    first = {}
    for n, (_, _, words) in enumerate(table):
        first.setdefault(words, n)
    different = list(first)
    root = {w: w for w in different}

    def find(w):
        while root[w] != w:
            w = root[w]
        return w

    links = 0
    for i, a in enumerate(different):
        for b in different[i + 1 :]:
            most = int(max(len(a), len(b)) * 0.2 + 1e-9)
            if abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                links += 1
                x, y = find(a), find(b)
                root[max(x, y, key=first.get)] = min(x, y, key=first.get)
    gone = Counter()
    for n, (key, i, words) in enumerate(table):
        if first[find(words)] != n:
            gone[key] += 1
    return gone, links


def similar_pairs(different):
    """All pairs of lines with an edit similarity of 0.8: two of them share one of their rarest words."""
    often = Counter(w for line in different for w in set(line))
    by_word = {}
    for n, line in enumerate(different):
        rare = sorted(line, key=lambda w: (often[w], w))[: int(len(line) * 0.2 + 1e-9) + 1]
        for w in set(rare):
            by_word.setdefault(w, []).append(n)
    pairs = {(a, b) for group in by_word.values() for i, a in enumerate(group) for b in group[i + 1 :]}
    counts = [Counter(line) for line in different]
    found = []
    for a, b in pairs:
        x, y = different[a], different[b]
        most = int(max(len(x), len(y)) * 0.2 + 1e-9)
        if (counts[a] & counts[b]).total() < max(len(x), len(y)) - most:
            continue
        while x and y and x[0] == y[0]:
            x, y = x[1:], y[1:]
        while x and y and x[-1] == y[-1]:
            x, y = x[:-1], y[:-1]
        if distance(x, y) <= most:
            found.append((different[a], different[b]))
    return found


def variants(rng_seed=5):
    """Long lines of which a few words are changed, so that they are close but not equal, and many of one line."""
    import random

    rng = random.Random(rng_seed)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(30):
        words = list(base)
        words[i] = f"v{i}"
        rows.append((i, " ".join(words) + f"\nshort {i}"))
    return rows


def test_lines(docs, rows, plain):
    found = lines.repeated_lines(docs)
    assert found.count() == len(rows)
    gone, _ = line_rows(plain)
    got = by_id(found, "n_lines", "n_removed")
    counts = {k: 0 if t is None else len(t.split("\n")) for k, t in plain}
    assert got == {k: (str(counts[k]), str(gone[k])) for k, _ in plain}


def test_close_lines(spark):
    pairs = variants()
    gone, links = line_rows(pairs)
    assert links > 20
    found = lines.repeated_lines(spark.createDataFrame(pairs, "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in found.collect()} == {k: gone[k] for k, _ in pairs}


def test_short_lines_and_unspaced_scripts(spark):
    long = "這是一個沒有空格的句子用來測試重複的行"
    thai = "ภาษาไทยไม่มีช่องว่างระหว่างคำ"
    texts = [
        f"Thank you!\nMenu\n1.\n{long}\n{thai}\nこんにちは",
        f"thank you\n1.\nmenu\n}}\n{long}",
        f"}}\n{thai}\nこんにちは。\nこんにちは\nother",
        f"一{long}\n全然違う行がここにあります",
    ]
    found = lines.repeated_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    # A full stop more makes one edit of six words, a character in front of the long line one of nineteen
    assert {r.doc_id: r.removed for r in found.collect()} == {0: [], 1: [0, 2, 4], 2: [1, 2, 3], 3: [0]}
    words = spark.createDataFrame([("Ab 漢字x ไทย",)], "line string").select(lines.line_words("line").alias("w")).first().w
    assert words == ["ab", "漢", "字", "x", "ไ", "ท", "ย"]


def test_fingerprints_of_lines(spark):
    """Bits are those of most words, at any length; one word many times has that word's hash."""
    texts = ["la " * 30_000, "la " * 70_000 + "x", "la la la", "one of the words is the same", "a b"]

    def plain(words):
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    table = spark.createDataFrame([(t.split(),) for t in texts], "w array<string>")
    bits = table.select(lines.fingerprint(F.transform("w", lambda x: F.xxhash64(x))).alias("bits"))
    assert [r["bits"] & (1 << 64) - 1 for r in bits.collect()] == [plain(t.split()) for t in texts]


def test_changed_words_in_lines_of_all_lengths(spark):
    """One word replaced, put in or left out, in lines of 8 to 60 words, and a fifth of the words in longer ones."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    texts, expected = [], 0
    for n in range(8, 61):
        base = [word() for _ in range(n)]
        at = rng.randrange(n)
        for changed in (base[:at] + [word()] + base[at + 1 :], base[:at] + [word()] + base[at:], base[:at] + base[at + 1 :]):
            texts += [" ".join(base), " ".join(changed)]
            expected += 1
            base = [word() for _ in range(n)]
    for n in range(30, 120, 3):
        base = [word() for _ in range(n)]
        changed = [word() if i in set(rng.sample(range(n), n // 10)) else w for i, w in enumerate(base)]
        texts += [" ".join(base), " ".join(changed)]
        expected += 1
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id for r in lines.repeated_lines(table).filter("n_removed > 0").collect()}
    assert all(k % 2 for k in found)
    assert len(found) >= 0.97 * expected


def test_unlike_lines_with_a_common_stretch(spark):
    """Lines that share nothing but a stretch stay; near copies among them are found, though the first is none of them."""
    rng = random.Random(3)
    common = "all of these lines share this stretch of words".split()
    texts = []
    for i in range(300):
        rest = [f"x{rng.randint(0, 10**6)}" for _ in range(25)]
        texts.append(" ".join(rest[:5] + common + rest[5:]))
        if i % 10 == 0:
            rest[20] = "other"
            texts.append(" ".join(rest[:5] + common + rest[5:]))
    rows = list(enumerate(texts))
    gone, links = line_rows(rows)
    assert links == 30
    found = lines.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in found.collect()} == {k: gone[k] for k, _ in rows}


def test_near_lines_of_the_documents(spark):
    """Of all pairs of different lines that are similar by their edits, nine of ten at least are linked in some way."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(F.col("text").isNotNull())
    table = docs.select("doc_id", "text")
    place, words_of = {}, {}
    for r in table.collect():
        for i, line in enumerate(r.text.split("\n")):
            parted = regex.sub(lines.UNSPACED, r" \1 ", line)
            words = tuple(w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", parted.lower()) if w)
            if len(words) >= 5:
                words_of.setdefault(words, len(words_of))
                place[r.doc_id, i] = words
    found = {r.doc_id: set(r.removed) for r in lines.repeated_lines(table).collect()}
    kept = {w for (d, i), w in place.items() if i not in found[d]}
    similar = similar_pairs(list(words_of))
    # Both lines of a similar pair stay only where it was missed
    missed = [1 for a, b in similar if a in kept and b in kept]
    assert len(similar) > 300
    assert len(missed) <= 0.1 * len(similar)


def test_edits_all_along_a_line_are_found(spark):
    """As many edits as a similarity of 0.8 allows, as evenly spread as they can be, in lines of 4 to 60 words."""
    rng = random.Random(29)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    texts = []
    for n in range(4, 61):
        base = [word() for _ in range(n)]
        for kind in ("replaced", "left out"):
            # every fifth word goes, or as many as the longer line allows
            out = set(range(2, n, 5)) if n > 4 else set()
            out = set(sorted(out)[: int(n * 0.2 + 1e-9)])
            words = [word() if i in out else w for i, w in enumerate(base) if kind == "replaced" or i not in out]
            texts += [" ".join(base), " ".join(words)] if out else [" ".join(base), " ".join([*base, word()])]
            base = [word() for _ in range(n)]
    rows = list(enumerate(texts))
    gone, links = line_rows(rows)
    assert links == len(texts) // 2 == sum(gone.values())
    found = lines.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in found.collect()} == {k: gone[k] for k, _ in rows}


def test_all_near_lines_of_the_documents(spark):
    """Groups are exactly those of all similar pairs, lines of four words and more."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(F.col("text").isNotNull())
    table = docs.select("doc_id", "text")
    place, words_of = {}, {}
    for r in sorted(table.collect(), key=lambda r: r.doc_id):
        for i, line in enumerate(r.text.split("\n")):
            parted = regex.sub(lines.UNSPACED, r" \1 ", line)
            words = tuple(w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", parted.lower()) if w)
            if len(words) >= 4:
                words_of.setdefault(words, len(words_of))
                place[r.doc_id, i] = words
    root = {w: w for w in words_of}

    def find(w):
        while root[w] != w:
            w = root[w]
        return w

    for a, b in similar_pairs(list(words_of)):
        x, y = sorted((find(a), find(b)), key=words_of.get)
        root[y] = x
    first = {}
    for at, words in place.items():
        first.setdefault(find(words), at)
    expected = {at for at, words in place.items() if first[find(words)] != at}
    found = {(r.doc_id, i) for r in lines.repeated_lines(table).collect() for i in r.removed}
    assert found & set(place) == expected


def test_blocks_of_bits_and_words(spark):
    """Fingerprints two bits apart share a choice of blocks; similar lines a pair of words."""
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(50)]
    near = [p ^ sum(1 << b for b in rng.sample(range(64), 2)) for p in prints]
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    table = spark.createDataFrame([(signed(a), signed(b)) for a, b in zip(prints, near)], "a long, b long")
    for r in table.select(lines.bit_blocks(F.col("a")).alias("a"), lines.bit_blocks(F.col("b")).alias("b")).collect():
        assert len(set(r.a)) == 6 and set(r.a) & set(r.b) and max(r.a) < 0
    texts = spark.createDataFrame([("a b c d".split(), "a b x c d".split()), ("a b c".split(), [])], "a array<string>, b array<string>")
    rows = texts.select(lines.pair_blocks(F.col("a")).alias("a"), lines.pair_blocks(F.col("b")).alias("b")).collect()
    assert len(rows[0].a) == 2 and len(rows[0].b) == 3 and set(rows[0].a) & set(rows[0].b) and min(rows[0].a) >= 0
    assert rows[1].a == rows[1].b == []


def test_common_passages_make_no_blocks_of_words(spark):
    """Pairs of rare words come first, however short these are, so lines that share a passage of long words do not meet."""
    rng = random.Random(8)
    common = "everything considered notwithstanding circumstances throughout".split()
    texts = [" ".join([f"x{rng.randint(0, 10**6)}" for _ in range(20)] + common) for _ in range(200)]
    table = lines.line_table(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert lines.word_blocks(table.select("h1", "size", "sig")).count() <= 10


def test_lines_leave_no_large_results_behind(spark):
    """Signatures and blocks are removed as soon as nothing reads them, and the session's setting is put back."""
    from ledgerloom.sources import scratch

    texts = [" ".join(f"w{j}" if j != i else "other" for j in range(40)) for i in range(30)]
    before, setting = set(os.listdir(scratch_path(spark))), spark.conf.get(scratch._CLEANUP)
    found = lines.repeated_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert found.agg(F.sum("n_removed")).first()[0] == 29
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(scratch_path(spark))) - before}
    assert "removed-lines" in left
    assert not left & {"lines", "distinct-lines", "word-blocks", "simhash-blocks", "block-centres", "parted-blocks"}
    assert spark.conf.get(scratch._CLEANUP) == setting


def test_unlike_lines_of_a_block_are_not_written_as_pairs(spark, monkeypatch):
    """Lines that share a pair of words and nothing else are told apart where they meet; near ones are still found."""
    rows, real = {}, lines.stored

    def counted(frame, name):
        result = real(frame, name)
        rows[name] = rows.get(name, 0) + result.count()
        return result

    monkeypatch.setattr(lines, "stored", counted)
    rng = random.Random(12)
    word = lambda: f"x{rng.randint(0, 10**9)}"
    for lines_each in (2, lines._SMALL_BLOCK + 3):
        shared = [[word(), word()] for _ in range(40)]
        texts = [" ".join([word() for _ in range(9)] + pair + [word() for _ in range(9)]) for pair in shared for _ in range(lines_each)]
        texts.append(" ".join([*texts[0].split()[:-1], "other"]))
        found = lines.repeated_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
        assert [r.doc_id for r in found.filter("n_removed > 0").collect()] == [len(texts) - 1]
        assert rows["first-pairs"] <= 3 and rows["more-pairs"] <= 3
        rows.clear()


def scratch_path(spark):
    from ledgerloom.sources import scratch

    path = scratch._run_folder(spark).removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    return path


def test_common_ends_do_not_change_distances(spark):
    rows = [("abcdef", "abxdef"), ("aaaa", "aaa"), ("", "abc"), ("abc", "abc"), ("xabc", "abc"), ("abcabc", "abc"), ("ab", "ba")]
    table = spark.createDataFrame(rows, "x string, y string")
    cut = lines._without_common_ends(F.col("x"), F.col("y")).alias("r")
    for r in table.select("x", "y", cut).collect():
        assert distance(r.x, r.y) == distance(r.r.x, r.r.y)
        assert not r.r.x or not r.r.y or (r.r.x[0] != r.r.y[0] and r.r.x[-1] != r.r.y[-1])


def test_without_repeats(docs, rows):
    kept = lines.without_repeats(docs)
    assert kept.columns == docs.columns
    got = {r.doc_id: r.text for r in kept.collect()}
    removed = {r.doc_id: set(r.removed) for r in lines.repeated_lines(docs).collect()}
    for key, text, *_ in rows:
        if not removed[key]:
            assert got[key] == text
        else:
            rest = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in removed[key])
            assert got.get(key, "") == rest if rest.strip() else key not in got


# All of them


def test_empty_tables(no_docs):
    for operator in (chunks.repeated_chunks, suffixes.remove_repeats, simhash.near_duplicates, lines.repeated_lines):
        assert operator(no_docs).count() == 0
    for stage in (simhash.one_per_group, lines.without_repeats):
        assert stage(no_docs).count() == 0


def test_names_that_clash(docs, clashing):
    for operator in (chunks.repeated_chunks, suffixes.remove_repeats, simhash.near_duplicates, lines.repeated_lines):
        mine = operator(clashing, text="my text", key="my.id")
        assert sorted(map(str, mine.collect())) == sorted(map(str, operator(docs).collect()))
    for stage in (simhash.one_per_group, lines.without_repeats):
        kept = stage(clashing, text="my text", key="my.id")
        assert kept.columns == clashing.columns
        assert kept.count() == stage(docs).count()
