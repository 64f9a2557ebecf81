import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ka lo mi ret sun dor vel ash tin gar pol esh".split()


def sentence(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def corpus_rows():
    """Small texts with copies, near copies, shared passages, repeated lines, junk, and all odd cases."""
    rng = random.Random(11)
    rows = []
    add = lambda text, source="a": rows.append((len(rows), text, "en", source, len(text or "")))
    base = ["\n".join(sentence(rng, rng.randint(12, 30)).capitalize() + "." for _ in range(4)) for _ in range(16)]
    for i, text in enumerate(base):
        add(text, "abc"[i % 3])
    passage = sentence(rng, 55)
    line = sentence(rng, 14)
    for text in base[:4]:
        add(text, "a")
    for text in base[4:8]:
        words = text.split(" ")
        words[5] = "changed"
        add(" ".join(words), "b")
    for text in base[8:12]:
        add(text[: len(text) // 2] + " " + passage + text[len(text) // 2 :], "c")
    for i in range(4):
        add(f"{sentence(rng, 25)}\n{line}\n{line.upper()}!\n{sentence(rng, 9)} é{i}", "a")
    add("# * $ % & | < > " * 30, None)
    add(("la la la la la la la la la la " * 6).strip(), None)
    add(None, None)
    add("", "a")
    add(" \t\n ", "a")
    add("one", "b")
    add("ÀÉÎ ñandú 漢字 🙂 " * 12, "b")
    add(sentence(rng, 9000), "c")
    rows.append(rows[3])
    rows.append((None, base[2], "en", "a", 1))
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def plain(rows):
    """(doc_id, text) once for each key, a null key last."""
    unique = {r[0]: r[1] for r in rows}
    return sorted(unique.items(), key=lambda x: (x[0] is None, x[0] or 0))


@pytest.fixture(scope="session")
def clashing(docs):
    """The same texts under other names, next to columns named like those the operators use inside."""
    from pyspark.sql import functions as F

    other = {c: F.lit("x") for c in ("h", "h1", "at", "start", "size", "key", "code", "fp", "w", "n", "id", "of", "kept")}
    renamed = docs.withColumnsRenamed({"text": "my text", "doc_id": "my.id"})
    return renamed.withColumns({**other, "text": F.lit("y"), "doc_id": F.lit(1)})
