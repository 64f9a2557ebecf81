"""Secret scans: three fixed patterns, and a battery of randomness tests under false-discovery control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import let, pick

# The patterns of the base kinds, the group whose length counts, and the least length
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]+"
_HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
LEAST_RANDOM = 20
# An equals sign ends a name before a token and pads one at its end, it is never inside
_TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
# Alphabets in the order they are tried, the smallest first
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("upper hex", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
MOST_Z = 3.0
DISCOVERY_RATE = 0.01
# Surprise, in quarters of a nat, is binned for the false-discovery threshold
_BINS, _STEP = 8000, 4.0


def _spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 1) -> Column:
    """(start, rank, end, token) of each leftmost match whose ``group`` has ``least`` characters, in code points.

    Matches and the gaps between them alternate, so their lengths run up to the positions.
    """
    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("cores"),
    )
    rank = KINDS.index(kind)
    shape = "array<struct<start:int,rank:int,end:int,token:string>>"

    def placed(p: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(p["gaps"], i))
            end = start + F.length(F.get(p["hits"], i))
            token = F.get(p["cores"], i)
            new = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), token.alias("token"))
            longer = F.when(F.length(token) >= least, F.array_append(state["out"], new)).otherwise(state["out"])
            return F.struct(end.alias("at"), longer.alias("out"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(shape).alias("out"))
        count = F.size(p["hits"])
        return F.aggregate(F.sequence(F.lit(0), count - 1), zero, step)["out"]

    return F.when(text.rlike(pattern), let(parts, placed)).otherwise(F.array().cast(shape))


def _alphabet(token: Column, field: str) -> Column:
    """The size or the characters of the smallest alphabet that a token fits, without its padding."""
    chosen = None
    for _, chars in ALPHABETS:
        fits = F.length(F.translate(token, chars, "")) == 0
        value = F.lit(chars)
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return chosen.otherwise(F.lit(ALPHABETS[-1][1]))


def _tests(token: Column, natural: Column) -> Column:
    """(n, uniform, runs, serial, surprise) of a token.

    ``uniform`` is the standardised chi-squared statistic against equal use of the inferred alphabet, ``runs`` that of
    the number of runs above and below its middle, ``serial`` that of the correlation of neighbours; all are about
    standard normal for a random string. ``surprise`` is how much likelier, in nats, the token is as a random string
    than as letters drawn as in ordinary words; under those, e^-surprise bounds the chance of as large a value.
    """
    core = F.rtrim(token, F.lit("="))

    def of(chars: Column) -> Column:
        def valued(v: Column) -> Column:
            n = F.size(v).cast("double")
            size = F.length(chars).cast("double")
            squares = F.aggregate(
                F.array_distinct(v),
                F.lit(0.0),
                lambda a, c: a + F.pow(F.size(F.filter(v, lambda x: x == c)).cast("double"), F.lit(2.0)),
            )
            uniform = (squares * size / n - n - (size - 1)) / F.sqrt(2 * (size - 1) * (1 - 1 / n))
            high = F.transform(v, lambda x: (2 * x >= size).cast("int"))
            n1 = F.aggregate(high, F.lit(0), lambda a, b: a + b).cast("double")
            n2 = n - n1
            turns = let(
                high,
                lambda h: F.aggregate(
                    F.sequence(F.lit(1), F.size(h) - 1), F.lit(1), lambda a, i: a + (F.get(h, i) != F.get(h, i - 1)).cast("int")
                ),
            ).cast("double")
            mean = 2 * n1 * n2 / n + 1
            spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
            mid = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n
            power = F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - mid) * (x - mid))
            lagged = F.aggregate(
                F.sequence(F.lit(1), F.size(v) - 1), F.lit(0.0), lambda a, i: a + (F.get(v, i) - mid) * (F.get(v, i - 1) - mid)
            )
            serial = F.when(power > 0, lagged / power).otherwise(F.lit(1.0)) * F.sqrt(n)
            return F.struct(
                n.alias("n"), uniform.alias("uniform"), ((turns - mean) / spread).alias("runs"), serial.alias("serial")
            )

        return let(F.transform(F.split(core, ""), lambda c: F.instr(chars, c) - 1), valued)

    letters = F.split(core, "")
    likely = F.aggregate(letters, F.lit(0.0), lambda a, c: a + F.coalesce(F.element_at(natural, c), F.lit(-12.0)))
    surprise = -F.length(core) * F.ln(F.length(_alphabet(core, "size"))) - likely
    return F.struct(let(_alphabet(core, "chars"), of).alias("t"), surprise.alias("surprise"))


def _candidates(text: Column) -> Column:
    """Unbroken tokens of ``LEAST_RANDOM`` or more characters of the base64 alphabets."""
    return _spans(text, _TOKEN, "random", 0, LEAST_RANDOM)


def _mixed(token: Column) -> Column:
    """Whether a token has both letters and digits, without which it is a word or a number."""
    return token.rlike("[0-9]") & token.rlike("[A-Za-z]") & (F.length(F.rtrim(token, F.lit("="))) >= LEAST_RANDOM)


def natural_letters(docs: DataFrame) -> DataFrame:
    """One row: ``natural``, log shares of the alphabets' characters in all texts outside long tokens, smoothed.

    Long tokens are left out so that random ones, however many there are, do not pass for ordinary writing. Characters are
    counted by how much shorter a text gets without them, so nothing is shuffled but one row a task.
    """
    chars = ALPHABETS[-1][1]
    plain = docs.select(F.regexp_replace("text", r"[A-Za-z0-9+/_-]{20,}+", " ").alias("plain"))
    count = lambda c: F.octet_length("plain") - F.octet_length(F.replace("plain", F.lit(c), F.lit("")))
    one = F.lit(1).cast("long")
    counts = plain.agg(*[(F.coalesce(F.sum(count(c)), F.lit(0)) + one).alias(f"n{i}") for i, c in enumerate(chars)])
    total = sum((F.col(f"n{i}") for i in range(1, len(chars))), F.col("n0"))
    shares = [x for i, c in enumerate(chars) for x in (F.lit(c), F.ln(F.col(f"n{i}") / total))]
    return counts.select(F.create_map(*shares).alias("natural"))


def _weighed(tested: Column, mean_length: Column) -> Column:
    """Surprise after the weight that a token's length gives it: longer ones get more of the error budget."""
    return tested["surprise"] + F.ln(F.greatest(tested["t"]["n"], F.lit(1.0)) / mean_length)


def discovery_threshold(tested: DataFrame, rate: float = DISCOVERY_RATE) -> DataFrame:
    """One row: ``threshold``, the least weighed surprise that the Benjamini-Hochberg rule at ``rate`` lets through.

    Surprise is rounded down to bins, so the rule is on the safe side; their number is fixed. Nothing passes where
    there is no threshold.
    """
    binned = tested.select(F.greatest(F.lit(0), F.least(F.lit(_BINS), F.floor(F.col("weighed") * _STEP))).alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    run = counts.select("bin", F.sum("n").over(above).alias("upto"), F.sum("n").over(every).alias("all"))
    passing = run.filter(F.exp(-F.col("bin") / _STEP) <= rate * F.col("upto") / F.col("all"))
    return passing.agg((F.min("bin") / _STEP).alias("threshold"))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", rate: float = DISCOVERY_RATE) -> DataFrame:
    """(doc_id, spans) for every row: ``spans`` is an array of (start, rank, end, token) sorted by start and kind.

    ``rank`` counts in ``KINDS``. Positions are in code points, ends exclusive. The base kinds are found by their
    patterns alone. A ``random`` span is a long token with letters and digits, outside the base spans, that passes all
    tests for randomness and whose surprise, against the letters of all texts outside long tokens, passes the
    false-discovery threshold over the candidates of all documents.
    Null and empty texts have no spans; repeated rows give repeated results.
    """
    narrow = pick(docs, doc_id=key, text=text).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    tokens = narrow.select(F.explode(_candidates(F.col("text"))["token"]).alias("token"))
    natural = natural_letters(narrow).scalar()
    mixed = tokens.filter(_mixed(F.col("token"))).withColumn("natural", natural)
    measured = mixed.select(_tests(F.col("token"), F.col("natural")).alias("x"))
    mean = measured.agg(F.coalesce(F.avg("x.t.n"), F.lit(1.0))).scalar()
    threshold = discovery_threshold(
        measured.withColumn("mean", mean).select(_weighed(F.col("x"), F.col("mean")).alias("weighed")), rate
    ).scalar()
    given = narrow.withColumns({"natural": natural, "mean": mean, "threshold": threshold})
    lowered = F.lower("text")
    named = (
        lowered.contains("passw") | lowered.contains("secret") | lowered.contains("token") | lowered.contains("key")
    )
    none = F.array().cast("array<struct<start:int,rank:int,end:int,token:string>>")
    base = F.concat(
        F.when(named, _spans(F.col("text"), _ASSIGN, "assign", 2, LEAST_ASSIGN)).otherwise(none),
        F.when(F.col("text").contains("AKIA"), _spans(F.col("text"), _ACCESS, "access", 0, LEAST_ACCESS)).otherwise(none),
        _spans(F.col("text"), _HEX, "hex"),
    )

    def random(x: Column) -> Column:
        t = x["t"]
        shaped = (t["uniform"] <= MOST_Z) & (F.abs(t["runs"]) <= MOST_Z) & (F.abs(t["serial"]) <= MOST_Z)
        return shaped & (F.floor(_weighed(x, F.col("mean")) * _STEP) / _STEP >= F.col("threshold"))

    def with_random(known: Column) -> Column:
        apart = lambda s: ~F.exists(known, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        added = F.filter(
            F.col("candidates"),
            lambda s: F.when(
                _mixed(s["token"]) & apart(s), let(_tests(s["token"], F.col("natural")), random)
            ).otherwise(F.lit(False)),
        )
        return F.sort_array(F.concat(known, added))

    found = given.withColumns({"base": base, "candidates": _candidates(F.col("text"))})
    return found.select("doc_id", let(F.col("base"), with_random).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
