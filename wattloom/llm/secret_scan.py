"""Secrets in whole texts: known forms, and strings that pass a battery of randomness tests.

Known forms are three regular expressions.  For any other run of token characters the
encoding is inferred from the characters it uses, and the run is tested as a sequence
over that alphabet:

* chi-squared: are all characters equally frequent (Wilson-Hilferty for the p-value)?
* runs: do characters of the lower and upper half alternate as often as by chance?
* serial correlation: does a character say anything about the next?

A run that any test rejects is no secret.  Whether a run that passes is written text is
asked of the same two things: which characters it has, and what follows what.  A model
of written text in the run's alphabet has the shares of letters, and how vowels,
consonants, capitals, digits and signs follow each other.  By Markov's bound, written text
is x times likelier as a random string with a chance of 1 / x at most, so the inverse of
this likelihood ratio is a p-value whatever the length, and that of a random run falls
exponentially with its length.  Runs of similar length form a family, within which the
Benjamini-Hochberg rule keeps the share of false discoveries below ``FALSE_SHARE``; its step
goes over a histogram of p-values, which has a bounded number of bins.

What is found where one run in twenty is random (measured in the tests, 60 runs each):

* hex and alphabets of several kinds of characters: 0.93 of 16 characters, 0.96 of 20, 0.97
  of 24, 0.98 and more from 32 on;
* letters of one case: some 0.75 of 16, 0.8 of 20, 0.86 of 24, 0.95 of 32, 0.99 of 40;
* digits only: none.  A random number looks like any other, so these are found only in
  known forms: from 32 digits on, or after a name such as ``token``.

Only DataFrame functions are used.  A text is marked by ``regexp_replace`` and split at
the marks, and the lengths of the parts give the positions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.columns import if_small, let, running_starts, total
from wattloom.workspace import materialize

# The known forms; group 2 of the first is the secret itself.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_ASSIGNED = 8
KINDS = ("assign", "access", "hex", "random")

# Runs of token characters that are tested, and what may fill them up at the end.
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])"
_DIGITS = "0123456789"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
# Alphabets from the narrowest on; a run has the first that holds all its characters.
ALPHABETS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "upper hex": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "upper": _UPPER,
    "base32": _UPPER + "234567",
    "upper base36": _DIGITS + _UPPER,
    "base36": _DIGITS + _LOWER,
    "letters": _UPPER + _LOWER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "mixed": _UPPER + _LOWER + _DIGITS + "+/-_",
}
# Chance that a random string is rejected by the battery, share of false discoveries.
BATTERY_LEVEL = 0.01
FALSE_SHARE = 0.01
# Share of each letter from a to z in written English.
LETTER_SHARES = (
    0.082, 0.015, 0.028, 0.043, 0.127, 0.022, 0.020, 0.061, 0.070, 0.0015, 0.0077, 0.040, 0.024,
    0.067, 0.075, 0.019, 0.00095, 0.060, 0.063, 0.091, 0.028, 0.0098, 0.024, 0.0015, 0.020, 0.00074,
)
# Chances that written text goes from one class of characters (row) to another, in
# the order lower-case vowel and consonant, capital vowel and consonant, digit, sign; the
# last row is for the first character.  Estimates for prose, names and file paths.
VOWELS = "aeiouy"
STEPS = (
    (0.130, 0.790, 0.005, 0.015, 0.020, 0.040),
    (0.480, 0.440, 0.005, 0.015, 0.020, 0.040),
    (0.100, 0.350, 0.080, 0.430, 0.020, 0.020),
    (0.300, 0.100, 0.300, 0.250, 0.030, 0.020),
    (0.015, 0.025, 0.010, 0.020, 0.860, 0.070),
    (0.220, 0.420, 0.060, 0.120, 0.140, 0.040),
    (0.250, 0.450, 0.080, 0.140, 0.060, 0.020),
)
# Least lengths of the families.
FAMILIES = (16, 24, 32, 48, 64, 128)
# Histogram bins for each factor e of the p-value, and the greatest exponent told apart.
BINS = 20
GREATEST = 700

# Marks: code points that stand for no character.
_OPEN, _MIDDLE, _CLOSE = "\ufdd0", "\ufdd1", "\ufdd2"


def _cleared(text: Column) -> Column:
    """The text without the marks' characters; as long as before."""
    return F.translate(text, _OPEN + _MIDDLE + _CLOSE, "\ufffd" * 3)


def _spans(text: Column, pattern: str, replacement: str, keep) -> Column:
    """``array<struct<start,end>>`` of a pattern's matches in code points, those that ``keep`` takes.

    ``replacement`` puts the marks; ``keep`` gets a part, which begins with a match.
    """

    def of_parts(parts: Column) -> Column:
        inner = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
        widths = F.transform(
            parts, lambda p: F.length(F.translate(p, _MIDDLE + _CLOSE, "")).cast("long")
        )
        return let(
            running_starts(widths),
            lambda starts: F.transform(
                F.filter(
                    F.transform(inner, lambda p, i: F.struct(p.alias("p"), F.get(starts, i + 1).alias("s"))),
                    lambda x: keep(x["p"]),
                ),
                lambda x: F.struct(
                    x["s"].alias("start"),
                    (
                        x["s"]
                        + F.instr(F.translate(x["p"], _MIDDLE, ""), _CLOSE)
                        - 1
                    ).alias("end"),
                    F.translate(F.substring_index(x["p"], _CLOSE, 1), _MIDDLE, "").alias("match"),
                ),
            ),
        )

    marked = F.regexp_replace(text, pattern, replacement)
    found = let(F.split(marked, _OPEN), of_parts)
    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the known forms as ``array<struct<start,kind,end>>``, by start, then kind."""
    plain = f"{_OPEN}$0{_CLOSE}"

    def long_enough(part: Column) -> Column:
        return F.instr(part, _CLOSE) - F.instr(part, _MIDDLE) - 1 >= LEAST_ASSIGNED

    every = lambda part: F.lit(True)
    found = [
        _spans(text, ASSIGN, f"{_OPEN}$1{_MIDDLE}$2{_CLOSE}", long_enough),
        _spans(text, ACCESS, plain, every),
        _spans(text, HEX, plain, every),
    ]

    def tagged(kind: int, spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")
            ),
        )

    return F.array_sort(F.concat(*[tagged(kind, spans) for kind, spans in enumerate(found)]))


def normal_tail(z: Column) -> Column:
    """Chance of a standard normal value above ``z``, within 2e-7 (relative for large ``z``)."""
    # Coefficients of the rational approximation by Abramowitz and Stegun, 26.2.17.
    p, coefficients = 0.2316419, (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    x = F.abs(z)
    t = 1 / (1 + p * x)
    series = F.lit(0.0)
    for c in reversed(coefficients):
        series = (series + c) * t
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def chi_squared_tail(value: Column, freedom: Column) -> Column:
    """Chance of a chi-squared value above ``value`` (Wilson and Hilferty)."""
    width = 2 / (9 * freedom)
    return normal_tail((F.pow(value / freedom, F.lit(1 / 3)) - (1 - width)) / F.sqrt(width))


def character_class(c: str) -> int:
    """Number of the column of :data:`STEPS`."""
    if c.lower() not in _LOWER:
        return 4 if c in _DIGITS else 5
    return 2 * (c in _UPPER) + (c.lower() not in VOWELS)


def text_model(alphabet: str) -> tuple[list[int], list[float], list[list[float]]]:
    """Of written text in these characters only: their classes, and two kinds of terms.

    The logarithm of how much likelier a random string is than written text is the sum of
    the own terms of its characters less the terms of the steps between their classes
    (the last row of these for the first character).
    """
    classes = [character_class(c) for c in alphabet]
    letters = dict(zip(_LOWER, LETTER_SHARES))
    weights = [letters.get(c.lower(), 1.0) for c in alphabet]
    totals = [sum(w for w, k in zip(weights, classes) if k == other) for other in range(6)]
    own = [math.log(totals[k] / w / len(alphabet)) for w, k in zip(weights, classes)]
    steps = []
    for row in STEPS:
        there = [share if totals[k] else 0.0 for k, share in enumerate(row)]
        steps.append([math.log(share / sum(there)) if share else 0.0 for share in there])
    return classes, own, steps


def _alphabet(body: Column) -> Column:
    """The inferred alphabet as ``struct<characters,classes,own,steps>``."""

    def entry(name: str) -> Column:
        classes, own, steps = text_model(ALPHABETS[name])
        return F.struct(
            F.lit(ALPHABETS[name]).alias("characters"),
            F.lit(classes).alias("classes"),
            F.lit(own).alias("own"),
            F.lit([x for row in steps for x in row]).alias("steps"),
        )

    names = list(ALPHABETS)
    chosen = entry(names[-1])
    for name in reversed(names[:-1]):
        fits = F.length(F.translate(body, ALPHABETS[name], "")) == 0
        chosen = F.when(fits, entry(name)).otherwise(chosen)
    return chosen


def _surprise(places: Column, alphabet: Column) -> Column:
    """Logarithm of how much likelier a random string is than written text."""
    own = _sum(F.transform(places, lambda p: F.element_at(alphabet["own"], p)))
    after = F.transform(places, lambda p: F.element_at(alphabet["classes"], p))
    first = F.lit(len(STEPS) - 1)
    steps = let(
        after,
        lambda classes: _sum(
            F.transform(
                classes,
                lambda k, i: F.get(
                    alphabet["steps"], F.when(i == 0, first).otherwise(F.get(classes, i - 1)) * 6 + k
                ),
            )
        ),
    )
    return own - steps


def _chi_squared(body: Column, characters: Column) -> Column:
    counts = F.transform(
        F.split(characters, ""),
        lambda c: (F.length(body) - F.length(F.replace(body, c, F.lit("")))).cast("long"),
    )
    squares = total(F.transform(counts, lambda c: c * c))
    return F.length(characters) / F.length(body) * squares - F.length(body)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _order_tests(places: Column, half: Column) -> Column:
    """z-values of the runs and serial-correlation tests of places in the alphabet, from 1 on."""
    n = F.size(places).cast("double")
    before = F.slice(places, F.lit(1), F.size(places) - 1)
    after = F.slice(places, F.lit(2), F.size(places) - 1)

    def tests(mean: Column) -> Column:
        products = _sum(F.zip_with(before, after, lambda a, b: (a - mean) * (b - mean)))
        squares = _sum(F.transform(places, lambda x: (x - mean) * (x - mean)))
        changes = _sum(
            F.zip_with(before, after, lambda a, b: F.when((a > half) != (b > half), 1.0).otherwise(0.0))
        )
        upper = _sum(F.transform(places, lambda x: F.when(x > half, 1.0).otherwise(0.0)))
        both = 2 * upper * (n - upper)
        spread = both * (both - n) / (n * n * (n - 1))
        return F.struct(
            F.when(spread > 0, (changes - both / n) / F.sqrt(spread)).otherwise(F.sqrt(n)).alias("runs"),
            F.when(squares > 0, (products / squares + 1 / n) * F.sqrt(n))
            .otherwise(F.sqrt(n))
            .alias("correlation"),
        )

    return let(_sum(F.transform(places, lambda x: x.cast("double"))) / n, tests)


def battery(match: Column) -> Column:
    """``struct<length,passes,p_text>`` of a run of token characters.

    ``passes`` says that no test rejects randomness, ``p_text`` bounds the chance that
    written text of this alphabet looks as random.
    """

    def judged(body: Column, alphabet: Column) -> Column:
        characters = alphabet["characters"]
        half = F.floor(F.length(characters) / 2)
        places = F.transform(F.split(body, ""), lambda c: F.position(c, characters))
        n, freedom = F.length(body), (F.length(characters) - 1).cast("double")

        def combined(t: Column) -> Column:
            level = BATTERY_LEVEL / 3
            passes = (
                (chi_squared_tail(t["chi"], freedom) >= level)
                & (2 * normal_tail(F.abs(t["order"]["runs"])) >= level)
                & (2 * normal_tail(F.abs(t["order"]["correlation"])) >= level)
            )
            p_text = F.exp(-F.greatest(t["surprise"], F.lit(0.0)))
            return F.struct(n.alias("length"), passes.alias("passes"), p_text.alias("p_text"))

        return let(
            F.struct(
                _chi_squared(body, characters).alias("chi"),
                let(places, lambda p: _order_tests(p, half)).alias("order"),
                let(places, lambda p: _surprise(p, alphabet)).alias("surprise"),
            ),
            combined,
        )

    return let(
        F.rtrim(match, F.lit("=")), lambda body: let(_alphabet(body), lambda a: judged(body, a))
    )


def _family(length: Column) -> Column:
    family = F.lit(0)
    for number, least in enumerate(FAMILIES):
        family = F.when(length >= least, F.lit(number)).otherwise(family)
    return family


def _thresholds(runs: DataFrame) -> DataFrame:
    """Per family, the least bin of p-values that the Benjamini-Hochberg rule takes."""
    # At most BINS * GREATEST + 2 rows per family.
    histogram = runs.groupBy("family", "bin").agg(F.count("*").alias("n"))
    family = Window.partitionBy("family")
    surer = family.orderBy(F.col("bin").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        histogram.select(
            "family",
            "bin",
            F.sum("n").over(family).alias("tested"),
            F.sum("n").over(surer).alias("found"),
        )
        .where("bin >= 0")
        .where(F.exp(-F.col("bin") / BINS) * F.col("tested") <= FALSE_SHARE * F.col("found"))
        .groupBy("family")
        .agg(F.min("bin").alias("least_bin"))
    )


def find_secrets(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, base, spans`` and the columns named in ``carry`` for each row of ``documents``.

    ``base`` and ``spans`` are ``array<struct<start,kind,end>>`` in code points (end
    exclusive), ordered by start and kind; kinds are numbers of :data:`KINDS`.  ``spans``
    adds random runs that overlap no known form.

    A null or empty text has no spans; texts and runs of any length are taken whole; a null
    id stays null; repeated rows are documents each; other columns are ignored, whatever their names; an empty table gives an empty
    result.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    plain = documents.select(
        F.struct(F.col(doc_id).alias("doc_id"), *carry).alias("row"), body.alias("body")
    ).withColumn("ref", F.monotonically_increasing_id())
    marked = F.when(
        F.col("body").rlike(f"{ASSIGN}|{ACCESS}|{HEX}|{RUN}"), _cleared(F.col("body"))
    ).otherwise(F.lit(""))
    known = plain.select("ref", "row", marked.alias("body")).select(
        "ref",
        "row",
        base_spans(F.col("body")).alias("base"),
        _spans(F.col("body"), RUN, f"{_OPEN}$0{_CLOSE}", lambda part: F.lit(True)).alias("runs"),
    )
    free = F.filter(
        "runs",
        lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (b["end"] > r["start"])),
    )
    scanned = materialize(known.select("ref", "row", "base", free.alias("runs")), "scanned")

    runs = scanned.select("ref", F.explode("runs").alias("r")).select(
        "ref", "r.start", "r.end", battery(F.col("r.match")).alias("t")
    )
    exponent = F.least(-F.log(F.greatest(F.col("t.p_text"), F.lit(1e-300))), F.lit(float(GREATEST)))
    runs = materialize(
        runs.select(
            "ref",
            "start",
            "end",
            _family(F.col("t.length")).alias("family"),
            F.when(F.col("t.passes"), F.floor(F.greatest(exponent, F.lit(0.0)) * BINS))
            .otherwise(F.lit(-1))
            .cast("int")
            .alias("bin"),
        ),
        "runs",
    )
    # One row per family.
    taken = runs.join(F.broadcast(_thresholds(runs)), "family").where("bin >= least_bin")
    span = F.struct("start", F.lit(KINDS.index("random")).alias("kind"), "end")
    added = materialize(taken.groupBy("ref").agg(F.collect_list(span).alias("added")), "added")
    return scanned.join(if_small(added), "ref", "left").select(
        "row.*",
        "base",
        F.array_sort(
            F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))
        ).alias("spans"),
    )


def count_of(spans: Column, kind: str) -> Column:
    """Number of spans of one kind."""
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def written_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """``text`` with each span, or chain of overlapping spans, replaced by ``mark``."""
    first = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        upto = F.greatest(s["start"], acc["at"])
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (upto - acc["at"]).cast("int"))
        fresh = (s["start"] >= acc["at"]) & ((s["start"] > 0) | (acc["at"] == 0))
        return F.struct(
            F.concat(acc["done"], F.when(fresh, F.concat(gap, F.lit(mark))).otherwise("")).alias("done"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    return F.aggregate(
        spans,
        first,
        step,
        lambda acc: F.concat(
            acc["done"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))
        ),
    )
