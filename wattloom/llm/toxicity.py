"""Toxicity scores: boosted trees over dense features of a text, calibrated.

The labelled rows that may be learned from are split by a hash of their id into
``FOLDS`` folds:

1. *lexicon*: words and word beginnings that occur in far more toxic than clean texts.
   Features of a fold to learn from come from the lexicon of the other folds, so trees
   see terms as they will meet them in new texts; the final lexicon is that of all folds;
2. *trees*: gradient-boosted trees over the features of all folds but the last;
3. *calibration*: isotonic regression of the last fold's labels on the trees' probability.

Features are densities of strong and weak lexicon terms over the text and in its densest
stretch, their nearness to words of the second person, and rates of capitals, punctuation,
digits and obfuscation.  Words are coded once per worker and a text is then an array of
codes, so whole texts of any length are scored.  Labels, ids and other columns are
never features.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm.columns import chosen_by_hash
from wattloom.llm.memory import frugal
from wattloom.workspace import materialize

# At most so many labelled rows are learned from, chosen by a hash of their id.
LEARN_ROWS = 24_000
# Lexicon: at most so many terms, in at least so many toxic texts and
# such a share of them, so many times likelier there.
LEXICON_TERMS = 1_000
LEAST_TEXTS, LEAST_SHARE = 3, 0.02
STRONG_ODDS, WEAK_ODDS = 30.0, 4.0
FOLDS = 5
TREES, DEPTH = 20, 4
STRETCH, NEARNESS = 25, 5
CACHE_LIMIT = 150_000

# Words of the second person in English, German, French and Spanish.
SECOND_PERSON = (
    "you your yours yourself ur u du dich dir dein deine deiner deinen ihr euch euer sie ihnen "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros"
).split()
# Characters that stand for letters in obfuscated words.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

FEATURES = (
    "strong_density",
    "weak_density",
    "strong_count",
    "strong_stretch",
    "second_person",
    "strong_near_second_person",
    "capital_letters",
    "capital_words",
    "exclamations",
    "questions",
    "punctuation",
    "digits",
    "obfuscated",
    "stretched",
    "words",
)

_STRONG, _WEAK, _YOU, _CAPITAL, _OBFUSCATED, _STRETCHED = (1 << i for i in range(6))
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…¿¡"
_THRICE = re.compile(r"(.)\1\1")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = bytes(range(ord("0"), ord("9") + 1))
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def bare(word: str) -> str:
    """A word in lower case without punctuation at its ends."""
    return word.strip(_EDGES).lower()


def terms(word: str) -> list[str]:
    """What the lexicon may hold of a bare word: itself, and its beginnings with a mark."""
    return [word, *("^" + word[:n] for n in range(4, 7) if len(word) >= n)] if word else []


def _deciphered(word: str) -> str:
    plain = "".join(LOOKALIKES.get(c, c) for c in word)
    return _THRICE.sub(r"\1", plain)


class _Codes(dict):
    """Flags of each raw word."""

    def __init__(self, strong: frozenset[str], weak: frozenset[str]):
        super().__init__()
        self._strong, self._weak = strong, weak

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_LIMIT:
            self.clear()
        own = bare(word)
        found = terms(own)
        code = _YOU if own in SECOND_PERSON else 0
        if len(own) > 1 and word.isupper():
            code |= _CAPITAL
        stretched = _THRICE.search(own) is not None
        code |= _STRETCHED if stretched else 0
        letters = sum(c.isalpha() for c in own)
        if letters and any(c in LOOKALIKES for c in own):
            code |= _OBFUSCATED
        if code & (_OBFUSCATED | _STRETCHED):
            found = found + terms(_deciphered(own))
        if any(t in self._strong for t in found):
            code |= _STRONG
        elif any(t in self._weak for t in found):
            code |= _WEAK
        self[word] = code
        return code


def text_features(text: str | None, codes: dict[str, int]) -> list[float]:
    """The values of :data:`FEATURES`; all 0 for a text without words."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    own = np.fromiter(map(codes.__getitem__, words), np.uint8, n)
    flag = lambda f: (own & f) > 0
    strong, you = flag(_STRONG), flag(_YOU)
    sums = np.concatenate([[0], np.cumsum(strong)])
    ends = np.minimum(np.arange(n) + STRETCH, n)
    near = np.concatenate([[0], np.cumsum(you)])
    at = np.nonzero(strong)[0]
    close = near[np.minimum(at + NEARNESS + 1, n)] - near[np.maximum(at - NEARNESS, 0)]
    raw = text.encode()
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / len(raw)
    return [
        100.0 * strong.mean(),
        100.0 * flag(_WEAK).mean(),
        math.log1p(strong.sum()),
        float((sums[ends] - sums[:-1]).max()),
        100.0 * you.mean(),
        100.0 * np.count_nonzero(close) / n,
        share(_UPPER),
        100.0 * flag(_CAPITAL).mean(),
        100.0 * text.count("!") / n,
        100.0 * text.count("?") / n,
        share(_PUNCTUATION),
        share(_DIGITS),
        100.0 * flag(_OBFUSCATED).mean(),
        100.0 * flag(_STRETCHED).mean(),
        math.log1p(n),
    ]


_CODES: dict = {}


def _worker_codes(strong: frozenset[str], weak: frozenset[str]) -> dict[str, int]:
    if _CODES.get("lexicon") != (strong, weak):
        _CODES.update(lexicon=(strong, weak), codes=_Codes(strong, weak))
    return _CODES["codes"]


@frugal
def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and clean texts with each term, by fold, of one task."""
    counts: dict[tuple[int, int], Counter] = {}
    for batch in batches:
        for text, toxic, fold in zip(batch["text"], batch["toxic"], batch["fold"]):
            words = {bare(w) for w in (text.as_py() or "").split()}
            own = counts.setdefault((fold.as_py(), toxic.as_py()), Counter())
            own.update({t for w in words for t in terms(w)})
    for (fold, toxic), own in counts.items():
        n = len(own)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(own), pa.string()),
                pa.array([fold] * n, pa.int32()),
                pa.array([v if toxic else 0 for v in own.values()], pa.int64()),
                pa.array([0 if toxic else v for v in own.values()], pa.int64()),
            ],
            ["term", "fold", "toxic", "clean"],
        )


Lexicon = tuple[frozenset[str], frozenset[str]]


def learn_lexicons(learned: DataFrame) -> list[Lexicon]:
    """Strong and weak terms from ``text, toxic, fold`` rows: without each fold, and of all."""
    counts = materialize(
        learned.select("text", "toxic", "fold")
        .mapInArrow(_term_counts, "term string, fold int, toxic long, clean long")
        .groupBy("term", "fold")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "terms",
    )
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in learned.groupBy("fold", "toxic").count().collect()}

    def lexicon(without: int | None) -> Lexicon:
        clean, toxic = (
            sum(n for (fold, kind), n in sizes.items() if kind == k and fold != without) for k in (0, 1)
        )
        if not toxic or not clean:
            return frozenset(), frozenset()
        kept = counts if without is None else counts.where(F.col("fold") != without)
        odds = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / clean)
        rows = (
            kept.groupBy("term")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .where((F.col("toxic") >= max(LEAST_TEXTS, LEAST_SHARE * toxic)) & (odds >= WEAK_ODDS))
            .select("term", odds.alias("odds"), (F.log(odds) * F.col("toxic")).alias("weight"))
            .orderBy(F.col("weight").desc(), "term")
            .limit(LEXICON_TERMS)
            .collect()  # at most LEXICON_TERMS rows
        )
        strong = frozenset(r["term"] for r in rows if r["odds"] >= STRONG_ODDS)
        return strong, frozenset(r["term"] for r in rows) - strong

    return [lexicon(without) for without in (*range(FOLDS), None)]


def with_features(
    documents: DataFrame,
    strong: frozenset[str],
    weak: frozenset[str],
    columns: list[str],
    text_in_row: str | None = None,
) -> DataFrame:
    """``columns`` of each document and its features.

    The text is the column ``text``, or a field of the struct column ``row``.
    """

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _worker_codes(strong, weak)
        for batch in batches:
            texts = batch["row"].field(text_in_row) if text_in_row else batch["text"]
            found = [text_features(text.as_py(), codes) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in columns), pa.array(found, pa.list_(pa.float64()))],
                [*columns, "features"],
            )

    own = documents.select(*columns, *([] if text_in_row else ["text"]))
    kinds = [f"`{c}` {own.schema[c].dataType.simpleString()}" for c in columns]
    return own.mapInArrow(run, ", ".join([*kinds, "features array<double>"]))


def toxicity_scores(
    documents: DataFrame,
    labels: DataFrame,
    learn_rows: int = LEARN_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    seed: int = 17,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``documents``.

    ``carry`` names columns of ``documents`` to pass on, as the struct ``row``.

    Rows whose ``crc32`` of the id as text is divisible by 5 are held out: their labels are
    never read.  ``score`` is between 0 and 1, ``predicted`` 1 from 0.5 on.

    Null and empty texts have features of 0 and are scored like others; null ids are not
    held out and have no label; rows of one id share its label, the greater one if there are
    several; repeated rows are scored each; other columns are ignored, whatever their names.
    Without labels of both kinds every score is the share of toxic ones, or 0; an
    empty table gives an empty result.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    passed = [F.struct(*carry).alias("row")] if carry else []
    text_in_row = text if text in carry and documents.schema[text].dataType == T.StringType() else None
    docs = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), *passed
    ).withColumn("held_out", F.coalesce(fold == 0, F.lit(False)))

    usable = materialize(
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic")),
        "usable",
    )
    # Somewhat fewer by hash, so that the limit hardly ever has anything to cut off.
    share = 0.97 * learn_rows / max(1, usable.count())
    chosen = materialize(
        usable.where(chosen_by_hash(share, F.lit(seed), "doc_id"))
        .withColumn("h", F.xxhash64("doc_id"))
        .orderBy("h", "doc_id")
        .limit(learn_rows),
        "chosen",
    )
    # Copies of a text would make all its words look like terms; at most learn_rows rows are dealt.
    copies = Window.partitionBy(F.xxhash64("text"), "text", "toxic").orderBy("fold")
    learned = materialize(
        docs.join(F.broadcast(chosen), "doc_id")
        .select("text", "toxic", F.pmod("h", F.lit(FOLDS)).cast("int").alias("fold"))
        .withColumn("copy", F.row_number().over(copies))
        .where("copy = 1")
        .drop("copy"),
        "learned",
    )
    *others, final = learn_lexicons(learned)
    featured = materialize(
        reduce(
            DataFrame.union,
            [
                with_features(learned.where(F.col("fold") == k), *own, ["toxic", "fold"])
                for k, own in enumerate(others)
            ],
        )
        .repartition(8, F.xxhash64("features"))
        .sortWithinPartitions("features", "toxic"),
        "featured",
    )
    last = F.col("fold") == FOLDS - 1
    counts = featured.groupBy("toxic", last).count().collect()
    scored = with_features(
        docs, *final, ["doc_id", "held_out", *(["row"] if carry else [])], text_in_row
    )
    if len(counts) < 4:
        share = learned.agg(F.avg("toxic")).first()[0] or 0.0
        scored = scored.withColumn("score", F.lit(float(share)))
    else:
        vectors = featured.withColumn("vector", array_to_vector("features"))
        trees = GBTClassifier(
            featuresCol="vector", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, seed=seed
        ).fit(vectors.where(~last))

        def raised(df: DataFrame) -> DataFrame:
            return trees.transform(df).withColumn("raised", vector_to_array("probability")[1])

        steps = IsotonicRegression(
            featuresCol="raised", labelCol="label", predictionCol="score"
        ).fit(raised(vectors.where(last)).select("raised", F.col("toxic").cast("double").alias("label")))
        scored = steps.transform(raised(scored.withColumn("vector", array_to_vector("features"))))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    found = scored.select("doc_id", "held_out", score.alias("score"), *(["row"] if carry else []))
    return found.select(
        "doc_id",
        "held_out",
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
        *(["row"] if carry else []),
    )
