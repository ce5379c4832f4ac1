"""Language of texts: first the family, then the language by votes of linear machines.

Texts are counted as hashed runs of two and three letters.  A multinomial model over the
families' run counts chooses the family; inside it, each two languages have a linear
support vector machine of their own, and the language that wins most of these is
predicted.  Everything is learned from a bounded sample of labelled rows, each machine in
a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.columns import chosen_by_hash
from wattloom.llm.memory import frugal
from wattloom.workspace import materialize

# Labelled rows of each language that are learned from, and languages that are learned at most.
LEARN_ROWS, LEARN_LANGUAGES = 1_500, 200
UNDETERMINED = "und"
DIMENSIONS = 1 << 12
# Characters that are counted at a time, and texts that are scored at a time.
CHARACTERS_AT_ONCE, TEXTS_AT_ONCE = 1 << 20, 256
# Passes over the sample, weight of errors, and the added count of the multinomial model.
PASSES, ERROR_WEIGHT, SMOOTHING = 20, 1.0, 0.5

# Languages by family; a language that is not listed belongs to "other".
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af lb fy yi",
    "romance": "fr es it pt ro ca gl oc ast",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "indic": "hi bn ur pa gu mr ne si",
    "semitic": "ar he am mt",
    "celtic": "ga gd cy br",
    "dravidian": "ta te kn ml",
    "austronesian": "id ms jv tl mg",
    "sinitic": "zh yue wuu",
}
_FAMILY_OF = {language: family for family, languages in FAMILIES.items() for language in languages.split()}
OTHER = "other"


def family_of(language: str) -> str:
    """Family of a language code such as ``en`` or ``pt-BR``."""
    return _FAMILY_OF.get(language.lower().replace("_", "-").split("-")[0], OTHER)


# Odd numbers that spread the letters of a run over 32 bits.
_MIX = {
    2: np.array([0x9E3779B1, 0x85EBCA6B], np.uint32),
    3: np.array([0xC2B2AE35, 0x27D4EB2F, 0x165667B1], np.uint32),
}
_LAST_MIX = np.uint32(0x2C1B3C6D)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The lower-case letter of every character, 0 for what is no letter."""
    return np.array([ord(c.lower()[0]) if c.isalpha() else 0 for c in map(chr, range(0x110000))], np.uint32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def run_counts(text: str) -> np.ndarray:
    """Counts of hashed runs of two and three letters of a whole text.

    Letters are lower-cased; all else between words is one blank, so that runs tell the
    ends of words.  A block of a long text is counted with the last characters of the
    one before it.
    """
    counts = np.zeros(DIMENSIONS, np.int64)
    letters = _letters()
    tail = np.zeros(1, np.uint32)
    for start in range(0, len(text), CHARACTERS_AT_ONCE):
        block = text[start : start + CHARACTERS_AT_ONCE].encode("utf-32-le", "surrogatepass")
        codes = np.concatenate([tail, letters[np.frombuffer(block, np.uint32)]])
        full = codes != 0
        full[1:] |= full[:-1]
        full[: len(tail)] = True
        codes = codes[full]
        _count_runs(codes, len(tail), counts)
        tail = codes[-2:]
    if tail[-1]:
        _count_runs(np.append(tail, np.uint32(0)), len(tail), counts)
    return counts


def _count_runs(codes: np.ndarray, seen: int, counts: np.ndarray, lengths: tuple[int, ...] = (2, 3)) -> None:
    """Add the runs that end after the first ``seen`` codes."""
    shift = np.uint32(32 - (DIMENSIONS.bit_length() - 1))
    for length in lengths:
        own = codes[max(0, seen - length + 1) :]
        n = len(own) - length + 1
        if n < 1:
            continue
        runs = own[:n] * _MIX[length][0]
        for k in range(1, length):
            runs += own[k : k + n] * _MIX[length][k]
        runs ^= runs >> np.uint32(15)
        runs *= _LAST_MIX
        counts += np.bincount(runs >> shift, minlength=DIMENSIONS)


def unit(counts: np.ndarray) -> np.ndarray:
    """Rows of square roots of counts, of length 1."""
    roots = np.sqrt(counts.astype(np.float64))
    return roots / np.maximum(np.sqrt((roots**2).sum(axis=-1, keepdims=True)), 1e-12)


def fit_machine(features: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Weights (the last one for a constant 1) of a linear support vector machine.

    Dual coordinate descent on the squared hinge loss: each row's multiplier is set to
    its best value in turn, with both signs given the same total weight.
    """
    rows = np.hstack([features, np.ones((len(features), 1))])
    share = np.where(signs > 0, (signs > 0).mean(), (signs < 0).mean())
    diagonal = share / ERROR_WEIGHT
    squares = (rows**2).sum(axis=1) + diagonal
    weights, multipliers = np.zeros(rows.shape[1]), np.zeros(len(rows))
    draw = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in draw.permutation(len(rows)):
            slope = signs[i] * (rows[i] @ weights) - 1 + diagonal[i] * multipliers[i]
            new = max(0.0, multipliers[i] - slope / squares[i])
            if new != multipliers[i]:
                weights += (new - multipliers[i]) * signs[i] * rows[i]
                multipliers[i] = new
    return weights


@dataclass(frozen=True)
class LanguageModel:
    """Log shares of runs by family, and a machine for each two languages of a family."""

    families: list[str]
    log_shares: np.ndarray
    languages: dict[str, list[str]]
    pairs: dict[str, list[tuple[int, int]]]
    machines: dict[str, np.ndarray]

    def predict(self, counts: np.ndarray) -> list[tuple[str, float]]:
        """Language and score of each row of counts."""
        likely = counts @ self.log_shares.T
        likely -= likely.max(axis=1, keepdims=True)
        # Runs of a text are not independent: a tenth of them counts.
        certain = np.exp(likely / 10)
        certain /= certain.sum(axis=1, keepdims=True)
        best = likely.argmax(axis=1)
        found: list = [None] * len(counts)
        for k, family in enumerate(self.families):
            rows = np.flatnonzero(best == k)
            if len(rows):
                votes, chances = self._vote(family, counts[rows])
                names = self.languages[family]
                for row, vote, chance in zip(rows, votes, chances):
                    found[row] = (names[vote], float(certain[row, k] * chance))
        return found

    def _vote(self, family: str, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language with most won pairs (ties: greater margins) and its mean chance in them."""
        names, pairs = self.languages[family], self.pairs[family]
        if not pairs:
            return np.zeros(len(counts), int), np.ones(len(counts))
        machines = self.machines[family]
        margins = unit(counts) @ machines[:, :-1].T + machines[:, -1]
        chances = 1 / (1 + np.exp(-3 * np.clip(margins, -30, 30)))
        won, sure = np.zeros((len(counts), len(names))), np.zeros((len(counts), len(names)))
        for k, (a, b) in enumerate(pairs):
            won[:, a] += margins[:, k] >= 0
            won[:, b] += margins[:, k] < 0
            sure[:, a] += chances[:, k]
            sure[:, b] += 1 - chances[:, k]
        sure /= len(names) - 1
        votes = (won + sure / 2).argmax(axis=1)
        return votes, sure[np.arange(len(votes)), votes]


def _sample(labelled: DataFrame, learn_rows: int, learn_languages: int, seed: int) -> DataFrame:
    """Up to ``learn_rows`` rows, by hash, of each of the languages with most rows."""
    totals = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    totals = totals.orderBy(F.col("n").desc(), "lang").limit(learn_languages)
    shares = [(r["lang"], min(1.0, 0.97 * learn_rows / r["n"])) for r in totals.collect()]
    if not shares:
        return labelled.limit(0)
    chosen = [(F.col("lang") == lang) & chosen_by_hash(share, F.lit(seed), "doc_id", "text") for lang, share in shares]
    return labelled.where(reduce(Column.__or__, chosen))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [run_counts(text.as_py()) for text in batch["text"]]
        places = [np.flatnonzero(c) for c in counts]
        yield pa.RecordBatch.from_arrays(
            [
                batch["lang"],
                batch["row"],
                pa.array([p.tolist() for p in places], pa.list_(pa.int32())),
                pa.array([c[p].tolist() for c, p in zip(counts, places)], pa.list_(pa.int64())),
            ],
            ["lang", "row", "places", "counts"],
        )


def _dense(table: pd.DataFrame) -> np.ndarray:
    rows = np.zeros((len(table), DIMENSIONS))
    for row, places, counts in zip(rows, table["places"], table["counts"]):
        row[np.asarray(places, int)] = counts
    return rows


def _fit_pair(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
    first, second = key
    table = table.sort_values(["row", "lang"], kind="stable")
    signs = np.where(table["lang"].to_numpy() == first, 1.0, -1.0)
    weights = fit_machine(unit(_dense(table)), signs)
    return pd.DataFrame({"first": [first], "second": [second], "weights": [weights.tolist()]})


def learn_languages(
    labelled: DataFrame,
    learn_rows: int = LEARN_ROWS,
    learn_languages: int = LEARN_LANGUAGES,
    seed: int = 23,
) -> LanguageModel | None:
    """A model from ``doc_id, text, lang`` rows, or nothing if there are none.

    The driver receives sums for each family and one vector of weights for each pair:
    numbers that depend on the bounds of the sample, not on the table.
    """
    chosen = _sample(labelled, learn_rows, learn_languages, seed)
    sample = materialize(
        chosen.select("lang", F.xxhash64("doc_id", "text").alias("row"), "text").mapInArrow(
            _counted, "lang string, row bigint, places array<int>, counts array<bigint>"
        ),
        "runs",
    )
    names = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not names:
        return None
    families = sorted({family_of(n) for n in names})
    languages = {f: [n for n in names if family_of(n) == f] for f in families}
    pairs = {f: list(combinations(range(len(own)), 2)) for f, own in languages.items()}
    spark = labelled.sparkSession

    sums = np.zeros((len(families), DIMENSIONS))
    of_family = spark.createDataFrame([(n, families.index(family_of(n))) for n in names], "lang string, family int")
    # Each language has the same say in its family, however many rows it has.
    by_run = (
        sample.select("lang", F.explode(F.arrays_zip("places", "counts")).alias("run"))
        .groupBy("lang", "run.places")
        .agg(F.sum("run.counts").alias("n"))
    )
    whole = by_run.groupBy("lang").agg(F.sum("n").alias("total"))
    for r in (
        by_run.join(F.broadcast(whole), "lang")
        .join(F.broadcast(of_family), "lang")
        .groupBy("family", "places")
        .agg(F.sum(F.col("n") / F.col("total")).alias("share"))
        .collect()  # at most DIMENSIONS rows a family
    ):
        sums[r["family"], r["places"]] = r["share"]
    total = whole.agg(F.max("total")).first()[0] or 1
    shares = sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-12)
    log_shares = np.log((shares * total + SMOOTHING) / (total + SMOOTHING * DIMENSIONS))

    wanted = [(languages[f][a], languages[f][b]) for f in families for a, b in pairs[f]]
    weights = {}
    if wanted:
        both = spark.createDataFrame(
            [(a, b, x) for a, b in wanted for x in (a, b)], "first string, second string, lang string"
        )
        fitted = (
            sample.join(F.broadcast(both), "lang")
            .groupBy("first", "second")
            .applyInPandas(_fit_pair, "first string, second string, weights array<double>")
        )
        weights = {(r["first"], r["second"]): r["weights"] for r in fitted.collect()}
    machines = {
        f: np.array([weights[languages[f][a], languages[f][b]] for a, b in pairs[f]]) for f in families
    }
    return LanguageModel(families, log_shares, languages, pairs, machines)


def language_ids(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    learn_rows: int = LEARN_ROWS,
    learn_languages_at_most: int = LEARN_LANGUAGES,
    seed: int = 23,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``documents``.

    Rows whose ``crc32`` of the id as text leaves 1 by 3 are held out: their languages are
    never read.  At most ``learn_rows`` rows of each of the ``learn_languages_at_most``
    languages with most rows are learned from; all rows are predicted, whole texts of any
    length.  ``score`` is between 0 and 1: the chance of the family times that of the
    language in it.

    Texts that are null, empty or without a letter are ``und`` with score 0 and are not
    learned from; so are all texts if there is nothing to learn from.  Rows without an id
    or a language are not learned from, and null ids are not held out.  Repeated rows are
    predicted each.  Other columns are ignored, whatever their names.  An empty table
    gives no rows.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    docs = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )
    labelled = docs.where((fold != 1) & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    model = learn_languages(labelled, learn_rows, learn_languages_at_most, seed)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(start, TEXTS_AT_ONCE)
                texts = [t.as_py() for t in part["text"]]
                found = [(UNDETERMINED, 0.0)] * len(texts)
                told = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
                if told:
                    counts = np.array([run_counts(texts[i]) for i in told])
                    for i, own in zip(told, model.predict(counts)):
                        found[i] = own
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["held_out"],
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([min(1.0, max(0.0, f[1])) for f in found], pa.float64()),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return docs.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {documents.schema[doc_id].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    )
