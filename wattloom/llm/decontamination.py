"""Benchmark passages in documents by SimHash of item-sized windows.

A window is as many consecutive words as an item has; a document of fewer words is one
window of its own.  Windows and items are compared
as multisets of word shingles: the weight of a shingle is how often it occurs, and the
similarity is the sum of the lesser weights over the sum of the greater ones.

1. *Windows.*  A window of similarity ``t`` and its item, both of ``s`` shingles, differ
   in at most ``s - ceil(2 t s / (1 + t))`` of them (a shorter window of ``r`` shingles in
   at most ``r - ceil(t (r + s) / (1 + t))``), so some run of the window's shingles
   all occur in the item, and its length is bounded from below.  Looking up every so
   many-th shingle of a document therefore meets each such run.  Where the run stands in
   the item says nothing of where the window starts, as parts of a passage may have
   changed places.  So all shingles of the documents that were met are looked up, and each
   one found counts for every window over it, by a running sum of where it comes in and
   goes out; windows with as many as the similarity wants are taken, one for each run of
   windows over the same shingles found.
2. *Candidates.*  Each of these windows gets a 64-bit SimHash.  Two fingerprints within
   ``RADIUS`` bits agree in one of eight bytes but for ``RADIUS // 8`` bits, so the
   items' bytes, with all variants, are indexed, and one lookup per byte finds every
   item of the window's length, or longer than its document, within the radius.
3. *Verification* computes the exact similarity.

Only DataFrame functions are used.  A shingle is known by its 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.columns import if_small, let, words_of
from wattloom.workspace import materialize

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
# Sets of similarity 0.8 have a cosine of 0.89 or more; each bit of their fingerprints
# differs with a chance of 0.15, and more than 23 of 64 bits with one of about 1e-5.
RADIUS = 23
_BLOCKS = 8
# Bits of a count of ones; three of them fit a number.
_LANE = 21
_BITS = 64 // _BLOCKS


def _hash(words: Column, at: Column, size: int) -> Column:
    """Hash of the ``size`` words from 0-based position ``at`` on."""
    return F.xxhash64(*[F.get(words, at + i) for i in range(size)])


def _all_shingles(words: Column, size: int) -> Column:
    """Hashes of all shingles; fewer words are one shingle of their own."""
    count = F.size(words) - (size - 1)
    many = F.transform(F.sequence(F.lit(0), count - 1), lambda p: _hash(words, p, size))
    few = F.lit(0).cast("long")
    for n in range(1, size):
        few = F.when(F.size(words) == n, _hash(words, F.lit(0), n)).otherwise(few)
    return F.when(count > 0, many).otherwise(F.array(few))


def _every_shingle(words: Column, width: int, step: int) -> Column:
    """Hashes of the shingles of ``width`` words at every so many-th word; none if there are fewer words."""
    places = F.sequence(F.lit(0), F.size(words) - width, F.lit(step))
    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= width, F.transform(places, lambda p: _hash(words, p, width))).otherwise(none)


def _place(i: Column, n: Column, steps: dict[int, int]) -> Column:
    """First word of shingle ``i`` of those of all widths, one width after the other, of ``n`` words."""
    before, place = F.lit(0), F.lit(None).cast("int")
    for width, step in sorted(steps.items()):
        own = F.when(n >= width, F.floor((n - width) / step).cast("int") + 1).otherwise(0)
        place = F.when((i >= before) & (i < before + own), (i - before) * step).otherwise(place)
        before = before + own
    return place


def _window(m: Column, start: Column, n: Column, size: int, widths: Iterable[int]) -> Column:
    """Shingles of the window from word ``start`` on, out of the columns ``of_`` of all shingles of a width."""
    window = F.array().cast("array<bigint>")
    for width in widths:
        own = F.slice(F.col(f"of_{width}"), start + 1, F.least(n, m) - width + 1)
        window = F.when(F.least(m, F.lit(size)) == width, own).otherwise(window)
    return window


def simhash(shingles: Column) -> Column:
    """64-bit fingerprint: each bit is the weighted majority of the shingles' bits."""
    none = F.lit(0).cast("long")
    ones = lambda b: F.aggregate(
        shingles, none, lambda a, h: a + F.getbit(h, b).cast("long")
    )
    # Three bits are counted at a time, in lanes of one number; longer arrays would overflow them.
    mask = F.lit(sum(1 << _LANE * k for k in range(3))).cast("long")

    def three(b: int) -> Column:
        return F.aggregate(shingles, none, lambda a, h: a + F.shiftright(h, b).bitwiseAND(mask))

    lanes = [three(b) for b in range(_LANE)]
    lane = lambda sums, b: F.shiftright(sums[b % _LANE], _LANE * (b // _LANE)).bitwiseAND(
        F.lit((1 << _LANE) - 1).cast("long")
    )
    counts = F.when(
        F.size(shingles) < 1 << _LANE,
        let(F.array(*lanes), lambda sums: F.array(*[lane(sums, b) for b in range(63)], ones(F.lit(63)))),
    ).otherwise(F.transform(F.sequence(F.lit(0), F.lit(63)), ones))
    masks = F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)])
    return F.aggregate(
        F.zip_with(counts, masks, lambda n, m: F.when(2 * n > F.size(shingles), m).otherwise(none)),
        none,
        lambda a, m: a.bitwiseOR(m),
    )


def weighted_similarity(a: Column, b: Column) -> tuple[Column, Column]:
    """Sums of the lesser and of the greater weights of two arrays of shingle hashes.

    Both are sorted together and passed once, so long windows take hardly more than their length.
    """
    tagged = lambda values, tag: F.transform(
        values, lambda h: F.struct(h.alias("h"), F.lit(tag).alias("tag"))
    )
    none = F.lit(0).cast("long")
    start = F.struct(none.alias("h"), none.alias("a"), none.alias("b"), none.alias("lesser"))

    def step(acc: Column, x: Column) -> Column:
        same = acc["h"] == x["h"]
        kept = lambda c: F.when(same, acc[c]).otherwise(none)
        return F.struct(
            x["h"].alias("h"),
            (kept("a") + (1 - x["tag"])).alias("a"),
            (kept("b") + x["tag"]).alias("b"),
            (acc["lesser"] + F.when(same, none).otherwise(F.least(acc["a"], acc["b"]))).alias("lesser"),
        )

    lesser = F.aggregate(
        F.sort_array(F.concat(tagged(a, 0), tagged(b, 1))),
        start,
        step,
        lambda acc: acc["lesser"] + F.least(acc["a"], acc["b"]),
    )
    return lesser, F.size(a) + F.size(b) - lesser


def least_run(shingles: int, percent: int, of: int | None = None) -> int:
    """Length of the run of common shingles that any window of the similarity has.

    ``of`` is the item's number of shingles, if it is not the window's.
    """
    differ = most_shift(shingles, percent, of)
    return -(-(shingles - differ) // (differ + 1))


def most_shift(shingles: int, percent: int, of: int | None = None) -> int:
    """Shingles of a window of the similarity that may not be its item's.

    They lie where words were put in, taken out or replaced, at the window's edges, and
    over the seams of parts that changed places.  ``of`` is the item's number of shingles,
    if it is not the window's.
    """
    both = shingles + (of or shingles)
    return shingles - -(-percent * both // (100 + percent))


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    size: int = SHINGLE_WORDS,
    percent: int = THRESHOLD_PERCENT,
    radius: int = RADIUS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, start, n_words, similarity``: one row per document and item in it.

    The row names the most similar window, of several the first: its 0-based first word
    and its length in words.  Words are lower-cased runs of characters other than ASCII
    white space; items of fewer words than a shingle are found where all their words are.
    A document of fewer words than an item is compared with it as a whole.

    Texts and items of any length are taken whole; the work for a passage grows with its
    length times the number of windows over its shingles.
    Documents and items with a null id, and null, empty and white-space texts, match
    nothing; repeated rows of a document, or rows that share an id, count as one; other
    columns are ignored, whatever their names; empty tables give an empty result.
    """
    # Texts without words give no shingles; a test of their words would split each text twice.
    docs = documents.select(
        F.col(doc_id).alias("doc_id"), words_of(F.col(text).cast("string")).alias("words")
    ).where("doc_id IS NOT NULL")
    items = materialize(
        benchmark.select(
            F.col(item_id).alias("item_id"), words_of(F.col(item_text).cast("string")).alias("words")
        )
        .where("item_id IS NOT NULL AND size(words) > 0")
        .distinct()
        .select(
            "item_id",
            F.size("words").alias("m"),
            _all_shingles(F.col("words"), size).alias("hashes"),
        )
        .withColumn("print", simhash(F.col("hashes"))),
        "items",
    )
    # One row per item length.
    lengths = [r["m"] for r in items.select("m").distinct().collect()]
    if not lengths:
        return _no_rows(docs, items)
    shingles = {m: max(1, m - size + 1) for m in lengths}
    # Shingles of each width are looked up at every so many-th word.
    steps: dict[int, int] = {}
    for m in lengths:
        width, own = min(m, size), shingles[m]
        # Of windows of the item's length and of documents that are shorter.
        runs = [least_run(n, percent, own) for n in range(-(-percent * own // 100), own + 1)]
        steps[width] = min(steps.get(width, 1 << 30), *runs)

    index = materialize(
        items.select("m", F.explode("hashes").alias("h")).distinct(), "index"
    )

    def looked_up(docs: DataFrame, steps: dict[int, int]) -> DataFrame:
        found = [_every_shingle(F.col("words"), width, step) for width, step in sorted(steps.items())]
        # The arrays are columns before they are taken apart, or each shingle's row would hold the whole text.
        # Outer, as Spark else tests the arrays before and works them out for that from the text.
        return (
            docs.select("doc_id", F.size("words").alias("n"), F.concat(*found).alias("found"))
            .select("doc_id", "n", F.posexplode_outer("found").alias("i", "h"))
            .join(if_small(index), "h")
            .select("doc_id", "n", "m", _place(F.col("i"), F.col("n"), steps).alias("p"))
        )

    met = materialize(looked_up(docs, steps).select("doc_id").distinct(), "met")
    hits = looked_up(docs.join(if_small(met), "doc_id", "left_semi"), dict.fromkeys(steps, 1))
    # Windows over a shingle; with as many as these shingles found, they can be similar enough.
    n_words = F.least(F.col("n"), F.col("m"))
    own = F.greatest(F.col("m") - (size - 1), F.lit(1))
    held = F.greatest(n_words - (size - 1), F.lit(1))
    enough = F.ceil(percent * (held + own) / (100 + percent))
    first = F.greatest(F.col("p") - own + 1, F.lit(0))
    last = F.greatest(F.least(F.col("p"), F.col("n") - F.col("m")), F.lit(0))
    event = lambda at, step: F.struct(at.alias("start"), F.lit(step).alias("step"))
    # A shingle found counts from the first window over it to the last.  Windows between two
    # such events hold the same shingles of items and are as similar, so the first of them is taken.
    so_far = Window.partitionBy("doc_id", "n", "m").orderBy("start")
    places = materialize(
        hits.where(100 * held >= percent * own)
        .select("doc_id", "n", "m", F.explode(F.array(event(first, 1), event(last + 1, -1))).alias("e"))
        .groupBy("doc_id", "n", "m", "e.start")
        .agg(F.sum("e.step").alias("step"))
        .withColumn("found", F.sum("step").over(so_far))
        .where(F.col("found") >= enough)
        .groupBy("doc_id", "n")
        .agg(F.collect_list(F.struct("m", "start")).alias("places")),
        "places",
    )
    windows = (
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
        .join(if_small(places), "doc_id")
        .select("doc_id", "n", "places", words_of(F.col("text")).alias("words"))
        .where(F.size("words") == F.col("n"))
        # Shingles, not words, meet the places, and each window takes its own of them: no row holds a text.
        .select("doc_id", "n", "places", *[_every_shingle(F.col("words"), w, 1).alias(f"of_{w}") for w in steps])
        .select("doc_id", "n", *[f"of_{w}" for w in steps], F.explode("places").alias("w"))
        .select(
            "doc_id",
            "w.m",
            "w.start",
            F.least(F.col("n"), F.col("w.m")).alias("n_words"),
            _window(F.col("w.m"), F.col("w.start"), F.col("n"), size, steps).alias("window"),
        )
        .withColumn("window_print", simhash(F.col("window")))
    )
    windows = materialize(windows, "windows")
    variants = [v for v in range(1 << _BITS) if v.bit_count() <= radius // _BLOCKS]
    byte = lambda c: [
        F.struct(
            F.lit(b).alias("block"),
            F.shiftrightunsigned(c, _BITS * b).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int").alias("value"),
        )
        for b in range(_BLOCKS)
    ]
    blocks = items.select("item_id", "m", "print", F.explode(F.array(*byte("print"))).alias("b"))
    blocks = materialize(
        blocks.select(
            "item_id",
            "m",
            "print",
            "b.block",
            F.explode(F.array(*map(F.lit, variants))).alias("v"),
            F.col("b.value").alias("own"),
        ).select("item_id", "m", "print", "block", F.col("own").bitwiseXOR(F.col("v")).alias("value")),
        "blocks",
    )
    candidates = (
        windows.select(
            "doc_id", "m", "start", "window_print", F.explode(F.array(*byte("window_print"))).alias("b")
        )
        .select("doc_id", "m", "start", "window_print", "b.block", "b.value")
        .join(if_small(blocks), ["m", "block", "value"])
        .where(F.bit_count(F.col("window_print").bitwiseXOR(F.col("print"))) <= radius)
        .select("doc_id", "m", "start", "item_id")
        .distinct()
    )
    lesser, greater = weighted_similarity(F.col("window"), F.col("hashes"))
    verified = (
        candidates.join(windows.select("doc_id", "m", "start", "n_words", "window"), ["doc_id", "m", "start"])
        .join(if_small(items.select("item_id", "m", "hashes")), ["item_id", "m"])
        .select("doc_id", "item_id", "start", "n_words", lesser.alias("lesser"), greater.alias("greater"))
        .where(100 * F.col("lesser") >= percent * F.col("greater"))
    )
    best = F.max_by(
        F.struct("start", "n_words", "similarity"),
        F.struct("similarity", -F.col("start"), -F.col("n_words")),
    )
    return (
        verified.withColumn("similarity", F.col("lesser") / F.col("greater"))
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.start").cast("long").alias("start"),
            F.col("best.n_words").cast("long").alias("n_words"),
            F.col("best.similarity").alias("similarity"),
        )
    )


def _no_rows(docs: DataFrame, items: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    kinds = [f"{c} {df.schema[c].dataType.simpleString()}" for df, c in ((docs, "doc_id"), (items, "item_id"))]
    return spark.createDataFrame([], ", ".join([*kinds, "start long, n_words long, similarity double"]))
