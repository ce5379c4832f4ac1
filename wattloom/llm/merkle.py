"""Merkle manifest of a table: one hash tree for each group of rows, and one over their roots.

The place of a leaf in its tree is its rank among the ids of its group.  Ids are gathered
as bitmaps of 64-bit words, one word for 64 neighbouring ids, kept only where they are not
empty; a directory of row counts over words, containers of 64 words and, for wide ranges
of ids, coarser spans of 4,096 gives every rank without sorting the rows.  Leaves then go
to arrays of 4,096 slots by rank, and each array is folded three levels at once; what
remains goes to arrays of 4,096 again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.ranking import with_global_index
from wattloom.llm.columns import if_small, let
from wattloom.workspace import materialize

# Children of a node, and levels that one array of slots folds: 16 ** 3 slots.
WAYS, LEVELS = 16, 3
SLOTS = WAYS**LEVELS
# Containers below one entry of a directory, as a power of two.
_SPAN_BITS = 12
# Rows without an id come before all words of ids.
_NO_ID_WORD = -(2**57) - 1
_DIGEST = 64
# Hex digits of a leaf by which rows of one id are ranked: as many as fit a long.
_PREFIX_DIGITS = 15
# Copies of a row that are put in place by one task.
_COPIES_AT_ONCE = 10_000
PATH_TYPE = "array<struct<left:string,right:string>>"


def field_text(value: Column) -> Column:
    """Length in UTF-8 and text of a value, so that fields cannot run into each other."""
    text = value.cast("string")
    written = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(value.isNull(), F.lit("-")).otherwise(written)


def leaf_hash(*values: Column) -> Column:
    """Hex SHA-256 of a row's fields."""
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    up = lambda node, level: F.sha2(F.concat(level["left"], node, level["right"]), 256)
    return F.aggregate(path, leaf, up)


def siblings(path: Column) -> Column:
    """All siblings on a path as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _shifted(value: Column, bits: int) -> Column:
    return F.shiftright(value, bits)


def _with_bases(counts: DataFrame, least: int, greatest: int) -> DataFrame:
    """``base``, the rows of earlier spans of the tree, and ``tree_rows``, its rows, for ``tree, span, rows``.

    Spans are summed under coarser ones until a tree has few, so no window holds more
    than 2 ** 12 of them, however many ids a tree has or how far apart they are.
    """
    earlier = (Window.unboundedPreceding, -1)
    if greatest - least < 1 << _SPAN_BITS:
        own = Window.partitionBy("tree")
        return counts.select(
            "tree",
            "span",
            F.coalesce(F.sum("rows").over(own.orderBy("span").rowsBetween(*earlier)), F.lit(0)).alias("base"),
            F.sum("rows").over(own).alias("tree_rows"),
        )
    parents = counts.withColumn("parent", _shifted(F.col("span"), _SPAN_BITS))
    above = _with_bases(
        parents.groupBy("tree", F.col("parent").alias("span")).agg(F.sum("rows").alias("rows")),
        least >> _SPAN_BITS,
        greatest >> _SPAN_BITS,
    ).select("tree", F.col("span").alias("parent"), F.col("base").alias("above"), "tree_rows")
    inside = F.sum("rows").over(
        Window.partitionBy("tree", "parent").orderBy("span").rowsBetween(*earlier)
    )
    return (
        parents.withColumn("inside", F.coalesce(inside, F.lit(0)))
        .join(above, ["tree", "parent"])
        .select("tree", "span", (F.col("above") + F.col("inside")).alias("base"), "tree_rows")
    )


def _words(rows: DataFrame) -> DataFrame:
    """Bitmap words of ``tree, word, bit, copies``, with the rows of each."""
    return rows.groupBy("tree", "word").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("mask"),
        F.sum("copies").alias("rows"),
    )


def _below(mask: Column, bit: Column) -> Column:
    """Ones of a word below a bit."""
    above = F.call_function("shiftleft", F.lit(-1).cast("long"), bit)
    return F.bit_count(mask.bitwiseAND(F.bitwise_not(above)))


def _is_crowded() -> Column:
    return F.col("rows") != F.bit_count("mask")


def _containers(words: DataFrame, counted: DataFrame | None) -> DataFrame:
    """Compressed bitmaps of up to 64 words, and the rows of the tree before each word.

    ``present`` has a one for each word that is stored; the place of a word in the arrays
    is the number of ones below its own.  A word in which ids repeat (``counted`` then
    has the rows) also stores the rows of each of its ids.
    """
    cells = words
    if counted is not None:
        crowded = words.where(_is_crowded()).select("tree", "word")
        by_id = (
            counted.join(if_small(materialize(crowded, "crowded")), ["tree", "word"], "left_semi")
            .groupBy("tree", "word", "bit")
            .agg(F.sum("copies").alias("rows"))
            .groupBy("tree", "word")
            .agg(F.collect_list(F.struct("bit", "rows")).alias("ids"))  # at most 64
        )
        cells = words.join(by_id, ["tree", "word"], "left")
    else:
        cells = words.withColumn("ids", F.lit(None).cast("array<struct<bit:int,rows:bigint>>"))
    low = F.col("word").bitwiseAND(63).cast("int")
    gathered = (
        cells.select(
            "tree",
            _shifted(F.col("word"), 6).alias("span"),
            "rows",
            F.call_function("shiftleft", F.lit(1).cast("long"), low).alias("one"),
            F.struct(low.alias("low"), "mask", "rows", "ids").alias("cell"),
        )
        .groupBy("tree", "span")
        .agg(
            F.sum("rows").alias("rows"),
            F.bit_or("one").alias("present"),
            F.sort_array(F.collect_list("cell")).alias("cells"),  # at most 64
        )
    )
    before = lambda cells: F.transform(
        cells,
        lambda c, i: F.aggregate(F.slice(cells, F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x["rows"]),
    )
    return materialize(
        gathered.select(
            "tree",
            "span",
            "rows",
            "present",
            F.col("cells.mask").alias("masks"),
            let(F.col("cells"), before).alias("before"),
            F.col("cells.ids").alias("ids"),
        ),
        "bitmaps",
    )


def _ranked(rows: DataFrame, words: DataFrame, counted: bool) -> DataFrame:
    """``rank``, the rows of the tree with lesser ids, ``id_rows``, those of the same id, and ``tree_rows``.

    ``rows`` has ``tree, word, bit, copies`` and whatever else; ``counted`` says that
    ids may repeat.
    """
    containers = _containers(words, rows if counted else None)
    ends = containers.agg(F.min("span"), F.max("span")).first()
    bases = _with_bases(containers.select("tree", "span", "rows"), ends[0] or 0, ends[1] or 0)
    directory = materialize(containers.drop("rows").join(bases, ["tree", "span"]), "directory")
    at = (_below(F.col("present"), F.col("word").bitwiseAND(63).cast("int")) + 1).cast("int")
    found = rows.withColumn("span", _shifted(F.col("word"), 6)).join(if_small(directory), ["tree", "span"])
    found = found.withColumn("at", at)
    own_ids = F.element_at("ids", F.col("at"))
    lesser = F.aggregate(
        own_ids,
        F.lit(0).cast("long"),
        lambda a, x: a + F.when(x["bit"] < F.col("bit"), x["rows"]).otherwise(0),
    )
    same = F.aggregate(
        own_ids,
        F.lit(0).cast("long"),
        lambda a, x: a + F.when(x["bit"] == F.col("bit"), x["rows"]).otherwise(0),
    )
    plain = _below(F.element_at("masks", F.col("at")), F.col("bit")).cast("long")
    rank = F.col("base") + F.element_at("before", F.col("at")) + F.coalesce(lesser, plain)
    return found.select(
        *rows.columns, rank.alias("rank"), F.coalesce(same, F.lit(1)).alias("id_rows"), "tree_rows"
    )


def _placed(leaves: DataFrame, carry: Sequence[str]) -> DataFrame:
    """``tree, rank, size, doc_id, leaf`` and ``carry``: every leaf at its place in its tree.

    Rows of one id follow each other by leaf.  They are counted first if there are any:
    equal rows are one with a number of copies; rows of one id that differ are ranked among
    themselves in the same way, by the first 60 bits of their leaves, and the few that
    share these by a window.
    """
    kept = ["doc_id", "leaf", *carry]
    rows = leaves.withColumn("copies", F.lit(1).cast("long"))
    words = materialize(_words(rows), "words")
    if words.where(_is_crowded()).isEmpty():
        ranked = _ranked(rows, words, counted=False)
        return ranked.select("tree", "rank", F.col("tree_rows").alias("size"), *kept)

    keys = ["tree", "word", "bit", *kept]
    counted = materialize(rows.groupBy(*keys).agg(F.sum("copies").alias("copies")), "counted")
    ranked = materialize(
        _ranked(counted, words, counted=True).withColumnRenamed("tree_rows", "size"), "ranked"
    )
    alone = ranked.where("id_rows = copies").select("tree", "rank", "size", "copies", *kept)
    prefix = F.conv(F.substring("leaf", 1, _PREFIX_DIGITS), 16, 10).cast("long")
    several = (
        ranked.where("id_rows > copies")
        .select(
            F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "tree").alias("inner_tree"),
            F.struct("tree", F.col("rank").alias("first"), "size", *kept).alias("row"),
            "copies",
            "leaf",
            prefix.alias("prefix"),
        )
        .select(
            F.col("inner_tree").alias("tree"),
            _shifted(F.col("prefix"), 6).alias("word"),
            F.col("prefix").bitwiseAND(63).cast("int").alias("bit"),
            "copies",
            "row",
            "leaf",
        )
    )
    if several.isEmpty():
        within = alone
    else:
        inner = _ranked(several, materialize(_words(several), "inner-words"), counted=True)
        # Different leaves of one id that share 60 bits: a handful at any size.
        same = Window.partitionBy("tree", "word", "bit").orderBy("leaf")
        earlier = F.coalesce(
            F.sum("copies").over(same.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
        close = inner.where("id_rows > copies").withColumn("rank", F.col("rank") + earlier)
        inner = inner.where("id_rows = copies").unionByName(close)
        within = alone.unionByName(
            inner.select(
                "row.tree",
                (F.col("row.first") + F.col("rank")).alias("rank"),
                "row.size",
                "copies",
                *[f"row.{c}" for c in kept],
            )
        )
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / _COPIES_AT_ONCE)))
    many = (
        within.where("copies > 1")
        .withColumn("chunk", chunk)
        .repartition(F.xxhash64("tree", "rank", "chunk"))
        .withColumn(
            "copy",
            F.explode(
                F.sequence(
                    F.col("chunk") * _COPIES_AT_ONCE,
                    F.least(F.col("copies"), (F.col("chunk") + 1) * _COPIES_AT_ONCE) - 1,
                )
            ),
        )
        .withColumn("rank", F.col("rank") + F.col("copy"))
    )
    columns = ["tree", "rank", "size", *kept]
    return within.where("copies = 1").select(columns).unionByName(many.select(columns))


def _height(size: Column) -> Column:
    """Levels above the leaves of a tree."""
    return reduce(lambda a, b: a + b, [(size > WAYS**k).cast("int") for k in range(16)])


def _runs(nodes: Column) -> Column:
    """Nodes of each run of 16, joined."""
    last = F.floor((F.size(nodes) - 1) / WAYS).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda r: F.array_join(F.slice(nodes, r * WAYS + 1, F.lit(WAYS)), ""),
    )


def _hashes(runs: Column) -> Column:
    return F.transform(runs, lambda t: F.sha2(t, 256))


def _step(run: Column, place: Column) -> Column:
    """Siblings of one node in its run, as a path of one level."""
    return F.struct(
        F.substring(run, F.lit(1), place * _DIGEST).alias("left"),
        F.substring(run, (place + 1) * _DIGEST + 1, F.length(run)).alias("right"),
    )


def _folded_arrays(nodes: DataFrame, level: int, carry: Sequence[str]) -> DataFrame:
    """``tree, block, size, top, runs``: arrays of 4,096 slots and what they fold to.

    ``runs`` has, for each 16 slots, their joined nodes, the path from their hash up to
    the array's top, and the carried columns of each node.
    """
    slot = (F.col("rank") % SLOTS).cast("int").alias("slot")
    blocks = nodes.groupBy("tree", F.floor(F.col("rank") / SLOTS).alias("block")).agg(
        F.first("size").alias("size"),
        F.sort_array(F.collect_list(F.struct(slot, "leaf", *carry))).alias("members"),
    )
    blocks = blocks.withColumn("height", F.greatest(F.lit(0), F.least(F.lit(LEVELS), _height(F.col("size")) - level)))
    runs = let(
        _runs(F.col("members.leaf")),
        lambda r0: let(
            _hashes(r0),
            lambda n1: let(
                _runs(n1),
                lambda r1: let(
                    _hashes(r1),
                    lambda n2: let(_runs(n2), lambda r2: F.struct(r0.alias("r0"), r1.alias("r1"), r2.alias("r2"))),
                ),
            ),
        ),
    )
    blocks = blocks.withColumn("folds", runs)
    top = (
        F.when(F.col("height") == 0, F.element_at("members.leaf", 1))
        .when(F.col("height") == 1, F.sha2(F.element_at("folds.r0", 1), 256))
        .when(F.col("height") == 2, F.sha2(F.element_at("folds.r1", 1), 256))
        .otherwise(F.sha2(F.element_at("folds.r2", 1), 256))
    )
    at = lambda i: F.floor(i / WAYS).cast("int")
    above = lambda i: F.slice(
        F.array(
            _step(F.element_at("folds.r1", at(i) + 1), i % WAYS),
            _step(F.element_at("folds.r2", 1), at(i)),
        ),
        F.lit(1),
        F.greatest(F.lit(0), F.col("height") - 1),
    )
    parts = F.transform(
        F.col("folds.r0"),
        lambda text, i: F.struct(
            text.alias("text"),
            above(i).alias("above"),
            F.transform(
                F.slice("members", i * WAYS + 1, F.lit(WAYS)), lambda m: m.dropFields("leaf")
            ).alias("members"),
        ),
    )
    return materialize(
        blocks.select("tree", "block", "size", "height", top.alias("top"), parts.alias("runs")), "slots"
    )


def _climb(nodes: DataFrame, carry: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of arrays, and ``tree, leaf``: the root of each tree."""
    rounds, tops, level = [], [], 0
    while True:
        blocks = _folded_arrays(nodes, level, carry if not level else ())
        rounds.append(blocks)
        level += LEVELS
        done = F.col("size") <= WAYS**level
        tops.append(blocks.where(done).select("tree", F.col("top").alias("leaf")))
        nodes = blocks.where(~done).select(
            "tree", F.col("block").alias("rank"), "size", F.col("top").alias("leaf")
        )
        if nodes.isEmpty():
            return rounds, reduce(DataFrame.union, tops)


def _expanded(blocks: DataFrame, above: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Nodes of all arrays with their whole path: ``above`` has that of each array's top."""
    parts = blocks.join(if_small(above), ["tree", "block"]).select(
        "tree", "block", "height", "subroot", F.col("above").alias("higher"), F.explode("runs").alias("part")
    )
    nodes = parts.select(
        "tree",
        "block",
        "height",
        "subroot",
        F.col("part.text").alias("text"),
        F.concat("part.above", "higher").alias("higher"),
        F.explode("part.members").alias("member"),
    )
    place = (F.col("member.slot") % WAYS).cast("int")
    own = F.when(F.col("height") > 0, F.array(_step(F.col("text"), place))).otherwise(
        F.array().cast(PATH_TYPE)
    )
    return nodes.select(
        "tree",
        (F.col("block") * SLOTS + F.col("member.slot")).alias("rank"),
        F.substring("text", place * _DIGEST + 1, F.lit(_DIGEST)).alias("leaf"),
        F.concat(own, "higher").alias("path"),
        "subroot",
        *[F.col(f"member.{c}").alias(c) for c in carry],
    )


def _with_paths(rounds: list[DataFrame], roots: DataFrame | None, carry: Sequence[str]) -> DataFrame:
    """All leaves with their path.

    ``roots`` has ``tree, above, subroot``, the root of each tree and the path from there
    on; without it, paths end there.
    """
    above = None
    for level, blocks in reversed(list(enumerate(rounds, start=1))):
        ended = blocks.where(F.col("size") <= WAYS ** (LEVELS * level)).select("tree", "block")
        if roots is None:
            tops = ended.select(
                "tree", "block", F.array().cast(PATH_TYPE).alias("above"), F.lit("").alias("subroot")
            )
        else:
            tops = ended.join(if_small(roots), "tree").select("tree", "block", "above", "subroot")
        above = materialize(tops if above is None else tops.unionByName(above), "above")
        nodes = _expanded(blocks, above, carry if level == 1 else ())
        above = nodes.select("tree", F.col("rank").alias("block"), F.col("path").alias("above"), "subroot")
    return nodes


def merkle_manifest(
    documents: DataFrame,
    leaf: Column,
    doc_id: str = "doc_id",
    group: str = "source",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """``doc_id, group, position, leaf, subroot, root, path`` and ``carry`` of every row.

    A group's rows are the leaves of its tree, in ascending order of id; 16 neighbours
    become one node until one is left, the subroot.  Subroots, in order of their group
    (null first, then by bytes), become the root in the same way.  ``path`` has the
    siblings of each level up to the root: :func:`folded` gives the root again.

    Null ids come first; rows of one id follow each other by leaf, and equal rows have a
    place each.  A null group is one of its own.  Texts are hashed whole, of any length.
    Other columns are ignored, whatever their names.  An empty table gives no rows.
    """
    extra = carry or {}
    rows = materialize(
        documents.select(
            F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
            F.col(doc_id).cast("long").alias("doc_id"),
            leaf.alias("leaf"),
            *[value.alias(f"carried_{name}") for name, value in extra.items()],
        )
        .withColumn("word", F.coalesce(_shifted(F.col("doc_id"), 6), F.lit(_NO_ID_WORD)))
        .withColumn("bit", F.coalesce(F.col("doc_id").bitwiseAND(63), F.lit(0)).cast("int")),
        "leaves",
    )
    carried = [f"carried_{name}" for name in extra]
    kept = ["doc_id", *carried]
    rounds, tops = _climb(_placed(rows, carried), kept)
    ordered = materialize(with_global_index(tops, ["tree"], "rank", unique=True), "subroots")
    groups = ordered.count()
    forest = ordered.select(F.lit("").alias("tree"), "rank", F.lit(groups).alias("size"), "leaf", F.col("tree").alias("of"))
    forest_rounds, root = _climb(forest, ["of"])
    top = root.first()
    roots = materialize(
        _with_paths(forest_rounds, None, ["of"]).select(
            F.col("of").alias("tree"), F.col("path").alias("above"), F.col("leaf").alias("subroot")
        ),
        "roots",
    )
    found = _with_paths(rounds, roots, kept)
    return found.select(
        "doc_id",
        F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias(group),
        F.col("rank").alias("position"),
        "leaf",
        "subroot",
        F.lit(top["leaf"] if top else None).cast("string").alias("root"),
        "path",
        *[F.col(f"carried_{name}").alias(name) for name in extra],
    )
