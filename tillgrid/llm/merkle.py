"""A Merkle manifest of a dataset: a tree per source, a tree over the sources, a proof per row.

Rows are ranked within their source by doc_id.  A rank's digits to the base of the
arity name the way from the root down, so a level of the tree is a grouping by all
digits but the last one left.  ``LEVELS`` levels make a block of bounded size: rows
are shuffled once to (source, block), and there one digit after the other is grouped
away, each group becoming a struct with its digest that nests its children.  A
nested transform over the block then lists every row with its siblings, and an
explode emits the rows; no row is joined to anything.  The digests of a source's
blocks are the nodes of the next, much smaller tier, which is rolled up alike until
one node a source is left; a block takes the path above it from that tier by an
equi-join with one row per block on both sides.

H is the lowercase hex sha256 of its inputs together.  A leaf is H of the row's
columns in turn, ``-`` for null, else byte count, ``:`` and value.

Defined results: sources and doc_ids may be null (null source and null id come
first); rows that repeat a doc_id follow each other by leaf, and equal rows are
leaves of their own; an empty text is ``0:``; an empty table gives an empty one;
columns beside the five are neither hashed nor read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import settle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
ARITY = 3
#: Levels of a block; a block holds at most ARITY ** LEVELS nodes.
LEVELS = 6


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(text: Column | None = None) -> Column:
    """The leaf of a row, with another text if given."""
    fields = {c: F.col(c) for c in COLUMNS} | ({"text": text} if text is not None else {})
    return digest(*(_field(fields[c]) for c in COLUMNS))


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) within ``tree`` by ``order``, and the tree's ``size``.

    Rows are dealt into ranges of (tree, order) and written; a row's rank is its
    place in the file's part of the tree and the counts of the parts before.  The
    place it came from splits even a third of all rows that are equal in all."""
    keys = [F.col(tree).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order), F.col("_from")]
    marked = rows.withColumn("_from", F.monotonically_increasing_id())
    dealt = settle(marked.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_from")
                   .withColumn("_place", F.monotonically_increasing_id()), "ranks")
    part = F.shiftright("_place", 33)
    runs = dealt.groupBy(F.col(tree).alias("_t"), part.alias("_p")).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    of_tree = Window.partitionBy("_t")
    before = of_tree.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_t", "_p", F.sum("_n").over(of_tree).alias("size"),
                       (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    here = F.col(tree).eqNullSafe(F.col("_t")) & (F.col("_part") == F.col("_p"))
    return (dealt.withColumn("_part", part).join(runs, here)
            .select(*rows.columns, (F.col("_place") + F.col("_shift")).alias("rank"), "size"))


def _rolled(nodes: DataFrame, payload: list[str], levels: int) -> DataFrame:
    """(tree, block, size, nested) of nodes (tree, rank, size, digest, *payload):
    ``nested`` is the block's tree of structs, ``levels`` digits high.

    The single shuffle deals by (tree, block); every grouping keeps those two and
    so finds its rows in place.  Levels above the root of a small tree pass its
    only node on."""
    span = ARITY ** levels
    digits = [F.pmod(F.floor(F.col("rank") / ARITY ** i), F.lit(ARITY)).cast("int").alias(f"d{i}")
              for i in range(levels)]
    now = nodes.select("tree", F.floor(F.col("rank") / span).alias("block"), "size", *digits,
                       F.struct("digest", *payload).alias("node"))
    now = now.repartition("tree", "block")
    for level in range(levels):
        kids = F.array_sort(F.collect_list(F.struct(f"d{level}", "node")))
        keep = ["tree", "block", "size", *(f"d{i}" for i in range(level + 1, levels))]
        below = ARITY ** level
        now = now.groupBy(*keep).agg(kids.alias("kids")).withColumn(
            "kids", F.transform("kids", lambda k: k["node"]))
        joined = F.array_join(F.transform("kids", lambda k: k["digest"]), "")
        now = now.select(*keep, F.struct(
            F.when(F.col("size") > below, F.sha2(joined, 256))
            .otherwise(F.element_at("kids", 1)["digest"]).alias("digest"), "kids").alias("node"))
    return now.withColumnRenamed("node", "nested")


def _listed(root: Column, above: Column, levels: int, size: Column) -> Column:
    """All nodes below ``root`` with their paths, an array of (node, path): one level
    after the other by nested transforms, so a path is made once per node."""
    def side(kids: Column) -> Column:
        return F.array_join(F.transform(kids, lambda k: k["digest"]), "")

    def below(hashed: Column) -> Callable[[Column], Column]:
        def kids_of(parent: Column) -> Column:
            kids = parent["node"]["kids"]

            def one(kid: Column, i: Column) -> Column:
                step = F.struct(side(F.slice(kids, F.lit(1), i)).alias("left"),
                                side(F.slice(kids, i + F.lit(2), F.lit(ARITY))).alias("right"))
                own = F.when(hashed, F.array(step)).otherwise(no_steps())
                return F.struct(kid.alias("node"), F.concat(own, parent["path"]).alias("path"))

            return F.transform(kids, one)
        return kids_of

    now = F.array(F.struct(root.alias("node"), above.alias("path")))
    for level in reversed(range(levels)):
        now = F.flatten(F.transform(now, below(size > ARITY ** level)))
    return now


def no_steps() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")


def rolled(nodes: DataFrame, payload: list[str], levels: int) -> list[DataFrame]:
    """The tiers over nodes (tree, rank, size, digest, *payload), lowest first, as
    tables of blocks (tree, block, size, nested); the last has one block a tree."""
    span = ARITY ** levels
    tiers = []
    while True:
        blocks = settle(_rolled(nodes, payload, levels), "blocks")
        tiers.append(blocks)
        if (blocks.agg(F.max("size")).first()[0] or 0) <= span:
            return tiers
        payload = ["at"]
        nodes = blocks.select("tree", F.col("block").alias("rank"),
                              F.ceil(F.col("size") / span).alias("size"),
                              F.col("nested.digest").alias("digest"), F.col("block").alias("at"))


def proofs(tiers: list[DataFrame], crown: DataFrame, payload: list[str], levels: int) -> DataFrame:
    """(*payload, path, *crown's further columns) of every node below the tiers.

    ``crown`` has for every tree the path that goes on above its root.  A path goes
    from a node's run up, siblings left and right."""
    further = [c for c in crown.columns if c not in ("tree", "path")]
    above = crown.withColumn("at", F.lit(0).cast("long"))
    for i in reversed(range(len(tiers))):
        own = payload if i == 0 else ["at"]
        known = above.select(F.col("tree").alias("_t"), "at", F.col("path").alias("above"), *further)
        blocks = tiers[i].join(known, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("block") == F.col("at")))
        nodes = _listed(F.col("nested"), F.col("above"), levels, F.col("size"))
        above = blocks.select("tree", *further, F.explode(nodes).alias("at")).select(
            "tree", *(F.col("at.node")[c].alias(c) for c in own), F.col("at.path").alias("path"), *further)
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` is the text with which a row is checked against the manifest, null
    where the row's own text stands; by default no row is tampered with."""
    own = docs.select(*COLUMNS)
    changed = F.lit(None).cast("string") if tampered is None else tampered
    rows = settle(own.select(
        F.col("source").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf().alias("digest"),
        F.when(changed.isNotNull(), leaf(changed)).alias("other")), "leaves")
    nodes = ranked(rows, "tree", ["doc_id", "digest"]).withColumn("leaf", F.col("digest"))
    payload = ["doc_id", "leaf", "other"]
    trees = rolled(nodes, payload, levels)
    subroots = trees[-1].select(F.lit(0).alias("tree"), F.col("tree").alias("source"),
                                F.col("nested.digest").alias("digest"))
    sources = ranked(subroots, "tree", ["source"]).withColumn("subroot", F.col("digest"))
    top = rolled(sources, ["source", "subroot"], levels)
    summit = top[-1].select("tree", no_steps().alias("path"),
                            F.col("nested.digest").alias("root"))
    crown = proofs(top, summit, ["source", "subroot"], levels).select(
        F.col("source").alias("tree"), "path", "subroot", "root")
    proven = proofs(trees, crown, payload, levels)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.coalesce("other", "leaf"), F.col("path")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def without_newlines() -> Column:
    """Deletes the line feeds of the text where 2 divides crc32 of the decimal doc_id; else null."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.when(crc % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
