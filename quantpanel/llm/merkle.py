"""Merkle manifest of a dataset: a hash tree per partition value and one above their roots.

A row's fields are hashed to a leaf. Nodes of a tree are numbered, and runs of ``arity`` consecutive
nodes have one parent. On every level a node computes the numbers of its siblings (the XOR with one
in a binary tree, the other slots of its run otherwise) and meets them in an equijoin of the level
with itself; the node in slot zero then emits the parent. Trees of all partitions climb together,
and a tree is done when one node is left. The roots of the trees, by the order of their values, are the
leaves of an upper tree.

What a node needs to reach the root (the digests left and right of it on every level) is put
together downwards: a run has its parent's route once, whatever the number of leaves below.
Numbers come from a range-partitioned sort, so a value that all rows share is many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise
from quantpanel.llm.rows import fold
from quantpanel.llm.stream_dedup import ascii_lower

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROW_BITS = 33  # monotonically_increasing_id holds the row of a partition in its lower bits


def digest(content: Column) -> Column:
    """SHA-256 as 32 bytes; digests are stored as bytes and hashed as lowercase hexadecimal text."""
    return F.unhex(F.sha2(content, 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: dict[str, Column], fields: Sequence[str] = FIELDS) -> Column:
    return digest(F.concat(*(field_text(columns[name]) for name in fields)))


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """``index`` of a node in its ``tree`` and the number ``n`` of the tree's nodes.

    Rows that tie in all of ``order`` are spread by their place in the input, so that repeated rows
    are no single task; which of them comes first makes no difference.
    """
    placed = materialise(
        nodes.withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange("tree", *order, "place")
        .sortWithinPartitions("tree", *order, "place")
        .drop("place")
        .withColumn("row", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("row", ROW_BITS))
    trees = Window.partitionBy("tree")
    starts = (
        placed.groupBy("tree", "part")
        .agg(F.min("row").alias("first"), F.count("*").alias("held"))
        .withColumn("n", F.sum("held").over(trees))
        .withColumn("before", F.sum("held").over(trees.orderBy("part")) - F.col("held"))
        .drop("held")
    )
    return placed.join(starts, ["tree", "part"]).select(
        *nodes.columns, (F.col("before") + F.col("row") - F.col("first")).alias("index"), "n"
    )


def sibling_numbers(index: Column, n: Column, arity: int) -> Column:
    """The numbers of the other nodes of a run; none beyond the last node."""
    if arity == 2:
        return F.array_compact(F.array(F.when(index.bitwiseXOR(F.lit(1)) < n, index.bitwiseXOR(F.lit(1)))))
    slot = F.pmod(index, F.lit(arity))
    others = F.transform(
        F.sequence(F.lit(1), F.lit(arity - 1)),
        lambda shift: index - slot + F.pmod(slot + shift, F.lit(arity)),
    )
    return F.filter(others, lambda other: other < n)


def _joined(siblings: Column, wanted) -> Column:
    """The digests of the wanted siblings behind each other, by their numbers."""
    empty = F.lit(b"")
    return F.reduce(F.filter(siblings, wanted), empty, lambda held, s: F.concat(held, s["digest"]))


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with ``run``, and the digests ``left`` and ``right`` of them in their run.

    Further columns of a node travel with its own row. One exchange by run serves the gathering
    and the caller's join with the parents.
    """
    further = [c for c in nodes.columns if c not in ("tree", "index", "n", "digest")]
    asked = nodes.select("tree", "index", F.explode(sibling_numbers(F.col("index"), F.col("n"), arity)).alias("number"))
    met = asked.join(
        nodes.select("tree", F.col("index").alias("number"), F.struct(F.col("index").alias("number"), "digest").alias("sibling")),
        ["tree", "number"],
    ).drop("number")
    rows = nodes.unionByName(met, allowMissingColumns=True)
    run = F.floor(F.col("index") / arity).cast("long")
    gathered = (
        rows.withColumn("run", run)
        .repartition("tree", "run")
        .groupBy("tree", "run", "index")
        .agg(
            *(F.max(c).alias(c) for c in ("n", "digest", *further)),
            F.sort_array(F.collect_list("sibling")).alias("siblings"),
        )
    )
    index = F.col("index")
    return gathered.select(
        "tree", "run", "index", "n", "digest", *further,
        _joined(F.col("siblings"), lambda s: s["number"] < index).alias("left"),
        _joined(F.col("siblings"), lambda s: s["number"] > index).alias("right"),
    )


def climb(nodes: DataFrame, arity: int) -> list[DataFrame]:
    """The levels of all trees, each a stored table; a tree's last node is the one with n = 1."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    levels = []
    while True:
        levels.append(materialise(with_siblings(nodes, arity)))
        if most == 1:
            return levels
        run = F.concat("left", "digest", "right")
        nodes = levels[-1].where((F.col("n") > 1) & (F.col("index") % arity == 0)).select(
            "tree",
            F.col("run").alias("index"),
            F.ceil(F.col("n") / arity).alias("n"),
            digest(hex_text(run)).alias("digest"),
        )
        most = -(-most // arity)


def last_nodes(levels: list[DataFrame]) -> DataFrame:
    """``tree, digest`` of the root of every tree."""
    roots = [level.where("n = 1").select("tree", "digest") for level in levels]
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return found


def routes(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Nodes of the lowest level with their ``route`` (left, right of every level) and what ``above`` says.

    ``above`` has one row per tree: its route further up, and values that all its nodes get.
    """
    said = [c for c in above.columns if c not in ("tree", "route")]
    found = None
    for number in range(len(levels) - 1, -1, -1):
        level = levels[number]
        own = [c for c in level.columns if number == 0 or c in ("tree", "index")]
        reached = level.where("n = 1").join(above, "tree").select(*own, "route", *said)
        if found is not None:
            parents = found.select("tree", F.col("index").alias("run"), "route", *said)
            step = F.array(F.struct("left", "right"))
            inner = level.where("n > 1").join(parents, ["tree", "run"])
            reached = reached.unionByName(inner.select(*own, F.concat(step, "route").alias("route"), *said))
        found = reached
    return found


def folded(leaf: Column, route: Column) -> Column:
    """The root that follows from a leaf and the siblings on its route."""
    return F.reduce(
        route, leaf, lambda held, step: digest(hex_text(F.concat(step["left"], held, step["right"])))
    )


def manifest(docs: DataFrame, by: str = "lang", fields: Sequence[str] = FIELDS, arity: int = ARITY, claimed: Column | None = None) -> DataFrame:
    """``doc_id, leaf, claimed, subroot, root, route`` of every row; digests are bytes.

    A row is hashed as its ``fields``, and rows of one value of ``by`` are a tree, ordered by doc_id
    (null first) and then by leaf; repeated rows are leaves of their own. Null is a value of ``by``, in
    front of all others, which are ordered by their bytes. A tree of one leaf has it as its root.
    ``claimed`` is the leaf that a later check finds (null: the same); an empty table gives no rows.
    """
    columns = {name: F.col(name) for name in fields}
    leaf = leaf_digest(columns, fields)
    leaves = materialise(
        docs.select(
            # keeps the order of bytes and has null first
            F.when(F.col(by).isNull(), "").otherwise(F.concat(F.lit("="), F.col(by).cast("string"))).alias("tree"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf.alias("digest"),
            (F.lit(None).cast("binary") if claimed is None else claimed).alias("claimed"),
        )
    )
    levels = climb(numbered(leaves, "doc_id", "digest"), arity)
    subroots = last_nodes(levels).select(F.lit("").alias("tree"), F.col("tree").alias("value"), "digest")
    upper = climb(numbered(materialise(subroots), "value"), arity)
    root = last_nodes(upper).select("tree", F.col("digest").alias("root"), _no_route().alias("route"))
    tops = materialise(
        routes(upper, root).select(F.col("value").alias("tree"), F.col("digest").alias("subroot"), "root", "route")
    )
    return routes(levels, tops).select(
        "doc_id", F.col("digest").alias("leaf"), F.coalesce("claimed", "digest").alias("claimed"), "subroot", "root", "route"
    )


def _no_route() -> Column:
    return F.array().cast("array<struct<left:binary,right:binary>>")


def audited(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    Where 3 divides the crc32 of the id, the check meets a text whose A-Z were lower-cased; it is
    verified only if that changed nothing. A null id is never tampered with. See ``manifest``.
    """
    columns = {name: F.col(name) for name in FIELDS}
    other = leaf_digest(columns | {"text": ascii_lower(F.col("text").cast("string"))})
    found = manifest(docs, claimed=F.when(fold(F.col("doc_id"), 3) == 0, other))
    siblings = F.reduce("route", F.lit(b""), lambda held, step: F.concat(held, step["left"], step["right"]))
    again = found.withColumn("folded_root", folded(F.col("claimed"), F.col("route")))
    return again.select(
        "doc_id",
        hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"),
        F.sha2(hex_text(siblings), 256).alias("proof_sha256"),
        hex_text(F.col("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
