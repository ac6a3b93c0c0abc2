"""A Merkle manifest of a dataset: leaves of rows, a tree for each source, a root over all of them.

A leaf is the SHA-256 of a row's fields, each with its length in front. Inside a source the leaves stand
in order of their ids; `FAN` consecutive nodes make a parent, the SHA-256 of their digests as text, until
one node is left. The trees of the sources are the leaves of a last tree of the same kind.

A level is built by a self-join: the first node of each run of siblings (slot 0) names the places of the
others by adding slot offsets, meets them by an equality join on those computed places, and emits the
parent together with the run's digests in order. Nodes of a level are dealt by source and run, so a source of
any size is spread, and no task holds more than runs of `FAN` digests. A node's siblings are its run without
its own slot, so the proof of a row follows from the runs above it, handed down level by level.

Defined results: null fields are `-`, an empty text is `0:`; rows without an id come first in their source;
rows of one id stand in order of their leaf, equal rows next to each other as leaves of their own; a null source is a source of
its own, before the others; a single row is its own root with an empty proof; an empty table gives no
rows; further columns are not part of a leaf.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.sequences import number_rows
from ..session import written

FAN = 16
HEX = 64  # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TREE = ["_named", "_source"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Hex SHA-256 of parts put together; null parts add nothing."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, or a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**changed: Column) -> Column:
    """The digest of a row, with some fields replaced."""
    return digest(*[field(changed.get(name, F.col(name))) for name in FIELDS])


def next_level(nodes: DataFrame, fan: int = FAN) -> DataFrame:
    """`TREE, run, kids, node` of nodes `TREE, at, node`: the digests of each run of siblings in order,
    and their parent. `run` is the place of the parent."""
    run = F.floor(F.col("at") / fan)
    first = nodes.where(F.col("at") % fan == 0).select(*TREE, F.explode(F.sequence(F.col("at"), F.col("at") + fan - 1)).alias("at"))
    found = first.join(nodes, [*TREE, "at"])
    kids = F.array_sort(F.collect_list(F.struct("at", "node")))
    runs = found.groupBy(*TREE, run.alias("run")).agg(F.array_join(F.transform(kids, lambda k: k["node"]), "").alias("kids"))
    return runs.select(*TREE, "run", "kids", F.sha2(F.col("kids").cast("binary"), 256).alias("node"))


def siblings(kids: Column, at: Column, fan: int = FAN) -> Column:
    """The digests before and after a node in its run."""
    slot = (at % fan).cast("int")
    before = F.substring(kids, F.lit(1), slot * HEX)
    after = F.substring(kids, (slot + 1) * HEX + 1, F.length(kids))
    return F.struct(before.alias("before"), after.alias("after"))


PATH = "array<struct<before: string, after: string>>"


def trees(leaves: DataFrame, fan: int = FAN) -> tuple[DataFrame, list[DataFrame]]:
    """Roots `TREE, node` of all trees of leaves `TREE, at, node`, and their levels of runs from the
    leaves up. A tree that is down to one node goes up no further."""
    sizes = leaves.groupBy(*TREE).agg((F.max("at") + 1).alias("n"))
    sizes = written(sizes, "sizes")
    highest = sizes.agg(F.max("n")).first()[0] or 0
    roots = leaves.join(sizes.where("n = 1").select(*TREE), TREE).select(*TREE, "node")
    levels: list[DataFrame] = []
    nodes, width = leaves, 1  # leaves below a node of the level
    while highest > width:
        # Only trees with more than one node on this level.
        going = sizes.where(F.col("n") > width).select(*TREE)
        runs = written(next_level(nodes.join(going, TREE), fan), "runs")
        levels.append(runs)
        width *= fan
        done = sizes.where((F.col("n") <= width) & (F.col("n") > width // fan)).select(*TREE)
        roots = roots.union(runs.join(done, TREE).select(*TREE, "node"))
        nodes = runs.select(*TREE, F.col("run").alias("at"), "node")
    return roots, levels


def paths(levels: Sequence[DataFrame], fan: int = FAN) -> DataFrame | None:
    """`TREE, run, kids, path` of the runs of the lowest level, where `path` holds the siblings of the
    runs' parents from the next level to the root; null without a level."""
    found = None
    for runs in reversed(levels):
        here = runs.select(*TREE, "run", "kids")
        if found is None:
            found = here.withColumn("path", F.array().cast(PATH))
        else:
            up = found.select(*TREE, F.col("run").alias("_up"), F.col("kids").alias("_kids"), F.col("path").alias("_path"))
            joined = here.withColumn("_up", F.floor(F.col("run") / fan)).join(up, [*TREE, "_up"], "left")
            own = F.concat(F.array(siblings(F.col("_kids"), F.col("run"), fan)), F.col("_path"))
            # A tree that ends here has no run above.
            path = F.when(F.col("_kids").isNull(), F.array().cast(PATH)).otherwise(own)
            found = joined.select(*TREE, "run", "kids", path.alias("path"))
    return found


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]).cast("binary"), 256))


def manifest(docs: DataFrame, tampered: Column | None = None, ident: str = "doc_id", fan: int = FAN) -> DataFrame:
    """`doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified` for every row of `docs`
    with the columns `FIELDS`. Where `tampered` holds, the proof is tried on a leaf whose text has its
    capitals A-Z lower-cased."""
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    rows = docs.select(
        F.col(ident).alias("doc_id"),
        F.col("source").isNotNull().alias("_named"),  # false, so null, comes first
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"),
        leaf_of().alias("node"),
        F.when(changed, leaf_of(text=F.translate("text", UPPER, LOWER))).alias("_other"),
    )
    # Written first: the order is found from a sample, and texts are to be read once.
    rows = written(rows, "leaves")
    leaves = written(number_rows(rows, TREE, ["doc_id", "node"], "at"), "placed")
    subroots, levels = trees(leaves.select(*TREE, "at", "node"), fan)
    subroots = written(subroots, "subroots")
    # The same over the sources, as one tree.
    numbered = number_rows(subroots, [], TREE, "at").withColumnsRenamed({"_named": "_n", "_source": "_s"})
    top = written(numbered.withColumns({"_named": F.lit(True), "_source": F.lit("")}), "sources")
    root, above = trees(top.select(*TREE, "at", "node"), fan)
    whole = root.first()  # one digest, or nothing where there are no rows
    lowest = paths(above, fan=fan)
    if lowest is None:
        sources = top.select("_n", "_s", F.col("node").alias("subroot"), F.array().cast(PATH).alias("_above"))
    else:
        runs = lowest.select(F.col("run").alias("_run"), F.col("kids").alias("_kids"), F.col("path").alias("_path"))
        joined = top.join(runs, F.floor(F.col("at") / fan) == F.col("_run"))
        own = F.concat(F.array(siblings(F.col("_kids"), F.col("at"), fan)), F.col("_path"))
        sources = joined.select("_n", "_s", F.col("node").alias("subroot"), own.alias("_above"))
    sources = written(sources.withColumn("root", F.lit(whole["node"] if whole else None).cast("string")), "sources")
    sources = sources.withColumnsRenamed({"_n": "_named", "_s": "_source"})
    return proved(leaves, paths(levels, fan=fan), sources, fan)


def proved(leaves: DataFrame, lowest: DataFrame | None, sources: DataFrame, fan: int) -> DataFrame:
    """Proofs of leaves `doc_id, TREE, at, node, _other` from the runs above them and their sources'
    `subroot, root, _above`."""
    if lowest is None:
        joined = leaves.withColumn("_below", F.array().cast(PATH)).join(sources, TREE)
    else:
        runs = lowest.withColumnRenamed("run", "_run").join(sources, TREE, "right")
        # Sources of a single row have no run; they meet their row at run 0.
        runs = runs.withColumn("_run", F.coalesce("_run", F.lit(0).cast("long")))
        joined = leaves.withColumn("_run", F.floor(F.col("at") / fan)).join(runs, [*TREE, "_run"])
        own = F.concat(F.array(siblings(F.col("kids"), F.col("at"), fan)), F.col("path"))
        joined = joined.withColumn("_below", F.when(F.col("kids").isNull(), F.array().cast(PATH)).otherwise(own))
    whole = joined.withColumn("_path", F.concat("_below", "_above"))
    texts = F.transform("_path", lambda s: F.concat(s["before"], s["after"]))
    found = whole.select(
        "doc_id",
        F.when(F.col("_named"), F.col("_source")).alias("source"),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        F.sha2(F.array_join(texts, "").cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("_other", "node"), F.col("_path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
