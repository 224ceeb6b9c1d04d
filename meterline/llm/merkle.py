"""Merkle manifest of a table: a digest for each row, an 8-ary hash tree for each
group of rows, one tree over the groups, and a proof for each row.

Rows get their place in their group without one task ever holding a group: they
are dealt out by ranges of the order, counted by (group, range), and numbered in
their range.  A level of the tree is then a table (group, place, nodes of the
group, digest).  Over stretches of ``SPAN`` places, a whole number of runs, lag
and lead columns at the offsets 1 to 7 give each node its run's others; slot and
run length mask what lies in another run.  The first child of each run hashes
the run's parent, and these rows are the next level.  On the way back down every
node's siblings are put before its parent's, so a row ends with its whole path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.functions.reuse import per_application
from meterline.llm.common import staged

# Children of a node, and places that one window partition holds.
FAN, SPAN = 8, 512

# What tampering changes, and to what.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Siblings travel as bytes, half as long as hex.
PATH = "array<struct<left:binary,right:binary>>"


def row_digest(*values: Column) -> Column:
    """sha256 of the values, each ``-`` if null, else byte count, ``:`` and the value."""
    strings = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
                             for s in strings)), 256)


def placed(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``i``, the place (from 0) in their group by ``order``, and
    ``n``, the group's rows.  Equal rows are spread by their row number."""
    order = [*order, F.col("_row")]
    # Staged before the ranges are sampled, or every digest would be made twice.
    numbered = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-digests")
    dealt = staged(numbered.repartitionByRange(F.col(group), *order).withColumn("_range", F.spark_partition_id()), "merkle-ranges")
    of_group = Window.partitionBy(group)  # a row for each range, not for each row
    counts = (dealt.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_c"))
              .select(group, "_range", F.sum("_c").over(of_group).alias("n"),
                      (F.sum("_c").over(of_group.orderBy("_range")) - F.col("_c")).alias("_before")))
    here = F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order))
    return (dealt.withColumn("_here", here).join(counts, [group, "_range"])
            .withColumn("i", F.col("_before") + F.col("_here") - 1).drop("_row", "_range", "_here", "_before"))


@per_application
def _siblings() -> dict[str, Column]:
    """``left`` and ``right``: the digests of the run's others, concatenated."""
    w = Window.partitionBy("g", F.expr(f"i div {SPAN}")).orderBy("i")
    slot = F.col("i") % FAN
    run = F.least(F.lit(FAN), F.col("n") - F.col("i") + slot)
    before = [F.when(slot >= k, F.lag("h", k).over(w)) for k in range(FAN - 1, 0, -1)]
    after = [F.when(slot + k < run, F.lead("h", k).over(w)) for k in range(1, FAN)]
    return {"left": F.concat_ws("", *before), "right": F.concat_ws("", *after)}


def _with_siblings(level: DataFrame) -> DataFrame:
    return level.withColumns(_siblings())


def _parents(level: DataFrame) -> DataFrame:
    """The next level: first children hash their run; a lone node stays what it is."""
    return (_with_siblings(level).filter(F.col("i") % FAN == 0)
            .select("g", F.expr(f"i div {FAN}").alias("i"), F.ceil(F.col("n") / FAN).alias("n"),
                    F.when(F.col("n") == 1, F.col("h")).otherwise(F.sha2(F.concat("h", "right"), 256)).alias("h")))


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """(g, i, n, h) of every level, from ``nodes`` to one node a group."""
    most = nodes.agg(F.max("n").alias("n")).first()["n"] or 0
    levels = [nodes]
    while most > 1:
        levels.append(staged(_parents(levels[-1].select("g", "i", "n", "h")), "merkle-level"))
        most = -(-most // FAN)
    return levels


def _paths(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """The nodes of the lowest level with ``path``, the (left, right) siblings of
    each level up; ``top`` is (g, path) of the one node that each group ends with.
    A group that is down to one node adds nothing at the levels above."""
    above = top.select("g", F.lit(0).cast("long").alias("i"), "path")
    for level in reversed(levels):
        if level is levels[-1]:
            found = level.join(above, ["g", "i"])
        else:
            own = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.array().cast(PATH))
            found = (_with_siblings(level).withColumns({"left": F.unhex("left"), "right": F.unhex("right"), "_up": F.expr(f"i div {FAN}")})
                     .join(above.select("g", F.col("i").alias("_up"), F.col("path").alias("_path")), ["g", "_up"])
                     .withColumn("path", F.concat(own, "_path")).drop("_up", "_path", "left", "right"))
        above = found.select("g", "i", "path")
    return found


def manifest(docs: DataFrame, digests: dict[str, Column], *, group: str, order: str) -> DataFrame:
    """``order``, ``group``, each of ``digests`` by name, and ``path``,
    ``subroot``, ``root``: the tree's leaves are the first of ``digests``, in
    one tree for each value of ``group`` (null is a value) by ``order`` (null
    first; equal ones by digests) and one tree over the groups' roots (null
    first).  ``path`` has the (left, right) siblings from the leaf to the root, as
    the bytes of their digests.

    Repeated rows are leaves of their own.  A group of one row has the leaf as
    its subroot, a table of one group has the subroot as its root.  An empty
    table gives no rows.  Other columns are never read.
    """
    leaf = next(iter(digests))
    key = F.coalesce(F.concat(F.lit("="), F.col("_group")), F.lit("-"))
    rows = (docs.select(F.col(order).alias("_order"), F.col(group).cast("string").alias("_group"),
                        *(d.alias(f"_d_{name}") for name, d in digests.items()))
            .withColumns({"g": key, "h": F.col(f"_d_{leaf}")}))
    leaves = staged(placed(rows, "g", [F.col("_order").asc_nulls_first(), *(F.col(f"_d_{d}") for d in digests)]), "merkle-leaves")
    levels = _levels(leaves)
    subroots = levels[-1].select("g", F.col("h").alias("subroot"))

    named = subroots.select(F.col("g").alias("name"), "subroot", F.col("subroot").alias("h"), F.lit("").alias("g"))
    tops = _levels(staged(placed(named, "g", [F.col("name")]), "merkle-groups"))  # "-" sorts before "="
    root = tops[-1].select("g", F.col("h").alias("root"))
    above = _paths(tops, root.select("g", F.array().cast(PATH).alias("path")))
    above = above.join(root, "g").select(F.col("name").alias("g"), "subroot", "root", "path")
    return (_paths(levels, above).join(above.drop("path"), "g")
            .select(F.col("_order").alias(order), F.col("_group").alias(group),
                    *(F.col(f"_d_{name}").alias(name) for name in digests), "path", "subroot", "root"))


def _hex(data: Column) -> Column:
    return F.lower(F.hex(data))


def proof_digest(path: Column) -> Column:
    """sha256 of a path's siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda e: F.concat(_hex(e["left"]), _hex(e["right"])))), 256)


def folded(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda h, e: F.sha2(F.concat(_hex(e["left"]), h, _hex(e["right"])), 256))


def document_digest(text: Column) -> Column:
    return row_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def verified_manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): the
    manifest of ``docs`` by language, held against texts whose A-Z are
    lower-cased where ``tampered`` (null: not)."""
    text = F.col("text").cast("string")
    now = F.when(tampered, document_digest(F.translate(text, UPPER, LOWER))).otherwise(document_digest(text))
    rows = manifest(docs, {"leaf": document_digest(text), "now": now}, group="lang", order="doc_id")
    found = folded(F.col("path"), F.col("now"))
    return (rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), found.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
