"""Hierarchical weighted hash tree: regions hold racks, racks hold shards.

A row descends from the root: at every level it draws, for each child, -ln(u) / weight with u a
hash of key and child, and goes to the child of the least draw. A node's weight is provisioned
for itself and is no sum over its children, so a change below a node moves rows below it alone,
and a child that is added or grows only takes rows. Only Spark expressions are used.

Defined results: a null key draws like the text "null"; a null text has size ``overhead`` and the
checksum of the empty text; repeated rows get slots of their own; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .pieces import free

Tree = dict[int, tuple[float, dict[int, tuple[float, dict[int, float]]]]]

REGIONS, RACKS = 4, 2
#: Runs in which the slots of one shard are numbered, each by a task of its own.
RUNS = 64


def tree(shards: int, regions: int = REGIONS, racks: int = RACKS) -> Tree:
    """Shards 0 to ``shards`` - 1 dealt in turn to the racks; all weights 1.

    One more shard goes to one rack, so that only rows of this rack (or, while racks are still
    empty, region) move, and only to it.
    """
    made: Tree = {}
    for shard in range(shards):
        region, rack = shard % regions, shard // regions % racks
        made.setdefault(region, (1.0, {}))[1].setdefault(rack, (1.0, {}))[1][shard] = 1.0
    return made


def _nodes(children: dict[int, float]) -> str:
    """SQL for the children that can be drawn, as an array of (c, w)."""
    return "array(" + ", ".join(f"named_struct('c', {child}, 'w', {float(weight)!r}D)"
                                for child, weight in children.items() if weight > 0) + ")"


def _drawn(key: str, path: str, nodes: str) -> str:
    """SQL for the child of the least draw; ``path`` is SQL for the way to the parent.

    No column may be named in it: the names of lambdas would hide one of the same name.
    """
    u = f"(shiftrightunsigned(xxhash64({key}, {path}, n.c), 11) + 0.5D) / 9007199254740992D"
    return f"array_min(transform({nodes}, n -> struct(-ln({u}) / n.w AS d, n.c AS c))).c"


def place(df: DataFrame, key: str, nodes: Tree, name: str = "shard") -> DataFrame:
    """``df`` with the shard of each row by the text of column ``key``.

    The tree is part of the expression: its size is the topology's, not the data's.
    """
    text, column = "k", "`" + key.replace("`", "``") + "`"
    regions = _nodes({r: w for r, (w, _) in nodes.items()})
    racks = ", ".join(f"{r}, {_nodes({k: w for k, (w, _) in own.items()})}"
                      for r, (_, own) in nodes.items())
    leaves = ", ".join(f"'{r}/{k}', {_nodes(s)}" for r, (_, own) in nodes.items()
                       for k, (_, s) in own.items())
    region = _drawn(text, "''", regions)
    rack = _drawn(text, "cast(r AS string)", f"map({racks})[r]")
    leaf = _drawn(text, "p", f"map({leaves})[p]")
    descent = (f"element_at(transform(transform(array({region}), r -> concat(r, '/', {rack})), "
               f"p -> {leaf}), 1)")
    placed = (f"element_at(transform(array(coalesce(cast({column} AS string), 'null')), "
              f"k -> {descent}), 1)")
    return df.withColumn(name, F.expr(f"cast({placed} AS int)"))


def slots(df: DataFrame, shard: str, order: list[str], slot: str = "slot") -> DataFrame:
    """``df`` with gapless numbers from 0 in each shard.

    A shard is numbered in runs by hash of ``order``, each in a window of its own; the runs are
    chained by their counts, of which there are shards x RUNS, however many rows there are.
    """
    run, n, first, own = (free(c, [*df.columns, slot]) for c in ("_run", "_n", "_first", "_own"))
    df = df.withColumn(run, F.pmod(F.xxhash64(*order), F.lit(RUNS)))
    counts = df.groupBy(shard, run).agg(F.count("*").alias(n))
    before = counts.withColumn(first, F.coalesce(F.sum(n).over(
        Window.partitionBy(shard).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).drop(n)
    place = F.row_number().over(Window.partitionBy(shard, run).orderBy(*order)) - 1
    return df.withColumn(own, place).join(before, [shard, run]) \
        .withColumn(slot, (F.col(first) + F.col(own)).cast("long")).drop(run, own, first)


def report(documents: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (with one shard more)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = documents.select("doc_id", (F.octet_length(text) + overhead).cast("long").alias("size"),
                          F.crc32(text.cast("binary")).alias("text_crc32"),
                          F.lit("key").alias("law"))
    df = place(df, "doc_id", tree(shards))
    df = place(df, "doc_id", tree(shards + 1), "grown_shard")
    df = slots(df, "shard", ["doc_id", "text_crc32", "size"])
    return df.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
