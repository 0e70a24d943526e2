"""Audits of tables that only grow, as states of their batches that add up.

What an audit finds in the batches that came since the last one is kept as rows: violations of
row rules, keys that became ambiguous, and lost references by key. The sum of all rows is what an
audit of the whole table finds, so the next one reads the new batches and, of earlier rows and of
parents, the columns of keys. References that were lost once are looked for again, as their
parents may have come later; keys of parents never go.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import schema
from .lookup import fits_broadcast
from .quality import ReferenceRule, RowRule, Rule, UniqueRule, _lines, _row_rules, _without

#: The rule name of rows that say which batches are audited.
BATCH = "batch"


def _state(lines: DataFrame, basis: str) -> DataFrame:
    return lines.selectExpr("table_name", f"'{basis}' AS basis", "rule", "check_name",
                            "cast(null as string) AS key_text", "violations AS n")


def _ambiguous(new: DataFrame, earlier: DataFrame | None, table: str,
               rule: UniqueRule) -> DataFrame:
    """One line: the keys that have several rows now and had one at most before.

    Earlier rows are first reduced to the new keys if these fit a broadcast; else both are counted
    by one shuffle of either.
    """
    def rows(df: DataFrame) -> DataFrame:
        return (df.where(rule.where) if rule.where else df).select(*rule.columns)

    def same(a: str, b: str):
        return reduce(and_, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
                             for c in rule.columns])

    now = rows(new).groupBy(*rule.columns).agg(F.count("*").alias("n"))
    if earlier is None:
        hit = now.where("n > 1")
    elif not fits_broadcast(rows(new)):
        both = rows(new).withColumn("_new", F.lit(1)).unionByName(
            rows(earlier).withColumn("_new", F.lit(0)))
        hit = both.groupBy(*rule.columns).agg(
            F.sum("_new").alias("n"), F.sum(1 - F.col("_new")).alias("m")).where(
            "n > 0 AND n + m > 1 AND m < 2")
    else:
        before = (rows(earlier).alias("old").join(
            now.select(*rule.columns).alias("now"), same("old", "now"), "left_semi")
            .groupBy(*rule.columns).agg(F.count("*").alias("m")))
        hit = now.alias("now").join(before.alias("old"), same("now", "old"), "left").where(
            "n + coalesce(m, 0) > 1 AND coalesce(m, 0) < 2")
    return _lines(hit.agg(F.count("*").alias("v0")), [(table, rule)])


def still_lost(lost: DataFrame, rules: list[ReferenceRule],
               parents: dict[str, DataFrame]) -> DataFrame:
    """The rows of ``lost`` (check_name, key_text, ...) whose key no parent has.

    Of the parents' keys only those that are looked for are compared; that side is small where
    the batch is, and Spark broadcasts it if its size allows.
    """
    out = []
    for parent, column in sorted({(r.parent, r.parent_column) for r in rules}):
        checks = [r.check for r in rules if (r.parent, r.parent_column) == (parent, column)]
        wanted = lost.where(F.col("check_name").isin(checks))
        known = parents[parent].select(F.col(column).cast("string").alias("key_text")).join(
            wanted.select("key_text"), "key_text", "left_semi").distinct()
        out.append(_without(wanted, known, ["key_text"]).select(lost.columns))
    return reduce(DataFrame.unionByName, out)


def found(table: str, basis: str, batches: list[int], new: DataFrame, earlier: DataFrame | None,
          rules: list[Rule], parents: dict[str, DataFrame]) -> DataFrame:
    """The state of new ``batches``, to be kept."""
    spark = new.sparkSession
    parts = [_state(spark.createDataFrame([(b,) for b in batches], "b long").selectExpr(
        f"'{BATCH}' AS rule", f"'{table}' AS table_name", "cast(b as string) AS check_name",
        "0L AS violations"), basis)]
    if rows := [r for r in rules if isinstance(r, RowRule)]:
        parts.append(_state(_row_rules(new, table, rows), basis))
    parts += [_state(_ambiguous(new, earlier, table, r), basis)
              for r in rules if isinstance(r, UniqueRule)]
    if references := [r for r in rules if isinstance(r, ReferenceRule)]:
        cells = ", ".join(f"struct('{r.rule}' AS rule, '{r.check}' AS check_name, "
                          f"cast({r.column} as string) AS key_text)" for r in references)
        per_key = new.selectExpr(f"inline(array({cells}))").where("key_text IS NOT NULL") \
            .groupBy("rule", "check_name", "key_text").agg(F.count("*").alias("n")) \
            .selectExpr(f"'{table}' AS table_name", f"'{basis}' AS basis", "*")
        parts.append(still_lost(per_key, references, parents))
    declared = schema("audit_states").fieldNames()
    return reduce(DataFrame.unionByName, [p.select(*declared) for p in parts])


def _of(table: str, basis: str) -> Column:
    return (F.col("table_name") == table) & (F.col("basis") == basis)


def audited(states: DataFrame, bases: dict[str, str]) -> dict[str, set[int]]:
    """The batches of each table that have a state on the table's present basis."""
    mine = reduce(or_, [_of(t, b) for t, b in bases.items()])
    out: dict[str, set[int]] = {t: set() for t in bases}
    for row in states.where(mine & (F.col("rule") == BATCH)).collect():
        out[row.table_name].add(int(row.check_name))
    return out


def totals(states: DataFrame, bases: dict[str, str], rules: dict[str, list[Rule]],
           parents: dict[str, DataFrame]) -> list[DataFrame]:
    """For each table (rule, table_name, check_name, violations) of all its audited batches."""
    mine = reduce(or_, [_of(t, b) for t, b in bases.items()])
    losing = {r.table_name for r in states.where(mine & F.col("key_text").isNotNull())
              .select("table_name").distinct().collect()}
    out = []
    for table, basis in bases.items():
        own = states.where(_of(table, basis))
        rows = own.where("key_text IS NULL")
        if table in losing:
            references = [r for r in rules[table] if isinstance(r, ReferenceRule)]
            rows = rows.unionByName(still_lost(own.where("key_text IS NOT NULL"), references,
                                               parents))
        names = [r.check.replace("'", "\\'") for r in rules[table]]
        sums = rows.agg(*[F.expr(
            f"sum(if(rule = '{r.rule}' AND check_name = '{name}', n, 0)) AS v{i}")
            for i, (r, name) in enumerate(zip(rules[table], names))])
        out.append(_lines(sums, [(table, r) for r in rules[table]]))
    return out
