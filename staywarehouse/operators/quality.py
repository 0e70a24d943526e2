"""Declared constraints as an audit: every rule yields its number of violations.

Rules share passes: the row rules of a table, the rules on versions of a business key (one
shuffle by that key), the other keys of a table, and the references of all tables. Key and
reference rules shrink the rows to one per key with map-side combine before they are
compared, so a hot key is one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .. import schemas as S


@dataclass(frozen=True)
class RowRule:
    """``bad`` is a SQL condition; a NULL outcome passes, as in a CHECK constraint."""

    rule: str
    check: str
    bad: str


@dataclass(frozen=True)
class UniqueRule:
    rule: str
    columns: tuple[str, ...]
    where: str | None = None

    @property
    def check(self) -> str:
        return "unique " + ",".join(self.columns) + (f" where {self.where}" if self.where else "")


@dataclass(frozen=True)
class ReferenceRule:
    rule: str
    column: str
    parent: str
    parent_column: str

    @property
    def check(self) -> str:
        return f"{self.column} in {self.parent}.{self.parent_column}"


@dataclass(frozen=True)
class ChainRule:
    """Versions of a key follow each other without gap or overlap."""

    rule: str
    key: str

    @property
    def check(self) -> str:
        return f"versions of {self.key} are contiguous"


Rule = RowRule | UniqueRule | ReferenceRule | ChainRule


def _outside(column: str, allowed: Iterable[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in allowed)
    return f"{column} not in ({listed})"


def declared(table: str) -> list[RowRule]:
    """DQ-14: not-null marks and text lengths of a table."""
    rules = [RowRule("DQ-14", f"{f.name} not null", f"{f.name} is null")
             for f in S.schema(table) if not f.nullable]
    rules += [RowRule("DQ-14", f"{column} at most {size} characters", f"length({column}) > {size}")
              for column, size in S.MAX_LENGTH.get(table, {}).items()]
    return rules


def _versioned(key: str, uuid: str) -> list[Rule]:
    return [UniqueRule("DQ-03", (key, "valid_from")),
            UniqueRule("DQ-04", (key,), "is_current"),
            UniqueRule("DQ-03", (uuid,), "is_current"),
            ChainRule("DQ-15", key)]


# The declared rules of the warehouse tables.
RULES: dict[str, list[Rule]] = {
    "dim_users": [
        RowRule("DQ-01", "user_type in domain", _outside("user_type", S.USER_TYPES)),
        RowRule("DQ-02", "valid_from before valid_to", "valid_from >= valid_to"),
        *_versioned("user_id", "user_uuid")],
    "dim_hosts": [
        RowRule("DQ-06", "response_rate 0..100", "response_rate not between 0 and 100"),
        RowRule("DQ-06", "response_time in domain",
                _outside("response_time", S.RESPONSE_TIMES)),
        *_versioned("host_id", "host_uuid")],
    "dim_properties": [
        RowRule("DQ-05", "price_per_night positive", "price_per_night <= 0"),
        *_versioned("property_id", "property_uuid")],
    "dim_dates": [UniqueRule("DQ-10", ("date_sk",)), UniqueRule("DQ-10", ("full_date",))],
    "fact_bookings": [
        RowRule("DQ-07", "at least one night", "number_of_nights < 1"),
        RowRule("DQ-07", "total_price not negative", "total_price < 0"),
        RowRule("DQ-07", "booking_status in domain",
                _outside("booking_status", S.BOOKING_STATUSES)),
        UniqueRule("DQ-10", ("booking_id",)),
        ReferenceRule("DQ-11", "user_sk", "dim_users", "user_sk"),
        ReferenceRule("DQ-11", "property_sk", "dim_properties", "property_sk"),
        ReferenceRule("DQ-11", "checkin_date_sk", "dim_dates", "date_sk"),
        ReferenceRule("DQ-11", "checkout_date_sk", "dim_dates", "date_sk"),
        ReferenceRule("DQ-11", "created_date_sk", "dim_dates", "date_sk")],
    "fact_payments": [
        RowRule("DQ-08", "amount not negative", "amount < 0"),
        RowRule("DQ-08", "payment_status in domain",
                _outside("payment_status", S.PAYMENT_STATUSES)),
        RowRule("Q-13", "fee and net add up to amount", "fee_amount + net_amount <> amount"),
        UniqueRule("DQ-10", ("payment_id",)),
        UniqueRule("DQ-10", ("transaction_id",)),
        ReferenceRule("DQ-12", "booking_sk", "fact_bookings", "booking_sk"),
        ReferenceRule("DQ-12", "user_sk", "dim_users", "user_sk"),
        ReferenceRule("DQ-12", "payment_date_sk", "dim_dates", "date_sk")],
    "dim_reviews": [
        RowRule("DQ-09", "overall_rating 1..5", "overall_rating not between 1 and 5"),
        UniqueRule("DQ-10", ("review_id",)),
        ReferenceRule("DQ-12", "user_sk", "dim_users", "user_sk"),
        ReferenceRule("DQ-12", "property_sk", "dim_properties", "property_sk"),
        ReferenceRule("DQ-12", "review_date_sk", "dim_dates", "date_sk")],
}

# Keys and references of the staging tables by business key.
STAGING_RULES: dict[str, list[Rule]] = {
    table: [UniqueRule("DQ-13", (key,)),
            *(UniqueRule("DQ-13", (c,)) for c in S.STAGING_UNIQUE.get(table, ()))]
    for table, key in S.STAGING_KEYS.items()
}
STAGING_RULES["tb_property"].append(ReferenceRule("DQ-11", "host_id", "tb_host", "host_id"))
STAGING_RULES["tb_booking"] += [
    ReferenceRule("DQ-11", "user_id", "tb_user", "user_id"),
    ReferenceRule("DQ-11", "property_id", "tb_property", "property_id")]
STAGING_RULES["tb_payment"] += [
    ReferenceRule("DQ-12", "booking_id", "tb_booking", "booking_id"),
    ReferenceRule("DQ-12", "user_id", "tb_user", "user_id")]
STAGING_RULES["tb_review"] += [
    ReferenceRule("DQ-12", "user_id", "tb_user", "user_id"),
    ReferenceRule("DQ-12", "property_id", "tb_property", "property_id")]


def all_rules(table: str, with_declared: bool = True) -> list[Rule]:
    return [*RULES[table], *(declared(table) if with_declared else ())]


def basis(rules: list[Rule], replaced_at: list[int]) -> str:
    """A name for what states of batches rest on: the rules, and when tables were truncated."""
    return hashlib.sha256(repr((rules, replaced_at)).encode()).hexdigest()[:16]


def _is_bad(rule: RowRule) -> Column:
    return F.expr(f"coalesce({rule.bad}, false)")


def _line(rule: Rule, table: str, count: str) -> str:
    check = rule.check.replace("'", "\\'")
    return (f"'{rule.rule}' AS rule, '{table}' AS table_name, '{check}' AS check_name, "
            f"cast(coalesce({count}, 0) as bigint) AS violations")


def _lines(totals: DataFrame, rules: list[tuple[str, Rule]]) -> DataFrame:
    """One line for each rule from one row with its count in ``v0``, ``v1``, ..."""
    lines = ", ".join(f"struct({_line(r, t, f'v{i}')})" for i, (t, r) in enumerate(rules))
    return totals.selectExpr(f"inline(array({lines}))")


def _row_rules(df: DataFrame, table: str, rules: list[RowRule]) -> DataFrame:
    totals = df.agg(*[F.expr(f"count_if({r.bad}) AS v{i}") for i, r in enumerate(rules)])
    return _lines(totals, [(table, r) for r in rules])


def _version_rules(df: DataFrame, table: str, key: str, rules: list[Rule]) -> DataFrame:
    """Chains and the keys that start with ``key``, by one shuffle on ``key``.

    A group is the versions of one business key: at most one for each merge.
    """
    line = Window.partitionBy(key).orderBy("version_number")
    rows = df.withColumns({"_from": F.lead("valid_from").over(line),
                           "_version": F.lead("version_number").over(line)})
    pair = next((r for r in rules if isinstance(r, UniqueRule) and len(r.columns) > 1), None)
    per_row, per_key, total = [], [], []
    for i, rule in enumerate(rules):
        chain = isinstance(rule, ChainRule)
        hit = ("_from <> valid_to OR _version <> version_number + 1" if chain
               else rule.where or "true")
        per_row.append(F.expr(f"count_if({hit}) AS n{i}"))
        per_key.append(F.expr(f"count_if(n{i} > 1) AS k{i}" if rule is pair
                              else f"sum(n{i}) AS k{i}"))
        total.append(F.expr(f"sum(k{i}) AS v{i}" if chain or rule is pair
                            else f"count_if(k{i} > 1) AS v{i}"))
    # grouping by (key, ...) and by key both keep to the partitions of the window
    fine = rows.groupBy(key, *(pair.columns[1:] if pair else ())).agg(*per_row)
    totals = fine.groupBy(key).agg(*per_key).agg(*total)
    return _lines(totals, [(table, r) for r in rules])


def _key_rules(df: DataFrame, table: str, rules: list[UniqueRule]) -> DataFrame:
    """Single-column keys of a table in one pass; keys of several rules are compared as text."""
    if len(rules) == 1:
        return _lines(_duplicates(df, rules[0]).agg(F.count("*").alias("v0")),
                      [(table, rules[0])])
    pairs = ", ".join(f"struct(if({r.where or 'true'}, {i}, null) AS _rule, "
                      f"cast({r.columns[0]} as string) AS _key)" for i, r in enumerate(rules))
    twice = (df.selectExpr(f"inline(array({pairs}))").where("_rule IS NOT NULL")
             .groupBy("_rule", "_key").agg(F.count("*").alias("_n")).where("_n > 1"))
    return _lines(twice.agg(*[F.expr(f"count_if(_rule = {i}) AS v{i}")
                              for i in range(len(rules))]), [(table, r) for r in rules])


def _without(per_key: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``per_key`` whose key is not known.

    An outer join, as Spark moves an anti join below the aggregation, where a hot key is not
    one row yet and every table would be joined with all parents.
    """
    marked = known.withColumn("_known", F.lit(True))
    return per_key.join(marked, key, "left").where("_known IS NULL").drop("_known")


def _reference_rules(tables: dict[str, DataFrame],
                     rules: list[tuple[str, ReferenceRule]]) -> DataFrame:
    """References of all tables at once: every table and every parent is read one time.

    Children come down to one row for each (parent, key), with a count for each rule, which is
    how the parents' keys are partitioned as well.
    """
    parents = sorted({(r.parent, r.parent_column) for _, r in rules})
    place = {p: n for n, p in enumerate(parents)}
    kinds = [tables[t].schema[r.column].dataType for t, r in rules]
    kinds += [tables[p].schema[c].dataType for p, c in parents]
    kind = "bigint" if all(isinstance(k, T.IntegralType) for k in kinds) else "string"
    children = []
    for table in dict.fromkeys(t for t, _ in rules):
        cells = ", ".join(
            f"struct({i} AS _rule, {place[r.parent, r.parent_column]} AS _parent, "
            f"cast({r.column} as {kind}) AS _key)"
            for i, (t, r) in enumerate(rules) if t == table)
        children.append(tables[table].selectExpr(f"inline(array({cells}))")
                        .where("_key IS NOT NULL"))
    per_key = reduce(DataFrame.unionByName, children).groupBy("_parent", "_key").agg(
        *[F.expr(f"count_if(_rule = {i}) AS n{i}") for i in range(len(rules))])
    known = reduce(DataFrame.unionByName, [
        tables[p].selectExpr(f"{n} AS _parent", f"cast({c} as {kind}) AS _key")
        for (p, c), n in place.items()])
    lost = _without(per_key, known, ["_parent", "_key"])
    return _lines(lost.agg(*[F.expr(f"sum(n{i}) AS v{i}") for i in range(len(rules))]), rules)


def _duplicates(df: DataFrame, rule: UniqueRule) -> DataFrame:
    rows = df.where(rule.where) if rule.where else df
    return rows.groupBy(*rule.columns).agg(F.count("*").alias("_n")).where("_n > 1")


def _orphans(df: DataFrame, rule: ReferenceRule, parent: DataFrame) -> DataFrame:
    per_key = (df.where(F.col(rule.column).isNotNull()).groupBy(rule.column)
               .agg(F.count("*").alias("_n")))
    keys = parent.select(F.col(rule.parent_column).alias(rule.column))
    return _without(per_key, keys, [rule.column])


def _broken_chain(df: DataFrame, rule: ChainRule) -> DataFrame:
    line = Window.partitionBy(rule.key).orderBy("version_number")
    nxt = df.select("*", F.lead("valid_from").over(line).alias("_next_from"),
                    F.lead("version_number").over(line).alias("_next_version"))
    return nxt.where((F.col("_next_from") != F.col("valid_to"))
                     | (F.col("_next_version") != F.col("version_number") + 1)
                     ).drop("_next_from", "_next_version")


def audit(tables: dict[str, DataFrame], rules: dict[str, list[Rule]],
          with_declared: bool = True) -> DataFrame:
    """(rule, table_name, check_name, violations) for every rule of the given tables.

    Duplicates count keys, orphans count rows.
    """
    parts, references = [], []
    for table, table_rules in rules.items():
        if table not in tables:
            continue
        df = tables[table]
        rows = [r for r in table_rules if isinstance(r, RowRule)]
        if with_declared:
            rows += declared(table)
        if rows:
            parts.append(_row_rules(df, table, rows))
        unique = [r for r in table_rules if isinstance(r, UniqueRule)]
        chains = [r for r in table_rules if isinstance(r, ChainRule)]
        for chain in chains:
            shared = [r for r in unique if r.columns == (chain.key,)]
            shared += [r for r in unique if len(r.columns) > 1 and r.columns[0] == chain.key][:1]
            unique = [r for r in unique if r not in shared]
            parts.append(_version_rules(df, table, chain.key, [chain, *shared]))
        if single := [r for r in unique if len(r.columns) == 1]:
            parts.append(_key_rules(df, table, single))
        for rule in unique:
            if len(rule.columns) > 1:
                parts.append(_lines(_duplicates(df, rule).agg(F.count("*").alias("v0")),
                                    [(table, rule)]))
        references += [(table, r) for r in table_rules
                       if isinstance(r, ReferenceRule) and r.parent in tables]
    if references:
        parts.append(_reference_rules(tables, references))
    return reduce(DataFrame.unionByName, parts)


def violations(df: DataFrame, rule: Rule, parent: DataFrame | None = None) -> DataFrame:
    """The offending rows (row and chain rules) or keys with their row count ``_n``."""
    if isinstance(rule, RowRule):
        return df.where(_is_bad(rule))
    if isinstance(rule, UniqueRule):
        return _duplicates(df, rule)
    if isinstance(rule, ChainRule):
        return _broken_chain(df, rule)
    if parent is None:
        raise ValueError("a reference rule needs its parent table")
    return _orphans(df, rule, parent)


def over_capacity(bookings: DataFrame, properties: DataFrame) -> DataFrame:
    """Bookings per property whose guests exceed what the property accommodates."""
    per_size = bookings.groupBy("property_id", "number_of_guests").agg(
        F.count("*").alias("bookings"))
    room = properties.select("property_id", "accommodates")
    return (per_size.join(room, "property_id")
            .where(F.col("number_of_guests") > F.col("accommodates"))
            .groupBy("property_id").agg(F.sum("bookings").alias("bookings"),
                                        F.max("number_of_guests").alias("most_guests"),
                                        F.max("accommodates").alias("accommodates")))


def require_unique(df: DataFrame, columns: tuple[str, ...], table: str) -> None:
    """Fail a batch whose declared key is not unique."""
    if not _duplicates(df, UniqueRule("DQ-13", columns)).isEmpty():
        raise ValueError(f"{table}: {', '.join(columns)} is not unique in the batch")
