"""Data-quality rules: a full report first, then a failure."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hindsight.operators.upsert import duplicate_keys
from hindsight.session import null_safe


class ChecksFailed(RuntimeError):
    def __init__(self, failed: list[tuple[str, str]]):
        super().__init__("; ".join(f"{name} ({detail})" for name, detail in failed))
        self.failed = failed


@dataclass(frozen=True)
class RowRule:
    """At most ``allowed`` rows may violate: false is a violation, and so is null unless ``null_ok``.

    ``holds`` says what a good row looks like. With ``per`` the bound holds for
    each value of a column on its own (one first row per person, say); null is
    a value as well.
    """

    name: str
    holds: Column
    allowed: int = 0
    null_ok: bool = False
    per: str | None = None


@dataclass(frozen=True)
class Floor:
    """At least ``least`` rows, of those meeting ``where`` if given."""

    name: str
    least: int
    where: Column | None = None


def in_domain(name: str, column: str, values: Sequence, null_ok: bool = False) -> RowRule:
    return RowRule(name, F.col(column).isin(list(values)), null_ok=null_ok)


def not_null_where(name: str, column: str, condition: Column) -> RowRule:
    return RowRule(name, F.col(column).isNotNull() | ~F.coalesce(condition, F.lit(False)))


def null_bound(name: str, column: str, per: str | None = None, allowed: int = 1) -> RowRule:
    return RowRule(name, F.col(column).isNotNull(), allowed=allowed, per=per)


def one_hot_sum(name: str, columns: Sequence[str]) -> RowRule:
    return RowRule(name, reduce(lambda a, b: a + b, [F.col(c) for c in columns]) == 1)


def check_rows(df: DataFrame, rules: Sequence[RowRule | Floor]) -> DataFrame:
    """All row rules and floors of one table, one report row each.

    One pass for all of them, and one more for the rules of each column that bounds are kept per.
    """
    columns = dict.fromkeys(r.per for r in rules if isinstance(r, RowRule) and r.per)
    parts = [_counted_rules(df, [r for r in rules if isinstance(r, Floor) or not r.per])] if any(isinstance(r, Floor) or not r.per for r in rules) else []
    parts += [_grouped_rules(df, [r for r in rules if isinstance(r, RowRule) and r.per == c], c) for c in columns]
    return combine(parts)


def _bad(rule: RowRule) -> Column:
    return ~F.coalesce(rule.holds, F.lit(rule.null_ok))


def _report(totals: DataFrame, rules: Sequence[RowRule | Floor], text: str) -> DataFrame:
    rows = []
    for i, rule in enumerate(rules):
        n, bound = F.col(f"n{i}"), F.col(f"bound{i}")
        floor = isinstance(rule, Floor)
        detail = F.format_string("%d rows, at least %d" if floor else text, n, bound)
        ok = n >= bound if floor else (n == 0 if rule.per else n <= bound)
        rows.append(F.struct(F.lit(rule.name).alias("name"), ok.alias("ok"), detail.alias("detail")))
    return totals.select(F.inline(F.array(*rows)))


def _measures(rules: Sequence[RowRule | Floor]) -> list[Column]:
    measures: list[Column] = []
    for i, rule in enumerate(rules):
        floor = isinstance(rule, Floor)
        counted = (F.lit(True) if rule.where is None else rule.where) if floor else _bad(rule)
        measures.append(F.count_if(counted).alias(f"n{i}"))
    return measures


def _bounds(rules: Sequence[RowRule | Floor]) -> list[int]:
    return [r.least if isinstance(r, Floor) else r.allowed for r in rules]


def _counted_rules(df: DataFrame, rules: Sequence[RowRule | Floor]) -> DataFrame:
    bounds = {f"bound{i}": F.lit(bound).cast("bigint") for i, bound in enumerate(_bounds(rules))}
    return _report(df.agg(*_measures(rules)).withColumns(bounds), rules, "%d bad rows, at most %d")


class Watch:
    """Rules counted while rows are written, so that checking them reads nothing again.

    Write ``rows``, all of them and once, before asking for ``report`` or
    ``count``. A rule with ``per`` needs its rows together and can't be watched.
    """

    def __init__(self, df: DataFrame, rules: Sequence[RowRule | Floor]):
        if any(isinstance(r, RowRule) and r.per for r in rules):
            raise ValueError("a bound per value is no matter of single rows")
        self.rules, self._seen = list(rules), Observation()
        self.rows = df.observe(self._seen, F.count("*").alias("rows"), *_measures(rules))

    def count(self, name: str | None = None) -> int:
        """Rows written; with the name of a floor, those that it counts."""
        found = self._seen.get
        return found["rows"] if name is None else found[f"n{[r.name for r in self.rules].index(name)}"]

    def report(self) -> DataFrame:
        spark, found = self.rows.sparkSession, self._seen.get
        row = {f"n{i}": found[f"n{i}"] for i in range(len(self.rules))} | {f"bound{i}": b for i, b in enumerate(_bounds(self.rules))}
        totals = spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in row.items()])
        return _report(totals, self.rules, "%d bad rows, at most %d")


def offending_rows(df: DataFrame, rules: Sequence[RowRule], keys: Sequence[str]) -> DataFrame:
    """(rule, *keys) of each row and rule that it breaks, in one pass; of rules with ``per`` also what is allowed."""
    broken = F.filter(F.array(*[F.when(_bad(r), F.lit(r.name)) for r in rules]), lambda name: name.isNotNull())
    return df.select(F.explode(broken).alias("rule"), *keys)


def _grouped_rules(df: DataFrame, rules: Sequence[RowRule], per: str) -> DataFrame:
    """Values of ``per`` with more bad rows than allowed."""
    counts = df.groupBy(per).agg(*[F.count_if(_bad(r)).alias(f"bad{i}") for i, r in enumerate(rules)])
    totals = counts.agg(*[F.count_if(F.col(f"bad{i}") > r.allowed).alias(f"n{i}") for i, r in enumerate(rules)])
    totals = totals.withColumns({f"bound{i}": F.lit(r.allowed).cast("bigint") for i, r in enumerate(rules)})
    return _report(totals, rules, f"%d values of {per} with more than %d bad rows")


def check_columns(df: DataFrame, name: str, contract: dict[str, str]) -> DataFrame:
    """Every contract column is there with its type; looks at the schema only."""
    have = dict(df.dtypes)
    missing = sorted(c for c in contract if c not in have)
    wrong = sorted(f"{c} is {have[c]}" for c, t in contract.items() if c in have and t and have[c] != t)
    return _stated(df.sparkSession, name, not missing and not wrong, f"missing: {missing}, mistyped: {wrong}")


def check_width(df: DataFrame, name: str, width: int, besides: int = 0) -> DataFrame:
    found = len(df.columns) - besides
    return _stated(df.sparkSession, name, found == width, f"{found} columns, expected {width}")


def check_unique(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """No key twice, null keys included; counted after a partial aggregation per key."""
    found = duplicate_keys(df, list(keys)).agg(F.count("*").alias("n"))
    return _counted(found, name, "%d repeated keys")


def check_orphans(child: DataFrame, parent: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Child rows whose key no parent has."""
    keys = list(keys)
    # one row per child key and its count: a hot key is one row in the join
    counted = child.groupBy(*keys).agg(F.count("*").alias("_rows"))
    lost = counted.join(parent.select(*keys), null_safe(counted, parent, keys), "left_anti")
    return _counted(lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")), name, "%d orphan rows")


def reconcile_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys only one side has, with ``only_left``; one aggregation over both sides."""
    keys = list(keys)
    both = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    seen = both.groupBy(*keys).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return seen.where(F.col("_l") != F.col("_r")).select(*keys, (F.col("_l") == 1).alias("only_left"))


def check_reconciled(left: DataFrame, right: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    gaps = reconcile_keys(left, right, keys).agg(
        F.count_if("only_left").alias("l"), F.count_if(~F.col("only_left")).alias("r")
    )
    return gaps.select(
        F.lit(name).alias("name"),
        ((F.col("l") == 0) & (F.col("r") == 0)).alias("ok"),
        F.format_string("%d keys missing, %d keys extra", "l", "r").alias("detail"),
    )


#: Positions below this are counted in bits, 64 a word; sequences beyond are rare and counted one by one.
POSITIONS = 1024


@dataclass(frozen=True)
class Lineage:
    """Keys of a source, of the table made of it, and of that table's children, who are told apart by a position from 0.

    One aggregation by key over all three, of numbers of fixed width, so that a
    key held by a third of all rows is one row a task before the exchange.
    Null is a key as any other.
    """

    source: DataFrame
    parents: DataFrame
    children: DataFrame
    keys: Sequence[str]
    position: str

    def keyed(self) -> DataFrame:
        """A row a key: rows in source and parents, children, and how many of these repeat a position."""
        at = F.col("at")
        kind = lambda df, name, position: df.select(*self.keys, F.lit(name).alias("kind"), position.cast("bigint").alias("at"))
        none = F.lit(None)
        rows = kind(self.source, "s", none).unionByName(kind(self.parents, "p", none)).unionByName(kind(self.children, "c", F.col(self.position)))
        inside = (F.col("kind") == "c") & at.between(0, POSITIONS - 1)
        words = [
            F.bit_or(F.when(inside & (F.floor(at / 64) == w), F.expr("shiftleft(1L, cast(at % 64 as int))"))).alias(f"w{w}") for w in range(POSITIONS // 64)
        ]
        counts = [F.count_if(F.col("kind") == k).alias(name) for k, name in (("s", "sources"), ("p", "parents"), ("c", "children"))]
        grouped = rows.groupBy(*self.keys).agg(*counts, F.count_if(inside).alias("inside"), *words)
        distinct = reduce(lambda a, b: a + b, [F.coalesce(F.bit_count(f"w{w}"), F.lit(0)) for w in range(POSITIONS // 64)])
        return grouped.select(*self.keys, "sources", "parents", "children", (F.col("inside") - distinct).alias("repeated"))

    def _beyond(self) -> DataFrame:
        """Keys and positions that bits don't count, held more than once."""
        outside = ~F.coalesce(F.col(self.position).between(0, POSITIONS - 1), F.lit(False))
        return duplicate_keys(self.children.where(outside), [*self.keys, self.position])

    def offenders(self) -> DataFrame:
        """(problem, *keys, rows): which keys break which rule, and in how many rows."""
        problems = {
            "missing": ((F.col("sources") > 0) & (F.col("parents") == 0), F.col("sources")),
            "extra": ((F.col("sources") == 0) & (F.col("parents") > 0), F.col("parents")),
            "repeated": (F.col("parents") > 1, F.col("parents")),
            "orphan": ((F.col("children") > 0) & (F.col("parents") == 0), F.col("children")),
            "repeated child": (F.col("repeated") > 0, F.col("repeated")),
        }
        listed = F.array(*[F.when(c, F.struct(F.lit(name).alias("problem"), n.alias("rows"))) for name, (c, n) in problems.items()])
        found = self.keyed().select(F.explode(F.filter(listed, lambda x: x.isNotNull())).alias("x"), *self.keys).select("x.problem", *self.keys, "x.rows")
        beyond = self._beyond().groupBy(*self.keys).agg(F.sum(F.col("rows") - 1).alias("rows"))
        return found.unionByName(beyond.select(F.lit("repeated child").alias("problem"), *self.keys, "rows"))

    def check(self, unique: str, reconciled: str, child_unique: str | None, orphans: str) -> DataFrame:
        """Four report rows of these names; without a name for it, none on repeated children, which are not looked for then."""
        totals = self.keyed().agg(
            F.count_if(F.col("parents") > 1).alias("unique"),
            F.count_if((F.col("sources") > 0) & (F.col("parents") == 0)).alias("missing"),
            F.count_if((F.col("sources") == 0) & (F.col("parents") > 0)).alias("extra"),
            F.coalesce(F.sum("repeated"), F.lit(0)).alias("inside"),
            F.coalesce(F.sum(F.when(F.col("parents") == 0, F.col("children"))), F.lit(0)).alias("orphans"),
        )
        if child_unique is not None:
            beyond = self._beyond().agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)))
            totals = totals.withColumn("repeated", F.col("inside") + beyond.scalar())

        def row(name: str, text: str, *counts: str):
            ok = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in counts])
            return F.struct(F.lit(name).alias("name"), ok.alias("ok"), F.format_string(text, *[F.col(c) for c in counts]).alias("detail"))

        rows = [
            row(unique, "%d repeated keys", "unique"),
            row(reconciled, "%d keys missing, %d keys extra", "missing", "extra"),
            *([] if child_unique is None else [row(child_unique, "%d rows repeat a key", "repeated")]),
            row(orphans, "%d orphan rows", "orphans"),
        ]
        return totals.select(F.inline(F.array(*rows)))


def check_equal_counts(spark: SparkSession, found: int, expected: int, name: str) -> DataFrame:
    """Two counts that are known already."""
    return _stated(spark, name, found == expected, f"{found} rows, expected {expected}")


def check_same_count(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    a, b = (df.agg(F.count("*").alias("n")) for df in (left, right))
    both = a.select(F.col("n").alias("l"), b.scalar().alias("r"))
    return both.select(
        F.lit(name).alias("name"),
        (F.col("l") == F.col("r")).alias("ok"),
        F.format_string("%d rows, expected %d", "l", "r").alias("detail"),
    )


def combine(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def enforce(report: DataFrame) -> list[tuple[str, bool, str]]:
    """Run the whole report, one row per rule, and raise afterwards if any rule failed."""
    rows = [(r["name"], r["ok"], r["detail"]) for r in report.collect()]
    failed = [(name, detail) for name, ok, detail in rows if not ok]
    if failed:
        raise ChecksFailed(failed)
    return rows


def _stated(spark: SparkSession, name: str, ok: bool, detail: str) -> DataFrame:
    return spark.range(1).select(F.lit(name).alias("name"), F.lit(ok).alias("ok"), F.lit(detail).alias("detail"))


def _counted(found: DataFrame, name: str, text: str) -> DataFrame:
    n = F.col("n")
    return found.select(F.lit(name).alias("name"), (n == 0).alias("ok"), F.format_string(text, n).alias("detail"))
