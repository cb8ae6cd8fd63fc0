"""Data quality: row rules on a flow, tests on finished tables.

A row rule states what a good row looks like; a row for which the condition is
NULL counts as a violation. A table test counts failing rows; there NULL passes
everything but ``not_null``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as X
from tradewind.operators import aggregates, joins

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: Column
    action: str = WARN


class RuleFailed(Exception):
    """A rule with action ``fail`` was violated; nothing was written."""


def _holds(rule: Rule) -> Column:
    return F.coalesce(rule.condition, F.lit(False))


def _kept(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [_holds(r) for r in rules if r.action == DROP], F.lit(True))


def _violations(rules: Sequence[Rule]) -> list[Column]:
    """One count per rule: warnings look only at rows the drop rules let through."""
    kept = _kept(rules)
    return [F.count_if((kept & ~_holds(r)) if r.action == WARN else ~_holds(r)).alias(r.name)
            for r in rules]


def drop_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.filter(_kept(rules)) if any(r.action == DROP for r in rules) else df


def rejected_rows(df: DataFrame, rules: Sequence[Rule], reasons: str = "_rejected_by") -> DataFrame:
    """The rows that drop rules turn away, with the names of the violated ones."""
    names = F.array_compact(F.array(*[F.when(~_holds(r), F.lit(r.name)) for r in rules if r.action == DROP]))
    return df.withColumn(reasons, names).filter(F.size(reasons) > 0)


def expectation_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, action, violations) for all rules in one pass over the rows."""
    counts = df.agg(*_violations(rules))
    return _as_rows(counts, [(r.name, r.action, F.col(r.name)) for r in rules],
                    ("rule", "action", "violations"))


def apply_expectations(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, dict[str, int]]:
    """The rows that pass the drop rules, and the violation counts.

    The counts are taken first, so a violated ``fail`` rule raises before any write.
    """
    if not rules:
        return df, {}
    return measure_expectations(df, rules, lambda kept: [])[:2]


def measure_expectations(df: DataFrame, rules: Sequence[Rule], facts: Callable[[Column], list[Column]]
                         ) -> tuple[DataFrame, dict[str, int], dict]:
    """``apply_expectations`` with further aggregates in the same pass.

    ``facts`` gets the condition that a row passes the drop rules.
    """
    found = df.agg(*_violations(rules), *facts(_kept(rules))).first().asDict()
    counts = {r.name: found.pop(r.name) for r in rules}
    failed = {r.name: counts[r.name] for r in rules if r.action == FAIL and counts[r.name]}
    if failed:
        raise RuleFailed(f"violated: {failed}")
    return drop_violations(df, rules), counts, found


def observe_expectations(df: DataFrame, rules: Sequence[Rule], name: str) -> DataFrame:
    """Counts violations as a by-product of whatever job runs the rows, then drops."""
    return drop_violations(df.observe(name, *_violations(rules)), rules) if rules else df


# --- table tests -------------------------------------------------------------

ERROR = "error"


@dataclass(frozen=True)
class TableTest:
    """``failing`` maps the tables to failing rows, or ``row_condition`` marks them.

    Tests given as row conditions on the same table are counted in one scan.
    """

    name: str
    table: str
    row_condition: Column | None = None
    failing: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None
    severity: str = ERROR


class TestsFailed(Exception):
    """At least one test of severity ``error`` found failing rows."""

    __test__ = False


def not_null(table: str, column: str, severity: str = ERROR) -> TableTest:
    return TableTest(f"{table}.{column} not_null", table, F.col(column).isNull(),
                     severity=severity)


def accepted_values(table: str, column: str, values: Iterable, severity: str = ERROR) -> TableTest:
    return TableTest(f"{table}.{column} accepted_values", table,
                     ~F.col(column).isin(*values), severity=severity)


def in_range(table: str, column: str, low=None, high=None, severity: str = ERROR) -> TableTest:
    bounds = ([F.col(column) < low] if low is not None else []) + (
        [F.col(column) > high] if high is not None else [])
    return TableTest(f"{table}.{column} in_range", table,
                     reduce(lambda a, b: a | b, bounds), severity=severity)


def not_in_future(table: str, column: str, now: Column | None = None,
                  severity: str = ERROR) -> TableTest:
    moment = F.current_timestamp() if now is None else now
    return TableTest(f"{table}.{column} not_in_future", table, F.col(column) > moment,
                     severity=severity)


def unique(table: str, *columns: str, severity: str = ERROR) -> TableTest:
    return TableTest(f"{table}.{'+'.join(columns)} unique", table,
                     failing=lambda t: aggregates.duplicate_keys(t[table], columns),
                     severity=severity)


def relationship(table: str, column: str, parent: str, parent_column: str,
                 severity: str = ERROR) -> TableTest:
    return TableTest(
        f"{table}.{column} references {parent}", table,
        failing=lambda t: joins.orphans(t[table].select(column), t[parent], column,
                                        parent_column),
        severity=severity)


def returns_no_rows(name: str, failing: Callable[[Mapping[str, DataFrame]], DataFrame],
                    severity: str = ERROR) -> TableTest:
    return TableTest(name, name, failing=failing, severity=severity)


def fresh(table: str, column: str, max_age_hours: int, now: Column | None = None,
          severity: str = WARN) -> TableTest:
    moment = F.current_timestamp() if now is None else now
    oldest = moment - F.make_dt_interval(hours=F.lit(max_age_hours))
    return TableTest(
        f"{table}.{column} fresh", table,
        failing=lambda t: t[table].agg(F.max(column).alias("latest")).filter(
            F.col("latest").isNull() | (F.col("latest") < oldest)),
        severity=severity)


def run_tests(tables: Mapping[str, DataFrame], tests: Sequence[TableTest]) -> DataFrame:
    """(test, severity, failing_rows, status), one row per test, still lazy."""
    parts = []
    row_tests: dict[str, list[TableTest]] = {}
    for test in tests:
        if test.row_condition is not None:
            row_tests.setdefault(test.table, []).append(test)
        else:
            count = test.failing(tables).agg(X.rows().alias("n"))
            parts.append(_as_rows(count, [(test.name, test.severity, F.col("n"))]))
    for table, group in row_tests.items():
        counts = tables[table].agg(*[F.count_if(t.row_condition).alias(f"n{i}")
                                     for i, t in enumerate(group)])
        parts.append(_as_rows(counts, [(t.name, t.severity, F.col(f"n{i}"))
                                       for i, t in enumerate(group)]))
    results = reduce(DataFrame.unionByName, parts)
    status = (F.when(F.col("failing_rows") == 0, "pass")
              .when(F.col("severity") == WARN, "warn").otherwise("fail"))
    return results.withColumn("status", status)


def require_passing(tables: Mapping[str, DataFrame], tests: Sequence[TableTest]) -> list:
    """Runs the tests; raises when an ``error`` test fails, else returns the result rows."""
    results = run_tests(tables, tests).collect()  # one row per test
    failed = [f"{r.test} ({r.failing_rows})" for r in results if r.status == "fail"]
    if failed:
        raise TestsFailed("; ".join(failed))
    return results


def _as_rows(counts: DataFrame, entries, names=("test", "severity", "failing_rows")) -> DataFrame:
    structs = [F.struct(F.lit(a).alias(names[0]), F.lit(b).alias(names[1]), c.alias(names[2]))
               for a, b, c in entries]
    return counts.select(F.inline(F.array(*structs)))
