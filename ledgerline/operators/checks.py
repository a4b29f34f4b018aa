"""Data-quality assertions evaluated as Spark aggregates.

A ``Rule`` names a model, a check kind, its column(s) and parameters.
``run_checks`` evaluates all column-level rules of one table in a single
global aggregate (``count_if`` per rule, no shuffled rows), all uniqueness
rules of one table in one grouped pass over their columns, and each
relationship rule as one anti join of distinct values. A table that is not
a stored one is computed once a pass: write it first. The result has one
row per rule: the number of failing rows (or groups).

NULL handling follows the usual test semantics: value rules (regex,
length, range, set) let NULL pass; ``unique`` ignores NULL; compound
uniqueness ignores rows whose key columns are all NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["model", "check_name", "column_name", "severity", "failures"]


@dataclass(frozen=True)
class Rule:
    model: str
    kind: str                      # not_null unique compound_unique regex length_equal
    #                                length_between between in_set row_count relationship
    columns: tuple[str, ...] = ()
    params: Mapping = field(default_factory=dict)
    severity: str = "error"

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


def _java_regex(pattern: str) -> str:
    """A trailing ``$`` also accepts a final newline in Java; use ``\\z``."""
    return pattern[:-1] + r"\z" if pattern.endswith("$") else pattern


def failing_condition(rule: Rule) -> Column:
    """Row-level predicate that is TRUE for a failing row."""
    p = rule.params
    if rule.kind == "not_null":
        return F.col(rule.columns[0]).isNull()
    c = F.col(rule.columns[0])
    cond = p.get("row_condition")
    if rule.kind == "regex":
        fail = ~c.rlike(_java_regex(p["regex"]))
    elif rule.kind == "length_equal":
        fail = F.length(c) != p["value"]
    elif rule.kind in ("length_between", "between"):
        v = F.length(c) if rule.kind == "length_between" else c
        fail = F.lit(False)
        if p.get("min_value") is not None:
            fail = fail | (v < p["min_value"])
        if p.get("max_value") is not None:
            fail = fail | (v > p["max_value"])
    elif rule.kind == "in_set":
        fail = ~c.isin(list(p["values"]))
    else:
        raise ValueError(rule.kind)
    fail = F.coalesce(fail & c.isNotNull(), F.lit(False))
    if cond is not None:
        fail = fail & F.coalesce(F.expr(cond), F.lit(False))
    return fail


def _result(rule: Rule, failures: Column) -> Column:
    return F.struct(F.lit(rule.model).alias("model"), F.lit(rule.kind).alias("check_name"),
                    F.lit(rule.column_name).alias("column_name"),
                    F.lit(rule.severity).alias("severity"),
                    failures.cast("bigint").alias("failures"))


def _bad_count(rule: Rule, n: Column) -> Column:
    lo, hi = rule.params.get("min_value"), rule.params.get("max_value")
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (n < lo)
    if hi is not None:
        bad = bad | (n > hi)
    return F.when(bad, 1).otherwise(0)


def _keep(cols: Sequence[str]) -> Column:
    keep = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        keep = keep | F.col(c).isNotNull()
    return keep


def _table_checks(df: DataFrame, rs: list[Rule], tables: Mapping[str, DataFrame]) -> list:
    """All rules of one table. Row rules and row counts are one global
    aggregate (counts per task, one row at the end: no row is shuffled);
    the uniqueness rules group their key columns in one pass; a relationship
    counts per child value before it joins."""
    row = [r for r in rs if r.kind not in ("unique", "compound_unique", "relationship",
                                           "row_count")]
    counts = [r for r in rs if r.kind == "row_count"]
    keys = [r for r in rs if r.kind in ("unique", "compound_unique")]
    rels = [r for r in rs if r.kind == "relationship"]
    parts = []
    if row or counts:
        one = df.agg(F.count(F.lit(1)).alias("__n"),
                     *[F.count_if(failing_condition(r)).alias(f"r{i}") for i, r in enumerate(row)])
        results = ([_result(r, F.col(f"r{i}")) for i, r in enumerate(row)]
                   + [_result(r, _bad_count(r, F.col("__n"))) for r in counts])
        parts.append(one.select(F.inline(F.array(*results))))
    if keys:
        # One row per rule and source row; a rule's columns stand in a struct
        # of their own, so each is grouped with its own types.
        marked = [F.struct(F.lit(i).alias("rule"), _keep(r.columns).alias("keep"),
                           *[(F.struct(*r.columns) if i == j else F.lit(None).cast(df.select(F.struct(*k.columns))
                              .schema[0].dataType)).alias(f"k{j}") for j, k in enumerate(keys)])
                  for i, r in enumerate(keys)]
        dup = (df.select(F.inline(F.array(*marked))).where("keep")
               .groupBy("rule", *[f"k{j}" for j in range(len(keys))]).count().where(F.col("count") > 1)
               .agg(*[F.count_if(F.col("rule") == i).alias(f"n{i}") for i in range(len(keys))]))
        parts.append(dup.select(F.inline(F.array(*[_result(r, F.col(f"n{i}")) for i, r in enumerate(keys)]))))
    for r in rels:
        col = r.columns[0]
        parent = tables[r.params["to"]].select(F.col(r.params["field"]).alias(col))
        # A value held by a large share of rows is one row in the join.
        per_value = df.groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
        orphans = (per_value.where(F.col(col).isNotNull())
                   .join(parent.distinct(), col, "left_anti")
                   .agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n")))
        parts.append(orphans.select(F.inline(F.array(_result(r, F.col("n"))))))
    return parts


def run_checks(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    parts: list[DataFrame] = []
    by_model: dict[str, list[Rule]] = {}
    for r in rules:
        by_model.setdefault(r.model, []).append(r)
    for model, rs in by_model.items():
        parts += _table_checks(tables[model], rs, tables)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failed(results: DataFrame, severity: str = "error") -> DataFrame:
    """Rules of ``severity`` with at least one failure."""
    return results.where((F.col("severity") == severity) & (F.col("failures") > 0))
