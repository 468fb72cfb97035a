"""Quality rules: a rule set compiled to one aggregate over the data.

All rules but uniqueness are counters in a single aggregate, so a rule set
costs one scan without a shuffle. Each uniqueness rule adds one count over its
key columns only. The report has one row per result: null checks give one per
column, all other rules one each.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import quoted
from .keys import orphan_values

SEVERITIES = ("error", "warning", "info")
RULE_TYPES = ("schema", "null_check", "business_rule", "freshness", "volume", "uniqueness")


@dataclass(frozen=True)
class Rule:
    name: str
    type: str
    severity: str = "error"
    config: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def of(cls, raw: Mapping[str, Any]) -> "Rule":
        return cls(raw["name"], raw["type"], raw.get("severity", "error"), raw.get("config") or {})


def load_rules(source: str | Iterable[Mapping[str, Any]] | Mapping[str, Any]) -> list[Rule]:
    """Rules from a list, a mapping with ``rules``, or the path of a YAML or JSON file."""
    if isinstance(source, str):
        with open(source, encoding="utf-8") as handle:
            text = handle.read()
        if source.endswith(".json"):
            source = json.loads(text)
        else:
            import yaml

            source = yaml.safe_load(text)
    if isinstance(source, Mapping):
        source = source.get("rules", [])
    return [Rule.of(r) for r in source]


# The rule sets shipped for the sales tables.
BRONZE_RULES = [
    {"name": "required_columns_bronze", "type": "schema", "severity": "error", "config": {"columns": [
        "transaction_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
        "transaction_date", "_extraction_timestamp", "_source_system", "_source_entity"]}},
    {"name": "no_nulls_in_keys", "type": "null_check", "severity": "error", "config": {
        "columns": ["transaction_id", "customer_id", "product_id"], "max_null_percentage": 0}},
    {"name": "limited_nulls_in_optional", "type": "null_check", "severity": "warning", "config": {
        "columns": ["customer_email", "notes"], "max_null_percentage": 50}},
    {"name": "minimum_volume", "type": "volume", "severity": "warning", "config": {
        "min_rows": 1, "max_rows": 10000000}},
    {"name": "data_freshness", "type": "freshness", "severity": "warning", "config": {
        "column": "_extraction_timestamp", "max_age_hours": 48}},
    {"name": "positive_quantity", "type": "business_rule", "severity": "error", "config": {
        "condition": "quantity > 0"}},
    {"name": "positive_prices", "type": "business_rule", "severity": "error", "config": {
        "condition": "unit_price > 0 AND total_amount > 0"}},
    {"name": "amount_calculation", "type": "business_rule", "severity": "warning", "config": {
        "condition": "ABS(total_amount - (quantity * unit_price)) < 0.01"}},
]
SILVER_RULES = [
    {"name": "required_columns_silver", "type": "schema", "severity": "error", "config": {"columns": [
        "transaction_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
        "transaction_date", "_silver_load_timestamp", "_bronze_source_path", "_transformer_name"]}},
    {"name": "unique_transaction_id", "type": "uniqueness", "severity": "error", "config": {
        "columns": ["transaction_id"]}},
    {"name": "no_nulls_in_required_fields", "type": "null_check", "severity": "error", "config": {
        "columns": ["transaction_id", "customer_id", "product_id", "quantity", "unit_price",
                    "total_amount", "transaction_date"], "max_null_percentage": 0}},
    {"name": "valid_quantity", "type": "business_rule", "severity": "error", "config": {
        "condition": "quantity > 0 AND quantity < 10000"}},
    {"name": "valid_amount", "type": "business_rule", "severity": "error", "config": {
        "condition": "total_amount > 0 AND total_amount < 1000000"}},
    {"name": "valid_date_range", "type": "business_rule", "severity": "error", "config": {
        "condition": "transaction_date >= '2020-01-01' AND transaction_date <= CURRENT_DATE()"}},
    {"name": "expected_volume", "type": "volume", "severity": "warning", "config": {
        "min_rows": 100, "max_rows": 5000000}},
    {"name": "silver_freshness", "type": "freshness", "severity": "warning", "config": {
        "column": "_silver_load_timestamp", "max_age_hours": 24}},
]


class ValidationFailed(ValueError):
    """Raised by a gate; lists every failure of the pass."""


@dataclass(frozen=True)
class ValidationResult:
    """The report of one run of rules, a row for each; all else is read from it."""

    report: tuple[Row, ...] = ()
    timestamp: datetime = field(default_factory=datetime.now)

    def broken(self, severity: str) -> list[dict]:
        """The rules of a severity that did not hold, in their order."""
        return [
            {"rule_name": r["rule_name"], "severity": severity, "message": _message(r),
             "details": {k: r[k] for k in ("column_name", "measured") if r[k] is not None}}
            for r in self.report if r["severity"] == severity and not r["passed"]
        ]

    failures = property(lambda self: self.broken("error"))
    warnings = property(lambda self: self.broken("warning"))
    rules_executed = property(lambda self: len(self.report))
    rules_passed = property(lambda self: sum(r["passed"] for r in self.report))
    rules_failed = property(lambda self: len(self.failures))
    passed = property(lambda self: not self.failures, doc="Only broken rules of severity error fail a run.")

    def to_dict(self) -> dict:
        # The names in the report of a run.
        names = ("passed", "rules_executed", "rules_passed", "rules_failed", "failures", "warnings")
        return {"timestamp": self.timestamp.isoformat(), **{n: getattr(self, n) for n in names}}


# The wording of the failures.
_MESSAGES = {
    "schema": "Missing required columns: {detail}",
    "null_check": "Column '{column}' has {measured:.2f}% nulls (max: {limit}%)",
    "null_check.missing": "Column '{column}' not found",
    "business_rule": "Business rule violated: {count} records don't satisfy '{detail}'",
    "freshness": "Data is {measured:.1f} hours old (max: {limit} hours)",
    "freshness.missing": "Freshness column '{column}' not found",
    "volume.low": "Row count {count} below minimum {limit}",
    "volume.high": "Row count {count} above maximum {limit}",
    "uniqueness": "Found {count} duplicate records on {detail}",
    "failed": "Rule execution failed: {detail}",
}


def _message(row: Row) -> str:
    limit = row["threshold"]
    shown = None if limit is None else int(limit) if float(limit).is_integer() else limit
    measured = row["measured"]
    return _MESSAGES[row["outcome"]].format(
        column=row["column_name"],
        measured=measured if measured is not None else 0.0,
        count=None if measured is None else int(measured),
        limit=shown,
        detail=row["detail"],
    )


# --- compilation -------------------------------------------------------------

_REPORT = (
    "position int, rule_name string, rule_type string, severity string, column_name string, "
    "measured double, threshold double, detail string, outcome string, passed boolean"
)


def _entry(
    position: int,
    rule: Rule,
    passed: Column,
    measured: Column | None = None,
    column: str | None = None,
    threshold: Any = None,
    detail: str | None = None,
    outcome: Column | str | None = None,
) -> Column:
    result = F.lit(outcome or rule.type) if not isinstance(outcome, Column) else outcome
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(rule.name).alias("rule_name"),
        F.lit(rule.type).alias("rule_type"),
        F.lit(rule.severity).alias("severity"),
        F.lit(column).cast("string").alias("column_name"),
        (F.lit(None) if measured is None else measured).cast("double").alias("measured"),
        limit.cast("double").alias("threshold"),
        F.lit(detail).cast("string").alias("detail"),
        result.alias("outcome"),
        passed.cast("boolean").alias("passed"),
    )


def _hours_since(latest: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(latest.cast("timestamp"))) / F.lit(3.6e9)


class _Compiler:
    """Collects the counters of a rule set and the report rows built on them."""

    def __init__(self, df: DataFrame, now: Column):
        self.df = df
        self.now = now
        self.counters: dict[str, Column] = {}
        self.entries: list[Column] = []
        self.unique: list[DataFrame] = []

    def counter(self, c: Column) -> Column:
        name = f"m{len(self.counters)}"
        self.counters[name] = c.alias(name)
        return F.col(name)

    def total(self) -> Column:
        self.counters.setdefault("total", F.count("*").alias("total"))
        return F.col("total")

    def add(self, position: int, rule: Rule) -> None:
        handler = getattr(self, f"_{rule.type}", None) if rule.type in RULE_TYPES else None
        if handler is None:
            self.entries.append(_entry(position, rule, F.lit(True)))  # unknown types pass
            return
        handler(position, rule)

    def fail(self, position: int, rule: Rule, error: Exception) -> None:
        broken = Rule(rule.name, rule.type, "error", rule.config)
        text = str(error).split("\n", 1)[0]
        self.entries.append(_entry(position, broken, F.lit(False), detail=text, outcome="failed"))

    def _schema(self, position: int, rule: Rule) -> None:
        missing = sorted(set(rule.config.get("columns", [])) - set(self.df.columns))
        self.entries.append(_entry(position, rule, F.lit(not missing), detail=str(missing) if missing else None))

    def _null_check(self, position: int, rule: Rule) -> None:
        limit = rule.config.get("max_null_percentage", 0)
        for column in rule.config.get("columns", []):
            if column not in self.df.columns:
                self.entries.append(
                    _entry(position, rule, F.lit(False), column=column, outcome="null_check.missing")
                )
                continue
            nulls = self.counter(F.count_if(F.col(quoted(column)).isNull()))
            share = F.when(self.total() > 0, nulls / self.total() * 100).otherwise(F.lit(0.0))
            self.entries.append(_entry(position, rule, share <= F.lit(limit), share, column, limit))

    def _business_rule(self, position: int, rule: Rule) -> None:
        condition = rule.config.get("condition")
        if not condition:
            self.entries.append(_entry(position, rule, F.lit(True)))
            return
        violated = F.expr(f"NOT ({condition})")
        self.df.select(violated)  # resolves names and types, runs nothing
        count = self.counter(F.count_if(violated))
        self.entries.append(_entry(position, rule, count == 0, count, detail=condition))

    def _freshness(self, position: int, rule: Rule) -> None:
        column, limit = rule.config.get("column"), rule.config.get("max_age_hours", 24)
        if column not in self.df.columns:
            self.entries.append(_entry(position, rule, F.lit(False), column=column, outcome="freshness.missing"))
            return
        age = _hours_since(self.counter(F.max(quoted(column))), self.now)
        self.entries.append(
            _entry(position, rule, F.coalesce(age <= F.lit(limit), F.lit(True)), age, column, limit)
        )

    def _volume(self, position: int, rule: Rule) -> None:
        low, high = rule.config.get("min_rows", 0), rule.config.get("max_rows")
        below = self.total() < F.lit(low)
        above = self.total() > F.lit(high) if high is not None else F.lit(False)
        self.entries.append(
            _entry(
                position,
                rule,
                ~(below | above),
                self.total(),
                threshold=F.when(below, F.lit(low)).when(above, F.lit(high)),
                outcome=F.when(below, F.lit("volume.low")).when(above, F.lit("volume.high")).otherwise(F.lit("volume")),
            )
        )

    def _uniqueness(self, position: int, rule: Rule) -> None:
        columns = list(rule.config.get("columns", []))
        repeats = duplicate_rows(self.df, columns).select(F.col("duplicates").alias("d"))
        entry = _entry(position, rule, F.col("d") == 0, F.col("d"), detail=str(columns))
        self.unique.append(repeats.select(entry.alias("e")).select("e.*"))

    def report(self) -> DataFrame:
        parts = list(self.unique)
        if self.entries:
            counters = list(self.counters.values()) or [F.lit(1).alias("one")]
            # Without counters no data is needed; one literal row carries the results.
            base = self.df.agg(*counters) if self.counters else self.df.sparkSession.range(1).select(*counters)
            parts.append(base.select(F.explode(F.array(*self.entries)).alias("e")).select("e.*"))
        if not parts:
            return self.df.sparkSession.createDataFrame([], _REPORT)
        return reduce(DataFrame.unionByName, parts)


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows beyond the first of each key. Null keys count like values.

    Two levels, so the keys are reduced on the map side before the shuffle.
    """
    per_key = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def _now(now: datetime | None) -> Column:
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")


def rules_report(df: DataFrame, rules: Iterable[Rule | Mapping[str, Any]], now: datetime | None = None) -> DataFrame:
    """The report as a DataFrame. A rule that does not resolve is a failed row."""
    compiler = _Compiler(df, _now(now))
    for position, raw in enumerate(rules):
        rule = raw if isinstance(raw, Rule) else Rule.of(raw)
        try:
            compiler.add(position, rule)
        except PySparkException as error:
            compiler.fail(position, rule, error)
    return compiler.report()


def _collect(df: DataFrame, rules: Sequence[Rule], now: datetime | None) -> list[Row]:
    """Report rows; as many as the rules have results, whatever the data size."""
    try:
        return rules_report(df, rules, now).collect()
    except PySparkException as error:
        if len(rules) == 1:
            broken = Rule(rules[0].name, rules[0].type, "error", rules[0].config)
            compiler = _Compiler(df, _now(now))
            compiler.fail(0, broken, error)
            return compiler.report().collect()
        # One rule raised on the data: run them one by one to find it.
        return [
            Row(**{**row.asDict(), "position": position})
            for position, rule in enumerate(rules)
            for row in _collect(df, [rule], now)
        ]


def validate(df: DataFrame, rules: Iterable[Rule | Mapping[str, Any]], now: datetime | None = None) -> ValidationResult:
    parsed = [r if isinstance(r, Rule) else Rule.of(r) for r in rules]
    return ValidationResult(tuple(sorted(_collect(df, parsed, now), key=lambda r: r["position"])))


def require_passed(result: ValidationResult) -> ValidationResult:
    """The result itself, or an error that lists every rule of severity error that failed."""
    if not result.passed:
        raise ValidationFailed("; ".join(f"{f['rule_name']}: {f['message']}" for f in result.failures))
    return result


def gate(df: DataFrame, rules: Iterable[Rule | Mapping[str, Any]], now: datetime | None = None) -> ValidationResult:
    """Validate and raise when a rule of severity error fails."""
    return require_passed(validate(df, rules, now))


# --- standalone checks --------------------------------------------------------

class QualityChecks:
    """A list of checks that runs in one pass.

    Unlike the rules, a null check gives one result for all its columns, and
    ``min_rows`` or ``max_rows`` of zero mean no limit.
    """

    def __init__(self, df: DataFrame, fail_on_error: bool = True, now: datetime | None = None):
        self.df = df
        self.fail_on_error = fail_on_error
        self.now = now
        self._checks: list[tuple[str, list[Rule]]] = []

    def _add(self, name: str, *rules: Rule) -> "QualityChecks":
        self._checks.append((name, list(rules)))
        return self

    def schema(self, columns: Sequence[str], name: str = "schema_check") -> "QualityChecks":
        return self._add(name, Rule(name, "schema", config={"columns": list(columns)}))

    def nulls(self, columns: Sequence[str], max_null_percentage: float = 0.0, name: str = "null_check") -> "QualityChecks":
        config = {"columns": list(columns), "max_null_percentage": max_null_percentage}
        return self._add(name, Rule(name, "null_check", config=config))

    def volume(self, min_rows: int | None = None, max_rows: int | None = None, name: str = "volume_check") -> "QualityChecks":
        config = {"min_rows": min_rows or 0, "max_rows": max_rows or None}
        return self._add(name, Rule(name, "volume", config=config))

    def freshness(self, column: str, max_age_hours: float = 24, name: str = "freshness_check") -> "QualityChecks":
        return self._add(name, Rule(name, "freshness", config={"column": column, "max_age_hours": max_age_hours}))

    def duplicates(self, key_columns: Sequence[str], name: str = "duplicate_check") -> "QualityChecks":
        return self._add(name, Rule(name, "uniqueness", config={"columns": list(key_columns)}))

    def run(self) -> list[dict]:
        rules = [r for _, group in self._checks for r in group]
        rows: dict[int, list[Row]] = {}
        for row in _collect(self.df, rules, self.now):
            rows.setdefault(row["position"], []).append(row)
        results = []
        for position, (name, _) in enumerate(self._checks):
            bad = [r for r in rows.get(position, []) if not r["passed"]]
            entry = {"check": name, "status": "FAILED" if bad else "PASSED"}
            if bad:
                entry["message"] = f"{name} FAILED: " + "; ".join(_message(r) for r in bad)
            results.append(entry)
        failed = [r["message"] for r in results if r["status"] == "FAILED"]
        if failed and self.fail_on_error:
            raise ValidationFailed(" | ".join(failed))
        return results


# --- column tests -------------------------------------------------------------

def not_null_test(df: DataFrame, column: str) -> DataFrame:
    """Failing rows of a not-null test."""
    return df.filter(F.col(column).isNull())


def unique_test(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    found = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return found.filter("rows > 1")


# The tests declared for the raw tables, the staging views and
# the marts. A relationship names the parent table and column.
COLUMN_TESTS = {
    "departments": {"id": ["unique", "not_null"], "department": ["not_null"]},
    "jobs": {"id": ["unique", "not_null"], "job": ["not_null"]},
    "hired_employees": {
        "id": ["unique", "not_null"],
        "name": ["not_null"],
        "datetime": ["not_null"],
        "department_id": ["not_null", ("departments", "id")],
        "job_id": ["not_null", ("jobs", "id")],
    },
    "stg_departments": {"id": ["unique", "not_null"], "department": ["not_null"]},
    "stg_jobs": {"id": ["unique", "not_null"], "job": ["not_null"]},
    "stg_hired_employees": {"id": ["unique", "not_null"], "hire_year": ["not_null"], "hire_quarter": ["not_null"]},
    "mart_hires_by_quarter": {
        c: ["not_null"] for c in ("department", "job", "hire_year", "q1", "q2", "q3", "q4")
    },
    "mart_departments_above_mean": {"id": ["unique", "not_null"], "department": ["not_null"], "hired": ["not_null"]},
}


def run_column_tests(
    tables: Mapping[str, DataFrame], tests: Mapping[str, Mapping[str, Sequence]] = COLUMN_TESTS
) -> DataFrame:
    """One row per test with its number of failures: null rows, repeated
    values, or rows without a parent. The null tests of a table share a scan."""
    parts = []
    for name, df in tables.items():
        nulls = [c for c, kinds in tests.get(name, {}).items() if "not_null" in kinds]
        if nulls:
            counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(nulls)])
            listed = [
                F.struct(F.lit(c).alias("column"), F.lit("not_null").alias("test"), F.col(f"n{i}").alias("failures"))
                for i, c in enumerate(nulls)
            ]
            parts.append(counted.select(F.lit(name).alias("table_name"), F.inline(F.array(*listed))))
        for column, kinds in tests.get(name, {}).items():
            for kind in kinds:
                if kind == "unique":
                    failures, label = unique_test(df, column).agg(F.count("*").alias("failures")), "unique"
                elif not isinstance(kind, str):
                    missing = orphan_values(df, column, tables[kind[0]], kind[1])
                    failures = missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"))
                    label = "relationships"
                else:
                    continue
                parts.append(
                    failures.select(
                        F.lit(name).alias("table_name"), F.lit(column).alias("column"), F.lit(label).alias("test"), "failures"
                    )
                )
    return reduce(DataFrame.unionByName, parts)


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)
