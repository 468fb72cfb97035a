"""Row contracts: declared columns compiled to typed columns and reject reasons.

``Contract.annotate`` keeps every row. It adds one array of reasons per row,
computed on the safely cast values, so the accepted rows (empty array) and the
rejected rows (the rest) always add up to the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import iso_timestamp, strip

REASONS = "_reasons"
SOURCE = "_source"
RAW = "_raw"
OK = "_ok"

# Declared type name -> Spark type.
DECLARED_TYPES = {
    "string": "string",
    "integer": "bigint",
    "float": "double",
    "boolean": "boolean",
    "datetime": "timestamp_ntz",
}

# The wording of the reject reasons.
REASON_INVALID = "{} is null/invalid"
REASON_EMPTY = "{} is empty"
REASON_DATETIME = "{} is empty/invalid format"
REASON_MIN = "{} is below {}"
REASON_MAX = "{} is above {}"


class MissingColumnsError(ValueError):
    """A required column is absent from the source."""


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str = "id"
    label: str | None = None

    @property
    def parent_label(self) -> str:
        return self.label or self.parent


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = True
    non_blank: bool = False
    minimum: float | None = None
    maximum: float | None = None

    def typed(self, source: T.DataType) -> Column:
        raw = F.col(self.name)
        if self.type == "timestamp_ntz" and isinstance(source, T.StringType):
            return iso_timestamp(raw)
        if self.type == "string":
            text = raw.cast("string")
            return strip(text) if self.non_blank else text
        return raw.try_cast(self.type)

    def reasons(self, raw: Column, value: Column) -> list[Column]:
        """What is wrong with a value, from its source form and its typed one."""
        found = []
        if self.type == "string":
            if self.non_blank:
                found.append(F.when(value.isNull() | (value == ""), F.lit(REASON_EMPTY.format(self.name))))
            elif self.required:
                found.append(F.when(raw.isNull(), F.lit(REASON_INVALID.format(self.name))))
        else:
            text = REASON_DATETIME if self.type == "timestamp_ntz" else REASON_INVALID
            broken = value.isNull() if self.required else raw.isNotNull() & value.isNull()
            found.append(F.when(broken, F.lit(text.format(self.name))))
        if self.minimum is not None:
            found.append(F.when(value < F.lit(self.minimum), F.lit(REASON_MIN.format(self.name, self.minimum))))
        if self.maximum is not None:
            found.append(F.when(value > F.lit(self.maximum), F.lit(REASON_MAX.format(self.name, self.maximum))))
        return found


@dataclass(frozen=True)
class Contract:
    table: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ("id",)
    foreign_keys: tuple[ForeignKey, ...] = ()
    version: str = "1.0"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def string_schema(self) -> T.StructType:
        """Reader schema: every column as text, so no value is lost on read."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def typed_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, T.DataType.fromDDL(f.type)) for f in self.fields]
        )

    def check_columns(self, df: DataFrame) -> None:
        missing = [f.name for f in self.fields if f.required and f.name not in df.columns]
        if missing:
            raise MissingColumnsError(f"missing required columns: {missing}")

    def annotate(self, df: DataFrame) -> DataFrame:
        """Typed contract columns, other columns unchanged, ``_reasons`` and ``_source``.

        ``_source`` is the row as it was read; only rejected rows ever use it.
        Values are typed first and the reasons found from them: within the
        lambda that drops empty reasons, each pattern would be matched again,
        and by interpreted code.
        """
        self.check_columns(df)
        types = {f.name: f.dataType for f in df.schema.fields}
        present = [f for f in self.fields if f.name in types]
        typed = {f.name: f.typed(types[f.name]).alias(f.name) for f in present}
        values = df.select(*[typed.get(c, F.col(c)) for c in df.columns], F.struct(*df.columns).alias(SOURCE))
        reasons = [r for f in present for r in f.reasons(F.col(SOURCE).getField(f.name), F.col(f.name))]
        return values.select(*df.columns, _compact(reasons).alias(REASONS), SOURCE)

    @classmethod
    def from_declared(cls, declared: Mapping[str, Any], table: str = "source", key: Sequence[str] = ()) -> "Contract":
        """Contract from a declaration of ``columns`` with name, type, required and bounds."""
        fields = []
        for column in declared.get("columns", []):
            bounds = column.get("validation") or {}
            kind = column.get("type", "string")
            fields.append(
                Field(
                    column["name"],
                    DECLARED_TYPES.get(kind, kind),
                    required=bool(column.get("required", False)),
                    minimum=bounds.get("min"),
                    maximum=bounds.get("max"),
                )
            )
        return cls(table, tuple(fields), tuple(key), version=str(declared.get("version", "1.0")))


def apply_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Declared types on the rows that satisfy the contract."""
    return accepted(contract.annotate(df))


def _compact(texts: Sequence[Column]) -> Column:
    return F.array_compact(F.array(F.lit(None).cast("string"), *texts))


def _source_json() -> Column:
    return F.to_json(F.col(SOURCE), {"ignoreNullFields": "false"})


def reason_text() -> Column:
    return F.concat_ws("; ", F.col(REASONS))


def accepted(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.size(REASONS) == 0).drop(REASONS, SOURCE)


def rejected(annotated: DataFrame, table: str) -> DataFrame:
    """Rows for the rejection log, without the time stamp the sink adds."""
    return annotated.filter(F.size(REASONS) > 0).select(
        F.lit(table).alias("table_name"),
        _source_json().alias("raw_row"),
        reason_text().alias("reason"),
    )


def sealed(annotated: DataFrame) -> DataFrame:
    """Form in which an annotated frame is written: the source text of rejected
    rows only, and a flag column to partition by."""
    bad = F.size(REASONS) > 0
    return annotated.select(
        *[F.col(c) for c in annotated.columns if c not in (REASONS, SOURCE)],
        F.when(bad, reason_text()).alias("_reason"),
        F.when(bad, _source_json()).alias(RAW),
        (~bad).alias(OK),
    )


def sealed_accepted(written: DataFrame) -> DataFrame:
    return written.filter(F.col(OK)).drop("_reason", RAW, OK)


def sealed_rejected(written: DataFrame, table: str) -> DataFrame:
    return written.filter(~F.col(OK)).select(
        F.lit(table).alias("table_name"), F.col(RAW).alias("raw_row"), F.col("_reason").alias("reason")
    )


def add_reasons(annotated: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Quarantine by SQL predicates: a row that breaks one gets the rule's name.

    A predicate that is null is not a violation.
    """
    broken = [F.when(F.expr(f"NOT ({condition})"), F.lit(name)) for name, condition in rules.items()]
    return annotated.withColumn(REASONS, F.concat(F.col(REASONS), _compact(broken)))


def quarantine(df: DataFrame, rules: Mapping[str, str], table: str) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` by row rules into (clean rows, rejection rows)."""
    unmarked = df.select("*", _compact([]).alias(REASONS), F.struct(*df.columns).alias(SOURCE))
    marked = add_reasons(unmarked, rules)
    return accepted(marked), rejected(marked, table)


# The three staffing tables and their keys.
DEPARTMENTS = Contract(
    "departments",
    (Field("id", "int"), Field("department", "string", non_blank=True)),
)
JOBS = Contract(
    "jobs",
    (Field("id", "int"), Field("job", "string", non_blank=True)),
)
HIRED_EMPLOYEES = Contract(
    "hired_employees",
    (
        Field("id", "int"),
        Field("name", "string", non_blank=True),
        Field("datetime", "timestamp_ntz"),
        Field("department_id", "int"),
        Field("job_id", "int"),
    ),
    foreign_keys=(
        ForeignKey("department_id", "departments", label="raw.departments"),
        ForeignKey("job_id", "jobs", label="raw.jobs"),
    ),
)
STAFFING = {c.table: c for c in (DEPARTMENTS, JOBS, HIRED_EMPLOYEES)}

# The declared layout of the sales source.
SALES_DECLARED = {
    "version": "1.0",
    "description": "Schema for sales transaction data",
    "columns": [
        {"name": "transaction_id", "type": "string", "required": True},
        {"name": "customer_id", "type": "string", "required": True},
        {"name": "product_id", "type": "string", "required": True},
        {"name": "quantity", "type": "integer", "required": True, "validation": {"min": 1}},
        {"name": "unit_price", "type": "float", "required": True, "validation": {"min": 0}},
        {"name": "total_amount", "type": "float", "required": True},
        {"name": "transaction_date", "type": "datetime", "required": True},
        {"name": "customer_email", "type": "string", "required": False},
        {"name": "notes", "type": "string", "required": False},
    ],
}
SALES = Contract.from_declared(SALES_DECLARED, "sales", ("transaction_id",))
