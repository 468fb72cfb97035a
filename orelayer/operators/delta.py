"""Delta load: compare incoming rows with the stored table by key.

Insert-only. A row whose key is unknown is ``new``; a row equal to the stored
one, or a further identical copy inside the batch, is ``skipped``; everything
else is a ``conflict``: the stored row stays and the incoming one is reported
with its changed fields.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import canonical
from ..session import Workspace

STATUS = "_status"
COPIES = "_copies"
CHANGES = "_changes"

NEW, SKIPPED, CONFLICT = "new", "skipped", "conflict"

# The wording of a conflict in the rejection log.
CONFLICT_TEXT = "CONFLICT: %s=%s exists with different data — %s"
CHANGE_ARROW = " → "
NO_VALUE = "None"
BATCH_TEXT = "CONFLICT: %s=%s occurs with different data in one batch"

_CHANGE = "struct<field:string,current:string,incoming:string>"


def _canonical(df: DataFrame, columns: Sequence[str], prefix: str = "") -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [canonical(F.col(f"{prefix}{c}"), types[c]).alias(c) for c in columns]


def changed_fields(incoming: DataFrame, columns: Sequence[str], current: str = "_cur.") -> Column:
    """Array of (field, current, incoming) for the fields that differ."""
    entries = [
        F.when(
            ~ours.eqNullSafe(theirs),
            F.struct(
                F.lit(c).alias("field"),
                F.col(f"{current}{c}").cast("string").alias("current"),
                F.col(c).cast("string").alias("incoming"),
            ),
        )
        for c, ours, theirs in zip(columns, _canonical(incoming, columns), _canonical(incoming, columns, current))
    ]
    return F.array_compact(F.array(F.lit(None).cast(_CHANGE), *entries))


def _stored(existing: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Stored rows as one struct per key."""
    return existing.select(*key, F.struct(F.lit(0).alias("_"), *values).alias("_cur"))


def _by_row(rows: DataFrame, incoming: DataFrame, values: list[str], absent: str) -> DataFrame:
    """Status of single rows beside their stored row; ``absent`` when there is none."""
    compared = rows.withColumn(CHANGES, changed_fields(incoming, values))
    known = F.col("_cur").isNotNull()
    status = F.when(~known, F.lit(absent)).when(F.size(CHANGES) == 0, F.lit(SKIPPED)).otherwise(F.lit(CONFLICT))
    return compared.select(
        *incoming.columns,
        status.alias(STATUS),
        F.lit(1).cast("bigint").alias(COPIES),
        F.when(known, F.col(CHANGES)).otherwise(_no_changes()).alias(CHANGES),
    )


def _no_changes() -> Column:
    return F.array().cast(f"array<{_CHANGE}>")


def classify_unique(incoming: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """``classify`` for a batch in which no key repeats: one join, nothing else."""
    key = list(key)
    values = [c for c in incoming.columns if c not in key]
    return _by_row(incoming.join(_stored(existing, key, values), key, "left"), incoming, values, NEW)


def classify_repeated(incoming: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """``classify`` for keys that may repeat inside the batch.

    The rows are first reduced to one row per key (on the map side as well),
    so the join with the stored table is one to one whatever the skew. Only
    keys in dispute go back to their single rows.
    """
    key = list(key)
    values = [c for c in incoming.columns if c not in key]
    types = {f.name: f.dataType for f in incoming.schema.fields}
    same = F.struct(F.lit(0).alias("_"), *_canonical(incoming, values))
    # What the canonical form drops: which texts were null, and the exact times.
    texts = [c for c in values if isinstance(types[c], T.StringType)]
    times = [c for c in values if isinstance(types[c], (T.TimestampType, T.TimestampNTZType))]
    exact = F.struct(
        F.lit(0).alias("_"), *[F.col(c).isNull().alias(c) for c in texts], *[F.col(c) for c in times]
    )

    def restored(c: str) -> Column:
        if c in times:
            return F.col(f"_low.exact.{c}").alias(c)
        form = F.col(f"_low.same.{c}")
        return (F.when(~F.col(f"_low.exact.{c}"), form) if c in texts else form).alias(c)

    per_key = incoming.groupBy(*key).agg(
        F.count("*").alias("_n"),
        F.min(F.struct(same.alias("same"), exact.alias("exact"))).alias("_low"),
        F.max(same).alias("_high"),
    )
    stored = _stored(existing, key, values)
    one_form = per_key.join(stored, key, "left").select(
        *key, *[restored(c) for c in values], "_n", "_cur",
        F.col("_low.same").eqNullSafe(F.col("_high")).alias("_uniform"),
    )
    changes = changed_fields(incoming, values)
    known = F.col("_cur").isNotNull()
    disputed = ~F.col("_uniform") | (known & (F.size(changes) > 0))

    first = F.struct(F.lit(NEW).alias("s"), F.lit(1).cast("bigint").alias("n"))
    others = F.struct(F.lit(SKIPPED).alias("s"), (F.col("_n") - 1).alias("n"))
    all_known = F.struct(F.lit(SKIPPED).alias("s"), F.col("_n").alias("n"))
    settled = (
        one_form.filter(~disputed)
        .withColumn("_o", F.explode(F.when(known, F.array(all_known)).otherwise(F.array(first, others))))
        .filter("_o.n > 0")
        .select(
            *incoming.columns, F.col("_o.s").alias(STATUS), F.col("_o.n").alias(COPIES), _no_changes().alias(CHANGES)
        )
    )
    rows = incoming.join(one_form.filter(disputed).select(*key, "_cur"), key, "inner")
    return settled.unionByName(_by_row(rows, incoming, values, CONFLICT))


def marked_keys(incoming: DataFrame, existing: DataFrame, key: Sequence[str], work: Workspace) -> DataFrame:
    """(key, _n, _known), written: the keys that repeat in the batch (``_n`` rows) and those that are
    stored already. Only key columns are read and moved."""
    counted = incoming.groupBy(*key).agg(F.count("*").alias("_n"))
    stored = existing.select(*key, F.lit(True).alias("_known"))
    return work.stage(counted.join(stored, list(key), "left").where("_n > 1 or _known"), "marked_keys")


def classify(
    incoming: DataFrame,
    existing: DataFrame,
    key: Sequence[str],
    work: Workspace | None = None,
    values_of: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Incoming rows with ``_status``, ``_copies`` and ``_changes``.

    ``existing`` holds each key once; incoming keys are not null. The sum of
    ``_copies`` is the number of incoming rows: identical copies of a skipped
    row are counted, not repeated, while every conflicting row is listed.

    With staging space it goes by keys first. The keys that repeat in the
    batch and those that are stored already are found from the key columns
    alone; both are rare in most batches. All other rows are new without
    having met the stored values, which are read for the known keys only:
    from ``values_of(known keys)``, where the caller can name a smaller part
    of the table for them. The found keys are written, so their true size
    decides how they are joined.
    """
    if work is None:
        return classify_repeated(incoming, existing, key)
    key = list(key)
    marked = marked_keys(incoming, existing, key, work)
    n_repeated, n_known = marked.agg(F.count_if(F.col("_n") > 1), F.count_if(F.col("_known"))).first()
    known, repeated = marked.where("_known").select(*key), marked.where("_n > 1").select(*key)
    alone = incoming.join(repeated, key, "left_anti") if n_repeated else incoming
    if n_known:
        stored = (values_of(known) if values_of else existing).join(known, key, "left_semi")
        parts = [_all_new(alone.join(known, key, "left_anti")), classify_unique(alone.join(known, key, "left_semi"), stored, key)]
    else:
        stored = existing.sparkSession.createDataFrame([], existing.schema)
        parts = [_all_new(alone)]
    if n_repeated:
        parts.append(classify_repeated(incoming.join(repeated, key, "left_semi"), stored, key))
    return reduce(DataFrame.unionByName, parts)


def _all_new(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.lit(NEW).alias(STATUS), F.lit(1).cast("bigint").alias(COPIES), _no_changes().alias(CHANGES))


def new_rows(outcome: DataFrame) -> DataFrame:
    return outcome.filter(F.col(STATUS) == NEW).drop(STATUS, COPIES, CHANGES)


def conflict_reason(outcome: DataFrame, key: Sequence[str]) -> Column:
    """Text of a conflict; texts and times are quoted, numbers are not."""
    plain = (T.NumericType, T.BooleanType)
    quoted = [f.name for f in outcome.schema.fields if not isinstance(f.dataType, plain)]

    def shown(change: Column, side: str) -> Column:
        value = change[side]
        text = F.when(change["field"].isin(*quoted), F.concat(F.lit("'"), value, F.lit("'"))).otherwise(value)
        return F.coalesce(text, F.lit(NO_VALUE))

    pairs = F.transform(
        CHANGES,
        lambda x: F.concat(x["field"], F.lit(": "), shown(x, "current"), F.lit(CHANGE_ARROW), shown(x, "incoming")),
    )
    names = ",".join(key)
    ids = F.concat_ws(",", *[F.col(k).cast("string") for k in key])
    stored = F.format_string(CONFLICT_TEXT, F.lit(names), ids, F.concat_ws(", ", pairs))
    return F.when(F.size(CHANGES) > 0, stored).otherwise(F.format_string(BATCH_TEXT, F.lit(names), ids))


def conflict_log(outcome: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Conflicting rows in the layout of the rejection log."""
    columns = [c for c in outcome.columns if c not in (STATUS, COPIES, CHANGES)]
    return outcome.filter(F.col(STATUS) == CONFLICT).select(
        F.lit(table).alias("table_name"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("raw_row"),
        conflict_reason(outcome, key).alias("reason"),
    )


def status_counts(outcome: DataFrame) -> DataFrame:
    return outcome.groupBy(STATUS).agg(F.sum(COPIES).alias("rows"))
