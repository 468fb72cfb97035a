"""Foreign-key checks and consecutive positions over a global order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace, broadcast_if_small, fits_broadcast, has_shuffle
from .contract import REASONS, ForeignKey

# The wording of the foreign-key reasons.
FK_PREFIX = "FK Violation: "
FK_NOT_IN = " not in "


def orphan_values(child: DataFrame, column: str, parent: DataFrame, parent_column: str = "id") -> DataFrame:
    """Child key values without a parent, each with its number of rows.

    The child is reduced to its distinct keys before anything is shuffled, so
    a key that holds a third of all rows costs one row per task. Null keys are
    not orphans.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    ids = parent.select(F.col(parent_column).alias("_parent_key"))
    return used.join(ids, F.col(column) == F.col("_parent_key"), "left_anti")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str = "id") -> DataFrame:
    """Child rows whose key has no parent."""
    ids = parent.select(F.col(parent_column).alias("_parent_key")).distinct()
    known = F.col(column) == F.col("_parent_key")
    return child.filter(F.col(column).isNotNull()).join(broadcast_if_small(ids), known, "left_anti")


def _violation(fk: ForeignKey, missing: Column) -> Column:
    text = F.concat(
        F.lit(f"{fk.column} "), F.col(fk.column).cast("string"), F.lit(FK_NOT_IN + fk.parent_label)
    )
    return F.when(missing & F.col(fk.column).isNotNull(), text)


def _flag_missing(df: DataFrame, fk: ForeignKey, parent: DataFrame, flag: str, work: Workspace | None) -> DataFrame:
    ids = parent.select(F.col(fk.parent_column).alias("_fk")).filter(F.col("_fk").isNotNull()).distinct()
    if work is None:
        # No staging space: one join on the keys, whose sides the optimizer
        # chooses; skewed join partitions are split at run time.
        joined = df.join(ids.withColumn(flag, F.lit(True)), F.col(fk.column) == F.col("_fk"), "left").drop("_fk")
        return joined.withColumn(flag, F.col(flag).isNull())
    # The parent's keys are worked out once, and measured where they were written.
    ids = work.stage(ids, f"parents_{fk.column}")
    if fits_broadcast(ids):
        known = F.broadcast(ids).withColumn(flag, F.lit(True))
        joined = df.join(known, F.col(fk.column) == F.col("_fk"), "left").drop("_fk")
        return joined.withColumn(flag, F.col(flag).isNull())
    # Too many parents to broadcast: find the orphan values first. They are
    # written, so the join with the wide rows knows their true size.
    used = df.filter(F.col(fk.column).isNotNull()).groupBy(fk.column).agg(F.count("*").alias("rows"))
    values = used.join(ids, F.col(fk.column) == F.col("_fk"), "left_anti").select(F.col(fk.column).alias("_fk"))
    staged = work.stage(values, f"orphans_{fk.column}")
    missing = broadcast_if_small(staged).withColumn(flag, F.lit(True))
    joined = df.join(missing, F.col(fk.column) == F.col("_fk"), "left").drop("_fk")
    return joined.withColumn(flag, F.col(flag).isNotNull())


def annotate_fk(
    annotated: DataFrame,
    foreign_keys: Sequence[ForeignKey],
    parents: Mapping[str, DataFrame],
    work: Workspace | None = None,
) -> DataFrame:
    """Add one reason per row listing every key that has no parent.

    Works on contract-annotated frames; rows that were already rejected keep
    their reasons and are not checked again.
    """
    source = annotated.columns
    texts = []
    for i, fk in enumerate(foreign_keys):
        flag = f"_missing_{i}"
        annotated = _flag_missing(annotated, fk, parents[fk.parent], flag, work)
        texts.append(_violation(fk, F.col(flag)))
    listed = F.array_compact(F.array(*texts))
    bad = (F.size(REASONS) == 0) & (F.size(listed) > 0)
    reason = F.array(F.concat(F.lit(FK_PREFIX), F.concat_ws("; ", listed)))
    return annotated.withColumn(REASONS, F.when(bad, reason).otherwise(F.col(REASONS))).select(*source)


# --- positions over a global order ------------------------------------------

_ROW = "_row_tag"
_PART_BITS = 33  # monotonically_increasing_id: partition above, row below
_PART_MASK = (1 << _PART_BITS) - 1


def ordered_parts(df: DataFrame, order: Sequence[str], work: Workspace, name: str) -> DataFrame:
    """Write ``df`` in global order, each row tagged with (range part, row in it).

    The row tag of the source breaks ties, so rows with equal order values
    still spread over several range parts. The tags must come out the same
    when a task is repeated: rows that were shuffled before are written first.
    Writing the result fixes the range bounds for all later steps.
    """
    source = work.stage(df, f"{name}_input") if has_shuffle(df) else df
    tagged = source.withColumn("_tie", F.monotonically_increasing_id())
    sorted_parts = (
        tagged.repartitionByRange(*order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn(_ROW, F.monotonically_increasing_id())
    )
    staged = work.stage(sorted_parts, name)
    return staged.select(
        *df.columns,
        F.shiftright(F.col(_ROW), _PART_BITS).alias("_part"),
        F.col(_ROW).bitwiseAND(F.lit(_PART_MASK)).alias("_pos"),
    )


def part_offsets(parts: DataFrame, weight: Column) -> DataFrame:
    """Total weight before each part; one row per range part."""
    totals = parts.groupBy("_part").agg(F.sum(weight).alias("_total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))


def consecutive_key(
    df: DataFrame,
    order: Sequence[str],
    key_column: str = "id",
    start: int = 1,
    work: Workspace | None = None,
) -> DataFrame:
    """Consecutive keys in a given order without a single-partition sort.

    One range shuffle writes the ordered rows; the per-part row counts (one
    row per shuffle partition) give each part its offset.
    """
    work = work or Workspace(df.sparkSession, "keys")
    parts = ordered_parts(df, order, work, "ordered")
    offsets = F.broadcast(part_offsets(parts, F.lit(1)))  # bounded by the number of parts
    numbered = parts.join(offsets, "_part")
    position = F.col("_offset") + F.col("_pos") + F.lit(start)
    return numbered.select(*df.columns, position.cast("bigint").alias(key_column))


def spread_key(df: DataFrame, key_column: str = "id", start: int = 1) -> DataFrame:
    """Unique, increasing but not consecutive keys; no shuffle at all.

    The keys follow the partitions of this evaluation: write them once before
    anything refers to them.
    """
    return df.withColumn(key_column, F.monotonically_increasing_id() + F.lit(start))
