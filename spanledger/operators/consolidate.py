"""Staging casts and merging of fragmented validity ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions.compare import all_of
from spanledger.functions.dates import TimeLike, date_lit, ts_lit
from spanledger.functions.keys import joined_key
from spanledger.operators.ordering import hot_keys, same_key
from spanledger.schemas import CONTRACT_KEY, FROM_DATE, GROUPING_COLUMNS, OPEN_END, TO_DATE
from spanledger.sources.scratch import durable


# Groups up to this many rows are gathered whole; each range looks through it once.
SMALL_GROUP_ROWS = 100
# Most keys of larger groups that are handed to all executors to split the rows by, and their most bytes.
LISTED_GROUPS = 100_000
LISTED_BYTES = 32 << 20


def stage_contracts(
    raw: DataFrame, run_ts: TimeLike, amount_type: str = "decimal(38,9)", open_end: str = OPEN_END
) -> DataFrame:
    """Typed staging columns; the open end is recognised by its text form first."""
    to_text = F.col(TO_DATE).cast("string")
    return raw.select(
        "contract_id",
        "territory_id",
        "external_contract_id",
        F.col("amount").cast(amount_type).alias("amount"),
        F.col("interest_date").cast("date").alias("interest_date"),
        F.col(FROM_DATE).cast("date").alias(FROM_DATE),
        F.when(to_text == open_end, date_lit(open_end)).otherwise(F.col(TO_DATE).cast("date")).alias(TO_DATE),
        ts_lit(run_ts).alias("loaded_at"),
    )


def consolidate_ranges(
    df: DataFrame,
    keys: Sequence[str] = tuple(GROUPING_COLUMNS),
    from_col: str = FROM_DATE,
    to_col: str = TO_DATE,
    open_end: str = OPEN_END,
    mode: str = "all_or_nothing",
    small_group_rows: int = SMALL_GROUP_ROWS,
    listed_groups: int = LISTED_GROUPS,
) -> DataFrame:
    """Merge closed day ranges of rows that agree on ``keys``.

    ``all_or_nothing``: a group becomes one row spanning it when each of its
    ranges is open-ended, or abuts the start of another one, or has no later
    start behind it; otherwise its rows are kept as they are. This misses some
    contiguous sets, e.g. an overlap followed by a later range.
    ``original_record_count`` is the size of the group.

    ``islands``: every maximal gap-free run becomes one row;
    ``original_record_count`` is the number of rows merged into it.

    Groups up to ``small_group_rows`` rows are decided on their gathered ranges,
    larger ones without gathering. With more than ``listed_groups`` larger ones no
    group is gathered. The result is the same.
    """
    keys = list(keys)
    if mode == "all_or_nothing":
        return _all_or_nothing(df, keys, from_col, to_col, open_end, small_group_rows, listed_groups)
    if mode == "islands":
        return _islands(df, keys, from_col, to_col)
    raise ValueError(f"unknown consolidation mode: {mode!r}")


def _all_or_nothing(
    df: DataFrame, keys: list[str], from_col: str, to_col: str, open_end: str, small_group_rows: int,
    listed_groups: int,
) -> DataFrame:
    """Small groups in one shuffle, large ones by calendar marks.

    Counting rows per group first combines map-side and is cheap next to moving
    the rows. Without large groups, each row is then shuffled once.
    """
    large = durable(hot_keys(df, keys, small_group_rows), "large-groups")
    key_bytes = F.sum(F.octet_length(F.to_json(F.struct(*keys))))
    n_large, n_bytes = large.agg(F.count(F.lit(1)), F.coalesce(key_bytes, F.lit(0))).first()
    if n_large == 0:
        return _from_arrays(df, keys, from_col, to_col, open_end)
    if n_large > listed_groups or n_bytes > LISTED_BYTES:
        return _from_marks(df, keys, from_col, to_col, open_end)
    listed, in_large = F.broadcast(large), same_key(df, large, keys)
    return _from_arrays(df.join(listed, in_large, "left_anti"), keys, from_col, to_col, open_end).unionByName(
        _from_marks(df.join(listed, in_large, "left_semi"), keys, from_col, to_col, open_end))


def _from_arrays(df: DataFrame, keys: list[str], from_col: str, to_col: str, open_end: str) -> DataFrame:
    """Decide on each group's gathered ranges, whose number is bounded."""
    ranges = F.collect_list(F.struct(F.col(from_col).alias("f"), F.col(to_col).alias("t")))
    groups = df.groupBy(*keys).agg(ranges.alias("_ranges")).withColumn(
        "_starts", F.transform("_ranges", lambda r: r["f"])).withColumn("_last_start", F.array_max("_starts"))
    fine = F.forall("_ranges", lambda r: r["f"].isNotNull() & (
        (r["t"] == date_lit(open_end)) | (r["t"] >= F.col("_last_start"))
        | F.array_contains("_starts", F.date_add(r["t"], 1))))
    whole = F.array(F.struct(
        F.array_min("_starts").alias("f"), F.array_max(F.transform("_ranges", lambda r: r["t"])).alias("t")))
    # A missing date makes the test false or NULL: the group is kept as it is.
    judged = groups.withColumn("_can", F.coalesce(fine, F.lit(False)))
    return judged.select(
        *keys,
        F.inline(F.when(F.col("_can"), whole).otherwise(F.col("_ranges"))).alias(from_col, to_col),
        F.col("_can").alias("was_consolidated"),
        F.size("_ranges").cast("bigint").alias("original_record_count"),
    )


def _from_marks(df: DataFrame, keys: list[str], from_col: str, to_col: str, open_end: str) -> DataFrame:
    """Decide per group from calendar-day facts instead of gathered range lists.

    Each range leaves two marks: its first day, and the day after its last one.
    A range abuts another one exactly when its end mark falls on some start mark,
    so grouping the marks by (keys, day) answers the question for all ranges at
    once. The group merges unless the earliest unmatched end precedes the latest
    start. Both aggregations combine map-side; a hot group is spread by day.
    """
    start, end = F.col(from_col), F.col(to_col)
    marks = df.select(
        *keys,
        F.inline(F.array(
            F.struct(start.alias("_day"), F.lit(True).alias("_is_start"), end.alias("_to")),
            F.struct(F.when(end != date_lit(open_end), F.date_add(end, 1)).alias("_day"),
                     F.lit(False).alias("_is_start"), F.lit(None).cast("date").alias("_to")),
        )),
    ).filter(F.col("_is_start") | F.col("_day").isNotNull())
    days = marks.groupBy(*keys, "_day").agg(
        F.count_if("_is_start").alias("_starts"),
        F.bool_or(~F.col("_is_start")).alias("_ends"),
        F.max("_to").alias("_to"),
        F.bool_or(F.col("_is_start") & (F.col("_day").isNull() | F.col("_to").isNull())).alias("_undated"),
    )
    has_start = F.col("_starts") > 0
    groups = days.groupBy(*keys).agg(
        F.min(F.when(has_start, F.col("_day"))).alias("_min_from"),
        F.max(F.when(has_start, F.col("_day"))).alias("_max_from"),
        F.max("_to").alias("_max_to"),
        F.min(F.when(F.col("_ends") & ~has_start, F.date_sub("_day", 1))).alias("_first_loose_end"),
        F.sum("_starts").cast("bigint").alias("_rows"),
        F.bool_or("_undated").alias("_undated"),
    )
    can = ~F.col("_undated") & F.coalesce(F.col("_first_loose_end") >= F.col("_max_from"), F.lit(True))
    groups = groups.withColumn("_can", can)

    def output(source: DataFrame, row_from: Column, row_to: Column) -> DataFrame:
        # Both branches ask for the same group columns, so they share one shuffle.
        return source.select(
            *keys,
            F.when(F.col("_can"), F.col("_min_from")).otherwise(row_from).alias(from_col),
            F.when(F.col("_can"), F.col("_max_to")).otherwise(row_to).alias(to_col),
            F.col("_can").alias("was_consolidated"),
            F.col("_rows").alias("original_record_count"),
        )

    nothing = F.lit(None).cast("date")
    merged = output(groups.filter("_can"), nothing, nothing)
    # Many rows meet one group; AQE splits the rows' side when a group is hot.
    rows = df.select(*[F.col(k).alias(f"_row_{k}") for k in keys], start.alias("_row_from"), end.alias("_row_to"))
    same_group = all_of([F.col(k).eqNullSafe(F.col(f"_row_{k}")) for k in keys])
    kept = output(groups.filter(~F.col("_can")).join(rows, same_group), F.col("_row_from"), F.col("_row_to"))
    return merged.unionByName(kept)


def _islands(df: DataFrame, keys: list[str], from_col: str, to_col: str) -> DataFrame:
    # Ranges starting on one day merge before the window, so a group in the
    # window has at most one row per calendar day, whatever its row count.
    by_start = df.groupBy(*keys, from_col).agg(F.max(to_col).alias(to_col), F.count("*").alias("_rows"))
    ordered = Window.partitionBy(*keys).orderBy(from_col)
    reach = F.max(to_col).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens_island = F.coalesce(F.col(from_col) > F.date_add(reach, 1), F.lit(True))
    marked = by_start.withColumn("_opens", opens_island.cast("int"))
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = marked.withColumn("_island", F.sum("_opens").over(running))
    return (
        numbered.groupBy(*keys, "_island")
        .agg(F.min(from_col).alias(from_col), F.max(to_col).alias(to_col),
             F.sum("_rows").cast("bigint").alias("original_record_count"))
        .select(*keys, from_col, to_col, (F.col("original_record_count") > 1).alias("was_consolidated"),
                "original_record_count")
    )


def consolidate_contracts(staged: DataFrame, run_ts: TimeLike, mode: str = "all_or_nothing") -> DataFrame:
    """The consolidated contract model, stamped with the processing time."""
    return consolidate_ranges(staged, mode=mode).withColumn("processed_at", ts_lit(run_ts))


def consolidation_impact(before: DataFrame, after: DataFrame, keys: Sequence[str] = tuple(CONTRACT_KEY)) -> DataFrame:
    """One row comparing record counts before and after consolidation."""
    text = joined_key(*keys)
    both = before.select(F.lit(True).alias("_before"), text.alias("_key"), F.lit(False).alias("_merged")).unionByName(
        after.select(F.lit(False).alias("_before"), text.alias("_key"), F.col("was_consolidated").alias("_merged")))
    was_before = F.col("_before")
    # One row per key first: it combines map-side and needs no distinct expansion.
    per_key = both.groupBy("_key").agg(
        F.count_if(was_before).alias("_b"), F.count_if(~was_before).alias("_a"), F.count_if("_merged").alias("_m"))
    has_key = F.col("_key").isNotNull()
    counts = per_key.agg(
        F.coalesce(F.sum("_b"), F.lit(0)).alias("before_record_count"),
        F.coalesce(F.sum("_a"), F.lit(0)).alias("after_record_count"),
        F.count_if(has_key & (F.col("_b") > 0)).alias("before_unique_contracts"),
        F.count_if(has_key & (F.col("_a") > 0)).alias("after_unique_contracts"),
        F.coalesce(F.sum("_m"), F.lit(0)).alias("consolidated_contract_count"),
    )
    reduced = F.col("before_record_count") - F.col("after_record_count")
    share = F.when(F.col("before_record_count") > 0, F.lit(100.0) * reduced / F.col("before_record_count"))
    return counts.select(
        "before_record_count",
        "after_record_count",
        reduced.alias("records_reduced"),
        F.round(share, 2).alias("percent_reduction"),
        "consolidated_contract_count",
        "before_unique_contracts",
        "after_unique_contracts",
    )
