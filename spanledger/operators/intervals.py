"""Joins of dated facts with validity ranges, without comparing every pair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.operators.ordering import HOT_GROUP_ROWS
from spanledger.schemas import FROM_DATE, TO_DATE
from spanledger.sources.scratch import durable

# A key with up to this many ranges is joined on the key alone, and each pair tested.
PLAIN_RANGES = 100
# Bins are 1, 4, 16, … days wide; a range lies in the bins of the first width that is not shorter than it.
_WIDTH_BITS = 2
_LEVEL, _BIN, _PIECE = "_bin_level", "_bin", "_bin_piece"
_DAY, _FIRST, _LAST, _ROW = "_fact_day", "_range_first", "_range_last", "_fact_row"
N_RANGES = "n_ranges"


def interval_join(
    facts: DataFrame,
    ranges: DataFrame,
    at: str,
    keys: Sequence[str] = (),
    from_col: str = FROM_DATE,
    to_col: str = TO_DATE,
    how: str = "inner",
    plain_ranges: int = PLAIN_RANGES,
    hot_rows: int = HOT_GROUP_ROWS,
    totals: Sequence[str] | None = None,
) -> DataFrame:
    """Every fact with every range of its keys that holds its day, both ends included; all ranges if there are no keys.

    ``left`` keeps facts without a range, with NULLs. Days, ends and keys that are NULL match nothing. The result has the
    facts' columns and those of ``ranges`` that are not keys; other shared names are an error.

    Keys with few ranges are joined on the key. For the others, each range goes into the one or two date bins of the
    width that suits its length, each fact into its bin of every width in use, and the two meet in an equi-join on key
    and bin; a last test of the day leaves only true pairs. A range is never longer than its bins, so a fact meets at
    most eight times the ranges that hold it (when lengths spread evenly), be they days or decades. Open ends are cut at
    the last fact first. Bins with more than ``hot_rows`` facts are cut in pieces, each of which meets all ranges of the
    bin.

    With ``totals``, columns of ``ranges`` that are not keys, each fact comes once, with the number of its ranges in
    ``n_ranges`` and the sums of these columns over them, and no pair is made: each range is cut into the few whole bins
    of 1, 2, 4, … days that it consists of, a bin's ranges are added up, and a day adds up its bins of every width.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    keys = list(keys)
    shared = (set(facts.columns) & {*ranges.columns, *([] if totals is None else [N_RANGES])}) - set(keys)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    if how == "left" and totals is None:
        facts = durable(facts.withColumn(_ROW, F.monotonically_increasing_id()), "interval-facts")
    columns = [*facts.columns, *(c for c in ranges.columns if c not in keys)]
    bounds = facts.agg(F.min(at).cast("date").alias("first"), F.max(at).cast("date").alias("last"), F.count(F.lit(1)).alias("n")).first()
    timed = facts.withColumn(_DAY, F.unix_date(F.col(at).cast("date")))
    cut = ranges.withColumn(_FIRST, F.unix_date(F.greatest(F.col(from_col).cast("date"), F.lit(bounds["first"]))))
    cut = cut.withColumn(_LAST, F.unix_date(F.least(F.col(to_col).cast("date"), F.lit(bounds["last"]))))
    cut = cut.filter(F.col(from_col).isNotNull() & F.col(to_col).isNotNull() & (F.col(_FIRST) <= F.col(_LAST)))
    if totals is not None:
        span = (bounds["last"] - bounds["first"]).days + 1 if bounds["first"] else 1
        found = timed.join(_day_totals(timed, cut, keys, list(totals), span.bit_length()), [*keys, _DAY], how)
        return found.withColumn(N_RANGES, F.coalesce(N_RANGES, F.lit(0))).select(*facts.columns, N_RANGES, *totals)

    parts = []
    if keys:
        many = durable(cut.groupBy(*keys).count().filter(F.col("count") > plain_ranges).select(*keys), "keys-with-many-ranges")
        some = not many.isEmpty()
        few_facts, few = (d.join(many, keys, "left_anti") if some else d for d in (timed, cut))
        parts.append(few_facts.join(few, keys).filter(_holds()).select(*columns))
        if some:
            parts.append(_by_bins(timed.join(many, keys, "left_semi"), cut.join(many, keys, "left_semi"), keys, bounds["n"], hot_rows).select(*columns))
    else:
        parts.append(_by_bins(timed, cut, keys, bounds["n"], hot_rows).select(*columns))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if how == "left":
        found = durable(found, "interval-pairs")
        alone = facts.join(found.select(_ROW).distinct(), _ROW, "left_anti")
        found = found.unionByName(alone, allowMissingColumns=True).drop(_ROW)
    return found


def _holds() -> Column:
    return F.col(_DAY).between(F.col(_FIRST), F.col(_LAST))


def _bin_of(day: Column, level: int) -> Column:
    return F.shiftright(day, _WIDTH_BITS * level)


def _day_totals(facts: DataFrame, ranges: DataFrame, keys: list[str], totals: list[str], n_levels: int) -> DataFrame:
    """Number of ranges and sums of ``totals`` for every key and day of ``facts`` that some range holds; bins of level k are 2^k days."""
    whole, own = [], []
    for k in range(n_levels):
        bin_at = lambda at, k=k: F.struct(F.lit(k).alias(_LEVEL), at.alias(_BIN))
        # From the first bin that lies in the range to the one after the last; odd ends are not in a bin of the next level.
        start, stop = -F.shiftright(-F.col(_FIRST), k), F.shiftright(F.col(_LAST) + 1, k)
        whole += [F.when((start < stop) & (start.bitwiseAND(1) == 1), bin_at(start)), F.when((start < stop) & (stop.bitwiseAND(1) == 1), bin_at(stop - 1))]
        own.append(bin_at(F.shiftright(F.col(_DAY), k)))
    on = [*keys, _LEVEL, _BIN]
    bins = ranges.select(*keys, *totals, F.inline(F.array_compact(F.array(*whole)))).groupBy(*on).agg(
        F.count(F.lit(1)).alias(N_RANGES), *[F.sum(c).alias(c) for c in totals])
    days = facts.select(*keys, _DAY).filter(F.col(_DAY).isNotNull()).distinct().select("*", F.inline(F.array(*own)))
    return days.join(bins, on).groupBy(*keys, _DAY).agg(F.sum(N_RANGES).alias(N_RANGES), *[F.sum(c).alias(c) for c in totals])


def _by_bins(facts: DataFrame, ranges: DataFrame, keys: list[str], n_facts: int, hot_rows: int) -> DataFrame:
    length = F.col(_LAST) - F.col(_FIRST) + 1
    level = sum((F.when(length > (1 << _WIDTH_BITS * k), 1).otherwise(0) for k in range(12)), F.lit(0))
    ranges = durable(ranges.withColumn(_LEVEL, level), "leveled-ranges")
    levels = sorted(r[0] for r in ranges.select(_LEVEL).distinct().collect())  # at most thirteen
    own = F.array(*[F.struct(F.lit(k).alias(_LEVEL), _bin_of(F.col(_DAY), k).alias(_BIN)) for k in levels or [0]])
    spread = facts.filter(F.col(_DAY).isNotNull()).select("*", F.inline(own))
    covered = F.lit(None).cast("array<int>")
    for k in levels:
        covered = F.when(F.col(_LEVEL) == k, F.sequence(_bin_of(F.col(_FIRST), k), _bin_of(F.col(_LAST), k))).otherwise(covered)
    binned = ranges.select("*", F.explode(covered).alias(_BIN))
    on = [*keys, _LEVEL, _BIN]
    if n_facts > hot_rows:
        pieces = durable(
            spread.groupBy(*on).count().filter(F.col("count") > hot_rows)
            .select(*on, F.ceil(F.col("count") / hot_rows).cast("int").alias("_pieces")), "hot-bins")
        if not pieces.isEmpty():
            # A row's source partition is the same when a task is run again, so it falls into the same piece.
            spread = spread.withColumn("_from", F.spark_partition_id()).join(pieces, on, "left")
            draw = F.pmod(F.xxhash64("_from", *[F.col(c) for c in facts.columns]), F.coalesce("_pieces", F.lit(1)))
            spread = spread.withColumn(_PIECE, draw.cast("int")).drop("_pieces", "_from")
            each = F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
            binned = binned.join(pieces, on, "left").withColumn(_PIECE, each).drop("_pieces")
            on = [*on, _PIECE]
    return spread.join(binned, on).filter(_holds())
