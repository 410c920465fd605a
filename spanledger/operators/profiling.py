"""Column profiles, quantiles, outliers, correlation and skewness."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.functions.compare import any_of
from spanledger.operators.gram import gram_correlation
from spanledger.sources.scratch import durable

QUARTILES = (0.25, 0.5, 0.75)
BOUNDARIES = (0.0, *QUARTILES, 1.0)
SKETCH_ACCURACY = 10_000
BRACKET_SKETCH = 4096  # items a KLL sketch keeps on a level; its rank error is near 0.13 %
BRACKET_MARGIN = 0.005  # share of the rows on either side of a wanted rank
BRACKET_LEAST = 10_000  # values from which brackets pay
WIDE_COLUMNS = 100  # columns of one aggregate pass
WIDE_PAIRS = 500  # column pairs up to which an aggregate pass is used
_WITH_EXTREMES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _ref(name: str) -> Column:
    return F.col(f"`{name}`")


# Text that is a number; codes such as 10F or 12D, which Java reads as numbers,
# are not. A failing cast costs an exception inside
# the JVM, so text that cannot succeed is turned to NULL by this cheap test first.
_BESIDE_DIGITS = ["", ".", "-", "+", "-.", "+."]  # what plain numbers hold besides digits
_NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"


def as_double(df: DataFrame, name: str) -> Column:
    """Numeric reading of a column; NULL where text is no number."""
    value = _ref(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        plain = F.translate(value, "0123456789", "").isin(*_BESIDE_DIGITS)  # several times as fast as the pattern
        return F.when(plain | value.rlike(_NUMBER_TEXT), value.try_cast("double"))
    return value.try_cast("double")


def with_numbers(df: DataFrame, columns: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """The columns read as numbers once, so that several aggregates share the work."""
    return df.select(*[_ref(c) for c in carry], *[as_double(df, c).alias(c) for c in columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def castable_columns(df: DataFrame) -> list[str]:
    ok = (T.NumericType, T.StringType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, ok)]


def _column_chunks(columns: Sequence[str], size: int | None) -> list[list[str]]:
    step = size or max(len(columns), 1)
    return [list(columns[i: i + step]) for i in range(0, len(columns), step)]


def profile_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    stats: bool = False,
    distinct: str = "exact",
    quantiles: str = "approx",
    chunk: int | None = 4,
    found: DataFrame | None = None,
) -> DataFrame:
    """One row per column: type, counts, extremes and, with ``stats``, moments.

    With ``stats`` text columns have extremes too, in byte order, and every column
    that reads as numbers has those of the numbers (``min_number``, ``max_number``).
    Counts, extremes, moments and sketches come from one aggregate pass for each
    ``WIDE_COLUMNS`` columns. Exact distinct counts are kept apart from it: Spark repeats each row once
    per distinct column of an aggregate, with all of them in the key. So ``chunk``
    columns share one such aggregate, which on a columnar table reads just these
    columns; ``chunk=None`` reads a costly derived input once. With
    ``distinct="approx"`` fixed-size sketches in the first pass replace all that.
    Quartiles come from a sketch (rank error 1/10,000) or, with
    ``quantiles="exact"``, from :func:`exact_quantiles`, or from ``found`` where
    such a result exists already.
    """
    if distinct not in ("exact", "approx") or quantiles not in ("exact", "approx"):
        raise ValueError("distinct and quantiles must be 'exact' or 'approx'")
    names = list(columns or df.columns)
    castable = [c for c in names if c in castable_columns(df)]
    exact_quartiles = stats and quantiles == "exact" and bool(castable)
    # Extremes of text keep an aggregate out of generated code, so text columns have passes of their own.
    text = [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]
    apart = [c for c in names if c not in text]
    out = reduce(lambda x, y: x.unionByName(y), [
        _column_facts(df, some, stats, distinct == "approx", stats and not exact_quartiles)
        for kind in (text, apart) for some in (_column_chunks(kind, WIDE_COLUMNS) if kind else [])])
    # One row per column on either side of these joins.
    if distinct == "exact":
        out = out.join(F.broadcast(_distinct_counts(df, names, chunk)), "column_name")
    if exact_quartiles:
        out = out.join(F.broadcast(quartile_columns(df, castable, found=found)), "column_name", "left")
    shown = ["column_name", "data_type", "total_count", "distinct_count", "null_count", "min_value", "max_value"]
    picked = [F.col(c) for c in shown]
    if stats:
        picked += [F.col("min_number"), F.col("max_number"), F.col("avg_value"), F.col("stddev_value"), F.col("q2").alias("median_value"),
                   F.col("q1"), F.col("q2"), F.col("q3")]
    return out.select(*picked).orderBy("column_name")


def _distinct_counts(df: DataFrame, names: Sequence[str], chunk: int | None) -> DataFrame:
    parts = []
    for some in _column_chunks(names, chunk):
        counts = df.agg(*[F.count_distinct(_ref(c)).alias(f"d{i}") for i, c in enumerate(some)])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"d{i}").alias("distinct_count"))
            for i, c in enumerate(some)]))))
    return reduce(lambda x, y: x.unionByName(y), parts)


def _column_facts(
    df: DataFrame, names: list[str], stats: bool, sketch_distinct: bool, sketch_quartiles: bool
) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    castable = [c for c in names if c in castable_columns(df)] if stats else []
    numbers = {c: f"_number_{i}" for i, c in enumerate(castable)}
    if numbers:
        df = df.select(*[_ref(c) for c in names], *[as_double(df, c).alias(n) for c, n in numbers.items()])
    aggregates: list[Column] = [F.count("*").alias("total")]
    rows: list[Column] = []

    def measured(aggregate: Column, alias: str) -> Column:
        aggregates.append(aggregate.alias(alias))
        return F.col(alias)

    for i, name in enumerate(names):
        value, number = _ref(name), numbers.get(name)
        cells = {
            "column_name": F.lit(name),
            "data_type": F.lit(types[name].simpleString()),
            "total_count": F.col("total"),
            "null_count": F.col("total") - measured(F.count(value), f"v{i}"),
            "min_value": F.lit(None).cast("string"),
            "max_value": F.lit(None).cast("string"),
        }
        if isinstance(types[name], _WITH_EXTREMES) or stats and isinstance(types[name], T.StringType):
            cells["min_value"] = measured(F.min(value).cast("string"), f"lo{i}")
            cells["max_value"] = measured(F.max(value).cast("string"), f"hi{i}")
        if sketch_distinct:
            cells["distinct_count"] = measured(F.approx_count_distinct(value), f"d{i}")
        if stats:
            cells |= dict.fromkeys(("min_number", "max_number", "avg_value", "stddev_value"), F.lit(None).cast("double"))
            if number:
                cells["min_number"] = measured(F.min(number), f"ln{i}")
                cells["max_number"] = measured(F.max(number), f"hn{i}")
                cells["avg_value"] = measured(F.avg(number), f"a{i}")
                cells["stddev_value"] = measured(F.stddev_samp(number), f"s{i}")
        if sketch_quartiles:
            sketch = F.lit(None).cast("array<double>")
            if number:
                sketch = measured(F.percentile_approx(number, list(QUARTILES), SKETCH_ACCURACY), f"q{i}")
            cells |= {f"q{j + 1}": sketch[j] for j in range(len(QUARTILES))}
        rows.append(F.struct(*[c.alias(k) for k, c in cells.items()]))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


class _Bracket(NamedTuple):
    """Values of a column between two bounds (None: no bound) and the ranks sought among them."""

    column: str
    low: float | None
    high: float | None
    probabilities: tuple[float, ...]

    @property
    def settled(self) -> bool:
        return self.low is not None and self.low == self.high


def _sketched_brackets(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> tuple[list[_Bracket], dict[str, int]]:
    """Bounds that a wanted rank lies between by the error of a sketch, and the number of values per column.

    Columns of few values have no bounds; the extremes are their own. NaN counts as the
    largest value, which only a bracket without an upper bound holds.
    """
    edges = F.array(*[F.lit(min(max(p + side, 0.0), 1.0)) for p in probabilities for side in (-BRACKET_MARGIN, BRACKET_MARGIN)])
    measures = [x for i, c in enumerate(columns) for x in (
        F.count(_ref(c)).alias(f"n{i}"), F.min(_ref(c)).alias(f"lo{i}"), F.max(_ref(c)).alias(f"hi{i}"),
        F.kll_sketch_agg_double(F.nanvl(_ref(c), F.lit(math.inf)), BRACKET_SKETCH).alias(f"s{i}"))]
    sketched = with_numbers(df, columns).agg(*measures)
    row = sketched.select(*[x for i in range(len(columns)) for x in (
        f"n{i}", f"lo{i}", f"hi{i}", F.when(F.col(f"n{i}") >= BRACKET_LEAST, F.kll_sketch_get_quantile_double(f"s{i}", edges)).alias(f"q{i}"))]
    ).first()
    totals = {c: row[f"n{i}"] for i, c in enumerate(columns) if row[f"n{i}"]}
    brackets: dict[tuple, list[float]] = {}
    for i, c in enumerate(columns):
        for j, p in enumerate(probabilities if c in totals else ()):
            low, high = row[f"q{i}"][2 * j: 2 * j + 2] if row[f"q{i}"] else (None, None)
            if p in (0.0, 1.0):
                low = high = row[f"lo{i}" if p == 0.0 else f"hi{i}"]
            low = None if 0.0 < p <= BRACKET_MARGIN else low
            high = None if 1 - BRACKET_MARGIN <= p < 1.0 or high == math.inf else high
            brackets.setdefault((c, low, high), []).append(p)
    return [_Bracket(*bounds, tuple(ps)) for bounds, ps in brackets.items()], totals


def _sides(p: float, total: int) -> tuple[tuple[str, int, float], tuple[str, int, float]]:
    """The two ranks (from 0) that a quantile lies between, and its share of the way."""
    position = p * (total - 1)
    share = position - math.floor(position)
    return ("lower", math.floor(position), share), ("upper", math.ceil(position), share)


def _placed_brackets(df: DataFrame, brackets: list[_Bracket], totals: dict[str, int]) -> list[tuple[_Bracket, int]]:
    """Each bracket with the number of values below it; one that misses its ranks loses its bounds."""
    columns = list(dict.fromkeys(b.column for b in brackets))
    counts = []
    for i, b in enumerate(brackets):
        below = F.lit(False) if b.low is None else _ref(b.column) < b.low
        upto = _ref(b.column).isNotNull() if b.high is None else _ref(b.column) <= b.high
        counts += [F.count_if(below).alias(f"b{i}"), F.count_if(upto).alias(f"u{i}")]
    row = with_numbers(df, columns).agg(*counts).first()
    out = []
    for i, b in enumerate(brackets):
        ranks = [rank for p in b.probabilities for _, rank, _ in _sides(p, totals[b.column])]
        holds = row[f"b{i}"] <= min(ranks) and max(ranks) < row[f"u{i}"]
        out.append((b, row[f"b{i}"]) if holds else (b._replace(low=None, high=None), 0))
    return out


def _within(b: _Bracket) -> Column:
    inside = _ref(b.column).isNotNull()
    if b.low is not None:
        inside &= _ref(b.column) >= b.low
    return inside if b.high is None else inside & (_ref(b.column) <= b.high)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(column_name, probability, value) with linear interpolation between ranks.

    A sketch brackets each wanted rank within a hundredth of the rows. A second scan
    counts the values below and up to the brackets. Brackets of a single value are
    settled by that. A third scan keeps the values inside the others, and only these
    are shuffled: equal ones are counted together, range-partitioned and stored with
    their partition number; partition totals tell which partition holds a wanted rank,
    and only that one is looked into. ``df`` is read up to three times when this is
    called and must give the same rows each time.
    """
    probabilities = list(dict.fromkeys(float(p) for p in probabilities))
    parts = [_exact_quantiles(df, some, probabilities) for some in _column_chunks(columns, WIDE_COLUMNS)]
    return reduce(lambda x, y: x.unionByName(y), parts)


def _exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    spark = df.sparkSession
    brackets, totals = _sketched_brackets(df, columns, probabilities)
    if not brackets:
        return spark.createDataFrame([], "column_name string, probability double, value double")
    all_placed = _placed_brackets(df, brackets, totals)
    settled = spark.createDataFrame(
        [(b.column, p, float(b.low)) for b, _ in all_placed if b.settled for p in b.probabilities],
        "column_name string, probability double, value double")
    placed_brackets = [(b, below) for b, below in all_placed if not b.settled]
    if not placed_brackets:
        return settled
    # At most two rows for each column and probability.
    ranks = spark.createDataFrame(
        [(i, b.column, p, side, rank - below, share) for i, (b, below) in enumerate(placed_brackets)
         for p in b.probabilities for side, rank, share in _sides(p, totals[b.column])],
        "_bracket int, column_name string, probability double, _side string, _rank bigint, _share double")
    inside = [_within(b) for b, _ in placed_brackets]
    values = F.array(*[
        F.struct(F.lit(i).alias("_bracket"), F.when(ok, _ref(b.column)).alias("value"))
        for i, ((b, _), ok) in enumerate(zip(placed_brackets, inside))])
    read = list(dict.fromkeys(b.column for b, _ in placed_brackets))
    kept = with_numbers(df, read).select(F.inline(values)).filter("value is not null")
    counted = kept.groupBy("_bracket", "value").agg(F.count("*").alias("_n"))
    order = ["_bracket", "value"]
    placed = durable(
        counted.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_block", F.spark_partition_id()), "quantiles")

    # At most brackets x partitions rows from here to `wanted`.
    blocks = placed.groupBy("_bracket", "_block").agg(F.sum("_n").alias("_rows"))
    earlier = Window.partitionBy("_bracket").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    wanted = blocks.join(F.broadcast(ranks), "_bracket").filter(
        (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_rows")))

    looked_into = F.broadcast(wanted.select("_bracket", "_block", "_before").distinct())
    until = Window.partitionBy("_bracket", "_block").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    reached = placed.join(looked_into, ["_bracket", "_block"]).withColumn(
        "_until", F.col("_before") + F.sum("_n").over(until))
    hits = reached.drop("_before").join(F.broadcast(wanted), ["_bracket", "_block"]).filter(
        (F.col("_rank") < F.col("_until")) & (F.col("_rank") >= F.col("_until") - F.col("_n")))
    sides = hits.groupBy("column_name", "probability").agg(
        F.max(F.when(F.col("_side") == "lower", F.col("value"))).alias("_lower"),
        F.max(F.when(F.col("_side") == "upper", F.col("value"))).alias("_upper"),
        F.max("_share").alias("_share"),
    )
    value = F.col("_lower") + (F.col("_upper") - F.col("_lower")) * F.col("_share")
    return settled.unionByName(sides.select("column_name", "probability", value.alias("value")))


def sketch_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """The same shape from one scan with a bounded sketch per column."""
    probs = [float(p) for p in probabilities]
    sketches = with_numbers(df, columns).agg(*[
        F.percentile_approx(_ref(c), probs, SKETCH_ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("probability"), F.col(f"q{i}")[j].alias("value"))
        for i, c in enumerate(columns) for j, p in enumerate(probs)
    ]
    return sketches.select(F.inline(F.array(*rows))).filter(F.col("value").isNotNull())


def _quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], quantiles: str, found: DataFrame | None
) -> DataFrame:
    """The wanted part of ``found``, or a new result of the given kind."""
    if found is not None:
        return found.filter(F.col("column_name").isin(list(columns)) & F.col("probability").isin(list(probabilities)))
    return (exact_quantiles if quantiles == "exact" else sketch_quantiles)(df, columns, probabilities)


def quartile_boundaries(
    df: DataFrame, columns: Sequence[str], quantiles: str = "approx", found: DataFrame | None = None
) -> DataFrame:
    """(column_name, quartiles): the five boundaries from minimum to maximum."""
    long = _quantiles(df, columns, BOUNDARIES, quantiles, found)
    # Five entries per column.
    ordered = F.array_sort(F.collect_list(F.struct("probability", "value")))
    return long.groupBy("column_name").agg(F.transform(ordered, lambda x: x["value"]).alias("quartiles"))


def quartile_columns(
    df: DataFrame, columns: Sequence[str], quantiles: str = "exact", found: DataFrame | None = None
) -> DataFrame:
    """(column_name, q1, q2, q3): one row per column that has values."""
    long = _quantiles(df, columns, QUARTILES, quantiles, found)
    return long.groupBy("column_name").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("value"))).alias(f"q{i + 1}") for i, p in enumerate(QUARTILES)])


def iqr_outliers(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    carry: Sequence[str] = (),
    quantiles: str = "approx",
    found: DataFrame | None = None,
) -> DataFrame:
    """Every value outside [Q1 - k IQR, Q3 + k IQR], with its row's ``carry`` columns.

    The bounds are one small map (an entry per column) held as a scalar. Rows are
    tested in place, and only those with an outlier are turned into output rows.
    """
    quartiles = quartile_columns(df, columns, quantiles, found)
    spread = F.lit(float(k)) * (F.col("q3") - F.col("q1"))
    bound = F.struct((F.col("q1") - spread).alias("lower_bound"), (F.col("q3") + spread).alias("upper_bound"))
    entries = F.map_from_entries(F.collect_list(F.struct("column_name", bound)))
    bounds = quartiles.agg(entries.alias("bounds")).scalar()

    def outside(value: Column, low: Column, high: Column) -> Column:
        return (value < low) | (value > high)

    limits = {c: (bounds[c]["lower_bound"], bounds[c]["upper_bound"]) for c in columns}
    numbers = with_numbers(df, columns, carry)
    with_any = numbers.filter(any_of([outside(_ref(c), *limits[c]) for c in columns]))
    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), _ref(c).alias("value"),
                 limits[c][0].alias("lower_bound"), limits[c][1].alias("upper_bound"))
        for c in columns
    ])
    listed = with_any.select(*carry, F.inline(cells))
    return listed.filter(outside(F.col("value"), F.col("lower_bound"), F.col("upper_bound")))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each column pair over rows where both are present.

    NULL where no row has both or one of them is constant there. Up to ``WIDE_PAIRS`` pairs are one aggregate pass; more
    are taken from Gram matrices, one scan for up to 1,000 columns (see ``gram``).
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    numbers = with_numbers(df, columns)
    if len(pairs) > WIDE_PAIRS:
        return gram_correlation(numbers, columns)

    def score(a: str, b: str) -> Column:
        # Not corr(): on a constant column it fails in ANSI mode, or gives a number made of rounding errors.
        x, y = F.when(_ref(b).isNotNull(), _ref(a)), F.when(_ref(a).isNotNull(), _ref(b))
        vary = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
        return F.when(vary, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))

    scores = numbers.agg(*[score(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return scores.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("col1"), F.lit(b).alias("col2"), F.col(f"c{i}").alias("correlation_score"))
        for i, (a, b) in enumerate(pairs)])))


def _log_plus_one(number: Column) -> Column:
    """ln(x + 1), NULL where x <= -1."""
    return F.ln(number + 1)


def log_transform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row-level ``<column>_log`` values next to the given columns."""
    return df.withColumns({f"{c}_log": _log_plus_one(as_double(df, c)) for c in columns})


def skewness_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: count and skewness before and after the log transform."""
    aggregates: list[Column] = [F.count("*").alias("total_records")]
    rows: list[Column] = []
    for i, c in enumerate(columns):
        aggregates += [F.skewness(_ref(c)).alias(f"x{i}"), F.skewness(_log_plus_one(_ref(c))).alias(f"l{i}")]
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.col("total_records"), F.col(f"x{i}").alias("skewness"),
            F.col(f"l{i}").alias("log_skewness")))
    return with_numbers(df, columns).agg(*aggregates).select(F.inline(F.array(*rows)))
