"""How filters interact: what each would remove at every place of every order.

Each text becomes the set of filters that it fails, and the corpus a histogram of (part, set of failures): at most
2^filters rows a part, combined map-side. All else is counted on the lattice of filter subsets. A state is the set of
filters already applied, an edge applies one more; what an edge removes, keeps and so on follows from the histogram. The
number of orders that reach a state from the empty set and leave it for the full set is counted forwards and backwards
along the edges. An edge lies on (reaching its start) x (leaving its end) orders, and this weight times its removals,
summed over a filter's edges, is the filter's removals over all orders. The steps of one order are read from the same edges.

Main path: SQL functions only.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.sources.scratch import durable

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SYMBOLS = "#$%&*|"
#: The filters of ``text_failures`` and the one on earlier copies, by their letters.
FILTERS = "ABCDE"


def path_counts(filters: int) -> tuple[list[int], list[int]]:
    """For each state (bit set of applied filters) the orders that reach it and those that leave it for the full set."""
    states = 1 << filters
    reach, leave = [0] * states, [0] * states
    reach[0] = leave[-1] = 1
    for state in range(states):  # every edge leads to a larger number
        for f in range(filters):
            if not state >> f & 1:
                reach[state | 1 << f] += reach[state]
    for state in reversed(range(states)):
        for f in range(filters):
            if not state >> f & 1:
                leave[state] += leave[state | 1 << f]
    return reach, leave


def lattice_edges(filters: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders through the edge from the state by the filter)."""
    reach, leave = path_counts(filters)
    return [(s, f, reach[s] * leave[s | 1 << f]) for s in range(1 << filters) for f in range(filters) if not s >> f & 1]


def text_failures(text: Column) -> Column:
    """Bit set of the failed filters A to D; a null text counts as empty.

    A: under 200 words. B: 100 x distinct words < 50 x words. C: 100 x capitals A-Z > 3 x code points. D: holds one of
    ``#$%&*|``. An empty text fails A alone.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    words, distinct = F.size(found), F.size(F.array_distinct(found))
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    symbol = F.lit(False)
    for s in SYMBOLS:
        symbol = symbol | F.contains(text, F.lit(s))
    failures = [words < MIN_WORDS, distinct * 100 < words * DISTINCT_PERCENT,
                capitals.cast("long") * 100 > F.char_length(text).cast("long") * CAPITAL_PERCENT, symbol]
    bits = F.lit(0)
    for i, failed in enumerate(failures):
        bits = bits + F.when(failed, F.lit(1 << i)).otherwise(F.lit(0))
    return bits


def _flags(labels: DataFrame) -> DataFrame:
    """One row per labelled id; a document is good or toxic if any of its label rows says so."""
    return labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("_good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("_toxic"))


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, failures, n, good, toxic): how many documents of a part fail exactly this set of filters.

    Filter E fails for a text that some smaller doc_id has too; texts are compared by their SHA-256. A null doc_id is
    neither smaller nor larger than another, so its row never fails E. Repeated rows count each, and no row of a text's
    smallest id fails E. Rows that share a text are combined before they are shuffled by it, however many they are.
    """
    rows = durable(docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"),
        F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("_digest"),
        text_failures(F.col("text")).alias("_bits"),
    ).groupBy("_id", "_part", "_digest", "_bits").agg(F.count(F.lit(1)).alias("_n")), "text-failures")
    has_id = F.col("_id").isNotNull()
    flagged = rows.filter(has_id).join(_flags(labels), "_id", "left").unionByName(rows.filter(~has_id), allowMissingColumns=True)
    # Ids are unique within a group here, so the least (id, rows) tells how many rows its smallest id has.
    copies = flagged.fillna(False, ["_good", "_toxic"]).groupBy("_digest", "_part", "_bits", "_good", "_toxic").agg(
        F.sum("_n").alias("_all"),
        F.coalesce(F.sum(F.when(has_id, F.col("_n"))), F.lit(0)).alias("_numbered"),
        F.min(F.when(has_id, F.struct("_id", "_n"))).alias("_least"))
    smallest = rows.groupBy("_digest").agg(F.min("_id").alias("_first"))
    at_first = F.when(F.col("_least._id") == F.col("_first"), F.col("_least._n")).otherwise(F.lit(0))
    late = F.col("_numbered") - at_first
    split = F.explode(F.array(
        F.struct(F.col("_bits").alias("failures"), (F.col("_all") - late).alias("n")),
        F.struct((F.col("_bits") + 16).alias("failures"), late.alias("n"))))
    found = copies.join(smallest, "_digest", "left").select("_part", "_good", "_toxic", split.alias("_s"))
    return found.select(F.col("_part").alias("part"), "_s.failures", "_s.n", "_good", "_toxic").groupBy("part", "failures").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("_good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("_toxic"), F.col("n"))), F.lit(0)).alias("toxic"))


def edge_counts(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What every lattice edge does in every part.

    One row for each part, state (bit set of applied filters) and filter (its bit): kept, removed, redundant (fail the filter, but
    an applied one too), unique_fails (fail this filter alone), good_lost, toxic_lost and shapley, the filter's removals
    summed over all orders.
    """
    edges = [F.struct(F.lit(s).alias("state"), F.lit(1 << f).alias("bit"), F.lit(w).cast("long").alias("orders"))
             for s, f, w in lattice_edges(len(filters))]
    # A part has at most 2^filters rows here, and the number of edges is fixed.
    at = counts.select("*", F.explode(F.array(*edges)).alias("_e")).select("*", "_e.*").drop("_e")
    fails = F.col("failures").bitwiseAND(F.col("bit")) != 0
    before = F.col("failures").bitwiseAND(F.col("state")) != 0
    alone = F.col("failures") == F.col("bit")

    def total(value: str, where: Column, name: str) -> Column:
        return F.sum(F.when(where, F.col(value)).otherwise(F.lit(0))).alias(name)

    done = at.groupBy("part", "state", "bit", "orders").agg(
        total("n", ~fails & ~before, "kept"), total("n", fails & ~before, "removed"), total("n", fails & before, "redundant"),
        total("n", alone, "unique_fails"), total("good", fails & ~before, "good_lost"), total("toxic", fails & ~before, "toxic_lost"))
    of_filter = Window.partitionBy("part", "bit")
    return done.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(of_filter)).drop("orders")


def _order_steps(docs: DataFrame, filters: str) -> DataFrame:
    """(filter_order, step, state, bit) of every order: a fixed table that does not depend on the data."""
    rows = []
    for order in permutations(range(len(filters))):
        state = 0
        for step, f in enumerate(order, 1):
            rows.append(("".join(filters[i] for i in order), step, state, 1 << f))
            state |= 1 << f
    return docs.sparkSession.createDataFrame(rows, "filter_order string, step int, state int, bit int")


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row, zeros included, for each part, order of the five filters and step.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley; see
    ``text_failures``, ``failure_counts`` and ``edge_counts`` for what they count. A null part is the empty string; labels
    of ids that no document has do not count, and null labels are neither good nor toxic. An empty table gives no rows.
    Other columns of ``docs``, whatever their names, are not looked at.
    """
    edges = edge_counts(failure_counts(docs, labels, part))
    return edges.join(F.broadcast(_order_steps(docs, FILTERS)), ["state", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
