"""The filter audit against brute force, and on odd rows."""

import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from spanledger.llm import filter_audit
from spanledger.llm.shipping import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
DOCS = "doc_id long, text string, lang string, part string, _n long, state string, failures string"
LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    """(part, {filter: failed}, id) of each row."""
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    for i, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        yield lang or "", {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > smallest[t]}, i


def brute_force(rows, labels):
    good, toxic = ({i for i, *v in labels if v[k] == 1} for k in (0, 1))
    judged, out = list(failures(rows)), []
    for part in {p for p, _, _ in judged}:
        docs = [(f, i in good and i is not None, i in toxic and i is not None) for p, f, i in judged if p == part]
        table, removals = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = docs, []
            for step, name in enumerate(order, 1):
                hit, stay = [d for d in left if d[0][name]], [d for d in left if not d[0][name]]
                table.append([part, "".join(order), step, len(stay), len(hit), sum(d[0][name] for d in gone),
                              sum([k for k in d[0] if d[0][k]] == [name] for d in docs), sum(d[1] for d in hit), sum(d[2] for d in hit), name])
                removals[name] += len(hit)
                left, gone = stay, gone + hit
        out += [tuple(r[:-1]) + (removals[r[-1]],) for r in table]
    return sorted(out)


def audited(spark, rows, labels):
    ship(spark)
    docs = spark.createDataFrame([(*r, "x", 7, "s", "f") for r in rows], DOCS).repartition(3)
    df = filter_audit.audit_filters(docs, spark.createDataFrame(labels, LABELS))
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def random_text(rng):
    words = [rng.choice(["a", "b", "Word", "BIG", "x#y", "éé", "the", "of"] if rng.random() < 0.5 else [f"w{rng.randrange(900)}"])
             for _ in range(rng.choice([0, 3, 199, 200, 201, 400]))]
    if rng.random() < 0.6:
        words = [w.replace("#", "") for w in words]
    return rng.choice([" ", "\n\t ", " \x0b"]).join(words) + rng.choice(["", " ", "$"])


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, random_text(rng), rng.choice(["en", "de", "", None])) for i in rng.sample(range(1000), 120)]
    rows += [(i + 2000, rng.choice(rows)[1], rng.choice(["en", "de"])) for i in range(40)]  # copies, also across parts
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, *_ in rows if rng.random() < 0.7]
    labels += [(99_999, 1, 1)]  # an id that no document has
    assert audited(spark, rows, labels) == brute_force(rows, labels)


def test_odd_rows(spark):
    """Null ids, texts and labels, repeated rows, repeated labels, a reused id, a long text of one word."""
    rows = [(None, "same", "en"), (None, "same", "en"), (4, "same", "en"), (4, "same", "en"), (4, "other", "en"), (9, "same", "de"),
            (2, None, "en"), (3, "", None), (5, "word " * 100_000, "en"), (-1, "word " * 100_000, "en"), (6, "A" * 3000, "en")]
    labels = [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9, None, 1), (3, 1, None)]
    assert audited(spark, rows, labels) == brute_force(rows, labels)


def test_empty_tables(spark):
    assert audited(spark, [], [(1, 1, 1)]) == []
    assert audited(spark, [(1, "a", "en")], []) == brute_force([(1, "a", "en")], [])


def test_paths_are_orders():
    reach, leave = filter_audit.path_counts(5)
    assert reach[-1] == leave[0] == 120
    assert reach[0b10110] == 6 and leave[0b10110] == 2
    for f in range(5):  # each order applies each filter once
        assert sum(w for _, b, w in filter_audit.lattice_edges(5) if b == f) == 120


def test_a_hot_text_is_counted_before_it_moves(spark):
    rows = [(i, "copy of one text", "en") for i in range(3000)]
    counts = {r["failures"]: r["n"] for r in filter_audit.failure_counts(
        spark.createDataFrame([(*r, "x", 7, "s", "f") for r in rows], DOCS), spark.createDataFrame([], LABELS)).filter(F.col("n") > 0).collect()}
    assert counts == {1: 1, 17: 2999}
