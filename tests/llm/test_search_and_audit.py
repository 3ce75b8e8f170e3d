"""Decontamination, ranked search and the filter audit against plain versions, on awkward texts and against their SQL."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import audit, decontaminate, lexical, registry

SF = "/root/testdata/sf0.001"
# The other columns bear names that the operators use themselves.
DOCS = "doc_id long, text string, source string, id string, part string, mask string, code string, n string, hits string, items string, term string, rank string"
ITEMS = "item_id long, text string, item string, piece string, term string, pass string"
LABELS = "doc_id long, quality int, toxic int, id string, good string, mask string"
AWKWARD = [None, "", " \n\t", "a", "Ab aB ab", "x" * 70_000, "one " * 3_000, "é😀 ÉÀ " * 300, "a@b-c_d", "\x00a\x00b\x7fc", "1.2,3;4"]
PASSAGE = "the quick brown fox jumps over the lazy dog and runs away from it"


def docs_of(spark, texts, sources=None, ids=None):
    sources = sources or ["s"] * len(texts)
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, s, *"abcdefghi") for i, t, s in zip(ids, texts, sources)], DOCS)


def items_of(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, *"abcd") for i, t in zip(range(len(texts)) if ids is None else ids, texts)], ITEMS)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Decontamination.

def contaminated(docs, items, size=10):
    found = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            k = min(size, len(w))
            found.setdefault(str(i), set()).update(tuple(w[j:j + k]) for j in range(len(w) - k + 1))
    out = []
    for d, t in docs:
        w, hit, names = words(t), set(), set()
        for name, windows in found.items():
            for win in windows:
                for j in range(len(w) - len(win) + 1):
                    if tuple(w[j:j + len(win)]) == win:
                        hit.update(range(j, j + len(win)))
                        names.add(name)
        code = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(names), code, bool(hit)))
    return sorted(out, key=repr)


def hard_texts():
    rng = random.Random(3)
    few = ["a", "b", "ab", "é", "bb1"]
    return [*AWKWARD, PASSAGE.upper(), f"see: {PASSAGE}. ", PASSAGE[4:-3], PASSAGE.replace(" ", "--"), f"{PASSAGE} {PASSAGE}", PASSAGE.replace("dog", "dogs"),
            *(" ".join(rng.choice(few) for _ in range(rng.randrange(60))) for _ in range(40))]


HARD_ITEMS = [PASSAGE, PASSAGE, "one one one", "zz " + PASSAGE, "Ab AB", "é😀", "", None, "a b a b ab ab é é bb1 a b a", "x" * 70_000, "bb1", "one " * 12]


@pytest.mark.parametrize("pass_bytes", [1 << 20, 2_000])
def test_decontamination_against_plain_search(spark, pass_bytes):
    texts = hard_texts()
    ids = [*range(len(texts)), None, 3, 3]
    texts = [*texts, PASSAGE, texts[3], texts[3]]
    item_ids = [*range(len(HARD_ITEMS)), None, 2]
    item_texts = [*HARD_ITEMS, "b b", "Ab ab"]
    found = decontaminate.find_passages(docs_of(spark, texts, ids=ids), items_of(spark, item_texts, item_ids), pass_bytes=pass_bytes)
    assert rows_of(decontaminate.digest(found)) == contaminated(zip(ids, texts), zip(item_ids, item_texts))


def test_decontamination_of_nothing(spark):
    some, none = docs_of(spark, ["a b", None]), docs_of(spark, [])
    assert rows_of(decontaminate.digest(decontaminate.find_passages(none, items_of(spark, ["a"])))) == []
    assert [r[2] for r in rows_of(decontaminate.digest(decontaminate.find_passages(some, items_of(spark, []))))] == [0, 0]


def test_long_items_are_cut_into_pieces_that_lose_no_window(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_TERMS", 7)
    rng = random.Random(5)
    item = " ".join(f"w{rng.randrange(50)}" for _ in range(60))
    texts = [" ".join(item.split()[i:i + 11]) for i in range(0, 60, 3)]
    found = decontaminate.find_passages(docs_of(spark, texts), items_of(spark, [item]))
    assert rows_of(decontaminate.digest(found)) == contaminated(enumerate(texts), [(0, item)])


def test_shift_tables_skip_most_of_a_text():
    known = decontaminate.compiled([("i", PASSAGE.encode())], 10)
    (group,) = {g.least: g for g in known.groups if g.least == min(h.least for h in known.groups)}.values()
    assert group.shift.max() == group.least - group.block + 1
    assert (group.shift == group.shift.max()).mean() > 0.8


# Ranked search.

def ranking(docs, items, k):
    held = [(d, Counter(words(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(words(t))
    out = []
    for i, terms in asked.items():
        scores = []
        for d, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0 and d is not None:
                scores.append((-s, d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def ranked_case():
    rng = random.Random(7)
    vocabulary = [f"t{i}" for i in range(40)] + ["a" * 20 + "b" + "c" * 20, "a" * 20 + "d" + "c" * 20, "é" * 9]
    draw = lambda n: " ".join(vocabulary[min(int(rng.expovariate(0.12)), len(vocabulary) - 1)] for _ in range(n))
    texts = [*AWKWARD, *(draw(rng.randrange(1, 120)) for _ in range(400)), *(["t1 t2 T3"] * 150), draw(5_000)]
    ids = [*range(len(texts)), None, 20, 20]
    texts = [*texts, "t1 t39", texts[20], texts[20]]
    items = [draw(6) for _ in range(25)] + ["t1 t2 t3", "unseen", "", None, "t1", " ".join(vocabulary)]
    return texts, ids, [*items, "t5"], [*range(len(items)), 0]


@pytest.mark.parametrize("pass_pairs,leaf,page", [(50_000, 32, 4096), (20, 4, 64)])
def test_ranked_search_against_plain_scores(spark, monkeypatch, pass_pairs, leaf, page):
    monkeypatch.setattr(lexical, "LEAF", leaf)
    monkeypatch.setattr(lexical, "PAGE_DOCS", page)
    monkeypatch.setattr(lexical, "PENDING", 64)
    texts, ids, items, item_ids = ranked_case()
    for k in (5, 50):
        got = lexical.ranked(docs_of(spark, texts, ids=ids).repartition(3), items_of(spark, items, item_ids), k, pass_pairs=pass_pairs)
        assert rows_of(got) == ranking(zip(ids, texts), zip(item_ids, items), k)


def test_ranked_search_of_nothing(spark):
    assert rows_of(lexical.ranked(docs_of(spark, []), items_of(spark, ["a"]))) == []
    assert rows_of(lexical.ranked(docs_of(spark, ["a", None]), items_of(spark, [None, ""]))) == []


def test_subtree_bounds_hold_and_spare_documents():
    import numpy as np

    rng = np.random.default_rng(1)
    # Documents of two topics: an item of the one descends into its half alone once it has its best.
    rows = [np.sort(rng.choice(20, 8, replace=False)) + 20 * (i % 2) for i in range(800)]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    terms_, tf = np.concatenate(rows), rng.integers(1, 5, starts[-1])
    m, ids = rng.integers(60, 200, len(rows)), np.arange(len(rows))
    asked = lexical.Asked([0], np.array([0, 4]), np.array([1, 3, 5, 7]), np.array([9, 8, 7, 6]) * 1000, np.arange(40), len(rows), 10_000)
    tree = lexical.plant(starts, terms_, tf, m, 40)
    held = sorted(d for leaf in tree.leaves if leaf is not None for d in leaf)
    assert held == list(range(len(rows)))
    best = lexical.Best(asked, 5, np.zeros(1, np.int64))
    lexical.PENDING, before = 1, lexical.PENDING
    scored, summed = [], lexical.summed
    lexical.summed = lambda table, *rest: (scored.append(len(table)), summed(table, *rest))[1]
    try:
        lexical.descend(tree, starts, terms_, tf, m, ids, asked, best)
    finally:
        lexical.summed, lexical.PENDING = summed, before
    best.settle()
    table = np.zeros((len(rows), 40), np.int64)
    table[np.repeat(np.arange(len(rows)), np.diff(starts)), terms_] = lexical.worth(tf, np.repeat(m, np.diff(starts)))
    want = lexical.summed(table, asked, np.array([0]))[:, 0]
    assert best.id.tolist() == sorted(range(len(rows)), key=lambda d: (-want[d], d))[:5]
    assert sum(scored[1:]) < len(rows) * 0.6


# Filter audit.

def audited(docs, labels):
    good, toxic = Counter(), Counter()
    for d, q, t in labels:
        if d is not None:
            good[d] |= q == 1
            toxic[d] |= t == 1
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    held = []
    for d, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": any(c in t for c in "#$%&*|"), "E": d is not None and d > least[t]}
        held.append((s or "", {f for f in fails if fails[f]}, good[d] if d is not None else 0, toxic[d] if d is not None else 0))
    out, shapley = [], Counter()
    for part in {h[0] for h in held}:
        mine = [h for h in held if h[0] == part]
        for order in permutations("ABCDE"):
            alive = mine
            for step, f in enumerate(order, 1):
                gone = [h for h in alive if f in h[1]]
                late = sum(f in h[1] for h in mine) - len(gone)
                alive = [h for h in alive if f not in h[1]]
                shapley[part, f] += len(gone)
                out.append([part, "".join(order), step, len(alive), len(gone), late, sum(h[1] == {f} for h in mine),
                            sum(bool(h[2]) for h in gone), sum(bool(h[3]) for h in gone)])
    return sorted((tuple([*r, shapley[r[0], r[1][r[2] - 1]]]) for r in out), key=repr)


def test_audit_against_plain_filters(spark):
    fine = " ".join(f"w{i}" for i in range(60))
    texts = [*AWKWARD, fine, fine, fine, fine.upper(), fine + " 5%", "a b " * 40, fine + "\x0bx\xa0y", None, "", "#", "T" * 9]
    sources = [None if i % 5 == 0 else "" if i % 5 == 1 else f"src{i % 3}" for i in range(len(texts))]
    ids = [*range(len(texts)), 11, None, None, 12]
    texts, sources = [*texts, fine, fine, "#", fine], [*sources, "src0", "src1", "src1", "src2"]
    labels = [(0, 1, 0), (11, 1, None), (12, 0, 1), (12, 1, 0), (13, None, 1), (None, 1, 1), (99, 1, 1), (15, 1, 1)]
    got = audit.audit(docs_of(spark, texts, sources, ids), spark.createDataFrame([(*r, *"abc") for r in labels], LABELS))
    assert rows_of(got) == audited(list(zip(ids, texts, sources)), labels)


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], LABELS)
    assert rows_of(audit.audit(docs_of(spark, []), none)) == []
    got = audit.audit(docs_of(spark, ["a"]), none)
    assert got.count() == 600 and got.where("removed > 0").agg(F.sum("good_lost")).first()[0] == 0


# SQL on the small table.

@pytest.mark.parametrize("name", ["op11_decontamination", "op12_lexical_search", "op13_filter_audit"])
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = db.execute(registry.ORACLES[name])
    columns = [d[0] for d in result.description]
    got = registry.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.select(*columns)) == sorted(result.fetchall(), key=repr)
