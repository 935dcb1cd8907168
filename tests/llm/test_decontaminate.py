import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import BENCH, TEXTS, documents, empty, passage
from twinframe.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
ITEMS = [(1, passage(12, 14)), (2, passage(205, 11)), (3, "One"), (4, ""), (5, None), (6, passage(12, 14)), (7, "same same")]


def brute(texts, items, window=10):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = {}
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[j : j + k]), set()).add(i)
    out = {}
    for d, t in texts.items():
        w, hit, got = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                found = windows.get(tuple(w[j : j + k]))
                if found:
                    got |= found
                    hit |= set(range(j, j + k))
        out[d] = (len(w), len(hit), len(got), D.digest(got), bool(hit))
    return out


@pytest.mark.parametrize(("most", "part"), [(D.MAX_ITEM_BYTES, D.PART_BYTES), (D.MAX_ITEM_BYTES, 60), (60, 60)])
def test_report_equals_brute_force(spark, most, part):
    got = D.report(documents(spark), spark.createDataFrame(ITEMS, BENCH), most=most, part=part).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == brute(TEXTS, ITEMS)


def test_empty_tables(spark):
    none = spark.createDataFrame([], BENCH)
    assert D.report(empty(spark), none).count() == 0
    assert not any(r.contaminated for r in D.report(documents(spark), none).collect())
    assert D.remove(documents(spark), none).count() == len(TEXTS)


@given(st.lists(st.text("ab ", max_size=30), max_size=5), st.text("ab ", max_size=60))
@settings(max_examples=200, deadline=None)
def test_automaton_equals_brute_force(items, text):
    rows = list(enumerate(items))
    auto = D.ItemAutomaton(rows, 4)
    hit, got = set(), set()
    for a, b, found in auto.scan(D.words_of(text)):
        hit |= set(range(a, b))
        got |= set(found)
    assert (len(hit), len(got)) == brute({0: text}, rows, 4)[0][1:3]


def test_building_is_linear_in_the_items():
    import pickle
    import random

    rng, common = random.Random(5), " ".join(f"c{i}" for i in range(12))
    items = [(k, common + " " + " ".join(f"w{rng.randrange(2000)}" for _ in range(40)) + " the the the the") for k in range(1500)]
    auto = D.ItemAutomaton(items)
    assert len(auto.owners) <= sum(len(t.split()) for _, t in items)
    assert len(pickle.dumps(auto)) < 25 * sum(len(t) for _, t in items)
    hits = list(auto.scan(D.words_of("a " + common + " b")))
    assert [(a, b, len(found)) for a, b, found in hits] == [(1, 11, 1500), (2, 12, 1500), (3, 13, 1500)]


def test_remove_cuts_passages_and_keeps_the_rest(spark):
    items = spark.createDataFrame([(1, passage(10, 30))], BENCH)
    docs = documents(spark)
    got = {r.doc_id: r.text for r in D.remove(docs, items).collect()}
    assert D.remove(docs, items).columns == docs.columns
    assert got[6] == passage(100, 45) + " , !"
    assert 7 not in got  # wholly benchmark
    assert got[1] is None and got[8] == TEXTS[8]


@pytest.mark.parametrize(("most", "part"), [(D.MAX_ITEM_BYTES, D.PART_BYTES), (D.MAX_ITEM_BYTES, 60), (60, 60)])
def test_remove_decides_and_cuts_once_on_the_hits_of_all_automata(spark, most, part):
    items = spark.createDataFrame([(1, passage(0, 15)), (2, passage(20, 15)), (3, passage(10, 12)), (4, "left right")], BENCH)
    rest = " ".join(f"z{i}" for i in range(40))
    texts = {
        0: f"{passage(0, 15)} {passage(20, 15)} {passage(300, 20)}",  # 30 of 50 words, 15 by each of two items
        1: f"{passage(0, 22)} {rest}",  # two passages overlap
        2: f"left {passage(20, 15)} right {rest}",  # cutting makes new neighbours
        3: rest,
    }
    got = {r.doc_id: r.text for r in D.remove(documents(spark, texts), items, most=most, part=part).collect()}
    assert got == {1: f" {rest}", 2: f"left  right {rest}", 3: rest}


@pytest.mark.parametrize(("most", "part"), [(D.MAX_ITEM_BYTES, D.PART_BYTES), (D.MAX_ITEM_BYTES, 60), (60, 60)])
def test_rows_of_one_or_no_id_stay_apart(spark, most, part):
    texts = [(7, passage(12, 14)), (7, "a " + passage(12, 14) + " b c"), (7, "same same"), (None, passage(205, 11)), (None, "a b"), (None, None)]
    got = D.report(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(ITEMS, BENCH), most=most, part=part).collect()
    want = [(d, *brute({0: t}, ITEMS)[0]) for d, t in texts]
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str) == sorted(want, key=str)
