import random
import re

from tests.llm.cases import TEXTS, documents, empty, passage
from twinframe.llm import common
from twinframe.llm import near_dedup as N

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(texts, percent=85):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    name = {i: i for i in sets}

    def top(x):
        while name[x] != x:
            x = name[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                name[max(x, y)] = min(x, y)
    return {i: (len(s), top(i), top(i) == i) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_groups_equal_brute_force(spark):
    assert result(N.groups(documents(spark))) == brute(TEXTS)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def test_a_large_group_of_near_copies_among_others(spark, monkeypatch):
    rng = random.Random(11)
    base, other = passage(0, 150).split(), passage(150, 150).split()
    texts = {i: edited(rng, base if i % 3 else other, rng.randrange(5)) for i in range(150)}
    texts |= {200 + i: passage(20, 40) + " " + " ".join(f"y{i}_{k}" for k in range(30)) for i in range(40)}  # one shared passage
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "CELL", 32)
    assert result(N.groups(documents(spark, texts).repartition(6), small=8)) == brute(texts)


def test_pairs_at_the_border_are_all_found(spark):
    texts = {}
    for k in range(60):
        words = [f"w{k}_{i}" for i in range(104 + k)]
        texts[2 * k] = " ".join(words)
        texts[2 * k + 1] = " ".join(words[: len(words) - (len(words) - 4) * 15 // 100])
    want = brute(texts)
    assert result(N.groups(documents(spark, texts))) == want and sum(not w[2] for w in want.values()) == 60


def test_empty_nulls_and_repeats(spark):
    assert N.groups(empty(spark)).count() == 0
    docs = spark.createDataFrame([(None, passage(0, 20)), (3, passage(0, 20)), (3, passage(0, 20)), (4, None), (5, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in N.groups(docs).collect()), key=str)
    assert got == sorted([(None, None, True), (3, 3, True), (3, 3, True), (4, 4, True), (5, 5, True)], key=str)


def test_every_text_of_a_repeated_id_links(spark):
    one, two = passage(0, 41), passage(100, 41)
    rows = [(1, one), (1, two), (2, one + " more"), (3, two + " more"), (4, "only here " + passage(200, 20)), (5, passage(250, 30)), (5, passage(300, 30)), (6, passage(300, 30)), (7, passage(250, 30))]
    rows += [(d, passage(330, 20)) for d in (8, 8, None, 9)]
    for n in (1, 3, 5):
        got = {(r.doc_id, r.component_id, r.kept) for r in N.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()}
        assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 5, True), (6, 5, False), (7, 5, False), (8, 8, True), (9, 8, False), (None, None, True)}


def test_large_classes_and_nodes_are_dealt_to_several_tasks(spark, monkeypatch):
    rng = random.Random(3)
    base = passage(0, 60).split()
    texts = {i: " ".join(base) for i in range(40)} | {40 + i: edited(rng, base, 1) for i in range(60)} | {200 + i: "" for i in range(30)}
    for name, value in (("LEAST_HOT", 4), ("HOT_KEYS", 30)):
        monkeypatch.setattr(common, name, value)
    monkeypatch.setattr(N, "PORTION", 8)
    assert result(N.groups(documents(spark, texts).repartition(3))) == brute(texts)


def test_the_stage_finds_pairs_at_its_border(spark):
    texts = {}
    for k in range(40):
        words = [f"w{k}_{i}" for i in range(104 + k)]
        texts[2 * k] = " ".join(words)
        texts[2 * k + 1] = " ".join(words[: len(words) - (len(words) - 4) * 20 // 100])
    kept = {r.doc_id for r in N.keep_first(documents(spark, texts)).collect()}
    assert kept == {i for i, w in brute(texts, 80).items() if w[2]} and len(kept) == 40


def test_keep_first_returns_the_columns_of_its_input(spark):
    docs = documents(spark)
    kept = N.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, w in brute(TEXTS, N.STAGE_PERCENT).items() if w[2]}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.id: r.component for r in N.components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
