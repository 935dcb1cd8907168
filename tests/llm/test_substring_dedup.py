import hashlib
import os
import tempfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import TEXTS, documents, empty
from twinframe.llm import substring_dedup as S


def brute(texts, length=50):
    raw = {i: (t or "").encode() for i, t in texts.items()}
    first = {}
    for i in sorted(raw):
        for j in range(len(raw[i]) - length + 1):
            first.setdefault(raw[i][j : j + length], i)
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            if first[b[j : j + length]] < i:
                gone[j : j + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_report_equals_brute_force(spark):
    got = S.report(documents(spark)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute(TEXTS)


def test_many_slices_and_columns_in_files(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(3)
    pool = ["".join(rng.choice(list("abcd "), 70)) for _ in range(12)]
    texts = {i: "".join(pool[k][: rng.integers(40, 70)] for k in rng.integers(0, 12, 12)) for i in range(60)}
    docs = documents(spark, texts).repartition(5)
    want = brute(texts)
    for hot in (S.HOT_SLICES, 1):
        got = S.remove(docs, buckets=3, block=100, hot_slices=hot).collect()
        assert {r.doc_id: (r.n_bytes, len(r.kept), r.kept_sha256) for r in got} == {i: (n, n - g, sha) for i, (n, g, _, sha) in want.items()}


def test_empty_table_and_null_ids(spark):
    assert S.report(empty(spark)).count() == 0
    docs = spark.createDataFrame([(None, "z" * 80), (1, "z" * 80)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in S.report(docs).collect()}
    assert got == {None: 80, 1: 0}


@given(st.lists(st.binary(max_size=14).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=8), st.sampled_from([1, 3, 1000]))
@settings(max_examples=300, deadline=None)
def test_column_index_is_the_sorted_suffix_order(texts, block):
    data, sizes = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    with tempfile.TemporaryDirectory() as folder:
        for where in (None, f"file://{folder}"):
            index = S.ColumnIndex(data, sizes, where, block)
            columns = [np.concatenate(c) for c in zip(*(b for _, b in index.columns.read()))]
            got = [(int(o) >> 8, int(o) & 255) for o in columns[2]]
            suffixes = sorted(((t[len(t) - k :] + b"", i, k) for i, t in enumerate(texts) for k in range(len(t) + 1)), key=lambda x: ([c + 300 for c in x[0]] + [x[1]]))
            assert [(i, k) for _, i, k in suffixes] == got
            common = [0] + [next((n for n, (x, y) in enumerate(zip(a[0], b[0])) if x != y), min(len(a[0]), len(b[0]))) for a, b in zip(suffixes, suffixes[1:])]
            assert common == [int(p) for p in columns[1]]
            before = [texts[i][-k - 1] if k < len(texts[i]) else None for _, i, k in suffixes]
            assert before == [int(index.values[c - 1]) if c else None for c in columns[0].tolist()]
            index.close()
        assert not os.listdir(folder)


@given(st.lists(st.text("ab", min_size=6, max_size=16), min_size=1, max_size=9), st.sampled_from([4, 5, 6]))
@settings(max_examples=200, deadline=None)
def test_least_owners(texts, length):
    raw = [t.encode() for t in texts]
    owner = np.arange(len(raw))[::-1].copy()
    least = {}
    for t, o in zip(raw, owner.tolist()):
        for j in range(len(t) - length + 1):
            least[t[j : j + length]] = min(o, least.get(t[j : j + length], o))
    got = S.least_owners(np.frombuffer(b"".join(raw), np.uint8), np.array([len(t) for t in raw]), owner, length, None, 7)
    assert got.tolist() == [least[t[j : j + length]] for t in raw for j in range(len(t) - length + 1)]


def test_bad_lengths_are_refused(spark):
    with pytest.raises(ValueError):
        S.remove(documents(spark), length=20, gram=20)


def test_ranges_of_buckets_take_turns(spark, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 2000)
    rng = np.random.default_rng(5)
    pool = ["".join(rng.choice(list("abcd "), 90)) for _ in range(12)]
    texts = {i: "".join(pool[k][: rng.integers(40, 90)] for k in rng.integers(0, 12, 12)) for i in range(60)} | {60: "", 61: "short", 62: None}
    docs, want = documents(spark, texts).repartition(5), brute(texts)
    for hot in (S.HOT_SLICES, 1):
        got = S.remove(docs, buckets=7, hot_slices=hot, turns=3).collect()
        assert {r.doc_id: (r.n_bytes, len(r.kept), r.kept_sha256) for r in got} == {i: (n, n - g, sha) for i, (n, g, _, sha) in want.items()}


def test_segments_lie_on_disk_once(spark, monkeypatch):
    """Segments go to their buckets in a shuffle only: no table of them is written, and little is lost on small ones."""
    rng = np.random.default_rng(6)
    line = "".join(rng.choice(list("abcdefgh "), 4000))
    tags = []
    monkeypatch.setattr(S, "written", lambda df, tag, f=S.written: tags.append(tag) or f(df, tag))
    monkeypatch.setattr(S, "fresh_path", lambda s, tag, f=S.fresh_path: tags.append(tag) or f(s, tag))
    monkeypatch.setattr(S, "PASS_TEXT", 1.0)
    docs = documents(spark, {i: line for i in range(6)})
    assert {r.doc_id: len(r.kept) for r in S.remove(docs, buckets=4).collect()} == {0: 4000} | dict.fromkeys(range(1, 6), 0)
    assert set(tags) == {"slices", "columns", "answers"} and tags.count("answers") > 1
    one = [np.array([x]) for x in (7, 16, 15, 20)]
    assert len(S.pack_segments(*one, np.frombuffer(line[:65].encode(), np.uint8))) < 65 + 30
    assert [x.tolist() for x in S.unpack_segments(S.pack_segments(*one, np.arange(65, dtype=np.uint8)))] == [[7], [16], [15], [20], list(range(65))]
