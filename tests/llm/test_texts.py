"""Byte BPE, token counts, id files, fingerprints."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.cases import TEXTS, documents, empty
from twinframe.llm.common import mix, run_hashes
from twinframe.llm import byte_bpe, id_files, simhash, token_counts

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
WORD_BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["it's 'S don't", "<|endoftext|> a<|startoftext|>", "İstanbul ΣΣ. ǅ ﬁ", "a\x1cb\x85c\xa0d", "¼½ ²x 3.14", "é ☃☃!!", "　漢字かな", "  two  spaces ", "▁mark ▁", "\r\n\tx", "'tis l'été D'Or 's", "." * 300, "a" * 700]


def test_byte_bpe_round_trip(spark):
    enc = byte_bpe.encoder(RANKS, PATTERN)
    assert byte_bpe.round_trip(empty(spark), RANKS, PATTERN).count() == 0
    for r in byte_bpe.round_trip(documents(spark), RANKS, PATTERN).collect():
        t = TEXTS[r.doc_id] or ""
        ids = np.array(enc.encode_ordinary(t), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.lossless) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), True)


def test_encode_then_decode_are_inverse(spark):
    docs = documents(spark)
    back = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in TEXTS.items()}


@given(st.text("ab1'! \n　é", max_size=200), st.integers(1, 20))
@settings(max_examples=300, deadline=None)
def test_cut_texts_have_the_ids_of_whole_ones(text, most):
    enc = byte_bpe.encoder(RANKS, PATTERN)
    assert byte_bpe.encode_text(enc, text, most).tolist() == enc.encode_ordinary(text)


def library():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    t = tokenizers.Tokenizer(tokenizers.models.Unigram([(model.id_to_piece(i), -math.log(i + 1)) for i in range(model.get_piece_size())], 0, True))
    t.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace()
    return t


def test_token_counts_equal_the_library(spark):
    tok = library()
    texts = TEXTS | {100 + i: t for i, t in enumerate(ODD)}
    got = {r.doc_id: r.n_tokens for r in token_counts.count(documents(spark, texts), PIECES).collect()}
    assert got == {i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t in texts.items()}
    assert token_counts.count(empty(spark), PIECES).count() == 0


@pytest.mark.parametrize("text", ["<s>", "a<0x0A>b", "</s> x<unk>", "<0x41><0x42> <s></s>"])
def test_what_looks_like_a_special_piece_is_text(text):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    special = lambda i: model.is_unknown(i) or model.is_control(i) or model.is_byte(i)
    tok = tokenizers.Tokenizer(tokenizers.models.Unigram([(f"\ue000{i}" if special(i) else model.id_to_piece(i), -math.log(i + 1)) for i in range(model.get_piece_size())], 0, False))
    tok.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace()
    assert token_counts.counter(PIECES)(text)[1] == len(tok.encode(text, add_special_tokens=False).ids)


@given(st.text("ab \n", max_size=40))
@settings(max_examples=200, deadline=None)
def test_ties_are_the_libraries(text):
    pieces = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -2.0), ("aa", -2.0), ("ab", -3.0), ("aab", -4.0), ("▁a", -2.0), ("ba", -3.0)]
    tok = tokenizers.Tokenizer(tokenizers.models.Unigram(pieces, 0, False))
    tok.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace()
    text = text.replace("\n", "")
    assert token_counts.Counter(pieces)(text)[1] == len(tok.encode(text, add_special_tokens=False).ids)


def test_id_files_hold_what_the_library_says(spark, tmp_path):
    texts = TEXTS | {100 + i: t for i, t in enumerate(ODD)} | {-5: "negative id"}
    tok, path = tokenizers.Tokenizer.from_file(WORD_BPE), str(tmp_path / "ids")
    id_files.write(documents(spark, texts).repartition(3), WORD_BPE, path, partitions=4)
    at, want = 0, {}
    for i in sorted(texts):
        ids = [*tok.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        want[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in id_files.index(spark, path).collect()} == want
    assert [r.doc_id for r in id_files.lookup(spark, path, [7, 999]).collect()] == [7]


def test_starts_are_places_in_the_files(spark, tmp_path):
    rows = [(d, t) for d in (3, None, 4) for t in ("a b c", "a b", "", None, "q w e r t", "a b", "z " * 40)] + [(2, "x y")]
    path = str(tmp_path / "ids")
    id_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), WORD_BPE, path, partitions=5)
    at, want = 0, []
    for r in id_files.read(spark, path).orderBy("part", "row").collect():
        want.append((r.doc_id, at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())))
        at += len(r.ids)
    assert [w[0] for w in want] == [None] * 7 + [2] + [3] * 7 + [4] * 7
    assert sorted(map(tuple, id_files.index(spark, path).collect()), key=str) == sorted(want, key=str)


def test_parts_are_ordered_by_number(spark, tmp_path):
    rows = [(0, [5, 2], 99_999, 0), (1, [6, 7, 2], 100_000, 0), (2, [2], 100_000, 1), (3, [8, 2], 100_001, 0)]
    path = str(tmp_path / "ids")
    spark.createDataFrame(rows, id_files._FILE).repartition(3).write.orc(path)
    assert sorted((r.doc_id, r.start) for r in id_files.index(spark, path).collect()) == [(0, 0), (1, 2), (2, 5), (3, 6)]


def test_id_files_are_orc_with_bloom_filters(spark, tmp_path):
    import glob

    import pyarrow.orc as orc

    path = str(tmp_path / "ids")
    id_files.write(documents(spark), WORD_BPE, path, partitions=2)
    files = sorted(glob.glob(f"{path}/*.orc"))
    assert files and all(orc.ORCFile(f).row_index_stride == 1000 for f in files)
    spark.createDataFrame([], documents(spark).schema)
    id_files.write(empty(spark), WORD_BPE, str(tmp_path / "none"), partitions=2)
    assert id_files.index(spark, str(tmp_path / "none")).count() == 0


def test_word_memory_turns_over():
    enc = id_files.WordEncoder(WORD_BPE)
    enc.known = id_files.Remembered(3)
    tok = tokenizers.Tokenizer.from_file(WORD_BPE)
    for t in ["a b c d", "b c e f g", "a a b", "h i j k a", "x" * 100 + " a", ""] * 2:
        assert np.frombuffer(enc([t])[0], "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_every_letter_below_u0250_is_split_as_the_library_does():
    enc = id_files.WordEncoder(WORD_BPE)
    tok = tokenizers.Tokenizer.from_file(WORD_BPE)
    texts = [f"A{chr(i)}B {chr(i)}an {chr(i)}" for i in range(0x250)] + ["Ɗan Ɓata ƐWE", "AƏB"]
    got = [np.frombuffer(x, "<u4").tolist() for x in enc(texts)]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_fingerprints_are_the_weighted_votes():
    def print_of(text):
        words = re.findall(rb"[^\x00-\x20]+", text.encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
        one = lambda w: int(run_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
        mixed = lambda x, seed=0: int(mix(np.array([x % 2**64], np.uint64), seed)[0])
        terms = Counter((one(w), 1.0) for w in words) + Counter((mixed(one(a) * 0x9E3779B97F4A7C15 + one(b)), 3.0) for a, b in zip(words, words[1:]))
        votes = [0.0] * 128
        for (term, kind), n in terms.items():
            bits = b"".join(mixed(term, 3000 + k).to_bytes(8, "little") for k in range(2))
            for i in range(128):
                votes[i] += kind * (1 + math.log(n)) * (1 if bits[i // 8] >> (7 - i % 8) & 1 else -1)
        return "".join(f"{sum((votes[i + k] > 0) << (7 - k) for k in range(8)):02x}" for i in range(0, 128, 8))

    texts = ["A few words and a few more words", "x", "", "é É é " * 9, "\x00a\tb c  a b"]
    assert [p.tobytes().hex() for p in simhash.fingerprints(texts)] == [print_of(t) for t in texts]


def test_edit_report(spark):
    got = {r.doc_id: r for r in simhash.edit_report(documents(spark).repartition(5), partitions=3).collect()}
    ids = sorted(TEXTS, reverse=True)
    for k, i in enumerate(ids):
        t, following = TEXTS[i] or "", TEXTS[ids[(k + 1) % len(ids)]] or ""
        n = len(t)
        want = t[: n - n // 3] + following[: n // 3]
        assert (got[i].n_chars, got[i].edited_sha256) == (n, hashlib.sha256(want.encode()).hexdigest())
        one, other = simhash.fingerprints([t, want])
        assert got[i].fingerprint == one.tobytes().hex() and got[i].edited_fingerprint == other.tobytes().hex()
        bits = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / simhash.BITS
        assert got[i].near_next == pytest.approx(bits(got[i].fingerprint, got[ids[(k + 1) % len(ids)]].fingerprint))
    assert got[0].fingerprint == got[5].fingerprint
    assert simhash.edit_report(empty(spark)).count() == 0
    alone = simhash.edit_report(documents(spark, {3: "abcdef"})).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


@pytest.mark.parametrize("radius", [0, 3, 6])
def test_block_tables_find_all_within_the_radius(spark, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 256, (20, 16), dtype=np.uint8)
    prints = {b.tobytes().hex() for b in base}
    for b in base:
        for k in range(12):
            flips = np.zeros(128, bool)
            flips[rng.choice(128, k, replace=False)] = True
            prints.add((b ^ np.packbits(flips)).tobytes().hex())
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints] + [(None,), (prints[0],)], "fingerprint string")
    got = [(r.query, r.found, r.distance) for r in simhash.within_radius(df, df, radius).collect()]
    want = {(a, b, d) for a in prints for b in prints if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_neighbours_count_documents(spark):
    rows = [(0, "0" * 32), (20, "0" * 31 + "1"), (3, "0" * 31 + "3"), (4, "f" * 32), (5, "f" * 32), (40, "f" * 32)]
    got = simhash.neighbours(spark.createDataFrame(rows, "doc_id long, fingerprint string"), F.col("doc_id") % 20 == 0, 1)
    assert {r.fingerprint: r.n_near for r in got.collect()} == {"0" * 32: 1, "0" * 31 + "1": 2, "f" * 32: 2}
