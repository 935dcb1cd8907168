"""Repeated and null doc_ids, and texts beyond one slice, through every operator: a row for each row, with the result of its text alone."""

import public_tokenizers
import pytest

from tests.llm.cases import passage
from twinframe.llm import byte_bpe, decontaminate, id_files, near_dedup, secret_scan, simhash, substring_dedup, token_counts, toxicity
from twinframe.llm.common import SLICE_BYTES, shared_dir

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
LONG = passage(0, 400) * (SLICE_BYTES // 2500)
ROWS = [(1, LONG), (2, "x" * 200_000), (3, LONG[:70_000] + " token=abcdefgh"), (4, "one"), (4, "two words"), (4, None), (4, "one"), (None, "one"), (None, None), (None, "AKIA" + "Q" * 16)]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    assert len(LONG.encode()) > SLICE_BYTES
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def by_row(df, *columns):
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()), key=str)


def want(of):
    return sorted(((d, *of(t)) for d, t in ROWS), key=str)


def test_byte_bpe(docs):
    enc = byte_bpe.encoder(RANKS, PATTERN)
    assert by_row(byte_bpe.round_trip(docs, RANKS, PATTERN), "n_tokens", "lossless") == want(lambda t: (len(enc.encode_ordinary(t or "")), True))


def test_token_counts(docs):
    count = token_counts.counter(public_tokenizers.path("piece_bpe_32k.model"))
    assert by_row(token_counts.count(docs, public_tokenizers.path("piece_bpe_32k.model")), "n_tokens") == want(lambda t: (count(t)[1],))


def test_id_files(docs, spark, tmp_path):
    encode = id_files.word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    id_files.write(docs, public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "ids"), 3)
    assert by_row(id_files.index(spark, str(tmp_path / "ids")), "n_tokens") == want(lambda t: (len(encode([t])[0]) // 4 + 1,))


def test_simhash(docs):
    prints = lambda t: (simhash.fingerprints([t])[0].tobytes().hex(), len(t or ""))
    assert by_row(simhash.edit_report(docs, partitions=2), "fingerprint", "n_chars") == want(prints)
    near = simhash.neighbours(simhash.fingerprint(docs), simhash.F.col("doc_id").isNull())
    assert near.count() == 3


def test_substring_dedup(docs):
    got = by_row(substring_dedup.report(docs), "n_bytes")
    assert got == want(lambda t: (len((t or "").encode()),))


def test_decontamination(docs, spark):
    items = spark.createDataFrame([(1, passage(5, 12))], "item_id long, text string")
    got = {(r.doc_id, r.n_words): r.n_hit for r in decontaminate.report(docs, items).collect()}
    assert len(by_row(decontaminate.report(docs, items), "n_words")) == len(ROWS)
    assert got[(4, 2)] == 0 and max(got.values()) == 12 * (SLICE_BYTES // 2500)


def test_near_dedup(docs):
    got = by_row(near_dedup.groups(docs), "component_id", "kept")
    assert got == sorted([(1, 1, True), (2, 2, True), (3, 1, False)] + [(4, 4, True)] * 4 + [(None, None, True)] * 3, key=str)


def test_secret_scan(docs):
    assert by_row(secret_scan.report(docs), "n_assign", "n_access") == want(lambda t: ((t or "").count("token="), (t or "").count("AKIA")))
    assert secret_scan.redact(docs).count() == len(ROWS)


def test_toxicity(docs, spark):
    marks = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    assert by_row(toxicity.score(docs, toxicity.train(docs, marks)), "rejected") == want(lambda t: (False,))


def test_no_local_folder_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(Conf)

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_dir(Cluster())
