import zlib

import numpy as np
import pytest

from delaystar.llm import byte_cnn
from delaystar.llm.tables import read_table
from tests.conftest import SMALL_SF
from tests.llm.helpers import documents


@pytest.fixture(scope="module")
def net(spark):
    sf = SMALL_SF.replace("0.001", "0.01")
    return byte_cnn.train(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 511, 512, 513, 992, 993, 5000])
def test_chunks_cover_every_byte_and_overlap(n):
    raw = bytes(i % 251 for i in range(n))
    found = byte_cnn.chunks(raw)
    step = byte_cnn.CHUNK - byte_cnn.OVERLAP
    flat = np.concatenate([found[0], *(c[byte_cnn.OVERLAP :] for c in found[1:])])
    assert flat[:n].tolist() == list(raw) and (flat[n:] == byte_cnn.PAD).all()
    assert len(found) == 1 or (len(found) - 1) * step + byte_cnn.OVERLAP < n  # no chunk without bytes of its own


def test_convolution_equals_the_sum_of_products(net):
    block = byte_cnn.chunks(b"The quick brown fox. " * 40)
    embedded = net.embed[block.astype(int)]
    fast = byte_cnn.convolve(net.tables(), block)
    for p in (0, 3, byte_cnn._POSITIONS - 1):
        window = embedded[:, p * byte_cnn.STRIDE : p * byte_cnn.STRIDE + byte_cnn.WIDTH]
        assert fast[:, p] == pytest.approx(np.einsum("nke,kef->nf", window, net.filters), abs=1e-3)


def score_by_loops(net, text):
    """The whole score of a text by loops over its chunks, positions, taps and layers."""
    raw = list(text.encode())
    step = byte_cnn.CHUNK - byte_cnn.OVERLAP
    logits, at = [], 0
    while at == 0 or at + byte_cnn.OVERLAP < len(raw):
        chunk = raw[at : at + byte_cnn.CHUNK]
        chunk += [byte_cnn.PAD] * (byte_cnn.CHUNK - len(chunk))
        best = None
        for p in range(0, byte_cnn.CHUNK - byte_cnn.WIDTH + 1, byte_cnn.STRIDE):
            response = sum(net.embed[chunk[p + k]] @ net.filters[k] for k in range(byte_cnn.WIDTH))
            best = response if best is None else np.maximum(best, response)
        hidden = np.maximum(np.maximum(best + net.bias, 0) @ net.hidden + net.hidden_bias, 0)
        logits.append(float(hidden @ net.out + net.out_bias[0]))
        at += step
    return 1 / (1 + np.exp(-np.clip(sum(logits) / len(logits), -30, 30)))


def test_scores_of_whole_texts_equal_plain_loops(spark, net):
    texts = ["", "short", "The word \u00e9 and others. " * 60, "x#*$ " * 300, "a\n" * 700 + "tail"]
    docs = documents(spark, list(enumerate([*texts, None])))
    got = {r["doc_id"]: r["score"] for r in byte_cnn.score_documents(docs, net).collect()}
    for i, text in enumerate([*texts, ""]):
        assert got[i] == pytest.approx(score_by_loops(net, text), abs=1e-3)


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    small = byte_cnn.fit(["clean words here " * 30, "bad&&& bad%%% " * 30] * 4, [1, 0] * 4)
    block, y, w = byte_cnn.chunks(b"some bad&&& and clean words " * 60), np.array([1.0, 0, 1, 0]), np.ones(4)
    block = block[:4]

    def loss():
        z = small.logits(block, small.tables().astype(np.float64))
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    found = byte_cnn._gradients(small, block, y, w)
    for name in ("out", "hidden", "hidden_bias", "bias"):
        values = getattr(small, name)
        at = tuple(rng.integers(s) for s in values.shape)
        keep = values[at]
        values[at] = keep + 1e-4
        up = loss()
        values[at] = keep - 1e-4
        down = loss()
        values[at] = keep
        assert found[name][at] == pytest.approx((up - down) / 2e-4, abs=2e-3)


def test_held_out_accuracy(spark, net):
    sf = SMALL_SF.replace("0.001", "0.01")
    scored = byte_cnn.score_documents(read_table(spark, sf, "documents"), net)
    rows = scored.where("held_out").join(read_table(spark, sf, "labels"), "doc_id").collect()
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.9
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.95


def test_odd_rows_have_scores_and_equal_texts_equal_scores(spark, net):
    rows = [(1, None), (2, ""), (3, "x"), (4, "same text"), (4, "same text"), (None, "same text"), (7, "y" * 3_000_000), (8, "\x00퟿")]
    got = byte_cnn.score_documents(documents(spark, rows, more="score held_out"), net).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert len({round(r["score"], 6) for r in got if r["doc_id"] in (4, None)}) == 1
    assert got[0]["score"] == pytest.approx(got[1]["score"])


def test_without_two_classes_the_score_is_the_share(spark):
    docs = documents(spark, [(i, "a b") for i in range(20)])
    labels = lambda q: spark.createDataFrame([(i, q, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in byte_cnn.score_documents(docs, byte_cnn.train(docs, labels(0))).collect()} == {0.0}
    none = byte_cnn.train(docs, labels(1).limit(0))
    assert {r["score"] for r in byte_cnn.score_documents(docs, none).collect()} == {1.0}
    assert byte_cnn.score_documents(documents(spark, []), none).count() == 0


def test_training_collects_a_bounded_number_of_chunks(spark, monkeypatch):
    rows = [(i, f"text {i} " * 20_000) for i in range(20)] + [(7, f"{k} " * 30) for k in range(300)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    seen = []
    monkeypatch.setattr(byte_cnn, "fit_chunks", lambda blocks, y: seen.append((len(blocks), len(y), max(map(len, blocks)))))
    byte_cnn.train(documents(spark, rows), labels)
    n = sum(zlib.crc32(str(i).encode()) % byte_cnn.FOLDS != byte_cnn.HELD_OUT for i in range(20))
    assert seen == [(n, n, byte_cnn.CHUNKS_PER_DOCUMENT + byte_cnn.CROPS_PER_DOCUMENT)]
