import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from delaystar.llm import fingerprints as fp
from tests.llm.helpers import documents, words

TEXTS = ["", " \n\t", "one", "one two three four", "one two three four five", "a b c d e f g h i j k",
         " ".join(f"w{i % 700}" for i in range(5000)), "é ß 中 😀 x\x0by z", " ".join(str(i * i) for i in range(300))]


def brute(text):
    """The fingerprint by plain loops."""
    w = words(text)
    if not w:
        return ""
    hashed = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in w]

    def chain(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little"), seed=seed)
        return seed - (1 << 64) if seed >> 63 else seed

    k = fp.WORDS_PER_SHINGLE
    all_hashes = [chain(hashed[i : i + k]) for i in range(len(hashed) - k + 1)] or [chain(hashed)]
    bins = {}
    for h in all_hashes:
        b = (h >> 64 - fp.BIN_BITS) + fp.BINS // 2
        bins[b] = min(bins.get(b, h), h)
    out = []
    for i in range(fp.BINS):
        start, stride = fp.cycle(i)
        j, t = i, 0
        while j not in bins:
            j, t = (start + t * stride) % fp.BINS, t + 1
        out.append(bins[j] & 255)
    return "".join(f"{int.from_bytes(bytes(out[8 * i : 8 * i + 8]), 'little'):016x}" for i in range(fp.BINS // 8))


def test_fingerprints_equal_plain_loops(spark):
    docs = documents(spark, list(enumerate(TEXTS)))
    got = docs.select("doc_id", fp.fingerprint_text(fp.fingerprint(F.col("text"))).alias("f")).collect()
    for r in got:
        assert r["f"] == brute(TEXTS[r["doc_id"]]), TEXTS[r["doc_id"]][:40]


def test_every_cycle_visits_all_bins():
    for i in range(fp.BINS):
        start, stride = fp.cycle(i)
        assert len({(start + t * stride) % fp.BINS for t in range(fp.BINS)}) == fp.BINS


@pytest.mark.parametrize("shared", [0, 100, 250, 400, 500])
def test_likeness_estimates_the_jaccard_similarity(spark, shared):
    rows = []
    for i in range(40):
        common = [f"c{i}_{j}" for j in range(shared)]
        rows.append((" ".join(common + [f"a{i}_{j}" for j in range(500 - shared)]), " ".join(common + [f"b{i}_{j}" for j in range(500 - shared)])))
    pairs = spark.createDataFrame(rows, "a string, b string")
    got = pairs.select(fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("s")).collect()
    sets = [[{tuple(words(t)[i : i + 5]) for i in range(496)} for t in r] for r in rows]
    truth = sum(len(a & b) / len(a | b) for a, b in sets) / len(sets)
    assert sum(r["s"] for r in got) / len(got) == pytest.approx(truth, abs=0.02)


def expected_next(rows):
    """doc_id descending, nulls last; the last is followed by the first."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return {r[0]: order[(i + 1) % len(order)][1] or "" for i, r in enumerate(order)}


@pytest.mark.parametrize("bucket_rows", [2000, 1])
def test_edited_texts_and_next_documents(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(fp, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(fp, "COARSE", 8)
    ids = [None, -5, 0, 1, 2, 3, 10, 1 << 60, 77, 78, 79, *range(1000, 1400, 3)]
    rows = [(d, None if d == 2 else "" if d == 3 else f"text é{d} " + "word😀 " * (i % 40)) for i, d in enumerate(ids)]
    following = expected_next(rows)
    got = fp.fingerprint_documents(documents(spark, rows, more="bucket own following")).collect()
    assert len(got) == len(rows)
    for r in got:
        own, nxt = dict(rows)[r["doc_id"]] or "", following[r["doc_id"]]
        n = len(own) // 3
        edited = own[: len(own) - n] + nxt[:n]
        assert r["n_chars"] == len(own)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (brute(own), brute(edited))


def test_a_hot_id_null_ids_and_an_outlier_share_no_large_bucket(spark, monkeypatch):
    """A third of all rows on one id, many without one, one far off: buckets stay near their size and the order is exact."""
    monkeypatch.setattr(fp, "BUCKET_ROWS", 20)
    monkeypatch.setattr(fp, "COARSE", 16)
    ids = [7] * 500 + [None] * 200 + [1 << 60] + [-(1 << 62)] + list(range(100, 900))
    rows = [(d, f"text number {i} of a table with hot ids") for i, d in enumerate(ids)]
    docs = documents(spark, rows)
    sizes = [r["count"] for r in docs.withColumn("b", fp.bucket_column(docs)).groupBy("b").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 100 and len(sizes) > 40

    def place(r):
        signed = xxhash.xxh64(r[1].encode(), seed=42).intdigest()
        return r[0] is None, -(r[0] or 0), signed - (1 << 64) * (signed >> 63)

    order = sorted(rows, key=place)
    following = {a[1]: b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}
    got = fp.with_next(docs.select("doc_id", "text"), fp.bucket_column(docs)).select("text", "following.text").collect()
    assert {r[0]: r[1] for r in got} == following


def test_one_row_is_followed_by_itself_and_no_rows_give_none(spark):
    row = fp.fingerprint_documents(documents(spark, [(4, "abcdefghi")])).collect()[0]
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefabc").hexdigest() and row["near_next"] == 1.0
    assert fp.fingerprint_documents(documents(spark, [])).count() == 0
    null = fp.fingerprint_documents(documents(spark, [(None, None)])).collect()[0]
    assert (null["n_chars"], null["fingerprint"], null["near_edited"]) == (0, "", 1.0)


def test_repeated_rows_follow_each_other(spark):
    rows = [(1, "x y z"), (1, "x y z"), (1, "x y z"), (0, "other words here")]
    got = fp.fingerprint_documents(documents(spark, rows)).collect()
    assert sorted(r["near_next"] for r in got if r["fingerprint"] == brute("x y z"))[1:] == [1.0, 1.0]


def test_no_python_runs_on_the_executors(spark):
    plan = fp.fingerprint_documents(documents(spark, [(1, "a b")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
