import hashlib
import random
import zlib

import numpy as np
import pytest

from delaystar.llm import periodic
from tests.llm.helpers import documents, words


def runs_by_comparing(ws):
    """Every run by comparing words q apart; a stretch counts for its smallest period only."""
    n, out = len(ws), {}
    for q in range(1, n // periodic.REPEATS + 1):
        s = None
        for i in range(n - q + 1):
            if i < n - q and ws[i] == ws[i + q]:
                s = i if s is None else s
            elif s is not None:
                if i + q - s >= max(periodic.LEAST, periodic.REPEATS * q):
                    out.setdefault((s, i + q - s), q)
                s = None
    return sorted((s, n, q) for (s, n), q in out.items())


def plant(ws, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(ws), h // 10
    if doc_id is None or h % 10 or not n:
        return list(ws)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[a + (i - a) % p] if i >= a else ws[i] for i in range(n)]


def brute_row(doc_id, text):
    ws = plant(words(text), doc_id)
    runs = runs_by_comparing(ws)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))


def texts(seed, n=120):
    """Random words over small alphabets, with powers, powers of powers and shared borders."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        letters = [f"w{i}" for i in range(rnd.choice([1, 2, 3, 30]))]
        ws = []
        for _ in range(rnd.randint(0, 6)):
            unit = [rnd.choice(letters) for _ in range(rnd.randint(1, 9))]
            if rnd.random() < 0.3:
                unit = (unit * rnd.randint(1, 5))[: rnd.randint(1, 40)] + [rnd.choice(letters)]
            ws += (unit * rnd.randint(1, 9))[: rnd.randint(1, 90)]
        out.append(rnd.choice([" ", "\n", "  "]).join(ws))
    return out


def fibonacci(k):
    a, b = ["x"], ["x", "y"]
    for _ in range(k):
        a, b = b, b + a
    return b


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_comparing_all_periods(seed):
    lists = [words(t) for t in texts(seed)] + [fibonacci(9), ["a"] * 50, ["a", "b"] * 40 + ["a"], []]
    numbers: dict = {}
    flat = np.array([numbers.setdefault(w, len(numbers)) for ws in lists for w in ws], np.int64)
    document, start, length, period = periodic.runs_of(flat, np.array([len(ws) for ws in lists]))
    for k, ws in enumerate(lists):
        own = document == k
        got = list(zip(start[own].tolist(), length[own].tolist(), period[own].tolist(), strict=True))
        assert got == runs_by_comparing(ws), ws


@pytest.mark.parametrize("seed", range(4))
def test_extensions_equal_word_by_word_comparison(seed):
    rnd = np.random.default_rng(seed)
    parts = [rnd.integers(0, k, n) for k, n in ((1, 40), (2, 300), (3, 200), (50, 400))] + [np.tile(rnd.integers(0, 3, 17), 20)]
    flat, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
    levels = periodic.grammar(flat, np.cumsum(sizes))
    assert len(levels[-1].symbols) == len(parts)
    back = periodic.mirrored(levels)
    for d, p in enumerate(parts):
        begin = int(sizes[:d].sum())
        i, j = np.sort(rnd.integers(0, len(p), (2, 500)), axis=0)
        i, j = i[i < j], j[i < j]
        got = periodic.extensions(levels, begin + i, begin + j, np.full(len(i), d))
        left = periodic.extensions(back, len(flat) - begin - j, len(flat) - begin - i, np.full(len(i), len(parts) - 1 - d))
        for x, y, r, le in zip(i, j, got, left, strict=True):
            want = next((k for k in range(len(p) - y) if p[x + k] != p[y + k]), len(p) - y)
            want_left = next((k for k in range(x) if p[x - 1 - k] != p[y - 1 - k]), x)
            assert (r, le) == (want, want_left)


def test_query_equals_brute_force(spark, monkeypatch):
    rows = list(enumerate(texts(11, 250), 1))
    want = sorted(brute_row(*r) for r in rows)
    assert sorted(map(tuple, periodic.periodic_runs(documents(spark, rows)).collect())) == want
    monkeypatch.setattr(periodic, "BLOCK_WORDS", 50)
    monkeypatch.setattr(periodic, "BLOCK_CANDIDATES", 7)
    assert sorted(map(tuple, periodic.periodic_runs(documents(spark, rows[:80])).collect())) == sorted(brute_row(*r) for r in rows[:80])


def test_whole_table_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted(brute_row(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    got = sorted(map(tuple, periodic.periodic_runs(docs).collect()))
    assert got == want
    assert sum(r[1] > 0 for r in got) > 5


def test_odd_rows(spark):
    long = " ".join(f"y{i % 7}" if i < 60_000 else f"z{i}" for i in range(120_000))
    rows = [(None, "a " * 8), (3, None), (4, ""), (5, " \n\t "), (6, "a a a a a"), (7, "é " * 6), (7, "é " * 6), (8, long)]
    got = {(r["doc_id"], r["n_runs"], r["start"], r["length"], r["period"]) for r in
           periodic.periodic_runs(documents(spark, rows, more="n_runs start Length"), plant=False).collect()}
    assert got == {(None, 1, 0, 8, 1), (3, 0, None, None, None), (4, 0, None, None, None), (5, 0, None, None, None),
                   (6, 0, None, None, None), (7, 1, 0, 6, 1), (8, 1, 0, 60_000, 7)}
    planted = periodic.periodic_runs(documents(spark, rows)).collect()
    assert len(planted) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r["runs_sha256"], r["collapsed_sha256"]) for r in planted if r["doc_id"] in (3, 4, 5)} == {(empty, empty)}
    assert periodic.periodic_runs(documents(spark, [])).count() == 0
