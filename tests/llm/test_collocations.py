import random
import re
from collections import Counter

import numpy as np
import pytest

from delaystar.llm import collocations
from tests.llm.helpers import TO_LOWER, documents, duckdb_rows


def brute(rows, top, least, longest):
    """All phrases counted in dictionaries; drops by looking at every longer candidate."""
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(TO_LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for i in range(len(ws)):
                for m in range(1, longest + 1):
                    if i + m <= len(ws):
                        f[lang, tuple(ws[i : i + m])] += 1
    candidates = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    dropped = set()
    for (lang, p), a in candidates.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                inner = (lang, p[i:j])
                if j - i < len(p) and 100 * a >= 100 * candidates[inner]:
                    dropped.add(inner)
    out = {}
    for (lang, p), a in candidates.items():
        if (lang, p) not in dropped:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def corpus(seed, n=150, vocabulary=60):
    """Random words with planted phrases of many lengths and frequencies, in three languages."""
    rnd = random.Random(seed)
    vocab = ["Ab", "é", "x y", "\x00", "$(a)", *(f"w{i}" for i in range(vocabulary))]
    phrases = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(2, 8))) for _ in range(20)]
    weights = [1 / (k + 1) for k in range(len(phrases))]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(0, 25)):
            parts.append(rnd.choices(phrases, weights)[0] if rnd.random() < 0.5 else rnd.choices(vocab, [1 / (k + 1) for k in range(len(vocab))])[0])
            if rnd.random() < 0.2:
                parts.append(rnd.choice([". ", ",", "!\n", "\t", " ;", "\x0b", "  "]))
        rows.append((i, " ".join(parts), rnd.choice(["en", "en", "de", None, "und"])))
    return rows


@pytest.fixture(autouse=True)
def small_bitmaps(monkeypatch):
    monkeypatch.setattr(collocations, "HASH_BITS", (14, 16, 15))
    monkeypatch.setattr(collocations, "CHUNK", 1 << 13)


def got(spark, rows, top):
    return sorted(map(tuple, collocations.collocations(documents(spark, rows), top).collect()))


@pytest.mark.parametrize("seed, least, top, frontier", [(1, 3, 2000, 10**6), (2, 4, 7, 10**6), (3, 3, 5, 9)])
def test_equal_to_counting_every_phrase(spark, monkeypatch, seed, least, top, frontier):
    monkeypatch.setattr(collocations, "LEAST", least)
    monkeypatch.setattr(collocations, "FRONTIER", frontier)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 2000)
    rows = corpus(seed, n=100 if frontier < 10 else 150, vocabulary=20 if frontier < 10 else 60)
    want = brute(rows, top, least, collocations.LONGEST)
    assert len(want) > 8
    assert got(spark, rows, top) == want


def test_small_memory_and_colliding_bitmaps_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST", 3)
    monkeypatch.setattr(collocations, "BITS", 7)  # nearly every hash hits
    monkeypatch.setattr(collocations, "HASH_BITS", (7, 7, 7))
    monkeypatch.setattr(collocations, "HELD_WORDS", 30)
    monkeypatch.setattr(collocations, "HELD_COUNTS", 40)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 500)
    monkeypatch.setattr(collocations, "FRONTIER", 25)
    rows = corpus(5, n=80, vocabulary=20)
    assert got(spark, rows, 2000) == brute(rows, 2000, 3, collocations.LONGEST)


def test_frontier_stops_when_settled(spark, monkeypatch):
    """Rare pairs outrank all that common words can reach, so those are never expanded; equal bounds are."""
    monkeypatch.setattr(collocations, "LEAST", 4)
    monkeypatch.setattr(collocations, "FRONTIER", 1)
    rows = [(i, f"r{i % 5} s{i % 5}. " + "c d. " * 5, "en") for i in range(20)]  # r_k s_k 4 times each, c d 100 times
    bands = []
    expanded = collocations.expanded
    monkeypatch.setattr(collocations, "expanded", lambda d, band, *bits: (bands.append({r["phrase"] for r in band.collect()}), expanded(d, band, *bits))[1])
    assert got(spark, rows, 2) == brute(rows, 2, 4, collocations.LONGEST)
    assert bands == [{f"{x}{k}" for x in "rs" for k in range(5)}]  # all ties at once, c and d not at all
    bands.clear()
    assert got(spark, rows, 6) == brute(rows, 6, 4, collocations.LONGEST)
    assert bands[1:] == [{"c", "d"}]


def test_large_counts_stay_exact(spark):
    """A score whose product passes 64 bits."""
    a, n, part = 10**13, 9 * 10**14, 10**13 + 1
    candidates = spark.createDataFrame([("en", "a b", 2, a)], "lang string, phrase string, m int, a bigint")
    words = spark.createDataFrame([("en", "a", part), ("en", "b", part)], collocations.PHRASES)
    totals = spark.createDataFrame([("en", n)], "lang string, n bigint")
    row = collocations.survivors(documents(spark, []), candidates, candidates, words, totals, None).first()
    assert row["score"] == 1000 * a * n // part**2


def test_twin_equals_brute_force():
    import pandas as pd

    rows = corpus(8, n=400, vocabulary=15)
    frame = pd.DataFrame({"text": [r[1] for r in rows], "lang": [r[2] for r in rows]})
    names, found = duckdb_rows(collocations.oracle(), documents=frame)
    assert names == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, collocations.TOP, collocations.LEAST, collocations.LONGEST)
    assert len(want) > 5
    assert sorted(found) == want


def test_hashed_counts_reach_the_least_where_the_sum_does(spark, monkeypatch):
    """Of words that no task has often enough, and with counts beyond a byte."""
    monkeypatch.setattr(collocations, "LEAST", 40)
    rows = [(i, "a b " * 3 + f"u{i} " + "z " * 300 * (i == 0), "en") for i in range(14)]
    bitmaps = collocations.hashed_counts(documents(spark, rows).repartition(14))
    hashed = lambda p: _hash("en", p)
    want = {"a": True, "b": True, "u1": False, "z": True, "a b": True, "b a": False, "z z": True, "b u1": False,
            "a b a": False, "z z z": True}
    got = {p: bool(collocations.within(bitmaps[p.count(" ")], hashed(p))[0]) for p in want}
    assert got == want


def _hash(lang, phrase):
    x = np.array([collocations.seed(lang)])
    for w in phrase.split(" "):
        x = collocations.fold(x, np.array([collocations.xxhash.xxh3_64_intdigest(w.encode())], np.uint64))
    return x


def test_parts_of_long_texts_end_at_borders():
    text = b"aa bb cc dd ee. ff gg hh ii. jj. kk ll mm nn oo pp"
    parts = list(collocations._parts(text, 10))
    assert len(parts) > 2
    assert b"\n".join(parts) == text.replace(b".", b"\n")


def test_grouping_and_hashes():
    rows = np.random.default_rng(1).integers(0, 4, (300, 4)).astype(np.int32)
    order, starts = collocations.grouped(rows)
    counts = Counter(map(tuple, rows.tolist()))
    sizes = np.diff(np.r_[starts, len(rows)])
    assert {tuple(rows[order[s]].tolist()): int(n) for s, n in zip(starts, sizes, strict=True)} == counts


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST", 2)
    rows = [(None, None, None), (1, "", "en"), (2, "a b\na b", None), (2, "A\tB", "und"), (3, "a b", "en"), (4, " . ", "de"), (5, "c d " * 40_000, "fr")]
    docs = documents(spark, rows, more="phrase rank LENGTH")
    want = brute(rows, 2000, 2, collocations.LONGEST)
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == want
    assert {r[0] for r in want} == {"und", "fr"}
    assert got(spark, [], 5) == []
    assert got(spark, [(1, None, None), (2, "x", "en")], 5) == []
