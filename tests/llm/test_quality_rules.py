import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from delaystar.llm import quality_rules as q
from delaystar.llm.tables import read_table
from tests.conftest import SMALL_SF
from tests.llm.helpers import documents, words

SF = SMALL_SF.replace("0.001", "0.01")
ODD = ["", " \n\t ", "a b c d e a b c d e", "x\x1cy \x85 z\xa0q", "a\n\n a\na\n a", "aa " * 60, "\n".join(["same line here"] * 9), "#*$%&|<> ##", "\u00e9" * 9]


@pytest.fixture(scope="module")
def forest(spark):
    return q.train(read_table(spark, SF, "documents"), read_table(spark, SF, "labels"))


def brute(text):
    w = words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


@pytest.mark.parametrize("text", ODD)
def test_statistics_equal_plain_loops(text):
    assert q.statistics(text)[0] == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "\n", "#", "\x0b", "\x85", "\u00e9"]), max_size=60).map(" ".join))
def test_statistics_equal_plain_loops_on_random_texts(text):
    assert q.statistics(text)[0] == brute(text)


def test_hash_candidates_are_checked_against_the_words():
    w = [b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h"]
    assert q.repeat_words(w, np.zeros(len(w), np.uint64)) == 0  # all windows collide, none is equal


def test_rows_on_whole_table_and_odd_rows(spark, forest):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (51, "rep " * 400_000), (52, "w x"), (52, "w x"), (None, "y")]
    table = documents(spark, rows, more="kept score n_words")
    for docs, texts in ((table, rows), (read_table(spark, SF, "documents"), None)):
        texts = texts or [tuple(r) for r in docs.select("doc_id", "text").collect()]
        got = sorted((tuple(r)[:7] for r in q.judge_documents(docs, forest).collect()), key=repr)
        want = []
        for doc_id, text in texts:
            b = brute(text)
            want.append((doc_id, *b, b[0] < 10 or 100 * b[4] > 20 * b[0]))
        assert got == sorted(want, key=repr)
    assert all(not (r["base_failed"] and r["kept"]) for r in q.judge_documents(table, forest).collect())


def test_constraints_hold_on_every_path(forest):
    rng = np.random.default_rng(4)
    scale = np.array([8, 8, 1, 1, 1, 1, 1, 1, 1, 1.0])
    base = rng.random((400, len(q.FEATURES))) * scale
    for f, (name, direction) in enumerate(q.FEATURES):
        if direction:
            grid = []
            for v in np.linspace(0, 1.2, 25):
                x = base.copy()
                x[:, f] = v
                grid.append(forest.score(x))
            assert (np.diff(np.array(grid), axis=0) * direction >= -1e-12).all(), name


def test_flat_nodes_score_like_walking_the_trees(forest):
    rng = np.random.default_rng(0)
    x = rng.random((50, len(q.FEATURES))) * 3

    def walk(row):
        total = forest.base
        for node in forest.roots:
            while forest.left[node] != node:
                node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
            total += forest.value[node]
        return 1 / (1 + np.exp(-total))

    assert forest.score(x) == pytest.approx([walk(r) for r in x])


def features_by_loops(text):
    """The feature vector by counting characters, words and lines one by one."""
    n_words, word_chars, n_symbols, n_dup, n_repeat = brute(text)
    ws = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    n, raw = max(n_words, 1), text.encode()
    same = 0
    for a, b in zip(ws, ws[1:], strict=False):
        same += a == b
    return [np.log1p(n_words), word_chars / n, n_symbols / n, n_dup / max(len(lines), 1), n_repeat / n, same / n,
            sum(c == "!" for c in text) / n, sum("A" <= c <= "Z" for c in text) / max(len(raw), 1), len(set(ws)) / n,
            sum("0" <= c <= "9" for c in text) / max(len(raw), 1)]


@pytest.mark.parametrize("text", ["", " \n ", "One two two three! 4 five\nOne\nOne\n", "\u00c9t\u00e9 A1 B2 B2 #% " * 9, "a b c d e f " * 7 + "!!\n\nx\nx"])
def test_features_equal_plain_loops(text):
    assert q.statistics(text)[1] == pytest.approx(features_by_loops(text))


def test_held_out_accuracy(spark, forest):
    from delaystar.llm.labelled import fold

    labels = read_table(spark, SF, "labels")
    held = labels.where(fold(labels["doc_id"], q.FOLDS) == q.HELD_OUT)
    rows = q.judge_documents(read_table(spark, SF, "documents"), forest).join(held, "doc_id").where("NOT base_failed").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in rows]) >= 0.97


def test_no_labels_leaves_the_base_rules(spark):
    docs = documents(spark, [(1, " ".join(f"w{i}" for i in range(30))), (2, "short")], more="kept")
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    forest = q.train(docs, empty)
    kept = q.keep_documents(docs, forest)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1]
    assert q.judge_documents(documents(spark, []), forest).count() == 0


def test_a_repeated_labelled_id_gives_one_training_row(spark, monkeypatch):
    rows = [(i, f"text number {i} of a few words") for i in range(40)] + [(7, f"{k} " * 30) for k in range(500)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    seen = []
    monkeypatch.setattr(q, "grow", lambda x, y: seen.append((x.tolist(), y.tolist())))
    q.train(documents(spark, rows), labels)
    q.train(documents(spark, rows[::-1]).repartition(3), labels)
    assert len(seen[0][1]) == sum(zlib.crc32(str(i).encode()) % q.FOLDS != q.HELD_OUT for i in range(40))
    assert seen[0] == seen[1]
