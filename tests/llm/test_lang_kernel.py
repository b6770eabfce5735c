import numpy as np
import pytest

from delaystar.llm import lang_kernel as lk
from delaystar.llm.tables import read_table
from tests.conftest import SMALL_SF
from tests.llm.helpers import documents

SF = SMALL_SF.replace("0.001", "0.01")


@pytest.fixture(scope="module")
def model(spark):
    return lk.train(read_table(spark, SF, "documents"))


def grams(text):
    """Distinct n-grams of the letter classes by plain loops."""
    table, classes = lk.letter_classes(), []
    for c in text.lower():
        k = int(table[ord(c)])
        if k or not classes or classes[-1]:
            classes.append(k)
    return {tuple(classes[i : i + n]) for n in lk.ORDERS for i in range(len(classes) - n + 1)}


@pytest.mark.parametrize("text", ["a", "Hello, World!", "déjà vu  --  Ñandú", "中文 text 中文", "  x  ", "ab" * 50])
def test_presence_equals_plain_loops(text):
    assert len(lk.presence(text)) == len(grams(text))


def test_kernel_equals_shared_over_root(model):
    texts = ["the words of this and that", "le la les des une", "der die das und nicht"]
    found = [lk.presence(t) for t in texts]
    bare = lk.fit(texts, ["a", "b", "c"])
    got = bare.kernel(found)
    for i, a in enumerate(texts):
        for j in range(3):
            b = min((t for t in texts), key=lambda t: abs(bare.kernel([lk.presence(t)])[0, j] - 1))
            ga, gb = grams(a), grams(b)
            assert got[i, j] == pytest.approx(len(ga & gb) / np.sqrt(len(ga) * len(gb)), abs=1e-5)


def gram_numbers(text):
    """Places of a text's n-grams in the table, by plain loops over their letter classes."""
    out, start = set(), 0
    for n in lk.ORDERS:
        for g in grams(text):
            if len(g) == n:
                out.add(start + sum(k * lk.CLASSES ** (n - 1 - i) for i, k in enumerate(g)))
        start += lk.CLASSES**n
    return out


@pytest.mark.parametrize("text", ["a", "Hello, World!", "d\u00e9j\u00e0 vu  --  \u00d1andu", "ab" * 50])
def test_presence_lists_the_same_grams(text):
    assert set(lk.presence(text).tolist()) == gram_numbers(text)


def test_predictions_equal_plain_loops(spark, model):
    docs = [r for r in read_table(spark, SF, "documents").collect() if len(r["text"] or "") < 3000][:40]
    texts = [r["text"] for r in docs] + ["of the and", "le la les"]
    got = lk.predict_languages(documents(spark, list(enumerate(texts))), model).collect()
    assert len(got) == len(texts)
    for r in got:
        own = gram_numbers(texts[r["doc_id"]])
        shared = [g for g in own if model.columns[g] >= 0]
        kernel = [sum(float(model.landmarks[model.columns[g], j]) for g in shared) / np.sqrt(len(own)) for j in range(model.landmarks.shape[1])]
        margins = [sum(k * float(w) for k, w in zip(kernel, model.weights[:-1, c], strict=True)) + float(model.weights[-1, c])
                   for c in range(len(model.languages))]
        best = max(range(len(margins)), key=margins.__getitem__)
        assert r["score"] == pytest.approx(min(max((margins[best] + 1) / 2, 0), 1), abs=1e-3)
        assert r["lang_pred"] == model.languages[best] or margins[best] - sorted(margins)[-2] < 1e-3


def test_held_out_accuracy(spark, model):
    docs = read_table(spark, SF, "documents")
    rows = lk.predict_languages(docs, model).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 150
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (4, "of the and"), (4, "of the and"), (None, "of the and"), (5, "z" * 2_000_000), (6, "中"), (7, "😀")]
    got = lk.predict_languages(documents(spark, rows, more="score lang_pred"), model).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1, 2, 3, 7))
    assert all(by[i]["lang_pred"] in model.languages for i in (4, 5, 6))
    assert len({(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (4, None)}) == 1
    assert by[None]["held_out"] is False


def test_no_languages_to_learn(spark):
    docs = documents(spark, [(1, "some text", None), (2, None, "en")])
    model = lk.train(docs)
    assert {(r["lang_pred"], r["score"]) for r in lk.predict_languages(docs, model).collect()} == {("und", 0.0)}
    assert lk.predict_languages(documents(spark, []), model).count() == 0


def test_one_language(spark):
    docs = documents(spark, [(i, "some text of words", "xx") for i in range(8)])
    assert {r["lang_pred"] for r in lk.predict_languages(docs, lk.train(docs)).collect()} == {"xx"}


def test_filter_keeps_columns_and_clean_documents(spark, model):
    docs = documents(spark, [(1, None), (2, "123"), (3, "the end of the thing and that"), (3, "the end of the thing and that")], more="accepted")
    kept = lk.keep_languages(docs, model)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [3, 3]
    all_docs = read_table(spark, SF, "documents")
    assert lk.keep_languages(all_docs, model).count() >= 0.98 * all_docs.count()
