import zlib

from delaystar.llm import labelled, lang_kernel
from delaystar.llm.labelled import class_sample, collected, fold
from tests.llm.helpers import documents


def test_sample_is_bounded_and_keeps_out_the_held_out_fold(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "IF(id % 10 = 0, 0, 1) AS quality")
    sample = class_sample(rows.where(fold(rows["doc_id"], 5) != 0), "quality", 300).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in sample)
    for q in (0, 1):
        assert sum(r["quality"] == q for r in sample) == 300


def test_one_id_on_most_rows_starves_no_class(spark):
    """Whatever its hash: every id in turn would be the first of its class."""
    small = [(k, lang) for n, lang in enumerate(("de", "es", "fr")) for k in range(1000 * n, 1000 * n + 300)]
    for hot in (5000, 5001, 5002):
        rows = spark.createDataFrame(small + [(hot, "en")] * 4000 + [(6000 + k, "en") for k in range(300)], "doc_id bigint, lang string")
        found = class_sample(rows, "lang", 100).collect()
        sizes = {lang: sum(r["lang"] == lang for r in found) for lang in ("en", "de", "es", "fr")}
        assert sizes == dict.fromkeys(sizes, 100)
        assert len({r["doc_id"] for r in found}) == 400
        again = class_sample(rows.repartition(7, "lang"), "lang", 100).collect()
        assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_classes_nulls_and_ids_of_two_classes(spark, monkeypatch):
    rows = [(None, "a"), (1, None), (2, "b"), (2, "a"), (3, "b"), (4, "b"), (5, "c"), (5, "c")]
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string")
    assert sorted(map(tuple, class_sample(frame, "lang", 10).collect())) == [(2, "a"), (3, "b"), (4, "b"), (5, "c")]
    monkeypatch.setattr(labelled, "MAX_CLASSES", 1)
    assert sorted(map(tuple, class_sample(frame, "lang", 10).collect())) == [(2, "b"), (3, "b"), (4, "b")]
    assert class_sample(frame.limit(0), "lang", 10).count() == 0


def test_one_text_of_each_id_is_collected(spark):
    rows = [(1, "x", "en"), (1, "y", "en"), (2, "z", "de")]
    texts = spark.createDataFrame(rows * 50, "doc_id bigint, text string, label string")
    one, two = (collected(t, "string", str.encode) for t in (texts, texts.repartition(5)))
    assert one == two and [lang for _, lang in one] == ["en", "de"]


def test_language_model_learns_all_languages_beside_a_hot_id(spark):
    texts = {"en": "the of and to in that", "de": "der die und das ist nicht", "fr": "le la les des et une"}
    rows = [(k * 3 + n, f"{t} {k}", lang) for k in range(60) for n, (lang, t) in enumerate(texts.items())]
    docs = documents(spark, rows + [(9999, "the of and to in", "en")] * 3000)
    model = lang_kernel.train(docs)
    assert model.languages == ("de", "en", "fr")
    again = lang_kernel.train(docs.repartition(3))
    assert (again.weights == model.weights).all()
