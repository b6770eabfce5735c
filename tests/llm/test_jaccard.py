import random

import pytest

from delaystar.llm import jaccard
from tests.llm.helpers import documents, jaccard_components


def got(rows_df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_df.collect()), key=repr)


def want(rows, width, num, den):
    found = jaccard_components(rows, width, num, den)
    return sorted(((rows[i][0], *found[i]) for i in found), key=repr)


def corpus(seed, n_base=12, copies=25, words=70):
    """Groups of near copies with 0 to 6 edits, exact copies, and texts around shared passages."""
    rnd = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for _ in range(n_base):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(3, words))]
        for _ in range(rnd.randint(0, copies)):
            w = list(base)
            for _ in range(rnd.randint(0, 6)):
                at = rnd.randrange(len(w))
                w[at : at + rnd.randint(0, 1)] = [rnd.choice(vocabulary)] * rnd.randint(0, 2)
            texts.append(" ".join(w))
        texts += [texts[-1]] * rnd.randint(0, 3) if texts else []
    for _ in range(30):
        own = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 12))]
        texts.append(" ".join(passage + own))
    texts += ["", " ", "one", "One", "one two", "ONE two", "a b c", "a b c d", "A B C D"]
    rnd.shuffle(texts)
    return list(enumerate(texts, 1000))


@pytest.mark.parametrize("seed, width, num, den", [(1, 4, 85, 100), (2, 5, 80, 100), (3, 1, 50, 100), (4, 4, 85, 100), (5, 3, 100, 100)])
def test_components_equal_comparing_all_pairs(spark, seed, width, num, den):
    rows = corpus(seed)
    assert got(jaccard.jaccard_components(documents(spark, rows), width, (num, den))) == want(rows, width, num, den)


@pytest.mark.parametrize("matches", [1, 6])
def test_the_number_of_matches_changes_nothing(spark, monkeypatch, matches):
    monkeypatch.setattr(jaccard, "MAX_MATCHES", matches)
    monkeypatch.setattr(jaccard, "PER_MATCH", 7)
    rows = corpus(9)
    assert got(jaccard.jaccard_components(documents(spark, rows))) == want(rows, 4, 85, 100)


def test_odd_rows(spark):
    long = " ".join(f"x{i % 5000}" for i in range(200_000))
    rows = [(5, None), (6, ""), (7, "\n"), (9, "a b"), (3, "A b"), (9, "a b"), (None, "q r s t u v"), (2, "q r s t u v"), (None, "alone"),
            (1, long), (4, long + " tail"), (8, "\u00c9 b"), (10, "\u00e9 b")]
    docs = documents(spark, rows, more="k n component_id")
    assert got(jaccard.jaccard_components(docs)) == want(rows, 4, 85, 100)


BASE = [f"w{i}" for i in range(100)]


def edited(*at):
    return " ".join("x" + w if i in at else w for i, w in enumerate(BASE))


#: Near copies with null ids: as the only bridge between 1 and 2, of 3, and of each other.
NULL_ID_NEAR_COPIES = [
    (2, edited(0, 99)), (None, edited(50)), (None, edited(50)), (1, edited(25, 50)),
    (3, "m " + " ".join(f"m{i}" for i in range(60))), (None, " ".join(f"m{i}" for i in range(60)) + " n"),
    *((None, " ".join(f"z{i}" for i in range(k, 80))) for k in range(3)), (None, "nothing like any other text here"),
]


def test_near_copies_with_null_ids_link_and_bridge(spark):
    rows = NULL_ID_NEAR_COPIES
    num, den = 87, 100
    without = want([r for r in rows if r[0] is not None], 4, num, den)
    assert {r[2] for r in without if r[0] in (1, 2)} == {1, 2}  # linked through the null id only
    assert {r[2] for r in want(rows, 4, num, den) if r[0] in (1, 2)} == {1}
    assert got(jaccard.jaccard_components(documents(spark, rows), 4, (num, den))) == want(rows, 4, num, den)


def test_stage_drops_near_copies_with_null_ids(spark):
    kept = jaccard.keep_one_per_group(documents(spark, NULL_ID_NEAR_COPIES), 4, (87, 100)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 3]
    assert sorted(r["text"][:1] for r in kept if r["doc_id"] is None) == ["n", "z"]


def test_hub_group_far_larger_than_its_links_is_whole(spark):
    """A large group of near copies whose members differ by more and more words."""
    base = [f"b{i}" for i in range(120)]
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        w = list(base)
        for k in range(rnd.randint(0, 5)):
            w[rnd.randrange(len(w))] = f"e{i}_{k}"
        rows.append((i, " ".join(w)))
    assert got(jaccard.jaccard_components(documents(spark, rows))) == want(rows, 4, 85, 100)


def test_chains_of_links_become_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 2000), (2000, 1500)], "a bigint, b bigint")
    roots = {r["k"]: r["root"] for r in jaccard.components(edges).collect()}
    assert roots == {i: 0 for i in range(301)} | {1000: 1000, 1500: 1000, 2000: 1000}


def test_empty_tables(spark):
    assert jaccard.jaccard_components(documents(spark, [])).count() == 0
    assert jaccard.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert jaccard.keep_one_per_group(documents(spark, [])).count() == 0


def test_stage_keeps_the_smallest_document_of_each_group(spark):
    rows = corpus(7)
    docs = documents(spark, rows, more="k place class_key")
    kept = jaccard.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    found = jaccard_components(rows, jaccard.STAGE_WIDTH, *jaccard.STAGE_SIMILARITY)
    expected = [rows[i][0] for i, (n, c) in found.items() if n == 0 or rows[i][0] == c]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)


def test_stage_with_repeated_and_null_ids(spark):
    copy = "the same six words as above here"
    rows = [(4, copy), (4, copy), (4, "entirely different words in this one text"), (9, copy), (None, copy), (None, "a text with no id at all here"),
            (None, "a text with no id at all here"), (5, None), (5, ""), (6, "  ")]
    kept = jaccard.keep_one_per_group(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], (r["text"] or "").strip()) for r in kept), key=repr) == sorted(
        [(4, copy), (4, "entirely different words in this one text"), (None, "a text with no id at all here"), (5, ""), (5, ""), (6, "")], key=repr
    )
