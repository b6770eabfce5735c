import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from delaystar.llm import mixing
from tests.llm.helpers import documents, duckdb_rows, words

ROWS = [
    (1, "a b c d", None, "s1"), (2, "a b", None, "s1"), (3, "x " * 50, None, "s2"), (4, None, None, "s2"), (5, "", None, "s3"),
    (6, "one two three", None, None), (6, "one two three", None, None), (None, "no id", None, "s1"), (8, "tie", None, "s4"),
    (8, "eit", None, "s4"), (9, "w " * 30_000, None, "S"), (10, "é b c", None, "s5"),
]


def brute_targets(sizes, weights, cap=3):
    """Reshare the excess by weight until no source is above its cap."""
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(cap * sizes[i] for i in capped)
        rest = sum(w for i, w in enumerate(weights) if i not in capped)
        target = [cap * s if i in capped else left * weights[i] / rest for i, s in enumerate(sizes)]
        over = {i for i, t in enumerate(target) if t > cap * sizes[i] + 1e-9} - capped
        if not over:
            return target
        capped |= over


def test_integrals_are_the_weights():
    assert [mixing.integrals(s)[-1] for s in mixing.SCHEDULES] == [5, 2, 1]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 5, 0, 7, 300], [5], [0, 0], [3, 0, 900, 2, 2, 2, 2]])
def test_targets_equal_repeated_resharing(spark, sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    rows = [(False, f"s{i:02d}", s) for i, s in enumerate(sizes)]
    frame = spark.createDataFrame(rows, "no_source boolean, source_key string, source_size bigint")
    got = [r["target"] for r in mixing.source_targets(frame).orderBy("source_key").collect()]
    assert got == pytest.approx(brute_targets(sizes, weights))


def test_plan_equals_the_sql_twin_on_odd_rows(spark):
    docs = documents(spark, ROWS, more="size Target bucket own")
    got = mixing.mix_digest(docs)
    frame = docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})
    frame["text"] = frame["text"].astype(object).where(frame["text"].notna(), None)
    names, want = duckdb_rows(mixing.oracle(), documents=frame)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=key) == sorted(want, key=key)


def test_taken_words_hit_the_targets_and_reruns_agree(spark):
    docs = documents(spark, [(i, "w " * (i % 37 + 1), None, f"s{i % 5}" if i % 3 else "hot") for i in range(600)])
    plan = mixing.plan_mix(docs).collect()
    by_source = {}
    for r in plan:
        assert r["size"] == len(words(r["text"])) and r["taken"] <= 3 * r["size"]
        assert list(r["positions"]) == sorted(r["positions"]) and all(0 <= p <= 1 for p in r["positions"])
        assert len(r["positions"]) == -(-r["taken"] // r["size"])
        target, taken = by_source.get(r["source"], (r["target"], 0))
        by_source[r["source"]] = (target, taken + r["taken"])
    assert all(abs(target - taken) <= 0.5 for target, taken in by_source.values())
    again = mixing.plan_mix(docs.repartition(7)).collect()
    assert sorted(plan, key=lambda r: r["doc_id"]) == sorted(again, key=lambda r: r["doc_id"])


def test_positions_follow_the_integrated_schedule(spark):
    """By time t a source has given its target times the share of its weight integral."""
    docs = documents(spark, [(i, "w w", None, "abc"[i % 3]) for i in range(3000)])
    rows = mixing.plan_mix(docs).collect()
    for s, name in enumerate("abc"):
        knots, due = mixing.SCHEDULES[s], mixing.integrals(mixing.SCHEDULES[s])
        at = sorted(p for r in rows if r["source"] == name for p in r["positions"])
        for k, (t, _) in enumerate(knots[1:-1], 1):
            assert sum(p <= t for p in at) / len(at) == pytest.approx(due[k] / due[-1], abs=0.01)


def test_training_order_is_sorted_and_keeps_columns(spark):
    docs = documents(spark, ROWS, more="position")
    planned = mixing.plan_mix(docs)
    rows = mixing.training_order(planned)
    assert rows.columns == docs.columns
    copies = {}
    for r in planned.collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + len(r["positions"])
    got = rows.collect()
    assert len(got) == sum(copies.values())
    firsts = {}
    for r in planned.collect():
        for p in r["positions"]:
            firsts.setdefault((r["doc_id"], r["text"]), []).append(p)
    for places in firsts.values():
        places.sort()
    flat = [firsts[r["doc_id"], r["text"]].pop(0) for r in got]
    assert flat == sorted(flat)


def test_pipeline_stage_keeps_columns_named_like_the_plan(spark):
    docs = documents(spark, ROWS, more="size Target source_size taken positions _size")
    docs = docs.withColumns({"size": F.col("n_chars") + 1, "Target": F.col("n_chars") + 2, "_size": F.col("n_chars") + 3})
    mixed = corpus_pipeline.mix(spark, docs, "")
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    plain = documents(spark, ROWS)
    assert [r["text"] for r in rows] == [r["text"] for r in corpus_pipeline.mix(spark, plain, "").collect()]
    assert all((r["size"], r["Target"], r["_size"]) == tuple(r["n_chars"] + i for i in (1, 2, 3)) for r in rows)
    assert {(r["source_size"], r["taken"], r["positions"]) for r in rows} == {(7, 7, 7)}


def test_empty_table(spark):
    docs = documents(spark, [])
    assert mixing.mix_digest(docs).count() == 0
    assert mixing.training_order(mixing.plan_mix(docs)).count() == 0


def test_a_hot_id_and_null_ids_are_spread_over_buckets(spark):
    """Texts that share an id, or have none, do not meet in one window; the words taken still meet the targets."""
    rows = [(1 if i % 3 == 0 else None if i % 3 == 1 else i, f"words of text {i} " * (1 + i % 4), None, "ab"[i % 2]) for i in range(1500)]
    docs = documents(spark, rows)
    planned = mixing.plan_mix(docs)
    got = planned.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 1 for r in got)
    keys = docs.select(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text")).substr(1, mixing.BUCKET_DIGITS).alias("b"))
    assert keys.groupBy("b").count().agg(F.max("count")).first()[0] <= 8
