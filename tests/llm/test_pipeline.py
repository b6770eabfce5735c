"""The pipeline against a version of plain loops that uses the same trained models."""

import hashlib
import shutil

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from delaystar.llm import lang_kernel, mixing, quality_rules
from delaystar.llm.tables import read_table
from tests.conftest import SMALL_SF
from tests.llm.helpers import documents, duckdb_rows, jaccard_components


def brute(spark, docs, sf_dir):
    rows = [r.asDict() for r in docs.collect()]
    model = lang_kernel.train(docs)
    names, scores = model.predict([r["text"] for r in rows])
    rows = [r for r, n, s in zip(rows, names, scores, strict=True) if n != "und" and s >= lang_kernel.MIN_SCORE]
    left = spark.createDataFrame([tuple(r.values()) for r in rows], docs.schema)
    forest = quality_rules.train(left, read_table(spark, sf_dir, "labels"))
    kept = quality_rules.judge([r["text"] for r in rows], forest)["kept"] if rows else []
    rows = [r for r, k in zip(rows, kept, strict=True) if k]
    found = jaccard_components([(r["doc_id"], r["text"]) for r in rows], 5, 80, 100)
    rows = [r for i, r in enumerate(rows) if found[i][0] == 0 or found[i][1] == r["doc_id"]]
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], docs.schema).select("doc_id", "text", "source").toPandas()
    columns, plan = duckdb_rows(mixing.oracle(), documents=frame)
    plan = {r[columns.index("doc_id")]: dict(zip(columns, r, strict=True)) for r in plan}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for r in rows:
        p = plan[r["doc_id"]]
        ids = library.encode(r["text"], add_special_tokens=False).ids
        made = (r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest())
        out += [made] * -(-p["taken"] // max(p["size"], 1))
    return sorted(out)


def test_run_equals_plain_loops(spark):
    docs = read_table(spark, SMALL_SF, "documents")
    got = sorted(map(tuple, corpus_pipeline.run(spark, SMALL_SF).collect()))
    assert got == brute(spark, docs, SMALL_SF)


def test_stages_keep_the_columns_and_clean_documents(spark):
    docs = read_table(spark, SMALL_SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, SMALL_SF).cache()
        assert docs.columns == columns, name
        if name == "language_id":
            assert docs.count() >= 0.97 * before


def test_odd_rows_pass_through_all_stages(spark, tmp_path):
    """Held against the plain loops: nulls, empty texts, repeated rows, clashing columns, no labels."""
    said = "the word that {} gives to this and those of many others is never the same as before {}"
    clean = [(10 + k, said.format(f"writer{k}", " ".join(f"name{k}x{i}" for i in range(8))), "en", "a" if k % 2 else None) for k in range(12)]
    rows = [(1, None, None, None), (2, "", "en", "a"), (2, "", "en", "a"), (None, "words " * 20, None, "b"), (9, "12 34", "en", "b"), *clean]
    for name, table in (("documents", documents(spark, rows, more="kept position k size target")),
                        ("labels", spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = read_table(spark, str(tmp_path), "documents")
    got = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(brute(spark, docs, str(tmp_path)), key=repr)
    assert len(got) > 5 and {r[0] for r in got} < set(range(10, 22))  # the mix takes less of the second source than it has
    shutil.rmtree(tmp_path / "documents.parquet")
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)
