"""The stages together against a plain version of each, and the registry."""

from __future__ import annotations

import __spark_entry__ as entry
import numpy as np
import corpus_pipeline as P
from helpers import SF, docs_df, sf_table
from test_decontam import brute
from test_lines import brute_kept
from test_simhash import components, naive


from vigil.llm import queries
from vigil.llm.quality import QualityRules, measure


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(b["item_id"], b["text"]) for b in sf_table("benchmark")]
    for name, stage in P.STAGES:
        before = docs.orderBy("doc_id").collect()
        docs = stage(spark, docs, SF).cache()
        after = {r.doc_id: r for r in docs.collect()}
        if name != "best-fit packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality rules":
            assert set(after) == {r.doc_id for r, m in zip(before, measure([r.text for r in before], QualityRules())) if m[-1]}
        elif name == "line dedup":
            want, links = brute_kept([(r.doc_id, r.text) for r in before])
            lost = 0
            for r in before:
                kept = "\n".join(x for i, x in enumerate(r.text.split("\n")) if (r.doc_id, i) in want or not x.strip())
                lost += after[r.doc_id].text != kept
                assert after[r.doc_id].n_chars == len(after[r.doc_id].text)
            assert lost <= 0.02 * links
        elif name == "simhash near-dedup":
            u = components(np.array([naive(r.text) for r in before], np.uint64), 3)
            assert set(after) == {r.doc_id for i, r in enumerate(before) if u.find(i) == i}
        elif name == "benchmark decontamination":
            hit = {d for d, _ in brute([(r.doc_id, r.text) for r in before], items)}
            assert set(after) == {r.doc_id for r in before} - hit and hit
        else:
            assert set(after) == {r.doc_id for r in before}


def test_run_survives_odd_rows(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(50))
    rows = [(1, text), (2, text), (2, text), (None, text + " x"), (3, None), (4, "")]
    docs_df(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id for r in P.run(spark, str(tmp_path)).collect()}
    assert got == {1, 2, None}  # doc 2 stays with its lines taken by doc 1
    docs_df(spark, rows).limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_repeated_doc_ids_keep_every_text(spark):
    """One result for any order of the rows; no text of a doc_id is lost, none
    written twice."""
    a, b, c = (" ".join(f"{p}{i}" for i in range(60)) for p in ("alpha", "beta", "gamma"))
    rows = [(3, b), (5, a), (5, b), (7, c), (7, c), (9, a + "\n" + c), (9, "some line of its own here")]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        docs = docs_df(spark, order).repartition(3)
        got = sorted((r.doc_id, r.text) for r in P.near_dedup(spark, docs, SF).collect())
        assert got == sorted([(3, b), (5, a), (7, c), (9, a + "\n" + c), (9, "some line of its own here")])
        lines = sorted((r.doc_id, r.text) for r in P.line_dedup(spark, docs, SF).collect())
        # doc 5 holds a, doc 3 b, doc 7 c; doc 9 keeps only what it owns
        assert lines == sorted([(3, b), (5, a), (5, ""), (7, c), (7, c), (9, ""), (9, "some line of its own here")])


def test_one_query_per_operator():
    names = [n for n in entry.queries() if n in queries.REGISTRY]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(queries.ORACLE) <= set(queries.REGISTRY)


def test_oracles(spark):
    from oracle_compare import compare

    for name, sql in queries.ORACLE.items():
        assert compare(spark, name, queries.REGISTRY[name], sql, SF)["ok"], name
