"""The pipeline against its stages' brute-force versions, stage by stage."""

import corpus_pipeline
from muster.llm.common import documents
from test_contained import brute as contaminated
from test_lines import brute as cleaned
from test_near import brute as near
from test_packing import checked

SF = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark):
    docs = documents(spark, SF)
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = {r.doc_id: r.text for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_classifier", "line_dedup", "near_duplicates", "decontamination", "packing"]

    docs = steps["quality_classifier"](spark, docs, SF)
    kept = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert kept.items() <= rows.items()
    assert {d for d, x in labels.items() if x == (1, 0)} <= kept.keys()
    assert sum(d in kept for d, x in labels.items() if x != (1, 0)) <= 0.2 * sum(x != (1, 0) for x in labels.values())

    want = {d: t for d, t, *_ in cleaned(list(kept.items()))}
    docs = steps["line_dedup"](spark, docs, SF)
    got = docs.collect()
    assert {r.doc_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)

    want = {d: want[d] for d, _, _, stays in near(list(want.items()), width=5) if stays}
    want |= {r.doc_id: r.text for r in got if not r.text.split()}
    docs = steps["near_duplicates"](spark, docs, SF)
    assert {r.doc_id: r.text for r in docs.collect()} == want

    want = {d: want[d] for d, _, hit, _, _ in contaminated(list(want.items()), items) if not hit}
    docs = steps["decontamination"](spark, docs, SF)
    assert {r.doc_id: r.text for r in docs.collect()} == want and docs.columns == columns

    checked(steps["packing"](spark, docs, SF).collect(), list(want.items()), 2048)


def test_stages_take_empty_tables_nulls_and_repeated_rows(spark):
    schema = documents(spark, SF).schema
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "just a few words here", None, "s", 4)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert name == "packing" or docs.columns == schema.names
        assert {r.doc_id for r in docs.collect()} == {r[0] for r in rows}
