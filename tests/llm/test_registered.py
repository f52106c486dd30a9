"""The registered queries of this subpackage: all there, those with SQL agree with it, columns as agreed."""

import re

import __spark_entry__ as driver
import pytest
from muster.llm.queries import QUERIES, SQL
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op2": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op3": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op5": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op6": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op7": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op8": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op9": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op11": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op12": {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
    "op13": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_all_queries_and_the_pipeline_are_registered():
    found = driver.queries()
    assert QUERIES.keys() <= found.keys() and "pipeline" in found
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert SQL.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", list(SQL))
def test_query_agrees_with_sql(spark, duck, name):
    count, difference = compare(QUERIES[name](spark, SF), duck, SQL[name])
    assert difference is None
    assert count > 0


@pytest.mark.parametrize("op", COLUMNS)
def test_columns(spark, op):
    (name,) = [n for n in QUERIES if n.startswith(f"{op}_")]
    kinds = dict(QUERIES[name](spark, SF).dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[op]} == COLUMNS[op]


@pytest.mark.parametrize("op", ["op3", "op10"])
def test_native_plans_have_no_python(spark, op):
    (name,) = [n for n in QUERIES if n.startswith(f"{op}_")]
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
