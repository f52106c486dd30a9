"""Tables made from lines and orders, alone and in a run that joins the two once."""

from helpers import plan, rows, ts

from muster.gallery.stand_in import Domain
from muster.sources.tables import Catalog

LINE_TABLES = "training_need document_uploads compliance_trends planning_history debriefing appraisal berths_snapshot".split()


def given(spark) -> Catalog:
    lines = [(1, 10, 3, 1, 5.0, ts("1998-01-01")), (1, 10, 3, 1, 5.0, ts("1998-01-01")), (1, None, 4, 2, 20.0, None),
             (2, 11, None, 3, None, ts("1997-12-20")), (None, 12, 5, 4, 1.0, ts("1998-01-02")), (9, 13, 6, 5, 2.0, ts("1998-01-03"))]
    orders = [(1, 7, ts("1997-11-01")), (2, None, ts("1997-12-01")), (2, 8, None), (None, 9, ts("1997-12-01")), (3, 9, ts("1997-12-02"))]
    return Catalog(
        spark,
        lineitem=spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz"),
        orders=spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
    )


def test_a_run_joins_lines_with_orders_once(spark):
    alone = Domain(given(spark))
    domain = Domain(given(spark))
    scope = domain.run()
    try:
        for name in LINE_TABLES:
            assert scope[name].schema.names == alone[name].schema.names
            assert [f.dataType for f in scope[name].schema] == [f.dataType for f in alone[name].schema]
            assert rows(scope[name]) == rows(alone[name]), name
            assert "Join" in plan(alone[name]) and "Join" not in plan(scope[name]), name
        assert alone["training_need"].count() == 5  # twice the same line, a line without part, one line of two orders
        assert rows(scope["orders"]) == rows(alone["orders"])
    finally:
        scope.close()
