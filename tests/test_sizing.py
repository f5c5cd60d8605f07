"""What one task holds does not grow with the tables, whatever the session's number of partitions is."""

from __future__ import annotations

import re

from catalog import QUERIES
from conftest import rows_of
from tallywork.plans import commerce
from tallywork.sources.adapters import Feeds

ORDER = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


def orders(spark, folder, n):
    rows = spark.range(n).selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "elt(CAST(id % 3 AS int) + 1, 'F', 'O', 'P') AS o_orderstatus", "CAST(100 + id * 37 % 90000 AS double) AS o_totalprice",
        "timestamp_ntz'2000-01-01' + make_dt_interval(CAST(id % 700 AS int)) AS o_orderdate", "concat(CAST(id % 5 + 1 AS string), '-X') AS o_orderpriority",
    )
    rows.write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_parts_follow_the_files(spark, tmp_path):
    feeds = Feeds(spark, orders(spark, tmp_path, 3_000))
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert feeds.parts("orders") == own
    assert feeds.parts("orders", each=1_000) > 2 * own


def test_the_joins_of_a_restatement_are_dealt_by_the_size_of_the_orders(spark, tmp_path, monkeypatch):
    """Before, both runs met in as many tasks as the session has partitions, 923 MB each at 9 million orders and 12 partitions."""
    folder = orders(spark, tmp_path, 3_000)
    before = rows_of(QUERIES["restatement_bridge"](spark, folder))
    monkeypatch.setattr(Feeds, "parts", lambda self, table, each=0: 37)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = QUERIES["restatement_bridge"](spark, folder)
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        # Orders, payments and refunds of either run; shipping is pruned.
        assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+L, 37\)", plan)) == 6
        assert before and rows_of(dealt) == before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orders_in_parts_are_the_same_orders(spark, tmp_path):
    raw = Feeds(spark, orders(spark, tmp_path, 500)).raw("commerce")
    assert rows_of(commerce.int_orders_enriched(raw, 7)) == rows_of(commerce.int_orders_enriched(raw))


def test_a_line_match_reads_either_ledger_once_for_lines_and_once_for_incomplete_ones(spark, tmp_path):
    """Before, numbers, counts and classes each read the ledgers again: 14 scans for one match."""
    folder = orders(spark, tmp_path, 3_000)
    for name in ("ledger_match_lines", "ledger_match"):
        matched = QUERIES[name](spark, folder)
        assert matched.collect()
        final = matched._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("FileScan parquet") <= 4, name


def test_rows_that_repeat_an_id_share_its_partners_and_rows_without_one_have_none(frame):
    from datetime import date
    from decimal import Decimal

    from tallywork.operators import match_lines

    line = lambda i: (i, "a", Decimal("1.00"), date(2024, 1, 1))
    schema = "line_id long, key string, amount decimal(12,2), day date"
    got = match_lines(frame(schema, [line(1), line(1), line(None)]), frame(schema, [line(7), line(8), line(9)]), 2)
    left = rows_of(got.where("side = 'left' AND line_id = 1"), "matched_id", "match_class")
    # The place of the line without id comes first, and whoever stands there on the other side has no partner.
    assert len(left) == 4 and {k for _, k in left} == {"same_day"} and len({m for m, _ in left}) == 2
    assert rows_of(got.where("line_id IS NULL"), "side", "matched_id", "match_class") == [("left", None, "other_amount")]
    assert rows_of(got.where("side = 'right' AND matched_id IS NULL"), "match_class") == [("other_amount",)]
