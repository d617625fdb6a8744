"""Keys made of stored pieces are many times their size, so that no join may send them to every task."""

from __future__ import annotations

from tributary.llm import line_dedup


def test_keys_of_pieces_are_not_broadcast(spark, table):
    long = "the same line of some length, told twice with one letter changed in it"
    docs = table("doc_id bigint, text string", [(1, long), (2, long.replace("told", "sold")), (3, "another\n" + long)])
    nearest = line_dedup.nearest_earlier(line_dedup.split_lines(docs, 1))
    plan = nearest._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 2
    found = {r.doc_id: r.removed for r in line_dedup.repeated_lines(docs).collect()}
    assert found == {1: [], 2: [0], 3: [1]}
