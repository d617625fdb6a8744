"""Cases in which documents were lost, or clean ones marked."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.llm import line_dedup, simhash, toxicity


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_labels_of_absent_documents_use_up_no_sample(spark, docs):
    rows = [(i, f"plain words of row{i} all fair " + ("vilexq scumbag" if i % 5 == 0 else "and good")) for i in range(400)]
    labels = [(i, 1, int(i % 5 == 0)) for i, _ in rows] + [(10_000 + i, 1, i % 2) for i in range(4000)]
    table = _labels(spark, labels)
    model = toxicity.train(docs(rows), table, sample_rows=50)
    found = toxicity.with_score(docs(rows), model, "score").select("doc_id", "score").collect()
    assert {r.doc_id for r in found if r.score >= 0.5} == {i for i in range(0, 400, 5)}


def test_absent_or_one_sided_labels_mark_nothing(spark, docs):
    rows = [(i, f"plain words of row{i} all fair") for i in range(60)]
    for labels in ([(5000 + i, 1, i % 2) for i in range(300)], [(i, 1, 0) for i in range(60)], [(i, 1, 1) for i in range(60)]):
        table = _labels(spark, [*labels, (None, 1, 1), (3, 0, None)])
        assert toxicity.drop_toxic(docs(rows), table).count() == 60
    assert toxicity.score(docs([]), _labels(spark, [])).count() == 0


def test_groups_without_ids_are_kept_apart_and_linked(docs):
    rows = [(0, "a b c d e f g"), (None, None), (None, "")]
    assert sorted((r.doc_id is None, r.text or "") for r in simhash.keep_one(docs(rows)).collect()) == [
        (False, "a b c d e f g"), (True, ""),
    ]
    # Near copies without ids are one group too.
    text = " ".join(f"word{i}" for i in range(4000))
    near = text + " more"
    assert bin(simhash.fingerprint(text.encode(), 3) ^ simhash.fingerprint(near.encode(), 3)).count("1") <= 2
    assert simhash.keep_one(docs([(None, text), (None, near), (None, "else where and when")])).count() == 2
    assert [r.doc_id for r in simhash.keep_one(docs([(None, text), (7, near)])).collect()] == [7]


def test_lines_go_from_documents_with_clashing_columns(docs):
    rows = [(1, "first line of all\nshared line"), (2, "shared line\nother")]
    table = docs(rows)
    for name in ("removed", "_t", "_i", "_h", "_line", "_line1", "doc_id2"):
        table = table.withColumn(name, F.lit(name))
    found = line_dedup.repeated_lines(docs(rows))
    left = line_dedup.without_lines(table, found)
    assert left.columns == table.columns
    assert {r.doc_id: (r.text, r.removed, r._t) for r in left.collect()} == {
        1: ("first line of all\nshared line", "removed", "_t"), 2: ("other", "removed", "_t"),
    }
