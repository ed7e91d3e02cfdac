from __future__ import annotations

from isoframe.llm import skew


def test_common_keys_are_dealt_and_nothing_else_changes(spark):
    rows = spark.range(12000).selectExpr("IF(id % 3 = 0, 7L, IF(id % 3 = 1, id, NULL)) AS k", "concat('x', id % 5) AS t", "id AS part_of")
    others = spark.range(9000).selectExpr("id AS k", "concat('x', id % 5) AS t", "id * 2 AS value").where("k <> 7 OR t = 'x2'")
    for keys in (["k"], ["k", "t"]):
        for how in ("inner", "left_semi"):
            mine, plain = (f.select(sorted(f.columns)) for f in (skew.dealt_join(rows, others.drop(*{"k", "t"} - set(keys)), keys, how), rows.join(others.drop(*{"k", "t"} - set(keys)), keys, how)))
            assert mine.columns == plain.columns and mine.count() == plain.count() > 4000 / 5
            assert mine.exceptAll(plain).isEmpty() and plain.exceptAll(mine).isEmpty()
    assert skew.dealt_join(rows.limit(0), others.drop("t"), ["k"]).count() == 0
