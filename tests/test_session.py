import os

import pytest

from bidlens.session import cut_lineage, settled, shared_dir


def folders(spark):
    return {os.path.join(d, n) for d, _, names in os.walk(shared_dir(spark).removeprefix("file:")) for n in names if n.startswith("part-")}


def test_settled_steps_leave_their_result_alone(spark):
    before = folders(spark)

    def inner():
        one = cut_lineage(spark.range(100), "one")
        return settled(spark, lambda: cut_lineage(one.filter("id % 2 = 0"), "two").union(one), "inner")

    def outer():
        part = inner()
        assert part.count() == 150
        return cut_lineage(part.groupBy("id").count(), "three").filter("count = 2")

    found = settled(spark, outer, "outer")
    assert found.count() == 50 and found.schema.names == ["id", "count"]
    left = folders(spark) - before
    assert left and all("/outer-" in f and "-steps" not in f for f in left)
    with pytest.raises(ValueError):
        settled(spark, lambda: int(cut_lineage(spark.range(5)).count() and "x"), "failed")
    assert folders(spark) - before == left
    assert all("failed" not in f and "-steps" not in f for f in folders(spark))
    assert cut_lineage(spark.range(3)).count() == 3
