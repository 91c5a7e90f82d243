"""Queries that fit classifiers, in a session in which an earlier query has observed metrics."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from bidlens.catalog import ORACLES, QUERIES
from compare import check, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["hurdle_fit_predict", "hurdle_oof", "hurdle_one_split", "leaf_logistic",
                                  "leaf_logistic_one_split", "stack_fit", "stack_predict", "stack_refit_top",
                                  "rfe_single", "adversarial_validation"])
def test_classifiers_after_an_observation(spark, name):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 3}
    rows, _, problem = check(spark, FOLDER, name, QUERIES[name], ORACLES[name], duck(FOLDER))
    assert problem is None, problem
    assert rows > 0
