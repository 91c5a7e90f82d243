"""Queries that fit models. Parameters are small; every fit sees the whole table."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import FMRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from bidlens.catalog.base import query, r, rounded
from bidlens.catalog.encoding import hash_fold
from bidlens.catalog.scoring import score_sql
from bidlens.catalog.tables import Tables
from bidlens.functions import metrics
from bidlens.operators import (boost, cv, eliminate, hurdle, leaves, mixed, queue, sampling, stack)
from bidlens.session import cut_lineage

FEATURES = ("requestion_num", "user_num", "rival_epcm", "rival_max_epcm", "rival_pctr", "rival_q_epcm",
            "rival_filter_rate", "rival_num")
DOC_FEATURES = ("n_chars", "f7", "f11")


def regress_table(t: Tables):
    """Ad days with their statistics, exposure label, unique row number and fold."""
    log = t.staged_log()
    rows = queue.label_join(queue.ad_day_request_stats(log), queue.label_counts(queue.exposed_ad(log)))
    day = F.date_diff("days", F.lit("2019-04-01").cast("date"))
    rows = rows.withColumns({"row": F.col("ad_id") * 100 + day, "Y": F.col("Y").cast("double")})
    return cut_lineage(sampling.assign_folds(rows, "row"), "regress")


def class_table(t: Tables):
    rows = t.view("labelled").withColumn("label", F.col("quality").cast("double"))
    return cut_lineage(sampling.assign_folds(rows, "doc_id", how="stratified", label="label"), "classes")


def gbt(depth: int = 4, rounds: int = 5) -> GBTRegressor:
    return GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=0.3, minInstancesPerNode=30, seed=2019,
                        subsamplingRate=0.8, featureSubsetStrategy="0.8")


def gbt_class() -> GBTClassifier:
    return GBTClassifier(maxIter=4, maxDepth=3, seed=2019)


# One feature and no penalty: each fold model is a least-squares line, which SQL can fit as well.
LINES = f"""
rows as (select d.ad_id * 100 + date_diff('day', date '2019-04-01', d.days) as row, cast(requestion_num as double) as x,
  cast(coalesce(l.y, 0) as double) as y from ad_days d left join day_labels l on d.ad_id = l.ad_id and d.days = l.days),
folded as (select *, {hash_fold('row', 5)} as fold from rows),
lines as (select k.fold, regr_slope(f.y, f.x) as slope, regr_intercept(f.y, f.x) as base
  from (select distinct fold from folded) k join folded f on f.fold <> k.fold group by k.fold),
oof as (select f.*, base + slope * x as p from folded f join lines l on f.fold = l.fold)"""
LINE_VIEWS = ["ad_days", "day_labels"]

# What SQL can say about fits it cannot repeat: every row is there once with its label, and what holds for its prediction.
REGRESS = """select d.ad_id * 100 + date_diff('day', date '2019-04-01', d.days) as row, cast(coalesce(l.y, 0) as double) as "Y", d.days
  from ad_days d left join day_labels l on d.ad_id = l.ad_id and d.days = l.days"""
ALL_ROWS = f'select row, "Y", true as held from ({REGRESS})'
LATE_ROWS = ALL_ROWS + " where days >= date '2019-04-22'"
CLASSES = "select doc_id, cast(quality as double) as label, true as held from labelled"


def held(rows, holds, *columns):
    """The columns and whether ``holds`` is true of the row."""
    return rows.select(*columns, F.coalesce(holds, F.lit(False)).alias("held"))


def finite(name: str):
    return F.col(name).isNotNull() & ~F.isnan(name)


def share(name: str):
    return F.col(name).between(0, 1)



def line_folds(t: Tables):
    rows = regress_table(t)
    return rows, cv.kfold_oof(rows, cv.Learner(LinearRegression(solver="normal"), ("requestion_num",)), "Y")


@query("kfold_oof", f"with {LINES} select row, fold, {r('y', 'Y', 4)}, {r('p', 'prediction_oof', 4)} from oof", LINE_VIEWS)
def kfold_oof(spark, folder):
    return rounded(line_folds(Tables(spark, folder))[1].oof.select("row", "fold", "Y", "prediction_oof"), 4)


@query("fold_average", f"""
with {LINES} select row, {r('avg(base + slope * x)', 'model_predict', 4)} from folded, lines group by row""", LINE_VIEWS)
def fold_average(spark, folder):
    rows, folds = line_folds(Tables(spark, folder))
    return rounded(folds.predict(rows).select("row", "model_predict"), 4)


@query("kfold_scores", f"""
with {LINES}, s as (select fold, {score_sql('y', 'p')} as s from oof group by fold), t as (select {score_sql('y', 'p')} as s from oof)
select {r('avg(s.s)', 'mean_score', 4)}, {r('stddev_pop(s.s)', 'std_score', 4)}, {r('max(t.s)', 'total_score', 4)} from s, t""", LINE_VIEWS)
def kfold_scores(spark, folder):
    return rounded(line_folds(Tables(spark, folder))[1].scores(metrics.exposure_score), 4)


@query("gbt_kfold", LATE_ROWS, LINE_VIEWS)
def gbt_kfold(spark, folder):
    rows = regress_table(Tables(spark, folder))
    train, valid = rows.filter("days < date '2019-04-22'"), rows.filter("days >= date '2019-04-22'")
    folds = cv.kfold_oof(train, cv.Learner(gbt(), FEATURES), "Y")
    scores = folds.eval_scores(valid, metrics.exposure_score)
    mean_score = scores.agg(F.avg("score")).scalar()
    rows = folds.predict(valid).withColumn("valid_score", mean_score)
    return held(rows, finite("model_predict") & F.col("valid_score").between(50, 90), "row", "Y")


@query("importance_sum", " union all ".join(f"select '{c}' as feature, true as held, cast(5 as double) as total" for c in FEATURES))
def importance_sum(spark, folder):
    folds = cv.kfold_oof(regress_table(Tables(spark, folder)), cv.Learner(gbt(), FEATURES), "Y")
    found = folds.importances(spark)
    total = F.round(F.lit(found.agg(F.sum("importance")).head()[0]), 6)
    return held(found.withColumn("total", total), F.col("importance") >= 0, "feature", "total")


@query("hurdle_fit_predict", ALL_ROWS, LINE_VIEWS)
def hurdle_fit_predict(spark, folder):
    rows = regress_table(Tables(spark, folder))
    fitted = hurdle.hurdle_fit(rows, cv.Learner(LogisticRegression(maxIter=20), FEATURES),
                               cv.Learner(LinearRegression(regParam=0.1), FEATURES), "Y", 60)
    over = F.col("probability_mean") > fitted.threshold
    return held(fitted.predict(rows), finite("model_predict") & share("probability_mean") & (over | (F.col("model_predict") == 0)),
                "row", "Y")


@query("hurdle_oof", ALL_ROWS, LINE_VIEWS)
def hurdle_oof(spark, folder):
    rows = regress_table(Tables(spark, folder))
    fitted = hurdle.hurdle_fit(rows, cv.Learner(LogisticRegression(maxIter=20), FEATURES),
                               cv.Learner(LinearRegression(regParam=0.1), FEATURES), "Y", 60)
    over = F.col("probability_oof") > fitted.threshold
    return held(fitted.oof, finite("prediction_oof") & (over | (F.col("prediction_oof") == 0)), "row", "Y")


@query("leaf_logistic", CLASSES, ["labelled"])
def leaf_logistic(spark, folder):
    rows = class_table(Tables(spark, folder))
    learners = [cv.Learner(gbt_class(), DOC_FEATURES),
                cv.Learner(RandomForestClassifier(numTrees=4, maxDepth=3, seed=3), DOC_FEATURES[:2])]
    model = leaves.leaf_logistic(rows, learners, "label")
    found = model.predict(rows, keep_label=True)
    return held(found, share("model_predict") & ((F.col("model_predict") > 0.5).cast("double") == F.col("label_predict")), "doc_id", "label")


@query("multi_tree_leaves", f"select row, true as held from ({REGRESS})", LINE_VIEWS)
def multi_tree_leaves(spark, folder):
    rows = regress_table(Tables(spark, folder))
    trees = leaves.multi_tree_leaves(rows, [cv.Learner(gbt(3, 3), FEATURES[:4]), cv.Learner(gbt(4, 3), FEATURES[4:])], "Y")
    inside = F.transform("leaves", lambda v, i: v.between(i * trees.num_leaves, (i + 1) * trees.num_leaves - 1))
    found = trees.apply(rows).withColumn("inside", inside)
    return held(found, (F.size("inside") == sum(trees.trees)) & ~F.array_contains("inside", False), "row")


@query("leaf_offset_encode", """
select l_orderkey, l_partkey, l_suppkey, [cast(l_linenumber as int), cast(l_quantity as int) + 64, cast(l_linenumber as int) + 128] as leaves from lineitem""")
def leaf_offset_encode(spark, folder):
    rows = Tables(spark, folder).base("lineitem")
    raw = F.array(*[F.col(c).cast("double") for c in ("l_linenumber", "l_quantity", "l_linenumber")])
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", leaves.leaf_offset_encode(raw, 64).alias("leaves"))


@query("concat_leaves", """
select l_orderkey, l_partkey, l_suppkey, [cast(l_linenumber as int), cast(l_quantity as int), 7] as leaves from lineitem""")
def concat_leaves(spark, folder):
    rows = Tables(spark, folder).base("lineitem")
    first = F.array(F.col("l_linenumber").cast("int"))
    second = F.array(F.col("l_quantity").cast("int"), F.lit(7))
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", leaves.concat_leaves(first, second).alias("leaves"))


@query("leaf_fm_kfold", ALL_ROWS, LINE_VIEWS)
def leaf_fm_kfold(spark, folder):
    rows = regress_table(Tables(spark, folder)).select("row", "Y", "fold", *FEATURES)
    fit = lambda part, seed: leaves.multi_tree_leaves(part, [cv.Learner(gbt(4, 4), FEATURES)], "Y", seed)
    folds = leaves.leaf_fm_kfold(rows, fit, FMRegressor(factorSize=3, maxIter=10, stepSize=0.1), "Y")
    return held(folds.oof, finite("prediction_oof"), "row", "Y")


@query("custom_objective_boost", ALL_ROWS, LINE_VIEWS)
def custom_objective_boost(spark, folder):
    rows = regress_table(Tables(spark, folder))
    params = boost.BoostParams(rounds=6, rate=0.3, max_depth=5, l1=1.0, write_every=3)
    booster = boost.custom_objective_boost(rows, FEATURES, "Y", params=params)
    found = booster.predict(rows)
    better = found.agg(metrics.exposure_score("Y", "model_predict") >= metrics.exposure_score("Y", 0.0)).head()[0]
    return held(found, finite("model_predict") & F.lit(better), "row", "Y")


@query("mixed_regressor_kfold", f"select f.row, f.\"Y\", true as held from ({REGRESS.replace('d.days\n', 'd.days, d.ad_id\n')}) f join ad_static s on f.ad_id = s.ad_id", [*LINE_VIEWS, "ad_static"])
def mixed_regressor_kfold(spark, folder):
    t = Tables(spark, folder)
    rows = regress_table(t).join(t.static().select("ad_id", "item_category", "ad_size_id"), "ad_id")
    rows = cut_lineage(rows, "mixed")
    fitted = mixed.mixed_regressor_kfold(rows, rows, ["item_category", "ad_size_id"], FEATURES, "Y", "row",
                                         estimator=LinearRegression(regParam=0.01))
    return held(fitted.predict(rows), finite("model_predict"), "row", "Y")


def _stack(t: Tables):
    rows = class_table(t)
    learners = [cv.Learner(LogisticRegression(maxIter=20), DOC_FEATURES),
                cv.Learner(RandomForestClassifier(numTrees=5, maxDepth=3, seed=5), DOC_FEATURES[:2])]
    return rows, stack.stack_fit(rows, learners, LogisticRegression(maxIter=20), "label", "doc_id", upsample=True)


@query("stack_fit", CLASSES, ["labelled"])
def stack_fit(spark, folder):
    _, fitted = _stack(Tables(spark, folder))
    return held(fitted.top.oof, share("m0") & share("m1") & share("prediction_oof"), "doc_id", "label")


@query("stack_predict", CLASSES, ["labelled"])
def stack_predict(spark, folder):
    rows, fitted = _stack(Tables(spark, folder))
    return held(fitted.predict(rows), share("model_predict"), "doc_id", "label")


@query("stack_refit_top", CLASSES, ["labelled"])
def stack_refit_top(spark, folder):
    rows, fitted = _stack(Tables(spark, folder))
    again = stack.stack_refit_top(fitted, RandomForestClassifier(numTrees=3, maxDepth=2, seed=9))
    return held(again.predict(rows), share("model_predict"), "doc_id", "label")


@query("rfe_multi", "select 3 as at_most, true as held")
def rfe_multi(spark, folder):
    rows = regress_table(Tables(spark, folder))
    names = eliminate.rfe_multi(rows, [gbt(3, 2), RandomForestRegressor(numTrees=4, maxDepth=4, seed=1)],
                                list(FEATURES), "Y", 2, 3)
    return spark.createDataFrame([(3, 1 <= len(names) <= 3 and set(names) <= set(FEATURES))], "at_most int, held boolean")


@query("rfe_single", "select cast(v.round as int) as round, true as held from (values (0), (1), (2)) v(round)")
def rfe_single(spark, folder):
    rows = class_table(Tables(spark, folder))
    learner = cv.Learner(RandomForestClassifier(numTrees=4, maxDepth=3, seed=1), DOC_FEATURES, proba=True)
    valid, train = rows.filter("fold = 4"), rows.filter("fold < 4")
    scores, best = eliminate.rfe_single(train, learner, "label", 1, 1, valid, metrics.log_loss)
    fits = bool(best) and set(best) <= set(DOC_FEATURES)
    return spark.createDataFrame([(i, fits and 0 < s < 5) for i, s in enumerate(scores)], "round int, held boolean")


@query("adversarial_validation", f"select row, true as held from ({REGRESS}) where days < date '2019-04-22'", LINE_VIEWS)
def adversarial_validation(spark, folder):
    rows = regress_table(Tables(spark, folder))
    train, test = rows.filter("days < date '2019-04-22'"), rows.filter("days >= date '2019-04-22'")
    importances, probability, auc = eliminate.adversarial_validation(train, test, list(FEATURES), "row",
                                                                     RandomForestClassifier(numTrees=5, maxDepth=4, seed=1))
    found = importances.agg(F.sum("importance")).head()[0], auc.head()["auc"]
    return held(probability, share("probability") & F.lit(0 <= found[0] < 5 + 1e-6 and 0 <= found[1] <= 1), "row")
