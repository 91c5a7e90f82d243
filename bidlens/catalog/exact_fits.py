"""Model operators on fits that SQL repeats: one split on a two-valued column, or least squares.

A tree of depth one on a two-valued column predicts the mean of each side, as does a logistic
regression on it; a linear model on one column is a regression line. The plumbing around the fits, folds, routing, levels,
elimination and averaging, is then checked value by value.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from bidlens.catalog.base import query, r, rounded
from bidlens.catalog.encoding import hash_fold
from bidlens.catalog.models import LINE_VIEWS, LINES, regress_table
from bidlens.catalog.scoring import score_sql
from bidlens.catalog.tables import Tables
from bidlens.functions import metrics
from bidlens.operators import best_first, boost, cv, eliminate, encode, hurdle, leaves, mixed, stack
from bidlens.session import cut_lineage

SIDES = f"""
rows as (select d.ad_id * 100 + date_diff('day', date '2019-04-01', d.days) as row, d.days, cast(coalesce(l.y, 0) as double) as y,
  case when requestion_num > 2 then 1 else 0 end as big
  from ad_days d left join day_labels l on d.ad_id = l.ad_id and d.days = l.days),
folded as (select *, {hash_fold('row', 5)} as fold from rows),
numbers as (select distinct fold from folded),
sides as (select k.fold, f.big, avg(f.y) as p, avg(sqrt(f.y)) as root, avg(cast(f.y > 1 as int)) as positive
  from numbers k join folded f on f.fold <> k.fold group by k.fold, f.big)"""
EARLY = "(select * from folded where days < date '2019-04-22')"
LATE = "(select * from folded where days >= date '2019-04-22')"
EARLY_SIDES = f"""early as (select k.fold, f.big, avg(f.y) as p from numbers k join {EARLY} f on f.fold <> k.fold group by k.fold, f.big),
means as (select big, avg(p) as p from early group by big)"""


def side_table(t: Tables):
    rows = regress_table(t).withColumns({"big": (F.col("requestion_num") > 2).cast("double"), "flat": F.lit(1.0)})
    return cut_lineage(rows.select("row", "days", "Y", "fold", "big", "flat"), "sides")


def stump() -> DecisionTreeRegressor:
    return DecisionTreeRegressor(maxDepth=1)


def one_tree() -> GBTRegressor:
    return GBTRegressor(maxIter=1, maxDepth=1)


@query("gbt_one_split", f"""
with {SIDES}, {EARLY_SIDES},
scored as (select k.fold, {score_sql('f.y', 'e.p')} as s from numbers k, {LATE} f join early e on f.big = e.big where e.fold = k.fold group by k.fold)
select f.row, f.y as "Y", {r('m.p', 'model_predict')}, {r('(select avg(s) from scored)', 'valid_score')}
from {LATE} f join means m on f.big = m.big""", LINE_VIEWS)
def gbt_one_split(spark, folder):
    rows = side_table(Tables(spark, folder))
    train, valid = rows.filter("days < date '2019-04-22'"), rows.filter("days >= date '2019-04-22'")
    folds = cv.kfold_oof(train, cv.Learner(one_tree(), ("big",)), "Y")
    score = folds.eval_scores(valid, metrics.exposure_score).agg(F.avg("score")).scalar()
    return rounded(folds.predict(valid).select("row", "Y", "model_predict", score.alias("valid_score")))


@query("importance_planted", "select * from (values ('big', cast(5 as double)), ('flat', cast(0 as double))) v(feature, importance)")
def importance_planted(spark, folder):
    folds = cv.kfold_oof(side_table(Tables(spark, folder)), cv.Learner(one_tree(), ("big", "flat")), "Y")
    return rounded(folds.importances(spark))


@query("hurdle_one_split", f"""
with {SIDES},
probable as (select f.*, s.positive as probability from folded f join sides s on f.fold = s.fold and f.big = s.big),
cut as (select quantile_cont(probability, 0.1) as threshold from probable),
routed as (select p.* from probable p, cut where probability > threshold),
value_sides as (select k.fold, o.big, avg(o.y) as p from (select distinct fold from routed) k join routed o on o.fold <> k.fold group by k.fold, o.big),
value_means as (select k.fold, avg(o.y) as p from (select distinct fold from routed) k join routed o on o.fold <> k.fold group by k.fold)
select p.row, p.y as "Y", {r('p.probability', 'probability_oof', 4)},
  {r('case when o.row is null then 0 else coalesce(v.p, m.p) end', 'prediction_oof', 4)}
from probable p left join routed o on p.row = o.row left join value_sides v on o.fold = v.fold and o.big = v.big
left join value_means m on o.fold = m.fold""", LINE_VIEWS)
def hurdle_one_split(spark, folder):
    fitted = hurdle.hurdle_fit(side_table(Tables(spark, folder)), cv.Learner(LogisticRegression(maxIter=200, tol=1e-12), ("big",)),
                               cv.Learner(stump(), ("big",)), "Y", 10)
    return rounded(fitted.oof.select("row", "Y", "probability_oof", "prediction_oof"), 4)


@query("leaf_logistic_one_split", f"""
with s as (select n_chars > 1000 as big, avg(quality) as p from labelled group by 1)
select doc_id, {r('p', 'model_predict', 3)} from labelled d join s on (d.n_chars > 1000) = s.big""", ["labelled"])
def leaf_logistic_one_split(spark, folder):
    rows = Tables(spark, folder).view("labelled").select(
        "doc_id", F.col("quality").cast("double").alias("label"), (F.col("n_chars") > 1000).cast("double").alias("big"))
    model = leaves.leaf_logistic(cut_lineage(rows, "classes"), [cv.Learner(GBTClassifier(maxIter=1, maxDepth=1), ("big",))],
                                 "label", LogisticRegression(maxIter=200, tol=1e-9))
    return rounded(model.predict(rows).select("doc_id", "model_predict"), 3)


@query("leaves_one_split", f"with {SIDES} select row, [big, big + 2] as leaves from rows", LINE_VIEWS)
def leaves_one_split(spark, folder):
    rows = side_table(Tables(spark, folder))
    trees = leaves.multi_tree_leaves(rows, [cv.Learner(one_tree(), ("big",)), cv.Learner(one_tree(), ("flat", "big"))], "Y")
    return trees.apply(rows).select("row", "leaves")


@query("leaf_linear_kfold", f"""
with {SIDES} select f.row, f.y as "Y", {r('s.p', 'prediction_oof', 4)} from folded f join sides s on f.fold = s.fold and f.big = s.big""", LINE_VIEWS)
def leaf_linear_kfold(spark, folder):
    def fit(part, seed):
        return leaves.multi_tree_leaves(part, [cv.Learner(one_tree(), ("big",))], "Y", seed)

    folds = leaves.leaf_fm_kfold(side_table(Tables(spark, folder)), fit, LinearRegression(), "Y")
    return rounded(folds.oof.select("row", "Y", "prediction_oof"), 4)


def _newton(g: str, h: str) -> str:
    return f"-0.3 * least(greatest(abs({g}) - 1, 0) / greatest({h}, 0.001), 150) * (case when {g} > 0 then 1 else -1 end)"


# From score 0 all gradients are alike, so the first tree is one leaf; the second splits.
@query("newton_steps", f"""
with {SIDES},
errors as (select big, greatest(y, 0.1) as t from rows),
first as (select {_newton('sum(case when t < 150 then cast(-2 as double) else -150 / t end)',
                          'sum(case when t < 150 then 2 / t else cast(0 as double) end)')} as v from errors),
slopes as (select big, v, case when abs(v - t) < 150 then 2 * (v - t) / t else 150 * sign(v - t) / t end as g,
  case when abs(v - t) < 150 then 2 / t else cast(0 as double) end as h from errors, first),
second as (select big, max(v) as v, {_newton('sum(g)', 'sum(h)')} as w from slopes group by big)
select row, {r('v + w', 'model_predict')} from rows join second on rows.big = second.big""", LINE_VIEWS)
def newton_steps(spark, folder):
    rows = side_table(Tables(spark, folder))
    params = boost.BoostParams(rounds=2, rate=0.3, max_depth=1, min_rows=1, columns=1.0, l1=1.0)
    booster = boost.custom_objective_boost(rows, ["big"], "Y", params=params)
    return rounded(booster.predict(rows).select("row", "model_predict"))


def _step(g: str, h: str) -> str:
    return f"-sign({g}) * least(greatest(abs({g}) - 1, 0) / greatest({h}, 0.001), 150)"


def _worth(g: str, h: str) -> str:
    w = f"({_step(g, h)})"
    return f"(-2 * ({g} * {w} + greatest({h}, 0.001) * {w} * {w} / 2 + abs({w})))"


def _gain(g: str, h: str, lg: str, lh: str) -> str:
    return f"{_worth(lg, lh)} + {_worth(f'({g} - {lg})', f'({h} - {lh})')} - {_worth(g, h)}"


# Derivatives at score 0, and all places where a feature of two or three values can be cut.
SLOPES = """
slopes as (select *, case when t < 150 then cast(-2 as double) else -150 / t end as g,
  case when t < 150 then 2 / t else cast(0 as double) end as h from (select *, greatest(y, 0.1) as t,
    date_diff('day', date '2019-04-01', days) % 3 as third from folded)),
cuts(feature, place) as (values (0, 0), (1, 0), (1, 1))"""
_LEFT = "case when c.feature = 0 then s.big <= c.place else s.third <= c.place end"


def _cut_sums(rows: str, by: str) -> str:
    return f"""
select {by}, c.feature, c.place, sum(s.g) as g, sum(s.h) as h, coalesce(sum(s.g) filter ({_LEFT}), 0) as lg,
  coalesce(sum(s.h) filter ({_LEFT}), 0) as lh, count(*) filter ({_LEFT}) as ln, count(*) as n from {rows} s, cuts c group by all"""


@query("best_first_splits", f"""
with {SIDES}, {SLOPES},
root as (select feature, place from ({_cut_sums('slopes', '0 as side')}) where ln between 1 and n - 1
  order by {_gain('g', 'h', 'lg', 'lh')} desc, feature, place limit 1),
sided as (select s.*, case when {_LEFT} then 0 else 1 end as side from slopes s, root c),
second as (select side, feature, place from ({_cut_sums('sided', 's.side')}) where ln between 1 and n - 1
  order by {_gain('g', 'h', 'lg', 'lh')} desc, side, feature, place limit 1),
leaves as (select s.*, case when s.side <> c.side then 2 when {_LEFT} then 0 else 1 end as leaf from sided s, second c),
steps as (select leaf, 0.3 * {_step('sum(g)', 'sum(h)')} as v from leaves group by leaf)
select row, {r('v', 'model_predict')} from leaves join steps on leaves.leaf = steps.leaf""", LINE_VIEWS)
def best_first_splits(spark, folder):
    rows = side_table(Tables(spark, folder))
    rows = rows.withColumn("third", F.date_diff("days", F.lit("2019-04-01").cast("date")) % 3)
    params = best_first.BestFirstParams(rounds=1, rate=0.3, num_leaves=3, min_rows=1, columns=1.0, l1=1.0)
    fitted = best_first.best_first_boost(rows, ["big", "third"], "Y", params=params, key="row")
    return rounded(fitted.predict(rows).select("row", "model_predict"))


@query("best_first_folds", f"""
with {SIDES}, {SLOPES},
sums as (select k.fold, s.big, sum(s.g) as g, sum(s.h) as h from numbers k join slopes s on s.fold <> k.fold group by all),
wholes as (select fold, sum(g) as g, sum(h) as h, sum(case when big = 0 then g else 0 end) as lg,
  sum(case when big = 0 then h else 0 end) as lh, count(*) as sides from sums group by fold),
steps as (select s.fold, s.big, 0.3 * case when sides = 2 and {_gain('w.g', 'w.h', 'lg', 'lh')} > 0
    then {_step('s.g', 's.h')} else {_step('w.g', 'w.h')} end as v from sums s join wholes w on s.fold = w.fold)
select f.row, f.y as "Y", {r('v', 'prediction_oof')} from folded f join steps s on f.fold = s.fold and f.big = s.big""", LINE_VIEWS)
def best_first_folds(spark, folder):
    params = best_first.BestFirstParams(rounds=1, rate=0.3, num_leaves=2, min_rows=1, columns=1.0, l1=1.0)
    _, oof = best_first.best_first_kfold(side_table(Tables(spark, folder)), ["big"], "Y", params=params, key="row")
    return rounded(oof.select("row", "Y", "prediction_oof"))


@query("mixed_ids_kfold", f"""
with {SIDES} select f.row, f.y as "Y", {r('s.root * s.root', 'prediction_oof', 3)} from folded f join sides s on f.fold = s.fold and f.big = s.big""", LINE_VIEWS)
def mixed_ids_kfold(spark, folder):
    rows = side_table(Tables(spark, folder)).withColumn("side", F.col("big").cast("int"))
    fitted = mixed.mixed_regressor_kfold(rows, rows, ["side"], ["flat"], "Y", "row", estimator=LinearRegression())
    return rounded(fitted.oof.select("row", "Y", "prediction_oof"), 3)


def _top(k: int) -> str:
    """Second-level lines on the first level's out-of-fold values."""
    return f"""
level as (select row, y, p as m0, {hash_fold('row', k, stack.TOP_SALT)} as top_fold from oof),
tops as (select k.top_fold, regr_slope(f.y, f.m0) as slope, regr_intercept(f.y, f.m0) as base
  from (select distinct top_fold from level) k join level f on f.top_fold <> k.top_fold group by k.top_fold),
bottom as (select row, y, avg(base + slope * x) as m0 from folded, lines group by row, y)"""


def _lines(spark, folder):
    rows = regress_table(Tables(spark, folder))
    line = LinearRegression(solver="normal")
    return rows, stack.stack_fit(rows, [cv.Learner(line, ("requestion_num",))], line, "Y", "row", binary=False)


@query("stack_lines", f"""
with {LINES}, {_top(5)} select row, y as "Y", {r('m0', 'm0', 4)}, {r('t.base + t.slope * m0', 'prediction_oof', 4)}
from level l join tops t on l.top_fold = t.top_fold""", LINE_VIEWS)
def stack_lines(spark, folder):
    _, fitted = _lines(spark, folder)
    return rounded(fitted.top.oof.select("row", "Y", "m0", "prediction_oof"), 4)


@query("stack_lines_predict", f"""
with {LINES}, {_top(5)} select row, {r('avg(t.base + t.slope * m0)', 'model_predict', 4)} from bottom, tops t group by row""", LINE_VIEWS)
def stack_lines_predict(spark, folder):
    rows, fitted = _lines(spark, folder)
    return rounded(fitted.predict(rows).select("row", "model_predict"), 4)


@query("stack_lines_refit", f"""
with {LINES}, {_top(3)} select row, {r('avg(t.base + t.slope * m0)', 'model_predict', 4)} from bottom, tops t group by row""", LINE_VIEWS)
def stack_lines_refit(spark, folder):
    rows, fitted = _lines(spark, folder)
    again = stack.stack_refit_top(fitted, LinearRegression(solver="normal"), k=3)
    return rounded(again.predict(rows).select("row", "model_predict"), 4)


def _either(lists):
    """Features found in any list."""
    merged = lists[0].select("feature")
    for names in lists[1:]:
        merged = merged.union(names.select("feature"))
    return merged.distinct()


@query("rfe_planted", "select 'big' as feature, 'both' as kept_by union all select 'big', 'either'")
def rfe_planted(spark, folder):
    rows = side_table(Tables(spark, folder)).withColumn("other", F.lit(2.0))
    found = []
    for name, combine in (("both", eliminate.feature_intersection), ("either", _either)):
        left = eliminate.rfe_multi(rows, [stump(), one_tree()], ["flat", "big", "other"], "Y", 1, 1, combine)
        found += [(f, name) for f in left]
    return spark.createDataFrame(found, "feature string, kept_by string")


@query("rfe_single_planted", f"""
with {SIDES}, {EARLY_SIDES},
s as (select avg(abs(f.y - m.p)) as score from {LATE} f join means m on f.big = m.big)
select cast(v.round as int) as round, {r('score', 'score')}, 'flat,big' as best from s, (values (0), (1)) v(round)""", LINE_VIEWS)
def rfe_single_planted(spark, folder):
    rows = side_table(Tables(spark, folder))
    train, valid = rows.filter("days < date '2019-04-22'"), rows.filter("days >= date '2019-04-22'")
    scores, best = eliminate.rfe_single(train, cv.Learner(stump(), ("flat", "big")), "Y", 1, 1, valid, metrics.mean_absolute_error)
    return rounded(spark.createDataFrame([(i, s, ",".join(best)) for i, s in enumerate(scores)], "round int, score double, best string"))


@query("adversarial_planted", f"""
with {SIDES} select row, cast(0 as double) as probability, cast(1 as double) as auc from {EARLY}""", LINE_VIEWS)
def adversarial_planted(spark, folder):
    rows = side_table(Tables(spark, folder)).withColumn("late", (F.col("days") >= F.lit("2019-04-22").cast("date")).cast("double"))
    _, probability, auc = eliminate.adversarial_validation(
        rows.filter("late = 0"), rows.filter("late = 1"), ["flat", "late"], "row", DecisionTreeClassifier(maxDepth=1))
    return rounded(probability.withColumn("auc", F.lit(auc.head()["auc"])))


@query("user_rules", "select o_orderkey, coalesce(case when o_orderkey % 2 = 0 then o_custkey end, -1) as o_custkey from orders")
def user_rules(spark, folder):
    orders = Tables(spark, folder).base("orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("o_custkey"))
    dropped = encode.drop_uninformative(orders, rule=lambda df: df.drop("o_orderstatus"))
    return encode.impute_with_flag(dropped, rule=lambda df: df.na.fill(-1))
