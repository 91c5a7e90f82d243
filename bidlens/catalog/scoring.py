"""Queries over metrics, blending, bid shaping, feature scores, factorization and diffusion."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidlens.catalog.base import query, r, rounded
from bidlens.catalog.encoding import hash_fold
from bidlens.catalog.tables import Tables
from bidlens.functions import metrics, scalar
from bidlens.operators import answer, blend, factorize, graph, ranking, sampling, select

SCORE = "40 * (1 - avg(abs(greatest({y}, 1) - greatest({p}, 1)) / ((greatest({y}, 1) + greatest({p}, 1)) / 2)) / 2) + 50"


def score_sql(y: str, p: str) -> str:
    return SCORE.format(y=y, p=p)


@query("exposure_score", f"""
select k2, {r(score_sql('y', 'p1'), 's1')}, {r(score_sql('y', 'p2'), 's2')}, {r(score_sql('y', 'cast(20 as double)'), 's20')}
from scored group by k2""", ["scored"])
def exposure_score(spark, folder):
    return rounded(Tables(spark, folder).view("scored").groupBy("k2").agg(
        metrics.exposure_score("y", "p1").alias("s1"), metrics.exposure_score("y", "p2").alias("s2"),
        metrics.exposure_score("y", 20).alias("s20")))


def _loss(p: str, slope: str) -> str:
    low = f"(case when {p} >= 1 then {p} else ({p} - 1) * {slope} + 1 end)"
    return f"sum(abs({low} - greatest(y, 1)) / abs({low} + greatest(y, 1)))"


@query("smape_loss", f"select k2, {r(_loss('(p3 - 5)', '0'), 'loss')} from scored group by k2", ["scored"])
def smape_loss(spark, folder):
    rows = Tables(spark, folder).view("scored")
    return rounded(rows.groupBy("k2").agg(metrics.smape_loss("y", F.col("p3") - 5).alias("loss")))


@query("leaky_smape_loss", f"select k2, {r(_loss('(p3 - 5)', '0.01'), 'loss')} from scored group by k2", ["scored"])
def leaky_smape_loss(spark, folder):
    rows = Tables(spark, folder).view("scored")
    return rounded(rows.groupBy("k2").agg(metrics.leaky_smape_loss("y", F.col("p3") - 5).alias("loss")))


@query("objective_gradients", f"""
with e as (select k1, k2, k3, greatest(y - 1, 0.1) as y, p2 * 5 - greatest(y - 1, 0.1) as err from scored)
select k1, k2, k3, {r('case when abs(err) < 150 then 2 * err / y else 150 * sign(err) / y end', 'grad')},
       {r('case when abs(err) < 150 then 2 / y else cast(0 as double) end', 'hess')} from e""", ["scored"])
def objective_gradients(spark, folder):
    grad, hess = metrics.relative_gradients(F.col("y") - 1, F.col("p2") * 5)
    return rounded(Tables(spark, folder).view("scored").select("k1", "k2", "k3", grad.alias("grad"), hess.alias("hess")))


@query("auc_score", f"""
with s as (select n_chars as s, count(*) filter (quality = 1) as pos, count(*) filter (quality = 0) as neg from labelled group by n_chars),
c as (select *, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) as below from s)
select {r('sum(pos * (below + neg / cast(2 as double))) / (sum(pos) * sum(neg))', 'auc')} from c""", ["labelled"])
def auc_score(spark, folder):
    return rounded(answer.auc_score(Tables(spark, folder).view("labelled"), "quality", "n_chars"))


FOLD = hash_fold("k1", 5)


@query("fold_scores", f"""
with f as (select {FOLD} as fold, {score_sql('y', 'p1')} as score from scored group by 1),
t as (select {score_sql('y', 'p1')} as total from scored)
select {r('avg(score)', 'mean_score')}, {r('stddev_pop(score)', 'std_score')}, {r('max(total)', 'total_score')} from f, t""",
       ["scored"])
def fold_scores(spark, folder):
    rows = sampling.assign_folds(Tables(spark, folder).view("scored"), "k1")
    return rounded(answer.fold_summary(rows, "y", "p1", metrics.exposure_score))


@query("blend_fixed", f"select k1, k2, k3, {r('0.65 * p1 + 0.35 * (0.7 * p2 + 0.3 * p3)', 'blended')} from scored", ["scored"])
def blend_fixed(spark, folder):
    return rounded(Tables(spark, folder).view("scored").select(
        "k1", "k2", "k3", scalar.blend_fixed("p1", "p2", "p3").alias("blended")))


@query("clip_low", """
select test_id, greatest(predict_val, 1) as clipped, case when predict_val is not null and test_id % 9 <> 0
then greatest(predict_val, 1) end as gaps from test_sample""", ["test_sample"])
def clip_low(spark, folder):
    return Tables(spark, folder).view("test_sample").select(
        "test_id", scalar.clip_low("predict_val").alias("clipped"),
        scalar.clip_low(F.when(F.col("test_id") % 9 != 0, F.col("predict_val"))).alias("gaps"))


@query("round_half_even", """
select test_id, round_even(test_id / cast(2 as double), 0) as rounded from test_sample""", ["test_sample"])
def round_half_even(spark, folder):
    return Tables(spark, folder).view("test_sample").select(
        "test_id", scalar.round_half_even(F.col("test_id") / 2).alias("rounded"))


@query("math_functions", f"""
select test_id, abs(test_id - 100) as a, cast(sign(test_id - 100) as double) as s, {r('sqrt(bid)', 'q')},
       cast(ceil(predict_val) as bigint) as c, {r('predict_val * predict_val', 'p')} from test_sample""", ["test_sample"])
def math_functions(spark, folder):
    return rounded(Tables(spark, folder).view("test_sample").select(
        "test_id", F.abs(F.col("test_id") - 100).alias("a"), F.signum(F.col("test_id") - 100).alias("s"),
        F.sqrt("bid").alias("q"), F.ceil("predict_val").alias("c"),
        F.pow("predict_val", F.lit(2.0)).alias("p")))


@query("blend_grid", "\nunion all\n".join(
    f"select {w[0]} as w0, {w[1]} as w1, {w[2]} as w2, {i} as place, "
    f"{r(score_sql('y', f'(p1 * {w[0]} / 10 + p2 * {w[1]} / 10 + p3 * {w[2]} / 10)'), 'score')} from scored"
    for i, w in enumerate(blend.weight_grid(3, 10))), ["scored"])
def blend_grid(spark, folder):
    rows = Tables(spark, folder).view("scored")
    return rounded(blend.blend_grid(rows, ["p1", "p2", "p3"], "y", 10, metrics.exposure_score))


@query("best_blend", f"""
with tried as ({' union all '.join(f"select {w[0]} as w0, {w[1]} as w1, {i} as place, " + r(score_sql('y', f'(p1 * {w[0]} / 4 + p2 * {w[1]} / 4)'), 'score') + ' from scored' for i, w in enumerate(blend.weight_grid(2, 4)))})
select * from tried order by score desc, place limit 1""", ["scored"])
def best_blend(spark, folder):
    rows = Tables(spark, folder).view("scored")
    return rounded(blend.best_blend(blend.blend_grid(rows, ["p1", "p2"], "y", 4, metrics.exposure_score)))


@query("align_predictions", f"""
select test_id, {r('predict_val', 'tree')}, {r('bid', 'net')} from test_sample""", ["test_sample"])
def align_predictions(spark, folder):
    rows = Tables(spark, folder).view("test_sample")
    return rounded(blend.align_predictions({
        "tree": rows.select("test_id", F.col("predict_val").alias("model_predict")),
        "net": rows.select("test_id", F.col("bid").alias("model_predict"))}))


@query("group_size", "select ad_id, count(*) as size from test_sample group by ad_id", ["test_sample"])
def group_size(spark, folder):
    return answer.group_size(Tables(spark, folder).view("test_sample"))


@query("group_size_filter", """
select test_id, ad_id from test_sample where ad_id in (select ad_id from test_sample group by ad_id having count(*) = 10)""",
       ["test_sample"])
def group_size_filter(spark, folder):
    return answer.groups_of_size(Tables(spark, folder).view("test_sample").select("test_id", "ad_id"), 10)


RANK_SQL = """ranked as (select *, rank() over (partition by ad_id order by {bid})
  + (count(*) over (partition by ad_id, {bid}) - 1) / cast(2 as double) as bid_rank,
  ceil(count(*) over (partition by ad_id) / cast(2 as double)) as mid,
  row_number() over (partition by ad_id order by {bid}, test_id) as at from test_sample)"""
PLAIN, TIED = RANK_SQL.format(bid="bid"), RANK_SQL.format(bid="tied_bid")


@query("bid_rank_avg", f"with {TIED} select test_id, ad_id, bid_rank from ranked", ["test_sample"])
def bid_rank_avg(spark, folder):
    rows = Tables(spark, folder).view("test_sample").select("test_id", "ad_id", "tied_bid")
    return ranking.average_rank(rows, "ad_id", "tied_bid", "bid_rank").drop("tied_bid")


@query("bid_rank_centered", f"with {TIED} select test_id, ad_id, bid_rank - mid as bid_offset from ranked", ["test_sample"])
def bid_rank_centered(spark, folder):
    rows = Tables(spark, folder).view("test_sample").select("test_id", "ad_id", "tied_bid")
    return answer.bid_rank_centered(rows, bid="tied_bid").drop("tied_bid")


MIDDLE = """select r.ad_id, min_by(t.predict_val, t.test_id) as predict_val
from ranked r join test_sample t on r.ad_id = t.ad_id and r.{bid} = t.{bid} where r.at = r.mid group by r.ad_id"""


@query("middle_bid_row", f"with {TIED} {MIDDLE.format(bid='tied_bid')}", ["test_sample"])
def middle_bid_row(spark, folder):
    return answer.middle_bid_row(Tables(spark, folder).view("test_sample"), "predict_val", bid="tied_bid")


@query("middle_bid_row_strict", f"with {TIED} select ad_id, predict_val from ranked where bid_rank = mid", ["test_sample"])
def middle_bid_row_strict(spark, folder):
    return answer.middle_bid_row(Tables(spark, folder).view("test_sample"), "predict_val", bid="tied_bid", strict=True)


def shaped(bid: str, strict: bool) -> str:
    ranked = RANK_SQL.format(bid=bid)
    middle = "select ad_id, predict_val from ranked where bid_rank = mid" if strict else MIDDLE.format(bid=bid)
    value = "case when m.predict_val is not null then greatest(m.predict_val, 1) end + (r.bid_rank - r.mid) * 0.0001"
    return f"with {ranked}, middle as ({middle}) select r.test_id, {r(value, 'predict_val')} from ranked r left join middle m on r.ad_id = m.ad_id"


@query("answer_by_bid", shaped("bid", False), ["test_sample"])
def answer_by_bid(spark, folder):
    return rounded(answer.answer_by_bid(Tables(spark, folder).view("test_sample")))


@query("broadcast_median_bid", shaped("tied_bid", False), ["test_sample"])
def broadcast_median_bid(spark, folder):
    return rounded(answer.answer_by_bid(Tables(spark, folder).view("test_sample"), bid="tied_bid"))


@query("answer_by_bid_strict", shaped("tied_bid", True), ["test_sample"])
def answer_by_bid_strict(spark, folder):
    return rounded(answer.answer_by_bid(Tables(spark, folder).view("test_sample"), bid="tied_bid", strict=True))


@query("answer_with_bid", f"with {TIED} select test_id, {r('predict_val + bid_rank * 0.0001', 'predict_val')} from ranked",
       ["test_sample"])
def answer_with_bid(spark, folder):
    return rounded(answer.answer_with_bid(Tables(spark, folder).view("test_sample"), bid="tied_bid"))


FINAL = """select test_id, ad_id, bid,
round_even(0.65 * predict_val + 0.35 * (0.7 * (predict_val / 2) + 0.3 * (test_id % 50)), 0) as predict_val from test_sample"""


@query("final_answer", shaped("bid", False).replace("test_sample", "blended").replace("with ", f"with blended as ({FINAL}), ", 1),
       ["test_sample"])
def final_answer(spark, folder):
    rows = Tables(spark, folder).view("test_sample").select(
        "test_id", "ad_id", "bid", F.col("predict_val").alias("fm"), (F.col("predict_val") / 2).alias("tree"),
        (F.col("test_id") % 50).alias("net"))
    return rounded(answer.final_answer(rows, "fm", "tree", "net"))


@query("relation_scores", "\nunion all\n".join(
    f"select '{c}' as feature, {r(f'corr({c}, y)', 'score')} from scored" for c in ("p1", "p2", "p3")), ["scored"])
def relation_scores(spark, folder):
    return rounded(select.relation_scores(Tables(spark, folder).view("scored"), ["p1", "p2", "p3"], "y"))


MIC_FEATURES = ["l_quantity", "l_discount", "l_linenumber"]


def mic_sql(features: list[str], label: str, table: str) -> str:
    place = lambda c: f"rank() over (order by {c}) - 1"
    long = " union all ".join(f"select '{c}' as feature, {place(c)} as rx, {place(label)} as ry from {table}" for c in features)
    return f"""
with long as ({long}),
size as (select count(*) as rows, greatest(pow(count(*), 0.6), 4) as cells from {table}),
levels as (select cast(pow(2, i) as bigint) as k from range(1, 40) v(i), size where 2 * pow(2, i) <= cells),
grids as (select x.k as a, y.k as b from levels x, levels y, size where x.k * y.k <= cells),
cells as (select feature, a, b, (rx * a) // rows as cx, (ry * b) // rows as cy, cast(count(*) as double) as n
  from long, grids, size group by feature, a, b, cx, cy),
shares as (select *, sum(n) over (partition by feature, a, b, cx) as nx, sum(n) over (partition by feature, a, b, cy) as ny,
  sum(n) over (partition by feature, a, b) as nn from cells),
info as (select feature, a, b, sum(n / nn * ln(n * nn / (nx * ny))) as mi from shares group by feature, a, b)
select feature, {r('max(greatest(mi, 0) / ln(least(a, b)))', 'score')} from info group by feature"""


@query("mic_scores", mic_sql(MIC_FEATURES, "l_extendedprice", "lineitem"))
def mic_scores(spark, folder):
    return rounded(select.mic_scores(Tables(spark, folder).base("lineitem"), MIC_FEATURES, "l_extendedprice"))


@query("free_line_scores")
def free_line_scores(spark, folder):
    return rounded(select.free_line_scores(Tables(spark, folder).base("lineitem"), MIC_FEATURES, "l_extendedprice"))


@query("mic_pair", f"select score from ({mic_sql(['l_quantity'], 'l_tax', 'lineitem')})")
def mic_pair(spark, folder):
    return rounded(select.mic_pair(Tables(spark, folder).base("lineitem"), "l_quantity", "l_tax"))


IMPORTANCE = " union all ".join(f"select '{c}' as feature, abs(corr({c}, l_extendedprice)) as importance from lineitem"
                                for c in (*MIC_FEATURES, "l_tax", "l_suppkey"))


def _importance(t: Tables, label: str = "l_extendedprice"):
    scores = select.relation_scores(t.base("lineitem"), [*MIC_FEATURES, "l_tax", "l_suppkey"], label)
    return scores.select("feature", F.abs("score").alias("importance"))


@query("top_features", f"select feature from ({IMPORTANCE}) order by importance desc, feature limit 3")
def top_features(spark, folder):
    return select.top_features(_importance(Tables(spark, folder)), 2, 2, 5).select("feature")


@query("bottom_features", f"select feature from ({IMPORTANCE}) order by importance, feature limit 2")
def bottom_features(spark, folder):
    return select.bottom_features(_importance(Tables(spark, folder)), 2).select("feature")


@query("feature_intersection", f"""
select feature from (select feature from ({IMPORTANCE}) order by importance desc, feature limit 3)
intersect select feature from (select feature from ({IMPORTANCE.replace('l_extendedprice', 'l_suppkey')}) order by importance desc, feature limit 3)""")
def feature_intersection(spark, folder):
    t = Tables(spark, folder)
    return select.feature_intersection([
        select.top_features(_importance(t), 2, 2, 5), select.top_features(_importance(t, "l_suppkey"), 2, 2, 5)])


@query("fm_score", f"""
with s as (select i.row, f.k, sum(f.v * i.x) as s, sum(f.v * f.v * i.x * i.x) as q
  from fm_input i join fm_factors f on i.feature = f.feature group by i.row, f.k)
select row, {r('0.5 + sum((s * s - q) / 2)', 'score')} from s group by row""", ["fm_input", "fm_factors"])
def fm_score(spark, folder):
    t = Tables(spark, folder)
    return rounded(factorize.fm_score(t.view("fm_input"), t.view("fm_factors"), bias=0.5))


@query("fm_score_linear", f"""
with s as (select i.row, f.k, sum(f.v * i.x) as s, sum(f.v * f.v * i.x * i.x) as q
  from fm_input i join fm_factors f on i.feature = f.feature group by i.row, f.k),
w as (select row, sum(x * feature / 10) as lin from fm_input group by row)
select s.row, {r('max(lin) + sum((s * s - q) / 2)', 'score')} from s join w on s.row = w.row group by s.row""",
       ["fm_input", "fm_factors"])
def fm_score_linear(spark, folder):
    t = Tables(spark, folder)
    factors = t.view("fm_factors")
    linear = factors.select("feature", (F.col("feature") / 10).alias("w")).distinct()
    return rounded(factorize.fm_score(t.view("fm_input"), factors, linear))


@query("bi_interaction", f"""
with s as (select i.row, f.k, sum(f.v * i.x) as s, sum(f.v * f.v * i.x * i.x) as q
  from fm_input i join fm_factors f on i.feature = f.feature group by i.row, f.k)
select row, {', '.join(r(f'max(case when k = {k} then (s * s - q) / 2 end)', f'bi_{k}') for k in range(5))}
from s group by row""", ["fm_input", "fm_factors"])
def bi_interaction(spark, folder):
    t = Tables(spark, folder)
    return rounded(factorize.bi_interaction(t.view("fm_input"), t.view("fm_factors")))


HOPS = """links as (select distinct src, dst from graph_edges),
h0 as (select s_suppkey as node, s_acctbal as x from supplier),
h1 as (select n.node, avg(v.x) as x from h0 n left join links l on l.src = n.node left join h0 v on v.node = l.dst group by n.node),
h2 as (select n.node, avg(v.x) as x from h0 n left join links l on l.src = n.node left join h1 v on v.node = l.dst group by n.node)"""


def _nodes(t: Tables):
    return t.base("supplier").selectExpr("s_suppkey as node", "s_acctbal as x")


@query("diffusion_features", f"""
with {HOPS} select node, 0 as hop, {r('x', 'x')} from h0 union all select node, 1, {r('x', 'x')} from h1
union all select node, 2, {r('x', 'x')} from h2""", ["graph_edges"])
def diffusion_features(spark, folder):
    t = Tables(spark, folder)
    return rounded(graph.diffusion_features(t.view("graph_edges"), _nodes(t), ["x"], 3))


@query("diffusion_weighted", f"""
with {HOPS} select node, 0 as hop, {r('x * 0.5', 'x')} from h0 union all select node, 1, {r('x * 0.25', 'x')} from h1
union all select node, 2, {r('x * 0.125', 'x')} from h2""", ["graph_edges"])
def diffusion_weighted(spark, folder):
    t = Tables(spark, folder)
    diffused = graph.diffusion_features(t.view("graph_edges"), _nodes(t), ["x"], 3)
    weights = diffused.select("hop").distinct().withColumn("x", F.pow(F.lit(0.5), F.col("hop") + 1))
    return rounded(graph.diffusion_weighted(diffused, weights, ["x"]))
