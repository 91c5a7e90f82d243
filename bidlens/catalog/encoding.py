"""Queries over cleaning, encoding, sampling and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidlens.catalog.base import query, r, rounded
from bidlens.catalog.tables import Tables
from bidlens.functions.scalar import SPREAD_FOLD, SPREAD_MIX, SPREAD_RANGE, SPREAD_SALT
from bidlens.operators import apply, encode, ranking, sampling

def hashed(key: str, salt: int = 0) -> str:
    """SQL of ``spread`` for keys that are not negative."""
    key = f"cast({key} as bigint)"
    x = (f"xor(xor({key} % {SPREAD_RANGE}, (({key} // {SPREAD_RANGE}) % {SPREAD_RANGE} * {SPREAD_FOLD}) % {SPREAD_RANGE}), "
         f"cast({salt * SPREAD_SALT % SPREAD_RANGE} as bigint))")
    for _ in range(2):
        x = f"((xor({x}, ({x}) >> 15) * {SPREAD_MIX}) % {SPREAD_RANGE})"
    return f"xor({x}, ({x}) >> 15)"


def hash_fold(key: str, k: int, salt: int = 0) -> str:
    return f"cast(floor({hashed(key, salt)} * {k} / cast({SPREAD_RANGE} as double)) as int)"


@query("frequency_encode", """
with used as (select nullif(item_id, 3) as item_id, ad_account_id from ad_static union all
  select nullif(s.item_id, 3), s.ad_account_id from test_sample t join ad_static s on t.ad_id = s.ad_id),
items as (select item_id, count(*) as n from used group by item_id),
accounts as (select ad_account_id, count(*) as n from used group by ad_account_id)
select s.ad_id, i.n as item_id, a.n as ad_account_id
from ad_static s join items i on nullif(s.item_id, 3) is not distinct from i.item_id
join accounts a on s.ad_account_id = a.ad_account_id""", ["ad_static", "test_sample"])
def frequency_encode(spark, folder):
    t = Tables(spark, folder)
    static = t.view("ad_static").select("ad_id", F.nullif("item_id", F.lit(3)).alias("item_id"), "ad_account_id")
    tests = t.view("test_sample").select("ad_id").join(static, "ad_id")
    return encode.frequency_encode(static, encode.fit_frequency([static, tests], ["item_id", "ad_account_id"]))


@query("index_encode", """
with c as (select o_custkey, row_number() over (order by min(o_orderkey)) - 1 as place from orders group by o_custkey),
p as (select o_orderpriority, row_number() over (order by min(o_orderkey)) - 1 as place from orders group by o_orderpriority)
select o.o_orderkey, c.place as o_custkey, p.place as o_orderpriority
from orders o join c on o.o_custkey = c.o_custkey join p on o.o_orderpriority = p.o_orderpriority""")
def index_encode(spark, folder):
    orders = Tables(spark, folder).base("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return encode.index_encode(orders, encode.fit_index(orders, ["o_custkey", "o_orderpriority"], "o_orderkey"))


@query("distinct_values", """
select o_custkey, row_number() over (order by min(o_orderkey)) - 1 as place from orders group by o_custkey""")
def distinct_values(spark, folder):
    return encode.distinct_values(Tables(spark, folder).base("orders"), "o_custkey", "o_orderkey")


@query("exact_percentile", "\nunion all\n".join(
    f"select '{c}' as stat, {', '.join(r(f'quantile_cont({c}, {p})', f'q{i}') for i, p in enumerate((0.1, 0.5, 0.95)))} from lineitem"
    for c in ("l_extendedprice", "l_quantity", "l_tax")))
def exact_percentile(spark, folder):
    lineitem = Tables(spark, folder).base("lineitem")
    return rounded(ranking.exact_quantiles(lineitem, ["l_extendedprice", "l_quantity", "l_tax"], [0.1, 0.5, 0.95]))


@query("group_median", f"""
select l_suppkey, {r('median(l_extendedprice)', 'l_extendedprice')}, {r('median(l_quantity)', 'l_quantity')}
from lineitem group by l_suppkey""")
def group_median(spark, folder):
    lineitem = Tables(spark, folder).base("lineitem")
    return rounded(ranking.grouped_medians(lineitem, ["l_suppkey"], ["l_extendedprice", "l_quantity"]))


PROFILED = ["l_quantity", "l_discount", "l_linenumber"]


@query("column_profile", "\nunion all\n".join(
    f"""select '{c}' as stat, count({c}) as n, cast(min({c}) as double) as low, cast(max({c}) as double) as high,
{r(f'avg({c})', 'mean')}, (select cast({c} as double) from lineitem group by {c} order by count(*) desc, {c} limit 1) as mode
from lineitem""" for c in PROFILED))
def column_profile(spark, folder):
    profile = encode.column_profile(Tables(spark, folder).base("lineitem"), PROFILED)
    return profile.withColumn("mean", F.round(F.col("mean") + 1.3e-8, 6))


@query("drop_uninformative", "select o_orderkey, o_custkey, o_orderstatus from orders")
def drop_uninformative(spark, folder):
    orders = Tables(spark, folder).base("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    padded = orders.withColumns({"empty": F.lit(None).cast("int"), "constant": F.lit(7),
                                 "one_value": F.when(F.col("o_orderkey") % 2 == 0, F.lit("x"))})
    return encode.drop_uninformative(padded)


IMPUTED = """select doc_id, case when doc_id % 13 = 0 then null else lang end as lang,
case when doc_id % 7 = 0 then null else n_chars end as n_chars,
case when doc_id % 5 = 0 then null else date '2019-04-01' + cast(doc_id % 30 as int) end as seen from documents"""


@query("impute_with_flag", f"""
with d as ({IMPUTED})
select doc_id, coalesce(lang, (select lang from d where lang is not null group by lang order by count(*) desc, lang limit 1)) as lang,
       {r('coalesce(n_chars, (select avg(n_chars) from d))', 'n_chars')},
       coalesce(seen, date '1970-01-01' + cast(floor((select avg(date_diff('day', date '1970-01-01', seen)) from d)) as int)) as seen,
       cast(lang is null as int) as lang_na, cast(n_chars is null as int) as n_chars_na, cast(seen is null as int) as seen_na from d""")
def impute_with_flag(spark, folder):
    docs = Tables(spark, folder).base("documents").select(
        "doc_id", F.when(F.col("doc_id") % 13 != 0, F.col("lang")).alias("lang"),
        F.when(F.col("doc_id") % 7 != 0, F.col("n_chars")).alias("n_chars"),
        F.when(F.col("doc_id") % 5 != 0, F.date_add(F.lit("2019-04-01").cast("date"), (F.col("doc_id") % 30).cast("int"))).alias("seen"))
    return rounded(encode.impute_with_flag(docs))


STATUSES = ["F", "O", "P"]


@query("one_hot", "select o_orderkey, " + ", ".join(
    f"cast(o_orderstatus = '{v}' as int) as \"o_orderstatus_{v}\"" for v in STATUSES) + " from orders")
def one_hot(spark, folder):
    orders = Tables(spark, folder).base("orders").select("o_orderkey", "o_orderstatus")
    return encode.one_hot(orders, "o_orderstatus", encode.fit_categories(orders, "o_orderstatus", "o_orderkey"))


@query("one_hot_vector", """
with c as (select o_custkey, row_number() over (order by min(o_orderkey)) - 1 as place from orders group by o_custkey)
select o.o_orderkey, c.place, cast(1 as int) as ones from orders o join c on o.o_custkey = c.o_custkey""")
def one_hot_vector(spark, folder):
    orders = Tables(spark, folder).base("orders").select("o_orderkey", "o_custkey")
    hot = encode.one_hot_vector(orders, orders, "o_custkey", "o_orderkey")
    found = hot.select("o_orderkey", encode.vector_entries("o_custkey_hot").alias("v"))
    ones = F.aggregate("v.values", F.lit(0.0), lambda a, x: a + x)
    place = F.get("v.at", (F.array_position("v.values", 1.0) - 1).cast("int"))
    return found.select("o_orderkey", place.alias("place"), ones.cast("int").alias("ones"))


@query("min_max_scale", f"""
with b as (select min(l_quantity) as ql, max(l_quantity) as qh, min(l_extendedprice) as pl, max(l_extendedprice) as ph from lineitem)
select l_orderkey, l_partkey, {r('(l_quantity - ql) / (qh - ql)', 'l_quantity')},
       {r('(l_extendedprice - pl) / (ph - pl)', 'l_extendedprice')}, cast(0 as double) as flat from lineitem, b""")
def min_max_scale(spark, folder):
    rows = Tables(spark, folder).base("lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", F.lit(3.0).alias("flat"))
    scaled = encode.min_max_scale(rows, rows, ["l_quantity", "l_extendedprice", "flat"])
    return rounded(scaled, 6).withColumn("flat", F.rint("flat"))


@query("percentile_scale", f"""
with b as (select min(l_quantity) as ql, quantile_cont(l_quantity, 0.95) - min(l_quantity) as qs, avg(l_quantity) as qm,
  min(l_extendedprice) as pl, quantile_cont(l_extendedprice, 0.95) - min(l_extendedprice) as ps, avg(l_extendedprice) as pm from lineitem)
select l_orderkey, l_partkey, {r('(l_quantity - ql) / qs - (qm - ql) / qs', 'l_quantity')},
       {r('(l_extendedprice - pl) / ps - (pm - pl) / ps', 'l_extendedprice')} from lineitem, b""")
def percentile_scale(spark, folder):
    rows = Tables(spark, folder).base("lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", F.lit(3.0).alias("flat"))
    fitted = encode.fit_percentile_scale(rows, ["l_quantity", "l_extendedprice", "flat"], 95)
    return rounded(encode.percentile_scale(rows.drop("flat"), fitted))


BINNED = ["l_quantity", "l_extendedprice", "l_tax"]


@query("quantile_bin", f"""
with b as (select {', '.join(f'list_distinct([' + ', '.join(f'quantile_cont({c}, {i / 10})' for i in range(1, 10)) + f']) as {c}_e, min({c}) as {c}_m' for c in BINNED)} from lineitem)
select l_orderkey, l_partkey, {', '.join(f'cast(len(list_filter({c}_e, lambda e: e > {c}_m and e <= {c})) as int) as {c}' for c in BINNED)}
from lineitem, b""")
def quantile_bin(spark, folder):
    rows = Tables(spark, folder).base("lineitem").select("l_orderkey", "l_partkey", *BINNED)
    return encode.quantile_bin(rows, encode.fit_quantile_bins(rows, BINNED))


@query("sqrt_label_scale", f"""
with b as (select quantile_cont(sqrt(l_quantity), 0.9) as ratio from lineitem)
select l_orderkey, l_partkey, {r('sqrt(l_quantity) / ratio', 'scaled')}, {r('l_quantity', 'back')} from lineitem, b""")
def sqrt_label_scale(spark, folder):
    rows = Tables(spark, folder).base("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    ratio = encode.fit_sqrt_label(rows, "l_quantity")
    scaled = rows.withColumn("scaled", encode.sqrt_label("l_quantity", ratio)).drop("l_quantity")
    return rounded(scaled.withColumn("back", encode.unsqrt_label("scaled", ratio)))


@query("select_by_pattern", "select o_custkey, sum(o_totalprice) > 0 as bid_2day, count(*) as n_3day from orders group by o_custkey")
def select_by_pattern(spark, folder):
    wide = Tables(spark, folder).base("orders").groupBy("o_custkey").agg(
        (F.sum("o_totalprice") > 0).alias("bid_2day"), F.count(F.lit(1)).alias("n_3day"),
        F.max("o_orderkey").alias("old_1day"), F.min("o_orderkey").alias("other"))
    return encode.select_by_pattern(wide, ["o_custkey"])


@query("union_sets", """
select c_custkey as key, c_nationkey as nation, c_mktsegment as segment, 'customer' as origin from customer
union all select s_suppkey, s_nationkey, null, 'supplier' from supplier""")
def union_sets(spark, folder):
    t = Tables(spark, folder)
    customer = t.base("customer").selectExpr("c_custkey as key", "c_nationkey as nation", "c_mktsegment as segment")
    supplier = t.base("supplier").selectExpr("s_suppkey as key", "s_nationkey as nation")
    return encode.union_sets({"customer": customer, "supplier": supplier})


@query("split_back", "select s_suppkey as key, s_nationkey as nation from supplier")
def split_back(spark, folder):
    return encode.split_back(union_sets(spark, folder), "supplier").drop("segment")


@query("rename_drop", "select l_orderkey as request_id, l_quantity as filler from lineitem")
def rename_drop(spark, folder):
    rows = Tables(spark, folder).base("lineitem").select("l_orderkey", "l_quantity", "l_tax")
    return rows.drop("l_tax").withColumnsRenamed({"l_orderkey": "request_id", "l_quantity": "filler"})


@query("downsample_zero", f"""
select o_orderkey, o_orderkey % 3 as label from orders
where o_orderkey % 3 <> 0 or {hashed('o_orderkey')} < {int(0.4 * SPREAD_RANGE)}""")
def downsample_zero(spark, folder):
    rows = Tables(spark, folder).base("orders").selectExpr("o_orderkey", "o_orderkey % 3 as label")
    return sampling.downsample_zero(rows, "label", "o_orderkey")


@query("downsample_zero_exact", f"""
with zero as (select o_orderkey, row_number() over (order by {hashed('o_orderkey')}) as pos, count(*) over () as n
  from orders where o_orderkey % 3 = 0)
select o_orderkey, 0 as label from zero where pos <= round(0.4 * n)
union all select o_orderkey, o_orderkey % 3 from orders where o_orderkey % 3 <> 0""")
def downsample_zero_exact(spark, folder):
    rows = Tables(spark, folder).base("orders").selectExpr("o_orderkey", "o_orderkey % 3 as label")
    return sampling.downsample_zero(rows, "label", "o_orderkey", exact=True)


@query("upsample_minority", """
with n as (select count(*) filter (toxic = 1) as ones, count(*) filter (toxic = 0) as zeros from labels),
p as (select case when ones > zeros then 0 else 1 end as minor, greatest(ones, zeros) // least(ones, zeros) as ratio from n)
select doc_id, toxic from labels, p, range(p.ratio) where toxic = minor
union all select doc_id, toxic from labels, p where toxic <> minor""")
def upsample_minority(spark, folder):
    return sampling.upsample_minority(Tables(spark, folder).base("labels").select("doc_id", "toxic"), "toxic")


@query("assign_folds", f"""
with n as (select o_orderkey, o_orderstatus, count(*) over () as n, row_number() over (order by o_orderkey) - 1 as pos,
  row_number() over (partition by o_orderstatus order by {hashed('o_orderkey', 7)}) - 1 as inside from orders)
select o_orderkey, {hash_fold('o_orderkey', 5, 7)} as shuffled,
  cast(case when pos < (n % 5) * (n // 5 + 1) then pos // (n // 5 + 1)
       else n % 5 + (pos - (n % 5) * (n // 5 + 1)) // (n // 5) end as int) as run,
  cast(inside % 5 as int) as stratified from n""")
def assign_folds(spark, folder):
    rows = Tables(spark, folder).base("orders").select("o_orderkey", "o_orderstatus")
    rows = sampling.assign_folds(rows, "o_orderkey", salt=7, into="shuffled")
    rows = sampling.assign_folds(rows, "o_orderkey", how="contiguous", into="run")
    rows = sampling.assign_folds(rows, "o_orderkey", how="stratified", label="o_orderstatus", salt=7, into="stratified")
    return rows.drop("o_orderstatus")


@query("shuffle_rows", f"""
select o_orderkey, row_number() over (order by {hashed('o_orderkey', 111)}) - 1 as place from orders""")
def shuffle_rows(spark, folder):
    return sampling.shuffled_places(Tables(spark, folder).base("orders").select("o_orderkey"), "o_orderkey", salt=111)


@query("threshold_route", """
with c as (select quantile_cont(p2, 0.7) as cut from scored)
select k1, k2, k3, p2 > cut as above from scored, c""", ["scored"])
def threshold_route(spark, folder):
    rows = Tables(spark, folder).view("scored")
    cut = ranking.fit_quantiles(rows, ["p2"], [0.7])["p2"][0]
    return sampling.threshold_route(rows.select("k1", "k2", "k3", "p2"), "p2", cut).drop("p2")


@query("parallel_apply", "select o_orderkey, length(o_orderpriority) as letters from orders")
def parallel_apply(spark, folder):
    rows = Tables(spark, folder).base("orders").select("o_orderkey", "o_orderpriority")
    return apply.parallel_apply(
        rows, lambda b: b.assign(letters=b.o_orderpriority.str.len())[["o_orderkey", "letters"]],
        "o_orderkey bigint, letters bigint")
