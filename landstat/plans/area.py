"""Queries on confusion counts and design-based estimates (D17-D19, D25, D39, E1-E17) with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.operators import confusion as c
from landstat.operators import estimators as e
from landstat.plans import bindings as b
from landstat.plans.registry import query, rounded

BY = ["dataset"]
PX = 30.0


def cm(spark: SparkSession, d: str) -> DataFrame:
    return c.confusion(b.ref_map(spark, d), by=BY)


def mapped(spark: SparkSession, d: str) -> DataFrame:
    """Mapped pixels of the classes of each dataset."""
    return b.table(spark, d, "documents").groupBy(F.col("source").alias("dataset"), (F.col("n_chars") % 2).cast("int").alias("map_class")).agg((F.count("*") * 1000).alias("px"))


def am(spark: SparkSession, d: str) -> DataFrame:
    return e.area_error_matrix(cm(spark, d), mapped(spark, d), BY)


CM = "with cm as (select g.dataset, r.c as ref_class, m.c as map_class, cast(count(x.id) as bigint) as n from (select distinct dataset from b_ref_map) g cross join (values (0),(1)) r(c) cross join (values (0),(1)) m(c) left join b_ref_map x on x.dataset = g.dataset and x.ref_class = r.c and x.map_class = m.c group by 1,2,3)"
MAPPED = "mapped as (select source as dataset, cast(n_chars % 2 as int) as map_class, count(*)*1000 as px from documents group by 1,2)"
AM = f"""{CM}, {MAPPED}, j as (select cm.*, cast(coalesce(px,0) as double) as px, cast(sum(n) over (partition by dataset, map_class) as double) as n_j from cm left join mapped using (dataset, map_class)),
 am0 as (select *, px / (sum(case when ref_class = 0 then px end) over (partition by dataset)) as w, sum(case when ref_class = 0 then px end) over (partition by dataset) as total_px from j),
 am as (select *, coalesce(w * n / nullif(n_j,0), 0) as p from am0)"""
EST = f"""{AM}, x0 as (select *, sum(p) over (partition by dataset, map_class) as p_j, sum(p) over (partition by dataset, ref_class) as p_i from am),
 x as (select *, coalesce(sum(case when ref_class=map_class then p end) over (partition by dataset, map_class)/nullif(p_j,0),0) as u_j, coalesce(sum(case when ref_class=map_class then p end) over (partition by dataset, ref_class)/nullif(p_i,0),0) as pa_i, coalesce(n/nullif(n_j,0),0) as s, nullif(n_j-1,0) as less from x0),
 est0 as (select dataset, ref_class as class, max(case when ref_class=map_class then u_j end) as u, max(case when ref_class=map_class then u_j*(1-u_j)/less end) as var_u, max(pa_i) as p, floor(sum(coalesce(px*n/nullif(n_j,0),0))) as n_i,
  coalesce(sum(case when ref_class<>map_class then px*px*s*(1-s)/less end),0) as others, max(case when ref_class=map_class then px*px*(1-pa_i)*(1-pa_i)*u_j*(1-u_j)/less end) as own, count(case when n_j=1 then 1 end) as singles, max(p_i) as a, sum((w*p-p*p)/less) as var_a,
  max(case when ref_class=map_class then n_j end) as n_j, max(case when ref_class=map_class then w end) as w, max(total_px) as total_px from x group by 1,2),
 est as (select *, case when singles=0 then coalesce(1/nullif(n_i*n_i,0),0)*(own+p*p*others) end as var_p, case when singles=0 then sqrt(greatest(0,var_a)) end as se_a from est0)"""


def six(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 as {n.split(' as ')[-1]}" if " as " not in n else f"round({n.split(' as ')[0]}, 6) + 0.0 as {n.split(' as ')[1]}" for n in names)


query("D17_confusion", lambda s, d: cm(s, d), f"{CM} select * from cm")
query("D18_cm_rates", lambda s, d: rounded(c.cm_rates(cm(s, d), BY)), f"{CM}, r as (select *, sum(n) over (partition by dataset, ref_class) as rs, sum(n) over (partition by dataset, map_class) as cs, sum(n) over (partition by dataset) as t from cm) select dataset, ref_class as class, {six('coalesce((cs-n)/nullif(t-rs,0),0) as fpr', 'coalesce(n/nullif(rs,0),0) as tpr', 'coalesce((t-rs-cs+2*n)/nullif(t,0),0) as accuracy')} from r where ref_class=map_class")
query("D19_binary_metrics", lambda s, d: rounded(c.binary_metrics(b.scores(s, d), 0.5, ["grp"])), "with k as (select grp, count_if(score>0.5 and y_true=1) as tp, count_if(score>0.5 and y_true=0) as fp, count_if(score<=0.5 and y_true=1) as fn, count_if(score<=0.5 and y_true=0) as tn from b_scores group by 1) select grp, " + six("coalesce((tp+tn)/nullif(tp+fp+fn+tn,0),0) as accuracy", "coalesce(tp/nullif(tp+fp,0),0) as precision", "coalesce(tp/nullif(tp+fn,0),0) as recall", "coalesce(2*tp/nullif(2*tp+fp+fn,0),0) as f1") + " from k")
query("D25_compute_change", lambda s, d: rounded(c.compute_change(b.scores(s, d), F.col("y_true"), (F.col("score") > 0.5).cast("int"), (F.col("score") > 0.7).cast("int"))), "with k as (select y_true as y, cast(score>0.5 as int) as p, cast(score>0.7 as int) as q from b_scores) select cast(count_if(p<>q) as bigint) as changed, cast(count_if(p<>q and q=y) as bigint) as corrected, cast(count_if(p<>q and q<>y) as bigint) as broken, " + six("2*count_if(p=1 and y=1)/(2*count_if(p=1 and y=1)+count_if(p<>y)) as f1_before", "2*count_if(q=1 and y=1)/(2*count_if(q=1 and y=1)+count_if(q<>y)) as f1_after", "count_if(p=y)/count(*) as accuracy_before", "count_if(q=y)/count(*) as accuracy_after") + " from k")
query("D39_error_breakdown", lambda s, d: c.error_breakdown(b.ref_map(s, d), "stratum"), "select case when ref_class=1 and map_class=1 then 'TP' when map_class=1 then 'FP' when ref_class=1 then 'FN' else 'TN' end as outcome, stratum as category, count(*) as n from b_ref_map group by 1,2")
query("E1_area_error_matrix", lambda s, d: rounded(am(s, d).select("dataset", "ref_class", "map_class", "n", "w", "p")), f"{AM} select dataset, ref_class, map_class, n, {six('w','p')} from am")
query("E2_users_accuracy", lambda s, d: rounded(e.users_accuracy(am(s, d), BY)), f"{EST} select dataset, class, {six('u')} from est")
query("E3_var_users_accuracy", lambda s, d: rounded(e.var_users_accuracy(am(s, d), BY)), f"{EST} select dataset, class, {six('var_u')} from est")
query("E4_producers_accuracy", lambda s, d: rounded(e.producers_accuracy(am(s, d), BY)), f"{EST} select dataset, class, {six('p')} from est")
query("E5_var_producers_accuracy", lambda s, d: rounded(e.class_estimates(am(s, d), BY).select("dataset", "class", "var_p")), f"{EST} select dataset, class, {six('var_p')} from est")
query("E6_overall_accuracy", lambda s, d: rounded(e.overall_accuracy(am(s, d), BY)), f"{EST} select dataset, {six('sum(u*w) as acc', 'case when count(var_u)=count(*) then sum(w*w*var_u) end as var_acc')} from est group by 1")
query("E7_std_area", lambda s, d: rounded(e.class_estimates(am(s, d), BY).select("dataset", "class", "se_a")), f"{EST} select dataset, class, {six('se_a')} from est")
ESTIMATE = f"{EST} select dataset, class, " + six("u", "1.96*sqrt(var_u) as ci_u", "p", "1.96*sqrt(var_p) as ci_p", "sum(u*w) over (partition by dataset) as acc", "1.96*sqrt(case when count(var_u) over (partition by dataset)=count(*) over (partition by dataset) then sum(w*w*var_u) over (partition by dataset) end) as ci_acc", "a as area_pr", "1.96*se_a as ci_pr", "a*total_px as area_px", "1.96*se_a*total_px as ci_px", "a*total_px*0.09 as area_ha", "1.96*se_a*total_px*0.09 as ci_ha") + " from est"
query("E8_area_estimate", lambda s, d: rounded(e.area_estimate(cm(s, d), mapped(s, d), PX, BY)), ESTIMATE)
query("E10_two_class_area", lambda s, d: rounded(e.area_estimate(cm(s, d), mapped(s, d), PX, BY).filter("class = 1").select("dataset", (F.col("area_px") / 1e8).alias("area_mha"), (F.col("ci_px") / 1e8).alias("ci_mha"))), f"{AM}, k as (select dataset, max(total_px) as t, sum(case when ref_class=1 then p end) as a, sum(case when ref_class=1 and n_j>1 then (w*w)*(n/n_j)*(1-n/n_j)/(n_j-1) end) as v, count(case when n_j=1 then 1 end) as singles from am group by 1) select dataset, {six('a*t/1e8 as area_mha', 'case when singles=0 then coalesce(1.96*sqrt(v)*t/1e8,0) end as ci_mha')} from k")


def fractions(s: SparkSession, d: str) -> DataFrame:
    each = b.table(s, d, "documents").groupBy(F.col("source").alias("dataset")).agg(F.avg((F.col("n_chars") % 2 == 1).cast("double")).alias("f_crop"))
    return each.select("dataset", "f_crop", (1 - F.col("f_crop")).alias("f_noncrop"), F.lit(0.8).alias("u_crop"), F.lit(0.7).alias("u_noncrop"))


query("E9_required_samples", lambda s, d: e.required_samples(fractions(s, d), BY), "with f as (select source as dataset, avg(cast(n_chars % 2 = 1 as double)) as fc from documents group by 1), k as (select dataset, cast(round_even(pow((fc*sqrt(cast(0.8 as double)*(1-cast(0.8 as double))) + (1-fc)*sqrt(cast(0.7 as double)*(1-cast(0.7 as double))))/cast(0.02 as double), 2), 0) as bigint) as n from f) select dataset, n, n//2 as n_crop, n - n//2 as n_noncrop from k")


def sizes(s: SparkSession, d: str, by: list[str]) -> DataFrame:
    keys = {"dataset": F.col("source"), "stratum": F.col("lang")}
    return b.table(s, d, "documents").groupBy(*[keys[k].alias(k) for k in by]).agg(F.count("*").alias("size"))


IND = "with ind as (select *, cast(ref_class=map_class as double) as oa_y, cast(ref_class=1 as double) as area_y, cast(ref_class=1 and map_class=1 as double) as ua_y, cast(map_class=1 as double) as ua_x, cast(ref_class=1 and map_class=1 as double) as pa_y, cast(ref_class=1 as double) as pa_x from b_ref_map)"
SIX = ("oa_y", "area_y", "ua_y", "ua_x", "pa_y", "pa_x")
MOM = f"{IND}, mom as (select stratum, count(*) as n, " + ", ".join([f"avg({k}) as mean_{k}" for k in SIX] + [f"var_samp({k}) as var_{k}" for k in SIX]) + ", covar_samp(ua_y, ua_x) as cov_ua, covar_samp(pa_y, pa_x) as cov_pa from ind group by 1)"
POINT = f"{MOM}, sz as (select lang as stratum, cast(count(*) as double) as size from documents group by 1), pt as (select " + ", ".join([f"sum(mean_{k}*size) as {k}" for k in SIX] + [f"sum(size*size*var_{k}/n) as v_{k}" for k in SIX]) + ", sum(size*size*cov_ua/n) as cov_ua, sum(size*size*cov_pa/n) as cov_pa, sum(size) as t from mom join sz using (stratum))"
RATIO = "{k}_y/nullif({k}_x,0)"
SE = "sqrt(greatest(0, v_{k}_y + pow({k}_y/nullif({k}_x,0),2)*v_{k}_x - 2*({k}_y/nullif({k}_x,0))*cov_{k}))/nullif({k}_x,0)"
query("E11_stehman_indicators", lambda s, d: e.stehman_indicators(b.ref_map(s, d), 1).select("id", *SIX), f"{IND} select id, {', '.join(SIX)} from ind")
query("E12_stratum_moments", lambda s, d: rounded(e.stratum_moments(e.stehman_indicators(b.ref_map(s, d), 1))), f"{MOM} select stratum, n, " + six(*[f"mean_{k}" for k in SIX], *[f"var_{k}" for k in SIX], "cov_ua", "cov_pa") + " from mom")


def whole(s: SparkSession, d: str) -> DataFrame:
    return e.stehman(e.stratum_moments(e.stehman_indicators(b.ref_map(s, d), 1)).join(sizes(s, d, ["stratum"]), "stratum"))


query("E13_stehman_point", lambda s, d: rounded(whole(s, d).select("ua", "pa", "oa", "area")), f"{POINT} select " + six(RATIO.format(k="ua") + " as ua", RATIO.format(k="pa") + " as pa", "oa_y/t as oa", "area_y/t as area") + " from pt")
query("E14_stehman_se", lambda s, d: rounded(whole(s, d).select("ua_se", "pa_se", "oa_se", "area_se")), f"{POINT} select " + six(SE.format(k="ua") + " as ua_se", SE.format(k="pa") + " as pa_se", "sqrt(v_oa_y)/t as oa_se", "sqrt(v_area_y)/t as area_se") + " from pt")
query("E15_f1_with_se", lambda s, d: rounded(whole(s, d).select(e.f1_of(F.col("pa"), F.col("ua")).alias("f1"), e.f1_se(F.col("pa"), F.col("ua"), F.col("pa_se"), F.col("ua_se")).alias("f1_se"))), f"{POINT}, q as (select {RATIO.format(k='ua')} as u, {RATIO.format(k='pa')} as p, {SE.format(k='ua')} as du, {SE.format(k='pa')} as dp from pt) select " + six("2*p*u/nullif(p+u,0) as f1", "2*(p*du+u*dp)/(p+u) + 2*p*u*(du+dp)/((p+u)*(p+u)) as f1_se") + " from q")
_OTHER = POINT.replace("ref_class=1 and map_class=1", "ref_class=0 and map_class=0").replace("cast(ref_class=1 as", "cast(ref_class=0 as").replace("cast(map_class=1 as", "cast(map_class=0 as")
query("E16_stehman_report", lambda s, d: rounded(e.stehman_report(b.ref_map(s, d), sizes(s, d, ["stratum"]))), f"{POINT}, q as (select {RATIO.format(k='ua')} as u, {RATIO.format(k='pa')} as p, {SE.format(k='ua')} as du, {SE.format(k='pa')} as dp, oa_y/t as oa, sqrt(v_oa_y)/t as oa_se, area_y/t as area, sqrt(v_area_y)/t as area_se from pt), o as ({_OTHER} select {RATIO.format(k='ua')} as u0, {RATIO.format(k='pa')} as p0, {SE.format(k='ua')} as du0, {SE.format(k='pa')} as dp0 from pt) select " + six("u as crop_ua", "du as crop_ua_se", "p as crop_pa", "dp as crop_pa_se", "oa", "oa_se", "2*p*u/nullif(p+u,0) as crop_f1_score", "2*(p*du+u*dp)/(p+u) + 2*p*u*(du+dp)/((p+u)*(p+u)) as crop_f1_score_se", "u0 as non_crop_ua", "p0 as non_crop_pa", "du0 as non_crop_ua_se", "dp0 as non_crop_pa_se", "area as crop_area_proportion", "area_se as crop_area_proportion_se") + " from q, o")
REPORT = f"""{EST}, k as (select dataset, {', '.join(f"max(case when class={i} then {v} end) as {v}{i}" for v in ('u', 'p', 'var_u', 'var_p') for i in (0, 1))}, case when count(var_u)=count(*) then sum(w*w*var_u) end as var_acc from est group by 1),
 a as (select dataset, {', '.join(f"sum(case when ref_class={i} and map_class={j} then n end) as {m}, sum(case when ref_class={i} and map_class={j} then p end) as {m}_area" for m, i, j in (('tn', 0, 0), ('fp', 0, 1), ('fn', 1, 0), ('tp', 1, 1)))} from am group by 1)
 select dataset, round(coalesce(2*p1*u1/nullif(p1+u1,0),0),2)+0.0 as crop_f1, round(2*(p1*sqrt(var_u1)+u1*sqrt(var_p1))/nullif(p1+u1,0) + 2*p1*u1*(sqrt(var_u1)+sqrt(var_p1))/nullif((p1+u1)*(p1+u1),0),2)+0.0 as std_crop_f1, round(tn_area+tp_area,2)+0.0 as accuracy, round(sqrt(var_acc),2)+0.0 as std_acc, round(p1,2)+0.0 as crop_recall_pa, round(sqrt(var_p1),2)+0.0 as std_crop_pa, round(p0,2)+0.0 as noncrop_recall_pa, round(sqrt(var_p0),2)+0.0 as std_noncrop_pa, round(u1,2)+0.0 as crop_precision_ua, round(sqrt(var_u1),2)+0.0 as std_crop_ua, round(u0,2)+0.0 as noncrop_precision_ua, round(sqrt(var_u0),2)+0.0 as std_noncrop_ua,
  cast(tp+fn as bigint) as crop_support, cast(tn+fp as bigint) as noncrop_support, cast(tn as bigint) as tn, cast(fp as bigint) as fp, cast(fn as bigint) as fn, cast(tp as bigint) as tp, round(tn_area,2)+0.0 as tn_area, round(fp_area,2)+0.0 as fp_area, round(fn_area,2)+0.0 as fn_area, round(tp_area,2)+0.0 as tp_area from k join a using (dataset)"""
query("E17_map_report", lambda s, d: e.map_report(cm(s, d), mapped(s, d), BY), REPORT)
