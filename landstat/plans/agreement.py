"""Queries on labeler agreement and on score metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.operators import confusion as cf
from landstat.operators import consensus as c
from landstat.operators import labels as l
from landstat.operators import metrics as m
from landstat.plans import bindings as b
from landstat.plans.registry import query, rounded


def firsts(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """One label a plot in each set."""
    a = b.annotations(s, d)
    return tuple(l.keep_first(a.filter(F.col("set_id") == k), ["plotid"], ["file_ord"]) for k in (1, 2))


def paired(s: SparkSession, d: str) -> DataFrame:
    return c.pair_sets(*firsts(s, d), b.final_labels(s, d), keys=["plotid"])


def table(s: SparkSession, d: str) -> DataFrame:
    return c.consensus(paired(s, d))


FIRST = "f as (select * exclude (r), cast(split_part(analysis_duration,' ',1) as double) as secs from (select *, row_number() over (partition by set_id, plotid order by file_ord) as r from b_annotations) where r=1)"
PAIR = f"with {FIRST}, p as (select a.plotid, a.answer as answer1, a.email as email1, a.secs as secs1, z.answer as answer2, z.email as email2, z.secs as secs2, g.answer as final from f a join f z on a.plotid=z.plotid and a.set_id=1 and z.set_id=2 join b_final g on g.plotid=a.plotid)"
CON = f"{PAIR}, c0 as (select *, case when answer1=final then '2' when answer2=final then '1' else 'both' end as side from p where not coalesce(answer1=answer2,false)), c as (select *, case side when '1' then answer1 when '2' then answer2 end as ol, case side when '1' then email1 when '2' then email2 end as oe, case side when '1' then secs1 when '2' then secs2 end as os, case side when '1' then secs2 when '2' then secs1 end as ks from c0), o as (select answer1 as label, email1 as email, final from c where side in ('1','both') union all select answer2, email2, final from c where side in ('2','both'))"
query("C1_pair_sets", paired, f"{PAIR} select * from p")
query("E22_consensus", lambda s, d: table(s, d).select("plotid", "overridden_side", "overridden_label", "overridden_email", "overridden_secs", "kept_secs"), f"{CON} select plotid, side as overridden_side, ol as overridden_label, oe as overridden_email, os as overridden_secs, ks as kept_secs from c")
query("B18_change_class", lambda s, d: b.ref_map(s, d).groupBy(c.change_class(F.col("ref_class"), F.col("map_class")).alias("code"), c.change_name(F.col("ref_class"), F.col("map_class")).alias("name")).agg(F.count("*").alias("n")), "select ref_class*2+map_class as code, case ref_class*2+map_class when 3 then 'Stable P' when 0 then 'Stable NP' when 2 then 'P loss' else 'P gain' end as name, count(*) as n from b_ref_map group by 1,2")
query("B19_resolve_labels", lambda s, d: c.resolve_labels(*firsts(s, d), ["u1", "u2", "u3"], ["u4", "u5"], b.final_labels(s, d).filter("answer = 'Non-crop'"), -100.0), f"with {FIRST} select a.plotid, coalesce(g.answer, case when a.answer=z.answer then a.answer end, case when z.answer is null then a.answer end, case when a.email in ('u1','u2','u3') then a.answer end, case when z.email in ('u4','u5') then z.answer end) as label from f a join f z on a.plotid=z.plotid and a.set_id=1 and z.set_id=2 left join (select * from b_final where answer = 'Non-crop') g on g.plotid=a.plotid where a.lon >= -100 and label is not null")
query("G1_duration_secs", lambda s, d: b.annotations(s, d).groupBy("email").agg(F.sum(c.duration_secs(F.col("analysis_duration"))).alias("secs")), "select email, sum(cast(split_part(analysis_duration,' ',1) as double)) as secs from b_annotations group by 1")
query("D8_labeler_disagreement", lambda s, d: rounded(c.labeler_disagreement(b.points(s, d).select(F.concat(F.lit("u"), F.col("id") % 7, F.lit(",u"), F.col("id") % 11).alias("labelers"), "class_probability"))), "select labeler, count(*) as n, cast(count_if(p=0.5) as bigint) as n_disagree, round(count_if(p=0.5)/count(*),6) as ratio from (select unnest(['u' || (id % 7), 'u' || (id % 11)]) as labeler, class_probability as p from b_points) group by 1")
query("D9_label_overrides", lambda s, d: c.label_overrides(table(s, d)), f"{CON} select label, count(*) as n from o group by 1")
query("D10_label_mistakes", lambda s, d: c.label_mistakes(table(s, d)), f"{CON} select final as label, count(*) as n from c group by 1")
query("D11_label_disagreements", lambda s, d: c.label_disagreements(table(s, d)), f"{CON} select least(coalesce(answer1,'none'),coalesce(answer2,'none')) as label_a, greatest(coalesce(answer1,'none'),coalesce(answer2,'none')) as label_b, count(*) as n from c group by 1,2")
query("D12_label_transitions", lambda s, d: c.label_transitions(table(s, d)), f"{CON} select label, final, count(*) as n from o group by 1,2")
query("D13_labeler_overrides", lambda s, d: c.labeler_overrides(table(s, d)), f"{CON} select email, count(*) as n from o group by 1")
query("D14_median_durations", lambda s, d: c.median_durations(table(s, d)), f"{CON} select median(os) as overridden, median(ks) as kept from c")
query("D15_slow_points", lambda s, d: c.slow_points(table(s, d), 0.9).select("plotid", "secs1", "secs2"), f"{CON}, q as (select quantile_cont(x, cast(0.9 as double)) as cut from (select secs1 as x from c union all select secs2 from c)) select plotid, secs1, secs2 from c, q where secs1>=cut or secs2>=cut")
query("D15_slow_transitions", lambda s, d: c.label_transitions(c.slow_points(table(s, d), 0.9)), f"{CON}, q as (select quantile_cont(x, cast(0.9 as double)) as cut from (select secs1 as x from c union all select secs2 from c)), z as (select * from c, q where secs1>=cut or secs2>=cut), oo as (select answer1 as label, final from z where side in ('1','both') union all select answer2, final from z where side in ('2','both')) select label, final, count(*) as n from oo group by 1,2")
query("D16_agreement_summary", lambda s, d: rounded(c.agreement_summary(paired(s, d))), f"{PAIR} select count(*) as n, round(avg(cast(coalesce(answer1=answer2,false) as double)),6) as agreement, cast(count_if(answer1 is null) as bigint) as missing1, cast(count_if(answer2 is null) as bigint) as missing2 from p")
query("C12_outer_counts", lambda s, d: c.outer_counts(firsts(s, d), "email"), f"with {FIRST} select email, cast(count_if(set_id=1) as bigint) as n1, cast(count_if(set_id=2) as bigint) as n2 from f group by 1")
query("D43_compare_exports", lambda s, d: rounded(c.compare_exports(*firsts(s, d), ["plotid"])), f"with {FIRST} select count(*) as n, round(avg(cast(coalesce(a.answer=z.answer,false) as double)),6) as same_answer, round(avg(cast(a.lat=z.lat and a.lon=z.lon as double)),6) as same_place from f a join f z on a.plotid=z.plotid and a.set_id=1 and z.set_id=2")
query("D44_slow_points_approx", lambda s, d: c.slow_points(table(s, d), 0.9, approx=True).select("plotid", "secs1", "secs2"))
query("D44_distinct_labelers_exact", lambda s, d: c.distinct_labelers(b.annotations(s, d), ["set_id"], approx=False), "select set_id, count(distinct email) as labelers from b_annotations group by 1")
query("D44_distinct_labelers", lambda s, d: c.distinct_labelers(b.annotations(s, d), ["set_id"]))
query("F6_sorted_overrides", lambda s, d: c.label_overrides(table(s, d)).orderBy("label"), f"{CON} select label, count(*) as n from o group by 1 order by 1")

SC = "with k as (select grp, score, count_if(y_true=1) as pos, count_if(y_true=0) as neg from b_scores group by 1,2)"
HIT = f"{SC}, h as (select grp, score, sum(pos) over (partition by grp order by score desc) as tp, sum(neg) over (partition by grp order by score desc) as fp from k)"
query("F10_cumulative_hits", lambda s, d: m.cumulative_hits(b.scores(s, d), ["grp"]), f"{HIT} select grp, score, cast(tp as bigint) as tp, cast(fp as bigint) as fp from h")
query("D20_roc_auc", lambda s, d: rounded(m.roc_auc(b.scores(s, d), ["grp"])), "with r as (select grp, y_true, rank() over (partition by grp order by score) as lo, count(*) over (partition by grp, score) as t from b_scores) select grp, round((sum(case when y_true=1 then lo + (t-1)/2.0::double end) - count_if(y_true=1)*(count_if(y_true=1)+1)/2)/(count_if(y_true=1)*count_if(y_true=0)),6) as auc from r group by 1")
query("D20_roc_curve", lambda s, d: rounded(m.roc_curve(b.scores(s, d), ["grp"])), f"{HIT} select grp, round(score,6)+0.0 as threshold, round(fp/max(fp) over (partition by grp),6) as fpr, round(tp/max(tp) over (partition by grp),6) as tpr from h")
SWEEP = "with t as (select unnest(range(0,100)) as k), w as (select grp, k, count_if(y_true=1 and score>k/100) as tp, count_if(y_true=0 and score>k/100) as fp, count_if(y_true=1 and score<=k/100) as fn, count_if(y_true=0 and score<=k/100) as tn from b_scores, t group by 1,2)"
query("D21_threshold_sweep", lambda s, d: m.threshold_sweep(b.scores(s, d), ["grp"]), f"{SWEEP} select grp, cast(k as int) as k, cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(fn as bigint) as fn, cast(tn as bigint) as tn from w")
query("D21_best_f1_threshold", lambda s, d: rounded(m.best_f1_threshold(b.scores(s, d), ["grp"])), f"{SWEEP}, f as (select *, coalesce(2*tp/nullif(2*tp+fp+fn,0),0) as f1, row_number() over (partition by grp order by coalesce(2*tp/nullif(2*tp+fp+fn,0),0) desc, k) as r from w) select grp, round(k/100,6) as threshold, round(f1,6) as f1 from f where r=1")
query("D22_threshold_for_fpr", lambda s, d: rounded(m.threshold_for_fpr(b.scores(s, d), 0.1, ["grp"])), f"{HIT}, g as (select grp, score, fp/max(fp) over (partition by grp) as fpr from h) select grp, round(score,6) as threshold from (select *, row_number() over (partition by grp order by abs(fpr-cast(0.1 as double)), score desc) as r from g) where r=1")
query("D23_threshold_effect", lambda s, d: rounded(m.threshold_effect(b.scores(s, d), [0.25, 0.5, 0.75], ["grp"])), "select grp, threshold, round(count_if(score>threshold and y_true=0)/count_if(y_true=0),6) as fpr, round(count_if(score>threshold and y_true=1)/count_if(y_true=1),6) as tpr from b_scores, (select unnest([0.25::double,0.5::double,0.75::double]) as threshold) group by 1,2")
RATES = "round(count_if((score>{t})=(y_true=1))/count(*),{r}) as {p}accuracy, round(coalesce(count_if(score>{t} and y_true=1)/nullif(count_if(score>{t}),0),0),{r}) as {p}precision, round(coalesce(count_if(score>{t} and y_true=1)/nullif(count_if(y_true=1),0),0),{r}) as {p}recall, round(coalesce(2*count_if(score>{t} and y_true=1)/nullif(count_if(score>{t})+count_if(y_true=1),0),0),{r}) as {p}f1"
query("D24_f1_by_balance", lambda s, d: rounded(m.f1_by_balance(b.scores(s, d), [10, 25, 50, 100])), f"with e as (select *, (id*48271) % 2147483647 % 100 as draw from b_scores) select percent, {RATES.format(t=0.5, r=6, p='')} from e, (select unnest([10, 25, 50, 100])::int as percent) where y_true=1 or draw<percent group by 1")
query("D40_split_metrics", lambda s, d: rounded(m.split_metrics(b.scores(s, d), "id")), f"with c as (select median(id) as cut from b_scores) select case when id>cut then 'above' else 'below' end as half, {RATES.format(t=0.5, r=6, p='')} from b_scores, c group by 1")
query("D41_cloudy_months", lambda s, d: rounded(m.cloudy_months(b.table(s, d, "embeddings"), "embedding", [0.5, 0.7, 0.9], ["label"])), "select label, round(avg(len(list_filter(embedding, lambda x: cast(x as double) > cast(0.5 as double)))),6) as above_50, round(avg(len(list_filter(embedding, lambda x: cast(x as double) > cast(0.7 as double)))),6) as above_70, round(avg(len(list_filter(embedding, lambda x: cast(x as double) > cast(0.9 as double)))),6) as above_90 from embeddings group by 1")
query("J11_evaluate", lambda s, d: m.evaluate(b.scores(s, d), 0.5, 0.7, ["grp"]), f"with r as (select *, rank() over (partition by grp order by score) as lo, count(*) over (partition by grp, score) as t from b_scores) select grp, {RATES.format(t=0.5, r=4, p='')}, round((sum(case when y_true=1 then lo + (t-1)/2.0::double end) - count_if(y_true=1)*(count_if(y_true=1)+1)/2)/(count_if(y_true=1)*count_if(y_true=0)),4) as auc, {RATES.format(t=0.7, r=4, p='thresh0_7_')} from r group by 1")
query("D20_roc_auc_whole", lambda s, d: rounded(m.roc_auc(b.scores(s, d))), "with r as (select y_true, rank() over (order by score) as lo, count(*) over (partition by score) as t from b_scores) select round((sum(case when y_true=1 then lo + (t-1)/2.0::double end) - count_if(y_true=1)*(count_if(y_true=1)+1)/2)/(count_if(y_true=1)*count_if(y_true=0)),6) as auc from r")
