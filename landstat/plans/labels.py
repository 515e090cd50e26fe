"""Queries on label rules and label tables (A, B, C10, C11, D1-D5, F, G16) with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.operators import labels as l
from landstat.plans import bindings as b
from landstat.plans.registry import query, rounded

AS_OF = "2024-06-01"


def raw(s: SparkSession, d: str) -> DataFrame:
    """Raw labels: points with a collection date."""
    return b.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), ((F.col("o_orderkey") * 7919) % 14000 / 100.0 - 70).alias("lat"), ((F.col("o_orderkey") * 104729) % 36000 / 100.0 - 180).alias("lon"), "o_orderdate", "o_orderstatus", F.col("o_totalprice").alias("price"))


RAW = "raw as (select o_orderkey as id, cast((o_orderkey*7919) % 14000 as double)/100 - 70 as lat, cast((o_orderkey*104729) % 36000 as double)/100 - 180 as lon, o_orderdate, o_orderstatus, o_totalprice as price from orders)"
SOURCE = l.LabelSource("orders", lambda _: l.ProbRule.equals("o_orderstatus", "F"), date_col="moved", filter=lambda df: df.withColumn("moved", F.add_months(F.to_date("o_orderdate"), 300)))
#: The window rule over a date column ``dt`` and the subset rule, in SQL.
WINDOW = f"greatest(make_date(year(dt),1,1), date '2015-07-01') as start_date, least(make_date(year(dt)+1,12,31), date '{AS_OF}' - 1) as end_date"
KEEP = f"make_date(year(dt),1,1) > date '2015-01-01' and greatest(make_date(year(dt),1,1), date '2015-07-01') < least(make_date(year(dt)+1,12,31), date '{AS_OF}' - 1)"
SUBSET = "case when (id*48271) % 2147483647 / cast(2147483647 as double) >= 0.4 then 'training' when (id*48271) % 2147483647 / cast(2147483647 as double) >= 0.2 then 'validation' else 'testing' end as subset"


def plain(s: SparkSession, d: str) -> DataFrame:
    return l.process_source(raw(s, d), SOURCE, AS_OF)


query("B1_process_source", lambda s, d: plain(s, d).select("class_probability", "start_date", "end_date", "lon", "lat", "subset", "eo_status").transform(lambda x: x.withColumns({"start_date": F.col("start_date").cast("string"), "end_date": F.col("end_date").cast("string")})), f"with {RAW}, r as (select *, cast(o_orderdate + interval 300 month as date) as dt from raw) select cast(o_orderstatus='F' as double) as class_probability, cast(greatest(make_date(year(dt),1,1), date '2015-07-01') as varchar) as start_date, cast(least(make_date(year(dt)+1,12,31), date '{AS_OF}' - 1) as varchar) as end_date, round(lon,8) as lon, round(lat,8) as lat, {SUBSET}, 'waiting' as eo_status from r where {KEEP}")
query("B2_class_prob", lambda s, d: l.with_class_prob(raw(s, d), F.col("price") / 1000000).select("id", F.round("class_probability", 6).alias("class_probability")), f"with {RAW} select id, round(price/1000000,6) as class_probability from raw")
query("B3_prob_rules", lambda s, d: b.table(s, d, "part").select("p_partkey", l.ProbRule.equals("p_brand", "Brand#11").alias("equals"), l.ProbRule.percent("p_size").alias("percent"), l.ProbRule.cast("p_size").alias("as_number"), l.ProbRule.flag("p_size").alias("flag"), l.ProbRule.not_in("p_brand", ["Brand#11", "Brand#12"]).alias("not_in")), "select p_partkey, cast(p_brand='Brand#11' as double) as equals, cast(p_size as double)/100 as percent, cast(p_size as double) as as_number, cast(p_size=0 as double) as flag, case when p_brand in ('Brand#11','Brand#12') then 0.0::double else 1.0::double end as not_in from part")
query("B4_drop_unlabeled", lambda s, d: l.drop_unlabeled(b.annotations(s, d), "answer").drop("file_ord"), "select * exclude (file_ord) from b_annotations where answer is not null")
query("B5_clean_annotations", lambda s, d: l.clean_annotations(b.annotations(s, d)).drop("file_ord"), "select * exclude (file_ord, r) from (select *, row_number() over (partition by lat, lon, email order by file_ord) as r from b_annotations where not flagged) where r = 1")
query("B6_require_complete", lambda s, d: l.require_complete(b.annotations(s, d), ("lat", "lon", "answer")).groupBy("set_id").agg(F.count("*").alias("n")), "select set_id, count(*) as n from b_annotations where lat is not null and lon is not null and answer is not null group by 1")


def seasons(s: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    moved = F.date_format(F.date_add(day, ((F.col("o_orderkey") * 37) % 900 - 400).cast("int")), "yyyy-MM-dd")
    return b.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.date_format(day, "yyyy-MM-dd").alias("planting"), F.when(F.col("o_orderkey") % 11 == 0, "unknown").otherwise(moved).alias("harvest"))


SEASON = "k as (select o_orderkey as id, cast(o_orderdate as date) as p, cast(o_orderdate as date) + cast((o_orderkey*37) % 900 - 400 as int) as h from orders where o_orderkey % 11 <> 0), m as (select id, p, h - p as gap, case when h-p < 0 and h-p > -365 then h + 365 else h end as h2 from k)"
query("B7_clean_seasons", lambda s, d: l.clean_seasons(seasons(s, d), range(1992, 1997)).select("id", F.col("harvest_date").cast("string").alias("harvest_date")), f"with {SEASON} select id, cast(h2 as varchar) as harvest_date from m where year(p) between 1992 and 1996 and h2-p between 1 and 365")
query("B7_clean_seasons_strict", lambda s, d: l.clean_seasons(seasons(s, d), range(1992, 1997), strict_reference=True).select("id", F.col("harvest_date").cast("string").alias("harvest_date")), f"with {SEASON} select id, cast(h2 as varchar) as harvest_date from m where year(p) between 1992 and 1996 and gap between 1 and 365")
query("B8_label_window", lambda s, d: l.with_label_window(raw(s, d).withColumn("dt", F.add_months(F.to_date("o_orderdate"), 264)), AS_OF, date_col="dt").select("id", F.col("start_date").cast("string").alias("start_date"), F.col("end_date").cast("string").alias("end_date")), f"with {RAW}, r as (select id, cast(o_orderdate + interval 264 month as date) as dt from raw), k as (select id, {WINDOW} from r where {KEEP}) select id, cast(start_date as varchar) as start_date, cast(end_date as varchar) as end_date from k")
query("B9_finalize_points", lambda s, d: l.finalize_points(b.points(s, d)).select("id", "lat", "lon", "class_probability"), "select id, round(lat,8) as lat, round(lon,8) as lon, class_probability from b_points where class_probability is not null")
query("B10_eo_status", lambda s, d: l.with_eo_status(b.points(s, d)).groupBy("eo_status").agg(F.count("*").alias("n")), "select case when class_probability=0.5 then 'skipped' else 'waiting' end as eo_status, count(*) as n from b_points group by 1")
TRAIN, EVAL = ("AUTOMOBILE", "BUILDING", "MACHINERY"), ("BUILDING", "FURNITURE")
query("B11_select_rows", lambda s, d: l.select_rows(b.points(s, d), "training", TRAIN, EVAL), "select * from b_points where class_probability<>0.5 and ((dataset in ('BUILDING','FURNITURE') and subset='training') or dataset in ('AUTOMOBILE','MACHINERY'))")
query("B12_up_to_year", lambda s, d: l.up_to_year(plain(s, d), 2019).groupBy("subset").agg(F.count("*").alias("n")), f"with {RAW}, r as (select *, cast(o_orderdate + interval 300 month as date) as dt from raw), k as (select {SUBSET}, {WINDOW} from r where {KEEP}) select subset, count(*) as n from k where year(start_date) <= 2019 group by 1")
BOX = (-20.0, 40.0, -60.0, 120.0)
query("B13_is_local", lambda s, d: l.with_is_local(b.points(s, d), BOX).select("id", "is_local"), "select id, lat between -20 and 40 and lon between -60 and 120 as is_local from b_points")
query("B13_count_not_local", lambda s, d: l.count_not_local(b.points(s, d), BOX), "select cast(count_if(not (lat between -20 and 40 and lon between -60 and 120)) as bigint) as outside, count(*) as n from b_points")
query("B14_evaluation_points", lambda s, d: l.evaluation_points(b.points(s, d)), "select *, cast(class_probability as int) as binary from b_points where subset='testing' and class_probability in (0,1)")
query("B17_answer_to_class", lambda s, d: b.annotations(s, d).groupBy(F.coalesce(l.answer_to_class(F.col("answer")), F.lit(-1)).alias("class")).agg(F.count("*").alias("n")), "select case answer when 'Crop' then 1 when 'Non-crop' then 0 else -1 end as class, count(*) as n from b_annotations group by 1")
query("B21_missing_datasets", lambda s, d: l.missing_datasets(b.points(s, d).select("dataset").distinct(), b.points(s, d).filter("subset = 'testing' and country like 'A%'").select("dataset").distinct()), "select distinct dataset from b_points where dataset not in (select dataset from b_points where subset='testing' and country like 'A%')")
CATALOG = "p_partkey as id, case when p_size % 3 > 0 then p_size / cast(50 as double) end as threshold"
query("B21_bad_maps", lambda s, d: l.bad_maps(b.table(s, d, "part").selectExpr(*CATALOG.split(", "), "case when p_size % 2 = 0 then array(p_size) when p_size % 5 = 0 then array() end as crop_classes")).select("id", "problem"), "with c as (select p_partkey as id, p_size % 3 > 0 as t, p_size % 2 = 0 as k from part) select id, case when t then 'both' else 'neither' end as problem from c where t = k")
query("B21_bad_splits", lambda s, d: l.bad_splits(b.table(s, d, "customer").selectExpr("c_custkey as id", "cast(c_custkey % 10 as double) / 10 as train", "case when c_custkey % 7 > 0 then cast(0.2 as double) end as val", "cast(c_custkey % 4 as double) / 10 as test")).selectExpr("id", "round(total, 6) as total"), "select c_custkey as id, case when c_custkey % 7 > 0 then round((c_custkey % 10 + 2 + c_custkey % 4) / cast(10 as double), 6) end as total from customer where c_custkey % 7 = 0 or c_custkey % 10 + 2 + c_custkey % 4 <> 10")
S1, S2 = "b_annotations where set_id=1", "b_annotations where set_id=2"


def sets(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    a = b.annotations(s, d)
    return a.filter("set_id = 1"), a.filter("set_id = 2")


query("B22_check_sets", lambda s, d: l.check_sets(*sets(s, d)), "with c as (select count(*) as common from (select distinct plotid, sampleid from b_annotations where set_id=1 intersect select distinct plotid, sampleid from b_annotations where set_id=2)) select set_id, count(*) as n, count(distinct (plotid, sampleid)) as plots, cast(count_if(answer is null) as bigint) as missing, max(common) as common from b_annotations, c group by 1")
query("A3_read_sets", lambda s, d: l.read_sets({k: x.drop("set_id", "file_ord") for k, x in zip((1, 2), sets(s, d))}), "select * exclude (file_ord) from b_annotations")
query("A6_export_training", lambda s, d: l.export_training_table(b.points(s, d).withColumn("eo_data", F.when(F.col("id") % 4 != 0, F.concat(F.lit("eo"), F.col("id"))))), "select dataset, cast(class_probability>0.5 as int) as is_crop, lat, lon, subset, num_labelers, country, concat('eo', id) as eo_data from b_points where id % 4 <> 0 and class_probability<>0.5")
query("A7_export_points", lambda s, d: l.export_points(b.points(s, d)), "select lat as latitude, lon as longitude, subset, class_probability as is_crop from b_points where class_probability<>0.5 and num_labelers>1")
EXIST = lambda s, d: b.points(s, d).filter("subset = 'training'").select("id", F.col("dataset").alias("source"), (F.col("id") % 2 + 2020).alias("start_year"))
INCOME = lambda s, d: b.points(s, d).filter("subset <> 'training'").select("id", F.col("dataset").alias("source"), (F.col("id") % 5 + 2019).alias("start_year"))
query("A13_ingest_new_sources", lambda s, d: l.ingest_new_sources(EXIST(s, d), INCOME(s, d)), "with e as (select id, dataset as source, id % 2 + 2020 as start_year from b_points where subset = 'training'), i as (select id, dataset as source, id % 5 + 2019 as start_year from b_points where subset <> 'training') select * from e union all select i.* from i where not exists (select 1 from e where e.source=i.source and e.start_year=i.start_year)")
LOG = lambda s, d: b.scores(s, d).select(F.col("grp").alias("model"), F.col("id").alias("run_ts"), F.col("score").alias("accuracy"))
query("A10_latest_metrics", lambda s, d: l.latest_metrics(l.upsert_metrics(LOG(s, d).filter("run_ts % 2 = 0"), LOG(s, d).filter("run_ts % 2 = 1"))), "select model, run_ts, accuracy from (select grp as model, id as run_ts, score as accuracy, row_number() over (partition by grp order by id desc) as r from b_scores) where r = 1")
query("C10_anti_rows", lambda s, d: l.rows_not_in(b.points(s, d), b.points(s, d).filter("subset = 'testing'"), ["country", "dataset"]), "select * from b_points p where not exists (select 1 from b_points q where q.subset='testing' and q.country=p.country and q.dataset=p.dataset)")
query("C11_common_plots", lambda s, d: l.common_plots(*sets(s, d)).select("plotid", "sampleid", "email"), "select plotid, sampleid, email from b_annotations a where set_id=1 and exists (select 1 from b_annotations c where c.set_id=2 and c.plotid=a.plotid and c.sampleid=a.sampleid)")


def placed(s: SparkSession, d: str) -> DataFrame:
    p = l.answer_to_class(F.col("answer")).cast("double")
    return b.annotations(s, d).select("lon", "lat", "email", p.alias("class_probability"), F.lit(1).alias("num_labelers"))


query("D1_merge_labels", lambda s, d: rounded(l.merge_labels(placed(s, d)), 6), "select round(lon,6)+0.0 as lon, round(lat,6)+0.0 as lat, round(avg(case answer when 'Crop' then 1.0::double when 'Non-crop' then 0.0::double end),6)+0.0 as class_probability, count(*) as num_labelers, string_agg(distinct email, ',' order by email) as email from b_annotations group by b_annotations.lon, b_annotations.lat")
WIN = lambda s, d: b.points(s, d).withColumns({"lat": F.floor(F.col("lat") / 10).cast("double"), "lon": F.floor(F.col("lon") / 10).cast("double"), "start_date": F.lit("2020-01-01"), "end_date": F.lit("2021-12-31")})
query("D2_merge_windows", lambda s, d: rounded(l.merge_label_windows(WIN(s, d))), "with w as (select *, floor(lat/10) as la, floor(lon/10) as lo from b_points) select lo as lon, la as lat, '2020-01-01' as start_date, '2021-12-31' as end_date, round(avg(class_probability),6) as class_probability, count(*) as num_labelers, arg_min(subset, id) as subset, arg_min(country, id) as country, string_agg(dataset, ',' order by id) as datasets from w group by 1,2")
query("D3_min_labelers", lambda s, d: l.min_labelers(b.points(s, d), 2), "select * from b_points where num_labelers >= 2")
query("D4_dataset_report", lambda s, d: rounded(l.dataset_report(b.points(s, d))), "select dataset, subset, count(*) as n, round(avg(cast(class_probability=0.5 as double)),6) as disagreement, round(coalesce(avg(case when class_probability<>0.5 then cast(class_probability>0.5 as double) end),0),6) as positive from b_points group by 1,2")
query("D5_test_set_stats", lambda s, d: l.test_set_stats(b.points(s, d)), "select dataset, count(*) as n, cast(count_if(class_probability=1) as bigint) as crop, round(avg(cast(class_probability as int)),3) as crop_rate from b_points where class_probability in (0,1) group by 1")
BOXES = lambda s, d: b.regions(s, d).select(F.col("region").alias("name"), F.col("y0").alias("min_lat"), F.col("y1").alias("max_lat"), F.col("x0").alias("min_lon"), F.col("x1").alias("max_lon"))
query("D5_local_amounts", lambda s, d: l.local_amounts(b.points(s, d), BOXES(s, d)), "select region as name, subset, count(*) as n from b_points join b_regions on lat between y0 and y1 and lon between x0 and x1 group by 1,2")
query("C5_join_bbox", lambda s, d: l.join_bbox(b.points(s, d), BOXES(s, d)).select("id", "name"), "select id, region as name from b_points join b_regions on lat between y0 and y1 and lon between x0 and x1")
query("F1_keep_first", lambda s, d: l.keep_first(b.annotations(s, d), ["plotid"], ["file_ord"]).drop("file_ord"), "select * exclude (file_ord, r) from (select *, row_number() over (partition by plotid order by file_ord) as r from b_annotations) where r=1")
query("F2_distinct_rows", lambda s, d: b.annotations(s, d).drop("file_ord").distinct(), "select distinct * exclude (file_ord) from b_annotations")
query("F3_duplicate_report", lambda s, d: l.duplicate_report(b.annotations(s, d), "plotid"), "select plotid, count(*) as n from b_annotations group by 1 having count(*) > 1")
query("F7_drop_tail", lambda s, d: l.drop_tail(b.points(s, d), 10, ["dataset"], ["id"]), "select * exclude (r) from (select *, row_number() over (partition by dataset order by id desc) as r from b_points) where r > 10")
query("F9_share", lambda s, d: rounded(l.share(b.points(s, d), "subset", ["dataset"])), "select dataset, subset, count(*) as n, round(count(*)/sum(count(*)) over (partition by dataset),6) as share from b_points group by 1,2")
query("D42_value_share", lambda s, d: rounded(l.share(b.table(s, d, "part"), "p_brand")), "select p_brand, count(*) as n, round(count(*)/sum(count(*)) over (),6) as share from part group by 1")
query("F11_union_all", lambda s, d: l.union_all(b.points(s, d).select("id", "dataset"), b.points(s, d).select("id", "country")), "select id, dataset, null as country from b_points union all select id, null, country from b_points")
query("F12_common_ids", lambda s, d: l.common_ids(*[x.select("plotid") for x in sets(s, d)]), "select plotid from b_annotations where set_id=1 intersect select plotid from b_annotations where set_id=2")
query("F13_rows_not_in", lambda s, d: l.rows_not_in(*sets(s, d), ["plotid"]).select("plotid", "email"), "select plotid, email from b_annotations where set_id=1 and plotid not in (select plotid from b_annotations where set_id=2)")
query("F14_apply_assignment", lambda s, d: l.apply_assignment(b.points(s, d).select("id", "country"), b.points(s, d).filter("subset <> 'testing'"), "id"), "select p.id, p.country, q.subset from b_points p left join (select id, subset from b_points where subset <> 'testing') q using (id)")
query("I1_split_subsets", lambda s, d: l.split_subsets(b.points(s, d).select("id")), f"select id, {SUBSET} from b_points")
for rule, sql in {"training": "select id, cast(class_probability>=0.5 as int) as is_crop from b_points", "export": "select id, cast(class_probability>0.5 as int) as is_crop from b_points where class_probability<>0.5", "unanimous": "select id, cast(class_probability as int) as is_crop from b_points where class_probability in (0,1)"}.items():
    query(f"B_binarize_{rule}", lambda s, d, r=rule: l.binarize_labels(b.points(s, d), r).select("id", "is_crop"), sql)
query("G16_join_unique", lambda s, d: b.annotations(s, d).groupBy("plotid").agg(l.join_unique(F.col("email")).alias("emails"), l.join_if_all(F.col("answer"), F.col("file_ord")).alias("answers")), "select plotid, string_agg(distinct email, ',' order by email) as emails, case when count(answer)=count(*) then string_agg(answer, ',' order by file_ord) else '' end as answers from b_annotations group by 1")
