"""Queries on pixel tables, maps, regions and distances (A8, A9, A11, A14, B15, B16, B20, C2-C9, C13, C15, D6, D7, D29-D38, E18-E21, F4, F5, F15, G2-G7, G19-G22, H, I2-I6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.functions import geo
from landstat.operators import areas as ar
from landstat.operators import confusion as cf
from landstat.operators import labels as l
from landstat.operators import points as p
from landstat.operators import spans as sp
from landstat.operators import triangles as tr
from landstat.operators import raster as r
from landstat.plans import bindings as b
from landstat.plans.registry import query, rounded

META = {"a": 3.6, "b": 0.0, "c": -180.0, "d": 0.0, "e": -0.7, "f": 70.0}
PX = 30.0
ROW, COL = "cast(floor((lat - 70.0::double)*3.6::double/(3.6::double*(-0.7::double))) as int)", "cast(floor((lon + 180.0::double)*(-0.7::double)/(3.6::double*(-0.7::double))) as int)"
CLASS = "case when value=255 then null when value<0.5 then 0 else 1 end"


def one_map(s: SparkSession, d: str, name: str = "A") -> DataFrame:
    return b.pixels(s, d).filter(F.col("map") == name)


def classes(s: SparkSession, d: str) -> DataFrame:
    return b.pixels(s, d).withColumn("class", r.binarize(F.col("value")))


def rings(s: SparkSession, d: str) -> DataFrame:
    return b.regions(s, d).withColumn("ring", geo.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))


def places(s: SparkSession, d: str) -> DataFrame:
    return b.points(s, d).select("id", "lat", "lon", "subset")


def all_pairs(s: SparkSession, d: str, **how) -> DataFrame:
    here = places(s, d)
    return rounded(p.pairwise_distance(here, here, **how), 4)


CATALOG = [("m_size", 25.0, None), ("m_key", None, [1, 2, 3, 5, 8, 13, 21, 34]), ("m_price", 25.0, None)]
MAPS = [m for m, _, _ in CATALOG]


def catalog(s: SparkSession) -> DataFrame:
    return s.createDataFrame(CATALOG, "map string, threshold double, crop_classes array<int>")


def flags(s: SparkSession, d: str) -> DataFrame:
    return r.with_crop_flag(b.map_values(s, d), catalog(s))


FLAG = "fl as (select id, map, value, cast(case when map='m_key' then cast(value as int) in (1,2,3,5,8,13,21,34) else value>=25 end as int) as crop from b_map_values)"
query("A11_tiles_to_pixels", lambda s, d: r.tiles_to_pixels(r.pixels_to_tiles(b.pixels(s, d), 10, 10), 10, 10).filter("value <> 255"), "select * from b_pixels where value <> 255")
query("B15_crop_flag", lambda s, d: flags(s, d).select("id", "map", "crop"), f"with {FLAG} select id, map, crop from fl")
query("B16_binarize", lambda s, d: classes(s, d).withColumn("class", F.coalesce("class", F.lit(-1))).select("map", "row", "col", "class"), f"select map, row, col, coalesce({CLASS}, -1) as class from b_pixels")
query("B20_demote", lambda s, d: b.scores(s, d).select("id", r.demote((F.col("score") > 0.5).cast("int"), F.col("id") % 5 == 0, F.col("score") < 0.6).alias("pred")), "select id, case when id % 5 = 0 or score < 0.6 then 0 else cast(score>0.5 as int) end as pred from b_scores")
query("C2_attach_map_values", lambda s, d: r.attach_map_values(b.table(s, d, "part").select(F.col("p_partkey").alias("id")), b.map_values(s, d), MAPS), "select id, max(case when map='m_size' then value end) as m_size, max(case when map='m_key' then value end) as m_key, max(case when map='m_price' then value end) as m_price from b_map_values group by 1")
SAMPLED = f"sp as (select q.id, q.class_probability, q.country, coalesce(x.value, -1) as value from (select *, {ROW} as row, {COL} as col from b_points) q left join (select * from b_pixels where map='A') x using (row, col))"
query("C3_sample_raster", lambda s, d: r.sample_raster(b.points(s, d), one_map(s, d), META).select("id", F.coalesce("value", F.lit(-1.0)).alias("value")), f"with {SAMPLED} select id, value from sp")
query("C4_sample_zonal", lambda s, d: r.sample_zonal(b.points(s, d), one_map(s, d), META), f"with q as (select id, {ROW} + i as row, {COL} + j as col from b_points, (select unnest([-1,0,1]) as i), (select unnest([-1,0,1]) as j)), k as (select id, value, count(*) as n from q join (select * from b_pixels where map='A') using (row, col) group by 1,2) select id, value from (select *, row_number() over (partition by id order by n desc, value) as o from k) where o=1")
INSIDE = "lon >= x0 and lon < x1 and lat >= y0 and lat < y1"
query("C6_join_regions", lambda s, d: p.join_regions(b.points(s, d), rings(s, d)).select("id", "region"), f"select id, region from b_points join b_regions on {INSIDE}")
query("C6_join_regions_by_leaves", lambda s, d: p.join_regions(b.points(s, d), rings(s, d), most=0, most_points=500).select("id", "region"), f"select id, region from b_points join b_regions on {INSIDE}")
HAV = "6371*2*atan2(sqrt(h), sqrt(greatest(0, 1-h)))"
H = "pow(sin((radians({1}.lat)-radians({0}.lat))/2),2) + cos(radians({0}.lat))*cos(radians({1}.lat))*pow(sin((radians({1}.lon)-radians({0}.lon))/2),2)"
PAIRS = f"pr as (select id_a, id_b, sa, sb, {HAV} as km, la, lo, lb, ob from (select a.id as id_a, z.id as id_b, a.subset as sa, z.subset as sb, a.lat as la, a.lon as lo, z.lat as lb, z.lon as ob, {H.format('a', 'z')} as h from b_points a, b_points z))"
ALL_KM = "round(avg(km),4) as avg_km, round(min(case when not (la=lb and lo=ob) then km end),4) as min_km, round(max(km),4) as max_km"
query("C7_within_distance", lambda s, d: p.within_distance(places(s, d), places(s, d), 300.0, digits=4).filter("id_a <> id_b"), f"with {PAIRS} select id_a, id_b, round(km,4)+0.0 as km from pr where km <= 300 and id_a <> id_b")
query("C8_nearest", lambda s, d: rounded(p.nearest(places(s, d), places(s, d), other=True), 4), f"with {PAIRS} select id_a, id_b, round(km,4)+0.0 as km from (select *, row_number() over (partition by id_a order by km, id_b) as o from pr where id_a <> id_b) where o=1")
query("C8_nearest_three", lambda s, d: rounded(p.nearest(b.points(s, d), b.table(s, d, "supplier").selectExpr("s_suppkey as id", "((s_suppkey * 7919) % 600) / 20.0D as lat", "((s_suppkey * 104729) % 900) / 20.0D as lon"), k=3), 4), f"with z as (select s_suppkey as id, ((s_suppkey*7919) % 600)/20.0::double as lat, ((s_suppkey*104729) % 900)/20.0::double as lon from supplier), pr as (select id_a, id_b, {HAV} as km from (select a.id as id_a, z.id as id_b, {H.format('a', 'z')} as h from b_points a, z)) select id_a, id_b, round(km,4)+0.0 as km from (select *, row_number() over (partition by id_a order by km, id_b) as o from pr) where o<=3")
query("C9_pairwise_distance", lambda s, d: all_pairs(s, d), f"with {PAIRS} select {ALL_KM} from pr")
query("D29_distance_metrics", lambda s, d: all_pairs(s, d, by=["subset"], own=True), f"with {PAIRS} select sa as subset, {ALL_KM} from pr where sa = sb and id_a <> id_b group by 1")
query("D30_density_report", lambda s, d: rounded(p.density_report(b.points(s, d), ["dataset", "subset"]), 4), "select dataset, subset, count(*) as n, round((max(lat)-min(lat))*111*((max(lon)-min(lon))*111),4) as area_km2, round(count(*)*100/nullif((max(lat)-min(lat))*111*((max(lon)-min(lon))*111),0),4)+0.0 as density_100km2 from b_points group by 1,2")
query("D31_histogram", lambda s, d: p.histogram(b.points(s, d), "lat", -70.0, 70.0), "select cast(case when lat < -70 then 0 when lat >= 70 then 41 else floor((lat+70)/140*40)+1 end as bigint) as bin, count(*) as n from b_points group by 1")
query("D32_region_proportion", lambda s, d: rounded(p.region_crop_proportion(b.points(s, d).withColumn("label", F.col("class_probability")), b.regions(s, d).select(F.col("region").alias("country"), (F.col("region_id") + 1).cast("double").alias("area_mha")), "country"), 4), "select country, round(avg(class_probability),4) as proportion, count(*) as n, round(avg(class_probability)*max(region_id+1)*1000000,4) as crop_ha from b_points join b_regions on region=country group by 1")
CL = f"cl as (select *, {CLASS} as class from b_pixels)"
query("D6_class_area", lambda s, d: rounded(r.class_area(classes(s, d), PX)), f"with {CL} select map, class, count(*) as px, round(count(*)*0.09,6) as ha, round(count(*)/sum(count(*)) over (partition by map),6) as fraction from cl where class is not null group by 1,2")
CHANGE = f"{CL}, ch as (select a.row, a.col, a.class*2+z.class as class from cl a join cl z on a.row=z.row and a.col=z.col and a.map='A' and z.map='R')"


def change(s: SparkSession, d: str) -> DataFrame:
    c = classes(s, d)
    return r.change_map(c.filter("map = 'A'"), c.filter("map = 'R'"))


query("C13_change_map", lambda s, d: change(s, d).filter("class is not null"), f"with {CHANGE} select row, col, class from ch where class is not null")
query("D7_change_area", lambda s, d: rounded(r.class_area(change(s, d), PX, by=())), f"with {CHANGE} select class, count(*) as px, round(count(*)*0.09,6) as ha, round(count(*)/sum(count(*)) over (),6) as fraction from ch where class is not null group by 1")
query("D33_crop_percent", lambda s, d: rounded(r.crop_percent(classes(s, d), 70 - (F.col("row") + 0.5) * 0.7)), f"with {CL} select map, round(100*sum(case when class is not null then cos(radians(70-(row+0.5::double)*0.7::double))*class end)/sum(case when class is not null then cos(radians(70-(row+0.5::double)*0.7::double)) end),6) as percent from cl group by 1")
query("D34_tile_sums", lambda s, d: r.tile_sums(classes(s, d), 20, 10).withColumn("tile", F.coalesce("tile", F.lit("all"))), f"with {CL}, t as (select map, class, concat(cast(row//20 as varchar), '_', cast(col//10 as varchar)) as tile from cl where class is not null) select map, class, coalesce(tile,'all') as tile, count(*) as px from t group by grouping sets ((map, class, tile), (map, class))")
query("D35_ensemble_area", lambda s, d: rounded(r.class_area(r.ensemble_map(classes(s, d), 3), PX, by=())), f"with {CL}, v as (select row, col, cast(sum(coalesce(class,0))>=2 as int) as class from cl group by 1,2) select class, count(*) as px, round(count(*)*0.09,6) as ha, round(count(*)/sum(count(*)) over (),6) as fraction from v group by 1")


def voted(s: SparkSession, d: str) -> DataFrame:
    f = flags(s, d).select("id", "map", F.col("crop").cast("double").alias("value"))
    wide = r.attach_map_values(b.table(s, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") % 2).alias("ref_class"), F.col("p_brand").alias("country")), f, MAPS)
    return wide.withColumn("ensemble", r.ensemble_vote(wide, MAPS))


query("D36_ensemble_vote", lambda s, d: voted(s, d).select("id", "ensemble"), f"with {FLAG} select id, cast(2*sum(crop)>count(*) as int) as ensemble from fl group by 1")


def intercompared(s: SparkSession, d: str) -> DataFrame:
    """Reports of every map and the ensemble in every country, in one plan; each point stands for 100 pixels."""
    points = b.table(s, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") % 2).alias("ref_class"), F.col("p_brand").alias("country"))
    groups = ["dataset", "country", "map_class"]
    px = ar.compared_maps(points, b.map_values(s, d), catalog(s), MAPS, MAPS).groupBy(*groups).agg((F.count("*") * 100).alias("px"))
    return ar.intercompare(points, b.map_values(s, d), catalog(s), MAPS, MAPS, px)


def reports(s: SparkSession, d: str) -> DataFrame:
    return intercompared(s, d).select("dataset", "country", "crop_f1", "std_crop_f1", "accuracy", "tp", "fp", "fn", "tn")


LONG = f"{FLAG}, lg as (select p_brand as country, map as dataset, p_size % 2 as ref_class, crop as map_class from part join fl on id=p_partkey union all select p_brand, 'ensemble', p_size % 2, ens from part join (select id, cast(2*sum(crop)>count(*) as int) as ens from fl group by 1) on id=p_partkey)"
KC = f"""with {LONG}, k as (select dataset, country, count_if(ref_class=1 and map_class=1) as tp, count_if(ref_class=0 and map_class=1) as fp, count_if(ref_class=1 and map_class=0) as fn, count_if(ref_class=0 and map_class=0) as tn from lg group by 1,2), z as (select *, coalesce(tp/nullif(tp+fp,0),0) as u1, coalesce(tp/nullif(tp+fn,0),0) as p1, cast(tp+fp as double) as n1, cast(tn+fn as double) as n0, coalesce(fn/nullif(tn+fn,0),0) as s0 from k),
 v as (select *, u1*(1-u1)/nullif(n1-1,0) as var_u1, case when n1<>1 and n0<>1 then coalesce(1/nullif(pow(floor(coalesce(100*n1*tp/nullif(n1,0),0)+coalesce(100*n0*fn/nullif(n0,0),0)),2),0),0)*(10000*n1*n1*(1-p1)*(1-p1)*u1*(1-u1)/(n1-1)+p1*p1*10000*n0*n0*s0*(1-s0)/(n0-1)) end as var_p1 from z),
 rp as (select dataset, country, round(coalesce(2*u1*p1/nullif(u1+p1,0),0),2) as crop_f1, round(2*(p1*sqrt(var_u1)+u1*sqrt(var_p1))/nullif(p1+u1,0) + 2*p1*u1*(sqrt(var_u1)+sqrt(var_p1))/nullif((p1+u1)*(p1+u1),0),2)+0.0 as std_crop_f1, round((tp+tn)/(tp+fp+fn+tn),2) as accuracy, cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(fn as bigint) as fn, cast(tn as bigint) as tn from v)"""
query("E21_intercompare", reports, f"{KC} select * from rp")
query("F4_rank_maps", lambda s, d: r.rank_maps(reports(s, d).select("dataset", "country", "accuracy"), "accuracy"), f"{KC} select dataset, country, accuracy, dense_rank() over (partition by country order by accuracy desc) as rank, dense_rank() over (partition by country order by accuracy desc)=1 as best, dense_rank() over (partition by country order by accuracy desc)=2 as second from rp")
query("F5_best_map", lambda s, d: r.best_map(reports(s, d), "crop_f1"), f"{KC} select country, dataset as best from (select *, row_number() over (partition by country order by crop_f1 desc, dataset desc) as o from rp) where o=1")
query("D37_summarise_results", lambda s, d: rounded(r.summarise_results(reports(s, d), "crop_f1", "accuracy"), 4).fillna("all", ["country", "dataset"]), f"{KC} select coalesce(country,'all') as country, coalesce(dataset,'all') as dataset, round(avg(crop_f1),4) as mean, round(avg(accuracy),4) as error, count(*) as n from rp group by grouping sets ((country),(dataset),())")


def attrs(s: SparkSession) -> DataFrame:
    return s.createDataFrame([("m_size", 10, 2019), ("m_key", 30, 2020), ("m_price", 100, 2015), ("ensemble", 10, 2020)], "dataset string, resolution_m int, year int")


ATTR = "atr as (select * from (values ('m_size',10,2019),('m_key',30,2020),('m_price',100,2015),('ensemble',10,2020)) t(dataset, resolution_m, year))"
query("C15_map_attrs", lambda s, d: ar.with_map_attrs(reports(s, d).select("dataset", "country"), attrs(s), 2018), f"{KC}, {ATTR} select dataset, country, resolution_m, year, abs(year-2018) as mismatch from rp join atr using (dataset)")
query("D38_correlation", lambda s, d: rounded(r.metric_correlation(reports(s, d).join(F.broadcast(attrs(s)), "dataset"), "resolution_m", "accuracy")), f"{KC}, {ATTR} select round(corr(resolution_m, accuracy),6) as r, round(regr_r2(accuracy, resolution_m),6) as r2 from rp join atr using (dataset)")
query("F15_mosaic", lambda s, d: r.mosaic(b.pixels(s, d), {"A": 1, "N": 2, "R": 3}), "select row, col, value from (select *, row_number() over (partition by row, col order by map desc) as o from b_pixels where value<>255) where o=1")
query("H4_mode_composite", lambda s, d: r.mode_composite(b.pixels(s, d)), "with k as (select row, col, value, count(*) as n from b_pixels group by 1,2,3) select row, col, value from (select *, row_number() over (partition by row, col order by n desc, value) as o from k) where o=1")
query("H3_median_composite", lambda s, d: rounded(r.median_composite(b.pixels(s, d).withColumn("cloud_percent", F.col("row") % 100), ["row", "col"], F.col("value") != 255, 80)), "select row, col, round(median(value),6)+0.0 as value from b_pixels where value<>255 and row % 100 <= 80 group by 1,2")
query("H5_paint", lambda s, d: r.paint(one_map(s, d), one_map(s, d).filter("(row + col) % 7 = 0")), "select row, col, map, case when (row+col) % 7 = 0 then 0 else value end as value from b_pixels where map='A'")
CENTER = "-180+(col+0.5::double)*3.6::double as lon, 70+(row+0.5::double)*(-0.7::double) as lat"


def shifted(s: SparkSession, d: str) -> DataFrame:
    """Regions whose borders run through pixels."""
    return b.regions(s, d).select("region", geo.box_ring(F.col("x0") + 1.0, F.col("y0") + 0.3, F.col("x1") + 2.0, F.col("y1") - 0.2).alias("ring"))


query("H1_clip_spans", lambda s, d: sp.clip_to_spans(one_map(s, d), META, rings(s, d).select("region", "ring")).select("row", "col", "region"), f"select row, col, region from (select *, {CENTER} from b_pixels where map='A') join b_regions on {INSIDE}")
query("H1_clip_touched", lambda s, d: sp.clip_to_spans(one_map(s, d), META, shifted(s, d), touched=True).select("row", "col", "region"), "select row, col, region from (select * from b_pixels where map='A') join b_regions on col*3.6::double-180 < x1+2 and (col+1)*3.6::double-180 > x0+1 and 70-row*0.7::double > y0+0.3::double and 70-(row+1)*0.7::double < y1-0.2::double")
query("H1_clip_pixels", lambda s, d: r.clip_pixels(one_map(s, d), META, rings(s, d)).select("row", "col", "region"), f"select row, col, region from (select *, {CENTER} from b_pixels where map='A') join b_regions on {INSIDE}")
FINE = {"a": 1.8, "b": 0.0, "c": -180.0, "d": 0.0, "e": -0.35, "f": 70.0}
query("H2_resample", lambda s, d: r.resample(one_map(s, d), META, FINE, 400, 200).filter("value is not null"), "select cast(2*row+i as int) as row, cast(2*col+j as int) as col, value from b_pixels, (values (0),(1)) x(i), (values (0),(1)) y(j) where map='A'")
query("H7_compare_points", lambda s, d: r.sample_raster(b.points(s, d), one_map(s, d), META).select("id", F.col("class_probability").alias("actual"), F.coalesce((F.col("value") > 0.5).cast("int"), F.lit(-1)).alias("prediction")), f"with {SAMPLED} select id, class_probability as actual, case when value=-1 then -1 else cast(value>0.5 as int) end as prediction from sp")
query("H7_compare_all", lambda s, d: rounded(r.compare_points(b.points(s, d), one_map(s, d), META, keep=["country", "dataset"])), f"with {SAMPLED} select id, sp.class_probability as actual, case when value<>-1 then cast(value>0.5 as int) end as prediction, round(case when value<>-1 then value end, 6) as probability, p.country, p.dataset from sp join b_points p using (id)")
query("H6_ndvi_demote", lambda s, d: r.ndvi_demote(b.scores(s, d).select("id", (F.col("score") > 0.5).cast("int").alias("prediction"), F.col("y_true").alias("label"), (F.col("id") % 1000 / 1000.0).alias("ndvi")), 0.5).select("id", "demoted"), "with k as (select id, cast(score>0.5 as int) as prediction, cast(id % 1000 as double)/1000 as ndvi from b_scores), c as (select avg(ndvi)-0.5*stddev_pop(ndvi) as cut from k where prediction=1) select id, case when prediction=1 and ndvi<cut then 0 else prediction end as demoted from k, c")


def sets(s: SparkSession, d: str) -> list[DataFrame]:
    return [b.annotations(s, d).filter(F.col("set_id") == k) for k in (1, 2)]


def agreed(s: SparkSession, d: str) -> DataFrame:
    """Plots on which both sets agree, with the class of the map and the region there."""
    return p.join_regions(ar.reference_agreement(*sets(s, d), one_map(s, d), META), rings(s, d)).select("plotid", "region", "ref_class", "map_class")


AGREED = f"f as (select * from (select *, case answer when 'Crop' then 1 when 'Non-crop' then 0 end as k, row_number() over (partition by set_id, plotid order by file_ord) as o from b_annotations) where o=1), ag0 as (select a.plotid, a.lon, a.lat, a.k as ref_class from f a join f z on a.plotid=z.plotid and a.set_id=1 and z.set_id=2 and a.k=z.k), ag as (select plotid, region, ref_class, {CLASS} as map_class from (select *, {ROW} as row, {COL} as col from ag0) join (select row, col, value from b_pixels where map='A') using (row, col) join b_regions on {INSIDE} where {CLASS} is not null)"
query("E18_reference_agreement", agreed, f"with {AGREED} select * from ag")


def estimated(s: SparkSession, d: str) -> DataFrame:
    return ar.estimate_area(one_map(s, d), META, rings(s, d), *sets(s, d), PX)


RPX = f"rp as (select region, {CLASS} as map_class, count(*) as px from (select *, {CENTER} from b_pixels where map='A') join b_regions on {INSIDE} where {CLASS} is not null group by 1,2)"
AREA = f"with {AGREED}, {RPX}, cm as (select g.region, i.c as ref_class, j.c as map_class, count(ag.plotid) as n from (select distinct region from ag) g cross join (values (0),(1)) i(c) cross join (values (0),(1)) j(c) left join ag on ag.region=g.region and ag.ref_class=i.c and ag.map_class=j.c group by 1,2,3), q as (select cm.*, coalesce(px,0) as px, sum(n) over (partition by region, map_class) as nj, sum(case when ref_class=0 then coalesce(px,0) end) over (partition by region) as t from cm left join rp using (region, map_class)), ar as (select region, ref_class as class, sum(coalesce(px*n/nullif(nj,0),0)) as area_px from q group by 1,2)"
query("E19_estimate_area", lambda s, d: rounded(estimated(s, d).select("region", "class", "area_px"), 4), f"{AREA} select region, class, round(area_px,4)+0.0 as area_px from ar")
EST = "t as (select *, sum(case when ref_class=0 then px end) over (partition by {by}) as t_px from j), w as (select *, px/nullif(t_px,0) as wj, coalesce(px/nullif(t_px,0)*n/nullif(nj,0),0) as pij from t), es as (select {by}, ref_class as class, sum(pij) as a, max(t_px) as t_px, case when count_if(nj=1)=0 then sqrt(greatest(0, sum((coalesce(wj,0)*pij-pij*pij)/nullif(nj-1,0)))) end as se from w group by {by}, ref_class)"
HA = "class, round(a*t_px*cast(0.09 as double),2)+0.0 as area_ha, round(cast(1.96 as double)*se*t_px*cast(0.09 as double),2)+0.0 as ci_ha"
HA_FINE = HA.replace(",2)", ",6)")  # two digits meet ties
query("E20_estimate_areas", lambda s, d: rounded(estimated(s, d).select("region", "class", "area_ha", "ci_ha"), 2), f"{AREA}, j as (select region, ref_class, map_class, n, nj, px from q), {EST.format(by='region')} select region, {HA} from es")


def jobs(s: SparkSession, d: str) -> DataFrame:
    """Every region in three years, each with a map and the two sets of its own."""
    years = s.createDataFrame([(2019, "A", 1, 2), (2020, "R", 1, 2), (2021, "N", 2, 1)], "year int, map string, set1 int, set2 int")
    return b.regions(s, d).select(F.col("region").alias("roi")).crossJoin(F.broadcast(years)).select("roi", "year", "map", "set1", "set2")  # three rows


def by_year(s: SparkSession, d: str) -> DataFrame:
    return ar.estimate_areas(jobs(s, d), b.pixels(s, d), META, rings(s, d).withColumnRenamed("region", "roi"), b.annotations(s, d), PX)


YEARS = f"f as (select * from (select *, case answer when 'Crop' then 1 when 'Non-crop' then 0 end as k, row_number() over (partition by set_id, plotid order by file_ord) as o from b_annotations) where o=1), jb as (select region as roi, year, map, s1, s2 from b_regions, (values (2019,'A',1,2),(2020,'R',1,2),(2021,'N',2,1)) y(year,map,s1,s2)), ag0 as (select a.plotid, a.lon, a.lat, a.set_id as s1, z.set_id as s2, a.k as ref_class from f a join f z on a.plotid=z.plotid and a.set_id<>z.set_id and a.k=z.k), ag as (select plotid, roi, year, ref_class, map_class from (select plotid, s1, s2, map, region as roi, ref_class, {CLASS} as map_class from (select *, {ROW} as row, {COL} as col from ag0) join b_pixels using (row, col) join b_regions on {INSIDE} where {CLASS} is not null) join jb using (roi, map, s1, s2)), rp as (select roi, year, map_class, count(*) as px from (select region as roi, map, {CLASS} as map_class from (select *, {CENTER} from b_pixels) join b_regions on {INSIDE} where {CLASS} is not null) join jb using (roi, map) group by 1,2,3), cm as (select g.roi, g.year, i.c as ref_class, j.c as map_class, count(ag.plotid) as n from (select distinct roi, year from ag) g cross join (values (0),(1)) i(c) cross join (values (0),(1)) j(c) left join ag on ag.roi=g.roi and ag.year=g.year and ag.ref_class=i.c and ag.map_class=j.c group by 1,2,3,4), j as (select cm.*, coalesce(px,0) as px, sum(n) over (partition by roi, year, map_class) as nj from cm left join rp using (roi, year, map_class))"
EST_YEARS = f"with {YEARS}, {EST.format(by='roi, year')}"
query("E20_estimate_areas_by_year", lambda s, d: rounded(by_year(s, d).select("roi", "year", "class", "area_ha", "ci_ha")), f"{EST_YEARS} select roi, year, {HA_FINE} from es")
ROIS = [f"NATION_{k}" for k in range(25)]
WIDE = ", ".join(f"max(case when roi='{r}' and class={k} then {c} end) as \"{r} {n}\"" for r in ROIS for k, c, n in ((1, "area_ha", "crop area"), (1, "ci_ha", "95% CI crop"), (0, "area_ha", "Non-crop area"), (0, "ci_ha", "95% CI noncrop")))
query("A8_area_results_by_year", lambda s, d: rounded(ar.area_results(by_year(s, d), ROIS, digits=6)), f"{EST_YEARS}, h as (select roi, year, {HA_FINE} from es) select year as \"Year\", {WIDE} from h group by 1")
query("A14_cm_summary", lambda s, d: rounded(ar.cm_summary(cf.confusion(agreed(s, d), by=["region"]), ["region"])), f"{AREA}, k as (select region, sum(case when ref_class=0 and map_class=0 then n end) as tn, sum(case when ref_class=1 and map_class=1 then n end) as tp, sum(case when ref_class=0 and map_class=1 then n end) as fp, sum(case when ref_class=1 and map_class=0 then n end) as fn from cm group by 1) select region, 'False Positive Rate' as metric, round(coalesce(fn/nullif(fn+tp,0),0),6)+0.0 as \"Non-Crop\", round(coalesce(fp/nullif(fp+tn,0),0),6)+0.0 as \"Crop\" from k union all select region, 'True Positive Rate', round(coalesce(tn/nullif(tn+fp,0),0),6)+0.0, round(coalesce(tp/nullif(tp+fn,0),0),6)+0.0 from k union all select region, 'Accuracy', round((tp+tn)/(tp+tn+fp+fn),6)+0.0, round((tp+tn)/(tp+tn+fp+fn),6)+0.0 from k")
YEARLY = ((2019, "A", 1, 2), (2020, "R", 1, 2), (2021, "N", 2, 1))
query("A9_area_jobs", lambda s, d: rounded(ar.estimate_areas(ar.area_jobs(s, [dict(zip(("roi", "year", "map", "set1", "set2"), (r, *y))) for r in ROIS for y in YEARLY]), b.pixels(s, d), META, rings(s, d).withColumnRenamed("region", "roi"), b.annotations(s, d), PX).select("roi", "year", "class", "area_ha")), f"{EST_YEARS}, h as (select roi, year, {HA_FINE} from es) select roi, year, class, area_ha from h")
query("A8_area_results", lambda s, d: rounded(ar.area_results(estimated(s, d).withColumnRenamed("region", "roi").withColumn("year", F.lit(2019)), ROIS, digits=6)), f"{AREA}, j as (select region, ref_class, map_class, n, nj, px from q), {EST.format(by='region')}, h as (select cast(2019 as int) as year, region as roi, {HA_FINE} from es) select year as \"Year\", {WIDE} from h group by 1")
SUMMARY = "sm as (select roi, year, ref_class as class, max(case when map_class=ref_class then n/nullif(nj,0) end) as u, sum(case when map_class=ref_class then pij end)/nullif(sum(pij),0) as p from w group by 1,2,3), ml as (select roi, year, class, 'Estimated area [ha]' as metric, area_ha as v from h union all select roi, year, class, '95% CI of area [ha]', ci_ha from h union all select roi, year, class, 'User''s accuracy', round(coalesce(u,0),6) from sm union all select roi, year, class, 'Producer''s accuracy', round(coalesce(p,0),6) from sm)"
query("A14_area_summary", lambda s, d: rounded(ar.area_summary(by_year(s, d), ["roi", "year"]).filter(~F.col("metric").isin(ar.MEASURES["ci_u"], ar.MEASURES["ci_p"]))), f"{EST_YEARS}, h as (select roi, year, {HA_FINE} from es), {SUMMARY} select roi, year, metric, max(case when class=0 then v end)+0.0 as \"Non-Crop\", max(case when class=1 then v end)+0.0 as \"Crop\" from ml group by 1,2,3")
query("G2_haversine", lambda s, d: rounded(b.points(s, d).select("id", geo.haversine_km(F.col("lat"), F.col("lon"), F.lit(10.0), F.lit(20.0)).alias("km")), 4), f"with k as (select id, {H.format('p', 'q')} as h from b_points p, (select 10.0::double as lat, 20.0::double as lon) q) select id, round({HAV},4)+0.0 as km from k")
query("G3_rowcol", lambda s, d: b.points(s, d).select("id", *[c.alias(n) for c, n in zip(geo.rowcol(F.col("lon"), F.col("lat"), META), ("row", "col"))]), f"select id, {ROW} as row, {COL} as col from b_points")
query("G4_utm_round_trip", lambda s, d: b.points(s, d).filter("lon between 30 and 36").select("id", *[F.round(c, 6).alias(n) for c, n in zip(geo.utm_to_wgs84(*geo.wgs84_to_utm(F.col("lat"), F.col("lon"), 32636), 32636), ("lat", "lon"))]), "select id, round(lat,6) as lat, round(lon,6) as lon from b_points where lon between 30 and 36")
query("G5_ring_measures", lambda s, d: rings(s, d).select("region", geo.ring_area(F.col("ring")).alias("area"), geo.centroid(F.col("ring"))["x"].alias("cx"), geo.centroid(F.col("ring"))["y"].alias("cy"), geo.ring_bounds(F.col("ring"))["max_y"].alias("top")).transform(rounded), "select region, (x1-x0)*(y1-y0) as area, round((x0+x1)/2,6)+0.0 as cx, round((y0+y1)/2,6)+0.0 as cy, y1 as top from b_regions")
query("G6_unit_xyz", lambda s, d: rounded(b.points(s, d).select("id", geo.unit_xyz(F.col("lat"), F.col("lon")).alias("u")).select("id", "u.*")), "select id, round(cos(radians(lat))*cos(radians(lon)),6)+0.0 as x, round(cos(radians(lat))*sin(radians(lon)),6)+0.0 as y, round(sin(radians(lat)),6)+0.0 as z from b_points")
query("G19_deg_to_km", lambda s, d: rounded(b.points(s, d).select("id", geo.deg_to_km(F.col("lat")).alias("km"))), "select id, round(lat*111,6)+0.0 as km from b_points")
query("G20_tile_grid", lambda s, d: rounded(geo.tile_grid(b.regions(s, d), 3, 4).select("region", "tile_row", "tile_col", "tx0", "ty0", "tx1", "ty1")), "select region, cast(i as int) as tile_row, cast(j as int) as tile_col, round(x0+j*18.0::double,6)+0.0 as tx0, round(y0+i*(28.0::double/3),6)+0.0 as ty0, round(x0+(j+1)*18.0::double,6)+0.0 as tx1, round(y0+(i+1)*(28.0::double/3),6)+0.0 as ty1 from b_regions, (select unnest(range(0,3)) as i), (select unnest(range(0,4)) as j)")
query("G20_point_box", lambda s, d: rounded(b.points(s, d).select("id", geo.point_box(F.col("lat"), F.col("lon"), 0.5).alias("b")).select("id", "b.*")), "select id, round(lat-0.25,6)+0.0 as min_lat, round(lat+0.25,6)+0.0 as max_lat, round(lon-0.25,6)+0.0 as min_lon, round(lon+0.25,6)+0.0 as max_lon from b_points")
query("G21_find_regions", lambda s, d: geo.find_regions(b.regions(s, d).withColumn("code", F.concat(F.lit("C"), F.col("country_id"))), "C1", ["NATION_6", "NATION_11", "NATION_3"]).select("region", "code"), "select region, concat('C', country_id) as code from b_regions where country_id=1 and region in ('NATION_6','NATION_11','NATION_3')")
query("G21_missing_regions", lambda s, d: geo.missing_regions(b.regions(s, d).filter("country_id = 1"), b.regions(s, d).select("region")), "select region from b_regions where country_id<>1")
query("G22_dissolve", lambda s, d: geo.dissolve(rings(s, d), "country_id").select("country_id", F.size("parts").alias("n_parts")), "select country_id, cast(count(*) as int) as n_parts from b_regions group by 1")
query("I2_reference_sample", lambda s, d: p.reference_sample(classes(s, d).filter("map = 'A' and class is not null").select("row", "col", F.col("class").alias("value")), {0: 50, 1: 50}, META).groupBy("value").agg(F.count("*").alias("n"), F.max("sample_id").alias("last")), f"with {CL}, k as (select class as value, row_number() over (partition by class) as o from cl where map='A' and class is not null) select value, count(*) as n, max(o) as last from k where o<=50 group by 1")
query("I3_points_in_polygons", lambda s, d: tr.points_in_polygons(rings(s, d), 10).join(rings(s, d), "region_id").select("region_id", "draw", ((F.col("x") >= F.col("x0")) & (F.col("x") <= F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") <= F.col("y1"))).alias("inside")), "select region_id, cast(unnest(range(1, 11)) as int) as draw, true as inside from b_regions")
query("I3_triangulate", lambda s, d: rounded(tr.triangulate(rings(s, d)).groupBy("region_id").agg(F.count("*").alias("n"), F.sum("area").alias("area"))), "select region_id, cast(2 as bigint) as n, round((x1-x0)*(y1-y0),6) as area from b_regions")
LOCAL = "u as (select *, cast(class_probability>0.5 as int) as is_crop, coalesce(lat between -20 and 40 and lon between -60 and 120, false) as is_local from b_points), n as (select count_if(is_crop=1) as pos, count_if(is_crop=0) as neg from u where is_local)"
query("I4_upsample_local", lambda s, d: p.upsample_local(l.with_is_local(b.points(s, d).withColumn("is_crop", (F.col("class_probability") > 0.5).cast("int")), (-20.0, 40.0, -60.0, 120.0))), f"with {LOCAL}, m as (select u.*, is_local and is_crop=case when pos<neg then 1 else 0 end as rare, row_number() over (partition by is_local, is_crop order by (id*48271) % 2147483647, id) as o, greatest(pos,neg) as big, least(pos,neg) as small from u, n) select * exclude (rare, o, big, small, k), cast(k as int) as copy from (select *, unnest(range(1, cast(case when rare then big//small + cast(o <= big % small as int) else 1 end + 1 as bigint))) as k from m)")
query("I5_region_holdout", lambda s, d: p.region_holdout(b.points(s, d).select("id", "lat", "lon"), rings(s, d).filter("region = 'NATION_3'")).select("id", "part"), f"select id, case when exists (select 1 from b_regions where region='NATION_3' and {INSIDE}) then 'test' else 'train' end as part from b_points")
query("I6_sample_n", lambda s, d: p.sample_n(b.points(s, d), 100, "id").select("id"), "select id from b_points order by (id*48271) % 2147483647, id limit 100")


def grid_by_sql(s: SparkSession, d: str) -> DataFrame:
    """The tile grid through the table function."""
    from landstat.functions import tables

    tables.register(s)
    b.regions(s, d).createOrReplaceTempView("landstat_regions")
    return rounded(s.sql("select region, t.* from landstat_regions, lateral tile_grid(x0, y0, x1, y1, 3, 4) t"))


query("L5_tile_grid_udtf", grid_by_sql, "select region, cast(i as int) as tile_row, cast(j as int) as tile_col, round(x0+j*18.0::double,6)+0.0 as tx0, round(y0+i*(28.0::double/3),6)+0.0 as ty0, round(x0+(j+1)*18.0::double,6)+0.0 as tx1, round(y0+(i+1)*(28.0::double/3),6)+0.0 as ty1 from b_regions, (select unnest(range(0,3)) as i), (select unnest(range(0,4)) as j)")
