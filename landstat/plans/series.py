"""Queries on series, models, streams and files (A1-A5, A12, C14, D26-D28, F8, G7-G18, J, K, L, H8) with their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landstat.operators import labels as l
from landstat.operators import groupfits as gf
from landstat.operators import ml
from landstat.operators import sketches as sk
from landstat.operators import timeseries as ts
from landstat.functions.shared import shared_dir
from landstat.plans import bindings as b
from landstat.plans.registry import query, rounded
from landstat.streaming import sinks
from landstat.sources import files
from landstat.streaming import labels as st


def folder(s: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(s)}/{uuid.uuid4().hex}"


def values(df: DataFrame, eo: str = "eo") -> DataFrame:
    """A series column in long form, for comparison: id, t, band, value."""
    return df.select("id", F.posexplode(eo).alias("t", "_v")).select("id", "t", F.posexplode("_v").alias("band", "value"))


POINT_SCHEMA = "id long, lat double, lon double, country string, class_probability double, subset string, num_labelers int"


def round_trip_csv(s: SparkSession, d: str) -> DataFrame:
    at = folder(s)
    b.points(s, d).drop("dataset").write.csv(at, header=True)
    return files.read_labels(s, at, POINT_SCHEMA)


def round_trip_geojson(s: SparkSession, d: str) -> DataFrame:
    """Regions written as GeoJSON text and read again."""
    at = folder(s)
    pair = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(pair("x0", "y0"), pair("x1", "y0"), pair("x1", "y1"), pair("x0", "y1"), pair("x0", "y0"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("region").alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    collection = F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))  # a file's features, by country
    b.regions(s, d).groupBy("country_id").agg(F.to_json(collection).alias("value")).repartition(5, "country_id").write.partitionBy("country_id").text(at)
    read = files.read_geojson(s, f"{at}/*/*.txt", T.StructType([T.StructField("region", T.StringType())]))
    return read.select("region", F.size(files.rings(F.col("coordinates"))).alias("n_vertices"))


def round_trip_parquet(s: SparkSession, d: str) -> DataFrame:
    at = folder(s)
    files.write_labels(b.points(s, d), at)
    return s.read.parquet(at).groupBy("dataset").agg(F.count("*").alias("n"))


def round_trip_folder(s: SparkSession, d: str) -> DataFrame:
    at = folder(s)
    b.points(s, d).drop("dataset").coalesce(2).write.csv(at, header=True)
    return files.read_all_labels(s, at, POINT_SCHEMA).groupBy("subset").agg(F.count("*").alias("n"))


query("A1_read_labels", round_trip_csv, "select id, lat, lon, country, class_probability, subset, num_labelers from b_points")
query("A2_read_geojson", round_trip_geojson, "select region, cast(4 as int) as n_vertices from b_regions")
query("A4_read_all_labels", round_trip_folder, "select subset, count(*) as n from b_points group by 1")
query("A5_write_labels", round_trip_parquet, "select dataset, count(*) as n from b_points group by 1")
query("A12_parse_eo", lambda s, d: rounded(values(b.eo(s, d).withColumn("eo", ts.parse_eo(ts.format_eo(F.col("eo")))))), "select id, t, band, round(value,6)+0.0 as value from b_eo_long")
query("C14_sample_features", lambda s, d: rounded(ts.sample_features(b.eo(s, d).select("id", "is_crop"), b.eo_long(s, d).filter("t = 0 and not (id % 10 = 3 and band = 2)"), range(3))), "select id, is_crop, round(max(case when band=0 then value end),6)+0.0 as b0, round(max(case when band=1 then value end),6)+0.0 as b1, round(max(case when band=2 then value end),6)+0.0 as b2 from b_eo_long where t=0 and id % 10 <> 3 group by 1,2")
query("D26_band_stats", lambda s, d: rounded(ts.band_stats(b.eo_long(s, d))), "select band, round(avg(value),6)+0.0 as mean, round(stddev_samp(value),6) as std, count(value) as n from b_eo_long group by 1")
query("D27_instance_stats", lambda s, d: rounded(b.eo(s, d).select("id", F.posexplode(F.zip_with(ts.band_means(F.col("eo")), ts.band_stds(F.col("eo")), lambda m, v: F.struct(m.alias("mean"), v.alias("std")))).alias("band", "x")).select("id", "band", "x.mean", "x.std"), 5), "select id, band, round(avg(value),5)+0.0 as mean, round(stddev_pop(value),5)+0.0 as std from b_eo_long group by 1,2")
query("D28_profile", lambda s, d: rounded(ts.profile(b.eo_long(s, d), ["is_crop"])), "select is_crop, t, band, round(avg(value),6)+0.0 as mean, round(stddev_pop(value),6) as std from b_eo_long group by 1,2,3")
query("F8_first_last_months", lambda s, d: rounded(values(b.eo(s, d).withColumn("eo", F.concat(ts.first_months(F.col("eo"), 2), ts.last_months(F.col("eo"), 3))))), "select id, cast(case when t<2 then t else t-3 end as int) as t, band, round(value,6)+0.0 as value from b_eo_long where t<2 or t>=5")
query("G7_month_encoding", lambda s, d: rounded(b.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), ts.month_sin_cos(F.month("o_orderdate") - 1).alias("m"), F.array_join(ts.month_seq(F.month("o_orderdate") - 1, 12), ",").alias("months")).select("id", "m.sin", "m.cos", "months")), "select o_orderkey as id, round(sin((month(o_orderdate)-1)*(2*pi()/12)),6)+0.0 as sin, round(cos((month(o_orderdate)-1)*(2*pi()/12)),6)+0.0 as cos, array_to_string(list_transform(range(0,12), lambda i: (month(o_orderdate)-1+i) % 12), ',') as months from orders")
W = "p as (select id, t, max(case when band=0 then value end) as b0, max(case when band=1 then value end) as b1, max(case when band=2 then value end) as b2, max(case when band=3 then value end) as b3, max(case when band=4 then value end) as b4 from b_eo_long group by 1,2)"
query("G8_with_ndvi", lambda s, d: rounded(values(b.eo(s, d).withColumn("eo", ts.with_ndvi(F.col("eo"), 3, 2))).filter("band = 8").drop("band"), 4), f"with {W} select id, t, round(coalesce((b3-b2)/nullif(b3+b2,0),0),4)+0.0 as value from p")
query("G9_vegetation_indices", lambda s, d: rounded(b.eo(s, d).select("id", F.posexplode(ts.vegetation_indices(F.col("eo"), 0, 1, 2, 3, 4)).alias("t", "v")).select("id", "t", "v.gndvi", "v.cvi", "v.evi"), 3), f"with {W} select id, t, round((b3-b1)/nullif(b3+b1,0),3)+0.0 as gndvi, round(b3-(b1-1),3)+0.0 as cvi, round(2.5*(b3-b2)/nullif(b3+6*b2-7.5*b0+1,0),3)+0.0 as evi from p")
query("G10_scale_bands", lambda s, d: rounded(values(b.eo(s, d).withColumn("eo", ts.scale_bands(F.col("eo"), range(8), [2.0] * 8, [0, 3])))), "select id, t, cast(case band when 3 then 1 else 0 end as int) as band, round((value+band)/2,6)+0.0 as value from b_eo_long where band in (0,3)")
query("G11_normalize", lambda s, d: rounded(values(ts.normalize(b.eo(s, d), ts.band_stats(b.eo_long(s, d)))), 4), "with st as (select band, avg(value) as m, stddev_samp(value) as v from b_eo_long group by 1) select id, t, band, round(coalesce((value-m)/nullif(v,0),0),4)+0.0 as value from b_eo_long join st using (band)")
query("G12_pad_months", lambda s, d: b.eo(s, d).select("id", F.size(ts.pad_months(F.col("eo"), 12, 8)).alias("months"), F.size(F.filter(ts.pad_months(F.col("eo"), 12, 8), lambda t: t[0].isNull())).alias("missing")), "select distinct id, cast(12 as int) as months, cast(4 as int) as missing from b_eo_long")
query("G13_select_bands", lambda s, d: rounded(values(b.eo(s, d).withColumn("eo", ts.select_bands(F.col("eo"), [5, 1])))), "select id, t, cast(case band when 1 then 1 else 0 end as int) as band, round(value,6)+0.0 as value from b_eo_long where band in (1,5)")
query("G14_num_timesteps", lambda s, d: b.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), ts.num_timesteps(F.to_date("o_orderdate"), F.date_add(F.to_date("o_orderdate"), 400), 2, 12).alias("timesteps")), "select o_orderkey as id, cast(round_even((least(cast(o_orderdate as date)+400, cast(make_date(year(o_orderdate),2,1) + interval 12 month as date)) - make_date(year(o_orderdate),2,1))/30.436875::double, 0) as int) as timesteps from orders")
query("G15_flatten_concat", lambda s, d: rounded(b.eo(s, d).select("id", F.posexplode(ts.feature_concat(ts.flatten_eo(F.col("eo")), ts.band_means(F.col("eo")))).alias("pos", "value")), 5), "select id, cast(t*8+band as int) as pos, round(value,5)+0.0 as value from b_eo_long union all select id, cast(64+band as int), round(avg(value),5)+0.0 from b_eo_long group by id, band")
query("G17_is_clear", lambda s, d: b.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), ts.is_clear(F.col("o_orderkey")).alias("clear")), "select o_orderkey as id, (o_orderkey & 3072) = 0 as clear from orders")
query("G18_min_max", lambda s, d: rounded(b.scores(s, d).withColumn("score", F.when(F.col("id") % 9 != 0, F.col("score"))).select("id", ts.min_max("score", ["grp"]).alias("scaled"))), "with k as (select id, grp, case when id % 9 <> 0 then score end as score from b_scores) select id, round((coalesce(score, min(score) over (partition by grp)) - min(score) over (partition by grp))/(max(score) over (partition by grp)-min(score) over (partition by grp)),6)+0.0 as scaled from k")
query("J12_assemble", lambda s, d: rounded(ts.assemble(b.eo(s, d), b.eo_long(s, d), 12, 8).select("id", "timesteps", F.size("eo").alias("months"), "weight", F.get(F.get("eo", F.lit(0)), F.lit(0)).alias("first")), 4), "with st as (select avg(value) as m, stddev_samp(value) as v from b_eo_long where band=0), k as (select vec_id as id, cast(label % 2 as int) as c from embeddings), sh as (select avg(c) as a from k) select id, cast(8 as int) as timesteps, cast(12 as int) as months, round(case when c=1 then 0.5/a else 0.5/(1-a) end,4) as weight, round((value-m)/v,4)+0.0 as first from k join b_eo_long using (id), st, sh where t=0 and band=0")


def featured(s: SparkSession, d: str) -> DataFrame:
    e = b.eo(s, d).withColumn("features", ts.flatten_eo(F.col("eo"))).drop("eo")
    return e.withColumns({"part": F.when(F.col("id") % 5 == 0, "test").otherwise("train"), "dataset": F.concat(F.lit("d"), F.col("id") % 3), "region": F.concat(F.lit("r"), F.col("id") % 2)})


def halves(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    f = featured(s, d)
    return f.filter("part = 'train'"), f.filter("part = 'test'")


def mean_score(batch):
    """A user's model: the mean of the features through a logistic curve."""
    import numpy as np
    import pandas as pd

    return pd.Series([float(1 / (1 + np.exp(-np.mean(x)))) for x in batch])


def region_summary(frames):
    """A user's function of a region: its rows and crops, from one frame after the other."""
    import pandas as pd

    region, n, crop = None, 0, 0
    for f in frames:
        region, n, crop = f["region"].iloc[0], n + len(f), crop + int(f["is_crop"].sum())
    yield pd.DataFrame({"region": [region], "n": [n], "crop": [crop]})


for kind, name in (("forest", "J1_forest"), ("logistic", "J2_logistic"), ("gbt", "J3_gbt"), ("svm", "J4_svm")):
    query(name, lambda s, d, k=kind: ml.predict(ml.FITS[k](halves(s, d)[0]), halves(s, d)[1]).select("id", "is_crop", F.round("score", 4).alias("score")))
query("J5_standardize", lambda s, d: ml.standardize(featured(s, d)).select("id", F.round(F.get("features", F.lit(0)), 4).alias("first")), "with st as (select avg(value) as m, stddev_samp(value) as v from b_eo_long where t=0 and band=0) select id, round((value-m)/v,4)+0.0 as first from b_eo_long, st where t=0 and band=0")
query("J6_feature_benchmark", lambda s, d: ml.feature_benchmark(featured(s, d), {"all": lambda df: df, "first": lambda df: df.withColumn("features", F.slice("features", 1, 16))}))
query("J7_run_baseline", lambda s, d: ml.run_baseline(*halves(s, d), kind="logistic"))
query("J8_plus_one", lambda s, d: ml.plus_one(*halves(s, d), base=["d0"], candidates=["d1", "d2"]))
query("J9_grid", lambda s, d: ml.grid(*halves(s, d), sets={"one": ["d0"], "all": ["d0", "d1", "d2"]}, seeds=[0, 1]))
query("J10_score", lambda s, d: rounded(ml.score(featured(s, d).select("id", "features"), mean_score).select("id", "score"), 5), "select id, round(1/(1+exp(-avg(value))),5) as score from b_eo_long group by 1")
query("L4_per_region", lambda s, d: ml.per_region(featured(s, d).select("region", "is_crop"), region_summary, "region string, n long, crop long", "region"), "select concat('r', id % 2) as region, count(*) as n, cast(sum(is_crop) as bigint) as crop from (select distinct id, is_crop from b_eo_long) group by 1")


def leveled(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Both halves with the mean of a place's values as the only feature."""
    one = lambda df: df.withColumn("features", F.array(F.aggregate("features", F.lit(0.0), lambda t, v: t + v) / F.size("features")))
    train, test = halves(s, d)
    return one(train), one(test)


def flat_fits(s: SparkSession, d: str) -> DataFrame:
    """Logistic models of all regions; true where the slopes of the loss are zero at the coefficients."""
    train = leveled(s, d)[0]
    models = gf.logistic(train, "region", ridge=0.0, balanced=False).filter("converged")
    off = F.col("score") - F.col("is_crop")
    slopes = [F.abs(F.avg(off)), F.abs(F.avg(off * F.get("features", F.lit(0))))]
    return gf.score_groups(models, train, "region").groupBy("region").agg(F.count("*").alias("n"), (F.greatest(*slopes) < 1e-6).alias("flat"))


LEVELS = "with e as (select id, max(is_crop) as y, avg(value) as x, concat('r', id % 2) as region, concat('d', id % 3) as dataset, id % 5 = 0 as test from b_eo_long group by id)"
query("H8_region_fits", flat_fits, f"{LEVELS} select region, count(*) as n, true as flat from e where not test group by 1")
query("H8_region_lines", lambda s, d: rounded(gf.score_groups(gf.least_squares(gf.grams(leveled(s, d)[0], "region"), "region"), leveled(s, d)[1], "region", lambda m: m).select("id", "region", "score"), 5), f"{LEVELS}, f as (select region, regr_slope(y, x) as k, regr_intercept(y, x) as c from e where not test group by 1) select id, region, round(c + k * x, 5) as score from e join f using (region) where test")
query("J8_plus_one_linear", lambda s, d: rounded(ml.plus_one(*leveled(s, d), base=["d0"], candidates=["d1", "d2"], kind="linear", rounds=2, ridge=0.0)), f"""{LEVELS}, m(dataset, added, round) as (values ('d0','d1',1),('d1','d1',1),('d0','d2',1),('d2','d2',1),('d0','',2),('d1','',2),('d2','',2)),
f as (select added, round, regr_slope(y, x) as k, regr_intercept(y, x) as c from e join m using (dataset) where not test group by 1, 2),
p as (select added, round, c + k * x > 0.5 as p, y = 1 as y from e, f where test),
q as (select added, round, count_if(p and y) as tp, count_if(p and not y) as fp, count_if(not p and y) as fn, count_if(not p and not y) as tn from p group by 1, 2),
r as (select added, round, coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0.0) as accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) as "precision", coalesce(tp / nullif(tp + fn, 0), 0.0) as recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) as f1 from q),
b as (select added from r where round = 1 order by f1 desc, added desc limit 1)
select case when round = 2 then (select case when added = 'd1' then 'd2' else 'd1' end from b) else added end as added, cast(round as int) as round, round(accuracy, 6) as accuracy, round("precision", 6) as "precision", round(recall, 6) as recall, round(f1, 6) as f1, 'linear' as model from r""")
query("J9_grid_logistic", lambda s, d: ml.grid(*leveled(s, d), sets={"one": ["d0"], "all": ["d0", "d1", "d2"]}, seeds=[0, 1], kind="logistic"))
query("H8_region_maps", lambda s, d: ml.region_maps(halves(s, d)[0], halves(s, d)[1], ["r0", "r1"]).select("id", "region", F.round("score", 4).alias("score")))

TEXT = "cast({} as varchar) as {}"


def with_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


COUNTS_SQL = "select strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') as start, strftime(date_trunc('day', ts) + interval 1 day, '%Y-%m-%d %H:%M:%S') as \"end\", answer, count(*) as n from b_stream group by 1,2,3"
CONSENSUS_SQL = "select plotid, cast(count_if(answer='Crop') as bigint) as n_crop, cast(count_if(answer<>'Crop') as bigint) as n_other, case when count_if(answer='Crop') > count_if(answer<>'Crop') then 'Crop' when count_if(answer='Crop') < count_if(answer<>'Crop') then 'Non-crop' else 'tie' end as answer from b_stream group by 1"
MOMENTS_SQL = "select answer, count(analysis_secs) as n, round(avg(analysis_secs),3) as mean, round(stddev_samp(analysis_secs),3) as std from b_stream group by 1"
UPSERT_SQL = "with e as (select event_id, email as source, cast(year(ts) as int) as start_year from b_stream where plotid<20), i as (select event_id, email as source, cast(year(ts)+event_id % 2 as int) as start_year from b_stream where plotid>=20) select * from e union all select * from i where not exists (select 1 from e where e.source=i.source and e.start_year=i.start_year)"
query("K1_dedupe", lambda s, d: st.stream_dedupe(b.stream(s, d)).select("event_id", "plotid", "email"), "select event_id, plotid, email from (select *, row_number() over (partition by plotid, email order by ts, event_id) as o from b_stream) where o=1")
query("K2_counts", lambda s, d: with_text(st.stream_counts(b.stream(s, d)), "start", "end"), COUNTS_SQL)
query("K2_sliding_counts", lambda s, d: with_text(st.stream_counts(b.stream(s, d), "1 day", "6 hours"), "start", "end"), "with k as (select answer, time_bucket(interval 6 hour, ts, timestamp '1970-01-01') - i * interval 6 hour as start from b_stream, (select unnest(range(0,4)) as i)) select strftime(start, '%Y-%m-%d %H:%M:%S') as start, strftime(start + interval 1 day, '%Y-%m-%d %H:%M:%S') as \"end\", answer, count(*) as n from k group by 1,2,3")
query("K3_sessions", lambda s, d: rounded(with_text(st.stream_sessions(b.stream(s, d)), "start", "end"), 4), "with k as (select *, case when ts - lag(ts) over (partition by email order by ts) >= interval 30 minute or lag(ts) over (partition by email order by ts) is null then 1 else 0 end as o from b_stream), g as (select *, sum(o) over (partition by email order by ts, event_id rows unbounded preceding) as k from k) select email, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as start, strftime(max(ts) + interval 30 minute, '%Y-%m-%d %H:%M:%S') as \"end\", count(*) as n, round(sum(analysis_secs),4) as secs from g group by email, k")
query("K4_consensus", lambda s, d: st.stream_consensus(b.stream(s, d)), CONSENSUS_SQL)
def arriving(s: SparkSession, d: str) -> DataFrame:
    """The label stream as a stream over the files of the events."""
    return b.as_stream(s.readStream.schema(b.table(s, d, "events").schema).parquet(f"{d}/events.parque[t]"))


def drained(s: SparkSession, stream: DataFrame, write, mode: str = "append") -> str:
    """Runs ``write(folder)`` over all of a stream; the folder."""
    at = f"{shared_dir(s)}/stream-{uuid.uuid4().hex}"
    sinks.drain(stream, write(f"{at}/table"), f"{at}/checkpoint", mode)
    return f"{at}/table"


def latest(s: SparkSession, d: str, stream: DataFrame, keys: list[str]) -> DataFrame:
    """What a stream in update mode last said of each key."""
    said = sinks.read_batches(s, drained(s, stream, sinks.append_once, "update"))
    values = [c for c in stream.columns if c not in keys]
    return said.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*keys, "v.*")


def streamed_upsert(s: SparkSession, d: str) -> DataFrame:
    incoming = arriving(s, d).select("event_id", F.col("email").alias("source"), F.year("ts").alias("start_year"), (F.col("plotid") < 20).alias("early"))
    at = f"{shared_dir(s)}/stream-{uuid.uuid4().hex}"
    for k, part in enumerate((incoming.filter("early"), incoming.filter("not early").withColumn("start_year", (F.col("start_year") + F.col("event_id") % 2).cast("int")))):
        # the batches of the second stream follow those of the first in one table
        sinks.drain(part.drop("early"), lambda batch, i, k=k: sinks.upsert_once(f"{at}/table", ["source", "start_year"])(batch, 1_000 * k + i), f"{at}/checkpoint-{k}")
    return sinks.read_batches(s, f"{at}/table", "rows").drop("batch")


query("K2_counts_stream", lambda s, d: with_text(latest(s, d, st.stream_counts(arriving(s, d)), ["start", "end", "answer"]), "start", "end"), COUNTS_SQL)
query("K4_consensus_stream", lambda s, d: latest(s, d, st.stream_consensus(arriving(s, d)), ["plotid"]), CONSENSUS_SQL)


def stored_sketches(s: SparkSession, d: str) -> DataFrame:
    """Sketches a day and answer, kept as a table and united over all days; true where they are within their bounds of the exact figures."""
    labels, at = b.stream(s, d).withColumn("day", F.to_date("ts")), f"{shared_dir(s)}/sketches-{uuid.uuid4().hex}"
    sk.sketches(labels, ["answer", "day"], "event_id", "analysis_secs").write.parquet(at)
    told = sk.estimates(sk.united(s.read.parquet(at), ["answer"]), [0.5, 0.9])
    rank = lambda op, q: F.avg(op(F.col("analysis_secs"), F.col(q)).cast("double"))
    near = lambda q, share: (rank(lambda x, y: x <= y, q) >= share - 0.02) & (rank(lambda x, y: x < y, q) <= share + 0.02)
    exact = labels.join(F.broadcast(told), "answer").groupBy("answer", "n")  # one row an answer
    different = F.count_distinct("event_id")
    return exact.agg((F.abs(F.first("items") - different) <= 0.04 * different).alias("items_near"), near("q0", 0.5).alias("median_near"), near("q1", 0.9).alias("p90_near"))


query("D44_stored_sketches", stored_sketches, "select answer, count(*) as n, true as items_near, true as median_near, true as p90_near from b_stream group by 1")
query("K5_band_stats_stream", lambda s, d: rounded(st.moments(sinks.read_merged(s, drained(s, arriving(s, d), st.merged_band_stats))), 3), MOMENTS_SQL)
query("K6_upsert_stream", streamed_upsert, UPSERT_SQL)
query("K5_band_stats", lambda s, d: rounded(st.moments(st.stream_band_stats(b.stream(s, d))), 3), MOMENTS_SQL)
query("K6_upsert", lambda s, d: st.upsert(b.stream(s, d).filter("plotid < 20").select("event_id", F.col("email").alias("source"), F.year("ts").alias("start_year")), b.stream(s, d).filter("plotid >= 20").select("event_id", F.col("email").alias("source"), (F.year("ts") + F.col("event_id") % 2).cast("int").alias("start_year"))), UPSERT_SQL)
