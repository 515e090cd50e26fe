"""Domain-shaped inputs derived from the star-schema test tables, as DataFrames and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _coord(c: str, factor: int, span: int, low: int):
    return ((F.col(c) * factor) % span).cast("double") / 100 - low


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    x0, y0 = (-180 + 72 * (k % 5)).cast("double"), (-70 + 28 * F.floor(k / 5)).cast("double")
    return table(spark, sf_dir, "nation").select(k.alias("region_id"), F.col("n_name").alias("region"), F.col("n_regionkey").alias("country_id"), x0.alias("x0"), (x0 + 72).alias("x1"), y0.alias("y0"), (y0 + 28).alias("y1"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    share = (k * 7919) % 1000
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    return table(spark, sf_dir, "customer").join(F.broadcast(nation), "c_nationkey").select(
        k.alias("id"), _coord("c_custkey", 7919, 14000, 70).alias("lat"), _coord("c_custkey", 104729, 36000, 180).alias("lon"), "country",
        F.when(k % 5 == 0, 0.5).when(k % 5 < 3, 1.0).otherwise(0.0).alias("class_probability"),
        F.when(share < 600, "training").when(share < 800, "validation").otherwise("testing").alias("subset"),
        (1 + k % 3).cast("int").alias("num_labelers"), F.col("c_mktsegment").alias("dataset"),
    )


ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of plots; ``file_ord`` is a struct of all columns of the source, a total order but for equal rows."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("plotid"), F.col("l_partkey").alias("sampleid"), (1 + F.col("l_linenumber") % 2).cast("int").alias("set_id"),
        F.concat(F.lit("u"), (F.col("l_suppkey") % 25).cast("string")).alias("email"), (F.col("l_linestatus") == "O").alias("flagged"),
        _coord("l_orderkey", 104729, 36000, 180).alias("lon"), _coord("l_orderkey", 7919, 14000, 70).alias("lat"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" secs")).alias("analysis_duration"),
        F.when(F.col("l_returnflag") == "A", "Crop").when(F.col("l_returnflag") == "R", "Non-crop").alias("answer"),
        F.struct(*ORDER).alias("file_ord"),
    )


def final_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("plotid"), F.when(F.col("o_orderstatus") == "O", "Non-crop").otherwise("Crop").alias("answer"))


def ref_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("stratum"), F.col("source").alias("dataset"))
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(F.col("doc_id").alias("id"), F.col("quality").alias("ref_class"), F.col("toxic").alias("map_class"), "stratum", "dataset")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("map"), (F.col("l_partkey") % 200).cast("int").alias("row"), (F.col("l_suppkey") % 100).cast("int").alias("col")).agg(F.max(F.when(F.col("l_tax") > 0.075, F.lit(255.0)).otherwise(F.col("l_discount") * 10)).alias("value"))


def map_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    one = lambda name, value: F.struct(F.lit(name).alias("map"), value.cast("double").alias("value"))
    each = F.explode(F.array(one("m_size", F.col("p_size")), one("m_key", (F.col("p_partkey") * 48271) % 50), one("m_price", F.floor("p_retailprice").cast("int") % 50))).alias("m")
    return part.select(F.col("p_partkey").alias("id"), each).select("id", "m.map", "m.value")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = (F.col("o_orderstatus") == "F").cast("int")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("grp"), y.alias("y_true"), (((F.col("o_orderkey") * 7919 + F.when(y == 1, 150).otherwise(0)) % 1000).cast("double") / 1000).alias("score"))


def eo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series as arrays: 8 timesteps of 8 bands."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") % 2).cast("int").alias("is_crop"), F.expr("transform(sequence(0, 7), t -> transform(slice(embedding, t * 8 + 1, 8), v -> cast(v as double)))").alias("eo"))


def eo_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") % 2).cast("int").alias("is_crop"), F.posexplode("embedding").alias("pos", "v"))
    return one.select("id", "is_crop", F.floor(F.col("pos") / 8).cast("int").alias("t"), (F.col("pos") % 8).cast("int").alias("band"), F.col("v").cast("double").alias("value"))


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_stream(table(spark, sf_dir, "events"))


def as_stream(events: DataFrame) -> DataFrame:
    """The label stream of an ``events`` frame, batch or streaming."""
    ts = F.col("ts").cast("timestamp") if events.isStreaming else F.col("ts")  # watermarks need a time with a zone
    return events.select("event_id", ts.alias("ts"), (F.col("user_id") % 40).alias("plotid"), F.concat(F.lit("u"), (F.col("user_id") % 25).cast("string")).alias("email"), F.when(F.col("event_type").isin("click", "purchase"), "Crop").otherwise("Non-crop").alias("answer"), F.col("value").alias("analysis_secs"))


#: The same inputs in DuckDB SQL.
VIEWS = {
    "b_regions": "select n_nationkey as region_id, n_name as region, n_regionkey as country_id, cast(-180 + 72*(n_nationkey % 5) as double) as x0, cast(-180 + 72*(n_nationkey % 5) + 72 as double) as x1, cast(-70 + 28*cast(floor(n_nationkey/5.0) as int) as double) as y0, cast(-70 + 28*cast(floor(n_nationkey/5.0) as int) + 28 as double) as y1 from nation",
    "b_points": "select c_custkey as id, cast((c_custkey*7919) % 14000 as double)/100 - 70 as lat, cast((c_custkey*104729) % 36000 as double)/100 - 180 as lon, n_name as country, cast(case when c_custkey % 5 = 0 then 0.5 when c_custkey % 5 < 3 then 1.0 else 0.0 end as double) as class_probability, case when (c_custkey*7919) % 1000 < 600 then 'training' when (c_custkey*7919) % 1000 < 800 then 'validation' else 'testing' end as subset, cast(1 + c_custkey % 3 as int) as num_labelers, c_mktsegment as dataset from customer join nation on c_nationkey = n_nationkey",
    "b_annotations": "select l_orderkey as plotid, l_partkey as sampleid, cast(1 + l_linenumber % 2 as int) as set_id, concat('u', cast(l_suppkey % 25 as string)) as email, l_linestatus = 'O' as flagged, cast((l_orderkey*104729) % 36000 as double)/100 - 180 as lon, cast((l_orderkey*7919) % 14000 as double)/100 - 70 as lat, concat(cast(cast(l_quantity as int) as string), ' secs') as analysis_duration, case when l_returnflag = 'A' then 'Crop' when l_returnflag = 'R' then 'Non-crop' else null end as answer, row_number() over (order by " + ",".join(ORDER) + ") as file_ord from lineitem",
    "b_final": "select o_orderkey as plotid, case when o_orderstatus = 'O' then 'Non-crop' else 'Crop' end as answer from orders",
    "b_ref_map": "select l.doc_id as id, l.quality as ref_class, l.toxic as map_class, d.lang as stratum, d.source as dataset from labels l join documents d on l.doc_id = d.doc_id",
    "b_pixels": "select l_returnflag as map, cast(l_partkey % 200 as int) as row, cast(l_suppkey % 100 as int) as col, max(case when l_tax > 0.075 then cast(255 as double) else l_discount*10 end) as value from lineitem group by 1,2,3",
    "b_map_values": "select p_partkey as id, map, cast(value as double) as value from (select p_partkey, 'm_size' as map, p_size as value from part union all select p_partkey, 'm_key' as map, cast((p_partkey*48271) % 50 as int) as value from part union all select p_partkey, 'm_price' as map, cast(floor(p_retailprice) as int) % 50 as value from part) t",
    "b_scores": "select o_orderkey as id, o_orderpriority as grp, cast(case when o_orderstatus='F' then 1 else 0 end as int) as y_true, cast((o_orderkey*7919 + case when o_orderstatus='F' then 150 else 0 end) % 1000 as double)/1000 as score from orders",
    "b_eo_long": "select vec_id as id, cast(label % 2 as int) as is_crop, cast(floor(pos/8) as int) as t, cast(pos % 8 as int) as band, cast(v as double) as value from (select vec_id, label, unnest(embedding) as v, generate_subscripts(embedding, 1) - 1 as pos from embeddings)",
    "b_stream": "select event_id, ts, user_id % 40 as plotid, concat('u', cast(user_id % 25 as string)) as email, case when event_type in ('click','purchase') then 'Crop' else 'Non-crop' end as answer, value as analysis_secs from events",
}


def oracle(sql: str) -> str:
    """``sql`` with the views that it names in front."""
    used = [f"{name} as ({text})" for name, text in VIEWS.items() if name in sql]
    if not used:
        return sql
    return f"with {', '.join(used)}, {sql[5:]}" if sql.startswith("with ") else f"with {', '.join(used)} {sql}"
