"""Bind the driver's tables to the domain shapes (see FIXTURES.md section 3).

Every view here is a projection of a given table, so its size grows with the
data. The derived pollutant columns are our own deterministic rules; each has
a one-line SQL twin in ``__spark_entry__.py`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.labels import three_band

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]

REFERENCE_CUTOFF = "2024-01-16 00:00:00"
N_RULE_MODELS = 5
# a landed doc holds one hour of one block of this many consecutive stations
STATIONS_PER_DOC = 1024


def station_block(station: str = "station_id"):
    """Doc group of a station: ``station div STATIONS_PER_DOC``."""
    return F.expr(f"{station} div {STATIONS_PER_DOC}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def measurements(events: DataFrame) -> DataFrame:
    """events -> one measurement row per event.

    city = event_type, timestamp = ts, version = event_id, pm2_5 = value
    (null where event_id % 17 = 0), pm10 = user_id, us_aqi = props.k.
    """
    v = F.col("value")
    k = F.get_json_object("props", "$.k").cast("bigint")
    city = F.col("event_type")
    return events.select(
        city.alias("city"),
        (F.length(city).cast("double") * F.lit(7.5) - F.lit(40.0)).alias("latitude"),
        (F.ascii(city).cast("double") - F.lit(150.0)).alias("longitude"),
        F.lit("UTC").alias("timezone"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("double")).otherwise(v).alias("pm2_5"),
        F.col("user_id").cast("double").alias("pm10"),
        (v * F.lit(10.0)).alias("carbon_monoxide"),
        (v / F.lit(4.0)).alias("nitrogen_dioxide"),
        (F.col("event_id") % 50).cast("double").alias("sulphur_dioxide"),
        ((F.col("user_id") * 7) % 120).cast("double").alias("ozone"),
        k.alias("us_aqi"),
        ((k * 7) % 600).alias("european_aqi"),
        F.col("event_id").alias("version"),
        F.col("user_id").alias("station_id"),
    )


def measurements_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements(table(spark, sf_dir, "events"))


def labeled_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = measurements_table(spark, sf_dir)
    return m.withColumn("air_quality_label", three_band("pm2_5")).withColumn("parameter", F.lit("pm2_5"))


def reference_current(df: DataFrame, ts: str = "timestamp", cutoff: str = REFERENCE_CUTOFF):
    """Split a table at a time cutoff: (before, from)."""
    c = F.lit(cutoff).cast("timestamp_ntz")
    return df.filter(F.col(ts) < c), df.filter(F.col(ts) >= c)


def stored_predictions(events: DataFrame, n_models: int = N_RULE_MODELS) -> DataFrame:
    """Deterministic rule "models" over events, for exact metric oracles.

    Model m predicts the band of value + ((event_id % 5) - 2) * 3m; per-class
    scores are 1 / (1 + |shifted - centre|) normalised to sum 1.
    """
    shifted = F.col("value") + ((F.col("event_id") % 5) - 2).cast("double") * F.col("model_idx").cast("double") * 3.0
    sg = F.lit(1.0) / (F.lit(1.0) + F.abs(F.col("shifted") - F.lit(6.0)))
    sm = F.lit(1.0) / (F.lit(1.0) + F.abs(F.col("shifted") - F.lit(23.7)))
    su = F.lit(1.0) / (F.lit(1.0) + F.abs(F.col("shifted") - F.lit(60.0)))
    tot = (F.col("sg") + F.col("sm")) + F.col("su")
    return (
        events.select("event_id", "value")
        .withColumn("model_idx", F.explode(F.sequence(F.lit(0), F.lit(n_models - 1))))
        .withColumn("model", F.concat(F.lit("rule_"), F.col("model_idx").cast("string")))
        .withColumn("shifted", shifted)
        .withColumn("sg", sg)
        .withColumn("sm", sm)
        .withColumn("su", su)
        .select(
            "model",
            "event_id",
            three_band("value").alias("label"),
            three_band("shifted").alias("prediction"),
            (F.col("sg") / tot).alias("p_good"),
            (F.col("sm") / tot).alias("p_moderate"),
            (F.col("su") / tot).alias("p_unhealthy"),
        )
    )


def probabilities_long(pred: DataFrame) -> DataFrame:
    """(model, event_id, label, class, score) long form of the class scores."""
    return pred.select(
        "model",
        "event_id",
        "label",
        F.inline(
            F.array(
                F.struct(F.lit("good").alias("class"), F.col("p_good").alias("score")),
                F.struct(F.lit("moderate").alias("class"), F.col("p_moderate").alias("score")),
                F.struct(F.lit("unhealthy").alias("class"), F.col("p_unhealthy").alias("score")),
            )
        ),
    )


def nest_hourly_docs(m: DataFrame) -> DataFrame:
    """Measurements -> raw docs: one per (city, station block, hour),
    parallel arrays ordered by (timestamp, version), time as an ISO-minute
    string.

    Ragged on purpose: docs of hours divisible by 5 lose the last ``ozone``
    element (padded back with null on read) and docs of hours divisible by 7
    carry no ``european_aqi`` array at all. The fetch time is the doc's latest
    measurement time. A doc holds one hour of at most ``STATIONS_PER_DOC``
    stations, so its size stays bounded as the table grows (the time span is
    fixed, stations scale with the data); a (city, hour) doc would grow with it.
    """
    feats = ["pm2_5", "pm10", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone", "us_aqi", "european_aqi"]
    rec = F.struct(
        F.col("timestamp"),
        F.col("version"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm").alias("time"),
        *[F.col(c).cast("double").alias(c) for c in feats],
    )
    g = (
        m.withColumn("doc_hour", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
        .withColumn("station_block", station_block())
        .groupBy("city", "station_block", "doc_hour")
        .agg(
            F.first("latitude").alias("latitude"),
            F.first("longitude").alias("longitude"),
            F.first("timezone").alias("timezone"),
            F.max("timestamp").alias("fetched"),
            F.sort_array(F.collect_list(rec)).alias("r"),
        )
    )
    hour = F.hour("doc_hour")

    def series(name):
        return F.transform("r", lambda x: x[name])

    ozone = F.when(hour % 5 == 0, F.slice(series("ozone"), 1, F.size("r") - 1)).otherwise(series("ozone"))
    eu = F.when(hour % 7 == 0, F.lit(None).cast("array<double>")).otherwise(series("european_aqi"))
    hourly = F.struct(
        series("time").alias("time"),
        *[series(c).alias(c) for c in feats[:5]],
        ozone.alias("ozone"),
        series("us_aqi").alias("us_aqi"),
        eu.alias("european_aqi"),
    )
    return g.select(
        "latitude",
        "longitude",
        "timezone",
        F.col("city").alias("city_name"),
        F.date_format("fetched", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetch_timestamp"),
        F.create_map(F.lit("time"), F.lit("iso8601"), F.lit("pm2_5"), F.lit("ug/m3")).alias("hourly_units"),
        hourly.alias("hourly"),
    )


# long-feed parameter name -> measurement column (our binding)
LONG_PARAMETER_COLUMNS = [
    ("pm25", "pm2_5"),
    ("pm10", "pm10"),
    ("o3", "ozone"),
    ("no2", "nitrogen_dioxide"),
    ("so2", "sulphur_dioxide"),
    ("co", "carbon_monoxide"),
]


def long_feed_rows(m: DataFrame, keep: tuple = ()) -> DataFrame:
    """Measurements unpivoted to the long feed: (city, ts, parameter, value),
    null values omitted, location = station id (plus ``keep`` columns)."""
    pairs = F.array(*[F.struct(F.lit(p).alias("parameter"), F.col(c).alias("value")) for p, c in LONG_PARAMETER_COLUMNS])
    return (
        m.select(
            "city",
            F.col("timestamp").alias("ts"),
            F.concat(F.lit("station-"), F.col("station_id").cast("string")).alias("location"),
            *keep,
            F.inline(pairs),
        )
        .filter(F.col("value").isNotNull())
    )


def nest_long_feed_docs(m: DataFrame) -> DataFrame:
    """Long rows -> feed docs ``{meta, results[]}``, one per (city, station
    block, hour), so a doc stays bounded as the table grows."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rec = F.struct(
        F.col("location"),
        F.col("city"),
        F.lit("XX").alias("country"),
        F.col("parameter"),
        F.col("value"),
        F.lit("ug/m3").alias("unit"),
        F.struct(iso.alias("utc"), iso.alias("local")).alias("date"),
    )
    rows = long_feed_rows(m, keep=(station_block().alias("station_block"),))
    return (
        rows.withColumn("doc_hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
        .groupBy("city", "station_block", "doc_hour")
        .agg(F.collect_list(rec).alias("results"), F.count("*").alias("found"))
        .select(F.create_map(F.lit("found"), F.col("found").cast("string")).alias("meta"), "results")
    )
