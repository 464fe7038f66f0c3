"""Batch sources and sinks.

Formats are selectable: Delta when its jar is on the classpath, otherwise
Parquet; JDBC when a driver and URL are configured.  Nothing here collects
data to the driver except table *names* (catalog listing) and single
numbers (row counts).
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.plans.joins import broadcast_if_small, with_stats


def has_delta(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("io.delta.tables.DeltaTable")
        return True
    except Exception:
        return False


def lake_format(spark: SparkSession, preferred: str = "delta") -> str:
    """Delta when available, Parquet otherwise."""
    return "delta" if preferred == "delta" and has_delta(spark) else "parquet"


# ------------------------------------------------------------------ CSV ----
#: Letters of the local alphabet to plain ones, and what is left to become an underscore.
_PLAIN = str.maketrans(C.TRANSLIT_FROM, C.TRANSLIT_TO)
_OTHER = "[^a-zA-Z0-9]"


def clean_name(name: str) -> str:
    """P7 (names): the cleanup of ``clean_values`` for one column name (schema metadata)."""
    return re.sub(_OTHER, "_", name.strip().translate(_PLAIN)).lower()


def clean_values(col: str):
    """P7 (values): trim, transliterate, non-alphanumerics to underscores, lower case; in Catalyst."""
    x = F.translate(F.trim(F.col(col)), C.TRANSLIT_FROM, C.TRANSLIT_TO)
    return F.lower(F.regexp_replace(x, _OTHER, "_"))


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Header CSV (a file or a glob such as ``dir/*.csv``), names cleaned.

    ``inferSchema`` costs an extra pass over the input; pass ``schema`` at scale.
    """
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    return df.toDF(*[clean_name(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV export (one directory of part files; no driver-side concatenation)."""
    df.write.mode("overwrite").option("header", header).csv(path)


def recent_export(market: DataFrame, tier: str, time_col: str = "processed_time") -> DataFrame:
    """S19 + P18: 5 export columns for the tier's recent interval (PREMIUM 12 h, VIP 24 h).

    'Now' is the newest row of the table, so history exports are reproducible.
    """
    hours = dict(C.EXPORT_HOURS).get(tier)
    if hours is None:
        raise PermissionError("FREE tier cannot export")
    m = with_stats(market, market.agg(F.max(time_col).alias("_now")))
    return (m.filter(F.col(time_col) >= F.col("_now") - F.expr(f"INTERVAL {hours} HOURS"))
            .select(F.col("symbol"), F.col("average_price").alias("price"), "volume_usd", "cvd",
                    F.col("vpin_score").alias("vpin")))


def recent_export_by_tier(market: DataFrame, users: DataFrame, time_col: str = "processed_time",
                          hours=C.EXPORT_HOURS) -> DataFrame:
    """S19 + P18: the export rows of every tier that users hold and that may export (PREMIUM, VIP).

    Each row is copied to the tiers whose interval holds it, a fixed list, and tiers without a user drop
    out by a semi-join with the distinct tiers, at most as many rows as there are tiers.
    """
    m = with_stats(market, market.agg(F.max(time_col).alias("_now")))
    tiers = F.array(*[F.when(F.col(time_col) >= F.col("_now") - F.expr(f"INTERVAL {h} HOURS"), F.lit(t)) for t, h in hours])
    rows = m.select(F.explode(F.array_compact(tiers)).alias("tier"), "symbol", F.col("average_price").alias("price"),
                    "volume_usd", "cvd", F.col("vpin_score").alias("vpin"))
    held = users.filter(F.col("tier").isin([t for t, _ in hours])).select("tier").distinct()
    return rows.join(F.broadcast(held), "tier", "left_semi")


# ------------------------------------------------------------- lake IO ----
def read_lake(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Table scan (Delta or Parquet); filters on partition columns prune directories."""
    return spark.read.format(fmt or lake_format(spark)).load(path)


def write_lake(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite", fmt: str | None = None) -> None:
    """Overwrite (or append), optionally partitioned (e.g. symbol, year)."""
    w = df.write.mode(mode).format(fmt or lake_format(df.sparkSession))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


#: What Spark says when there is no table yet; any other failure of a read is an error.
NOT_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_there(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None if there is none; other errors are raised."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() not in NOT_THERE:
            raise
        return None


def upsert(spark: SparkSession, batch: DataFrame, path: str, keys: list[str],
           partition_by: list[str] | None = None) -> None:
    """MERGE update-all / insert-all on ``keys`` without Delta.

    Only partitions touched by the batch are rewritten (dynamic partition
    overwrite).  The merged partitions are first cut from their lineage with
    ``checkpoint()`` (the cluster's shared checkpoint folder), because they
    are read from the very files being replaced.
    """
    partition_by = partition_by or []
    current = read_if_there(spark, path)
    if current is None:
        write_lake(batch, path, partition_by, "overwrite", "parquet")
        return
    if partition_by:
        touched = batch.select(*partition_by).distinct()
        current = current.join(broadcast_if_small(touched), partition_by, "left_semi")
    merged = (current.join(batch.select(*keys), keys, "left_anti")
              .unionByName(batch.select(*current.columns)))
    merged = merged.checkpoint(eager=True)
    w = merged.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key (max_by over a total order; partial aggregation)."""
    others = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_r"))
            .select(*keys, "_r.*"))


# ----------------------------------------------------------------- JDBC ----
def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, mode: str = "append",
               drop: list[str] = ()) -> None:
    """JDBC write with columns dropped first (needs the driver jar on the classpath)."""
    df.drop(*drop).write.jdbc(url=url, table=table, mode=mode, properties=properties)


def table_name_from_file(path: str) -> str:
    """Target table named after the uploaded file."""
    base = path.rstrip("/").split("/")[-1]
    return clean_name(base.rsplit(".", 1)[0])


# -------------------------------------------------------- catalog / SQL ----
def materialize(df: DataFrame, name: str, as_view: bool = True) -> None:
    """Temp view, or a managed table."""
    if as_view:
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)


def run_sql(spark: SparkSession, query: str) -> DataFrame:
    """Ad-hoc SQL over registered tables and views."""
    return spark.sql(query)


def list_tables(spark: SparkSession) -> list[str]:
    """Catalog listing (names only)."""
    return sorted(t.name for t in spark.catalog.listTables())


def row_count(spark: SparkSession, name: str) -> int:
    """One aggregate; parquet can answer from footers."""
    return spark.table(name).count()


def truncate(spark: SparkSession, path: str) -> None:
    """Empty a parquet table, keeping its schema."""
    df = spark.read.parquet(path)
    df.limit(0).checkpoint(eager=True).write.mode("overwrite").parquet(path)


# ------------------------------------------------------------------ XML ----
RSS_ITEM = "struct<title: string, link: string, pubDate: string>"
#: Items stand in the channel (RSS 2.0) or beside it (RSS 1.0); attributes and namespaces are passed over.
RSS_FEED = f"channel struct<item: array<{RSS_ITEM}>>, item array<{RSS_ITEM}>"


def rss_items(docs: DataFrame, xml_col: str = "xml", limit: int = 5) -> DataFrame:
    """The first ``limit`` items (title, link, pubDate) of every feed, parsed as a whole with ``from_xml``.

    Returns the other columns of ``docs``, pos (from 0), title, link, pubDate.  Missing fields are null; a
    text that is no feed, or no XML at all, has no items.
    """
    feed = F.from_xml(F.col(xml_col), RSS_FEED, {"ignoreNamespace": "true", "mode": "PERMISSIVE", "excludeAttribute": "true"})
    others = [c for c in docs.columns if c != xml_col]
    items = F.coalesce(F.col("_feed.channel.item"), F.col("_feed.item"))
    return (docs.select(*others, feed.alias("_feed")).select(*others, F.posexplode(F.slice(items, 1, limit)).alias("pos", "_i"))
            .select(*others, "pos", "_i.title", "_i.link", "_i.pubDate"))
