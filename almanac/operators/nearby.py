"""Geographic radius search, nearest first: around one point, or around every point of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac import params
from almanac.functions import geo


def within(geotags: DataFrame, latitude: float, longitude: float, radius_meters: int = params.RADIUS, language: str = "en") -> DataFrame:
    """All geotags in the circle, with distance_meters (one decimal), unordered. Coordinates are checked before the language."""
    latitude, longitude = params.coordinates(latitude, longitude)
    meters = params.radius(radius_meters)
    df = geotags.where(F.col("lang") == params.language(language)).where(geo.in_box(F.col("latitude"), F.col("longitude"), latitude, longitude, meters))
    away = geo.distance(F.lit(latitude), F.lit(longitude), F.col("latitude"), F.col("longitude"))
    return df.withColumn("exact", away).where(F.col("exact") <= meters).withColumn("distance_meters", F.round("exact", 1)).drop("exact")


def nearby(geotags: DataFrame, latitude: float, longitude: float, radius_meters: int = params.RADIUS, limit: int = params.NEARBY_LIMIT, language: str = "en") -> DataFrame:
    """title, pageid, latitude, longitude, distance_meters, language of the nearest `limit` (50 at most)."""
    params.coordinates(latitude, longitude)
    most = params.row_limit(limit)
    df = within(geotags, latitude, longitude, radius_meters, language).orderBy("distance_meters", "pageid").limit(most)
    return df.select("title", "pageid", "latitude", "longitude", "distance_meters", F.lit(language).alias("language"))


def nearby_meta(geotags: DataFrame, latitude: float, longitude: float, radius_meters: int = params.RADIUS, limit: int = params.NEARBY_LIMIT, language: str = "en") -> DataFrame:
    """One row: query_latitude, query_longitude, radius_meters_used, shown, cap, truncated (shown reaches cap), notice."""
    rows, cap, meters = nearby(geotags, latitude, longitude, radius_meters, limit, language), params.row_limit(limit), params.radius(radius_meters)
    shown = F.col("shown")
    notice = F.when(shown == 0, F.lit(f"Nothing within {meters} m; a larger radius_meters may help, or other coordinates.")).when(shown >= cap, F.lit(f"Only the first {cap} are shown; a larger limit shows more."))
    one = rows.agg(F.count("*").alias("shown"))
    return one.select(F.lit(float(latitude)).alias("query_latitude"), F.lit(float(longitude)).alias("query_longitude"), F.lit(meters).alias("radius_meters_used"), "shown", F.lit(cap).alias("cap"), (shown >= cap).alias("truncated"), notice.alias("notice"))


def nearby_batch(geotags: DataFrame, points: DataFrame, radius_meters: int = params.RADIUS, limit: int = params.NEARBY_LIMIT, language: str = "en") -> DataFrame:
    """points (point_id, latitude, longitude) to point_id, rank, title, pageid, distance_meters.

    A grid of cells about as wide as the circle makes this an equi-join: each point asks the cells its circle meets. Points of
    one place ask once, and of the geotags of one place, which are as far, only those of the smallest pageids can be answers.
    """
    meters, most, lang = params.radius(radius_meters), params.row_limit(limit), params.language(language)
    tags = _first(geotags.where(F.col("lang") == lang), ["latitude", "longitude"], ["pageid"], most).withColumn("row", geo.cell_row(F.col("latitude"), meters))
    tags = tags.withColumn("cell", geo.cell_column(F.col("longitude"), geo.cells_in_row(F.col("row"), meters)))
    high = geo.cell_rows(meters)
    points = points.select("point_id", F.col("latitude").alias("plat"), F.col("longitude").alias("plon"))
    ask = points.select("plat", "plon").distinct()
    ratio = F.sin(F.radians(F.lit(high))) / F.cos(F.radians("plat"))
    wide = F.when(F.abs("plat") + high >= 90, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), ratio))) * 1.000001)
    ask = ask.withColumns({"wide": wide, "row": F.explode(F.sequence(geo.cell_row(F.col("plat"), meters) - 1, geo.cell_row(F.col("plat"), meters) + 1))})
    ask = ask.withColumn("n", geo.cells_in_row(F.col("row"), meters))
    side = F.least(F.ceil(F.col("wide") * F.col("n") / 360) + 1, F.floor(F.col("n") / 2) + 1).cast("long")
    middle = geo.cell_column(F.col("plon"), F.col("n"))
    ask = ask.withColumn("cell", F.explode(F.array_distinct(F.transform(F.sequence(middle - side, middle + side), lambda c: F.pmod(c, F.col("n"))))))
    away = geo.distance(F.col("plat"), F.col("plon"), F.col("latitude"), F.col("longitude"))
    near = tags.drop("rank").join(ask.drop("wide", "n"), ["row", "cell"]).withColumn("exact", away).where(F.col("exact") <= meters).withColumn("distance_meters", F.round("exact", 1))
    found = _first(near, ["plat", "plon"], ["distance_meters", "pageid"], most).select("plat", "plon", "title", "pageid", "distance_meters")
    rows = _first(points.join(found, ["plat", "plon"]), ["point_id"], ["distance_meters", "pageid"], most)  # a point_id may have several places
    return rows.select("point_id", "rank", "title", "pageid", "distance_meters")


def _first(df: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """The first `most` rows of each group, with their rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= most)
