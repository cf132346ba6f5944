"""nearby_batch where many points and geotags share places."""

import math
import random
import time
from collections import defaultdict

from pyspark.sql import functions as F

from almanac.functions import geo
from almanac.operators import nearby


def _away(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    return 2 * geo.EARTH_METERS * math.asin(math.sqrt(min(1.0, math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))


def test_shared_places(spark):
    rng = random.Random(8)
    place = lambda: (48.8 + rng.randrange(4) / 300, 2.3 + rng.randrange(4) / 300)
    tags = [("en", f"T{i}", i, *place()) for i in rng.sample(range(1000), 300)] + [("de", "other", 5000, 48.8, 2.3), ("en", "nowhere", 5001, None, None)]
    asked = [(i, *place()) for i in range(60)] + [(7, *place()), (7, *place()), (None, *place()), (99, None, 2.3)]
    got = defaultdict(list)
    for r in nearby.nearby_batch(spark.createDataFrame(tags, "lang string, title string, pageid long, latitude double, longitude double"), spark.createDataFrame(asked, "point_id long, latitude double, longitude double"), 700, 12).collect():
        got[r["point_id"]].append((r["rank"], r["pageid"], r["distance_meters"], r["title"]))
    want = defaultdict(list)
    for i, lat, lon in asked:
        if lat is not None:
            want[i] += [(round(m, 1), n) for lang, _, n, a, b in tags if lang == "en" and a is not None and (m := _away(lat, lon, a, b)) <= 700]
    assert set(got) == {i for i, found in want.items() if found}
    for i, rows in got.items():
        assert [(rank, n) for rank, n, _, _ in sorted(rows)] == [(k + 1, n) for k, (_, n) in enumerate(sorted(want[i])[:12])]
        assert all(title == f"T{n}" for _, n, _, title in rows)


def test_one_place(spark):
    """400 million pairs of one place: the nearest ten of each point, without making the pairs."""
    tags = spark.range(20_000).select(F.lit("en").alias("lang"), F.concat(F.lit("T"), "id").alias("title"), F.col("id").alias("pageid"), F.lit(48.8).alias("latitude"), F.lit(2.3).alias("longitude"))
    points = spark.range(20_000).select(F.col("id").alias("point_id"), F.lit(48.801).alias("latitude"), F.lit(2.3).alias("longitude"))
    began = time.time()
    n, pages, last = nearby.nearby_batch(tags, points).agg(F.count("*"), F.count_distinct("pageid"), F.max("pageid")).first()
    assert (n, pages, last) == (200_000, 10, 9) and time.time() - began < 30
