import pytest
from pyspark.sql import functions as F

from almanac import params


@pytest.mark.parametrize("code", ["not_a_valid_BCP47!!!", "INVALID!!", "xx", "zz", "simple", "fr\n", "", None, 5, "e"])
def test_languages_that_are_none(code):
    with pytest.raises(params.ValidationError) as e:
        params.language(code)
    assert e.value.reason == "invalid_language" and e.value.code == -32007


def test_languages():
    assert params.language("EN") == "en" and params.language("zh-min-nan") == "zh-min-nan"
    assert len(params.EDITIONS) == 227 == len(set(params.EDITIONS))


@pytest.mark.parametrize("value", [0, -1, 5.7, True, "3", None])
def test_limits_that_are_none(value):
    for check in (params.row_limit, params.radius, params.section_index):
        with pytest.raises(params.ValidationError):
            check(value)


def test_limits_are_clamped():
    assert params.row_limit(999) == 50 and params.row_limit(7) == 7
    assert params.radius(99_999) == 10_000 and params.radius(1) == 1


@pytest.mark.parametrize("lat,lon", [(91, 0), (-91, 0), (0, 181), (0, -181), (float("nan"), 0), ("1", 2), (True, 0)])
def test_coordinates_that_are_none(lat, lon):
    with pytest.raises(params.ValidationError) as e:
        params.coordinates(lat, lon)
    assert e.value.reason == "invalid_coordinates"


def test_coordinates_at_the_bounds():
    for lat, lon in ((90, 180), (-90, -180)):
        assert params.coordinates(lat, lon) == (lat, lon)


def test_editions_as_columns(spark):
    df = spark.createDataFrame([(c,) for c in ("EN", "simple", "zz", "fr\n", None, "be-tarask")], "language string")
    joined = {r[0]: r[1] for r in params.with_edition(df).collect()}
    literal = {r[0]: r[1] for r in df.select("language", params.known_edition(F.col("language"))).collect()}
    assert joined == literal == {"EN": True, "simple": False, "zz": False, "fr\n": False, None: False, "be-tarask": True}
