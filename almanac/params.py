"""Parameters, checked before any plan is built. The first failing check wins."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEARCH_LIMIT, NEARBY_LIMIT, MOST_ROWS = 10, 10, 50
RADIUS, MOST_RADIUS = 1_000, 10_000
MOST_LINKS = 500

#: Codes of the known editions (fixed values).
EDITIONS = tuple(
    """
    aa ab ace af als am an ang ar arz as ast ay az azb ba bar bcl be be-tarask bg bh bjn bm bn bo bpy br bs bxr ca cbk-zam
    ce ceb ch chy ckb co cr crh cs csb cu cv cy da de diq ee el eml en eo es et eu ext fa ff fi fiu-vro fo fr frp frr fur
    fy ga gag gd gl glk gn got gu hak hat he hi hif hr hsb hu hy hz ia id ie ig ii ilo io is it iu ja jv ka ki kk kl km kn
    ko krc ksh ku kv kw ky la lad lb lg li lij lmo ln lt lv map-bms mg mhr mi min mk ml mn mr ms mt mwl my myv mzn nah nap
    nds nds-nl ne new nl nn no nrm nso oc or os pa pcd pfl pi pl pms pnb ps pt qu rm ro roa-rup roa-tara ru rue rw sa sah
    sc scn sco sd se sg sh si simple sk sl sm sn so sq sr ss st stq su sv sw szl ta te tet tg th tk tl tn to tpi tr ts tt
    tw ty ug uk ur uz ve vec vep vi vls wa war wo wuu xh xmf yo za zh zh-classical zh-min-nan zh-yue
    """.split()
)
#: Shape of a language code. A listed code that does not have it (`simple`) stays out of reach: the shape is checked first.
LANGUAGE_SHAPE = r"[a-z]{2,3}(-[a-z0-9]+)*"


class QueryError(Exception):
    """A request that cannot be answered; `reason` is one of the operators' declared reasons."""

    def __init__(self, reason: str, message: str, **data):
        super().__init__(message)
        self.reason, self.data = reason, data


class ValidationError(QueryError):
    code = -32007


class NotFound(QueryError):
    code = -32001


class Unavailable(QueryError):
    code = -32000


def whole(name: str, value, least: int = 1) -> int:
    """An integer of at least `least`; booleans and fractions are refused."""
    if isinstance(value, bool) or not isinstance(value, int) or value < least:
        raise ValidationError("invalid_parameter", f"{name} must be an integer of {least} or more, not {value!r}", name=name)
    return value


def text(name: str, value) -> str:
    if not isinstance(value, str) or not value:
        raise ValidationError("invalid_parameter", f"{name} must be a text that is not empty", name=name)
    return value


def language(code) -> str:
    """The edition's code in lower case."""
    if not isinstance(code, str) or not re.fullmatch(LANGUAGE_SHAPE, code, re.I | re.A):
        raise ValidationError("invalid_language", f"not a language code: {code!r}", language=code)
    if code.lower() not in EDITIONS:
        raise ValidationError("invalid_language", f"no edition in the language {code!r}", language=code)
    return code.lower()


def row_limit(value) -> int:
    return min(whole("limit", value), MOST_ROWS)


def radius(value) -> int:
    return min(whole("radius_meters", value), MOST_RADIUS)


def coordinates(latitude, longitude) -> tuple[float, float]:
    for name, value, most in (("latitude", latitude, 90), ("longitude", longitude, 180)):
        if isinstance(value, bool) or not isinstance(value, (int, float)) or not -most <= value <= most:
            raise ValidationError("invalid_coordinates", f"{name} must be from -{most} to {most}, not {value!r}", latitude=latitude, longitude=longitude)
    return float(latitude), float(longitude)


def section_index(value) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ValidationError("invalid_section", f"section_index must be an integer of 1 or more, not {value!r}", section_index=value)
    return value


def editions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in EDITIONS], "code string")


def well_formed(code: Column) -> Column:
    """Whether a language column has the shape of a code; the end is the end of the text, also before a line break."""
    return code.rlike(rf"(?i)\A{LANGUAGE_SHAPE}\z")


def known_edition(code: Column) -> Column:
    return F.coalesce(well_formed(code) & F.lower(code).isin(*EDITIONS), F.lit(False))


def with_edition(requests: DataFrame, column: str = "language") -> DataFrame:
    """requests with `known`, by a join to the list of editions rather than a literal: for large request tables."""
    known = F.broadcast(editions(requests.sparkSession).withColumn("_known", F.lit(True)))
    df = requests.join(known, F.lower(requests[column]) == F.col("code"), "left")
    return df.withColumn("known", F.coalesce(F.col("_known") & well_formed(F.col(column)), F.lit(False))).drop("code", "_known")
