"""Address dictionary of C4: texts that share a key, texts in exchanges, ids against the plain DISTINCT."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from filingfold.constants import DS_JP, DS_PATSTAT, DS_PCT, DS_USPTO
from filingfold.operators.info import LOCATION_ROW_COLUMNS, address_ids, location_rows, text_key
from tests.helpers import locations as make_locations
from tests.helpers import register

ADDRESSES = [
    # Two locations with one text and point are one spot; one text on two points is two.
    {"location_id": 1, "unformattedaddress": "12 Mill Road", "data_source": DS_USPTO, "lat": 1.0, "lng": 2.0, "coord_source": "API"},
    {"location_id": 2, "unformattedaddress": "12 Mill Road", "data_source": DS_USPTO, "lat": 1.0, "lng": 2.0, "coord_source": "API"},
    {"location_id": 3, "unformattedaddress": "12 Mill Road", "data_source": DS_PCT, "lat": 3.0, "lng": 2.0, "coord_source": "API"},
    {"location_id": 4, "unformattedaddress": "7 Bay Street", "data_source": DS_PCT, "lat": None, "lng": None, "coord_source": None},
    {"location_id": 5, "unformattedaddress": None, "data_source": DS_PATSTAT, "lat": 1.0, "lng": 2.0, "coord_source": "API"},
    {"location_id": 6, "unformattedaddress": "", "data_source": DS_PCT, "lat": 6.0, "lng": 6.0, "coord_source": "API"},
    {"location_id": 7, "unformattedaddress": "one text", "data_source": DS_JP, "lat": 1.0, "lng": 2.0, "coord_source": "API"},
    {"location_id": 8, "unformattedaddress": "another text", "data_source": DS_JP, "lat": 1.0, "lng": 2.0, "coord_source": "API"},
]
PCT = [(10, "12 Mill Road", 4), (10, "7 Bay Street", 4), (11, "", 4), (11, None, 4), (12, "12 mill road", 4), (10, "12 Mill Road", 4)]


def inputs(spark):
    reg = register(spark, pers_appln=[(1, 10, 0, 1), (1, 10, 0, 2), (2, 11, 0, 1)])
    loc = make_locations(
        spark, addresses=ADDRESSES, addresses_pct=PCT, person_location=[(1, 1), (1, 2), (1, 5), (2, 5)],
        jp=[(20, 7, "INV"), (20, 8, "INV"), (20, 7, "APP")],
    )
    return reg, loc


def every_text_one_key(text):
    return tuple(F.when(text.isNotNull(), F.lit(i).cast("long")) for i in (1, 2))


@pytest.mark.parametrize("key_of", [text_key, every_text_one_key])
def test_rows_by_id_equal_the_plain_union(spark, key_of):
    reg, loc = inputs(spark)
    ids = address_ids(loc, key_of)
    assert (len(ids.key) == 3) == (key_of is every_text_one_key)
    points = ids.spots.join(ids.points, "point_id").drop("point_id")
    got = location_rows(reg, loc, ids).filter("role = 'inv'").join(points, "spot_id").select("appln_id", "person_id", "data_source", "lat")
    # (10, 1): locations 1 and 2 are one spot, 5 another; (11, 2): 5.  WIPO texts by hand.
    want = [
        (10, 1, DS_USPTO, 1.0), (10, 1, DS_PATSTAT, 1.0), (11, 2, DS_PATSTAT, 1.0),
        (10, 0, DS_USPTO, 1.0), (10, 0, DS_PCT, 3.0), (10, 0, DS_PCT, None), (11, 0, DS_PCT, 6.0),
        (20, 0, DS_JP, 1.0),
    ]
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert set(LOCATION_ROW_COLUMNS) <= {"appln_id", "person_id", *points.columns}


def test_no_text_in_an_exchange_of_the_union(spark):
    reg, loc = inputs(spark)
    plan = location_rows(reg, loc, address_ids(loc))
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    above = [x for x in lines if "Join" in x or "Aggregate" in x or "Repartition" in x]
    assert above and not any("unformattedaddress" in x or "address_text" in x for x in above)
    # The texts' keys are made in the scan's own projection, below every join.
    assert any("Project" in x and "xxhash64(address_text" in x for x in lines)
