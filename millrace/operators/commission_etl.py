"""Commission rows to a star schema: unwind, clean, locations, references, types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.extract import route_ends
from millrace.operators import relational as R

ARRAYS = ("tourcodes", "originating", "flights", "pos", "from_location", "to_location", "pcc")
DATES = ("sales_period_eff_date", "sales_period_dis_date", "tkt_dis_date", "trv_dis_date")
NUMBERS = ("agent_discount", "corporate_discount", "rtw_fare_comm", "ct_fare_comm")
# fixed values: locations that stand for others and for several, and the zones of regions
CLEAN = {"CX AND KA": "ALL CX AND KA", "CX AND KA SYSTEM": "ALL CX AND KA", "SYSTEM": "ALL CX AND KA", "FROM": None}
LISTS = {"MEXICO ANDLATIN AMERICA": ["MEXICO", "LATIN AMERICA"], "MEXICO AND LATIN AMERICA": ["MEXICO", "LATIN AMERICA"], "SHA OR HKG": ["SHA", "HKG"], "WUH, CAN, BJS, SHA OR HKG": ["WUH", "CAN", "BJS", "SHA", "HKG"]}
ZONES = {"ASIA": ["220", "310", "320", "330", "340"], "LATIN AMERICA": ["MX", "120", "140", "160", "170"]}
UNKNOWN_COMMISSION = "9999"


@dataclass
class Star:
    """The three tables and the rows that could not be typed."""

    commissions: DataFrame
    locations: DataFrame
    location_map: DataFrame
    rejected: DataFrame


def unwound(rows: DataFrame) -> DataFrame:
    """One row for each combination of the array columns; blank locations come from the route."""
    ends = route_ends(F.col("route"))
    filled = rows
    for side in ("from_location", "to_location"):
        filled = filled.withColumn(side, F.when(F.size(side) > 0, F.col(side)).otherwise(ends[side]))
    return R.unwind_outer(filled, ARRAYS)


def cleaned(rows: DataFrame) -> DataFrame:
    """Sentinels to null, quotes off codes, locations by the maps, rows of the location ``OR`` dropped."""
    out = rows.withColumns({c: F.nullif(F.col(c), F.lit(UNKNOWN_COMMISSION)) for c in ("rtw_fare_comm", "ct_fare_comm")})
    out = out.withColumns({c: F.regexp_extract(c, r"^\s*([0-9.]+)\s*%?\s*$", 1) for c in ("agent_discount", "corporate_discount")})
    out = out.withColumns({c: R.sentinel(F.col(c), "", R.UNKNOWN_END) for c in DATES if c != "sales_period_eff_date"})
    out = out.withColumn("tourcodes", F.regexp_replace("tourcodes", "['\"]", ""))
    for side in ("from_location", "to_location"):
        out = R.drop_value(R.unwind_values(R.map_values(out, side, CLEAN), side, LISTS), side, "OR")
    return out


def star(rows: DataFrame, airports: DataFrame, parts: int | None = None) -> Star:
    """Build the star schema from commission rows and (code, country, city, zone) of places.

    A location is an airport if the reference knows its code, else a city; regions
    stand for their zones.  Locations get numbers in their order.
    """
    good, rejected = R.typed(cleaned(unwound(rows)), dict.fromkeys(DATES, "date") | dict.fromkeys(NUMBERS, "double"))
    keys = ["from_location", "to_location", "pos"]
    known = good.withColumns({k: F.coalesce(k, F.lit("")) for k in keys})
    locations = R.dense_keys(known, keys, "loc_fk", parts)
    commissions = known.join(locations, keys).drop(*keys)
    places = locations.select(F.explode(F.array("from_location", "to_location")).alias("location"), "pos").where("location <> ''").distinct()
    spread = R.unwind_values(places.withColumn("zone_key", F.col("location")), "zone_key", ZONES)
    reference = airports.select(F.col("code").alias("zone_key"), "country", "city", "zone")
    mapped = spread.join(reference, "zone_key", "left").select(
        "location", "pos",
        F.when(F.col("location") != F.col("zone_key"), F.col("zone_key")).otherwise(F.col("zone")).alias("zone"),
        "country",
        F.when(F.col("country").isNull(), F.col("location")).otherwise(F.col("city")).alias("city"),
    )
    return Star(commissions, locations, mapped.distinct(), rejected)
