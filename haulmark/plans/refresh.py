"""Full refreshes: dimension snapshots and latest-record tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from haulmark.functions.timeops import NEVER, YARD_ZONE, local_time, year_month
from haulmark.operators.latest import drop_tombstones, latest_by_maxima, snapshot_dimension


# Attributes of each dimension besides the source system.
DIMENSIONS: Mapping[str, Sequence[str]] = {
    "latchtype": ("latchtypeid", "description"),
    "maptype": ("maptypeid", "description"),
    "tiretype": ("tiretypeid", "description"),
    "tiresourcetype": ("tiresourcetypeid", "description"),
    "vehicletype": ("vehicletypeid", "description", "mapconstrainttypeid", "title"),
    "flagdescription": (
        "flagdescriptionid", "flagvalue", "description", "tablename", "columnname", "schema",
        "active",
    ),
    "mapdata": (
        "maptypeid", "position1x", "position1y", "position3x", "position2x", "position2y",
        "position3y", "parkingrowlength", "rowheight", "parkingrowwidth", "columncount",
        "rowcount", "startingrownumber", "incrementby", "lot", "row", "startingcolumnnumber",
        "slotdigits", "rowangle", "flags", "stringformat", "mapconstrainttypeid", "isactive",
        "mapgroupid",
    ),
}

# Columns a dimension row must have.
REQUIRED = {"mapdata": ("maptypeid",)}

# Columns of the latest-record tables, and the default of each maximum.
ROVER_COLUMNS = (
    "sourcesystem", "mjid", "chid", "lastdetailtimestamp", "ipaddress", "softwareversion",
    "navversion", "updateversion", "gpshwversion1", "gpshwversion2", "powerhwversion",
    "powerfwversion", "startuptimestamp", "fleetmanagementversion", "keepaliveversion",
    "vehicleviewversion", "bootloaderfwversion", "gyroserialnumber", "flags",
    "navbootloaderversion",
)
ROVER_MAXIMA = {"lastdetailtimestamp": None, "startuptimestamp": NEVER}
VEHICLE_COLUMNS = (
    "sourcesystem", "mjid", "chid", "lastdetailtimestamp", "lastfueltimestamp",
    "lastrefueltimestamp", "lasttiretimestamp", "lastimpacttimestamp", "vehicletypeid",
    "vehiclesubtypeid", "trailcolor", "status", "tosserveripaddress", "lastplctimestamp",
)
VEHICLE_MAXIMA = {
    "lastdetailtimestamp": NEVER,
    "lastfueltimestamp": NEVER,
    "lastrefueltimestamp": NEVER,
    "lasttiretimestamp": NEVER,
    "lastimpacttimestamp": NEVER,
    "vehiclesubtypeid": 0,
    "lastplctimestamp": NEVER,
}


def dimension(staging: DataFrame, name: str) -> DataFrame:
    """Snapshot of one of `DIMENSIONS` from its staging table."""
    return snapshot_dimension(
        drop_tombstones(staging),
        ["sourcesystem", *DIMENSIONS[name]],
        not_null=REQUIRED.get(name, ()),
    )


def rover_details(
    staging: DataFrame, latest_only: bool = False, zone: str = YARD_ZONE, never: date = NEVER
) -> DataFrame:
    """Rover records with local time and year-month; all of them, or the latest per machine."""
    rows = drop_tombstones(staging).select(*ROVER_COLUMNS)
    if latest_only:
        rows = latest_by_maxima(rows, "mjid", ROVER_MAXIMA)
    else:
        rows = rows.withColumn(
            "startuptimestamp",
            F.coalesce(
                "startuptimestamp", F.lit(never).cast(rows.schema["startuptimestamp"].dataType)
            ),
        ).distinct()
    return rows.withColumns(
        {
            "yrmon": year_month("lastdetailtimestamp", never),
            "sourcesystemtimestamp": local_time(rows, "lastdetailtimestamp", zone),
        }
    )


def vehicle_details(staging: DataFrame, latest_only: bool = True) -> DataFrame:
    """Vehicle records with their year-month; the latest per machine, or all of them."""
    rows = drop_tombstones(staging).select(*VEHICLE_COLUMNS)
    if latest_only:
        rows = latest_by_maxima(rows, "mjid", VEHICLE_MAXIMA)
    else:
        rows = rows.withColumns(
            {
                name: F.coalesce(name, F.lit(default).cast(rows.schema[name].dataType))
                for name, default in VEHICLE_MAXIMA.items()
            }
        ).distinct()
    return rows.withColumn("yrmon", year_month("lastdetailtimestamp"))
