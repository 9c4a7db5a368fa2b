"""Schemas of the input tables, for empty targets, CSV scans and test fixtures."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema from `name type, name type, ...`."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


POSITION = _schema(
    "mjid string, chid string, rovertimestamp timestamp, servertimestamp timestamp,"
    "sourcesystemtimestamp timestamp, sourcesystemdate date, latchtypeid int, vehicletypeid int,"
    "azimuth double, localx double, localy double, spreaderazimuth double, spreaderx double,"
    "spreadery double, velocity double, spreaderlength double, spreaderheight double"
)
POSITION_ENHANCED = T.StructType([*POSITION.fields, T.StructField("lot", T.StringType())])
LATCH = _schema(
    "mjid string, chid string, rovertimestamp timestamp, latchtypeid int, containerlot string,"
    "containerrow string, containertier string, container1spot string, container1id string,"
    "container2spot string, container2id string, matchedchid string, distancetravelled double,"
    "duration double, flags int, sourcesystemdate date"
)
FUEL = _schema(
    "mjid string, chid string, rovertimestamp timestamp, level1 double, level2 double,"
    "sourcesystemdate date"
)
IMPACT = _schema(
    "mjid string, chid string, rovertimestamp timestamp,"
    + ",".join(
        f"sensorid{i} int, ximpact{i} double, yimpact{i} double, zimpact{i} double"
        for i in range(1, 5)
    )
    + ", flags int, sourcesystemdate date"
)
LOOKUP_TYPE = _schema(
    "sourcesystem string, audtdateadded timestamp, typeid int, description string"
)
OPERATIONAL_ASSET = _schema(
    "operationalassetid int, operationalassetname string, operationalassetdescription string,"
    "installdate date, operationalviewid int, sortkeyid int"
)
WORK_ORDER = _schema(
    "workorderid int, operationalassetid int, worktypeid int, raisedate date, finishdate date"
)
WORK_TYPE = _schema("worktypeid int, name string, category string")
METER = _schema(
    "operationalassetid int, updatetime date, createtime date, metername string,"
    "meterdescription string"
)
TASK = _schema("operationalassetid int, tasksynclevel int, frequency int")
LOOKUP_TABLE = _schema("tableid int, tablename string, tablevalue string, tabledescription string")
OPERATIONAL_VIEW = _schema("operationalviewid int, name string")
TABLE_ATTRIBUTE = _schema("keyid int, attributenameid int, datavalue string")
INGESTION_TRACKER = _schema(
    "source_name string, ingested_row_count bigint, rovertimestamp timestamp,"
    "ingestiontimestamp date"
)
