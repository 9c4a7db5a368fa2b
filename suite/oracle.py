"""The SQL of every query in `suite.queries`, for an independent engine on the same tables."""

from __future__ import annotations

from haulmark.plans import telemetry as flat
from suite.standins import FLAT_SIDES

HOUR, DAY = "INTERVAL 1 HOUR", "INTERVAL 1 DAY"


def _local(column: str) -> str:
    return f"(({column} AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"


NEW_YORK = _local("ts")


def _kind(alias: str, kind: str) -> str:
    return f"""{alias} AS (
        SELECT event_id, ts, user_id AS mjid, user_id % 10 AS chid, value,
               user_id % 5 AS latchtypeid, user_id % 25 AS vehicletypeid
        FROM events WHERE event_type = '{kind}')"""


TELEMETRY = "WITH " + ", ".join(
    _kind(*pair)
    for pair in [("pos", "view"), ("latch", "click"), ("fuel", "purchase"), ("impact", "error"),
                 ("tire", "signup")]
)


def _attached(name: str) -> str:
    return f"{name}.event_id AS {name}_id, {name}.ts AS {name}_ts, {name}.value AS {name}_value"


def _left(name: str, keys: str, window: str) -> str:
    same = " AND ".join(f"{name}.{key} = pos.{key}" for key in keys.split())
    return f"LEFT JOIN {name} ON {same} AND {name}.ts <= pos.ts AND {name}.ts >= pos.ts - {window}"


ENRICHED = f"""
    FROM pos
    JOIN region ON r_regionkey = latchtypeid
    JOIN nation ON n_nationkey = vehicletypeid
    {_left("latch", "mjid chid", "INTERVAL 6 HOUR")}
    {_left("fuel", "mjid chid", DAY)}
    {_left("impact", "mjid chid", "INTERVAL 6 HOUR")}
    {_left("tire", "chid", HOUR)}"""
ENRICHED_COLUMNS = f"""pos.event_id, pos.mjid, pos.chid, pos.value,
    r_name AS spreaderstate, n_name AS vehicletype,
    {_attached("latch")}, {_attached("fuel")}, {_attached("impact")}, {_attached("tire")}"""

CODES = """codes AS (
    SELECT n_nationkey AS tableid,
           CASE n_nationkey WHEN 23 THEN 'MAKE' WHEN 24 THEN 'MODEL NO' ELSE n_name END AS tablename,
           CAST(n_nationkey * 10 AS VARCHAR) AS tablevalue,
           CASE WHEN n_nationkey = 4 THEN 'NULL' ELSE 'Cause ' || n_name END AS tabledescription
    FROM nation)"""
VIEWS = "views AS (SELECT r_regionkey AS operationalviewid, r_name AS name FROM region)"
CUSTOMERS = f"""WITH {CODES}, {VIEWS}, asset AS (
    SELECT c_custkey AS operationalassetid, c_name AS operationalassetname,
           c_mktsegment AS operationalassetdescription,
           CASE WHEN c_acctbal >= 0 THEN make_date(c_nationkey + 1980, 6, 15) END AS installdate,
           c_nationkey % 5 AS operationalviewid, c_nationkey AS sortkeyid
    FROM customer),
workorder AS (
    SELECT workorderid, operationalassetid, category, raisedate,
           CASE WHEN digit < 5 THEN raisedate + digit * 10 END AS finishdate, digit AS faultid
    FROM (SELECT o_orderkey AS workorderid, o_custkey AS operationalassetid,
                 CASE o_orderstatus WHEN 'F' THEN 'Failure' WHEN 'O' THEN 'Maintenance'
                      ELSE 'Inspection' END AS category,
                 CAST(o_orderdate AS DATE) AS raisedate,
                 CAST(o_orderpriority[1] AS INTEGER) AS digit
          FROM orders)),
meter AS (
    SELECT o_custkey AS operationalassetid, CAST(o_orderdate AS DATE) AS updatetime,
           CASE o_orderstatus WHEN 'P' THEN 'Hour Meter' ELSE 'Odometer' END AS meterdescription,
           o_totalprice / 1000 AS reading
    FROM orders),
task AS (
    SELECT o_custkey AS operationalassetid, CAST(o_orderpriority[1] AS INTEGER) AS tasksynclevel,
           CAST(month(o_orderdate) * 50 AS INTEGER) AS frequency
    FROM orders),
keyed AS (
    SELECT asset.*, tablename AS sortkeyname, tablevalue FROM asset JOIN codes ON sortkeyid = tableid),
qualifying AS (
    SELECT * FROM keyed WHERE sortkeyname NOT IN ('NATION_3', 'NATION_7')
      AND operationalassetname NOT LIKE '%77%' AND operationalassetname NOT LIKE '%#0000013%')"""
PARTS = f"""WITH {CODES}, {VIEWS}, asset AS (
    SELECT p_partkey AS operationalassetid, p_name AS operationalassetname,
           p_type AS operationalassetdescription, make_date(1990 + p_size % 10, 1, 31) AS installdate,
           p_size % 5 AS operationalviewid, CAST(p_brand[7:] AS INTEGER) - 1 AS sortkeyid
    FROM part),
workorder AS (
    SELECT l_orderkey AS workorderid, l_partkey AS operationalassetid,
           CASE l_returnflag WHEN 'R' THEN 'FAIL' WHEN 'A' THEN 'SCH' ELSE 'OTHER' END AS worktypename,
           CASE l_returnflag WHEN 'R' THEN 'Failure' ELSE 'Other' END AS category,
           l_linenumber * 5 AS faultid
    FROM lineitem),
meter AS (
    SELECT l_partkey AS operationalassetid, CAST(l_shipdate AS DATE) AS updatetime,
           l_linestatus AS metername, 'Meter ' || l_returnflag AS meterdescription,
           l_quantity AS reading
    FROM lineitem),
keyed AS (
    SELECT asset.*, tablename AS sortkeyname, tablevalue, tabledescription
    FROM asset JOIN codes ON sortkeyid = tableid),
qualifying AS (
    SELECT * FROM keyed WHERE sortkeyname NOT IN ('NATION_3', 'NATION_7')
      AND operationalassetname NOT LIKE '%anvil%' AND operationalassetname NOT LIKE '%old %'),
attribute AS (
    SELECT p_partkey AS keyid, 23 AS attributenameid,
           CASE WHEN p_size = 50 THEN 'NULL' ELSE ' ' || chr(9) || upper(p_name) || ' ' END AS datavalue
    FROM part
    UNION ALL SELECT p_partkey, 23, 'ZZ ' || p_brand FROM part
    UNION ALL SELECT p_partkey, CASE WHEN p_size = 49 THEN 22 ELSE 24 END, p_type FROM part),
makes AS (
    SELECT keyid AS operationalassetid, min(datavalue) AS make
    FROM attribute JOIN codes ON tableid = attributenameid WHERE tablename = 'MAKE' GROUP BY keyid),
models AS (
    SELECT keyid AS operationalassetid, min(datavalue) AS model
    FROM attribute JOIN codes ON tableid = attributenameid WHERE tablename = 'MODEL NO' GROUP BY keyid)"""

MARGINS = """readings AS (
    SELECT meter.operationalassetid, CAST(trunc(reading) AS BIGINT) AS reading, updatetime
    FROM meter JOIN keyed USING (operationalassetid) JOIN views USING (operationalviewid)
    WHERE meterdescription = 'Hour Meter'),
usage AS (
    SELECT operationalassetid, CAST(sum(reading) AS BIGINT) AS value, min(updatetime) AS mindate,
           max(updatetime) AS maxdate,
           CAST(datediff('day', min(updatetime), max(updatetime)) AS DOUBLE) AS daterange
    FROM readings GROUP BY operationalassetid),
frequencies AS (
    SELECT task.operationalassetid, frequency FROM task
    JOIN (SELECT operationalassetid, max(tasksynclevel) AS tasksynclevel FROM task GROUP BY 1) m
      ON task.operationalassetid = m.operationalassetid AND task.tasksynclevel = m.tasksynclevel),
margins AS (
    SELECT operationalassetid, value, mindate, maxdate, daterange, frequency,
           round(daterange * frequency / nullif(value, 0), 0) AS estimated, 350 AS pm_margin,
           round(daterange * 350 / nullif(value, 0), 0) AS pm_margin_days
    FROM usage JOIN frequencies USING (operationalassetid))"""
MARGIN_COLUMNS = """operationalassetid, value, mindate, maxdate, daterange, frequency, estimated,
    pm_margin, pm_margin_days"""

LISTING = """work AS (
    SELECT w.operationalassetid, operationalassetname, v.name AS operationalviewname, category,
           raisedate, finishdate
    FROM workorder w JOIN asset a ON a.operationalassetid = w.operationalassetid
    JOIN views v ON v.operationalviewid = a.operationalviewid
    WHERE w.operationalassetid IN (SELECT operationalassetid FROM keyed)
      AND operationalassetname NOT LIKE '%77%' AND operationalassetname NOT LIKE '%#0000013%'),
named AS (
    SELECT operationalassetid, max(operationalassetname) AS operationalassetname,
           max(operationalviewname) AS operationalviewname
    FROM work WHERE operationalassetid IN (SELECT operationalassetid FROM qualifying) GROUP BY 1),
labelled AS (
    SELECT work.operationalassetid, named.operationalassetname, named.operationalviewname,
           sortkeyname, CASE category WHEN 'Failure' THEN raisedate ELSE finishdate END AS "all",
           CASE WHEN category = 'Failure' AND raisedate IS NOT NULL THEN 'Failure'
                WHEN category = 'Maintenance' AND finishdate IS NOT NULL THEN 'PM Completed'
                ELSE '' END AS type
    FROM work LEFT JOIN named ON named.operationalassetid = work.operationalassetid
    LEFT JOIN qualifying ON qualifying.operationalassetid = work.operationalassetid
    WHERE category IN ('Failure', 'Maintenance')),
listing AS (
    SELECT labelled.*, CAST(coalesce(n, 0) AS INTEGER) AS no_failures
    FROM labelled LEFT JOIN (
        SELECT operationalassetname, count(*) AS n FROM labelled WHERE type = 'Failure' GROUP BY 1
    ) failures ON failures.operationalassetname = labelled.operationalassetname)"""

SURVIVAL = """typed AS (
    SELECT w.*, operationalassetname FROM workorder w JOIN asset USING (operationalassetid)
    WHERE raisedate >= DATE '1996-01-01'),
failures AS (SELECT * FROM typed WHERE category = 'Failure'),
bounds AS (SELECT min(raisedate) AS first_day, max(raisedate) AS last_day FROM failures),
rows_at_risk AS (
    SELECT operationalassetid, 1 AS fail, raisedate AS day, workorderid AS tie FROM failures
    UNION ALL
    SELECT DISTINCT operationalassetid, 0, last_day, 9223372036854775807 FROM failures, bounds),
gaps AS (
    SELECT operationalassetid, fail, day,
           coalesce(lag(day) OVER (PARTITION BY operationalassetid ORDER BY day, fail DESC, tie),
                    first_day) AS earlier
    FROM rows_at_risk, bounds),
all_rows AS (
    SELECT * FROM gaps
    UNION ALL
    SELECT DISTINCT operationalassetid, 0, last_day, first_day FROM typed, bounds
    WHERE category = 'Maintenance'
      AND operationalassetid NOT IN (SELECT operationalassetid FROM failures)),
survival AS (
    SELECT a.operationalassetid, r.fail,
           CAST(day - make_date(year(installdate), 1, 1) AS INTEGER) AS age_days,
           CAST(day - earlier AS INTEGER) AS sincefailure_days, operationalassetname,
           (SELECT count(*) FROM typed t WHERE t.operationalassetid = r.operationalassetid
              AND t.category = 'Maintenance' AND t.finishdate <= r.day) AS cumulative_maintenance
    FROM all_rows r JOIN asset a ON a.operationalassetid = r.operationalassetid
    WHERE installdate IS NOT NULL)"""

MACHINES = """WITH machine AS (
    SELECT o_custkey AS mjid, o_orderkey AS chid, o_orderpriority AS sourcesystem,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS detail,
           o_orderdate AS startuptimestamp, CAST(month(o_orderdate) AS INTEGER) AS vehiclesubtypeid
    FROM orders WHERE o_orderpriority <> '5-LOW')"""

STAGING = f"""WITH staging AS (
    SELECT event_id, ts, user_id, event_type, value,
           CASE WHEN event_type = 'error' THEN 'D' WHEN event_type = 'click' THEN 'U'
                WHEN event_type <> 'signup' THEN 'I' END AS dboperationtype,
           {NEW_YORK} AS sourcesystemtimestamp, CAST({NEW_YORK} AS DATE) AS sourcesystemdate
    FROM events)"""


def _delta(before: str, guard: str = "true") -> str:
    return f"""{STAGING},
    target AS (SELECT * FROM staging WHERE ts < TIMESTAMP '{before}'),
    d AS (SELECT coalesce(max(sourcesystemdate), DATE '2017-07-31') AS newest
          FROM target WHERE {guard}),
    t AS (SELECT coalesce(max(ts), TIMESTAMP '2017-07-31') AS newest FROM target
          WHERE sourcesystemdate = (SELECT newest FROM d))
    SELECT DISTINCT event_id, ts, user_id, event_type, value, sourcesystemtimestamp, sourcesystemdate
    FROM staging
    WHERE dboperationtype <> 'D' AND sourcesystemdate >= (SELECT newest FROM d)
      AND ts > (SELECT newest FROM t)"""


def _single(name: str, keys: str, window: str) -> str:
    return f"SELECT pos.*, {_attached(name)} FROM pos {_left(name, keys, window)}"


def _recoded(column: str) -> str:
    return f"""CASE {column} WHEN 'small ring' THEN 'ring' WHEN 'red ring' THEN 'ring'
        WHEN 'old ring' THEN 'ring' WHEN 'small bolt' THEN 'bolt' WHEN 'red bolt' THEN 'bolt'
        WHEN 'blue gear' THEN 'gear' WHEN 'hot gear' THEN 'gear' ELSE {column} END"""


def _usage_vs_failures(value: str, fault: str) -> str:
    return f"""{PARTS},
    failed AS (
        SELECT w.operationalassetid, count(*) AS count, max(operationalassetname) AS name,
               max(v.name) AS operationalviewname
        FROM workorder w JOIN asset USING (operationalassetid)
        JOIN views v USING (operationalviewid)
        WHERE category = 'Failure' AND operationalassetname NOT LIKE '%anvil%'
          AND operationalassetname NOT LIKE '%old %' AND {fault}
        GROUP BY 1),
    used AS (
        SELECT meter.operationalassetid, sum({value}) AS sum, max(meterdescription) AS meterdescription
        FROM meter JOIN keyed USING (operationalassetid) JOIN views USING (operationalviewid)
        GROUP BY 1)
    SELECT q.operationalassetid, installdate AS year, sum, meterdescription, count, failed.name,
           operationalviewname
    FROM qualifying q JOIN used USING (operationalassetid) JOIN failed USING (operationalassetid)"""



def _flat_side(alias: str, kind: str) -> str:
    measures = "".join(f", value + {i} AS {name}" for i, name in enumerate(FLAT_SIDES[kind]))
    return f"""{alias} AS (
        SELECT user_id % 3 AS mjid, user_id % 10 AS chid, user_id % 5 AS latchtypeid,
               user_id % 25 AS vehicletypeid, ts AS rovertimestamp, ts AS sourcesystemtimestamp,
               CAST(ts AS DATE) AS sourcesystemdate{measures}
        FROM events WHERE event_type = '{kind}')"""


def _flat_file(seconds: dict[str, int], where: str = "TRUE") -> str:
    sides = {"pos": "view", "latch": "click", "fuel": "purchase", "impact": "error", "tire": "signup"}
    tires = {name: name for name in FLAT_SIDES["signup"]}
    columns = {"latch": flat.LATCH_COLUMNS, "fuel": flat.FUEL_COLUMNS, "impact": flat.IMPACT_COLUMNS, "tire": tires}
    kept = [f"pos.{name}" for name in flat.POSITION_COLUMNS if not name.endswith("typeid") and name in
            (*flat.MACHINE, "rovertimestamp", "sourcesystemtimestamp", "sourcesystemdate", *FLAT_SIDES["view"])]
    kept += [f"{side}.{source} AS {name}" for side, of in columns.items() for name, source in of.items()]
    joins = " ".join(
        f"LEFT JOIN {side} ON {side}.chid = pos.chid AND {side}.rovertimestamp <= pos.rovertimestamp"
        f" AND {side}.rovertimestamp >= pos.rovertimestamp - INTERVAL {seconds[side]} SECOND"
        + (f" AND {side}.mjid = pos.mjid" if side != "tire" else "")
        for side in columns
    )
    return f"""WITH {", ".join(_flat_side(*side) for side in sides.items())}
        SELECT {", ".join(kept)}, r_name AS spreaderstate, n_name AS vehicletype
        FROM pos JOIN region ON r_regionkey = latchtypeid JOIN nation ON n_nationkey = vehicletypeid
        {joins} WHERE {where}"""


ORACLE: dict[str, str] = {
    "flat_file": _flat_file({"latch": 1, "fuel": 301, "impact": 1, "tire": 301}),
    "flat_file_delta": _flat_file(
        {"latch": 3600, "fuel": 216000, "impact": 3600, "tire": 3600},
        "pos.rovertimestamp > (SELECT max(rovertimestamp) FROM pos"
        " WHERE sourcesystemdate < DATE '2024-01-20')",
    ),
    "enrich_positions": f"{TELEMETRY} SELECT pos.ts, {ENRICHED_COLUMNS} {ENRICHED}",
    "enrich_positions_delta": f"""{TELEMETRY} SELECT pos.ts AS rovertimestamp, {ENRICHED_COLUMNS}
        {ENRICHED}
        WHERE pos.ts > (SELECT max(ts) FROM pos WHERE ts < TIMESTAMP '2024-01-16')""",
    "interval_join_direct": f"{TELEMETRY} {_single('fuel', 'mjid', DAY)}",
    "interval_join_bucketed": f"{TELEMETRY} {_single('fuel', 'mjid', DAY)}",
    "interval_join_split_cells": f"""{TELEMETRY}
        SELECT pos.*, {_attached("fuel")}, {_attached("impact")} FROM pos
        {_left("fuel", "chid", "INTERVAL 6 HOUR")} {_left("impact", "chid", HOUR)}""",
    "interval_join_composite_key": """
        SELECT e.event_id, e.ts, e.user_id, e.event_type, r.event_id AS earlier_id,
               r.ts AS earlier_ts
        FROM events e LEFT JOIN events r
          ON e.user_id = r.user_id AND e.event_type = r.event_type
         AND r.ts <= e.ts AND r.ts >= e.ts - INTERVAL 1 DAY""",
    "incremental_delta": _delta("2024-01-20"),
    "incremental_empty_target": _delta("2000-01-01"),
    "delta_future_guard": _delta("2024-01-20", "sourcesystemdate <= DATE '2024-01-15'"),
    "scalar_watermark_join": """
        SELECT event_id, ts, event_type FROM events
        WHERE ts > (SELECT max(ts) FROM events
                    WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-15')""",
    "snapshot_dimension": """
        SELECT o_orderstatus, o_orderpriority, max(o_orderdate) AS o_orderdate
        FROM orders GROUP BY 1, 2""",
    "latest_by_maxima": """
        SELECT DISTINCT o.o_custkey, o_orderkey, o.o_orderdate, o.o_totalprice FROM orders o
        JOIN (SELECT o_custkey, max(o_orderdate) AS d, max(o_totalprice) AS p
              FROM orders GROUP BY 1) m
          ON m.o_custkey = o.o_custkey AND d = o_orderdate AND p = o_totalprice""",
    "latest_by_max_single": """
        SELECT DISTINCT o.o_custkey, o_orderkey, o.o_orderdate FROM orders o
        JOIN (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY 1) m
          ON m.o_custkey = o.o_custkey AND d = o_orderdate""",
    "argmax_with_ties": """
        SELECT p_partkey, p_brand, p_size FROM (
            SELECT *, max(p_size) OVER (PARTITION BY p_brand) AS largest FROM part)
        WHERE p_size = largest""",
    "any_value_per_key": """
        SELECT DISTINCT o_custkey,
               max(o_orderpriority) OVER (PARTITION BY o_custkey) AS o_orderpriority,
               max(o_orderstatus) OVER (PARTITION BY o_custkey) AS o_orderstatus
        FROM orders""",
    "year_month_key": """
        SELECT CASE WHEN o_orderpriority = '5-LOW' THEN '190001'
                    ELSE strftime(o_orderdate, '%Y%m') END AS yrmon, count(*) AS orders
        FROM orders GROUP BY 1""",
    "local_time_date": f"""
        SELECT CAST({NEW_YORK} AS DATE) AS local_date, count(*) AS events,
               max({NEW_YORK}) AS last_local
        FROM events GROUP BY 1""",
    "ingestion_audit": """
        SELECT 'events' AS source_name, count(*) AS ingested_row_count, max(ts) AS rovertimestamp,
               DATE '2024-02-01' AS ingestiontimestamp
        FROM events""",
    "exclude_patterns": """
        SELECT p_partkey, p_name, p_type FROM part
        WHERE p_name NOT LIKE '%anvil%' AND p_name NOT LIKE '%bolt%' AND p_name NOT LIKE '%old %'
          AND p_name NOT LIKE '%hot %' AND p_type <> 'PROMO'""",
    "null_sentinel_filter": """
        SELECT c_custkey, c_mktsegment AS segment FROM customer
        WHERE c_acctbal >= 0 AND c_acctbal <= 9000""",
    "semi_join_subset": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_custkey IN (
            SELECT DISTINCT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')""",
    "anti_join_never_failed": """
        SELECT DISTINCT o_custkey FROM orders o WHERE o_orderstatus = 'O'
          AND NOT EXISTS (SELECT 1 FROM orders f
                          WHERE f.o_custkey = o.o_custkey AND f.o_orderstatus = 'F')""",
    "fault_causes": f"""{CUSTOMERS},
        failed AS (
            SELECT w.operationalassetid, tabledescription AS causeoffaultdescription,
                   v.name AS operationalviewname, category AS worktypecategory
            FROM workorder w JOIN codes ON codes.tableid = faultid
            JOIN asset USING (operationalassetid) JOIN views v USING (operationalviewid)
            WHERE category = 'Failure' AND tabledescription <> 'NULL'
              AND v.name NOT LIKE '%77%' AND v.name NOT LIKE '%#0000013%')
        SELECT q.operationalassetid, operationalassetname AS name, causeoffaultdescription,
               operationalviewname, worktypecategory, installdate AS year, sortkeyname
        FROM failed RIGHT JOIN qualifying q ON q.operationalassetid = failed.operationalassetid""",
    "usage_vs_failures": _usage_vs_failures(
        "reading", "faultid IN (SELECT tableid FROM codes)"
    ),
    "usage_vs_failures_code_value": _usage_vs_failures("CAST(tablevalue AS DOUBLE)", "true"),
    "usage_rate": f"""{PARTS},
        totals AS (
            SELECT meter.operationalassetid, operationalassetname, operationalassetdescription,
                   metername, v.name AS operationalviewname, sum(reading) AS sumofvalue,
                   max(updatetime) AS maxdate, min(updatetime) AS mindate
            FROM meter JOIN keyed USING (operationalassetid) JOIN views v USING (operationalviewid)
            GROUP BY ALL)
        SELECT t.operationalassetid, sumofvalue, maxdate, mindate, operationalviewname,
               t.operationalassetdescription,
               CAST(datediff('day', mindate, maxdate) AS DOUBLE) AS date_diff,
               sumofvalue / nullif(datediff('day', mindate, maxdate), 0) AS ratio, metername,
               t.operationalassetname AS name, sortkeyname
        FROM totals t LEFT JOIN qualifying q ON q.operationalassetid = t.operationalassetid""",
    "pm_margin": f"{CUSTOMERS}, {MARGINS} SELECT {MARGIN_COLUMNS} FROM margins",
    "pm_margin_cleanup": f"""{CUSTOMERS}, {MARGINS} SELECT {MARGIN_COLUMNS} FROM margins
        WHERE value IS NOT NULL AND value <> 0 AND value <> 1 AND value >= 0 AND estimated < 800
          AND pm_margin_days < 800 AND estimated <> 0 AND pm_margin_days <> 0""",
    "maintenance_listing": f"""{CUSTOMERS}, {LISTING}
        SELECT operationalassetid, operationalassetname, operationalviewname, sortkeyname, "all",
               type, no_failures FROM listing""",
    "maintenance_timeline": f"""{CUSTOMERS}, {MARGINS}, {LISTING}
        SELECT listing.operationalassetid, operationalassetname, operationalviewname, sortkeyname,
               "all", type, no_failures, CAST(NULL AS BOOLEAN) AS done
        FROM listing JOIN margins USING (operationalassetid) WHERE type <> ''""",
    "pm_schedule": f"""{CUSTOMERS}, {MARGINS}
        SELECT operationalassetid, frequency, estimated, pm_margin_days,
               CAST(unnest(generate_series(CAST(mindate AS TIMESTAMP), CAST(maxdate AS TIMESTAMP),
                                           to_days(CAST(estimated AS INTEGER)))) AS DATE) AS due
        FROM margins WHERE estimated >= 1""",
    "pm_compliance": f"""{CUSTOMERS.replace("WITH", "WITH RECURSIVE", 1)}, {MARGINS},
        due_dates AS (
            SELECT operationalassetid, pm_margin_days,
                   CAST(unnest(generate_series(CAST(mindate AS TIMESTAMP),
                        CAST(maxdate AS TIMESTAMP), to_days(CAST(estimated AS INTEGER)))) AS DATE)
                       AS due
            FROM margins WHERE estimated >= 1),
        wanted AS (
            SELECT operationalassetid, due, due + CAST(pm_margin_days AS INTEGER) AS until,
                   row_number() OVER (PARTITION BY operationalassetid ORDER BY due) AS n
            FROM due_dates),
        finished AS (
            SELECT operationalassetid, finishdate,
                   row_number() OVER (PARTITION BY operationalassetid ORDER BY finishdate) AS m
            FROM workorder WHERE category = 'Maintenance' AND finishdate IS NOT NULL),
        served AS (
            SELECT operationalassetid, CAST(0 AS BIGINT) AS n, CAST(NULL AS DATE) AS due,
                   CAST(NULL AS DATE) AS until, CAST(0 AS BIGINT) AS used, false AS done
            FROM (SELECT DISTINCT operationalassetid FROM wanted)
            UNION ALL
            SELECT s.operationalassetid, w.n, w.due, w.until,
                   coalesce((SELECT min(m) FROM finished f
                             WHERE f.operationalassetid = w.operationalassetid AND m > s.used
                               AND finishdate BETWEEN w.due AND w.until), s.used),
                   EXISTS (SELECT 1 FROM finished f
                           WHERE f.operationalassetid = w.operationalassetid AND m > s.used
                             AND finishdate BETWEEN w.due AND w.until)
            FROM served s JOIN wanted w
              ON w.operationalassetid = s.operationalassetid AND w.n = s.n + 1)
        SELECT operationalassetid, due, until, done FROM served WHERE n > 0""",
    "eav_attributes": f"""{PARTS}
        SELECT operationalassetid, make, model FROM makes JOIN models USING (operationalassetid)""",
    "normalize_make": f"SELECT p_partkey, {_recoded('p_name')} AS make FROM part",
    "failures_by_make_model": f"""{PARTS},
        recoded AS (
            SELECT operationalassetid, lower(trim(make, chr(9) || ' ')) AS spelled,
                   lower(trim(model)) AS model
            FROM makes JOIN models USING (operationalassetid) WHERE make <> 'NULL'),
        listed AS (
            SELECT q.operationalassetid, operationalassetname, {_recoded("spelled")} AS make, model,
                   {_recoded("spelled")} || '-' || model AS makenmod, installdate AS year,
                   tabledescription AS causeoffaultdescription, sortkeyname
            FROM qualifying q JOIN recoded USING (operationalassetid)),
        counted AS (
            SELECT listed.*, worktypename FROM workorder JOIN listed USING (operationalassetid)
            WHERE worktypename IN ('FAIL', 'FAILold', 'SCH', 'SCHold', 'TIRES'))
        SELECT operationalassetid, operationalassetname, make, model, year, causeoffaultdescription,
               makenmod, worktypename, countofassetmakes,
               count(*) OVER (PARTITION BY make) AS countofmakesinworkorders,
               count(*) OVER (PARTITION BY makenmod) AS countofmodels, countofassetmodels, sortkeyname
        FROM counted
        LEFT JOIN (SELECT make, count(*) AS countofassetmakes FROM listed GROUP BY 1) a USING (make)
        LEFT JOIN (SELECT makenmod, count(*) AS countofassetmodels FROM listed GROUP BY 1) b
          USING (makenmod)""",
    "time_since_previous": """
        SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day,
               CAST(coalesce(lag(o_orderdate) OVER w, (SELECT min(o_orderdate) FROM orders)) AS DATE)
                   AS previous,
               CAST(datediff('day', coalesce(lag(o_orderdate) OVER w,
                    (SELECT min(o_orderdate) FROM orders)), o_orderdate) AS INTEGER) AS gap_days
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    "asof_cumulative_count": """
        SELECT e.event_id, e.user_id, e.ts, count(p.event_id) AS purchases_so_far
        FROM events e LEFT JOIN events p
          ON p.event_type = 'purchase' AND p.user_id = e.user_id AND p.ts <= e.ts
        WHERE e.event_type = 'error' GROUP BY ALL""",
    "asof_cumulative_count_by_day": f"""{CUSTOMERS}
        SELECT e.workorderid, e.operationalassetid, e.raisedate, count(p.workorderid) AS maintained
        FROM workorder e LEFT JOIN workorder p
          ON p.category = 'Maintenance' AND p.operationalassetid = e.operationalassetid
         AND p.finishdate <= e.raisedate
        WHERE e.category = 'Failure' GROUP BY ALL""",
    "survival_dataset": f"{CUSTOMERS}, {SURVIVAL} SELECT * FROM survival",
    "survival_by_make_site": f"""{CUSTOMERS}, {SURVIVAL},
        sites AS (
            SELECT operationalassetid, v.name AS operationalviewname,
                   CASE c_mktsegment WHEN 'MACHINERY' THEN 'machine' WHEN 'FURNITURE'
                        THEN 'household' ELSE lower(c_mktsegment) END AS make, sortkeyname
            FROM keyed JOIN views v USING (operationalviewid)
            JOIN customer ON c_custkey = operationalassetid
            WHERE c_nationkey <> 9 AND sortkeyname NOT IN ('NATION_3', 'NATION_7')
              AND operationalassetid IN (SELECT operationalassetid FROM workorder))
        SELECT DISTINCT fail, age_days, sincefailure_days, operationalassetname,
               cumulative_maintenance, operationalviewname, make, sortkeyname
        FROM survival JOIN sites USING (operationalassetid)""",
    "equi_join_split_keys": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag,
               CASE l_returnflag WHEN 'R' THEN 'FAIL' WHEN 'A' THEN 'SCH' ELSE 'OTHER' END AS name,
               CASE l_returnflag WHEN 'R' THEN 'Failure' WHEN 'A' THEN 'Maintenance'
                    ELSE 'Inspection' END AS category, p_name
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "tombstone_filter": f"""{STAGING}
        SELECT event_id, dboperationtype FROM staging WHERE dboperationtype <> 'D'""",
    "two_level_watermark": f"""{STAGING},
        target AS (SELECT * FROM staging WHERE ts < TIMESTAMP '2024-01-20'),
        d AS (SELECT max(sourcesystemdate) AS newest FROM target
              WHERE sourcesystemdate <= DATE '2024-01-18')
        SELECT max(ts) AS newest_time, max(newest) AS newest_date
        FROM target JOIN d ON sourcesystemdate = newest""",
    "tracker_watermark": """
        SELECT max(ts) AS rovertimestamp FROM events WHERE event_type = 'click'""",
    "fixed_date_cutoff": f"""{TELEMETRY},
        recent AS (SELECT *, CAST(ts AS DATE) AS sourcesystemdate FROM pos
                   WHERE ts >= TIMESTAMP '2024-01-16')
        SELECT recent.*, fuel.event_id AS fuel_id, fuel.ts AS fuel_ts FROM recent
        LEFT JOIN fuel ON fuel.mjid = recent.mjid AND fuel.chid = recent.chid
          AND fuel.ts <= recent.ts
          AND fuel.ts >= recent.ts - INTERVAL 1 DAY""",
    "vehicle_details": f"""{MACHINES}
        SELECT DISTINCT r.mjid, r.chid, r.sourcesystem, r.lastdetailtimestamp,
               TIMESTAMP '1900-01-01' AS lastfueltimestamp, r.vehiclesubtypeid,
               strftime(r.lastdetailtimestamp, '%Y%m') AS yrmon
        FROM (SELECT mjid, chid, sourcesystem, vehiclesubtypeid,
                     coalesce(detail, TIMESTAMP '1900-01-01') AS lastdetailtimestamp FROM machine) r
        JOIN (SELECT mjid, coalesce(max(detail), TIMESTAMP '1900-01-01') AS d,
                     max(vehiclesubtypeid) AS v FROM machine GROUP BY mjid) m
          ON m.mjid = r.mjid AND d = lastdetailtimestamp AND v = vehiclesubtypeid""",
    "rover_details": f"""{MACHINES}
        SELECT DISTINCT mjid, chid, sourcesystem, detail AS lastdetailtimestamp, startuptimestamp,
               strftime(coalesce(detail, TIMESTAMP '1900-01-01'), '%Y%m') AS yrmon,
               {_local('detail')} AS sourcesystemtimestamp
        FROM machine""",
    "rover_details_latest": f"""{MACHINES}
        SELECT DISTINCT r.mjid, chid, sourcesystem, detail AS lastdetailtimestamp, startuptimestamp,
               strftime(detail, '%Y%m') AS yrmon, {_local('detail')} AS sourcesystemtimestamp
        FROM machine r
        JOIN (SELECT mjid, max(detail) AS d, max(startuptimestamp) AS s
              FROM machine GROUP BY mjid) m
          ON m.mjid = r.mjid AND d = detail AND s = startuptimestamp""",
    "dimension_required": """
        SELECT o_orderpriority AS maptypeid, o_orderstatus, max(o_orderdate) AS o_orderdate
        FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority IS NOT NULL GROUP BY 1, 2""",
    "union_missing_columns": """
        SELECT event_id, ts AS raised, CAST(NULL AS TIMESTAMP) AS finished,
               CAST(NULL AS DOUBLE) AS value FROM events WHERE event_type = 'error'
        UNION ALL
        SELECT event_id, NULL, ts, value FROM events WHERE event_type = 'purchase'""",
    "date_parse_strict": """
        SELECT o_orderkey,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS day
        FROM orders""",
}
