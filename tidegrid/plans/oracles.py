"""The same results as plain SQL over the given tables, for checking the queries."""

from __future__ import annotations

from tidegrid.plans.blake3_sql import blake3_ctes

VALUES = ("sst", "anom", "err", "ice")
KEY = "time, zlev, lat_idx, lon_idx"


def grid_sql(step: str = "day", n_lat: int = 720, n_lon: int = 1440, levels: int = 1, further: bool = False) -> str:
    counted = ", max(l_returnflag) AS flag, CAST(count(*) AS INTEGER) AS items" if further else ""
    more = ", flag, items" if further else ""
    lat_step, lon_step = 180.0 / n_lat, 360.0 / n_lon
    return f"""
    binned AS (
        SELECT date_trunc('{step}', l_shipdate)::TIMESTAMP + INTERVAL 12 HOUR AS time,
               CAST(1 + l_linenumber % {levels} AS INTEGER) AS zlev,
               CAST(l_suppkey % {n_lat} AS INTEGER) AS lat_idx,
               CAST(l_partkey % {n_lon} AS INTEGER) AS lon_idx,
               CAST(max(l_quantity) AS FLOAT) AS sst, CAST(min(l_extendedprice) AS FLOAT) AS anom,
               CAST(min(l_discount) AS FLOAT) AS err, CAST(max(l_tax) AS FLOAT) AS ice{counted}
        FROM lineitem GROUP BY 1, 2, 3, 4
    ),
    grid AS (
        SELECT CAST(time AS DATE) AS day, time, zlev, lat_idx, lon_idx,
               CAST({-90 + lat_step / 2} AS DOUBLE) + CAST({lat_step} AS DOUBLE) * lat_idx AS lat,
               CAST({lon_step / 2} AS DOUBLE) + CAST({lon_step} AS DOUBLE) * lon_idx AS lon,
               CASE WHEN (lat_idx + lon_idx) % 5 <> 0 THEN CAST(sst AS DOUBLE) END AS sst,
               CASE WHEN (lat_idx + lon_idx) % 5 <> 0 THEN CAST(anom AS DOUBLE) END AS anom,
               CASE WHEN (lat_idx + lon_idx) % 5 <> 0 THEN CAST(err AS DOUBLE) END AS err,
               CASE WHEN ice > CAST(0.04 AS FLOAT) THEN CAST(ice AS DOUBLE) END AS ice{more}
        FROM binned
    )"""


DAILY, MONTHLY = grid_sql(), grid_sql("month")
FURTHER, FURTHER_MONTHLY = grid_sql(further=True), grid_sql("month", further=True)
COARSE, COARSE_MONTHLY = grid_sql(n_lat=12, n_lon=16), grid_sql("month", 12, 16)


def from_grid(select: str, grid: str = DAILY) -> str:
    return f"WITH {grid} {select}"


DAY_TEXT = "strftime(day, '%Y-%m-%d')"
ALL_VALUES = f"SELECT {KEY}, sst, anom, err, ice FROM grid"

LISTING = """
    listing AS (
        SELECT 'grids/obj-' || event_id || CASE WHEN event_type = 'click' THEN '.txt' ELSE '.nc' END AS key,
               ts AS last_modified, event_type <> 'error' AS ok
        FROM events
    )"""
KEPT = "last_modified >= TIMESTAMP '2024-01-15' AND key LIKE '%.nc'"

RECORDS = """
    records AS (
        SELECT event_id, ts AS event_time, user_id AS size, props AS etag,
               CASE WHEN event_id % 7 = 0 THEN 'ObjectRemoved:Delete' ELSE 'ObjectCreated:Put' END AS event_name,
               'bucket-' || event_type AS bucket, 'in/e.' || event_id || suffix AS key,
               's3://bucket-' || event_type || '/in/e.' || event_id || suffix AS uri
        FROM events CROSS JOIN (VALUES ('.nc'), ('.txt')) AS s(suffix)
    )"""

NAMES = """
    named AS (
        SELECT doc_id,
               CASE WHEN doc_id % 11 = 0 THEN 'sample.nc'
                    ELSE 'data/' || lang || '/grid-v02.2025' || lpad(CAST((doc_id % 400) % 13 + 1 AS VARCHAR), 2, '0')
                         || lpad(CAST((doc_id % 400) % 28 + 1 AS VARCHAR), 2, '0')
                         || CASE WHEN doc_id % 3 = 0 THEN '_preliminary' ELSE '' END || '.nc' END AS path
        FROM documents
    )"""


def fingerprint(*columns: str) -> str:
    """SHA-256 over whole ten-thousandths."""
    parts = ", ".join(f"CAST(CAST(round({c} * 10000) AS BIGINT) AS VARCHAR)" for c in columns)
    return f"sha256(concat_ws('|', {parts}))"


def filled(column: str) -> str:
    return f"coalesce({column}, -999.0)"


CELL_HASH = fingerprint("lat", "lon", *[filled(c) for c in ("sst", "err", "ice", "anom")])


MEASURED = ("lat", "lon", *[filled(c) for c in ("sst", "err", "ice", "anom")])


def blake3_of(source: str = "grid", keep: str = KEY, name: str = "hashed") -> str:
    return blake3_ctes(source, MEASURED, keep, name)


def drawn(count: int, seed: int) -> str:
    """The position of the cell of each draw: the smallest of 60 bits of MD5."""
    text = f"concat_ws('|', strftime(time, '%Y-%m-%d %H:%M:%S'), zlev, lat_idx, lon_idx, {seed}, draw)"
    return f"""drawn AS (
        SELECT time, CAST(draw AS INTEGER) AS draw, row_number() OVER (PARTITION BY time, draw ORDER BY CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT), zlev, lat_idx, lon_idx) AS place,
            zlev, lat_idx, lon_idx, lat, lon, sst, anom, err, ice
        FROM grid CROSS JOIN range(1, {count + 1}) AS r(draw) QUALIFY place = 1)"""


def cents(value: str) -> str:
    """Two decimals as text from whole hundredths."""
    hundredths = f"CAST(round({value} * 100) AS BIGINT)"
    return (
        f"CAST({hundredths} // 100 AS VARCHAR) || '.' || "
        f"lpad(CAST({hundredths} % 100 AS VARCHAR), 2, '0')"
    )


DAILY_MEANS = "daily AS (SELECT time, min(sst) AS daily_min, max(sst) AS daily_max, avg(sst) AS daily_mean, count(sst) AS valid_cells FROM grid GROUP BY time)"

CHANGED = """
    source AS (SELECT * FROM grid WHERE year(time) <> 2000),
    store AS (
        SELECT * EXCLUDE (sst), CASE WHEN year(time) = 1999 AND err > CAST(0.05 AS DOUBLE) THEN sst + 1 ELSE sst END AS sst
        FROM grid WHERE year(time) <> 1996
    )"""

AXES = """
    axes AS (
        SELECT 'time' AS axis, count(DISTINCT time) AS n FROM grid UNION ALL
        SELECT 'zlev', count(DISTINCT zlev) FROM grid UNION ALL
        SELECT 'lat', count(DISTINCT lat) FROM grid UNION ALL
        SELECT 'lon', count(DISTINCT lon) FROM grid
    )"""
VARIABLES = "(VALUES ('sst'), ('anom'), ('err'), ('ice')) AS v(variable)"
CHUNK = "CASE WHEN axis = 'time' THEN 1 ELSE least(5120, n) END"


def _layout() -> str:
    # Names and settings of the layout document.
    one = (
        "'{\"chunks\":{\"time\":1,\"zlev\":' || least(5120, max(n) FILTER (axis = 'zlev')) || ',\"lat\":' || "
        "least(5120, max(n) FILTER (axis = 'lat')) || ',\"lon\":' || least(5120, max(n) FILTER (axis = 'lon')) || '}}'"
    )
    variables = " || ',' || ".join(f"'\"{v}\":' || one" for v in VALUES)
    return from_grid(
        f""", {AXES}, per AS (SELECT {one} AS one FROM axes)
        SELECT '{{"dataset":"custom","description":"Custom dataset",'
            || '"compressor":{{"id":"blosc","cname":"lz4","clevel":5,"shuffle":2}},'
            || '"conversion":{{"variables":{{' || {variables} || '}}}}}}' AS layout
        FROM per"""
    )


# Whether all variables of a grid are floating, for one without and one with variables of other types.
SCHEMAS = f"""{FURTHER},
    kinds AS (SELECT typeof(any_value(sst)) AS a, typeof(any_value(anom)) AS b, typeof(any_value(err)) AS c,
                     typeof(any_value(ice)) AS d, typeof(any_value(flag)) AS e, typeof(any_value(items)) AS f FROM grid),
    listed AS (SELECT 'plain' AS grid, unnest([a, b, c, d]) AS kind FROM kinds
               UNION ALL SELECT 'further', unnest([a, b, c, d, e, f]) FROM kinds),
    floating AS (SELECT grid, bool_and(kind IN ('FLOAT', 'DOUBLE')) AS all_floating FROM listed GROUP BY grid)"""

EVERY_FILE = "SELECT DISTINCT time AS file_time FROM grid"

ORACLES = {
    "discover_since": f"WITH {LISTING} SELECT key, last_modified FROM listing WHERE {KEPT}",
    "read_mark": f"""WITH {LISTING}
        SELECT coalesce(max(last_modified), TIMESTAMP '2024-01-10') AS mark FROM listing WHERE NOT ok""",
    "advance_mark": f"""WITH {LISTING}
        SELECT greatest(TIMESTAMP '2024-01-15 18:00:00',
                        least(max(last_modified), min(last_modified) FILTER (NOT ok))) AS mark
        FROM listing WHERE {KEPT}""",
    "parse_object_events": f"""WITH {RECORDS}
        SELECT event_id, event_name, event_time, bucket, key, size, etag, uri FROM records""",
    "filter_object_events": f"""WITH {RECORDS}
        SELECT event_id, uri, event_name FROM records WHERE event_name LIKE 'ObjectCreated:%' AND key LIKE '%.nc'""",
    "ingest_files": from_grid(ALL_VALUES, MONTHLY),
    "read_store": from_grid(f"SELECT {KEY}, {DAY_TEXT} AS day, sst, anom, err, ice FROM grid", MONTHLY),
    "select_existing_files": """
        SELECT 'docs/d.' || doc_id || '.nc' AS key, doc_id IN (SELECT doc_id FROM labels) AS found FROM documents""",
    "write_create": from_grid(f"SELECT {DAY_TEXT} AS day, count(*) AS cells, sum(sst) AS sum_sst FROM grid GROUP BY 1", MONTHLY),
    "write_append": from_grid(ALL_VALUES, MONTHLY),
    "write_upsert": from_grid(
        f"SELECT {KEY}, CASE WHEN year(time) = 1998 THEN sst + 100 ELSE sst END AS sst, anom, err, ice FROM grid",
        MONTHLY,
    ),
    "write_overwrite": from_grid(f"{ALL_VALUES} WHERE year(time) >= 1998", MONTHLY),
    "store_summary": from_grid(
        f"""SELECT {DAY_TEXT} AS day, count(*) AS cells, count(sst) AS valid_cells,
            min(lat_idx) AS first_lat_idx, max(lat_idx) AS last_lat_idx,
            min(lon_idx) AS first_lon_idx, max(lon_idx) AS last_lon_idx,
            min(sst) AS min_value, max(sst) AS max_value,
            CAST(sum(CAST('0x' || substr({CELL_HASH}, 1, 15) AS BIGINT)) AS VARCHAR) AS checksum
            FROM grid GROUP BY 1""",
        MONTHLY,
    ),
    "catalogue_has_time": from_grid(
        """SELECT DISTINCT CAST(o_orderdate AS DATE)::TIMESTAMP + INTERVAL 12 HOUR AS time FROM orders
           WHERE CAST(o_orderdate AS DATE)::TIMESTAMP + INTERVAL 12 HOUR IN (SELECT time FROM grid)""",
        MONTHLY,
    ),
    "ingest_all_variables": from_grid(f"SELECT {KEY}, sst, flag, CAST(items AS BIGINT) AS items, time AS source_time FROM grid", FURTHER_MONTHLY),
    "poll_convert": from_grid(
        """SELECT time AS file_time, CASE WHEN month(time) = 12 THEN 2 ELSE 1 END AS attempts,
            CASE WHEN month(time) = 12 THEN 'failed' ELSE 'done' END AS state,
            CAST(CASE WHEN month(time) = 12 THEN 2 ELSE 1 END AS BIGINT) AS polls,
            CASE WHEN month(time) <> 12 THEN count(*) END AS cells, CASE WHEN month(time) <> 12 THEN sum(sst) END AS sum_sst
            FROM grid GROUP BY time""",
        MONTHLY,
    ),
    "merge_versions": from_grid(
        f"""SELECT {KEY}, sst + CASE WHEN lat_idx % 3 = 0 THEN 2 WHEN lat_idx % 2 = 0 OR lat_idx % 5 > 0 THEN 1 ELSE 0 END AS sst,
            CASE WHEN lat_idx % 3 = 0 THEN 2 WHEN lat_idx % 2 = 0 OR lat_idx % 5 > 0 THEN 1 ELSE 0 END AS version
            FROM grid WHERE lat_idx % 3 = 0 OR lat_idx % 2 = 0 OR lat_idx % 5 > 0 OR lat_idx % 7 = 0""",
        MONTHLY,
    ),
    "write_profile": _layout(),
    "ingest_with_status": from_grid(
        """SELECT time AS file_time, CASE WHEN month(time) = 12 THEN 'failed' ELSE 'ok' END AS status,
            CASE WHEN month(time) = 12 THEN 'ValueError: unreadable' END AS error,
            CASE WHEN month(time) = 12 THEN 0 ELSE count(*) END AS cells,
            CASE WHEN month(time) = 12 THEN 0 ELSE count(*) END AS rows_written
            FROM grid GROUP BY time""",
        MONTHLY,
    ),
    "ensure_zlev": from_grid(f"SELECT {KEY}, sst FROM grid"),
    "select_first_level": from_grid(
        f"""SELECT {KEY}, sst FROM grid
            WHERE (time, zlev) IN (SELECT (time, min(zlev)) FROM grid GROUP BY time)""",
        grid_sql(levels=2),
    ),
    "select_time": from_grid(
        f"{ALL_VALUES} WHERE time IN (TIMESTAMP '1998-06-15 12:00:00', TIMESTAMP '1999-01-01 12:00:00')"
    ),
    "select_first_time": from_grid(f"{ALL_VALUES} WHERE time = (SELECT min(time) FROM grid)", MONTHLY),
    "point_by_index": from_grid(
        f"""SELECT {KEY}, s_name AS name, lat, lon, sst FROM grid JOIN supplier
            ON lat_idx = s_suppkey % 720 AND lon_idx = s_nationkey AND s_nationkey <= 20"""
    ),
    "point_by_label": from_grid(
        f"""SELECT {KEY}, s_name AS name, sst FROM grid JOIN supplier
            ON lat_idx = s_suppkey % 720 AND lon_idx = s_nationkey"""
    ),
    "select_variables": from_grid(f"SELECT {KEY}, lat, lon, sst FROM grid"),
    "mask_missing": from_grid(ALL_VALUES),
    "fill_sentinel": from_grid(
        f"SELECT {KEY}, " + ", ".join(f"{filled(v)} AS {v}" for v in VALUES) + " FROM grid"
    ),
    "all_floating": f"WITH {SCHEMAS} SELECT grid, all_floating FROM floating",
    "squeeze": from_grid("SELECT time, lat_idx, lon_idx, lat, lon, sst FROM grid"),
    "build_grid": from_grid(
        """, lats AS (SELECT lat, row_number() OVER (ORDER BY lat) - 1 AS lat_idx FROM (SELECT DISTINCT lat FROM grid) AS a),
             lons AS (SELECT lon, row_number() OVER (ORDER BY lon) - 1 AS lon_idx FROM (SELECT DISTINCT lon FROM grid) AS b)
        SELECT lat_idx, lon_idx, lat, lon FROM lats CROSS JOIN lons"""
    ),
    "expand_time": from_grid(
        """, lats AS (SELECT lat, row_number() OVER (ORDER BY lat) - 1 AS lat_idx FROM (SELECT DISTINCT lat FROM grid) AS a),
             lons AS (SELECT lon, row_number() OVER (ORDER BY lon) - 1 AS lon_idx FROM (SELECT DISTINCT lon FROM grid) AS b),
             steps AS (SELECT DISTINCT time FROM grid)
        SELECT time, lat_idx, lon_idx, lat, lon FROM lats CROSS JOIN lons CROSS JOIN steps""",
        COARSE,
    ),
    "has_time": from_grid(
        """SELECT DISTINCT CAST(o_orderdate AS DATE)::TIMESTAMP + INTERVAL 12 HOUR AS time FROM orders
           WHERE CAST(o_orderdate AS DATE)::TIMESTAMP + INTERVAL 12 HOUR IN (SELECT time FROM grid)"""
    ),
    "drop_time": from_grid(
        f"""SELECT {KEY}, sst FROM grid WHERE time NOT IN (
            SELECT CAST(o_orderdate AS DATE)::TIMESTAMP + INTERVAL 12 HOUR FROM orders WHERE year(o_orderdate) = 1997)"""
    ),
    "align_variables": from_grid(ALL_VALUES),
    "attach_variable": from_grid(f"SELECT {KEY}, sst, CASE WHEN sst > 25 THEN sst - 25 END AS excess FROM grid"),
    "lookup_config": f"""WITH {RECORDS}, configs AS (
            SELECT 'bucket-' || (['click', 'view', 'purchase', 'error', 'none'])[r_regionkey + 1] AS bucket, r_name AS dataset
            FROM region)
        SELECT uri, bucket, dataset FROM records LEFT JOIN configs USING (bucket)""",
    "reconcile_stats": from_grid(
        f""", {CHANGED},
        a AS (SELECT time, min(sst) AS lo, max(sst) AS hi, avg(sst) AS mean FROM source GROUP BY time),
        b AS (SELECT time, min(sst) AS lo, max(sst) AS hi, avg(sst) AS mean FROM store GROUP BY time)
        SELECT coalesce(a.time, b.time) AS time,
            CASE WHEN b.time IS NULL THEN 'missing_in_store' WHEN a.time IS NULL THEN 'missing_in_source'
                 WHEN coalesce(abs(a.lo - b.lo) <= 1e-6, a.lo IS NULL AND b.lo IS NULL)
                  AND coalesce(abs(a.hi - b.hi) <= 1e-6, a.hi IS NULL AND b.hi IS NULL)
                  AND coalesce(abs(a.mean - b.mean) <= 1e-6, a.mean IS NULL AND b.mean IS NULL) THEN 'match'
                 ELSE 'differs' END AS status,
            a.lo AS source_daily_min, b.lo AS store_daily_min, a.hi AS source_daily_max, b.hi AS store_daily_max
        FROM a FULL OUTER JOIN b ON a.time = b.time"""
    ),
    "verify_fingerprints": from_grid(
        f""", {CHANGED},
        a AS (SELECT {KEY}, {CELL_HASH} AS h FROM source), b AS (SELECT {KEY}, {CELL_HASH} AS h FROM store)
        SELECT {KEY}, CASE WHEN b.h IS NULL THEN 'missing' WHEN a.h IS NULL THEN 'extra' ELSE 'changed' END AS status
        FROM a FULL OUTER JOIN b USING ({KEY}) WHERE a.h IS DISTINCT FROM b.h"""
    ),
    "compare_by_tiles": from_grid(
        """, source AS (SELECT * FROM grid WHERE NOT (year(time) = 1996 AND lon_idx = 9)),
        store AS (SELECT * EXCLUDE (sst), CASE WHEN lat_idx < 30 AND month(time) = 5 THEN sst + 1 ELSE sst END AS sst
                  FROM grid WHERE NOT (year(time) = 1995 AND lon_idx = 7))
        SELECT time, zlev, lat_idx, lon_idx, CASE WHEN b.lat IS NULL THEN 'missing' WHEN a.lat IS NULL THEN 'extra' ELSE 'changed' END AS status
        FROM source a FULL OUTER JOIN store b USING (time, zlev, lat_idx, lon_idx)
        WHERE a.lat IS NULL OR b.lat IS NULL OR a.sst IS DISTINCT FROM b.sst"""
    ),
    "tile_digests": from_grid(
        f"""SELECT {DAY_TEXT} AS day, CAST(lat_idx // 72 AS INTEGER) AS tile_i, CAST(lon_idx // 144 AS INTEGER) AS tile_j, count(*) AS cells
            FROM grid GROUP BY 1, 2, 3"""
    ),
    "add_fingerprints": from_grid(f", {blake3_of()} SELECT {KEY}, digest AS spatial_hash FROM hashed"),
    "sample_cells": from_grid(
        f""", {drawn(5, 0)}, {blake3_of("drawn", "time, draw, lat, lon, sst")}
        SELECT time, draw, lat, lon, sst, digest AS spatial_hash FROM hashed"""
    ),
    "sample_verifiers": from_grid(f", {drawn(5, 1)} SELECT time, draw, lat, lon, ',,,,,,,,,' AS verifier_pubkeys FROM drawn"),
    "daily_stats": from_grid(f", {DAILY_MEANS} SELECT * FROM daily"),
    "dataset_overview": from_grid(
        """SELECT min(time) AS first_time, max(time) AS last_time, count(DISTINCT time) AS time_steps,
            count(DISTINCT lat) AS n_lat, count(DISTINCT lon) AS n_lon FROM grid"""
    ),
    "array_shapes": from_grid(f", {AXES} SELECT axis, n AS length FROM axes"),
    "discovery_counts": f"""WITH {LISTING}
        SELECT count(*) AS objects, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS pages,
               count(*) FILTER ({KEPT}) AS new_files FROM listing""",
    "ingest_metrics": from_grid("SELECT count(*) AS cells, count(sst) AS valid_cells FROM grid"),
    "max_modified": "SELECT max(ts) AS max_modified FROM events",
    "running_mean": from_grid(
        f""", {DAILY_MEANS}
        SELECT time, row_number() OVER (ORDER BY time) AS day_number, round(daily_mean, 6) AS daily_mean,
            round(avg(daily_mean) OVER (ORDER BY time ROWS UNBOUNDED PRECEDING), 6) AS running_mean FROM daily"""
    ),
    "day_number": from_grid("SELECT time, row_number() OVER (ORDER BY time) AS day_number FROM (SELECT DISTINCT time FROM grid) AS t"),
    "running_components": from_grid(
        f""", {DAILY_MEANS},
        numbered AS (SELECT time, daily_mean, row_number() OVER (ORDER BY time) AS day_number FROM daily),
        listed AS (
            SELECT time, day_number,
                list('Day ' || day_number || ': ' || {cents('daily_mean')} || '°C')
                    OVER (ORDER BY time ROWS UNBOUNDED PRECEDING) AS terms,
                avg(daily_mean) OVER (ORDER BY time ROWS UNBOUNDED PRECEDING) AS mean
            FROM numbered)
        SELECT time, day_number, array_to_string(terms, ' + ') || ' = ' || {cents('mean')} || '°C' AS components
        FROM listed""",
        MONTHLY,
    ),
    "running_terms": from_grid(
        f""", {DAILY_MEANS},
        numbered AS (SELECT time, daily_mean, row_number() OVER (ORDER BY time) AS day_number,
                            avg(daily_mean) OVER (ORDER BY time ROWS UNBOUNDED PRECEDING) AS mean FROM daily)
        SELECT time, day_number, 'Day ' || day_number || ': ' || coalesce({cents('daily_mean')}, 'nan') || '°C' AS term,
            coalesce({cents('mean')}, 'nan') || '°C' AS total FROM numbered"""
    ),
    "components_of_days": from_grid(
        f""", {DAILY_MEANS},
        numbered AS (SELECT time, daily_mean, row_number() OVER (ORDER BY time) AS day_number,
                            avg(daily_mean) OVER (ORDER BY time ROWS UNBOUNDED PRECEDING) AS mean FROM daily),
        terms AS (SELECT *, 'Day ' || day_number || ': ' || coalesce({cents('daily_mean')}, 'nan') || '°C' AS term FROM numbered),
        wanted AS (SELECT min(time) AS time FROM daily GROUP BY date_trunc('quarter', time)),
        texts AS (
            SELECT w.time, max(t.day_number) AS day_number, string_agg(t.term, ' + ' ORDER BY t.time) AS listed
            FROM wanted w JOIN terms t ON t.time <= w.time GROUP BY w.time),
        shown AS (SELECT texts.time, texts.day_number, listed || ' = ' || coalesce({cents('mean')}, 'nan') || '°C' AS components
                  FROM texts JOIN numbered USING (time))
        SELECT time, day_number, CAST(length(components) AS INTEGER) AS chars, sha256(components) AS sha256 FROM shown"""
    ),
    "sort_by_time": from_grid(f"SELECT {KEY}, sst FROM grid"),
    "first_last_time": from_grid("SELECT max(time) AS first_time, min(time) AS last_time FROM grid"),
    "concat_time": from_grid(
        f"""SELECT {KEY}, sst, anom, err, ice FROM grid WHERE year(time) <= 1998
            UNION ALL SELECT {KEY}, sst, anom, err, NULL FROM grid WHERE year(time) >= 1998"""
    ),
    "upsert_logical": from_grid(
        f""", batch AS (SELECT {KEY}, sst + 100 AS sst FROM grid WHERE year(time) = 1998 AND sst > 25)
        SELECT {KEY}, sst FROM grid WHERE time NOT IN (SELECT time FROM batch)
        UNION ALL SELECT {KEY}, sst FROM batch"""
    ),
    "recenter_longitude": from_grid(
        """SELECT time, zlev, lat_idx, CAST((lon_idx + 720) % 1440 AS INTEGER) AS lon_idx,
            CASE WHEN lon >= 180 THEN lon - 360 ELSE lon END AS lon, sst FROM grid"""
    ),
    "file_date": f"""WITH {NAMES}
        SELECT path, doc_id,
            try_strptime(nullif(regexp_extract(replace(split_part(path, '/', -1), '_preliminary', ''), '\\.(\\d{{8}})\\.', 1), ''), '%Y%m%d') AS file_date,
            try_strptime(nullif(regexp_extract(split_part(path, '/', -1), '\\.(\\d{{8}})\\.', 1), ''), '%Y%m%d') AS plain_date
        FROM named""",
    "strip_suffix": f"WITH {NAMES} SELECT doc_id, replace(split_part(path, '/', -1), '_preliminary', '') AS name FROM named",
    "noon_of": "SELECT o_orderkey, CAST(o_orderdate AS DATE)::TIMESTAMP + INTERVAL 12 HOUR AS noon FROM orders",
    "dotted_date": f"""WITH {NAMES}
        SELECT doc_id, split_part(path, '.', -2) AS dotted FROM named""",
    "to_utc": """
        WITH written AS (
            SELECT event_id, ts,
                strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || (['', 'Z', '+02:00'])[event_id % 3 + 1] AS written FROM events),
        instants AS (
            SELECT event_id, written, CASE WHEN event_id % 3 = 2 THEN ts - INTERVAL 2 HOUR ELSE ts END AS instant FROM written)
        SELECT event_id, written, instant,
            strftime(instant, '%Y-%m-%dT%H:%M:%S')
                || CASE WHEN microsecond(instant) % 1000000 = 0 THEN '' ELSE strftime(instant, '.%f') END
                || '+00:00' AS iso
        FROM instants""",
    "date_part": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events",
    "format_day": "SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events",
    "object_uri": """
        WITH parts AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS rest FROM pages)
        SELECT page_id, CASE WHEN instr(rest, '/') > 0 THEN substr(rest, 1, instr(rest, '/') - 1) ELSE rest END AS bucket,
            CASE WHEN instr(rest, '/') > 0 THEN substr(rest, instr(rest, '/') + 1) END AS key,
            CASE WHEN instr(rest, '/') > 0 THEN 's3://' || rest END AS uri
        FROM parts""",
    "cell_fingerprint": from_grid(f"SELECT {KEY}, {CELL_HASH} AS spatial_hash FROM grid"),
    "fingerprint_fallback": f"""
        WITH raw AS (
            SELECT l_orderkey, l_linenumber, l_partkey, 0.25 * (l_suppkey % 720) AS lat, 0.25 * (l_partkey % 1440) AS lon,
                l_linenumber IN (1, 3) AS bad, l_quantity AS sst,
                CASE WHEN l_linenumber <> 2 THEN l_discount END AS err, l_tax AS ice, CAST(1.5 AS DOUBLE) AS anom
            FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey,
            CASE WHEN bad THEN {fingerprint('lat', 'lon', '-999.0', '-999.0', '-999.0', '-999.0')}
                 ELSE {CELL_HASH} END AS spatial_hash
        FROM raw""",
    "empty_verifiers": from_grid(f"SELECT {KEY}, ',,,,,,,,,' AS verifier_pubkeys FROM grid"),
    "append_verifier": from_grid(
        f""", firsts AS (
            SELECT date_trunc('month', l_shipdate)::TIMESTAMP + INTERVAL 12 HOUR AS time,
                CAST(l_suppkey % 12 AS INTEGER) AS lat_idx, CAST(l_partkey % 16 AS INTEGER) AS lon_idx,
                'key-' || (l_orderkey % 50) AS pubkey, min(l_orderkey) AS seq
            FROM lineitem GROUP BY 1, 2, 3, 4),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY time, lat_idx, lon_idx ORDER BY seq, pubkey) AS rank FROM firsts),
        lists AS (
            SELECT time, lat_idx, lon_idx, list(pubkey ORDER BY rank) AS keys FROM ranked WHERE rank <= 10 GROUP BY 1, 2, 3)
        SELECT {KEY}, array_to_string(keys, ',') || repeat(',', 10 - len(keys)) AS verifier_pubkeys
        FROM grid JOIN lists USING (time, lat_idx, lon_idx)""",
        COARSE_MONTHLY,
    ),
    "append_verifier_to_store": from_grid(
        f""", firsts AS (
            SELECT date_trunc('month', l_shipdate)::TIMESTAMP + INTERVAL 12 HOUR AS time,
                CAST(l_suppkey % 12 AS INTEGER) AS lat_idx, CAST(l_partkey % 16 AS INTEGER) AS lon_idx,
                'key-' || (l_orderkey % 50) AS pubkey, min(l_orderkey) AS seq
            FROM lineitem WHERE year(l_shipdate) = 1996 GROUP BY 1, 2, 3, 4),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY time, lat_idx, lon_idx ORDER BY seq, pubkey) AS rank FROM firsts),
        lists AS (
            SELECT time, lat_idx, lon_idx, list(pubkey ORDER BY rank) AS keys FROM ranked WHERE rank <= 10 GROUP BY 1, 2, 3)
        SELECT {KEY}, coalesce(array_to_string(keys, ',') || repeat(',', 10 - len(keys)), ',,,,,,,,,') AS verifier_pubkeys
        FROM grid LEFT JOIN lists USING (time, lat_idx, lon_idx)""",
        COARSE_MONTHLY,
    ),
    "format_stat": from_grid(
        f""", {DAILY_MEANS}, texts AS (
            SELECT time, coalesce({cents('daily_mean')}, 'nan') AS m, coalesce({cents('daily_max')}, 'nan') || '°C' AS x FROM daily)
        SELECT time, repeat(' ', greatest(10 - length(m), 0)) || m AS shown,
            repeat(' ', greatest(10 - length(x), 0)) || x AS shown_max FROM texts"""
    ),
    "json_text": """
        SELECT '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S')
            || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END
            || '+00:00","event_type":"' || event_type || '"}' AS json FROM events""",
    "tile_ids": from_grid(
        f"""SELECT {KEY}, CAST(lat_idx // 180 AS INTEGER) AS sst_i, CAST(lon_idx // 360 AS INTEGER) AS sst_j,
            0 AS anom_i, 0 AS anom_j, CAST(lat_idx // 72 AS INTEGER) AS tile_i, CAST(lon_idx // 144 AS INTEGER) AS tile_j
            FROM grid"""
    ),
    "pack_tiles": from_grid(
        """, slots AS (
            SELECT time, zlev, lat_idx // 6 AS tile_i, lon_idx // 8 AS tile_j, (lat_idx % 6) * 8 + lon_idx % 8 AS pos, sst
            FROM grid),
        present AS (SELECT DISTINCT time, zlev, tile_i, tile_j FROM slots),
        every AS (SELECT * FROM present CROSS JOIN range(48) AS r(pos))
        SELECT time, zlev, CAST(tile_i AS INTEGER) AS tile_i, CAST(tile_j AS INTEGER) AS tile_j,
            string_agg(coalesce(CAST(CAST(sst AS INTEGER) AS VARCHAR), '-'), ',' ORDER BY pos) AS "values"
        FROM every LEFT JOIN slots USING (time, zlev, tile_i, tile_j, pos) GROUP BY ALL""",
        COARSE,
    ),
    "convert_tiles": from_grid(
        """, ends AS (SELECT max(lat_idx) + 1 AS n_lat, max(lon_idx) + 1 AS n_lon FROM grid),
        sizes AS (SELECT v.variable, CAST(coalesce(la, n_lat) AS INTEGER) AS lat_size, CAST(coalesce(lo, n_lon) AS INTEGER) AS lon_size
                  FROM (VALUES ('sst', 6, 8), ('anom', 4, NULL), ('err', NULL, NULL), ('ice', NULL, NULL)) AS v(variable, la, lo) CROSS JOIN ends),
        cells AS (SELECT 'sst' AS variable, time, zlev, lat_idx, lon_idx, sst AS value FROM grid
                  UNION ALL SELECT 'anom', time, zlev, lat_idx, lon_idx, anom FROM grid
                  UNION ALL SELECT 'err', time, zlev, lat_idx, lon_idx, err FROM grid
                  UNION ALL SELECT 'ice', time, zlev, lat_idx, lon_idx, ice FROM grid),
        slots AS (SELECT variable, time, zlev, CAST(lat_idx // lat_size AS INTEGER) AS tile_i, CAST(lon_idx // lon_size AS INTEGER) AS tile_j,
                         lat_size, lon_size, (lat_idx % lat_size) * lon_size + lon_idx % lon_size AS pos, value
                  FROM cells JOIN sizes USING (variable)),
        present AS (SELECT DISTINCT variable, time, zlev, tile_i, tile_j, lat_size, lon_size FROM slots),
        every AS (SELECT *, unnest(range(lat_size * lon_size)) AS pos FROM present)
        SELECT variable, time, zlev, tile_i, tile_j, lat_size, lon_size,
            string_agg(coalesce(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY pos) AS "values"
        FROM every LEFT JOIN slots USING (variable, time, zlev, tile_i, tile_j, lat_size, lon_size, pos) GROUP BY ALL""",
        COARSE_MONTHLY,
    ),
    "unpack_tiles": from_grid(f"SELECT {KEY}, sst FROM grid WHERE sst IS NOT NULL", COARSE),
    "suggest_chunks": from_grid(f", {AXES} SELECT variable, axis, 4 AS itemsize, {CHUNK} AS chunk FROM axes CROSS JOIN {VARIABLES}"),
    "profile_dataset": from_grid(
        f", {AXES} SELECT variable, axis, n AS axis_size, 'float' AS dtype, 4 AS itemsize FROM axes CROSS JOIN {VARIABLES}"
    ),
    "suggest_codec": f"""WITH {SCHEMAS}
        SELECT grid, CASE WHEN all_floating THEN 'blosc' END AS id, CASE WHEN all_floating THEN 'lz4' END AS cname,
            CASE WHEN all_floating THEN 5 END AS clevel, CASE WHEN all_floating THEN 2 END AS shuffle,
            CASE WHEN all_floating THEN 'lz4_raw' ELSE 'none' END AS parquet_codec FROM floating""",
    "profile_all_variables": from_grid(
        f""", {AXES}, typed AS (
            SELECT variable, CASE kind WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE 'float' END AS dtype
            FROM (SELECT unnest(['sst', 'anom', 'err', 'ice', 'flag', 'items']) AS variable,
                         unnest([typeof(any_value(sst)), typeof(any_value(anom)), typeof(any_value(err)), typeof(any_value(ice)),
                                 typeof(any_value(flag)), typeof(any_value(items))]) AS kind FROM grid) AS t)
        SELECT variable, axis, n AS axis_size, dtype, CASE WHEN dtype <> 'string' THEN 4 END AS itemsize,
            CASE WHEN axis = 'time' THEN 1 WHEN dtype = 'string' THEN least(3620, n) ELSE least(5120, n) END AS chunk
        FROM typed CROSS JOIN axes""",
        FURTHER,
    ),
    "suggest_layout": _layout(),
    "stream_files": from_grid(EVERY_FILE, MONTHLY),
    "stream_convert": from_grid(
        f""", {blake3_of(keep=f"{KEY}, sst")} SELECT {KEY}, sst, digest AS spatial_hash, ',,,,,,,,,' AS verifier_pubkeys FROM hashed""",
        MONTHLY,
    ),
    "stream_upsert": from_grid(ALL_VALUES, MONTHLY),
    "dedup_events": f"WITH {RECORDS} SELECT uri, etag, event_id FROM records",
    "late_files": f"""WITH {LISTING},
        named AS (SELECT *, CAST(CAST(last_modified AS DATE) - 3 AS TIMESTAMP) + INTERVAL 12 HOUR AS file_time FROM listing)
        SELECT key, file_time, file_time < TIMESTAMP '2024-01-20 12:00:00' AS late,
            last_modified >= TIMESTAMP '2024-01-15' AS polled FROM named""",
    "stream_daily_stats": from_grid(
        f""", {DAILY_MEANS}
        SELECT time, row_number() OVER (ORDER BY time) AS day_number, daily_min, daily_max,
            round(avg(daily_mean) OVER (ORDER BY time ROWS UNBOUNDED PRECEDING), 6) AS running_mean FROM daily""",
        MONTHLY,
    ),
    "poll_state": f"""WITH {LISTING}
        SELECT max(last_modified) AS mark FROM listing WHERE last_modified >= TIMESTAMP '2024-01-10' AND key LIKE '%.nc'""",
    "apply_cellwise": from_grid(f"SELECT {KEY}, round(sst + 273.15, 6) AS kelvin FROM grid"),
}
