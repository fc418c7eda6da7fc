"""Adapter views: the nine fleet sources derived from the driver tables.

The test data has no fleet tables, so each source is derived from the
TPC-H-like tables.  The derivations inject the dirt the reports clean (old
snapshots, blank / NULL / padded ids, bad numbers, zero voltage, out-of-range
fuel, unmatched units).  The SQL is written in the subset Spark and DuckDB
share, so the same text feeds ``spark.sql`` (driver tables bound as DataFrame
arguments) and the DuckDB oracle (plain table names).

Fixed values: the as-of date of this data is 2024-02-01.
"""

from __future__ import annotations

AS_OF = "2024-02-01"

# view name -> (driver tables it reads, SQL with {table} placeholders)
ADAPTERS: dict[str, tuple[tuple[str, ...], str]] = {
    "fuso_devices": (("customer",), """
  SELECT '2024-02-01' AS extract_date, CAST(c_custkey AS STRING) AS imei,
         CASE WHEN c_custkey % 50 = 49 THEN NULL
              WHEN c_custkey % 50 = 48 THEN ' '
              WHEN c_custkey % 50 = 47 THEN ' mhf' || LPAD(CAST(c_custkey AS STRING), 8, '0') || ' '
              ELSE 'MHF' || LPAD(CAST(c_custkey AS STRING), 8, '0') END AS chassis_number,
         c_name AS vehicle_name, 'FN' || CAST(c_nationkey % 6 AS STRING) AS vehicle_type,
         CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '2023-05-01' END AS activation_date
  FROM {customer}
  UNION ALL
  SELECT '2024-01-01', CAST(c_custkey AS STRING), 'MHF' || LPAD(CAST(c_custkey AS STRING), 8, '0'),
         'OLD ' || c_name, 'FN0', ''
  FROM {customer} WHERE c_custkey % 3 = 0
"""),
    "fuso_fuel_reports": (("events",), """
  SELECT CAST(ts AS DATE) AS extract_date, 'MHF' || LPAD(CAST(user_id AS STRING), 8, '0') AS chassis_number,
         CAST(ts AS STRING) AS _time, CAST(value AS STRING) AS fuelAverage,
         CAST(EXTRACT(DAY FROM ts) * 10 AS STRING) AS odometer,
         CASE WHEN event_type = 'error' THEN '0' ELSE '24.5' END AS raw_current_voltage
  FROM {events}
"""),
    "fuso_daily_summary": (("events",), """
  SELECT CAST(user_id AS STRING) AS imei, CAST(CAST(ts AS DATE) AS STRING) || 'T00:00:00' AS _date,
         CASE WHEN COUNT(*) > 5 THEN 'n/a'
              ELSE CAST(CAST(SUM(CAST(FLOOR(value * 10) AS BIGINT)) AS BIGINT) AS STRING) END AS long_drive,
         CAST(600 * SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS STRING) AS long_idle,
         CAST(COUNT(*) AS STRING) AS distance
  FROM {events} GROUP BY user_id, CAST(ts AS DATE)
"""),
    "jd_equipment": (("supplier",), """
  SELECT '2024-02-01' AS extract_date, 'JD' || LPAD(CAST(s_suppkey AS STRING), 6, '0') AS serialNumber,
         s_name AS _name, 'TYPE-' || CAST(s_nationkey % 5 AS STRING) AS fleet_type,
         CASE WHEN s_suppkey % 7 = 6 THEN 'false' ELSE 'true' END AS telematicsCapable,
         CASE WHEN s_suppkey % 10 = 9 THEN 'Attachment' ELSE 'Machine' END AS _type
  FROM {supplier}
  UNION ALL
  SELECT '2024-01-01', 'JD' || LPAD(CAST(s_suppkey AS STRING), 6, '0'), 'OLD ' || s_name, 'TYPE-0', 'true', 'Machine'
  FROM {supplier} WHERE s_suppkey % 2 = 0
"""),
    "jd_measurement": (("lineitem",), """
  SELECT 'JD' || LPAD(CAST(l_suppkey AS STRING), 6, '0') AS serial_number,
         CAST(DATE '2024-01-01' + CAST(l_orderkey % 30 AS INT) AS STRING) AS intervalEndDate,
         CASE WHEN l_linestatus = 'F' THEN 'Fuel Consumed' ELSE 'Machine Utilization' END AS _name,
         CAST(FLOOR(l_tax * 10000) AS DOUBLE) AS idle, l_quantity * 60 AS working,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(FLOOR(l_discount * 3600) AS DOUBLE) END AS transport
  FROM {lineitem}
"""),
    "liugong_machines": (("part",), """
  SELECT '2024-02-01' AS extract_date, 'LG' || LPAD(CAST(p_partkey AS STRING), 7, '0') AS serialNumber,
         p_name AS productName, p_type AS equipmentModel
  FROM {part} WHERE p_size <= 40
  UNION ALL
  SELECT '2024-01-01', 'LG' || LPAD(CAST(p_partkey AS STRING), 7, '0'), 'OLD ' || p_name, p_type
  FROM {part} WHERE p_partkey % 2 = 0 AND p_size <= 40
"""),
    "liugong_work_hours": (("lineitem",), """
  SELECT 'LG' || LPAD(CAST(l_partkey AS STRING), 7, '0') AS overall_unit_sn,
         CAST(DATE '2024-01-01' + CAST(l_orderkey % 30 AS INT) AS STRING) AS extract_date,
         CASE WHEN l_linenumber = 7 THEN 'bad' ELSE CAST(l_quantity / 10 AS STRING) END AS working_hours,
         CASE WHEN l_linenumber = 6 THEN '' ELSE CAST(CAST(FLOOR(l_tax * 50) AS BIGINT) AS STRING) END AS idle_hours,
         CAST(CAST(FLOOR(l_discount * 100) AS BIGINT) AS STRING) AS avg_mileage_idle_oil_consume,
         CAST(l_quantity AS STRING) AS job_oil_consumes,
         CAST(l_quantity + CAST(FLOOR(l_discount * 100) AS BIGINT) AS STRING) AS oil_consumes
  FROM {lineitem}
"""),
    "cat_asset_utilization": (("orders",), """
  SELECT 'SYW' || LPAD(CAST(o_custkey AS STRING), 9, '0') AS asset_serial_number,
         'D' || CAST(o_custkey % 4 AS STRING) AS model,
         CAST(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INT) AS STRING) AS extract_date,
         CASE WHEN o_orderstatus = 'P' THEN '0' ELSE CAST(o_orderkey % 9 AS STRING) END AS working_time_hours,
         CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderstatus = 'P' THEN '0' ELSE '2' END AS idle_time_hours,
         CAST(o_orderkey % 97 AS STRING) AS total_fuel_burned_liter
  FROM {orders}
"""),
    "lark_fleet_master": (("customer", "supplier", "part", "region"), """
  SELECT '2024-02-01' AS extract_date, 'TRUCK' AS class, 'LOC-' || CAST(c_nationkey AS STRING) AS equipment_location,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'Dump truck' END AS egi_equipment_description,
         'DT-' || CAST(c_custkey AS STRING) AS equipment_number,
         'MHF' || LPAD(CAST(c_custkey AS STRING), 8, '0') AS equipment_serial_number,
         CASE WHEN c_custkey % 9 = 8 THEN ' mitsubishi ' ELSE 'MITSUBISHI' END AS manufacture,
         'FN-' || CAST(c_nationkey % 6 AS STRING) AS model, CAST(c_custkey AS STRING) AS number,
         CASE c_custkey % 8 WHEN 0 THEN ' nursery' WHEN 1 THEN 'Warehouse' WHEN 2 THEN '0' WHEN 3 THEN 'VACANT'
              WHEN 4 THEN 'vacant' WHEN 5 THEN 'r & d' WHEN 6 THEN 'Breakdown/Accident' ELSE 'unknown dept' END AS user
  FROM {customer} WHERE c_custkey % 4 <> 3
  UNION ALL
  SELECT '2024-02-01', 'TRACTOR', 'LOC-' || CAST(s_nationkey AS STRING), 'Tractor', 'TR-' || CAST(s_suppkey AS STRING),
         'JD' || LPAD(CAST(s_suppkey AS STRING), 6, '0'), 'JOHN DEERE', 'TYPE-' || CAST(s_nationkey % 5 AS STRING),
         CAST(s_suppkey AS STRING), 'FARMING'
  FROM {supplier} WHERE s_suppkey % 5 <> 4
  UNION ALL
  SELECT '2024-02-01', 'LOADER', 'LOC-0', 'Wheel loader', 'WL-' || CAST(p_partkey AS STRING),
         'LG' || LPAD(CAST(p_partkey AS STRING), 7, '0'), 'LIUGONG', p_type, CAST(p_partkey AS STRING), 'civil '
  FROM {part} WHERE p_partkey % 3 = 0
  UNION ALL
  SELECT '2024-02-01', 'DOZER', 'LOC-1', 'Dozer', 'DZ-' || CAST(c_custkey AS STRING),
         CASE WHEN c_custkey % 20 = 19 THEN 'NO-SERIAL'
              ELSE 'X9-SYW' || LPAD(CAST(c_custkey AS STRING), 9, '0') END,
         CASE WHEN c_custkey % 9 = 8 THEN ' cat ' ELSE 'CAT' END, 'D6', CAST(c_custkey AS STRING), 'LC'
  FROM {customer}
  UNION ALL
  SELECT '2024-02-01', 'EXCAVATOR', 'LOC-2', 'Excavator', 'EX-1', 'KM-1', 'KOMATSU', 'PC200', '1', 'HSE'
  FROM {region} WHERE r_regionkey = 0
  UNION ALL
  SELECT '2024-01-01', 'STALE', 'LOC-9', 'Stale row', 'ST-1', 'MHF00000001', 'MITSUBISHI', 'STALE', '1', 'HSE'
  FROM {region} WHERE r_regionkey = 0
"""),
}


def adapter_ctes() -> str:
    """All adapters as a CTE list over plain table names (for the oracle)."""
    parts = []
    for name, (tables, body) in ADAPTERS.items():
        parts.append(f"{name} AS ({body.format(**{t: t for t in tables})})")
    return ",\n".join(parts)
