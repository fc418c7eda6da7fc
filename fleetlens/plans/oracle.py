"""Plain-SQL twins of the registry (DuckDB dialect), for result checking.

These are written the direct way — joins that multiply rows, sums over the
joined rows — so they check the Spark jobs' pre-aggregated, skew-safe plans
against the straightforward semantics.  The same helper rules (TRIM set,
half-up rounding on the binary value, SYW suffix) are spelled out in SQL.
"""

from __future__ import annotations

from fleetlens.functions.text import DEPARTMENTS
from fleetlens.sources.adapters import AS_OF, adapter_ctes

WS = "(' ' || chr(9) || chr(13) || chr(10))"
JD_CAPABLE = "telematicsCapable = 'true'"


def norm(x: str) -> str:
    return f"upper(trim({x}, {WS}))"


def trim(x: str) -> str:
    return f"trim({x}, {WS})"


def rhu(x: str, d: int) -> str:
    k = 10 ** d
    return (f"(CASE WHEN abs({x}) * CAST({k} AS DOUBLE) >= CAST(4503599627370496 AS DOUBLE) THEN CAST({x} AS DOUBLE) "
            f"ELSE sign({x}) * floor(abs({x}) * CAST({k} AS DOUBLE) + 0.5) / CAST({k} AS DOUBLE) END)")


def dbl(x: str) -> str:
    return f"CASE WHEN NOT isnan(TRY_CAST({x} AS DOUBLE)) THEN TRY_CAST({x} AS DOUBLE) END"


def lenient_int(x: str) -> str:
    return f"TRY_CAST({rhu(dbl(x), 0)} AS INTEGER)"


def cat_id(serial: str) -> str:
    return (f"('CAT' || CASE WHEN strpos({serial}, 'SYW') = 0 THEN '' "
            f"ELSE substr({serial}, strpos({serial}, 'SYW')) END)")


def bucket(ts: str) -> str:
    return f"(date_trunc('hour', {ts}) + to_minutes(CAST(30 * (minute({ts}) // 30) AS BIGINT)))"


def clean_user(u: str) -> str:
    depts = ", ".join(f"'{d}'" for d in DEPARTMENTS)
    return (f"CASE WHEN {norm(u)} IN ({depts}) THEN {norm(u)} "
            f"WHEN {trim(u)} = 'VACANT' THEN 'VACANT' ELSE NULL END")


def reg_key(variant: str) -> tuple[str, str]:
    s, m = "equipment_serial_number", "manufacture"
    if variant == "list":
        return (f"CASE WHEN {m} = 'CAT' THEN {cat_id(s)} ELSE {s} END",
                f"CASE WHEN {m} = 'CAT' THEN 'CATERPILLAR' ELSE {m} END")
    if variant == "hours":
        return (f"CASE WHEN {m} = 'CAT' THEN {cat_id(s)} ELSE {norm(s)} END",
                f"CASE WHEN {norm(m)} = 'CAT' THEN 'CATERPILLAR' ELSE {norm(m)} END")
    return (f"CASE WHEN {norm(m)} = 'CAT' THEN {cat_id(s)} ELSE {norm(s)} END",
            f"CASE WHEN {norm(m)} = 'CAT' THEN 'CATERPILLAR' ELSE {norm(m)} END")


def _latest(table: str, key: str, cols: list[str], where: str = "") -> str:
    order = ", ".join(["extract_date DESC NULLS LAST"] + [f"{c} DESC NULLS LAST" for c in cols])
    w = f"WHERE {where}" if where else ""
    return (f"SELECT {key}, {', '.join(cols)} FROM {table} {w} "
            f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1")


def _ctes() -> str:
    since = f"(DATE '{AS_OF}' - 30)"
    lid, lmk = reg_key("list")
    hid, hmk = reg_key("hours")
    fid, fmk = reg_key("fuel")
    drive_h = rhu(f"{dbl('long_drive')} / 3600.0", 2)
    idle_h = rhu(f"{dbl('long_idle')} / 3600.0", 2)
    ts = "CAST(_time AS TIMESTAMP)"
    lg_active = f"CASE WHEN {dbl('working_hours')} + {dbl('idle_hours')} > 0 THEN 1 ELSE 0 END"
    ctes = {
        "o_fuso_latest": _latest("fuso_devices", "imei",
                                 ["chassis_number", "vehicle_name", "vehicle_type", "activation_date"]),
        "o_jd_latest": (f"SELECT serialNumber, _name, fleet_type FROM ("
                        f"{_latest('jd_equipment', 'serialNumber', ['_name', 'fleet_type', '_type'], JD_CAPABLE)}) t "
                        f"WHERE _type = 'Machine'"),
        "o_lg_latest": _latest("liugong_machines", "serialNumber", ["productName", "equipmentModel"]),
        "o_cat_latest": _latest("cat_asset_utilization", "asset_serial_number", ["model"]),
        "o_register": (f"SELECT * FROM lark_fleet_master WHERE extract_date = "
                       f"(SELECT max(extract_date) FROM lark_fleet_master) AND {norm('manufacture')} IN "
                       f"('MITSUBISHI', 'JOHN DEERE', 'LIUGONG', 'CAT')"),
        "o_units": ("SELECT chassis_number AS idNumber, vehicle_name AS vehicleName, vehicle_type AS vehicleType, "
                    "'MITSUBISHI' AS manufacture FROM o_fuso_latest "
                    "UNION ALL SELECT serialNumber, _name, fleet_type, 'JOHN DEERE' FROM o_jd_latest "
                    "UNION ALL SELECT serialNumber, productName, equipmentModel, 'LIUGONG' FROM o_lg_latest "
                    "UNION ALL SELECT 'CAT' || asset_serial_number, CAST(NULL AS VARCHAR), model, 'CATERPILLAR' "
                    "FROM o_cat_latest"),
        # ---- daily hours
        "o_ds": (f"SELECT imei, CAST(substr(_date, 1, 10) AS DATE) AS date_record, {drive_h} AS long_drive, "
                 f"{idle_h} AS long_idle, {rhu(dbl('distance'), 2)} AS distance FROM fuso_daily_summary"),
        "o_mu": ("SELECT serial_number AS serialNumber, CAST(intervalEndDate AS DATE) AS _date, "
                 "SUM(idle) / 3600.0 AS mu_idle, SUM(working) / 3600.0 AS mu_working "
                 "FROM jd_measurement WHERE _name = 'Machine Utilization' GROUP BY 1, 2"),
        "o_lg_daily": (f"SELECT overall_unit_sn AS serialNumber, CAST(extract_date AS DATE) AS _date, "
                       f"{dbl('working_hours')} AS work_hour, {dbl('idle_hours')} AS idle_hour "
                       f"FROM liugong_work_hours"),
        "o_cat_daily": (f"SELECT asset_serial_number AS serialNumber, CAST(extract_date AS DATE) AS _date, "
                        f"{dbl('working_time_hours')} AS work_hour, {dbl('idle_time_hours')} AS idle_hour "
                        f"FROM cat_asset_utilization"),
        "o_daily": (
            f"SELECT d.chassis_number AS idNumber, d.vehicle_name AS vehicleName, d.vehicle_type AS vehicleType, "
            f"'MITSUBISHI' AS manufacture, s.date_record AS _date, s.long_drive AS work_hour, "
            f"s.long_idle AS idle_hour, "
            f"CASE WHEN {rhu('s.long_drive + s.long_idle', 2)} > 0 THEN 1 ELSE 0 END AS is_active_day "
            f"FROM o_fuso_latest d LEFT JOIN o_ds s ON d.imei = s.imei "
            f"UNION ALL SELECT e.serialNumber, e._name, e.fleet_type, 'JOHN DEERE', m._date, m.mu_working, "
            f"m.mu_idle, CASE WHEN {rhu('m.mu_working + m.mu_idle', 4)} > 0 THEN 1 ELSE 0 END "
            f"FROM o_jd_latest e LEFT JOIN o_mu m ON e.serialNumber = m.serialNumber "
            f"UNION ALL SELECT l.serialNumber, l.productName, l.equipmentModel, 'LIUGONG', h._date, h.work_hour, "
            f"h.idle_hour, CASE WHEN coalesce(h.work_hour, 0) + coalesce(h.idle_hour, 0) > 0 THEN 1 ELSE 0 END "
            f"FROM o_lg_latest l LEFT JOIN o_lg_daily h ON l.serialNumber = h.serialNumber "
            f"UNION ALL SELECT c.asset_serial_number, CAST(NULL AS VARCHAR), c.model, 'CATERPILLAR', h._date, "
            f"h.work_hour, h.idle_hour, "
            f"CASE WHEN coalesce(h.work_hour, 0) + coalesce(h.idle_hour, 0) > 0 THEN 1 ELSE 0 END "
            f"FROM o_cat_latest c LEFT JOIN o_cat_daily h ON c.asset_serial_number = h.serialNumber"),
        "o_hours_joined": (
            f"SELECT d.*, r.equipment_location, r.egi_equipment_description, r.model, r.class FROM o_daily d "
            f"LEFT JOIN (SELECT {hid} AS rid, {hmk} AS rmaker, equipment_location, egi_equipment_description, "
            f"model, class FROM o_register) r "
            f"ON {norm('d.idNumber')} = r.rid AND {norm('d.manufacture')} = r.rmaker"),
        "o_hours_master": ("SELECT manufacture, vehicleType, max(model) AS model, max(class) AS class, "
                           "max(egi_equipment_description) AS egi_equipment_description FROM o_hours_joined "
                           "WHERE model IS NOT NULL AND class IS NOT NULL GROUP BY manufacture, vehicleType"),
        # ---- utilization
        "o_util_units": (
            f"SELECT d.chassis_number AS idNumber, d.vehicle_name AS vehicleName, d.vehicle_type AS vehicleType, "
            f"'MITSUBISHI' AS manufacture, "
            f"CAST(SUM(CASE WHEN s.work_hour > 0 THEN 1 ELSE 0 END) AS BIGINT) AS total_active_days "
            f"FROM o_fuso_latest d LEFT JOIN (SELECT imei, {drive_h} + {idle_h} AS work_hour "
            f"FROM fuso_daily_summary WHERE CAST(substr(_date, 1, 10) AS DATE) >= {since}) s ON d.imei = s.imei "
            f"WHERE d.chassis_number IS NOT NULL AND {trim('d.chassis_number')} <> '' GROUP BY 1, 2, 3 "
            f"UNION ALL SELECT e.serialNumber, e._name, e.fleet_type, 'JOHN DEERE', "
            f"CAST(SUM(CASE WHEN m.work_hour > 0 THEN 1 ELSE 0 END) AS BIGINT) "
            f"FROM o_jd_latest e LEFT JOIN (SELECT serial_number, (idle / 3600.0) + (working / 3600.0) AS work_hour "
            f"FROM jd_measurement WHERE _name = 'Machine Utilization' "
            f"AND CAST(intervalEndDate AS DATE) >= {since}) m ON e.serialNumber = m.serial_number "
            f"WHERE e.serialNumber IS NOT NULL AND {trim('e.serialNumber')} <> '' GROUP BY 1, 2, 3 "
            f"UNION ALL SELECT l.serialNumber, l.productName, l.equipmentModel, 'LIUGONG', "
            f"CAST(SUM(CASE WHEN h.work_hour > 0 THEN 1 ELSE 0 END) AS BIGINT) "
            f"FROM o_lg_latest l LEFT JOIN (SELECT serialNumber, work_hour + idle_hour AS work_hour "
            f"FROM o_lg_daily WHERE _date >= {since}) h ON l.serialNumber = h.serialNumber "
            f"WHERE l.serialNumber IS NOT NULL AND {trim('l.serialNumber')} <> '' GROUP BY 1, 2, 3 "
            f"UNION ALL SELECT c.asset_serial_number, CAST(NULL AS VARCHAR), c.model, 'CATERPILLAR', "
            f"CAST(SUM(CASE WHEN h.work_hour > 0 THEN 1 ELSE 0 END) AS BIGINT) "
            f"FROM o_cat_latest c LEFT JOIN (SELECT serialNumber, work_hour + idle_hour AS work_hour "
            f"FROM o_cat_daily WHERE _date >= {since}) h ON c.asset_serial_number = h.serialNumber "
            f"WHERE c.asset_serial_number IS NOT NULL AND {trim('c.asset_serial_number')} <> '' "
            f"GROUP BY 1, 2, 3"),
        "o_util_joined": (
            f"SELECT {norm('a.manufacture')} AS manufacture, {norm('a.vehicleType')} AS vehicleType, "
            f"r.equipment_location, r.egi_equipment_description, r.model, r.class, r.\"user\" AS user_company, "
            f"a.total_active_days FROM o_util_units a LEFT JOIN "
            f"(SELECT {lid} AS rid, {lmk} AS rmaker, * FROM o_register) r "
            f"ON {norm('a.idNumber')} = r.rid AND {norm('a.manufacture')} = r.rmaker"),
        "o_util_master": ("SELECT manufacture, vehicleType, max(model) AS model, max(class) AS class, "
                          "max(egi_equipment_description) AS egi_equipment_description FROM o_util_joined "
                          "WHERE model IS NOT NULL AND class IS NOT NULL GROUP BY manufacture, vehicleType"),
        # ---- fuel
        "o_fuel_clean": (
            f"SELECT extract_date, chassis_number, _time, {lenient_int('fuelAverage')} AS fuelLevel, "
            f"{lenient_int('odometer')} AS odometer, {bucket(ts)} AS window_start FROM fuso_fuel_reports "
            f"WHERE {dbl('fuelAverage')} >= 0 AND {dbl('fuelAverage')} <= 300 "
            f"AND {dbl('raw_current_voltage')} > 0 AND NOT isnan({dbl('raw_current_voltage')})"),
        "o_fuel_last": (
            f"SELECT * FROM o_fuel_clean QUALIFY row_number() OVER (PARTITION BY chassis_number, window_start "
            f"ORDER BY {ts} DESC NULLS LAST, fuelLevel DESC NULLS LAST, odometer DESC NULLS LAST, "
            f"extract_date DESC NULLS LAST, _time DESC NULLS LAST) = 1"),
        "o_fuel_lag": (
            "SELECT *, lag(fuelLevel) OVER w AS prev_fuel_level, lag(odometer) OVER w AS prev_odometer "
            "FROM o_fuel_last WINDOW w AS (PARTITION BY chassis_number ORDER BY window_start ASC NULLS LAST)"),
        "o_fuel_steps": (
            "SELECT extract_date AS _date, chassis_number AS idNumber, window_start, _time, prev_fuel_level, "
            "fuelLevel, CASE WHEN prev_fuel_level IS NOT NULL AND fuelLevel < prev_fuel_level "
            "AND prev_fuel_level - fuelLevel < 50 THEN prev_fuel_level - fuelLevel ELSE 0 END AS fuel_used_liters, "
            "prev_odometer, odometer, CASE WHEN prev_odometer IS NOT NULL AND odometer > prev_odometer "
            "THEN odometer - prev_odometer ELSE 0 END AS trip_meter FROM o_fuel_lag"),
        "o_fuel_steps2": ("SELECT *, CASE WHEN fuel_used_liters > 0 AND trip_meter = 0 THEN fuel_used_liters "
                          "ELSE 0 END AS idle_fuel_consumption FROM o_fuel_steps"),
        "o_fuso_active": (f"SELECT imei, CAST(substr(_date, 1, 10) AS DATE) AS _date, "
                          f"CASE WHEN {drive_h} + {idle_h} > 0 THEN 1 ELSE 0 END AS is_active_day "
                          f"FROM fuso_daily_summary"),
        "o_fuso_fuel": (
            f"SELECT f.idNumber, d.vehicle_name AS vehicleName, d.vehicle_type AS vehicleType, "
            f"'MITSUBISHI' AS manufacture, f._date, "
            f"{rhu('CAST(SUM(f.idle_fuel_consumption) AS DOUBLE)', 2)} AS fuel_consumed_idle, "
            f"{rhu('CAST(SUM(f.fuel_used_liters) AS DOUBLE)', 2)} - "
            f"{rhu('CAST(SUM(f.idle_fuel_consumption) AS DOUBLE)', 2)} AS fuel_consumed_working, "
            f"CAST(NULL AS DOUBLE) AS fuel_consumed_transport, "
            f"{rhu('CAST(SUM(f.fuel_used_liters) AS DOUBLE)', 2)} AS fuel_consumed_total, "
            f"COALESCE(MAX(a.is_active_day), 0) AS is_active_day "
            f"FROM o_fuel_steps2 f LEFT JOIN o_fuso_latest d ON {norm('f.idNumber')} = {norm('d.chassis_number')} "
            f"LEFT JOIN o_fuso_active a ON d.imei = a.imei AND f._date = a._date "
            f"GROUP BY f.idNumber, d.vehicle_name, d.vehicle_type, f._date"),
        "o_jd_fuel": (
            "SELECT e.serialNumber AS idNumber, e._name AS vehicleName, e.fleet_type AS vehicleType, "
            "'JOHN DEERE' AS manufacture, f._date, f.fi AS fuel_consumed_idle, f.fw AS fuel_consumed_working, "
            "f.ft AS fuel_consumed_transport, f.fi + f.fw AS fuel_consumed_total, "
            "COALESCE(a.is_active_day, 0) AS is_active_day FROM o_jd_latest e "
            "LEFT JOIN (SELECT serial_number, CAST(intervalEndDate AS DATE) AS _date, SUM(idle) / 3600.0 AS fi, "
            "SUM(working) / 3600.0 AS fw, SUM(transport) / 3600.0 AS ft FROM jd_measurement "
            "WHERE _name = 'Fuel Consumed' GROUP BY 1, 2) f ON e.serialNumber = f.serial_number "
            "LEFT JOIN (SELECT serial_number, CAST(intervalEndDate AS DATE) AS _date, "
            "CASE WHEN SUM(idle + working) / 3600.0 > 0 THEN 1 ELSE 0 END AS is_active_day FROM jd_measurement "
            "WHERE _name = 'Machine Utilization' GROUP BY 1, 2) a "
            "ON e.serialNumber = a.serial_number AND f._date = a._date"),
        "o_lg_active": (f"SELECT overall_unit_sn AS serialNumber, CAST(extract_date AS DATE) AS _date, "
                        f"{lg_active} AS is_active_day FROM liugong_work_hours"),
        "o_lg_day_active": ("SELECT serialNumber, _date, max(is_active_day) AS is_active_day FROM o_lg_active "
                            "GROUP BY serialNumber, _date"),
        "o_lg_fuel": (
            f"SELECT l.serialNumber AS idNumber, g.productName AS vehicleName, g.equipmentModel AS vehicleType, "
            f"'LIUGONG' AS manufacture, l._date, l.fi AS fuel_consumed_idle, l.fw AS fuel_consumed_working, "
            f"CAST(NULL AS DOUBLE) AS fuel_consumed_transport, l.ft AS fuel_consumed_total, "
            f"COALESCE(a.is_active_day, 0) AS is_active_day FROM "
            f"(SELECT overall_unit_sn AS serialNumber, CAST(extract_date AS DATE) AS _date, "
            f"{dbl('avg_mileage_idle_oil_consume')} AS fi, {dbl('job_oil_consumes')} AS fw, "
            f"CAST(oil_consumes AS DOUBLE) AS ft FROM liugong_work_hours) l "
            f"LEFT JOIN o_lg_latest g ON {norm('l.serialNumber')} = {norm('g.serialNumber')} "
            f"LEFT JOIN o_lg_day_active a ON l.serialNumber = a.serialNumber AND l._date = a._date"),
        "o_cat_fuel": (
            f"SELECT 'CAT' || c.asset_serial_number AS idNumber, CAST(NULL AS VARCHAR) AS vehicleName, "
            f"c.model AS vehicleType, 'CATERPILLAR' AS manufacture, f._date, "
            f"{rhu('f.ft * f.ih / NULLIF(f.wh + f.ih, 0)', 2)} AS fuel_consumed_idle, "
            f"{rhu('f.ft * f.wh / NULLIF(f.wh + f.ih, 0)', 2)} AS fuel_consumed_working, "
            f"CAST(NULL AS DOUBLE) AS fuel_consumed_transport, f.ft AS fuel_consumed_total, "
            f"CASE WHEN coalesce(f.wh, 0) + coalesce(f.ih, 0) > 0 THEN 1 ELSE 0 END AS is_active_day "
            f"FROM o_cat_latest c LEFT JOIN (SELECT 'CAT' || asset_serial_number AS serialNumber, "
            f"CAST(extract_date AS DATE) AS _date, {dbl('working_time_hours')} AS wh, "
            f"{dbl('idle_time_hours')} AS ih, {dbl('total_fuel_burned_liter')} AS ft "
            f"FROM cat_asset_utilization) f ON 'CAT' || c.asset_serial_number = f.serialNumber"),
        "o_fuel_merged": ("SELECT * FROM o_fuso_fuel UNION ALL SELECT * FROM o_jd_fuel "
                          "UNION ALL SELECT * FROM o_lg_fuel UNION ALL SELECT * FROM o_cat_fuel"),
        "o_fuel_joined": (
            f"SELECT m.*, r.equipment_location, r.egi_equipment_description, r.model, r.class, r.user_company "
            f"FROM o_fuel_merged m LEFT JOIN (SELECT {fid} AS rid, {fmk} AS rmaker, equipment_location, "
            f"egi_equipment_description, model, class, {clean_user(chr(34) + 'user' + chr(34))} AS user_company "
            f"FROM o_register) r ON {norm('m.idNumber')} = r.rid AND {norm('m.manufacture')} = r.rmaker"),
        "o_fuel_master": ("SELECT manufacture, vehicleType, max(model) AS model, max(class) AS class, "
                          "max(egi_equipment_description) AS egi_equipment_description FROM o_fuel_joined "
                          "WHERE model IS NOT NULL AND class IS NOT NULL GROUP BY manufacture, vehicleType"),
    }
    return ",\n".join(f"{k} AS ({v})" for k, v in ctes.items())


def _finals() -> dict[str, str]:
    lid, lmk = reg_key("list")
    hid, hmk = reg_key("hours")
    fid, fmk = reg_key("fuel")
    user = '"user"'
    ratio_ok = f"{rhu('j.work_hour + j.idle_hour', 4)} > 0 AND j.is_active_day = 1"
    ratios = (f"CASE WHEN {ratio_ok} THEN {rhu('j.work_hour / (j.work_hour + j.idle_hour) * 100.0', 2)} END "
              f"AS work_ratio, "
              f"CASE WHEN {ratio_ok} THEN {rhu('j.idle_hour / (j.work_hour + j.idle_hour) * 100.0', 2)} END "
              f"AS idle_ratio")
    under = "CAST(SUM(CASE WHEN j.total_active_days < 10 THEN 1 ELSE 0 END) AS BIGINT)"
    return {
        "latest_fuso_devices": "SELECT * FROM o_fuso_latest",
        "latest_jd_equipment": "SELECT * FROM o_jd_latest",
        "latest_liugong": "SELECT * FROM o_lg_latest",
        "latest_cat": "SELECT * FROM o_cat_latest",
        "empty_to_null_date": ("SELECT imei, CAST(NULLIF(activation_date, '') AS DATE) AS activation_date "
                               "FROM o_fuso_latest"),
        "register_latest_snapshot": "SELECT * FROM o_register",
        "register_normalize": (f"SELECT equipment_serial_number, manufacture, {lid} AS id_list, {lmk} AS maker_list, "
                               f"{lid} AS id_utilization, {lmk} AS maker_utilization, "
                               f"{hid} AS id_hours, {hmk} AS maker_hours, {fid} AS id_fuel, {fmk} AS maker_fuel "
                               f"FROM o_register"),
        "clean_user_department": (f"SELECT equipment_number, {user}, {clean_user(user)} AS department "
                                  f"FROM o_register"),
        "fleet_units": "SELECT * FROM o_units",
        "fleet_list": (
            f"SELECT r.equipment_location, r.model, r.class, "
            f"coalesce(r.egi_equipment_description, u.vehicleType) AS egi_equipment_description, "
            f"r.clean_user AS {user}, coalesce(r.rid, u.idNumber) AS idNumber, "
            f"coalesce(u.vehicleName, r.equipment_number) AS vehicleName, "
            f"coalesce(u.vehicleType, r.class) AS vehicleType, coalesce(u.manufacture, r.rmaker) AS manufacture, "
            f"CASE WHEN r.rid IS NULL THEN 'Datalake Only' WHEN u.idNumber IS NULL THEN 'Lark Only' "
            f"ELSE 'Matched' END AS data_source "
            f"FROM (SELECT *, {lid} AS rid, {lmk} AS rmaker, {clean_user(user)} AS clean_user FROM o_register) r "
            f"FULL OUTER JOIN o_units u ON {norm('r.rid')} = {norm('u.idNumber')} "
            f"AND {norm('r.rmaker')} = {norm('u.manufacture')}"),
        "fuso_daily_hours": "SELECT date_record, long_drive, long_idle, distance, imei FROM o_ds",
        "jd_daily_hours": ("SELECT serialNumber, _date, mu_idle AS machine_utilization_idle, "
                           "mu_working AS machine_utilization_working FROM o_mu"),
        "liugong_cat_daily_hours": ("SELECT 'LIUGONG' AS manufacture, * FROM o_lg_daily "
                                    "UNION ALL SELECT 'CATERPILLAR', * FROM o_cat_daily"),
        "active_flag_rules": (
            "SELECT 'hours' AS rule, manufacture, idNumber, _date, is_active_day FROM o_daily "
            "UNION ALL SELECT 'fuel', 'MITSUBISHI', imei, _date, is_active_day FROM o_fuso_active "
            "UNION ALL SELECT 'fuel', 'LIUGONG', serialNumber, _date, is_active_day FROM o_lg_active "
            "UNION ALL SELECT 'fuel', manufacture, idNumber, _date, is_active_day FROM o_jd_fuel "
            "UNION ALL SELECT 'fuel', manufacture, idNumber, _date, is_active_day FROM o_cat_fuel"),
        "work_idle_ratio": (f"SELECT j.idNumber, j.manufacture, j._date, j.work_hour, j.idle_hour, j.is_active_day, "
                            f"{ratios} FROM o_daily j"),
        "hours": (
            f"SELECT j.idNumber, j.vehicleName, j.vehicleType, j.manufacture, j._date, j.work_hour, j.idle_hour, "
            f"j.is_active_day, j.equipment_location, "
            f"coalesce(j.egi_equipment_description, m.egi_equipment_description) AS equipment_description, "
            f"coalesce(j.model, m.model) AS model, coalesce(j.class, m.class) AS class, {ratios} "
            f"FROM o_hours_joined j LEFT JOIN o_hours_master m "
            f"ON j.manufacture = m.manufacture AND j.vehicleType = m.vehicleType"),
        "active_days_30d": "SELECT * FROM o_util_units",
        "active_days_by_day": "SELECT * FROM o_util_units",
        "latest_cat_merged": "SELECT * FROM o_cat_latest",
        "impute_vehicle_master": "SELECT * FROM o_hours_master",
        "impute_utilization_master": "SELECT * FROM o_util_master",
        "impute_fuel_master": "SELECT * FROM o_fuel_master",
        "utilization": (
            f"SELECT j.manufacture, j.vehicleType, j.equipment_location, "
            f"coalesce(j.egi_equipment_description, m.egi_equipment_description) AS equipment_description, "
            f"coalesce(j.model, m.model) AS model, coalesce(j.class, m.class) AS class, j.user_company, "
            f"count(*) AS total_unit, {under} AS total_underutilized_unit, "
            f"count(*) - {under} AS total_utilized_unit "
            f"FROM o_util_joined j LEFT JOIN o_util_master m "
            f"ON j.manufacture = m.manufacture AND j.vehicleType = m.vehicleType GROUP BY 1, 2, 3, 4, 5, 6, 7"),
        "fuel_readings_clean": "SELECT * FROM o_fuel_clean",
        "half_hour_bucket": (f"SELECT chassis_number, _time, {bucket('CAST(_time AS TIMESTAMP)')} AS window_start "
                             f"FROM fuso_fuel_reports"),
        "last_reading_per_bucket": "SELECT * FROM o_fuel_last",
        "fuel_delta": "SELECT * FROM o_fuel_steps2",
        "fuso_fuel_daily": "SELECT * FROM o_fuso_fuel",
        "jd_fuel_daily": "SELECT * FROM o_jd_fuel",
        "liugong_fuel_daily": "SELECT * FROM o_lg_fuel",
        "cat_fuel_allocation": "SELECT * FROM o_cat_fuel",
        "fuel": (
            "SELECT j.idNumber, j.vehicleName, j.vehicleType, j.manufacture, j._date, j.fuel_consumed_idle, "
            "j.fuel_consumed_working, j.fuel_consumed_transport, j.fuel_consumed_total, j.is_active_day, "
            "j.equipment_location, coalesce(j.model, m.model) AS model, coalesce(j.class, m.class) AS class, "
            "coalesce(j.egi_equipment_description, m.egi_equipment_description) AS equipment_description, "
            f"j.user_company FROM o_fuel_joined j LEFT JOIN o_fuel_master m "
            f"ON {norm('j.manufacture')} = {norm('m.manufacture')} "
            f"AND {norm('j.vehicleType')} = {norm('m.vehicleType')}"),
    }


def oracle_sql() -> dict[str, str]:
    """SQL per registry key over the driver tables (adapters as CTEs)."""
    prefix = "WITH " + adapter_ctes() + ",\n" + _ctes() + "\n"
    return {k: prefix + v for k, v in _finals().items()}


def source_sql() -> dict[str, str]:
    """SQL per registry key over tables named like the nine fleet sources."""
    prefix = "WITH " + _ctes() + "\n"
    return {k: prefix + v for k, v in _finals().items()}
