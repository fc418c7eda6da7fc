"""Hand-made fleet rows that reach the cases the derived test data does not.

Each block says which rule it exercises.
"""

import datetime as dt

D = dt.date

FUSO_DEVICES = [
    # extract_date, imei, chassis_number, vehicle_name, vehicle_type, activation_date
    ("2024-02-01", "1", "MHF001", "Truck A", "FN1", "2023-05-01"),
    ("2024-01-01", "1", "MHF001", "Old A", "FN1", ""),             # older snapshot
    ("2024-02-01", "2", "MHF002", "Truck B", "FN1", ""),           # same imei + date: tie
    ("2024-02-01", "2", "MHF002", "Truck B2", "FN1", ""),
    ("2024-02-01", "3", "MHF003", "Truck C", "fn1 ", ""),          # type equal only after UPPER(TRIM())
    ("2024-02-01", "4", "MHF003", "Truck C2", "FN2", "2023-01-01"),  # one chassis, two imeis
    ("2024-02-01", "5", None, "Truck E", "FN2", ""),               # NULL chassis
    ("2024-02-01", "6", " ", "Truck F", "FN2", ""),                # blank chassis
    ("2024-02-01", "7", " mhf007 ", "Truck G", "FN1", ""),         # padded, lower case
    (None, "8", "MHF008", "Truck H", "FN1", ""),                   # NULL date sorts last
    ("2024-01-15", "8", "MHF008", "Truck H new", "FN1", ""),
    ("2024-02-01", None, "MHF009", "No imei", "FN3", ""),          # NULL key
    ("2024-02-01", "10", "MHF010", "Truck J", "FN3", ""),          # exactly 10 active days
]


def _days(imei, first, n, drive="3600", idle="0"):
    return [(imei, (D(2024, 1, first) + dt.timedelta(days=i)).isoformat() + "T00:00:00", drive, idle, "12")
            for i in range(n)]


FUSO_DAILY_SUMMARY = (
    # imei, _date, long_drive, long_idle, distance
    _days("1", 2, 10)                                     # 10 active days from as_of-30
    + [("1", "2024-01-01T00:00:00", "3600", "0", "1")]   # as_of-31: outside the window
    + [("1", "2024-02-05T00:00:00", "3600", "0", "1")]   # future day: inside
    + _days("2", 3, 9)                                    # exactly 9 active days
    + _days("10", 20, 10, drive="0", idle="600")          # exactly 10, idle hours only
    + [("3", "2024-01-05T00:00:00", "18", "0", "1.005"),  # x.xx5 rounding
       ("3", "2024-01-05T00:00:00", "5418", "n/a", "2.675"),  # second row, same day
       ("3", "2024-01-06T00:00:00", "", "", "x"),
       ("4", "2024-01-05T00:00:00", "0", "0", "0"),
       ("4", "2024-01-05T00:00:00", "7200", "1800", "3"),
       ("4", "2024-01-06T00:00:00", "3600", "0", "1"),     # two activity rows on one day:
       ("4", "2024-01-06T00:00:00", "0", "0", "1"),        # fuel of that day counts twice
       ("7", "2024-01-06T00:00:00", "17", "0", "1"),       # rounds to 0.0 -> inactive
       ("7", "2024-01-07T00:00:00", "NaN", "0", "1"),      # NaN text is no number
       ("7", "2024-01-08T00:00:00", "1e21", "0", "1e17"),  # too large to round
       ("7", "2024-01-09T00:00:00", "Infinity", "1", "x"),
       ("99", "2024-01-05T00:00:00", "3600", "0", "1")]    # device unknown
)


def _r(day, t, fuel, odo="10", volt="24.5", chassis="MHF001"):
    return (D(2024, 1, day), chassis, None if t is None else f"2024-01-{day:02d} {t}", fuel, odo, volt)


FUSO_FUEL_REPORTS = [
    # extract_date, chassis_number, _time, fuelAverage, odometer, raw_current_voltage
    _r(5, "10:00:00", "100"),
    _r(5, "10:29:59", "90"),                     # last of the 10:00 bucket
    _r(5, "10:30:00", "80"),
    _r(5, "10:59:59", "75", odo="12"),            # last of the 10:30 bucket, moved
    _r(5, "11:00:00", "25", odo="12"),            # drop of exactly 50: not counted
    _r(5, "11:30:00", "300", odo="12"),           # refuel; 300 is inside the range
    _r(5, "12:00:00", "251", odo="12"),           # drop of 49, no movement: idle
    _r(5, "12:30:00", "230", odo="x"),            # text odometer -> NULL -> idle
    _r(5, "13:00:00", "229.5", odo=None),         # rounds half up to 230
    _r(5, "13:30:00", "300.4"),                   # above range
    _r(5, "14:00:00", "-1"),                      # below range
    _r(5, "14:30:00", "20", volt="0"),            # dead sensor
    _r(5, "15:00:00", "20", volt="NaN"),          # NaN voltage
    _r(5, "15:30:00", "NaN"),                     # NaN fuel
    _r(6, "00:10:00", "228", odo="11"),           # next day: delta dated by this row
    _r(6, None, "50"),                            # NULL time: its own bucket
    _r(6, "00:20:00", "220", chassis=" mhf003 "),  # padded chassis, two devices
    _r(6, "00:40:00", "210", chassis=" mhf003 "),
    _r(5, "08:00:00", "5", chassis="MHF010"),
    _r(5, "08:30:00", "0", chassis="MHF010"),     # level exactly 0 is inside the range
    _r(5, "09:00:00", "60", chassis="MHF404"),    # chassis without device
    _r(5, "09:40:00", "55", chassis="MHF404"),
]

JD_EQUIPMENT = [
    # extract_date, serialNumber, _name, fleet_type, telematicsCapable, _type
    ("2024-02-01", "JD1", "Tractor 1", "TYPE-1", "true", "Machine"),
    ("2024-01-01", "JD1", "Old 1", "TYPE-1", "true", "Machine"),
    ("2024-02-01", "JD2", "Tractor 2", "TYPE-2", "false", "Machine"),  # capability filter first
    ("2024-01-01", "JD2", "Tractor 2 old", "TYPE-2", "true", "Machine"),
    ("2024-02-01", "JD3", "Sprayer", "TYPE-3", "true", "Attachment"),  # type filter after ranking
    ("2024-01-01", "JD3", "Sprayer old", "TYPE-3", "true", "Machine"),
    ("2024-02-01", "JD4", "Tractor 4", "type-1 ", "true", "Machine"),
]

JD_MEASUREMENT = [
    # serial_number, intervalEndDate, _name, idle, working, transport
    ("JD1", "2024-01-10", "Machine Utilization", 1800.0, 3600.0, None),
    ("JD1", "2024-01-10", "Machine Utilization", 0.1, 0.2, 5.0),
    ("JD1", "2024-01-10", "Fuel Consumed", 36.0, 72.0, None),
    ("JD1", "2024-01-10", "Fuel Consumed", 7.0, None, 3.0),
    ("JD1", "2024-01-11", "Fuel Consumed", 10.0, 20.0, 1.0),      # fuel, no utilization
    ("JD1", "2024-01-12", "Machine Utilization", 0.0, 0.0, 0.0),  # zero hours
    ("JD2", "2024-01-10", "Machine Utilization", 0.0, 0.18, None),  # rounds to 0 at 4 digits
    ("JD2", "2024-01-10", "Other", 5.0, 5.0, 5.0),
    ("JD4", "2024-01-09", "Machine Utilization", None, 3600.0, None),
    ("JD1", None, "Fuel Consumed", 3.0, 3.0, 3.0),                 # NULL day on both metrics:
    ("JD1", None, "Machine Utilization", 3600.0, 0.0, None),      # the flag join cannot match
]

LIUGONG_MACHINES = [
    # extract_date, serialNumber, productName, equipmentModel
    ("2024-02-01", "LG1", "Loader 1", "CLG856"),
    ("2024-01-01", "LG1", "Loader old", "CLG856"),
    ("2024-02-01", "lg2 ", "Loader 2", "CLG856 "),
    ("2024-02-01", "LG3", "Loader 3", "CLG835"),
    ("2024-02-01", "LG8", "Loader 8", "CLG835"),
]

LIUGONG_WORK_HOURS = [
    # overall_unit_sn, extract_date, working_hours, idle_hours, idle fuel, job fuel, total fuel
    ("LG1", "2024-01-10", "5", "1", "2", "10", "12"),
    ("LG1", "2024-01-10", "0", "0", "1", "1", "2"),     # two rows on one day: one flag for both
    ("LG1", "2024-01-11", "bad", "1", "x", "3", "4"),   # lenient / strict parses
    ("LG2", "2024-01-10", "2", "", "1", "2", "3"),      # matches 'lg2 ' only after UPPER(TRIM())
    ("LG9", "2024-01-10", "1", "1", "1", "1", "2"),     # no machine-list row
    ("LG8", "2024-01-10", "NaN", "0", "NaN", "1", "2"),  # NaN hours and litres
    ("LG8", "2024-01-11", "Infinity", "1", "1", "1", "2"),
    ("LG8", "2024-01-12", "1e17", "0", "1", "1", "2"),
    (None, "2024-01-12", "1", "0", "1", "1", "2"),       # NULL unit: no activity flag
]

CAT_ASSETS = [
    # asset_serial_number, model, extract_date, working h, idle h, total fuel
    ("SYW1", "D6", "2024-01-10", "6", "2", "40"),
    ("SYW1", "D6", "2024-01-11", "0", "0", "5"),       # zero hours: divide guard
    ("SYW1", "D6", "2024-01-12", "3", "", "9"),        # unparseable idle
    ("SYW1", "D6", "2023-12-01", "1", "1", "1"),       # outside the 30-day window
    ("SYW2", "d6 ", "2024-01-10", "1", "2", "7"),
    (None, "D8", "2024-01-10", "1", "1", "1"),          # NULL serial
    ("SYW2", "d6 ", "2024-01-11", "NaN", "1", "7"),     # NaN hours
    ("SYW2", "d6 ", "2024-01-12", "1e17", "1", "7"),
]

REGISTER = [
    # extract_date, class, location, description, equipment_number, serial, manufacture, model, number, user
    ("2024-02-01", "TRUCK", "LOC-1", "Dump truck", "DT-1", "MHF001", "MITSUBISHI", "FN-1", "1", " nursery"),
    ("2024-02-01", "TRUCK", "LOC-1", None, "DT-3", "mhf003", " mitsubishi ", "FN-3", "3", "Warehouse"),
    ("2024-02-01", "TRUCK", "LOC-2", "Tipper", "DT-7", "MHF007\t", "MITSUBISHI", None, "7", "VACANT"),
    ("2024-02-01", "TRUCK", "LOC-3", "Dump truck", "DT-50", "MHF050", "MITSUBISHI", "FN-9", "50", "vacant"),
    ("2024-02-01", "TRACTOR", "LOC-1", "Tractor", "TR-1", "JD1", "JOHN DEERE", "T1", "1", "r & d"),
    ("2024-02-01", "TRACTOR", "LOC-1", "Tractor", "TR-4", "jd4", "JOHN DEERE", "T4", "4", "0"),
    ("2024-02-01", "LOADER", "LOC-0", "Wheel loader", "WL-1", "LG1", "LIUGONG", "CLG856", "1", "civil "),
    ("2024-02-01", "LOADER", "LOC-0", "Wheel loader", "WL-2", "LG2", "LIUGONG", "CLG856", "2", "Breakdown/Accident"),
    ("2024-02-01", "DOZER", "LOC-1", "Dozer", "DZ-1", "X9-SYW1", "CAT", "D6", "1", "LC"),
    ("2024-02-01", "DOZER", "LOC-1", "Dozer", "DZ-2", "X9-SYW2", " cat ", "D6", "2", "LC"),
    ("2024-02-01", "DOZER", "LOC-1", "Dozer", "DZ-3", "NO-SERIAL", "CAT", "D6", "3", "LC"),
    ("2024-02-01", "DOZER", "LOC-1", "Dozer", "DZ-4", None, "CAT", "D6", "4", "LC"),
    ("2024-02-01", "EXCAVATOR", "LOC-2", "Excavator", "EX-1", "KM-1", "KOMATSU", "PC200", "1", "HSE"),
    ("2024-01-01", "STALE", "LOC-9", "Stale", "ST-1", "MHF001", "MITSUBISHI", "OLD", "1", "HSE"),
]

TABLES = {
    "fuso_devices": FUSO_DEVICES,
    "fuso_daily_summary": FUSO_DAILY_SUMMARY,
    "fuso_fuel_reports": FUSO_FUEL_REPORTS,
    "jd_equipment": JD_EQUIPMENT,
    "jd_measurement": JD_MEASUREMENT,
    "liugong_machines": LIUGONG_MACHINES,
    "liugong_work_hours": LIUGONG_WORK_HOURS,
    "cat_asset_utilization": CAT_ASSETS,
    "lark_fleet_master": REGISTER,
}
