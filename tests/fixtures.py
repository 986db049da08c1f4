"""Generated raw inputs in the published column layouts, for made-up networks."""

from __future__ import annotations

import calendar
import csv
import gzip
import io
import os

from meterflow import schemas as S

#: (secondary substation, feeder); the whole id is 5310 024 <substation> <feeder>
SSEN_FEEDERS = [("417", "03"), ("417", "11"), ("862", "07"), ("950", "02")]
SSEN_TIMES = ["00:00", "04:30", "09:00", "17:30", "22:00"]
#: the last one leaves every text blank that the feed may leave blank
NGED_FEEDERS = [("771203", "4"), ("771203", "5"), ("508811", "1"), ("640022", "9")]
NGED_TIMES = ["04:30", "16:00"]
SSEN_PER_DAY, NGED_PER_DAY = len(SSEN_FEEDERS) * len(SSEN_TIMES), len(NGED_FEEDERS) * len(NGED_TIMES)


def write_csv(path: str, header: list[str], rows: list[dict]) -> str:
    buf = io.StringIO()
    w = csv.DictWriter(buf, header, restval="", extrasaction="ignore")
    w.writeheader()
    w.writerows(rows)
    with gzip.open(path, "wt") as f:
        f.write(buf.getvalue())
    return path


def ssen_rows(day: str, consumption: str = "641.5") -> list[dict]:
    return [
        {
            "dataset_id": f"5310024{sub}{feeder}", "dno_alias": "SSEN", "dno_name": "North Network",
            "secondary_substation_id": sub, "secondary_substation_name": f"Mill Lane {sub}", "lv_feeder_id": feeder,
            "aggregated_device_count_active": "7.5", "total_consumption_active_import": consumption,
            "primary_consumption_active_import": consumption, "data_collection_log_timestamp": f"{day}T{time}:00.000Z",
            "insert_time": f"{day}T23:10:00.000Z", "last_modified_time": f"{day}T23:40:00.000Z",
        }
        for time in SSEN_TIMES for sub, feeder in SSEN_FEEDERS
    ]


def ssen_daily_files(folder: str, year: int, month: int, days=None, consumption: str = "641.5") -> list[str]:
    os.makedirs(folder, exist_ok=True)
    names = [f"{year:04d}-{month:02d}-{d:02d}" for d in days or range(1, calendar.monthrange(year, month)[1] + 1)]
    return [write_csv(f"{folder}/{n}.csv.gz", S.SSEN_CSV_COLUMNS, ssen_rows(n, consumption)) for n in names]


def nged_row(sub: str, feeder: str, stamp: str) -> dict:
    row = {
        "dno_name": "South Network", "secondary_substation_id": sub, "LV_feeder_ID": feeder,
        "aggregated_device_count_Active": "22.4", "Primary_consumption_active_import": "1180.5",
        "Total_consumption_active_import": "1180.5", "data_collection_log_timestamp": f"{stamp}:00+00:00",
        "Insert_time": "2025-05-02 01:00:00+00:00", "last_modified_time": "2025-05-03 01:00:00+00:00",
        "substation_geo_location": ", ", "LV_feeder_name": " ",
    }
    if sub != NGED_FEEDERS[-1][0]:
        row |= {"dataset_id": f"S{sub}F{feeder}", "dno_alias": "NGED", "secondary_substation_name": f"Quay {sub}", "LV_feeder_name": f"Quay {feeder}", "substation_geo_location": "52.610004, -1.120007"}
    return row


def nged_part_files(folder: str, year: int, month: int, parts: int = 3, extra_next_month: bool = False) -> list[str]:
    os.makedirs(folder, exist_ok=True)
    days = [f"{year:04d}-{month:02d}-{d:02d}" for d in range(1, calendar.monthrange(year, month)[1] + 1)]
    rows = [nged_row(sub, feeder, f"{day} {time}") for day in days for time in NGED_TIMES for sub, feeder in NGED_FEEDERS]
    if extra_next_month:
        rows.append(nged_row(*NGED_FEEDERS[0], f"{year + month // 12:04d}-{month % 12 + 1:02d}-01 00:00"))
    size = -(-len(rows) // parts)
    return [
        write_csv(f"{folder}/aggregated-smart-meter-data-lv-feeder-{year:04d}-{month:02d}-part{i:04d}.csv.gz", S.NGED_CSV_COLUMNS, rows[i * size : (i + 1) * size])
        for i in range(parts)
    ]
