"""GeoParquet sink (SK2) as a Python Data Source.

Spark's own Parquet writer cannot put the ``geo`` key into the file footer,
so this sink writes each task's Arrow batches with ``pyarrow.parquet``:
zstd level 9, millisecond UTC timestamps, the point column tagged as a
geoarrow point, sorting columns recorded, and the ``geo`` metadata.

Layout of a published table:

  <root>/files/job=<job>/month=<YYYY-MM-01>/part-<task>-<attempt>.parquet
  <root>/index/month=<YYYY-MM-01>/<number>-<job>.json

Data files are never moved or written over. What a month holds is said by the
highest numbered index file of the month alone: a line per data file with its
rows, bounding box and time range, for the files of the successful task
attempts, as Spark's write hands them to ``commit``. Adding that one small file
is the switch: a write that fails, at whatever point, leaves each month as it
was or as it will be, and files of failed or losing attempts are in no index.
``sweep`` removes what no index names once it is old enough.

The boxes let a reader skip files (``sources.readers.read_published``).
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# executors get the writer by value; they need no copy of this package
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover
    pass

# GeoParquet metadata for a WGS 84 lon/lat point column.
GEOPARQUET_VERSION = "1.1.0"
WGS84_PROJJSON = {
    "$schema": "https://proj.org/schemas/v0.7/projjson.schema.json",
    "type": "GeographicCRS",
    "name": "WGS 84",
    "datum_ensemble": {
        "name": "World Geodetic System 1984 ensemble",
        "ellipsoid": {"name": "WGS 84", "semi_major_axis": 6378137, "inverse_flattening": 298.257223563},
        "accuracy": "2.0",
        "id": {"authority": "EPSG", "code": 6326},
    },
    "coordinate_system": {
        "subtype": "ellipsoidal",
        "axis": [
            {"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"},
            {"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"},
        ],
    },
    "id": {"authority": "EPSG", "code": 4326},
}


def geo_metadata(geometry: str = "geometry") -> dict:
    col = {"encoding": "point", "crs": WGS84_PROJJSON, "geometry_types": ["Point"]}
    return {"version": GEOPARQUET_VERSION, "schema_version": GEOPARQUET_VERSION, "primary_column": geometry, "columns": {geometry: col}}


INDEX_SCHEMA = "month date, file string, n_rows long, x_min double, y_min double, x_max double, y_max double, ts_min timestamp, ts_max timestamp"
SWEEP_AGE_S = 24 * 3600


@dataclass
class FileEntry:
    """A data file and what it covers; no box if it has no location."""

    month: str
    file: str  # below <root>/files
    n_rows: int = 0
    box: list = field(default_factory=list)
    times: list = field(default_factory=list)

    def add(self, table, geometry: str, ts: str) -> None:
        import pyarrow.compute as pc

        self.n_rows += table.num_rows
        xy = table.column(geometry).combine_chunks()
        here = []
        for c in ("x", "y"):
            v = pc.struct_field(xy, c)
            low_high = pc.min_max(v.filter(pc.is_finite(v)))
            here += [low_high["min"].as_py(), low_high["max"].as_py()]
        if None not in here:
            x0, x1, y0, y1 = here
            b = self.box or [x0, y0, x1, y1]
            self.box = [min(b[0], x0), min(b[1], y0), max(b[2], x1), max(b[3], y1)]
        if ts in table.column_names:
            low_high = pc.min_max(table.column(ts))
            if low_high["min"].is_valid:
                both = [low_high["min"].as_py(), low_high["max"].as_py()]
                t = self.times or both
                self.times = [min(t[0], both[0]), max(t[1], both[1])]

    def line(self) -> str:
        box = dict(zip(("x_min", "y_min", "x_max", "y_max"), self.box))
        times = {k: t.isoformat() for k, t in zip(("ts_min", "ts_max"), self.times)}
        return json.dumps({"file": self.file, "n_rows": self.n_rows, **box, **times})


@dataclass
class FilesWritten(WriterCommitMessage):
    files: list


def _fs(root: str):
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(root)


def _to_published_arrow(table, geometry: str, partition_col: str):
    import pyarrow as pa
    import pyarrow.compute as pc

    cols, fields = [], []
    for field in table.schema:
        name = field.name
        if name == partition_col:
            continue
        arr = table.column(name)
        if name == geometry:
            # a missing location is an empty point (NaN, NaN), not a null
            x = pc.fill_null(pc.struct_field(arr, "x"), float("nan"))
            y = pc.fill_null(pc.struct_field(arr, "y"), float("nan"))
            arr = pa.StructArray.from_arrays(
                [x.combine_chunks() if hasattr(x, "combine_chunks") else x, y.combine_chunks() if hasattr(y, "combine_chunks") else y],
                fields=[pa.field("x", pa.float64(), nullable=False), pa.field("y", pa.float64(), nullable=False)],
            )
            meta = {
                b"ARROW:extension:name": b"geoarrow.point",
                b"ARROW:extension:metadata": json.dumps({"crs": WGS84_PROJJSON}).encode(),
            }
            field = pa.field(name, arr.type, nullable=True, metadata=meta)
        elif pa.types.is_timestamp(field.type):
            arr = pc.cast(arr, pa.timestamp("ms", tz="UTC"), safe=False)
            field = pa.field(name, arr.type)
        cols.append(arr)
        fields.append(field)
    schema = pa.schema(fields, metadata={b"geo": json.dumps(geo_metadata(geometry)).encode()})
    return pa.Table.from_arrays([c if not hasattr(c, "chunks") else c.combine_chunks() for c in cols], schema=schema)


#: rows of a month that a task holds until they are a row group
ROW_GROUP_ROWS = 1 << 17


class GeoParquetWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.geometry = options.get("geometry", "geometry")
        self.ts = options.get("timestamp", "data_collection_log_timestamp")
        self.partition_col = options.get("partition", "month")
        self.sort = [c for c in options.get("sort", "").split(",") if c]
        self.level = int(options.get("compression_level", "9"))
        self.job = uuid.uuid4().hex  # made on the driver, one for all tasks

    def write(self, iterator) -> FilesWritten:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}.parquet"  # attempts never share a name
        fs, base = _fs(self.root)
        writers: dict = {}
        waiting: dict = {}
        entries: dict[str, FileEntry] = {}

        def flush(value) -> None:
            tables = waiting.pop(value, [])
            if tables:
                table = pa.concat_tables(tables).combine_chunks()
                writers[value].write_table(table, row_group_size=ROW_GROUP_ROWS)
                entries[value].add(table, self.geometry, self.ts)

        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch])
                if table.num_rows == 0:
                    continue
                keys = table.column(self.partition_col)
                for value in keys.unique().to_pylist():
                    sub = table.filter(pa.compute.equal(keys, pa.scalar(value, keys.type)))
                    out = _to_published_arrow(sub, self.geometry, self.partition_col)
                    if value not in writers:
                        folder = f"job={self.job}/{self.partition_col}={value}"
                        fs.create_dir(f"{base}/files/{folder}", recursive=True)
                        sorting = [pq.SortingColumn(out.schema.get_field_index(c)) for c in self.sort if c in out.schema.names]
                        writers[value] = pq.ParquetWriter(
                            f"{base}/files/{folder}/{name}",
                            out.schema,
                            filesystem=fs,
                            compression="zstd",
                            compression_level=self.level,
                            sorting_columns=sorting or None,
                        )
                        entries[value] = FileEntry(str(value), f"{folder}/{name}")
                    waiting.setdefault(value, []).append(out)
                    if sum(t.num_rows for t in waiting[value]) >= ROW_GROUP_ROWS:
                        flush(value)
            for value in list(waiting):
                flush(value)
        finally:
            for w in writers.values():
                w.close()
        return FilesWritten(files=list(entries.values()))

    def commit(self, messages) -> None:
        """Switch every month written to its new files, a month at a time."""
        fs, base = _fs(self.root)
        months: dict[str, list[FileEntry]] = {}
        for entry in (e for m in messages if m is not None for e in m.files):
            months.setdefault(entry.month, []).append(entry)
        for month, entries in sorted(months.items()):
            lines = "".join(e.line() + "\n" for e in sorted(entries, key=lambda e: e.file.rsplit("/", 1)[1]))
            switch_month(fs, f"{base}/index/{self.partition_col}={month}", lines, self.job)

    def abort(self, messages) -> None:
        """Nothing to undo: what no index names is not published. Nor are files
        removed here: tasks that are being ended may still write, and a commit
        that broke off may have switched some months to this job's files."""


def _listed(fs, folder: str) -> list:
    import pyarrow.fs as pafs

    return fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))


def switch_month(fs, folder: str, lines: str, job: str) -> None:
    """Add the index file that says what the month holds from now on. It is
    written under a name readers skip and renamed, so it is never seen in part."""
    numbers = [int(i.base_name.split("-")[0]) for i in _listed(fs, folder) if i.base_name[0].isdigit()]
    name = f"{max(numbers, default=0) + 1:012d}-{job}.json"
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/_{name}") as out:
        out.write(lines.encode())
    fs.move(f"{folder}/_{name}", f"{folder}/{name}")


def sweep(root: str, age_s: float = SWEEP_AGE_S) -> list[str]:
    """Remove what is older than ``age_s`` and of no use to any reader: index
    files below the highest of their month, then jobs' files that no index
    names. Returns the paths removed."""
    fs, base = _fs(root.rstrip("/"))
    now, named, removed = time.time(), set(), []

    def old(info) -> bool:
        return info.mtime is not None and now - info.mtime.timestamp() >= age_s

    for month in _listed(fs, f"{base}/index"):
        files = sorted(_listed(fs, month.path), key=lambda i: i.base_name)
        current = [i for i in files if i.base_name[0].isdigit()]
        for i in files:
            if old(i) and (i not in current[-1:]):
                fs.delete_file(i.path)
                removed.append(i.path)
            elif i in current:
                named |= {json.loads(line)["file"].split("/")[0] + "/" + month.base_name for line in fs.open_input_stream(i.path).read().decode().splitlines()}
    for job in _listed(fs, f"{base}/files"):
        months = _listed(fs, job.path)
        for m in months:
            if f"{job.base_name}/{m.base_name}" not in named and all(old(i) for i in _listed(fs, m.path)):
                fs.delete_dir(m.path)
                removed.append(m.path)
        if old(job) and not _listed(fs, job.path):
            fs.delete_dir(job.path)
    return removed


class GeoParquetDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "meterflow_geoparquet"

    def schema(self):
        raise NotImplementedError("write-only sink; read the files with spark.read.parquet")

    def writer(self, schema, overwrite: bool):
        return GeoParquetWriter(self.options)


def register(spark) -> None:
    spark.dataSource.register(GeoParquetDataSource)
