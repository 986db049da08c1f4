"""Late files and late repetitions in the de-duplicated stream (IN8)."""

import datetime as dt

from meterflow.streaming import ingest as ST

KEYS = [ST.TS, "feeder"]


def test_late_rows_stay_and_late_repetitions_go(spark, tmp_path):
    landing, out, chk = (str(tmp_path / n) for n in ("landing", "out", "chk"))
    kind = f"{ST.TS} timestamp_ntz, feeder string, kwh double"
    june, march = dt.datetime(2024, 6, 1), dt.datetime(2024, 3, 1)
    files = [
        [(june, "a", 1.0), (june, "b", 1.0), (june, "b", 1.0)],
        [(june + dt.timedelta(days=40), "a", 1.0)],
        [(march, "a", 1.0), (march, "b", 2.0), (None, "a", 1.0)],  # months behind
        [(june, "a", 1.0), (march, "b", 2.0), (march, "c", 3.0), (None, "a", 1.0)],  # repeats, far behind
    ]
    want = set()
    for rows in files:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(kind).parquet(landing)
        ST.dedupe_stream(stream, KEYS, out, chk)
        want |= set(rows)
        got = spark.read.parquet(out).select(ST.TS, "feeder", "kwh").collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_batches_of_one_run_and_keys_alone(spark, tmp_path):
    landing, out, chk = (str(tmp_path / n) for n in ("landing", "out", "chk"))
    kind = f"{ST.TS} timestamp_ntz, feeder string"
    days = [dt.datetime(2024, 6, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1), dt.datetime(2023, 12, 31)]
    for d in days:
        spark.createDataFrame([(d, "a")], kind).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(landing)
    ST.dedupe_stream(stream, KEYS, out, chk)
    assert sorted(r[ST.TS] for r in spark.read.parquet(out).collect()) == sorted(set(days))


def rows_of(spark, out):
    return sorted((r.feeder, r[ST.TS], r.kwh) for r in spark.read.parquet(out).select(ST.TS, "feeder", "kwh").collect())


def test_two_checkpoints_into_one_output(spark, tmp_path):
    """A second source, and a new checkpoint at the first one's place, lose nothing."""
    out, kind = str(tmp_path / "out"), f"{ST.TS} timestamp_ntz, feeder string, kwh double"
    first = [(dt.datetime(2024, 1, d), "a", 1.0) for d in range(1, 6)]
    runs = [("one", "c1", first), ("two", "c2", [(dt.datetime(2024, 1, 2), "b", 2.0), first[0]]), ("three", "c1-again", [(dt.datetime(2024, 1, 9), "c", 3.0)])]
    for landing, chk, rows in runs:
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / landing))
        ST.dedupe_stream(spark.readStream.schema(kind).parquet(str(tmp_path / landing)), KEYS, out, str(tmp_path / chk))
    assert rows_of(spark, out) == sorted({(f, t, k) for _, _, rows in runs for t, f, k in rows})


def test_a_batch_touches_its_days_alone_and_failures_are_made_good(spark, tmp_path, monkeypatch):
    landing, out, chk = (str(tmp_path / n) for n in ("landing", "out", "chk"))
    kind = f"{ST.TS} timestamp_ntz, feeder string, kwh double"
    day = lambda d: dt.datetime(2024, 5, d, 12)

    def bring(rows):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(landing)
        ST.dedupe_stream(spark.readStream.schema(kind).parquet(landing), KEYS, out, chk, compact_after=3)

    bring([(day(d), "a", 1.0) for d in (1, 2, 3)])
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").glob("__day=*/*.parquet")}
    bring([(day(2), "a", 1.0), (day(2), "b", 1.0)])
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").glob("__day=*/*.parquet")}
    assert {p.parent.name for p in files if after.get(p) != files[p]} == {"__day=2024-05-02"}

    real, calls = ST._write, []

    def broken(df, path, by):
        calls.append(path)
        if path == out:
            raise RuntimeError("lost before the output")
        real(df, path, by)

    monkeypatch.setattr(ST, "_write", broken)
    try:
        bring([(day(2), "c", 1.0)])
    except Exception as exc:
        assert "lost before the output" in str(exc)
    monkeypatch.undo()
    bring([(day(4), "a", 1.0)])  # the failed batch is retried first
    want = sorted([("a", day(d), 1.0) for d in (1, 2, 3, 4)] + [("b", day(2), 1.0), ("c", day(2), 1.0)])
    assert rows_of(spark, out) == want
    parts = {p.parent.name for p in (tmp_path / "out-landed" / "__day=2024-05-02").glob("*/epoch=*")}
    assert parts == {"source=compacted"}  # the day came in three parts
    bring([(day(2), "a", 1.0)])
    assert rows_of(spark, out) == want
