"""Landing and header reading hold no file in a worker's memory."""

import csv
import gzip
import os

from meterflow.sources import csvfiles as CSV
from meterflow.sources import testdata as TD


def test_files_are_landed_in_pieces_of_several_tasks(spark, tmp_path, monkeypatch):
    def whole_files(*_):
        raise AssertionError("a file's rows meet in one worker")

    monkeypatch.setattr(type(spark.range(1).groupBy("id")), "applyInArrow", whole_files)
    monkeypatch.setattr(TD, "OPEN_FILES", 2)
    values = ["plain", " spaced ", "", None, 'say "x", y', "back\\slash", "ünï"]
    rows = [(f"{i % 5}.csv" + (".gz" if i % 2 else ""), values[i % 7], str(i)) for i in range(2000)]
    TD.land_csv(spark.createDataFrame(rows, "source_file string, a string, b string").repartition(4), str(tmp_path / "out"))
    assert os.listdir(tmp_path) == ["out"]
    got = []
    for name in os.listdir(tmp_path / "out"):
        with (gzip.open if name.endswith(".gz") else open)(tmp_path / "out" / name, "rt", encoding="utf-8", newline="") as f:
            got += [(name, r["a"], r["b"]) for r in csv.DictReader(f)]
    assert sorted(got) == sorted((n, a or "", b) for n, a, b in rows)


def test_an_ordered_file_keeps_its_order_and_nulls_come_last(spark, tmp_path):
    rows = [("f.csv", str(i), None if i == 7 else i) for i in range(1000)]
    TD.land_csv(spark.createDataFrame(rows, "file string, a string, nr long").repartition(6), str(tmp_path / "out"), "file", order="nr")
    lines = (tmp_path / "out" / "f.csv").read_text().splitlines()
    assert lines == ["a", *(str(i) for i in range(1000) if i != 7), "7"]


def test_headers_are_read_without_sending_lines_to_python(spark, tmp_path, monkeypatch):
    (tmp_path / "one.csv").write_text("a,b\n" + "1,2\n" * 1000)
    (tmp_path / "two.csv").write_text("b,a\n3,4\n")

    def python(*_):
        raise AssertionError("every line of a file goes to a Python worker")

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", python)
    assert [(f.rsplit("/", 1)[1], line) for f, line in CSV.file_headers(spark, str(tmp_path))] == [("one.csv", "a,b"), ("two.csv", "b,a")]


def test_landing_functions_go_to_workers_by_value():
    """Executors need no copy of this package to land files."""
    import pickle
    import pickletools

    from pyspark import cloudpickle

    sent = cloudpickle.dumps(TD._by_name)
    named = {arg for _, arg, _ in pickletools.genops(sent) if isinstance(arg, str)}
    assert pickle.loads(sent) is not TD._by_name and "np" in named  # its code and globals, not its name alone
