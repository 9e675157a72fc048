import json
import os

import pytest
from pyspark.errors import AnalysisException

from tests.conftest import rows
from watchfold.sources import files


def write_day(folder, day, records):
    with open(os.path.join(folder, f"{day}.json"), "w") as fh:
        for rec in records:
            fh.write(json.dumps(rec) + "\n")


def envelope(**source):
    return {"_index": "history", "_type": "kplus", "_id": "x", "_score": 0, "_source": source}


def test_day_paths_inclusive():
    assert files.day_paths("20220430", "20220502") == ["20220430", "20220501", "20220502"]
    assert len(files.day_paths("20220401", "20220430")) == 30


def test_watch_logs_one_scan_date_from_name(spark, tmp_path):
    folder = str(tmp_path)
    write_day(folder, "20220401", [envelope(Contract="C1", Mac="m1", AppName="VOD", TotalDuration=10)])
    # reordered and missing fields must not shift columns
    write_day(folder, "20220402", [{"_source": {"TotalDuration": 5, "AppName": "RELAX", "Contract": "C2"}}])
    df = files.read_watch_logs(spark, folder, "20220401", "20220402")
    assert df.columns == ["Contract", "Mac", "AppName", "TotalDuration", "log_date"]
    got = rows(df)
    import datetime as dt
    assert got == [("C1", "m1", "VOD", 10, dt.date(2022, 4, 1)),
                   ("C2", None, "RELAX", 5, dt.date(2022, 4, 2))]


def test_watch_logs_missing_day(spark, tmp_path):
    folder = str(tmp_path)
    write_day(folder, "20220401", [envelope(Contract="C1", Mac="m", AppName="VOD", TotalDuration=1)])
    write_day(folder, "20220403", [envelope(Contract="C1", Mac="m", AppName="VOD", TotalDuration=2)])
    with pytest.raises(AnalysisException):
        files.read_watch_logs(spark, folder, "20220401", "20220403").collect()
    skipped = files.read_watch_logs(spark, folder, "20220401", "20220403", missing="skip")
    assert sorted(r.TotalDuration for r in skipped.collect()) == [1, 2]


def test_search_logs_by_month_in_path(spark, tmp_path):
    base = tmp_path / "log_search"
    for month, day, users in [("202206", "20220601", ["u1", "u2"]), ("202206", "20220615", ["u3"]),
                              ("202207", "20220714", ["u4"])]:
        folder = base / month / day
        folder.mkdir(parents=True)
        spark.createDataFrame([(u, "kw", 1) for u in users], "user_id string, keyword string, extra int") \
            .coalesce(1).write.mode("overwrite").parquet(str(folder / "part"))
    june = files.read_search_logs(spark, str(base), ["202206"])
    assert rows(june) == [("u1", "kw", "202206"), ("u2", "kw", "202206"), ("u3", "kw", "202206")]
    both = files.read_search_logs(spark, str(base))
    assert sorted(r.month_yyyymm for r in both.collect()) == ["202206"] * 3 + ["202207"]
    none = files.read_search_logs(spark, str(base), ["209901"])
    assert none.count() == 0 and none.columns == ["user_id", "keyword", "month_yyyymm"]


def test_genre_mapping_roundtrip_and_export(spark, tmp_path):
    mapping = spark.createDataFrame([("a", "Drama"), ("b, c", "News")], "most_searched string, Genre string")
    path = str(tmp_path / "mapping_csv")
    files.write_genre_mapping(mapping, path)
    assert rows(files.read_genre_mapping(spark, path)) == [("a", "Drama"), ("b, c", "News")]
    prev = spark.createDataFrame([("u1", "a"), ("u2", "b")], "user_id string, most_searched string")
    curr = spark.createDataFrame([("u1", "a"), ("u3", "c")], "user_id string, most_searched string")
    out = str(tmp_path / "programs_csv")
    files.export_distinct_programs(prev, curr, out)
    back = spark.read.option("header", "true").csv(out)
    assert rows(back) == [("a",), ("b",), ("c",)]


def test_search_log_month_filter_prunes_files(spark, tmp_path):
    """A file of another month is never opened: a corrupt one there does no harm."""
    base = tmp_path / "log_search"
    good = base / "202206" / "20220601"
    good.mkdir(parents=True)
    spark.createDataFrame([("u1", "kw")], "user_id string, keyword string") \
        .coalesce(1).write.mode("overwrite").parquet(str(good / "part"))
    bad = base / "202208" / "20220801"
    bad.mkdir(parents=True)
    (bad / "broken.parquet").write_bytes(b"this is not parquet")
    assert rows(files.read_search_logs(spark, str(base), ["202206"])) == [("u1", "kw", "202206")]
    with pytest.raises(Exception):
        files.read_search_logs(spark, str(base)).collect()


def test_durations_fractional_quoted_and_malformed_lines(spark, tmp_path):
    with open(tmp_path / "20220401.json", "w") as fh:
        fh.write('{"_source": {"Contract": "C1", "TotalDuration": 12.5}}\n')
        fh.write('{"_source": {"Contract": "C2", "TotalDuration": "77"}}\n')
        fh.write('{"_source": {"Contract": "C3", "TotalDuration": "n/a"}}\n')
        fh.write('not json\n')
    read = files.read_watch_logs(spark, str(tmp_path), "20220401", "20220401")
    assert rows(read, "Contract", "TotalDuration") == [("C1", 12.5), ("C2", 77.0), ("C3", None)]
    counted = files.malformed_lines(spark, str(tmp_path), "20220401", "20220401").collect()[0]
    assert (counted.lines, counted.malformed) == (4, 2)


def test_file_of_two_months_is_read_for_both(spark, tmp_path):
    both = tmp_path / "log_search" / "202206" / "load_202207"
    both.parent.mkdir(parents=True)
    data = spark.createDataFrame([("u1", "kw")], "user_id string, keyword string").coalesce(1)
    data.write.parquet(str(both))
    got = files.read_search_logs(spark, str(tmp_path / "log_search"), ["202206", "202207"])
    assert rows(got) == [("u1", "kw", "202206"), ("u1", "kw", "202207")]


def test_csv_keeps_spaces_tabs_quotes_empty_and_line_breaks(spark, tmp_path):
    keys = [" vtv3 ", "\ttab", "", 'say ""hi""', 'one "two"', "line\nbreak", "a,b", "back\\slash"]
    mapping = spark.createDataFrame([(k, "Drama") for k in keys] + [("null genre", None)],
                                    "most_searched string, Genre string")
    files.write_genre_mapping(mapping, str(tmp_path / "csv"))
    assert rows(files.read_genre_mapping(spark, str(tmp_path / "csv"))) == rows(mapping)
    with open(tmp_path / "other.csv", "w") as fh:
        fh.write('most_searched,Genre\n"a ""quoted"" name",News\n')
    assert rows(files.read_genre_mapping(spark, str(tmp_path / "other.csv"))) == [('a "quoted" name', "News")]
