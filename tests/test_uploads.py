"""CSV uploads: scan, numbering, parsing, markers and progress."""

import json

import pytest
from pyspark.sql import functions as F

from tripweave.operators import uploads
from tripweave.sources.uploads import read_uploads, upload_files

HEADER = "region,origin_coord,destination_coord,datetime,datasource"
GOOD = "Prague,POINT (14.49 50.0),POINT (14.43 50.04),2018-05-28 09:03:40,funny_car"


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([*lines, ""]), encoding="utf-8")
    return str(folder)


def test_bad_rows_keep_their_number_and_get_a_reason(spark, tmp_path):
    path = write(
        tmp_path / "in",
        "a.csv",
        HEADER,
        GOOD,
        "Prague,POINT (200 95),POINT (14.43 50.04),2018-05-28 09:03:40,funny_car",
        "Prague,POINT (1 2 3),POINT (14.43 50.04),2018-05-28 09:03:40,funny_car",
        "Prague,POINT (14.49 50.0)",
        "Prague,POINT (14.49 50.0),POINT (14.43 50.04),yesterday,funny_car",
        '" The ""old"" town, north ",point(14.49 50.0),POINT (14.43 50.04),2018-05-28T09:03:40+02:00,x',
        GOOD + ",one,too,many",
    )
    rows = uploads.assign_ingestions(read_uploads(spark, path), "load")
    parsed = {r.row_number: r for r in uploads.parse_trips(rows).collect()}
    assert {n: r.reject_reason for n, r in parsed.items()} == {
        1: None,
        2: "coordinate_out_of_range",
        3: "bad_point",
        4: "missing_field",
        5: "bad_datetime",
        6: None,
        7: None,
    }
    assert parsed[6].region == ' The "old" town, north '
    assert parsed[6].datetime == "2018-05-28T07:03:40Z"
    assert parsed[1].trip_id == parsed[7].trip_id and len(parsed[1].trip_id) == 64


def test_numbers_run_through_files_split_over_many_tasks(spark, tmp_path):
    folder = tmp_path / "many"
    sizes = {"a.csv": 3000, "b.csv": 1, "c.csv": 700}
    for name, size in sizes.items():
        write(folder, name, HEADER, *(GOOD.replace("Prague", f"r{i}") for i in range(1, size + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_uploads(spark, str(folder))
        assert rows.rdd.getNumPartitions() > 5
        got = rows.select("upload_file", "row_number", "region").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == sum(sizes.values())
    for name, size in sizes.items():
        mine = [r for r in got if r.upload_file.endswith(name)]
        assert sorted(r.row_number for r in mine) == list(range(1, size + 1))
        assert all(r.region == f"r{r.row_number}" for r in mine)


def test_columns_go_by_header_name_and_a_missing_one_rejects(spark, tmp_path):
    shuffled = write(
        tmp_path / "shuffled",
        "a.csv",
        "datasource,region,extra,datetime,destination_coord,origin_coord",
        "src,Prague,?,2018-05-28,POINT (1 2),POINT (3 4)",
    )
    row = uploads.parse_trips(read_uploads(spark, shuffled)).first()
    assert (row.region, row.datasource, row.origin_lon, row.reject_reason) == ("Prague", "src", 3.0, None)
    short = write(tmp_path / "short", "a.csv", "region,datasource", "Prague,src")
    assert uploads.parse_trips(read_uploads(spark, short)).first().reject_reason == "missing_field"


def test_each_file_has_its_own_header(spark, tmp_path):
    folder = tmp_path / "mixed"
    write(folder, "a.csv", HEADER, GOOD, "", '"a ""b"", c",POINT (1 2),,2018-05-28,""')
    write(folder, "b.csv", "\ufeffdatasource, region ,extra,datetime,destination_coord,origin_coord", "src,Turin,?,2018-05-29,POINT (1 2),POINT (3 4)", "only")
    path = write(folder, "c.csv", "region,datasource", "Brno,x")
    rows = read_uploads(spark, path)
    got = {(r.upload_file.rsplit("/", 1)[1], r.row_number): r for r in rows.collect()}
    assert set(got) == {("a.csv", 1), ("a.csv", 2), ("b.csv", 1), ("b.csv", 2), ("c.csv", 1)}
    assert got["a.csv", 1].region == "Prague" and got["a.csv", 1].datasource == "funny_car"
    quoted = got["a.csv", 2]
    assert (quoted.region, quoted.destination_coord, quoted.datasource) == ('a "b", c', None, "")
    other = got["b.csv", 1]
    assert (other.region, other.datasource, other.origin_coord, other.datetime) == ("Turin", "src", "POINT (3 4)", "2018-05-29")
    assert (got["b.csv", 2].datasource, got["b.csv", 2].region) == ("only", None)
    assert (got["c.csv", 1].region, got["c.csv", 1].origin_coord) == ("Brno", None)


def test_a_long_quoted_field_is_read_whole(spark, tmp_path):
    long = 'x ""y"", ' * 20_000
    path = write(tmp_path / "long", "a.csv", HEADER, f'"{long}",POINT (1 2),POINT (1 2),2018-05-28,s')
    row = read_uploads(spark, path).first()
    assert row.region == long.replace('""', '"') and row.datasource == "s"


def test_quoted_line_breaks_when_asked_for(spark, tmp_path):
    path = write(tmp_path / "lines", "a.csv", HEADER, GOOD.replace("Prague", '"two\nlines"'), GOOD)
    rows = read_uploads(spark, path, multi_line=True).orderBy("row_number").collect()
    assert [(r.row_number, r.region) for r in rows] == [(1, "two\nlines"), (2, "Prague")]


def test_quoted_breaks_in_files_cut_anywhere(spark, tmp_path):
    """Against Python's reader, over many small blocks, each file with its own header."""
    import csv
    import random

    rng = random.Random(5)
    folder = tmp_path / "cut"
    folder.mkdir()
    columns = ["region", "origin_coord", "destination_coord", "datetime", "datasource"]
    expected = {}
    for number in range(3):
        order = columns[:]
        rng.shuffle(order)
        rows = []
        for i in range(400):
            text = rng.choice(["plain", "a,b", 'say ""', "two\nlines", '\n\n"x"\n', "", "end\n", " \n ,\n", "é\u2028ü", "cr\r\nlf"])
            rows.append({"region": f"{text}{i}" if text or i % 3 else "", "origin_coord": f"POINT ({i} 1)", "datasource": rng.choice(["s", 's"q"', "t\n\nu"])} | {"destination_coord": "d" * rng.randrange(30), "datetime": "2018"})
        with open(folder / f"{number}.csv", "w", newline="", encoding="utf-8") as file:
            out = csv.DictWriter(file, order, lineterminator=rng.choice(["\n", "\r\n"]))
            out.writeheader()
            for at, row in enumerate(rows):
                out.writerow(row)
                if at % 50 == 0:
                    file.write("\n")
        expected[f"{number}.csv"] = rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "701")
    try:
        read = read_uploads(spark, str(folder), multi_line=True)
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 60
        got = {}
        for r in read.collect():
            own = got.setdefault(r.upload_file.rsplit("/", 1)[1], {})
            assert r.row_number not in own
            own[r.row_number] = {c: r[c] or "" for c in columns}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, rows in expected.items():
        assert [got[name][i] for i in sorted(got[name])] == rows
        assert sorted(got[name]) == list(range(1, len(rows) + 1))


def test_an_empty_first_field_moves_nothing(spark, tmp_path):
    path = write(tmp_path / "first", "a.csv", HEADER, GOOD.replace("Prague", ""), ",,,,")
    rows = read_uploads(spark, path).orderBy("row_number").collect()
    assert rows[0].region is None and rows[0].origin_coord == GOOD.split(",")[1]
    assert [rows[1][c] for c in HEADER.split(",")] == [None] * 5


def test_open_quotes_at_the_end_are_one_row(spark, tmp_path):
    path = write(tmp_path / "open", "a.csv", HEADER, GOOD, '"never,closed', "second line")
    for multi_line, rows in ((True, 2), (False, 3)):
        assert read_uploads(spark, path, multi_line).count() == rows


def test_two_scans_and_no_text_by_file(spark, tmp_path, plan_of):
    path = write(tmp_path / "plan", "a.csv", HEADER, GOOD)
    df = read_uploads(spark, path)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan text") == 2


def test_every_file_gets_one_marker_also_without_rows(spark, tmp_path):
    write(tmp_path / "up", "a.csv", HEADER, GOOD, "bad,row", GOOD)
    path = write(tmp_path / "up", "b.csv", HEADER)
    files = uploads.assign_ingestions(upload_files(spark, path), "load")
    rows = uploads.assign_ingestions(read_uploads(spark, path), "load")
    trips = uploads.accepted(uploads.parse_trips(rows))
    events = uploads.to_events(trips, files, F.lit("2024-01-01").cast("timestamp")).collect()
    values = [json.loads(e.value) for e in events]
    ends = {v["ingestion_id"]: v for v in values if v.get("record_type") == "ingestion_end"}
    assert sorted(v["total_rows"] for v in ends.values()) == [0, 2]
    assert all(set(v) == {"record_type", "ingestion_id", "control_id", "total_rows"} for v in ends.values())
    assert all(v["control_id"] == v["ingestion_id"] + ":end" for v in ends.values())
    sent = [v for v in values if "record_type" not in v]
    assert [v["row_number"] for v in sorted(sent, key=lambda v: v["row_number"])] == [1, 3]
    assert all(e.key == json.loads(e.value)["ingestion_id"] for e in events)


@pytest.mark.parametrize("chunk", [10, 250, 100_000])
def test_progress_equals_a_running_count(spark, chunk):
    sent = [("big", n) for n in range(1, 1501) if n % 7] + [("small", n) for n in range(1, 60)]
    trips = spark.createDataFrame(sent, "ingestion_id string, row_number int")
    got = uploads.sent_progress(trips, step=100, chunk=chunk).collect()
    total = sum(1 for name, _ in sent if name == "big")
    assert sorted(r.rows for r in got) == list(range(100, total + 1, 100))
    assert {r.ingestion_id for r in got} == {"big"}
