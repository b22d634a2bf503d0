"""Feed archives: nested members, text ids, undeclared columns and members, bad records, several archives."""

import zipfile

from cellscope.sources import archive, gtfs


def _archives(folder):
    folder.mkdir()
    with zipfile.ZipFile(folder / "a.zip", "w") as z:
        z.writestr("feed/stops.txt", "\ufeffstop_id, stop_lat,stop_lon,stop_name\nA1,-19.9,-43.9,\"Rua \"\"X\"\", 1\nsecond line\"\n00012,bad,-43.8,B\n\n7,1,2\n")
        z.writestr("feed/shapes.txt", "shape_id,n\ns1,1\n")
    with zipfile.ZipFile(folder / "b.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("stops.txt", "stop_lon,zone,stop_id\n-43.7,z9,00013\n-43.6,z9,00014,more\n")
        z.writestr("empty.txt", "")
    return str(folder)


def test_archives(spark, tmp_path):
    path = _archives(tmp_path / "feed.zips")
    assert [r[0] for r in gtfs.list_members(spark, path).collect()] == ["empty.txt", "feed/shapes.txt", "feed/stops.txt", "stops.txt"]
    found = gtfs.read_member(spark, path, "stops", keep_bad=True)
    assert found.columns == ["stop_id", "stop_lat", "stop_lon", "stop_name", "zone", "_bad"]
    assert found.rdd.getNumPartitions() == 2
    rows = sorted(map(tuple, found.collect()))
    assert rows == [("00012", None, -43.8, "B", None, "stop_lat"), ("00013", None, -43.7, None, "z9", None), ("00014", None, -43.6, None, "z9", "too long"),
                    ("7", 1.0, 2.0, None, None, "too short"), ("A1", -19.9, -43.9, 'Rua "X", 1\nsecond line', None, None)]
    feed = gtfs.read_feed(spark, path)
    assert set(feed) == {"stops", "shapes", "empty"} and feed["shapes"].collect()[0].asDict() == {"shape_id": "s1", "n": "1"} and feed["empty"].count() == 0
    assert {r["table"]: (r["records"], r["bad"]) for r in gtfs.bad_records(spark, path, ["stops", "shapes"]).collect()} == {"stops": (5, 3), "shapes": (1, 0)}
    single = str(tmp_path / "feed.zips" / "a.zip")
    assert gtfs.read_member(spark, single, "stops").count() == 3 and gtfs.read_member(spark, f"file://{single}", "stops").count() == 3


def test_folder_keeps_text_ids_and_names_bad_values(spark, tmp_path):
    (tmp_path / "stops.txt").write_text("stop_id,stop_lat,stop_lon\nA1,-19.9,-43.9\n00012,x,-43.8\n13,,1\n")
    rows = sorted(tuple(r) for r in gtfs.read_member(spark, str(tmp_path), "stops", keep_bad=True).collect())
    assert rows == [("00012", None, -43.8, "stop_lat"), ("13", None, 1.0, None), ("A1", -19.9, -43.9, None)]


def test_write_archives(spark, tmp_path):
    path = str(tmp_path / "out.zips")
    table = spark.range(1000, numPartitions=3).selectExpr("lpad(id, 6, '0') AS stop_id", "id / 7 AS stop_lat", "CASE WHEN id % 5 = 0 THEN NULL ELSE -id / 3 END AS stop_lon", "'a,\"b\"' AS note")
    archive.write_archive(table, path, "stops", "overwrite")
    archive.write_archive(table, path, "stops", "overwrite")
    assert len(archive.archives(path)) == 3
    assert sorted(map(tuple, gtfs.read_member(spark, path, "stops").collect())) == sorted(map(tuple, table.collect()))
    archive.write_archive(table.limit(1), path, "stops")
    assert gtfs.read_member(spark, path, "stops").count() == 1001
    archive.write_archive(table.where("false"), str(tmp_path / "none.zips"), "stops")
    assert gtfs.read_member(spark, str(tmp_path / "none.zips"), "stops").count() == 0
