import glob
import json

import pytest

import tessera as ts
from tessera.__main__ import arguments, run
from tessera.plans import cut

LINES = [
    "5310*;*(12.125, -7.0625, 'Bakery', '40', '8', 'Corner Bread')",
    "1*;*(40.5,-73.9,,,",
    "7*;*( 1.5 ,  2.5 , 'A')",
    "8*;*(1, 2, 'A*B')",
]
BAD = ["9*;", "10*;*(abc, 2)", "", "x*;*(1, 2)"]


def text(tmp_path, lines, name="in.txt"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_both_line_formats(spark, tmp_path):
    got = ts.read_points(spark, text(tmp_path, LINES)).collect()
    assert [(r.id, r.x, r.y) for r in got] == [
        (5310, 12.125, -7.0625),
        (1, 40.5, -73.9),
        (7, 1.5, 2.5),
        (8, 1.0, 2.0),
    ]
    assert got[0].attrs == [" 'Bakery'", " '40'", " '8'", " 'Corner Bread'"]


def test_bad_lines(spark, tmp_path):
    path = text(tmp_path, LINES + BAD)
    assert ts.read_points(spark, path, "drop").count() == 4
    kept = ts.read_points(spark, path, "keep").collect()
    assert len(kept) == 8 and all(r.x is None and r.y is None for r in kept[4:])
    bad = ts.read_points(spark, path)
    for act in (bad.collect, bad.count, bad.select("id").collect, bad.select("y").collect):
        with pytest.raises(Exception, match="not a point: "):
            act()
    with pytest.raises(ValueError):
        ts.read_points(spark, path, "ignore")


def test_string_ids_and_file_order(spark, tmp_path):
    text(tmp_path, ["a*;*(1,1)", "b*;*(2,2)"], "1.txt")
    text(tmp_path, ["a*;*(5,5)", "a*;*(0,0)"], "2.txt")
    df = ts.read_points(spark, str(tmp_path), id_type="string", with_position=True)
    last = ts.dedup_last(df.select("id", "x", "y", "pos"), "id", ["pos"])
    assert {(r.id, r.x) for r in last.collect()} == {("a", 0.0), ("b", 2.0)}


def test_points_round_trip(spark, points, tmp_path):
    data = [(1, 0.1, -2.5e-9), (2, 1e20, 3.0)]
    ts.write_points(points(data), str(tmp_path / "out"))
    got = ts.read_points(spark, str(tmp_path / "out")).select("id", "x", "y")
    assert sorted(map(tuple, got.collect())) == data


def test_neighbour_sinks(spark, points, tmp_path):
    found = ts.knn_exact(points([(1, 0.0, 0.0), (2, 3.0, 4.0), (3, 6.0, 8.0)]), k=2)
    path = ts.write_neighbours(found, str(tmp_path / "lists"), "json")
    records = [json.loads(line) for f in glob.glob(f"{path}/*.json") for line in open(f)]
    near = {r["src"]: [(n["dst"], n["dist"]) for n in r["neighbours"]] for r in records}
    assert near[1] == [(2, 5.0), (3, 10.0)] and near[2] == [(1, 5.0)]
    path = ts.write_neighbours(found, str(tmp_path / "plain"), "text")
    lines = [line.strip() for f in glob.glob(f"{path}/*.txt") for line in open(f)]
    assert "(1,[(2,5.0), (3,10.0)])" in lines and len(lines) == 3
    ts.write_report(found, str(tmp_path / "report"))
    whole = "".join(open(f).read() for f in glob.glob(f"{tmp_path}/report/*.txt"))
    assert (
        "SourceID:1\nNeighbourID:2+++NeighbourDistance5.0\nNeighbourID:3+++NeighbourDistance10.0\n"
        in whole
    )
    with pytest.raises(ValueError):
        ts.write_neighbours(found, str(tmp_path / "x"), "xml")


def test_command_line(spark, tmp_path):
    lines = [f"{i}*;*({i % 10}.5, {i // 10}.25, 'x')" for i in range(100)]
    path = text(tmp_path, lines + ["5*;*(0.0, 0.0, 'moved')"])

    def go(*args):
        run(spark, arguments().parse_args(args))

    go("exact", path, str(tmp_path / "exact"), "--format", "parquet")
    assert spark.read.parquet(glob.glob(f"{tmp_path}/exact*")[0]).count() == 100
    go("ring", path, str(tmp_path / "ring"), "-k", "3", "--format", "json")
    assert spark.read.json(glob.glob(f"{tmp_path}/ring*")[0]).count() > 50
    go("brute", path, str(tmp_path / "brute"), "--axes", "x", "--keep-self")
    assert spark.read.text(str(tmp_path / "brute")).where("value like 'SourceID%'").count() == 100
    go("exact", path, str(tmp_path / "both"), "--targets", text(tmp_path, lines[:3], "s.txt"), "--format", "json")
    assert spark.read.json(glob.glob(f"{tmp_path}/both*")[0]).select("neighbours.dst").distinct().count() <= 100
    go("radius", path, str(tmp_path / "radius"), "--radius", "0.5")
    assert spark.read.parquet(str(tmp_path / "radius")).count() == 100 - 1 + 1
    go("upsample", path, str(tmp_path / "grown"), "--factor", "2")
    assert ts.read_points(spark, str(tmp_path / "grown")).count() == 200


def test_cuts_go_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert cut.folder(spark) == shared
    table = cut.written(spark.range(3), "try")
    assert table.count() == 3 and shared in table.inputFiles()[0]
    with ts.Tables() as own:
        other = cut.written(spark.range(4), "other")
    own.release(spark)
    assert table.count() == 3 and not glob.glob(f"{shared}/tessera-other-*") and other is not None
    cut.release(spark)
    assert not glob.glob(f"{shared}/tessera-try-*")
