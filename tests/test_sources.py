import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspan.sources import images, manifests, sinks


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_plate_manifest(spark, tmp_path):
    path = put(tmp_path / "m.tsv", "plate\tchannels\tbp_channels\tcp_nucl_channel\np1\t1,2,3\t2\t1\np10\tnone\t3,1\tnone\n")
    got = {r["plate"]: r for r in manifests.plate_manifest(spark, path).collect()}
    assert got["p1"]["channels"] == [0, 1, 2] and got["p1"]["cp_nucl_channel"] == 0 and got["p1"]["dc_psfs"] is None
    assert got["p10"]["channels"] is None and got["p10"]["cp_nucl_channel"] is None
    flat = manifests.flatfield_channels(manifests.plate_manifest(spark, path))
    assert sorted((r["plate"], r["channel"]) for r in flat.collect()) == [("p1", 1), ("p10", 0), ("p10", 2)]


def test_wells_and_lists(spark, tmp_path):
    wells = put(tmp_path / "w.tsv", "A01\tA\t1\tp1\tx\nP24\t\t\tp1\tx\n")
    got = {r["well"]: r for r in manifests.well_manifest(spark, wells).collect()}
    assert got["P24"]["row"] == "P" and got["P24"]["relpath"] == "p1/P/24" and got["A01"]["key"] == "p1:A01"
    deny = manifests.well_list(spark, put(tmp_path / "b.tsv", "p1\tA01\n"))
    assert [r["key"] for r in deny.collect()] == ["p1:A01"]
    bad = put(tmp_path / "bad.tsv", "\tA\t1\tp1\tx\n")
    with pytest.raises(Exception, match="mandatory"):
        manifests.well_manifest(spark, bad).collect()


def test_registration_and_controls(spark, tmp_path):
    path = put(tmp_path / "r.tsv", "reference_plate\treference_channel\tquery_plates\tquery_channels\nr\t1\ta,b\t2,3\n")
    reg = manifests.registration_manifest(spark, path)
    row = reg.collect()[0]
    assert row["ref_channel"] == 0 and [tuple(q) for q in row["qry"]] == [("a", 1), ("b", 2)]
    assert sorted(tuple(r) for r in manifests.plate_pairs(reg).collect()) == [("a", "r"), ("b", "r"), ("r", "r")]
    control = manifests.control_list(spark, put(tmp_path / "c.tsv", "plate\twell\tchannels\tname\np\tA01\t1,2\tdmso\n"))
    assert sorted(r["channel"] for r in control.collect()) == [1, 2]


def test_key_value_line_and_roundtrip(spark, tmp_path):
    path = put(tmp_path / "s.txt", "p1_ch0=0.5 p1_ch1=1\n")
    assert {r["key"]: r["value"] for r in manifests.key_value_line(spark, path).collect()} == {"p1_ch0": 0.5, "p1_ch1": 1.0}
    assert manifests.key_value_line(spark, str(tmp_path / "none.txt")).count() == 0
    factors = spark.createDataFrame([("p1", 1, 1.0), ("p1", 0, 0.5)], "plate string, channel int, factor double")
    assert sinks.scaling_line(factors).collect()[0]["line"] == "p1_ch0=0.5 p1_ch1=1.0"


def test_statistics_index_and_files(spark, tmp_path):
    for p, v in (("p1/A/1", 3), ("p2/B/2", 4)):
        put(tmp_path / "stats" / p / "intensity_stats.tsv", f"plate\tq50\n{p[:2]}\t{v}\n")
    assert {r["plate"]: r["q50"] for r in manifests.statistics(spark, str(tmp_path / "stats")).collect()} == {"p1": 3, "p2": 4}
    assert sorted(r["plate"] for r in manifests.plates_of_folder(spark, str(tmp_path / "stats")).collect()) == ["p1", "p2"]
    assert len({r["md5"] for r in manifests.file_digests(spark, str(tmp_path / "stats")).collect()}) == 2
    index = put(tmp_path / "i.json", '{"plate":{"name":"p"},"wells":[{"id":"0101","row":1,"col":1,"images":[{"field":1,"channel":"1","time_abs":"2024-01-01T00:00:00+02:00","position":{"x":{"value":1.5},"y":{"value":2.0},"z":{"value":0.0}}}]},{"id":"0102","row":1,"col":2,"images":[]}]}')
    row = manifests.vendor_index_json(spark, index).collect()
    assert len(row) == 1 and row[0]["x"] == 1.5 and row[0]["time_abs"].hour in (22, 0)
    xml = put(tmp_path / "i.xml", "<Root><Images><Image><Row>1</Row><Col>2</Col></Image><Image><Row>3</Row><Col>4</Col></Image></Images></Root>")
    assert sorted(r["Row"] for r in manifests.vendor_index_xml(spark, xml).collect()) == [1, 3]


def test_names(spark):
    files = spark.createDataFrame([("/d/1_my_plate_A01_ch1.tiff",), ("/d/1_my_plate_A01_ch2.tiff",), ("/d/x.txt",)], "path string")
    named = manifests.named_images(files)
    assert {(r["field"], r["plate"], r["well"], r["channel"]) for r in named.collect()} == {(1, "my_plate", "A01", 1), (1, "my_plate", "A01", 2)}
    sets = manifests.image_sets(named, {1: "dna", 2: "actin"}).collect()
    assert len(sets) == 1 and sets[0]["actin"].endswith("ch2.tiff")


def test_planes_and_sinks(spark, tmp_path):
    where = tmp_path / "img" / "p" / "A" / "1"
    where.mkdir(parents=True)
    np.save(where / "3.npy", np.arange(2 * 1 * 2 * 2).reshape(2, 1, 2, 2))
    got = sorted((r["channel"], r["field"], list(r["pixels"])) for r in images.planes(spark, str(tmp_path / "img")).collect())
    assert got == [(0, 3, [0, 1, 2, 3]), (1, 3, [4, 5, 6, 7])]
    table = spark.createDataFrame([("p", "A01", 1.0), ("p", "A02", None)], "plate string, well string, v double")
    sinks.features(table, str(tmp_path / "out"), ["v"], ["plate", "well"])
    back = spark.read.csv(str(tmp_path / "out"), sep="\t", header=True)
    assert sorted(r["v"] for r in back.collect()) == ["1.0", "NaN"]
    sinks.columnar(table, str(tmp_path / "pq"), ["plate"])
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 2
    wells = spark.createDataFrame([("p", "A01", "A", "1", None)], "plate string, well string, row string, col string, index_xml string")
    sinks.well_manifests(wells, str(tmp_path / "wells"))
    assert spark.read.text(str(tmp_path / "wells")).collect()[0]["value"].split("\t") == ["A01", "A", "1", "p", "none"]
    long = spark.createDataFrame([(1, 1, "nuclear membrane", "dna", 0.5)], "ImageNumber int, ObjectNumber int, class string, channel string, probability double")
    assert sinks.cell_classes(long, ["nuclear membrane"], ["dna"]).collect()[0]["Localization_NuclearMembrane_dna"] == 0.5
    assert table.where(F.col("v").isNull()).count() == 1
