from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from loamline.__main__ import main
from loamline.operators import geometry
from loamline.plans import charts

from .test_runs import collection, square


def parts(svg, tag):
    return ElementTree.fromstring(svg).findall(f".//{{http://www.w3.org/2000/svg}}{tag}")


def test_correlations(spark):
    svg = charts.correlations(spark.createDataFrame([("a", "b", 1.0), ("a", "c<", -1.0), ("b", "c<", None)], "a string, b string, rho double"))
    fills = [r.get("fill") for r in parts(svg, "rect")[1:]]
    assert len(fills) == 9 and fills.count("#dddddd") == 2 and "#c8553d" in fills and "#3b6ea5" in fills


def test_series_and_bars(spark):
    df = spark.createDataFrame([("x", 2020, 0.5), ("x", 2021, None), ("x", 2022, 1.0), ("y", 2020, 0.2), ("y", 2022, 0.1)], "n string, year int, v double")
    svg = charts.series(df, "year", "v", "n", "t & t")
    assert len(parts(svg, "circle")) == 4 and [p.get("d").count("M") for p in parts(svg, "path")[1:]] == [2, 1]
    assert charts.series(df.limit(0), "year", "v", "n", "none").count("no values") == 1
    assert [float(r.get("width")) for r in parts(charts.bars(df.filter("n = 'x'"), "year", "v", "b"), "rect")[1:]] == [360.0, 180.0]
    with pytest.raises(ValueError):
        charts.bars(spark.range(charts.MOST + 1).select("id", F.lit(1.0).alias("v")), "id", "v", "long")


def test_context(spark, tmp_path):
    (tmp_path / "p.geojson").write_text(collection([({"parcel_id": "x7", "area": "a"}, square(0, 0, 0.01, 0.01)), ({"parcel_id": "x8", "area": "a"}, square(0.005, 0.005, 0.5, 0.5)), ({"parcel_id": "x9", "area": "a"}, square(5, 5, 6, 6))]))
    assert main(["context", "--in", str(tmp_path / "p.geojson"), "--out", str(tmp_path / "out"), "--number", "7", "--metres", "100"], spark) == 0
    lines = parts((tmp_path / "out_map/charts/context.svg").read_text(), "path")
    assert len(lines) == 6 and sum(p.get("stroke-width") == "2.5" for p in lines) == 4  # two sides of the second come into the box, none of the third
    box = geometry.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1))
    assert spark.range(1).select(geometry.area(box).alias("a")).first().a == 1
