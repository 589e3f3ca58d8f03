import numpy as np
import pytest

from loamline.__main__ import main
from loamline.sources import geotiff

from .test_labels_and_models import rows_of


def test_stages_by_command(spark, tmp_path, capsys):
    rows_of(spark).write.parquet(str(tmp_path / "t"))
    at = lambda name: str(tmp_path / name)
    assert main(["label", "--in", at("t"), "--out", at("l")], spark) == 0
    assert spark.read.parquet(at("l/table")).filter("label_type = 'confident_positive'").count() > 0
    assert main(["diagnose", "--in", at("t"), "--out", at("d")], spark) == 0
    assert spark.read.parquet(at("d/missing")).count() > 3
    (tmp_path / "c.json").write_text('{"hdbscan": {"min_cluster_size": 10, "min_samples": 5, "pca_components": 3}}')
    assert main(["cluster", "--in", at("l/table"), "--out", at("c"), "--config", at("c.json")], spark) == 0
    assert spark.read.parquet(at("c/table")).count() == 120
    with pytest.raises(SystemExit):
        main(["nothing"], spark)


def test_audit_and_crs_by_command(spark, tmp_path):
    (tmp_path / "in/masks").mkdir(parents=True)
    a = np.array([[[0, 3], [1, 1]]], "float32")
    (tmp_path / "in/masks/amga_2020_water_mask.tif").write_bytes(geotiff.encode(geotiff.Raster(a, (1, 0, 0, 0, -1, 2), 3857)))
    (tmp_path / "in/masks/broken.tif").write_bytes(b"x")
    args = ["--in", str(tmp_path / "in"), "--out", str(tmp_path / "out")]
    assert main(["audit", *args], spark) == 0 and main(["audit", *args, "--fail-on-error"], spark) == 2
    codes = {r.code for r in spark.read.parquet(str(tmp_path / "out/issues")).collect()}
    assert codes >= {"RASTER_OPEN", "RASTER_NOT_BINARY", "MASKS_MISSING"}
    assert main(["crs", "--in", str(tmp_path / "in"), "--out", str(tmp_path / "crs")], spark) == 3
    assert main(["self-test"], spark) == 0
