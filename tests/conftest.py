import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tremorlake.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def feature(properties=None, geometry=None, **more):
    """A GeoJSON feature with a place and a position unless told otherwise."""
    return {
        "type": "Feature",
        "properties": {"place": "5 km S of Here", **(properties or {})},
        "geometry": {"type": "Point", "coordinates": [1.5, 2.5, 3.5]} if geometry is None else geometry,
        "id": "x",
        **more,
    }


def document(*features):
    return json.dumps({"type": "FeatureCollection", "features": list(features)})


@pytest.fixture
def lines(spark):
    """A frame of bronze lines."""

    def make(*texts):
        return spark.createDataFrame([(text,) for text in texts], "value string")

    return make


@pytest.fixture
def documents(spark, tmp_path):
    """Lines read back as nested documents."""
    from tremorlake.sources.layers import read_bronze_json

    def make(*texts):
        path = tmp_path / "documents.json"
        path.write_text("\n".join(texts) + "\n")
        return read_bronze_json(spark, str(path))

    return make
