import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from framewatch.session import get_spark
    s = get_spark("local[4]", app="framewatch-tests", shuffle_partitions=8,
                  extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


_ZEROS = object()


def frame(seq, feed="camera_1", rnd=1, cam=None, b=165.0, blur=0.12, emb=_ZEROS, dim=8,
          ts="2026-05-26T12:00:00+00:00", frame_id=None):
    return (seq, feed, rnd, ts, feed if cam is None else cam,
            frame_id or f"{feed}_b{rnd:03d}_f{seq:02d}", b, blur,
            [0.0] * dim if emb is _ZEROS else emb)


@pytest.fixture
def make_frames(spark):
    from framewatch.sources.frames import FRAME_SCHEMA

    def _make(rows):
        return spark.createDataFrame(rows, FRAME_SCHEMA)
    return _make
