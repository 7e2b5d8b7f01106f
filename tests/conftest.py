import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from postlake.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, extra={"spark.postlake.scanPartitions": "4"})
    yield s
    s.stop()


ITEM_DDL = ("id bigint, type string, by string, time bigint, title string, url string, "
            "score bigint, descendants bigint")

ITEMS = [
    (11, "story", "dana", 1709251200, "Which index should a small table use?", "http://db.example.org:8080/q/7", 100, 3),
    (12, "story", "erik", 1704067199, "Year end notes", "https://Notes.Example.net/2023", 99, 0),
    (13, "story", None, 1718452800, "A tour of window functions", None, 640, 51),
    (14, "story", "dana", 1709289000, "Ask: why", "mailto:x@example.org", 0, 2),
    (15, "poll", "erik", 1709289000, "Vote?", None, 500, 9),
]


@pytest.fixture(scope="session")
def items(spark):
    return spark.createDataFrame(ITEMS, ITEM_DDL)


@pytest.fixture()
def workdir(spark):
    from postlake.session import scratch_dir
    return scratch_dir(spark, "test")
