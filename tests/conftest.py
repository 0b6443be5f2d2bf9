import os
import sys
from collections import namedtuple

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalog_marts.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault(
        "PYSPARK_SUBMIT_ARGS", "--master local[8,2] --driver-memory 4g pyspark-shell"
    )
    session = get_session(
        "catalog-marts-tests",
        partitions=8,
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    saved = {}

    def put(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


Mini = namedtuple("Mini", "titles ratings names principals akas")


@pytest.fixture(scope="session")
def mini(spark):
    """Hand-checked catalogue."""
    titles = spark.createDataFrame(
        [
            ("tt1", "movie", "Alpha", "Alpha", False, 2000, None, 90, "Drama,Comedy"),
            ("tt2", "movie", "Alpha 2", "Alpha 2", False, 2000, None, 95, None),
            ("tt3", "short", "Gamma", "Gamma", False, 2001, None, 10, "Drama"),
            ("tt4", "short", "Delta", "Delta", None, None, None, None, "Sci-Fi"),
        ],
        "title_id string, title_type string, primary_title string, original_title string, "
        "is_adult boolean, start_year int, end_year int, runtime_minutes int, genres string",
    )
    ratings = spark.createDataFrame(
        [("tt1", 8.0, 1000), ("tt2", 6.0, 3000)],
        "title_id string, average_rating float, num_votes int",
    )
    names = spark.createDataFrame(
        [("nm1", "Ann", None, None), ("nm2", "Bob", None, None), ("nm3", "Cy", None, None)],
        "name_id string, primary_name string, birth_year int, death_year int",
    )
    principals = spark.createDataFrame(
        [
            ("tt1", 1, "nm1", "actor"),
            ("tt1", 2, "nm2", "director"),
            ("tt1", 3, "nm9", "actress"),
            ("tt2", 1, "nm1", "actor"),
            ("tt2", 2, "nm1", "producer"),
            ("tt3", 1, "nm2", "director"),
            ("tt3", 2, "nm3", "actor"),
        ],
        "title_id string, ordering int, name_id string, category string",
    )
    akas = spark.createDataFrame(
        [("tt1", "US"), ("tt1", "US"), ("tt1", "FR"), ("tt1", None), ("tt2", None)],
        "title_id string, region string",
    )
    return Mini(titles, ratings, names, principals, akas)
