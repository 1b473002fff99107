import sys
from pathlib import Path

import pytest
from pyspark import SparkConf

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from latewatch.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # the setting is fixed once Spark runs; a folder that is named already is kept
    named = SparkConf().get("spark.checkpoint.dir", None)
    own = {} if named else {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))}
    yield get_session("local[4]", 4, app_name="latewatch-tests", extra=own)
