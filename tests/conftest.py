import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from posttags.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "posttags-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


SMALL = [
    (0, "java thread pool thread>>>java concurrency"),
    (1, "java null pointer>>>java"),
    (2, "swift ui button>>>swift ios"),
    (3, "swift null optional>>>swift"),
    (4, "the java swift>>>java swift"),
]


@pytest.fixture(scope="session")
def small_posts(spark):
    from posttags.sources.posts import parse_lines

    return parse_lines(spark.createDataFrame(SMALL, "doc_id bigint, value string"))
