import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", partitions="8", memory="12g")
    yield session
    session.stop()


def make_vocab(spark, tokens):
    return spark.createDataFrame(
        [(t, i, "piece") for i, t in enumerate(["[UNK]", "[CLS]", "[SEP]", "[PAD]", "[MASK]", *tokens])],
        "token string, id int, source string",
    )
