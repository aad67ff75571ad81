import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from eventlake.session import local_session

    return local_session(4, shuffle_partitions=8)


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


def raw_rows(spark, values, server="kafka-a:9092", topic="t_click", keys=None):
    """Raw records from JSON texts (one partition each)."""
    rows = []
    for i, v in enumerate(values):
        key = None if keys is None else keys[i]
        rows.append((server, "etl", topic, 0, i, None, None if key is None else key.encode(),
                     None if v is None else v.encode()))
    return spark.createDataFrame(rows, "server string, consumer_group string, topic string, partition int, "
                                       "offset bigint, timestamp timestamp_ntz, key binary, value binary")
