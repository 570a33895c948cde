import pytest

from tributary.scratch import scratch_path
from tributary.settings import session_settings


class Session:
    """Just the settings the function asks for."""

    def __init__(self, **values):
        self.conf, self.values = self, values

    def get(self, name, default=None):
        return self.values.get(name.removeprefix("spark."), default)


def test_the_shared_folder_is_used():
    session = Session(**{"checkpoint.dir": "store://bucket/tmp/", "master": "yarn"})
    first, second = (scratch_path(session, "x") for _ in range(2))
    assert first.startswith("store://bucket/tmp/x-") and first != second


def test_a_local_folder_stands_in_on_one_machine_only():
    assert scratch_path(Session(master="local[4]"), "x").endswith("/x")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError):
            scratch_path(Session(master=master), "x")


def test_partitions_follow_the_data():
    assert session_settings(100 * 2**40, 8000)["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (128 * 2**20))
    assert session_settings(0, 8)["spark.sql.shuffle.partitions"] == "16"
