"""Tables, landed files and event topics as DataFrames."""

from tributary.sources.database import KeyRange, key_bounds, read_options, read_table
from tributary.sources.lake import read_zone, zone_path
from tributary.sources.landing import landed_state, read_landed, stream_landed
from tributary.sources.topics import FileTopic, KafkaTopic, read_topic, stream_topic

__all__ = [
    "FileTopic",
    "KafkaTopic",
    "KeyRange",
    "key_bounds",
    "landed_state",
    "read_landed",
    "stream_landed",
    "read_options",
    "read_table",
    "read_topic",
    "read_zone",
    "stream_topic",
    "zone_path",
]
