from .conform import conform, typed
from .json_batch import read_json_batch
from .readings import Increment, increment_cutoff, jdbc_options, read_day, read_increment, read_jdbc
from .topic import kafka_options, read_stream

__all__ = [
    "Increment",
    "conform",
    "increment_cutoff",
    "jdbc_options",
    "kafka_options",
    "read_day",
    "read_increment",
    "read_jdbc",
    "read_json_batch",
    "read_stream",
    "typed",
]
