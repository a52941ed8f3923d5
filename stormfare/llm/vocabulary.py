"""Vocabulary files, read once by the driver and sent to the tasks: a few megabytes each."""

from __future__ import annotations

import hashlib

from pyspark import Broadcast
from pyspark.sql import SparkSession

_built: dict[tuple[str, str], object] = {}


def sent(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def built(kind: type, content: bytes):
    """The worker's own ``kind(content)``, made once per worker process."""
    name = (kind.__name__, hashlib.sha256(content).hexdigest())
    if name not in _built:
        _built[name] = kind(content)
    return _built[name]
