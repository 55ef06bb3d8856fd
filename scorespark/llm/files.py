"""Files that tasks write and read in the folder all executors share, through Arrow's file systems.

A task writes under a name of its own and reports it as a row; files of tasks
that were lost or run twice are in no table, so nothing ever reads them.
"""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyarrow import fs
from pyspark.sql import SparkSession

from scorespark.session import new_path


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder as a URI; a plain path is one of the local file system."""
    path = new_path(spark, name)
    return path if urlsplit(path).scheme else f"file://{path}"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    return system, path


def own_name(suffix: str) -> str:
    return f"{uuid.uuid4().hex}.{suffix}"
