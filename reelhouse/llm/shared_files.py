"""Binary files in the folder that all executors share, written and read inside tasks."""

from __future__ import annotations

import contextlib
import uuid

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from reelhouse.session import checkpoint_root


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder for one run of a writer."""
    return f"{checkpoint_root(spark)}/reelhouse-llm/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def whole_file(uri: str):
    """Output stream of a file that appears under its name only when complete: a failed or
    second attempt of the task leaves nothing half-written there."""
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    context = TaskContext.get()
    attempt = f"{path}.attempt-{context.taskAttemptId() if context else uuid.uuid4().hex}"
    with store.open_output_stream(attempt) as out:
        yield out
    store.move(attempt, path)


def read_range(uri: str, offset: int, length: int) -> bytes:
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f:
        return f.read_at(length, offset)


def remove_folder(uri: str) -> None:
    store, path = fs.FileSystem.from_uri(uri)
    store.delete_dir(path)


def file_size(uri: str) -> int:
    store, path = fs.FileSystem.from_uri(uri)
    return store.get_file_info(path).size
