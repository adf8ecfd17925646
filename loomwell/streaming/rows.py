"""A row-by-row sink that commits once per partition and micro-batch."""

from __future__ import annotations

import json
import sys
from typing import Any
from uuid import uuid4

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Row

# Send these classes themselves to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class RowFiles:
    """A ``foreach`` writer: the rows of one partition and micro-batch become one file of JSON lines.

    Rows go to a hidden file, which gets its name when the partition has ended
    without an error. The name holds the micro-batch and the partition, so a batch
    that runs again after a failure replaces its own files and no row counts twice. That
    holds as long as a repeated batch is cut into the same partitions: always for
    stateful queries, and for file sources under unchanged settings.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.files, root = fs.FileSystem.from_uri(self.folder)
        name = f"{epoch_id:06d}-{partition_id:05d}.json"
        self.target, self.hidden = f"{root}/{name}", f"{root}/_{name}.{uuid4().hex}"
        self.files.create_dir(root, recursive=True)
        self.stream = self.files.open_output_stream(self.hidden)
        return True

    def process(self, row: Row) -> None:
        self.stream.write((json.dumps(row.asDict(recursive=True), default=str) + "\n").encode())

    def close(self, error: Any) -> None:
        self.stream.close()
        if error is None:
            self.files.move(self.hidden, self.target)
        else:
            self.files.delete_file(self.hidden)


class FailingRowFiles(RowFiles):
    """The same writer, which fails in the middle of one micro-batch: to rehearse a restart."""

    def __init__(self, folder: str, epoch: int, after_rows: int):
        super().__init__(folder)
        self.epoch, self.after_rows = epoch, after_rows

    def open(self, partition_id: int, epoch_id: int) -> bool:
        # an even partition commits, an odd one fails
        self.left = self.after_rows if epoch_id == self.epoch and partition_id % 2 else None
        return super().open(partition_id, epoch_id)

    def process(self, row: Row) -> None:
        if self.left is not None:
            if not self.left:
                raise RuntimeError("the writer fails here on purpose")
            self.left -= 1
        super().process(row)
