"""Arrays that tasks write to the shared folder and that workers map."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

import numpy as np
import pyarrow.fs
from pyspark import SparkFiles
from pyspark.sql import SparkSession

from .session import fresh_path


@dataclass
class Store:
    """Arrays, one file each, in a folder that all machines share.

    Tasks write whole files under a name of their own and then rename them, so a task that runs twice does no harm.
    Where the folder is a mounted file system, workers map the files themselves; from any other store they fetch a file
    once into Spark's folder for files of the job and map the copy.
    """

    uri: str
    opened: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"uri": self.uri, "opened": {}}

    def _at(self, name: str) -> tuple[pyarrow.fs.FileSystem, str]:
        store, path = pyarrow.fs.FileSystem.from_uri(self.uri)
        return store, f"{path}/{name}.npy"

    def create(self) -> None:
        store, path = pyarrow.fs.FileSystem.from_uri(self.uri)
        store.create_dir(path, recursive=True)

    def write(self, name: str, array: np.ndarray) -> None:
        store, path = self._at(name)
        own = f"{path}.{os.getpid()}-{os.urandom(8).hex()}"
        with store.open_output_stream(own) as out:
            np.lib.format.write_array(out, np.ascontiguousarray(array), allow_pickle=False)
        store.move(own, path)

    def read(self, name: str) -> np.ndarray:
        if name not in self.opened:
            store, path = self._at(name)
            if not isinstance(store, pyarrow.fs.LocalFileSystem):
                here = os.path.join(SparkFiles.getRootDirectory(), f"{os.path.basename(self.uri)}-{name}.npy")
                if not os.path.exists(here):
                    own = f"{here}.{os.getpid()}"
                    with store.open_input_stream(path) as source, open(own, "wb") as out:
                        while piece := source.read(1 << 24):
                            out.write(piece)
                    os.replace(own, here)
                path = here
            self.opened[name] = np.load(path, mmap_mode="r")
        return self.opened[name]


def uri(spark: SparkSession, path: str) -> str:
    """A path of Spark's as workers name it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def shared_store(spark: SparkSession, label: str) -> Store:
    """A new, empty store in the shared folder."""
    store = Store(uri(spark, fresh_path(spark, label)))
    store.create()
    return store
