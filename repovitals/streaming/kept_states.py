"""Mergeable states of what a file stream has brought, each file taken once.

A batch of the stream reduces the files that are new to states and writes them as one version, named by
the batch. A batch that is tried again writes the same version, so a file counts once whether it lands
late, out of order or again. What is asked is then made from the states, not from the files. Versions
are folded into one when there are many.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from repovitals.sources.store import LayerStore

#: Versions that are read side by side before they are folded into one.
FOLD_AFTER = 24


class KeptStates:
    """States in a folder of a store. What they are, and how they are made and merged, a subclass says."""

    #: Columns by which states are kept in folders, so that readers can leave some out.
    partition_by: tuple[str, ...] = ()

    def __init__(self, store: LayerStore, name: str):
        self.store, self.spark = store, store.spark
        self.folder = f"{store.root}/{name}"

    def schema(self) -> str:
        """Columns of a state."""
        raise NotImplementedError

    def stream(self, landed: str) -> DataFrame:
        """The stream of what lands below a path."""
        raise NotImplementedError

    def reduced(self, batch: DataFrame) -> DataFrame:
        """The states of a batch."""
        raise NotImplementedError

    def merged(self, states: DataFrame) -> DataFrame:
        """States of several batches, of which one key may have several, as one for each key."""
        raise NotImplementedError

    def lasting(self, states: DataFrame) -> DataFrame:
        """What is worth keeping when versions are folded."""
        return states

    def _write(self, states: DataFrame, path: str) -> None:
        states.write.mode("overwrite").partitionBy(*self.partition_by).parquet(path)

    def _version(self, part: str, number: int) -> str:
        return f"{self.folder}/{part}/version={number:020d}"

    def _read(self, part: str, numbers: list[int]) -> DataFrame:
        reader = self.spark.read.schema(self.schema()).option("basePath", f"{self.folder}/{part}")
        paths = [self._version(part, number) for number in numbers]
        return reader.parquet(*paths).drop("version") if paths else self.spark.createDataFrame([], self.schema())

    def _folded_upto(self) -> int:
        return max(self.store.committed_versions(f"{self.folder}/folded"), default=0)

    def _open(self) -> list[int]:
        folded = self._folded_upto()
        return [n for n in self.store.committed_versions(f"{self.folder}/batches") if n > folded]

    def absorb(self, landed: str) -> int:
        """Take the files below `landed` (which may hold globs) that are new; returns how many batches they came in."""
        before = len(self._open())

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            # Batches count from 0, and a version above 0 is complete only once it is committed.
            self._write(self.reduced(batch), self._version("batches", batch_id + 1))

        writer = self.stream(landed).writeStream.foreachBatch(on_batch)
        writer.option("checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        taken = len(self._open()) - before
        if len(self._open()) > FOLD_AFTER:
            self.fold()
        return taken

    def fold(self) -> None:
        """Make one version of all. Until it is committed readers see the many, afterwards the one."""
        numbers = self._open()
        if not numbers:
            return
        last = self._folded_upto()
        self._write(self.lasting(self.states()), self._version("folded", numbers[-1]))
        self.store.drop_versions(f"{self.folder}/folded", last)
        self.store.drop_versions(f"{self.folder}/batches", numbers[-1])

    def states(self) -> DataFrame:
        """The states of all files taken, one for each key."""
        folded = self._folded_upto()
        parts = [self._read("folded", [folded] if folded else []), self._read("batches", self._open())]
        return self.merged(reduce(DataFrame.unionByName, parts))
