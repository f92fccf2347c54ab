"""A live source for Structured Streaming: ramp windows in numbered batches, replayable from any offset."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


class _Range(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


class _RampReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.channels, self.samples = int(options.get("channels", 3)), int(options.get("samples", 50))
        self.windows, self.batch = int(options.get("windows", 4)), int(options.get("windowsPerBatch", 2))
        self.at = 0

    def initialOffset(self) -> dict:
        return {"window": 0}

    def latestOffset(self) -> dict:
        self.at = min(self.at + self.batch, self.windows)
        return {"window": self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Range(k, k + 1) for k in range(start["window"], end["window"])]

    def read(self, partition: _Range) -> Iterator[tuple]:
        for seq in range(partition.start, partition.end):
            for c in range(self.channels):
                yield seq, c, [seq * 1000 + c * 100 + t for t in range(self.samples)]

    def commit(self, end: dict) -> None:
        pass


class RampSource(DataSource):
    """``spark.readStream.format("sigloom_ramp")``: windows of the ramp signal, one partition each."""

    @classmethod
    def name(cls) -> str:
        return "sigloom_ramp"

    def schema(self) -> str:
        return "seq long, channel int, samples array<long>"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _RampReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RampSource)
