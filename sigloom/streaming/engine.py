"""Running a stream to several sinks, and the sinks: counting, rotating files, receipts, metrics text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.streaming.processors import fan_out


@dataclass
class Report:
    """What a run took in, gave to each sink, and lost: nothing is dropped unless a sink fails."""

    windows_in: int = 0
    consumed: dict[str, int] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    dropped: int = 0

    def prometheus(self) -> str:
        """The counters as exposition text."""
        lines = [f"sigloom_windows_in_total {self.windows_in}", f"sigloom_windows_dropped_total {self.dropped}"]
        lines += [f'sigloom_windows_consumed_total{{sink="{k}"}} {v}' for k, v in sorted(self.consumed.items())]
        return "\n".join([*lines, *(f'sigloom_sink_errored{{sink="{k}"}} 1' for k in sorted(self.errors))]) + "\n"


def run(stream: DataFrame, sinks: dict[str, Callable[[DataFrame, int], None]], checkpoint: str) -> Report:
    """Drain what the source has to every sink, then stop. A sink that fails once is left out from then
    on and reported; the others go on."""
    report = Report(consumed=dict.fromkeys(sinks, 0))

    def each(batch: DataFrame, epoch: int) -> None:
        live = {n: s for n, s in sinks.items() if n not in report.errors}
        n = batch.count()
        failed = fan_out(batch, epoch, live)
        report.windows_in += n
        report.errors |= failed
        for name in live:
            if name not in failed:
                report.consumed[name] += n

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return report


def rotating_files(path: str, windows_per_file: int) -> Callable[[DataFrame, int], None]:
    """Parquet below ``path`` in folders of so many windows; a batch that runs again replaces its own."""

    def sink(batch: DataFrame, epoch: int) -> None:
        part = F.floor(F.col("seq") / windows_per_file)
        batch.withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(f"{path}/epoch={epoch}")

    return sink
