"""Stored posts as a replayable stream: the format ``post_replay``.

A table of Parquet files with a time column arrives in the order of its times, as many rows at once as fall into a step of
time. An offset is a time: the rows between two offsets are the same whenever they are asked for, so a stream that stops goes
on where it was, and a batch that is repeated has the same rows.

Options: ``path``; ``time`` (its column, ``created_at`` by default); ``steps`` (the table's time is cut into so many equal
steps, 6 by default) or ``step_seconds``; ``track`` (terms as a JSON list: only posts whose ``text`` has one of them arrive,
which is decided where the files are read). A partition is a row group that has times of the batch; row groups outside are
not opened. Rows without a time never arrive. Row groups tell their times by statistics; where a file has none, as with
96-bit times, its times are read once when the stream starts.
"""

import json
import sys
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The source travels by value, so the workers that plan and read it need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "post_replay"
STEPS = 6
WRITTEN_TIMES = "spark.sql.parquet.outputTimestampType"


def file_system(path):
    """(file system, path on it) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def data_files(path):
    from pyarrow import fs

    store, root = file_system(path)
    if store.get_file_info(root).type == fs.FileType.File:
        return store, [root]
    found = store.get_file_info(fs.FileSelector(root, recursive=True))
    return store, sorted(f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".parquet"))


def microseconds(value):
    """A time of row-group statistics as microseconds since the epoch."""
    import pyarrow as pa

    return pa.scalar(value).cast(pa.timestamp("us", "UTC" if value.tzinfo else None)).cast(pa.int64()).as_py()


def opened(source):
    import pyarrow.parquet as pq

    return pq.ParquetFile(source, coerce_int96_timestamp_unit="us")


def with_zone(schema, meta):
    """The Arrow schema of a file, with the zone of 96-bit times: they are instants, but Arrow reads them without it."""
    import pyarrow as pa

    columns = [meta.schema.column(i) for i in range(meta.num_columns)]
    for column in columns:
        if column.physical_type == "INT96" and column.path in schema.names:
            at = schema.get_field_index(column.path)
            schema = schema.set(at, pa.field(column.path, pa.timestamp("us", "UTC")))
    return schema


def ticks(times):
    """Times of an Arrow array as microseconds since the epoch."""
    import pyarrow as pa

    return times.cast(pa.timestamp("us", times.type.tz), safe=False).cast(pa.int64())


def time_bounds(file, group, time):
    """(least, greatest) time of a row group, None without any."""
    import pyarrow.compute as pc

    meta = file.metadata
    place = [meta.schema.column(i).path for i in range(meta.num_columns)].index(time)
    known = meta.row_group(group).column(place).statistics
    if known is not None and known.has_min_max:
        return microseconds(known.min), microseconds(known.max)
    found = [pc.min_max(ticks(batch.column(time))).as_py() for batch in file.iter_batches(row_groups=[group], columns=[time])]
    found = [x for x in found if x["min"] is not None]
    return (min(x["min"] for x in found), max(x["max"] for x in found)) if found else None


@dataclass
class RowGroup(InputPartition):
    """The rows of one row group with a time after ``start`` and up to ``end``."""

    file: str
    group: int
    start: int
    end: int


class PostReplayReader(DataSourceStreamReader):
    def __init__(self, schema, options):
        self.columns, self.path, self.time = schema.names, options["path"], options.get("time", "created_at")
        self.track = json.loads(options.get("track", "[]"))
        store, files = data_files(self.path)
        self.groups = []  # (file, row group, least time, greatest time)
        for name in files:
            with store.open_input_file(name) as source:
                file = opened(source)
                for group in range(file.metadata.num_row_groups):
                    bounds = time_bounds(file, group, self.time)
                    if bounds:
                        self.groups.append((name, group, *bounds))
        self.first = min((low for *_, low, _ in self.groups), default=0) - 1
        self.last = max((high for *_, high in self.groups), default=-1)
        seconds = options.get("step_seconds")
        steps = int(options.get("steps", STEPS))
        self.step = int(float(seconds) * 1e6) if seconds else max(1, -(-(self.last - self.first) // steps))
        self.position = None

    def initialOffset(self):
        return {"time": self.first}

    def latestOffset(self):
        position = self.first if self.position is None else self.position
        self.position = min(position + self.step, self.last)
        return {"time": self.position}

    def partitions(self, start, end):
        # After a restart the engine plans the last batch of the log before it asks for more.
        if self.position is None:
            self.position = end["time"]
        start, end = start["time"], end["time"]
        return [RowGroup(file, group, start, end) for file, group, low, high in self.groups if low <= end and high > start]

    def read(self, partition):
        import pyarrow.compute as pc

        store, _ = file_system(self.path)
        with store.open_input_file(partition.file) as source:
            needed = list(dict.fromkeys([*self.columns, self.time, *(["text"] if self.track else [])]))
            file = opened(source)
            for batch in file.iter_batches(row_groups=[partition.group], columns=needed):
                batch = batch.cast(with_zone(batch.schema, file.metadata))
                time = ticks(batch.column(self.time))
                kept = pc.and_(pc.greater(time, partition.start), pc.less_equal(time, partition.end))
                if self.track:
                    found = [pc.match_substring(batch.column("text"), term) for term in self.track]
                    some = found[0]
                    for other in found[1:]:
                        some = pc.or_(some, other)
                    kept = pc.and_(kept, some)
                yield batch.filter(kept).select(self.columns)

    def commit(self, end):
        """Nothing to free: the files stay."""


class PostReplay(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        from pyspark.sql.pandas.types import from_arrow_schema

        store, files = data_files(self.options["path"])
        with store.open_input_file(files[0]) as source:
            file = opened(source)
            return from_arrow_schema(with_zone(file.schema_arrow, file.metadata))

    def streamReader(self, schema):
        return PostReplayReader(schema, self.options)


def replay(spark, path, track=None, **options):
    """The rows of a Parquet table as a stream in the order of their times."""
    spark.dataSource.register(PostReplay)
    reader = spark.readStream.format(FORMAT).options(**options)
    return (reader.option("track", json.dumps(list(track))) if track else reader).load(path)


def ordered_table(rows, path, time="created_at"):
    """Write rows as files that ``replay`` reads a few of per step: sorted by time, in ranges of time.

    Times are written with statistics, whatever the session is set to.
    """
    conf = rows.sparkSession.conf
    before = conf.get(WRITTEN_TIMES)
    conf.set(WRITTEN_TIMES, "TIMESTAMP_MICROS")
    try:
        rows.repartitionByRange(time).sortWithinPartitions(time).write.parquet(path)
    finally:
        conf.set(WRITTEN_TIMES, before)
    return path
