"""An exactly-once sink of rows as JSON lines: the format ``published_rows``.

Tasks write their rows to files of their own below ``rows``; nothing of them counts yet. The commit of a batch lists the files
of its tasks in ``batches/<number>.json``, which appears at once, whole. A batch that is repeated after its commit finds its
list and leaves it as it is, and what its tasks wrote anew is deleted; of a batch that failed no list exists, so
``read_published`` sees each batch once or not at all. It works for ``writeStream`` (the batch is the stream's), and for a
write inside ``foreachBatch`` with the option ``batch``.
"""

import json
import sys
import uuid
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from ..sources.replay import file_system

# The sink travels by value, as the source of ``replay`` does.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "published_rows"


@dataclass
class Written(WriterCommitMessage):
    """The file of a task, None if it had no rows."""

    file: str | None


class Publication:
    """The two phases: files of tasks, then the list of a batch."""

    def __init__(self, path):
        self.path = path

    def write_rows(self, batches):
        store, root = file_system(self.path)
        name, out = f"{uuid.uuid4().hex}.json", None
        for batch in batches:
            if batch.num_rows and out is None:
                store.create_dir(f"{root}/rows", recursive=True)
                out = store.open_output_stream(f"{root}/rows/{name}")
            for row in batch.to_pylist():
                out.write(json.dumps(row, ensure_ascii=False, default=str).encode("utf-8") + b"\n")
        if out is None:
            return Written(None)
        out.close()
        return Written(name)

    def commit_batch(self, messages, number):
        from pyarrow import fs

        store, root = file_system(self.path)
        listed, files = f"{root}/batches/{number:020d}.json", [m.file for m in messages if m and m.file]
        if store.get_file_info(listed).type != fs.FileType.NotFound:
            self.drop(files)
            return
        store.create_dir(f"{root}/batches", recursive=True)
        draft = f"{root}/draft-{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            out.write(json.dumps({"batch": number, "files": files}).encode("utf-8") + b"\n")
        store.move(draft, listed)

    def drop(self, files):
        store, root = file_system(self.path)
        for file in files:
            store.delete_file(f"{root}/rows/{file}")


class BatchWriter(DataSourceArrowWriter, Publication):
    def __init__(self, options):
        Publication.__init__(self, options["path"])
        self.number = int(options["batch"])

    def write(self, iterator):
        return self.write_rows(iterator)

    def commit(self, messages):
        self.commit_batch(messages, self.number)

    def abort(self, messages):
        self.drop([m.file for m in messages if m and m.file])


class StreamWriter(DataSourceStreamArrowWriter, Publication):
    def __init__(self, options):
        Publication.__init__(self, options["path"])

    def write(self, iterator):
        return self.write_rows(iterator)

    def commit(self, messages, batchId):
        self.commit_batch(messages, batchId)

    def abort(self, messages, batchId):
        self.drop([m.file for m in messages if m and m.file])


class PublishedRows(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        return BatchWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return StreamWriter(self.options)


def publish_rows(rows, path, batch_id):
    """Publish the rows of a batch once, from inside ``foreachBatch``."""
    rows.sparkSession.dataSource.register(PublishedRows)
    rows.write.format(FORMAT).option("path", path).option("batch", batch_id).mode("append").save()


def publish_stream(rows, path, checkpoint, **trigger):
    """Start publishing a stream of rows; returns the query."""
    rows.sparkSession.dataSource.register(PublishedRows)
    writer = rows.writeStream.format(FORMAT).option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_published(spark, path, schema):
    """The published rows: those of the files that some committed batch lists."""
    from pyarrow import fs

    store, root = file_system(path)
    if store.get_file_info(f"{root}/batches").type == fs.FileType.NotFound:
        return spark.createDataFrame([], schema)
    lists = spark.read.schema("batch bigint, files array<string>").json(f"{path}/batches")
    files = [f"{path}/rows/{name}" for row in lists.collect() for name in row.files]
    return spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)
