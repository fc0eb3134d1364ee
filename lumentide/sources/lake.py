"""The lake: files of the stream by event date and batch, without a log of files.

A file sink of Spark keeps a log of its files, and once files are expired, every read of the
folder fails over the log. Here a micro-batch is complete in a hidden folder before its days
are moved into place, and a small file remembers the last batch delivered. Files come into
sight once, under one name, so batch readers and file streams read every row once, and a day
can be dropped like any partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumentide.sources.files import Storage
from lumentide.sources.layout import laid_out

DELIVERED, PENDING, LOG = "_delivered", "_pending-", "_spark_metadata"


def deliver(
    batch: DataFrame, path: str, stream: str, batch_id: int, partition_by: str = "event_date",
) -> bool:
    """Add a micro-batch to the lake; one that was delivered before adds nothing.

    A batch delivered again after a failure in the middle is not computed again but moved
    in from where it stopped, under the same file names. Each day's rows are balanced over
    tasks, so a micro-batch makes few files for a day. Whether it added something.
    """
    path = path.rstrip("/")
    storage = Storage(batch.sparkSession, path)
    done, pending = f"{path}/{DELIVERED}/{stream}", f"{path}/{PENDING}{stream}-{batch_id}"
    if any(int(e.name) >= batch_id for e in storage.entries(done) if e.name.isdigit()):
        storage.remove(pending)
        return False
    if not storage.exists(f"{pending}/_complete"):
        storage.remove(pending)
        laid_out(batch, partition_by).write.partitionBy(partition_by).parquet(pending)
        storage.write(f"{pending}/_complete", "")
    for entry in storage.entries(pending):
        if entry.is_dir and entry.name.startswith(f"{partition_by}="):
            target = f"{path}/{entry.name}/batch={stream}-{batch_id}"
            storage.remove(target)  # what a store without true renames left half copied
            storage.move(f"{pending}/{entry.name}", target)
    storage.write(f"{done}/{batch_id:012d}", "")
    storage.remove(pending)
    for entry in storage.entries(done):
        if entry.name.isdigit() and int(entry.name) < batch_id:
            storage.remove(f"{done}/{entry.name}")
    return True


def adopt_lake(spark: SparkSession, path: str) -> int:
    """Turn a folder written by a file sink into a lake that can be expired.

    The files its log lists move to a batch of their day, files of failed micro-batches,
    which it doesn't list, are removed, and the log goes last: until then the call can be
    repeated after a failure. No writer or reader may be at work. Returns the number of
    files that moved; nothing is done to a folder without such a log.
    """
    path = path.rstrip("/")
    storage = Storage(spark, path)
    if not storage.exists(f"{path}/{LOG}"):
        return 0
    # With a schema given, whichever, Spark reads the log and no footers of files that moved.
    logged = spark.read.schema("event_date date").parquet(path)
    listed = {f.rpartition("/")[2] for f in logged.inputFiles()}
    moved = 0
    for entry in storage.entries(path):
        if not (entry.is_dir and entry.name.startswith("event_date=")):
            continue
        folder = f"{path}/{entry.name}"
        for file in storage.entries(folder):
            if file.is_dir:
                continue
            if file.name in listed:
                storage.move(f"{folder}/{file.name}", f"{folder}/batch=adopted/{file.name}")
                moved += 1
            else:
                storage.remove(f"{folder}/{file.name}")
    storage.remove(f"{path}/{LOG}")
    return moved
