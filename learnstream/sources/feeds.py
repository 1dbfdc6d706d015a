"""Feed sources and the replay job.

A feed record is one text ``value``. Batch queries take the lines as a
DataFrame; streams read them with ``readStream`` from a Kafka topic (when the
connector is on the class path) or from a directory of text files, through the
same parsers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REPLAY_PARTITIONS = 10
RATE_PER_PARTITION = {"register": 1000, "qz": 1000, "page": 100, "course_learn": 100}
BATCH_SECONDS = 3


def replay_frame(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """The lines as a feed, over ``partitions`` partitions if given, else
    over those of the scan."""
    out = lines.select(F.col("value").alias("line"))
    return out.repartition(partitions) if partitions else out


def replay_to_dir(lines: DataFrame, feed_dir: str,
                  partitions: int = MIN_REPLAY_PARTITIONS) -> None:
    """Write the lines as text files a file-stream source picks up."""
    replay_frame(lines, partitions).write.mode("append").text(feed_dir)


def stream_feed(spark: SparkSession, *, topic: str | None = None,
                bootstrap: str | None = None, directory: str | None = None,
                partitions: int | None = None, feed: str | None = None,
                files_per_trigger: int | None = None,
                bytes_per_trigger: int | str | None = None) -> DataFrame:
    """S1 + S3: a streaming DataFrame with one ``value string`` column.

    Kafka: one subscribed topic from the earliest offset; the intake cap is
    ``rate x batch seconds x partitions`` records per trigger, so the feed's name and the
    topic's number of partitions must be given. (No connector is installed here:
    this branch is not run by the tests.) Directory: new text files, at most
    ``files_per_trigger`` or about ``bytes_per_trigger`` at a time."""
    if topic:
        cap = topic_cap(feed, partitions)
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap)
                .option("subscribe", topic)
                .option("startingOffsets", "earliest")
                .option("maxOffsetsPerTrigger", cap)
                .load()
                .select(F.col("value").cast("string").alias("value")))
    if files_per_trigger and bytes_per_trigger:
        raise ValueError("a folder takes a cap of files or of bytes, not both")
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(bytes_per_trigger))
    return reader.load(directory)


def topic_cap(feed: str | None, partitions: int | None) -> int:
    """Records a trigger of a topic may take."""
    if feed not in RATE_PER_PARTITION:
        raise ValueError(f"feed must be one of {sorted(RATE_PER_PARTITION)}, not {feed!r}")
    if not partitions or partitions < 1:
        raise ValueError("the cap needs the topic's number of partitions")
    return RATE_PER_PARTITION[feed] * BATCH_SECONDS * partitions
