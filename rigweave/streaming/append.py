"""Structured Streaming forms of the append-only steps (an addition: the batch operators need no stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

#: Folders by which the keys written so far are found.
KEY_BUCKETS = 256


def append_once(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, key: str) -> StreamingQuery:
    """Append the rows of new files to a table, each key once, however often files or batches are delivered again.

    A batch goes to its own folder batch=N, overwritten if the batch is retried, and holds only keys that no earlier batch
    holds. The keys written so far lie beside the table by hash bucket, and a batch reads only the buckets that its own keys
    fall in, so a small batch does not read all that came before.
    """
    known = target.rstrip("/") + ".keys"
    kind = dict(zip(schema.fieldNames(), (f.dataType for f in schema.fields)))[key]
    keys = StructType().add(key, kind).add("batch", "long").add("bucket", "integer")

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        fresh = batch.dropDuplicates([key]).where(F.col(key).isNotNull()).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int"))
        hadoop = session.sparkContext._jvm.org.apache.hadoop.fs.Path(known)
        if hadoop.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]
            earlier = session.read.schema(keys).parquet(known).where((F.col("batch") < number) & F.col("bucket").isin(touched)).select(key)
            fresh = fresh.join(earlier, key, "left_anti")
        fresh.drop("bucket").write.mode("overwrite").parquet(f"{target}/batch={number}")
        # from the rows as written: what a retry writes is what its keys say
        written = session.read.schema(schema).parquet(f"{target}/batch={number}").select(key)
        written.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{known}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "2 days") -> DataFrame:
    """Rows per key and tumbling window; rows later than `late` behind the newest are dropped, as a watermark implies."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")
