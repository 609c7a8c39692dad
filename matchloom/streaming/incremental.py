"""Matching newly arrived first-side rows against a stored key index, with Structured Streaming.

The index of the second side (its keys and the rare ones' IDF) is built once in batch and stored partitioned
by country. Each micro-batch makes its rows' keys, joins the index and appends its ranked candidates;
there is no state between batches, so late rows and restarts need no watermark: the checkpoint of the
query and the batch id make every batch's output replace itself.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from matchloom.operators import blocking, keys


def store_index(s23: DataFrame, kinds: tuple[str, ...], folder: str) -> None:
    """Keys of the second side and the rare keys, under ``folder``."""
    k = keys.keys(s23, kinds).withColumnRenamed("gid", "s23_gid")
    rare = blocking.rare_keys(k, blocking.pool_sizes(s23))
    rare.write.mode("overwrite").partitionBy("country").parquet(f"{folder}/rare")
    k.join(rare.select("country", "kind", "key"), ["country", "kind", "key"], "left_semi").write.mode("overwrite").partitionBy("country").parquet(f"{folder}/keys")


def candidates(spark: SparkSession, rows: DataFrame, kinds: tuple[str, ...], folder: str, k: int) -> DataFrame:
    """Ranked candidates of ``rows`` from the stored index."""
    own = keys.keys(rows, kinds).withColumnRenamed("gid", "s1_gid")
    return blocking.top(blocking.score(own, spark.read.parquet(f"{folder}/keys"), spark.read.parquet(f"{folder}/rare"), kinds), k)


def start(stream: DataFrame, kinds: tuple[str, ...], folder: str, out: str, checkpoint: str, k: int = blocking.BEST_FIRST, once: bool = False) -> StreamingQuery:
    """Starts matching ``stream`` (the columns that ``kinds`` need); candidates go to ``out``/batch=N."""

    def step(batch: DataFrame, number: int) -> None:
        candidates(batch.sparkSession, batch, kinds, folder, k).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
