"""Score a stream of texts with the batch scorer.

Files arriving in a folder are read with ``readStream`` and each
micro-batch goes through the same ``score`` plan as a batch table
(``foreachBatch``); that plan is map-only, so there is no streaming state
and nothing stays cached after a batch. Each
epoch's output is written to its own ``epoch=<id>`` folder with
overwrite, so a replayed epoch after a failure rewrites the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimflow.operators.score import Scorer, score


def start_scoring_stream(spark: SparkSession, source_dir: str, schema: T.StructType, scorer: Scorer,
                         key: str, sink_dir: str, checkpoint_dir: str, text_col: str = "text",
                         fmt: str = "parquet", glob: str | None = None,
                         available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        out = score(batch, scorer, key, text_col)
        out.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/epoch={epoch_id}")

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def score_stream_once(spark: SparkSession, source_dir: str, schema: T.StructType, scorer: Scorer,
                      key: str, sink_dir: str, checkpoint_dir: str, **kw) -> DataFrame:
    """Run the stream over the files present now and return what it wrote."""
    q = start_scoring_stream(spark, source_dir, schema, scorer, key, sink_dir, checkpoint_dir, **kw)
    q.awaitTermination()
    return spark.read.parquet(sink_dir)
