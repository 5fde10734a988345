"""Month load driven by newly arriving staging files.

    q = run_month_feed(spark, staging_dir, posts_schema, roster, kpi, price,
                       short_path, full_path)

``readStream`` on the staging folder; ``foreachBatch`` takes the month labels
of the new files (a handful of values) and replaces those months in both
marts from the *whole* staging table, because a month may arrive in several
files.  Replaying a batch after a failure replaces the same slices again, so
the marts see each batch exactly once in effect.  The caller names the stream's
checkpoint folder (shared, and the same at each start: a new one would replay
every file).  A staging folder partitioned by month is pruned to the months of
the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vitrina.plans.load import load_payment_months


def run_month_feed(spark: SparkSession, staging_dir: str, posts_schema: StructType,
                   roster: DataFrame, kpi: DataFrame, price: DataFrame, short_path: str,
                   full_path: str, checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    """Start the feed; with ``available_now`` it processes what is there and stops."""

    def load(batch: DataFrame, epoch_id: int) -> None:
        months = [r[0] for r in batch.select("sheets_name").where(F.col("sheets_name").isNotNull())
                                     .distinct().collect()]  # month labels only
        if not months:
            return
        s = batch.sparkSession
        posts = s.read.schema(posts_schema).parquet(staging_dir)
        load_payment_months(s, posts, roster, kpi, price, short_path, full_path, sorted(months), written=True)

    w = (spark.readStream.schema(posts_schema).parquet(staging_dir)
         .writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
