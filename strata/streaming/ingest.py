"""Bronze as a file stream, and silver upserts per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.plans.silver import silver_full
from strata.plans.stored import merge_silver
from strata.sources.tables import MONTH, Lake, month_of
from strata.sources.watermarks import CONTROL, Mark, advanced, control_table, stored_marks
from strata.specs import TABLES


def bronze_stream(
    spark: SparkSession,
    table: str,
    landing: str,
    target: str,
    checkpoint: str,
    source_system: str,
) -> StreamingQuery:
    """Append the parquet files that arrived in `landing` to `target`, each exactly once.

    Takes what is there and ends; run it as often as the data should be fresh. The
    checkpoint must lie in storage that all executors share.
    """
    rows = spark.readStream.schema(TABLES[table].source_schema).parquet(landing)
    stamped = rows.withColumns(
        {
            "load_timestamp": F.current_timestamp().cast("timestamp_ntz"),
            "source_system": F.lit(source_system),
            MONTH: month_of("created_at"),
        }
    )
    return (
        stamped.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy(MONTH)
        .trigger(availableNow=True)
        .start()
    )


def silver_upsert(lake: Lake, table: str) -> Callable[[DataFrame, int], None]:
    """For `writeStream.foreachBatch`: clean a micro-batch of bronze rows and upsert it.

    A batch that is repeated after a failure upserts the same rows. A row older than the
    one in silver does not replace it, since files can arrive out of order.
    """
    spec = TABLES[table]
    name = f"silver.{table}"

    def apply(batch: DataFrame, _epoch: int) -> None:
        rows = silver_full(table, batch)
        if lake.exists(name):
            known = lake.read(name).select(*spec.keys, F.col("updated_at").alias("_known"))
            rows = (
                rows.join(known, list(spec.keys), "left")
                .filter(F.col("_known").isNull() | (F.col("updated_at") >= F.col("_known")))
                .drop("_known")
            )
        # A batch is a load of its own: the facts take in its changes like those of a job.
        marks = stored_marks(lake)
        names = [f"bronze.{table}", name]
        load = 1 + max(marks.get(n, Mark()).load for n in names)
        merge_silver(lake, table, rows, marks.get(name, Mark()).load, load)
        moved = {n: Mark(marks.get(n, Mark()).at, load) for n in names}
        lake.publish(advanced(control_table(lake.spark, lake), moved), CONTROL)

    return apply
