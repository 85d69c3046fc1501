"""Incremental clean-and-load of new raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.impute import impute_cascade
from ..operators.joins import join_dim, new_rows
from ..operators.ledger import Ledger
from ..operators.load import first_known, load_star, open_target, stage
from ..plans.clean import clean
from ..schemas import RAW_SCHEMA
from ..session import drop_stored, store


def _stream(spark: SparkSession, src: str, schema: T.StructType, fmt: str, files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.load(src)


def _drain(stream: DataFrame, each, checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _label(spark: SparkSession, checkpoint: str, number: int) -> str:
    """Names a micro-batch. The id in the checkpoint tells a replay from the first batches of a new stream."""
    return f"{spark.read.text(f'{checkpoint}/metadata', wholetext=True).first()[0].strip()} {number}"


def incremental_append(spark: SparkSession, src: str, target: str, checkpoint: str, schema: T.StructType,
                       keys: list[str], fmt: str = "parquet", files_per_batch: int | None = None) -> None:
    """Append rows of new files whose key is not in the target yet, then stop; `appended` reads them.

    Each key lands exactly once: a micro-batch is a recorded batch of the target, so a
    replayed one is skipped or written over. It reads only stored files that may hold its keys.
    """

    def each(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        ledger, label = Ledger(session, target), _label(session, checkpoint, number)
        if ledger.knows(label):
            return
        firsts = store(first_known(batch.withColumn("__at", F.monotonically_increasing_id()), keys, "__at").select(*schema.fieldNames()))
        stored = ledger.read("rows", schema, ledger.files_holding("rows", firsts, keys))
        added = ledger.write("rows", new_rows(firsts, stored, keys), keys)
        ledger.commit(label, {}, {"rows": added})
        drop_stored(firsts)

    _drain(_stream(spark, src, schema, fmt, files_per_batch), each, checkpoint)


def appended(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rows that `incremental_append` has recorded."""
    return Ledger(spark, target).read("rows", schema)


def incremental_load(spark: SparkSession, src: str, target: str, checkpoint: str, prices: DataFrame | None = None,
                     fmt: str = "csv", files_per_batch: int | None = None, price_order: str = "seq") -> None:
    """New raw files through the cleaning chain into the star tables, then stop.

    Prices stay as found: a filled price would depend on what else is in the micro-batch,
    and with it the row's signature. `filled_prices` fills them from the whole stored table.
    A micro-batch is one recorded batch of the target (see `load_star`): its rows appear in all
    eight tables or in none, and a replayed one is skipped once it is recorded.
    """

    def each(batch: DataFrame, number: int) -> None:
        staged = stage(clean(batch, prices, impute=False, price_order=price_order)).withColumn("__at", F.monotonically_increasing_id())
        load_star(batch.sparkSession, target, store(staged), "__at", label=_label(batch.sparkSession, checkpoint, number))

    _drain(_stream(spark, src, RAW_SCHEMA, fmt, files_per_batch), each, checkpoint)


def filled_prices(spark: SparkSession, target: str) -> DataFrame:
    """The stored devices with brand and model, gaps in price_eur filled from all stored rows."""
    star = {t: open_target(spark, target, t) for t in ("Device", "Device_Name")}
    rows = join_dim(star["Device"], star["Device_Name"], "device_name_id", ["brand", "model"])
    return impute_cascade(rows, value="price_eur")
