"""Row numbers and fixed-size batches without a single-task window."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.operators.selection import require_positive
from docweave.session import stage


def _number_groups(group_width):
    """Partition function: appends each row's position in its group, and whether
    the group is the first of the task.

    The rows of a task arrive sorted, so a group is one run of rows; only the
    last group key and its count are carried from batch to batch.
    """

    def run(batches):
        last, count, first_run = None, 0, True
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            keys = batch.columns[:group_width]
            new_run = np.zeros(n, dtype=bool)
            for key in keys:
                codes = key.dictionary_encode(null_encoding="encode").indices
                codes = codes.to_numpy(zero_copy_only=False)
                new_run[1:] |= codes[1:] != codes[:-1]
            here = tuple(key[0].as_py() for key in keys)
            goes_on = last is None or here == last
            begins = np.concatenate([[0], np.flatnonzero(new_run)])
            lengths = np.diff(np.append(begins, n))
            position = np.arange(n) - np.repeat(begins, lengths)
            lead = np.zeros(n, dtype=bool)
            if goes_on:
                position[:lengths[0]] += count
                lead[:lengths[0]] = first_run
            first_run = first_run and goes_on and len(begins) == 1
            last, count = tuple(key[n - 1].as_py() for key in keys), int(position[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(position, pa.int64()), pa.array(lead)],
                names=[*batch.schema.names, "_position", "_lead"])

    return run


def number_rows(rows: DataFrame, order_by, within=(), name="row_no", partitions=None) -> DataFrame:
    """Adds `name`: 0, 1, 2, ... in the order of `order_by`, per group of `within`.

    `order_by` names columns that are unique within a group. One range shuffle
    on (within, order_by) spreads even a group holding most rows over many
    tasks; each task numbers its own rows and the counts of the tasks before it
    are added. A task can start in the middle of a group for its first group
    only, so these offsets are at most one row per task and safe to broadcast.
    """
    within, order_by = list(within), list(order_by)
    keys = [*within, *order_by]
    rest = [c for c in rows.columns if c not in within]
    ordered = rows.select(*within, *rest)
    ranged = (ordered.repartitionByRange(partitions, *keys) if partitions
              else ordered.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    schema = T.StructType([*ranged.schema.fields, T.StructField("_position", T.LongType()),
                           T.StructField("_lead", T.BooleanType())])
    # Written once: the task numbers must be the same for the rows and the offsets.
    numbered = stage(ranged.mapInArrow(_number_groups(len(within)), schema)
                     .withColumn("_task", F.spark_partition_id()), "numbered")

    group = within or [F.lit(0).alias("_all")]
    sizes = numbered.groupBy(*group, "_task").agg(
        F.count(F.lit(1)).alias("_rows"), F.bool_or("_lead").alias("_lead"))
    before = (Window.partitionBy(*(within or ["_all"])).orderBy("_task")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (sizes.withColumn("_offset", F.sum("_rows").over(before))
               .where("_lead and _offset is not null").select("_task", "_lead", "_offset"))
    placed = numbered.join(F.broadcast(offsets), ["_task", "_lead"], "left")
    row_no = F.col("_position") + F.coalesce("_offset", F.lit(0))
    return placed.select(*rows.columns, row_no.alias(name))


def fixed_batches(rows: DataFrame, batch_size: int, order_by, within=(), partitions=None) -> DataFrame:
    """Adds `batch_no` and `position`: batches of `batch_size` rows in the given
    order, per group of `within`; the last batch of a group may be shorter."""
    require_positive(batch_size, "batch size")
    numbered = number_rows(rows, order_by, within, "_row_no", partitions)
    return numbered.select(
        *rows.columns,
        F.floor(F.col("_row_no") / batch_size).cast("bigint").alias("batch_no"),
        (F.col("_row_no") % batch_size).alias("position"))
