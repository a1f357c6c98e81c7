"""Batches that close by count or by time, for whole tables.

A batch closes at the first row that fills it or that arrives ``interval`` or more after the
last closing row. From closing row ``p`` the next one is therefore
``min(p + n, first row at or after arrival(p) + interval)``, which needs at most the next ``n``
rows. Following this step from the first row is a chain over all rows of a key, yet the chain
can be cut: where it enters a block of rows, it enters within the block's first ``n`` rows.

1. Rows are cut into blocks by their place in the key; each block also gets the ``n`` rows
   after it. For every possible entry a block works out where the chain leaves it.
2. Blocks are composed in groups, and the groups of a key are walked from its first row,
   which gives each group, then each block, its real entry.
3. Each block marks its closing rows from there.

No task sees more than one block, one group of block summaries, or one key's groups.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from wirelake.operators.scan import ordinal
from wirelake.session import send_code_with_tasks

send_code_with_tasks(__name__)

OPEN = -1  # the chain ends: no later row closes a batch

_SUMMARY = "start BIGINT, exits ARRAY<BIGINT>, closings ARRAY<BIGINT>"
_ENTRY = "entry BIGINT, first_batch BIGINT"


def batch_count_or_time(
    rows: DataFrame,
    key: str,
    order: str,
    size: int = 500,
    interval_us: int = 1_000_000,
    *,
    arrival: str = "arrival",
    width: int = 1 << 16,
    group: int = 1024,
) -> DataFrame:
    """Add ``batch_no`` and ``closes`` (does this row close its batch?) to rows in arrival order.

    The clock starts at a key's first row; arrival times must not go back. The last batch of a
    key stays open if no row closes it. Nothing is refused: intake is bounded at the source.
    """
    width = max(width, size)
    own = (
        ordinal(rows, (key,), order, "_i")
        .withColumn("_us", F.unix_micros(arrival))
        .withColumn("_block", F.floor(F.col("_i") / width).cast("bigint"))
        .withColumn("_own", F.lit(True))
    )
    # One pass gives every row to its block and the first rows of a block to the one before.
    ahead = (F.col("_i") % width < size) & (F.col("_block") > 0)
    homes = F.when(ahead, F.array("_block", F.col("_block") - 1)).otherwise(F.array("_block"))
    spread = (
        own.withColumn("_home", F.explode(homes))
        .withColumn("_own", F.col("_home") == F.col("_block"))
        .drop("_block")
        .withColumnRenamed("_home", "_block")
    )
    steps = _Steps(size, interval_us)
    key_type = rows.schema[key].dataType
    blocks = spread.groupBy(key, "_block").applyInPandas(
        _summarise(steps, key), _schema(key, key_type, "_block", _SUMMARY)
    )
    grouped = blocks.withColumn("_group", F.floor(F.col("_block") / group).cast("bigint"))
    groups = grouped.groupBy(key, "_group").applyInPandas(
        _compose(key), _schema(key, key_type, "_group", _SUMMARY)
    )
    group_entries = groups.groupBy(key).applyInPandas(
        _walk_key(key), _schema(key, key_type, "_group", _ENTRY)
    )
    block_entries = (
        grouped.groupBy(key, "_group")
        .cogroup(group_entries.groupBy(key, "_group"))
        .applyInPandas(_walk_group(key), _schema(key, key_type, "_block", _ENTRY))
    )
    out = T.StructType(
        [
            *rows.schema.fields,
            T.StructField("batch_no", T.LongType()),
            T.StructField("closes", T.BooleanType()),
        ]
    )
    return (
        spread.groupBy(key, "_block")
        .cogroup(block_entries.groupBy(key, "_block"))
        .applyInPandas(_mark(steps, rows.columns), out)
    )


def batch_list(marked: DataFrame, key: str, order: str) -> DataFrame:
    """One row per batch: its rows, first and last place, and whether it was closed."""
    return (
        marked.groupBy(key, "batch_no")
        .agg(
            F.count("*").alias("rows"),
            F.min(order).alias("first_seq"),
            F.max(order).alias("last_seq"),
            F.bool_or("closes").alias("closed"),
        )
    )


def _schema(key: str, key_type: T.DataType, place: str, rest: str) -> T.StructType:
    fields = [T.StructField(key, key_type), T.StructField(place, T.LongType())]
    return T.StructType(fields + T.StructType.fromDDL(rest).fields)


class _Steps:
    """The step from one closing row to the next, within a block and the rows after it."""

    def __init__(self, size: int, interval_us: int):
        self.size, self.interval_us = size, interval_us

    def after(self, us: np.ndarray, own: int) -> np.ndarray:
        """Next closing row of each own row; ``len(us)`` where there is none."""
        place = np.arange(own)
        by_time = np.searchsorted(us, us[:own] + self.interval_us, side="left")
        step = np.minimum(np.maximum(by_time, place + 1), place + self.size)
        return np.minimum(step, len(us))

    def first(self, us: np.ndarray) -> int:
        by_time = int(np.searchsorted(us, us[0] + self.interval_us, side="left"))
        return min(by_time, self.size - 1, len(us))


def _sorted(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, int]:
    pdf = pdf.sort_values("_i", kind="stable")
    return pdf, pdf["_us"].to_numpy(), int(pdf["_own"].sum())


def _summarise(steps: _Steps, key: str):
    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, us, own = _sorted(pdf)
        end = len(us)
        # Rows after the block, and the end mark, lead to themselves; doubling the step
        # until all entries are outside follows every chain at once.
        chain = np.arange(end + 1)
        chain[:own] = steps.after(us, own)
        count = np.zeros(end + 1, dtype=np.int64)
        count[:own] = 1
        entries = min(steps.size, own)
        while (chain[:entries] < own).any():
            count = count + count[chain]
            chain = chain[chain]
        exits = np.where(chain[:entries] == end, OPEN, chain[:entries] - own)
        block = int(pdf["_block"].iloc[0])
        start = steps.first(us) if block == 0 else OPEN
        return pd.DataFrame(
            {
                key: [pdf[key].iloc[0]],
                "_block": [block],
                "start": [OPEN if start == end else start],
                "exits": [exits],
                "closings": [count[:entries]],
            }
        )

    return summarise


def _compose(key: str):
    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        first = pdf.iloc[0]
        exits = np.array(first["exits"], dtype=np.int64)
        closings = np.array(first["closings"], dtype=np.int64)
        for more, added in zip(pdf["exits"].iloc[1:], pdf["closings"].iloc[1:]):
            going = exits != OPEN
            at = exits[going]
            closings[going] += np.asarray(added, dtype=np.int64)[at]
            exits[going] = np.asarray(more, dtype=np.int64)[at]
        return pd.DataFrame(
            {
                key: [first[key]],
                "_group": [int(first["_group"])],
                "start": [int(first["start"])],
                "exits": [exits],
                "closings": [closings],
            }
        )

    return compose


def _walk(pdf: pd.DataFrame, place: str, key: str, entry: int, batch: int) -> pd.DataFrame:
    entries, batches = [], []
    for exits, closings in zip(pdf["exits"], pdf["closings"]):
        entries.append(entry)
        batches.append(batch)
        if entry != OPEN:
            batch += int(closings[entry])
            entry = int(exits[entry])
    return pd.DataFrame(
        {key: pdf[key].to_numpy(), place: pdf[place].to_numpy(), "entry": entries, "first_batch": batches}
    )


def _walk_key(key: str):
    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_group")
        return _walk(pdf, "_group", key, int(pdf["start"].iloc[0]), 0)

    return walk


def _walk_group(key: str):
    def walk(blocks: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        at = entries.iloc[0]
        blocks = blocks.sort_values("_block")
        return _walk(blocks, "_block", key, int(at["entry"]), int(at["first_batch"]))

    return walk


def _mark(steps: _Steps, columns: list[str]):
    def mark(pdf: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        pdf, us, own = _sorted(pdf)
        at = entries.iloc[0]
        closes = np.zeros(own, dtype=bool)
        place = own if at["entry"] == OPEN else int(at["entry"])
        after = steps.after(us, own)
        while place < own:
            closes[place] = True
            place = int(after[place])
        # A row belongs to the batch that the next closing row ends.
        number = int(at["first_batch"]) + np.cumsum(closes) - closes
        out = pdf[columns].iloc[:own].copy()
        out["batch_no"], out["closes"] = number, closes
        return out

    return mark
