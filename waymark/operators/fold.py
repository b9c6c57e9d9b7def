"""Ordered folds over a log, in parallel also within one log.

A fold such as "keep a frame that moved far enough from the last kept one" depends on all rows
before it. Rows are range-partitioned by (log, order), so a large log spans many partitions of
equal size. Every partition folds its rows with an assumed entry state; the exit states (one small
record per partition) are then passed on to the next partition of the same log, and the fold is
repeated where the assumption was wrong, until nothing changes. The result equals the
sequential fold; most logs fit one partition and need no second round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.session import cut_partitions

# step(state, row) -> (new state, output tuple or None); state None starts a log.
Step = Callable[[tuple | None, tuple], tuple[tuple | None, tuple | None]]


def ordered_fold(df: DataFrame, by: list[str], order: list[Column | str], inputs: list[str], step: Step,
                 outputs: str, partitions: int | None = None) -> DataFrame:
    """Fold each log in order. `step` sees the `inputs` of a row; its outputs extend the `by` columns."""
    keys = [*by, *order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys).select(
        F.spark_partition_id().alias("_part"), *by, *inputs)
    ranged = cut_partitions(ranged)
    width = len(by)

    def run(batches: Iterator[pd.DataFrame], entry: dict):
        """Yield (outputs of a batch) and remember the first log and the exit of the partition."""
        state, log, head, part = None, None, None, None
        for pdf in batches:
            rows = list(zip(*(pdf[c].tolist() for c in pdf.columns)))
            found = []
            for row in rows:
                here = row[1:1 + width]
                if here != log:
                    if log is None:
                        part, head = row[0], here
                        state = entry.get(part)
                    else:
                        state = None
                    log = here
                state, out = step(state, row[1 + width:])
                if out is not None:
                    found.append((*here, *out))
            yield found, (part, head, log, state)

    exit_schema = T.StructType([
        T.StructField("part", T.IntegerType()),
        T.StructField("head", T.StringType()),
        T.StructField("tail", T.StringType()),
        T.StructField("state", T.ArrayType(T.DoubleType())),
    ])

    def exits(entry: dict, only: set | None) -> dict:
        def probe(batches):
            last = None
            for _, last in run(batches, entry):
                pass
            if last is not None and last[0] is not None:
                part, head, tail, state = last
                yield pd.DataFrame({
                    "part": [int(part)], "head": [repr(head)], "tail": [repr(tail)],
                    "state": [None if state is None else [float(s) for s in state]],
                })

        src = ranged if only is None else ranged.filter(F.col("_part").isin(sorted(only)))
        # one row per partition
        return {r["part"]: r for r in src.mapInPandas(probe, exit_schema).collect()}

    entry: dict[int, tuple] = {}
    known = exits(entry, None)
    while True:
        changed: set[int] = set()
        upcoming: dict[int, tuple] = {}
        before = None
        for part in sorted(known):
            r = known[part]
            if before is not None and before["tail"] == r["head"] and before["state"] is not None:
                upcoming[part] = tuple(before["state"])
            if upcoming.get(part) != entry.get(part):
                changed.add(part)
            before = r
        if not changed:
            break
        entry = upcoming
        known.update(exits(entry, changed))

    by_types = [f for f in ranged.schema.fields if f.name in by]
    schema = T.StructType(by_types + T.StructType.fromDDL(outputs).fields)
    names = schema.names

    def emit(batches):
        for found, _ in run(batches, entry):
            if found:
                yield pd.DataFrame(found, columns=names)

    return ranged.mapInPandas(emit, schema)
