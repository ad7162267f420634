"""Change rows applied as they arrive, with the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.sources.buckets import Buckets
from tessera.sources.snapshots import read_snapshot, write_snapshot

#: ``(state, changes) -> (next state, outcomes)``, e.g. operators.changes.upsert_measures
Apply = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def begin(initial: DataFrame, state_root: str) -> None:
    """Store the state the first batch starts from, as version -1."""
    write_snapshot(initial, state_root, -1)


def start(
    changes: DataFrame,
    apply: Apply,
    state_root: str,
    outcome_root: str,
    checkpoint: str,
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Fold a stream of changes into snapshots, one version per batch.

    Batch n reads version n - 1 and writes version n.  A batch that is run again after
    a failure finds the same input and overwrites the same version, so each change
    takes effect once.  ``after`` is told the version.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        state, outcomes = apply(read_snapshot(batch.sparkSession, state_root, batch_id - 1), batch)
        write_snapshot(state, state_root, batch_id)
        write_snapshot(outcomes, outcome_root, batch_id)
        if after is not None:
            after(batch_id)

    return (
        changes.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_bucketed(
    changes: DataFrame,
    apply: Apply,
    state: Buckets,
    outcome_root: str,
    checkpoint: str,
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """As ``start``, but a batch reads and writes only the buckets that its keys fall into.

    ``apply`` must treat rows of different bucket keys apart.  The state begins with
    ``state.begin``; a batch is read once.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            touched = state.touched(batch)
            part, outcomes = apply(state.read(spark, batch_id - 1, touched), batch)
            state.write(part, batch_id, touched)
            write_snapshot(outcomes, outcome_root, batch_id)
        finally:
            batch.unpersist()
        if after is not None:
            after(batch_id)

    return (
        changes.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
