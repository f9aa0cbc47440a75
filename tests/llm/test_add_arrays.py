"""Sums of arrays: few tasks, each run once, however many partitions a shuffle has."""

import numpy as np
import pyarrow as pa

from tripspark.llm import common


def test_few_tasks_add_arrays_up_once(spark):
    cells = np.arange(6_400, dtype=np.int64)

    def make(batches):
        for batch in batches:
            for n in batch.column("id").to_pylist():
                yield common.array_rows(cells + n, 64)

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "150")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    context = spark.sparkContext
    context.setJobGroup("adding", "adding")
    try:
        rows = spark.range(0, 20, 1, 5).mapInArrow(make, common.ARRAY_SCHEMA)
        found = common.add_arrays(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        context.setLocalProperty("spark.jobGroup.id", None)
    assert found.tolist() == (20 * cells + sum(range(20))).tolist()
    status = context.statusTracker()
    stages = {s for job in status.getJobIdsForGroup("adding") for s in status.getJobInfo(job).stageIds}
    tasks = sum(info.numCompletedTasks for info in map(status.getStageInfo, stages) if info)
    assert tasks <= 5 + sum(common.ROUNDS)


def test_a_task_without_rows_has_nothing_to_give_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    run = common.tidy(lambda batches: (b for b in batches))
    empty = pa.RecordBatch.from_pydict({"a": pa.array([], pa.int64())})
    assert list(run([empty])) == [empty] and not calls
    full = pa.RecordBatch.from_pydict({"a": [1]})
    assert list(run([full])) == [full] and calls == [1]
