"""Writing a table in a fixed number of files."""

import pytest

from tripspark.sources import writers


@pytest.mark.parametrize("parts,spread,shuffled", [(20, False, False), (20, True, True),
                                                   (3, False, True)])
def test_files_without_a_shuffle(spark, tmp_path, parts, spread, shuffled):
    """Neighbouring partitions share a file, unless rows are dealt anew."""
    spark.range(1000, numPartitions=parts).write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    spark.conf.set("spark.sql.files.openCostInBytes", "1g")  # a partition for each file
    try:
        assert source.rdd.getNumPartitions() == parts
        writers.write_variant(source, str(tmp_path / "out"), "parquet", "snappy", 8, spread)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    files = sorted((tmp_path / "out").glob("part-*"))
    assert len(files) == 8
    found = [[r["id"] for r in spark.read.parquet(str(f)).collect()] for f in files]
    assert sorted(i for ids in found for i in ids) == list(range(1000))
    # Without a shuffle every file holds whole partitions of the source.
    size = 1000 // parts
    whole = all(set(range(i // size * size, i // size * size + size)) <= set(ids)
                for ids in map(set, found) for i in ids)
    assert whole != shuffled
