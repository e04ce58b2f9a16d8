"""Numbers along an order of a whole table."""

import random

from pyspark.sql import functions as F

from plimsoll.operators import running


def test_sparse_positions_are_numbered_without_gaps(spark):
    rng = random.Random(2)
    ids = list({rng.getrandbits(64) - (1 << 63) for _ in range(12_000)})
    rows = [("a" if i % 3 else "b", p) for i, p in enumerate(ids)] + [(None, 5), ("c", None)]
    df = spark.createDataFrame(rows, "suite string, pos long").repartition(7)
    got = {(r["suite"], r["pos"]): r["seq"] for r in running.numbered(df, ["suite"], "pos").collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0))
    assert got == {row: i + 1 for i, row in enumerate(order)}


def test_sparse_positions_spread_over_tasks(spark):
    """One suite with random 64-bit ids, and one that holds nearly all rows with dense ids."""
    rng = random.Random(3)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for ids in ([rng.getrandbits(62) for _ in range(20_000)], range(20_000)):
            df = spark.createDataFrame([("s", i) for i in ids], "suite string, pos long").repartition(5)
            sizes = [r["count"] for r in running.ranked_parts(df, ["suite", "pos"]).groupBy("__part").count().collect()]
            tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
            assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / tasks
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_nothing_is_numbered(spark):
    df = spark.createDataFrame([], "suite string, pos long")
    assert running.numbered(df, ["suite"], "pos").count() == 0
    assert running.numbered(df.select(F.col("pos")), [], "pos").columns == ["pos", "seq"]
