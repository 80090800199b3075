import pyarrow as pa

from daygrid.llm.batches import BATCH_BYTES, _bytes, in_small_batches

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "size"])


def test_batches_are_bounded_and_lose_nothing(spark):
    before = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "64m")
        rows = spark.range(3000, numPartitions=1).selectExpr("id", "repeat('x', IF(id = 7, 9000000, 10000)) AS text")
        found = in_small_batches(rows).mapInArrow(sizes, "rows bigint, size bigint").collect()
        assert sum(r.rows for r in found) == 3000 and len(found) > 6
        assert sorted(r["size"] for r in found)[-2] < 1.1 * BATCH_BYTES
        spark.conf.set(LIMIT, "1m")
        in_small_batches(rows)
        assert spark.conf.get(LIMIT) == "1m"
    finally:
        spark.conf.set(LIMIT, before)


def test_sizes_are_read():
    assert [_bytes(x) for x in ("67108864b", "5", "4m", "2KB", "1g")] == [67108864, 5, 4 << 20, 2048, 1 << 30]
