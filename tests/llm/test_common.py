"""Helpers that several operators share."""

import pyarrow as pa

from tessera.llm.common import ascii_lower, map_arrow, remainder, without
from tessera.session import BATCH_BYTES


def test_without_is_an_anti_join(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'t' as text").union(spark.sql("SELECT null, 'n'"))
    for some in ("doc_id % 7 = 0", "doc_id = 5", "false", "true"):
        keys = docs.filter(some).select("doc_id")
        want = docs.join(keys, "doc_id", "left_anti")
        got = without(docs, keys, "doc_id")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert got.columns == docs.columns


def test_ascii_lower_leaves_other_letters(spark):
    rows = spark.createDataFrame([("ABÉÀßİ日Z",), ("PLAIN az",)], "t string")
    assert [r[0] for r in rows.select(ascii_lower(rows["t"])).collect()] == ["abÉÀßİ日z", "plain az"]


def test_remainder_is_that_of_crc32(spark):
    import zlib

    rows = spark.createDataFrame([(1,), (123456789,), (None,)], "doc_id long").select("doc_id", remainder("doc_id", 5))
    for key, rest in rows.collect():
        assert rest == zlib.crc32(("" if key is None else str(key)).encode()) % 5


def test_a_slice_holds_few_bytes(spark):
    def sizes(batch):
        return pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    own = spark.newSession()
    try:
        own.conf.unset(BATCH_BYTES)
        docs = own.range(0, 250, 1, 1).selectExpr("repeat(cast(id as string), 40000) as text")
        got = map_arrow(docs, "n long, size long", sizes).collect()
        assert sum(r["n"] for r in got) == 250 and max(r["size"] for r in got) < 5_000_000
        own.conf.set(BATCH_BYTES, "1m")
        map_arrow(docs, "n long, size long", sizes)
        assert own.conf.get(BATCH_BYTES) == "1m"
    finally:
        spark.sparkContext._jvm.SparkSession.setActiveSession(spark._jsparkSession)
