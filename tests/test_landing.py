"""Text goes out and comes back as it was."""

import pytest

from tiffin.session import scratch
from tiffin.sources import landing

TEXTS = ['a\nb "q" \\ c,d\r\nx\ry', "", None, "  sp  ", '"', "\\N", "\\", "\n", 'a\\"b', '""', "\r",
         "é\t,", "x" * 200_000]


@pytest.mark.parametrize("gzip", [False, True])
def test_csv_loses_nothing(spark, gzip):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string").repartition(3)
    path = scratch(spark, "landing")
    landing.export(df, path, gzip=gzip)
    rows = landing.read_csv(spark, path, ["id", "t"]).collect()
    assert {int(r["id"]): r["t"] for r in rows} == dict(enumerate(TEXTS))
    assert all(r[landing.RESCUED] is None for r in rows)


def test_the_mark_of_null_is_refused(spark):
    df = spark.createDataFrame([(landing.NULL_MARK,)], "t string")
    with pytest.raises(Exception, match="mark of NULL"):
        landing.export(df, scratch(spark, "landing"))


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_a_stream_loses_nothing(spark, kind):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    root = scratch(spark, "landing")
    landing.write_shard(df, root, 0, kind)
    name = f"landed_{kind}"
    query = (landing.stream(spark, root, ["id", "t"], kind).writeStream.format("memory")
             .queryName(name).trigger(availableNow=True).start())
    query.awaitTermination()
    rows = spark.table(name).collect()
    assert {int(r["id"]): r["t"] for r in rows} == dict(enumerate(TEXTS))
