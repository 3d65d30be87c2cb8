from golden import lines
from linetally.operators import profile as prof
from linetally.streaming.profile_stream import start_text_groups_stream


def test_stream_matches_batch(spark, scratch):
    df = lines(spark)
    df.limit(4).write.parquet(f"{scratch}/in/a")
    df.write.mode("append").parquet(f"{scratch}/in/a")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in/a")
    q = start_text_groups_stream(stream, snapshot_path=f"{scratch}/out", available_now=True,
                                 checkpoint_location=f"{scratch}/ckpt")
    q.awaitTermination(120)
    got = {r["text"]: r.asDict() for r in spark.read.parquet(f"{scratch}/out").collect()}
    want = {r["text"]: r.asDict() for r in prof.text_groups(spark.read.parquet(f"{scratch}/in/a")).collect()}
    assert got == want
