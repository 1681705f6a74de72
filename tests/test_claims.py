"""The queue's stream: ids are handed out once, come back when stale, and state outlives a restart."""

import datetime
import time

from terrane.streaming import claims

AT = datetime.datetime(2024, 5, 1)


def run(spark, root, batches):
    """Each batch as one run of the stream from its checkpoint; the claims so far."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", claims.PROVIDER)
    try:
        for rows in batches:
            data = [(q, AT + datetime.timedelta(minutes=m), kind, i, w) for q, m, kind, i, w in rows]
            spark.createDataFrame(data, claims.EVENTS).coalesce(1).write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(claims.EVENTS).parquet(f"{root}/in")
            query = claims.claims(stream).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp").outputMode("append").trigger(availableNow=True).start()
            query.awaitTermination()
            time.sleep(0.1)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    return sorted(((r["at"] - AT).total_seconds() / 60, r["queue"], r["worker"], r["id"]) for r in spark.read.parquet(f"{root}/out").collect())


def test_claims(spark, tmp_path):
    add = lambda m, *ids: [("q", m, "add", i, None) for i in ids]
    ask = lambda m, w, q="q": (q, m, "ask", None, w)
    batches = [
        [*add(0, 1, 2, 3, 2), ask(1, "a"), ask(1, "b"), ("other", 0, "add", 9, None), ask(1, "a", "other")],
        # After a restart: 3 is done, 1 is left; then nothing, until the claims of minute 1 are stale.
        [("q", 2, "done", 3, "a"), ("q", 2, "done", 2, "a"), ask(3, "c"), ask(4, "d"), *add(5, 3)],
        [ask(30, "e"), ask(31, "f"), ("q", 31, "done", 2, "b")],
        [ask(70, "g"), ask(70, "h"), ask(70, "i"), ask(50, "x", "other"), ask(50, "y", "other")],
    ]
    got = run(spark, str(tmp_path), batches)
    assert got[:5] == [(1, "other", "a", 9), (1, "q", "a", 3), (1, "q", "b", 2), (3, "q", "c", 1), (4, "q", "d", None)]
    # b says in its last minute that 2 is done, which counts before the ask; c never does so for 1, which comes back.
    assert got[5:7] == [(30, "q", "e", None), (31, "q", "f", None)]
    assert got[9:] == [(70, "q", "g", 1), (70, "q", "h", None), (70, "q", "i", None)]
    held = {}
    for m, q, w, i in got:
        if i is not None:
            assert m - held.get((q, i), -99) >= 30
            held[q, i] = m
    assert [x[3] for x in got if x[0] == 50] == [9, None]
