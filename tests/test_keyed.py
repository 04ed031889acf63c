"""The upsert as keyed state: late and repeated rows, restarts, timers."""

import random
import time

from gleanrow.streaming import keyed

SCHEMA = "id long, name string, price double, first string, seq long"


def plain(rows):
    """All rows in order, one after the other, by the rules."""
    out = {}
    for i, name, price, first, _ in sorted(rows, key=lambda r: r[4]):
        old = out.get(i)
        out[i] = (name, price, first) if old is None else (name, old[1] if price is None else price, old[2])
    return sorted((i, *v) for i, v in out.items())


def land(spark, rows, src):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(src)


def test_late_and_repeated_rows_and_restarts(spark, tmp_path):
    rng = random.Random(7)
    rows = [(rng.randrange(12), rng.choice(["a", "b", None]), rng.choice([1.0, 2.5, None]), rng.choice(["x", "y", None]), seq) for seq in range(120)]
    rng.shuffle(rows)
    src, table, seen = str(tmp_path / "in"), str(tmp_path / "t"), []
    for batch in (rows[:50], rows[50:90] + rows[:20], rows[90:], rows[:5]):
        seen += batch
        land(spark, batch, src)
        changed = keyed.changes(spark.readStream.schema(SCHEMA).json(src), ["id"], "seq", ["name"], ["first"])
        keyed.write_changes(changed, table, str(tmp_path / "cp")).awaitTermination()
        got = keyed.current(spark, table, ["id"]).select("id", "name", "price", "first").collect()
        assert sorted(map(tuple, got)) == plain(set(seen))
    assert spark.read.parquet(f"{table}/written_in=3").count() == 0


def test_a_timer_gathers_the_changes_of_a_key(spark, tmp_path):
    src, table = str(tmp_path / "in"), str(tmp_path / "t")
    for k in range(4):
        land(spark, [(1, f"n{k}", float(k), "x", k)], src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    changed = keyed.changes(stream, ["id"], "seq", ["name"], ["first"], settle_ms=6000)
    run = keyed.write_changes(changed, table, str(tmp_path / "cp"), processingTime="200 milliseconds")
    try:
        end = time.time() + 60
        while time.time() < end:
            time.sleep(1)
            if list((tmp_path / "t").glob("written_in=*")) and keyed.current(spark, table, ["id"]).where("name = 'n3'").count():
                break
        rows = keyed.current(spark, table, ["id"]).collect()
    finally:
        run.stop()
    assert [tuple(r)[0] for r in rows] == [1]
    written = spark.read.parquet(table)
    assert written.count() < 4 and written.where("name = 'n3'").count() == 1
