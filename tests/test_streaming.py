import os

from convoy.operators.tables import TableSpec, read_table
from convoy.streaming.ingest import file_stream, upsert_stream

SCHEMA = "order_id string, order_status string, order_date date, vehicle_id string"
SPEC = TableSpec("orders", "order_id", "order_date", ("order_status",))


def _drop(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("order_id,order_status,order_date,vehicle_id\n" + "\n".join(lines) + "\n")


def test_file_drops_upsert_in_order(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    table, ckpt = os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, "ckpt")
    _drop(src, "a.csv", ["o1,pending,2024-01-01,", "o2,in transit,2024-01-01,V1"])
    upsert_stream(file_stream(spark, src, SCHEMA), SPEC, table, ckpt).awaitTermination()
    _drop(src, "b.csv", ["o2,delivered,2024-01-02,V1", "o3,pending,2024-01-02,"])
    upsert_stream(file_stream(spark, src, SCHEMA), SPEC, table, ckpt).awaitTermination()
    got = sorted((r["order_id"], r["order_status"]) for r in read_table(spark, table).collect())
    assert got == [("o1", "pending"), ("o2", "delivered"), ("o3", "pending")]
    # nothing new: a restart from the checkpoint leaves the table as it is
    upsert_stream(file_stream(spark, src, SCHEMA), SPEC, table, ckpt).awaitTermination()
    assert read_table(spark, table).count() == 3
    assert not os.path.exists(os.path.join(table, "order_status=in transit"))


def test_processing_time_trigger(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    table, ckpt = os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, "ckpt")
    _drop(src, "a.csv", ["o1,pending,2024-01-01,", "o1,delivered,2024-01-03,V2"])
    q = upsert_stream(file_stream(spark, src, SCHEMA), SPEC, table, ckpt, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = [(r["order_id"], r["order_status"], r["vehicle_id"]) for r in read_table(spark, table).collect()]
    assert got == [("o1", "delivered", "V2")]  # latest row of the micro-batch wins
