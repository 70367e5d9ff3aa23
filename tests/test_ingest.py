import os
import time

from pyspark.sql import types as T

from remitflow.sources.ingest import load_landing
from remitflow.streaming.landing import empty_files, start_landing_stream

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("amount", T.DoubleType())])


def _land(folder):
    os.makedirs(folder, exist_ok=True)
    open(os.path.join(folder, "a.csv"), "w").write("1,x,1.5\n2,y,2.5\n")
    open(os.path.join(folder, "b.csv"), "w").write("3,z,oops\n4,w,4.0\n")      # bad number
    open(os.path.join(folder, "c.csv"), "w").write("5,v\n")                    # too few columns
    open(os.path.join(folder, "d.csv"), "w").write("")                         # empty file


def test_landing_quarantine(spark, tmp_out):
    land = os.path.join(tmp_out, "land")
    _land(land)
    res = load_landing(spark, land, SCHEMA, ["id", "amount"])
    assert sorted(r.id for r in res.good.collect()) == [1, 2]   # nothing of a file with a reject
    assert sorted(r.file_name for r in res.rejected.collect()) == ["b.csv", "c.csv"]
    st = {os.path.basename(r.file_path): (r.n_good, r.n_bad, r.status) for r in res.file_status.collect()}
    assert st == {"a.csv": (2, 0, "OK"), "b.csv": (1, 1, "BATCH ERROR"), "c.csv": (0, 1, "BATCH ERROR"),
                  "d.csv": (0, 0, "EMPTY FILE")}


def test_landing_stream_available_now(spark, tmp_out):
    land = os.path.join(tmp_out, "land")
    _land(land)
    out = {k: os.path.join(tmp_out, k) for k in ("good", "bad", "status", "ckpt")}

    def run():
        start_landing_stream(spark, land, SCHEMA, ["id", "amount"], out["good"], out["bad"], out["status"], out["ckpt"]).awaitTermination(120)

    run()
    assert sorted(r.id for r in spark.read.parquet(out["good"]).collect()) == [1, 2]
    st = {os.path.basename(r.file_path): (r.n_good, r.n_bad, r.status) for r in spark.read.parquet(out["status"]).collect()}
    assert st == {"a.csv": (2, 0, "OK"), "b.csv": (1, 1, "BATCH ERROR"), "c.csv": (0, 1, "BATCH ERROR")}
    assert [os.path.basename(r.file_path) for r in empty_files(spark, land).collect()] == ["d.csv"]
    # a second run sees no new files: nothing is processed twice
    open(os.path.join(land, "e.csv"), "w").write("6,u,6.0\n")
    run()
    assert sorted(r.id for r in spark.read.parquet(out["good"]).collect()) == [1, 2, 6]
    # a batch that was written but not committed is tried again: it replaces its own rows
    last = max(int(f) for f in os.listdir(os.path.join(out["ckpt"], "commits")) if f.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(out["ckpt"], "commits", name)):
            os.remove(os.path.join(out["ckpt"], "commits", name))
    run()
    assert sorted(r.id for r in spark.read.parquet(out["good"]).collect()) == [1, 2, 6]
    assert spark.read.parquet(out["status"]).count() == 4 and spark.read.parquet(out["bad"]).count() == 2


def test_equal_file_names_in_other_folders_are_other_files(spark, tmp_out):
    land = os.path.join(tmp_out, "land")
    for sub in ("x", "y"):
        os.makedirs(os.path.join(land, sub), exist_ok=True)
        open(os.path.join(land, sub, "same.csv"), "w").write("1,a,1.0\n" if sub == "x" else "1,a,oops\n")
    res = load_landing(spark, land, SCHEMA, ["id", "amount"])
    st = sorted((r.file_path.split("/")[-2], r.status) for r in res.file_status.collect())
    assert st == [("x", "OK"), ("y", "BATCH ERROR")]
