"""foreachBatch classification over a parquet stream equals the batch classification."""
import uuid

from pyspark.sql import functions as F

from latticeguard.session import checkpoint_dir
from latticeguard.streaming.score_stream import run_classification

SF = "/root/testdata/sf0.001"


def test_stream_classification_matches_batch(spark):
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    run_classification(spark, SF, f"{base}/out", f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/out")
    n_raw = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert out.count() == n_raw
    unknown = out.where(F.col("quantum_vulnerable").isNull()).select("algorithm").distinct().collect()
    assert [r[0] for r in unknown] == ["FOO-1"]
    # a second run over the same checkpoint finds nothing new
    run_classification(spark, SF, f"{base}/out", f"{base}/ckpt")
    assert spark.read.parquet(f"{base}/out").count() == n_raw
