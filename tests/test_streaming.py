"""The streaming label report equals the batch report over the same files."""

import os

from parcelscope.streaming import parcel_label_stream, start_label_counts


def test_stream_counts_match_batch(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "incoming")
    os.makedirs(d)
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write('id,zone\n1,Single Family\n2,"Duplex, two"\n3,Office\n')
    labels = parcel_label_stream(spark, d, 1, words=["family", "duplex"])
    out = os.path.join(tmpdir_path, "zone_counts")
    q = start_label_counts(labels, out, os.path.join(tmpdir_path, "ckpt"), header_label="zone")
    try:
        q.processAllAvailable()
        with open(os.path.join(d, "b.csv"), "w") as f:
            f.write('id,zone\n4,single family\n5,warehouse\n')
        q.processAllAvailable()
        got = {r.label: r.n for r in spark.read.parquet(out).collect()}
    finally:
        q.stop()
    assert got == {"single family": 2, "duplex, two": 1}
