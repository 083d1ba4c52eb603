import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quantpanel.llm.stream_dedup import exact_groups
from tests.llm.tables import awkward, documents


def lower(text):
    return (text or "").encode().lower()


def brute(rows, digest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = []
    for i, t in rows:
        same = groups[lower(t)]
        keep = max((x for x in same if x is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256(lower(t)).hexdigest()))
    return sorted(out, key=repr)


def run(spark, frame, folder, files, **options):
    frame.repartition(files).write.mode("overwrite").parquet(folder)
    docs = spark.read.parquet(folder)
    arriving = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    got = exact_groups(docs, arriving, **options).collect()
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got], key=repr)


def texts(n):
    return [(i, f"{'Text' if i % 3 else 'TEXT'} {i % 7} É") for i in range(n)]


def test_batches_share_their_state(spark, tmp_path):
    rows = texts(40) + [(100, "É"), (101, "é")]
    assert run(spark, documents(spark, rows), str(tmp_path / "d"), 3) == brute(rows, None)


def test_bytes_are_checked_when_digests_collide(spark, tmp_path):
    rows = texts(30)
    weak = lambda normal: F.substring(F.sha2(F.encode(normal, "UTF-8"), 256), 1, 0)
    got = run(spark, documents(spark, rows), str(tmp_path / "d"), 2, digest=weak)
    assert got == brute(rows, None)


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_rows(spark, tmp_path, empty):
    frame = documents(spark, []) if empty else awkward(spark)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert run(spark, frame, str(tmp_path / "d"), 2) == brute(rows, None)
