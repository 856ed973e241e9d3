"""What a worker holds follows a slice of a batch, and a verdict's code fits a class."""

import tracemalloc

import numpy as np
import pyarrow as pa

from plumbline.llm import langid, neardup
from plumbline.llm.arrow import sliced


def batch_of(texts):
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


def test_slices_hold_every_row_in_order():
    texts = ["a" * 30, None, "", "b" * 500, "c" * 40, "d" * 70, None]
    batches = [batch_of(texts), batch_of([]), batch_of(["e"])]
    found = list(sliced(iter(batches), 1, 100))
    assert pa.Table.from_batches(found).equals(pa.Table.from_batches(batches))
    assert [b.num_rows for b in found] == [3, 1, 1, 2, 0, 1]


def test_a_batch_of_many_texts_is_hashed_slice_by_slice():
    r = np.random.default_rng(1)
    words = [f"w{i}" for i in range(5000)]
    batch = batch_of([" ".join(r.choice(words, 2000)) for _ in range(2000)])
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in neardup._signed(iter([batch]), 40, 5))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 2000
    assert peak < 2.5 * batch.nbytes


def test_the_language_verdict_is_compiled(spark):
    docs = spark.createDataFrame(
        [(i, f"the words of document {i} are plain english words", "en", f"h{i % 3}.example.com") for i in range(20)],
        "doc_id long, text string, lang string, source string",
    )
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert langid.only_identified(docs).count() == 20
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
