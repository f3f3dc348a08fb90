"""What Python workers remember from task to task."""

import gc
import weakref

import pyarrow as pa

from shoal.llm import classify, pieces
from shoal.llm import common as C
from shoal.llm.queries import tokenizer_file


def test_a_worker_holds_the_memories_of_one_operator_only():
    known = weakref.ref(pieces.transducer(pieces.compiled(tokenizer_file("piece_bpe_32k.model"))))
    assert known() is not None
    words = classify.kept("slots", "one", classify.slots)
    words[b"word"]
    gc.collect()
    assert known() is None and classify.kept("slots", "one", classify.slots) is words
    assert classify.kept("slots", "two", classify.slots) is not words


def test_a_task_without_memories_starts_with_none(spark):
    def held(batches):
        C.hold("mine")["words"] = 1
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(C.hold("mine"))] * b.num_rows, pa.list_(pa.string()))], ["held"])

    def other(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(C._HELD)] * b.num_rows, pa.list_(pa.string()))], ["held"])

    df = spark.range(8).repartition(8)
    assert {tuple(r[0]) for r in C.map_batches(df, held, "held array<string>", "mine").collect()} == {("version", "words")}
    assert {tuple(r[0]) for r in C.map_batches(df, other, "held array<string>").collect()} == {("version",)}
