"""What executors hold: the size of batches on their way to Python workers, and how many workers a task needs."""

import pyarrow as pa
import pytest

from epiweave.llm import automaton, memory

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unlimited(spark):
    had = spark.conf.get(LIMIT, None)
    spark.conf.unset(LIMIT)
    yield spark
    spark.conf.unset(LIMIT)
    if had is not None:
        spark.conf.set(LIMIT, had)


def batch_sizes(rows):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    return memory.map_lean(rows, sizes, "n long, bytes long").collect()


def test_batches_for_workers_are_bounded(unlimited):
    docs = unlimited.range(0, 400, 1, 1).selectExpr("id", "repeat('word ', 4000) text")  # 8 MB in one task
    found = batch_sizes(docs)
    assert sum(r.n for r in found) == 400 and len(found) > 3
    assert max(r.bytes for r in found) < 2 * memory.BATCH_BYTES


def test_a_longer_row_is_a_batch_of_its_own(unlimited):
    docs = unlimited.range(0, 3, 1, 1).selectExpr("id", "repeat('word ', 1000000) text")
    found = batch_sizes(docs)
    assert [r.n for r in found] == [1, 1, 1] and min(r.bytes for r in found) >= 5_000_000


def test_a_limit_of_the_session_stays(unlimited):
    unlimited.conf.set(LIMIT, "123456")
    batch_sizes(unlimited.range(3))
    assert unlimited.conf.get(LIMIT) == "123456"


def test_operators_bound_their_batches(unlimited):
    docs = unlimited.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = unlimited.createDataFrame([(1, "x y z")], "item_id long, text string")
    automaton.decontaminate(docs, bench).collect()
    assert unlimited.conf.get(LIMIT, None) == str(memory.BATCH_BYTES)


def test_decontaminate_takes_one_worker_a_task(spark):
    item = " ".join(f"i{k}" for k in range(10))
    own = " ".join(f"w{k}" for k in range(10))
    rows = [(f"{own} {item}", 1, 99), (f"{own} {item} {item}", 2, 99), (own, 3, 99), (None, 4, None), ("", 5, 0)]
    docs = spark.createDataFrame(rows, "text string, doc_id long, n_chars int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = automaton.decontaminate(docs, bench)
    assert clean._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    # ten hit words of twenty are not more than half of them
    assert sorted(map(tuple, clean.collect()), key=lambda r: r[1]) == [(own, 1, len(own)), (own, 3, 99), (None, 4, None), ("", 5, 0)]
    third = automaton.decontaminate(docs, bench, max_coverage=0.49)
    assert sorted(r.doc_id for r in third.collect()) == [3, 4, 5]
