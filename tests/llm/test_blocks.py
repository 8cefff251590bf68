"""Groups of members of buckets in which several clusters have not met."""

import pyarrow as pa

from epiweave.llm import minhash, substring
from epiweave.llm.words import distinct, shingles, text_bytes, word_hashes

MEMBERS = [(i, 5, 0, 1, 1) for i in (1, 2, 3, 4)] + [(i, 5, 1, 2, 5) for i in (5, 6, 7)] + [(i, 5, 2, 3, 8) for i in (8, 9)]


def test_the_leading_cluster_comes_with_the_counts(spark, monkeypatch):
    """No join of all members with the clusters of first ids, and members are stored once for targets and queries."""
    stored, store = [], minhash.materialize

    def seen(df, name):
        stored.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return store(df, name)

    monkeypatch.setattr(minhash, "materialize", seen)
    members = spark.createDataFrame(MEMBERS, "id long, n long, band int, key long, pivot long")
    clusters = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3)], "id long, component long")
    classes = spark.createDataFrame([(i, b"x") for i in range(1, 10)], "id long, sig binary")
    rows = minhash._open_blocks(members, clusters, classes).collect()
    targets = sorted((r.key, r.id, r.cluster, r.leading) for r in rows if not r.asks)
    assert targets == [(1, 2, 1, True), (1, 3, 3, False), (1, 4, 3, False), (2, 6, 6, False), (2, 7, 7, False)]
    assert sorted((r.key, r.id, r.cluster) for r in rows if r.asks) == [(1, 3, 3), (1, 4, 3), (2, 6, 6), (2, 7, 7)]
    assert [name for name, _ in stored] == ["unmet-members", "unmet"]
    assert not any("Join" in line and "pivot" in line for _, plan in stored for line in plan.split("\n"))


def test_only_lines_that_share_a_bucket_are_signed(spark, monkeypatch):
    """Distinct lines are stored with their band hashes; signatures are made of candidates alone, and links are found as before."""
    stored, store = {}, minhash.materialize

    def seen(df, name):
        out = stored[name] = store(df, name)
        return out

    monkeypatch.setattr(minhash, "materialize", seen)
    monkeypatch.setattr(substring, "materialize", seen)
    words = [f"w{i}" for i in range(40)]
    shared, near = " ".join(words), " ".join(["X", *words[1:]])
    texts = [shared, near.upper(), *(" ".join(f"d{i}w{j}" for j in range(30)) for i in range(20))]
    rows = {r.doc_id: r for r in substring.report(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert [i for i, r in rows.items() if r.repeated] == [1] and rows[1].removed_words == 40
    assert stored["lines"].columns == ["id", "n", "keys"] and stored["lines"].count() == 22
    signed = {r.id: r for r in stored["signed"].collect()}
    assert set(signed) == {r.id for r in stored["candidates"].collect()} and len(signed) == 2
    sets, bounds = distinct(*shingles(*word_hashes(*text_bytes(pa.array([shared]))), substring.SHINGLE))
    assert minhash.packed(minhash.signatures(sets, bounds, substring.HASHES))[0].tobytes() in {r.sig for r in signed.values()}
    assert {r.n for r in signed.values()} == {36}
