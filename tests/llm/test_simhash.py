import numpy as np
import pytest
import xxhash

from pulsegrid.llm import queries, simhash
from pulsegrid.llm.components import components


def brute_print(text, shingle=3):
    own = (text or "").encode().lower().split()
    if not own:
        return 0
    parts = [b" ".join(own[k : k + shingle]) for k in range(max(1, len(own) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(docs, distance=2):
    """(id, fingerprint, least id reachable)."""
    prints = [brute_print(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for (i, _), g in zip(docs, group, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted(((i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(docs, prints, group, strict=True)), key=str)


def run(df, **args):
    return sorted((tuple(r)[:3] for r in simhash.near_duplicates(df, **args).collect()), key=str)


def test_edge_rows(edge):
    assert run(edge) == brute([(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()])


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert sorted((tuple(r)[:3] for r in queries.op4_simhash(spark, small).collect()), key=str) == brute(docs)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_of_all_distances(spark, monkeypatch, distance):
    """Fingerprints that differ in 0 to 4 bits, wherever they are."""
    random = np.random.default_rng(5)
    base = random.integers(0, 1 << 63, 30, dtype=np.uint64)
    made = [int(b) ^ int(np.bitwise_or.reduce(np.uint64(1) << random.integers(0, 64, k).astype(np.uint64), initial=np.uint64(0))) for b in base for k in range(5)]
    df = spark.createDataFrame([(i, str(f)) for i, f in enumerate(made)], "doc_id long, text string")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_: docs.selectExpr("doc_id AS id", "doc_id AS key", "cast(cast(text AS decimal(20)) - (CASE WHEN cast(text AS decimal(20)) >= 9223372036854775808 THEN 18446744073709551616 ELSE 0 END) AS long) AS fp"))
    got = dict((r.doc_id, r.component_id) for r in simhash.near_duplicates(df, distance=distance).collect())
    group = list(range(len(made)))
    for i in range(len(made)):
        for j in range(i):
            if (made[i] ^ made[j]).bit_count() <= distance and group[i] != group[j]:
                a, b = max(group[i], group[j]), min(group[i], group[j])
                group = [b if g == a else g for g in group]
    assert [got[i] for i in range(len(made))] == group


def test_one_of_each_group_stays(edge):
    kept = simhash.keep_one(edge)
    assert kept.schema == edge.schema
    expected = {c for *_, c in brute([(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()])}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_empty_table(nothing):
    assert run(nothing) == [] and simhash.keep_one(nothing).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200, 202: 200}
    assert components(df.limit(0)).count() == 0
