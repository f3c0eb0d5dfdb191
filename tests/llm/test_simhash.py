from itertools import combinations

import numpy as np
import pytest
import xxhash

from dayledger.llm import simhash
from dayledger.llm.components import components
from dayledger.llm.near_dedup import without_near_duplicates
from fixtures import EDGE, docs_of, edge_docs, empty_docs, prose


def plain_fingerprint(text, words=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = [w for w in lower.replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(pairs):
    """{node: smallest reachable} by union-find over all pairs."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in list(parent)}


def expected(rows, distance=4):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    distinct = sorted({f for _, f in fps})
    near = [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= distance]
    roots = plain_groups(near + [(f, f) for f in distinct])
    least = {}
    for i, f in fps:
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    return sorted((i if i is not None else -1, f"{f:016x}", least.get(roots[f])) for i, f in fps)


def result(df):
    return sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in df.collect())


def test_edge_rows_against_brute_force(spark):
    got = simhash.near_duplicate_groups(edge_docs(spark))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert result(got) == expected(EDGE)


def test_empty_table(spark):
    assert simhash.near_duplicate_groups(empty_docs(spark)).collect() == []


def test_near_copies_against_brute_force(spark, sf_dir):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    base = prose(3, 300).split()
    for n in range(60):
        copy = list(base)
        copy[5 * n] = f"edit{n}"
        rows.append((10_000 + n, " ".join(copy)))
    assert result(simhash.near_duplicate_groups(docs_of(spark, rows))) == expected(rows)


def _components_of(spark, fps, distance=4):
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(df, distance)).collect()}
    return {f: roots.get(int(np.uint64(f).view(np.int64))) for f in fps}


@pytest.mark.parametrize("compared", [8192, 20])
def test_dense_groups_keep_every_link(spark, monkeypatch, compared):
    """Also when a key has more fingerprints than are compared: midpoints link them."""
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 2**63, 3, dtype=np.uint64)
    fps = set()
    for c in centres:
        for _ in range(70):
            flips = rng.choice(64, rng.integers(0, 7), replace=False)
            fps.add(int(c) ^ sum(1 << int(b) for b in flips))
    fps = sorted(fps)
    if compared != simhash.COMPARED:
        link = simhash._link_runs
        monkeypatch.setattr(simhash, "_link_runs", lambda d: _limited(link, d, compared))
    near = [(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 4]
    plain = plain_groups(near)
    found = _components_of(spark, fps)
    same = lambda groups: {frozenset(x for x in groups if groups[x] == r) for r in groups.values() if r is not None}
    assert same(found) == same(plain)


def _limited(link, distance, compared):
    def rows(batches):
        from dayledger.llm import simhash as there

        there.COMPARED, kept = compared, there.COMPARED
        try:
            yield from link(distance)(batches)
        finally:
            there.COMPARED = kept

    return rows


def test_runs_across_batches():
    """A key's run may span batches and may end the input."""
    import pyarrow as pa

    keys = np.array([1] * 3 + [2] * 30 + [3] * 2, np.int64)
    fps = np.array([0, 1, 3, *range(30), 7, 6], np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 7]), pa.array(fps[i : i + 7])], ["key", "fp"]) for i in range(0, 35, 7)]
    edges = {(a, b) for out in simhash._link_runs(64)(iter(batches)) for a, b in zip(*map(lambda c: c.to_pylist(), out.columns), strict=True)}
    groups = plain_groups(edges)
    assert {groups[x] for x in range(30)} == {0}


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_near_duplicates(rows, words=5, similarity=0.8):
    """What stays, as a multiset of (id, text), from all pairs."""
    def words_of(text):
        return "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()

    def shingles(text):
        w = words_of(text)
        return {b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)} or ({b" ".join(w)} if w else set())

    low = -(2**63)
    texts = {}
    for i, t in rows:
        texts.setdefault(b" ".join(words_of(t)), []).append((low if i is None else i, t))
    firsts = {key: min(v)[0] for key, v in texts.items()}
    sets = {key: shingles(v[0][1]) for key, v in texts.items()}
    near = [(firsts[a], firsts[b]) for a, b in combinations(sets, 2) if (sets[a] or sets[b]) and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    roots = plain_groups(near)
    return sorted(i for i in firsts.values() if roots.get(i, i) == i)


def test_one_of_each_group_stays(spark):
    base = prose(5, 260).split()
    rows = list(EDGE)
    for n in range(40):
        copy = list(base)
        for k in range(n % 6):
            copy[(37 * n + 50 * k) % 260] = f"edit{n}x{k}"
        rows.append((100 + n, " ".join(copy)))
    rows += [(300 + n, prose(1000 + n, 60)) for n in range(30)]
    kept = without_near_duplicates(docs_of(spark, rows))
    assert kept.columns == ["doc_id", "text"]
    assert sorted(r[0] if r[0] is not None else -(2**63) for r in kept.collect()) == plain_near_duplicates(rows)


def test_near_duplicates_keep_clashing_columns(spark):
    docs = edge_docs(spark)
    assert without_near_duplicates(docs).columns == docs.columns
    assert without_near_duplicates(empty_docs(spark)).collect() == []


def test_large_classes_are_compared_in_blocks(spark, monkeypatch):
    from dayledger.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    base = prose(6, 200).split()
    rows = [(n, " ".join(base[:n] + [f"edit{n}"] + base[n + 1 :])) for n in range(25)]
    assert [r[0] for r in without_near_duplicates(docs_of(spark, rows)).collect()] == plain_near_duplicates(rows)
