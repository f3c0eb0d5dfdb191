from dayledger.llm import near_dedup, simhash
from dayledger.llm.near_dedup import without_near_duplicates
from fixtures import docs_of, prose


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_block_edits_are_found(spark):
    """A block appended or replaced at the end, down to 0.8; below that both stay."""
    rows, gone = [], []
    for n in range(120):
        size = 150 + 40 * (n % 20)
        base, other = prose(2000 + n, size).split(), prose(5000 + n, size).split()
        part = size * (3 + n % 21) // 100
        copy = base + other[:part] if n % 2 else base[: size - part // 2] + other[: part // 2]
        rows += [(2 * n, " ".join(base)), (2 * n + 1, " ".join(copy))]
        if jaccard(rows[-2][1], rows[-1][1]) >= 0.8:
            gone.append(2 * n + 1)
    assert 60 < len(gone) < 120
    kept = sorted(r.doc_id for r in without_near_duplicates(docs_of(spark, rows)).collect())
    assert kept == sorted({i for i, _ in rows} - set(gone))


def test_repeated_and_missing_ids_go_by_text(spark):
    """What is a near duplicate goes, the other text of its doc_id stays; so without ids."""
    near = [f"{prose(n, 100)} more" for n in (1, 3)]
    rows = [(1, prose(1, 100)), (2, near[0]), (2, prose(2, 100)), (None, prose(3, 100)), (None, near[1]), (None, prose(4, 100))]
    kept = {(r.doc_id, r.text) for r in without_near_duplicates(docs_of(spark, rows)).collect()}
    assert {(1, prose(1, 100)), (2, prose(2, 100)), (None, prose(4, 100))} <= kept
    assert len(kept) == 4 and len(kept & {rows[3], rows[4]}) == 1


def test_fingerprints_link_texts_before_shingles_do(spark, monkeypatch):
    """Texts that op4 links are grouped by its links, so chains no longer pair them; below 0.8 they stay."""
    base = prose(7, 400).split()
    copies = [" ".join([*base[:n], "other", *base[n + 1 :]]) for n in (390, 395, 398)]
    rows = [(0, " ".join(base)), *enumerate(copies, 1), (9, prose(8, 400))]
    asked = []

    def noted(docs, texts, pairs, words, similarity):
        asked.append({frozenset((r.a, r.b)) for r in pairs.collect()})
        return similar(docs, texts, pairs, words, similarity)

    similar = near_dedup._similar
    monkeypatch.setattr(near_dedup, "_similar", noted)
    docs = docs_of(spark, rows)
    fps = {i: simhash.fingerprint(t, 4) for i, t in rows}
    linked = [i for i in (1, 2, 3) if (fps[i] ^ fps[0]).bit_count() <= 4]
    assert linked
    kept = sorted(r.doc_id for r in without_near_duplicates(docs).collect())
    assert kept == [0, 9]
    assert len(asked[0]) >= len(linked)
    assert not asked[0] & asked[1]
