import random
from collections import Counter, defaultdict

import pytest

from dayledger.llm import queries, spelling_variants
from fixtures import edge_docs, empty_docs


def near_by_slots(words):
    """Words by what is left of them around each letter, and around each gap."""
    without, gaps, near = defaultdict(set), defaultdict(set), defaultdict(set)
    for word in words:
        for k in range(len(word) + 1):
            gaps[word[:k], word[k:]].add(word)
            if k < len(word):
                without[word[:k], word[k + 1 :]].add(word)
    for slot, group in without.items():
        for word in group:
            near[word] |= group - {word}
            for shorter in gaps.get(slot, ()):
                near[word].add(shorter)
                near[shorter].add(word)
    return near


def variants_by_hand(n):
    near, form = near_by_slots(n), {}
    for word in n:
        best = min(near[word], key=lambda other: (-n[other], other), default=None)
        form[word] = best if best is not None and n[best] >= 2 * n[word] else None
    rows = set()
    for word in n:
        root = word
        while form[root] is not None:
            root = form[root]
        rows.add((word, form[word], root, n[word], len(near[word]), n.get(form[word])))
    return rows


def words_of(spark, n):
    return spark.createDataFrame(list(n.items()), "word string, n long")


def found(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def vocabulary(seed, size, letters):
    rng = random.Random(seed)
    words = {}
    while len(words) < size:
        base = "".join(rng.choices(letters, k=rng.randint(1, 9)))
        words[base] = rng.randint(1, 1000)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(base) + 1)
            other = base[:k] + rng.choice(["", *letters]) + base[k + rng.randint(0, 1) :]
            if other:
                words.setdefault(other, rng.randint(1, 50))
                base = rng.choice([base, other])
    return words


@pytest.mark.parametrize("letters", ["abc", "abcdefghijklmnop", "eéèüßnst", "aйяж漢字é"])
def test_variants_are_those_of_all_slots(spark, letters):
    n = vocabulary(len(letters), 700, letters)
    assert found(spelling_variants.variants(words_of(spark, n))) == variants_by_hand(n)


@pytest.mark.parametrize("cell, part", [(40, 65_536), (8_192, 30), (60, 25)])
def test_many_cells_and_parts_of_cells_change_nothing(spark, monkeypatch, cell, part):
    monkeypatch.setattr(spelling_variants, "CELL", cell)
    monkeypatch.setattr(spelling_variants, "PART", part)
    n = vocabulary(5, 900, "abcdeé")
    assert found(spelling_variants.variants(words_of(spark, n))) == variants_by_hand(n)


def test_a_sample_of_few_words_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(spelling_variants, "SAMPLE", 50)
    monkeypatch.setattr(spelling_variants, "CELL", 100)
    n = vocabulary(6, 800, "abcdefg")
    assert found(spelling_variants.variants(words_of(spark, n))) == variants_by_hand(n)


def test_one_form_of_very_many_words_anagrams_and_a_chain(spark):
    rng = random.Random(3)
    hub = "abcdefghij"
    n = {hub: 10**6}
    for k in range(11):
        for letter in "klmnopqrstuvwxyzéèà":
            n[hub[:k] + letter + hub[k:]] = rng.randint(1, 9)
    n |= {"".join(rng.sample("stuvwxyz", 8)): 5 for _ in range(1500)}
    n |= {"q" * k: 4**k for k in range(5, 25)}
    rows = found(spelling_variants.variants(words_of(spark, n)))
    assert rows == variants_by_hand(n)
    assert ("qqqqq", "qqqqqq", "q" * 24, 4**5, 1, 4**6) in rows


def test_very_long_words_and_extremes(spark):
    n = {"x" * 3000: 3, "x" * 2999 + "y": 9, "x" * 2999: 20, "y" * 70: 1, "y" * 71: 2, "a": 8, "é": 3}
    assert found(spelling_variants.variants(words_of(spark, n))) == variants_by_hand(n)
    assert found(spelling_variants.variants(words_of(spark, {"alone": 3}))) == {("alone", None, "alone", 3, 0, None)}
    assert spelling_variants.variants(spark.createDataFrame([], "word string, n long")).collect() == []


def test_the_query_counts_whole_texts(spark, tmp_path):
    rng = random.Random(8)
    words = list(vocabulary(9, 300, "abcdeéÀB"))
    rows = [(n, "!\n".join(rng.choices(words, k=rng.randint(0, 400)))) for n in range(200)]
    rows += [(7, None), (None, "alone Alone ÄLONE " * 5), (8, ""), (9, "x" * 5000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for doc_id, text in rows:
        counts.update(queries.misspelt(doc_id, Counter(spelling_variants.runs_in(text))))
    n = {word: times for word, times in counts.items() if times >= 3 and len(word) >= 5}
    assert "älone" not in n and n["Älone"] == 5 and n["alone"] == 10
    assert found(queries.op11_spelling_variants(spark, str(tmp_path))) == variants_by_hand(n)


def test_edge_rows_and_an_empty_table(spark):
    assert spelling_variants.spelling_variants(edge_docs(spark)).count() > 0
    assert spelling_variants.spelling_variants(empty_docs(spark)).collect() == []
