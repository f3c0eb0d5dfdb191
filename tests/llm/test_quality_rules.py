import re
from collections import Counter

from dayledger.llm import quality_rules
from fixtures import EDGE, edge_docs, empty_docs, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + s for i, w in enumerate(windows) if often[w] > 1 for s in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def measures(df):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return [tuple(r) for r in df.select(*names).collect()]


def test_edge_rows_against_brute_force(spark):
    docs = edge_docs(spark).coalesce(1)
    assert measures(quality_rules.judged(docs)) == [plain(t) for _, t in EDGE]
    kept = quality_rules.well_written(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} <= {4, 6, 7, 8}


def test_repeats_and_symbols(spark):
    texts = [
        "x y z x y z", "a b a b a b", "same line\nsame line\n\n \nsame line\nother", "# * $ % & | < > ok",
        " ".join(["spam"] * 60), prose(8, 60) + "\n" + prose(8, 60), "one two",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    assert measures(quality_rules.judged(docs)) == [plain(t) for t in texts]


def test_rules_name_what_they_reject(spark):
    good = " ".join(f"the word{i} of light{i} and" for i in range(20))
    rows = [(0, good), (1, good.replace("word", "###")), (2, good.upper()), (3, good.replace(" ", "! ")), (4, " | ".join(good.split()))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r[0]: (r.kept, set(r.broken_rules)) for r in quality_rules.judged(docs).select("row.doc_id", "kept", "broken_rules").collect()}
    assert out[0] == (True, set())
    assert "symbol_ratio" in out[1][1] and {"capital_ratio", "stop_words"} <= out[2][1]
    assert "exclamation_ratio" in out[3][1] and "letter_word_ratio" in out[4][1]


def test_stays_in_the_jvm_without_a_shuffle(spark):
    plan = quality_rules.well_written(edge_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert quality_rules.judged(empty_docs(spark)).collect() == []
