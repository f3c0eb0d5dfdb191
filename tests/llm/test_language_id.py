import math
import random
from collections import Counter

import pytest

from dayledger.llm import language_id, queries
from fixtures import edge_docs

SOUNDS = {"aa": "ka lo mi ten sar", "bb": "zu wez ghi pol sar", "cc": "éa ñu óra qué sar", "dd": "жа ло мит тен кар"}


def text_in(lang, seed, n):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(SOUNDS[lang].split(), k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(lang, text_in(lang, n, 60)) for lang in SOUNDS for n in range(30)] + [(None, "ka lo"), ("aa", None)]
    return language_id.learned(spark.createDataFrame(rows, "lang string, text string"))


def scores_by_hand(rows, text):
    """The same definition, word by word, from plain counts."""
    languages = sorted({lang for lang, _ in rows})
    counts = {}
    for lang, own in rows:
        for word in language_id.words_in(own):
            counts.setdefault(0, Counter())[lang, word] += 1
            for size in range(1, 6):
                for gram in language_id.grams_in(word, size):
                    counts.setdefault(size, Counter())[lang, gram] += 1
    totals = {(s, lang): sum(n for (of, _), n in c.items() if of == lang) for s, c in counts.items() for lang in languages}
    score = {s: {f: -math.log10(n / totals[s, f[0]]) for f, n in c.items()} for s, c in counts.items()}

    def of(size, feature):
        if not any((lang, feature) in score[size] for lang in languages):
            return None
        rarest = max(score[size].values()) + 1
        return [score[size].get((lang, feature), rarest) for lang in languages]

    means = []
    for word in language_id.words_in(text):
        for size in (0, 5, 4, 3, 2, 1):
            rows_of = [of(size, f) for f in ([word] if size == 0 else language_id.grams_in(word, size))]
            rows_of = [r for r in rows_of if r]
            if rows_of:
                means.append([sum(r[k] for r in rows_of) / len(rows_of) for k in range(len(languages))])
                break
    mean = [sum(m[k] for m in means) / len(means) for k in range(len(languages))]
    best = min(range(len(languages)), key=lambda k: mean[k])
    return languages[best], 1 / sum(10 ** (mean[best] - m) for m in mean)


def test_scores_are_those_of_the_definition(spark, model):
    rows = [(lang, text_in(lang, n, 60)) for lang in SOUNDS for n in range(30)]
    for lang in SOUNDS:
        for text in (text_in(lang, 999, 25), text_in(lang, 5, 3) + " xkq wézghi ло", "sar"):
            got, score = language_id.Judge(model).identify([text])[0]
            wanted, exactly = scores_by_hand(rows, text)
            assert got == wanted and score == pytest.approx(exactly, abs=1e-4)


def test_held_out_texts_are_told_apart(spark, model):
    rows = [(lang, n, text_in(lang, 1000 + n, 12)) for lang in SOUNDS for n in range(50)]
    got = language_id.identified(spark.createDataFrame(rows, "lang string, n long, text string"), model)
    assert got.columns == ["lang", "n", "lang_pred", "score"]
    right = [r.lang == r.lang_pred for r in got.collect()]
    assert sum(right) / len(right) >= 0.98


def test_unseen_words_back_off_to_shorter_grams(model):
    assert all(word not in model.rows[0] for word in ("wezghipolzuwez", "митжаб"))
    assert language_id.Judge(model).identify(["wezghipolzuwez"])[0][0] == "bb"
    assert language_id.Judge(model).identify(["Митжаб"])[0][0] == "dd"
    assert language_id.Judge(model).identify(["漢字"])[0] == (model.languages[model.usual], model.usual_share)


def test_forgetting_unseen_words_changes_nothing(model, monkeypatch):
    texts = [text_in(lang, 2000 + n, 40) for n in range(10) for lang in SOUNDS]
    wanted = [language_id.Judge(model).identify([text])[0] for text in texts]
    monkeypatch.setattr(language_id, "REMEMBERED", 7)
    judge = language_id.Judge(model)
    got = [judge.identify([text])[0] for text in texts]
    assert [lang for lang, _ in got] == [lang for lang, _ in wanted]
    assert [score for _, score in got] == pytest.approx([score for _, score in wanted])


def test_texts_without_letters_and_without_a_model(spark, model):
    rows = [(1, None), (2, ""), (3, " 12 ½ ² _ --- "), (4, "Ka lo.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identified(docs, model).collect()}
    assert [got[k] for k in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4][0] == "aa" and 0 < got[4][1] <= 1
    nothing = language_id.learned(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in language_id.identified(docs, nothing).collect()} == {"und"}
    assert language_id.identified(docs.where("false"), model).collect() == []


def test_only_the_most_frequent_features_stay_and_ties_go_together(spark, monkeypatch):
    monkeypatch.setattr(language_id, "WORDS", 3)
    rows = [("aa", "one one one two two six six ten"), ("bb", "uno uno uno due due tre")]
    small = language_id.learned(spark.createDataFrame(rows, "lang string, text string"))
    assert set(small.rows[0]) == {"one", "two", "six", "uno", "due", "tre"}
    monkeypatch.setattr(language_id, "WORDS", 2)
    assert set(language_id.learned(spark.createDataFrame(rows, "lang string, text string")).rows[0]) == {"one", "uno", "due"}


def test_the_query_learns_from_documents_that_are_not_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = queries.op12_language_id(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert got.where("held_out <> (crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1)").isEmpty()
    rows = got.join(docs, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) >= 50 and sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.97


def test_columns_beyond_and_clashing_names(spark, model):
    docs = edge_docs(spark).selectExpr("*", "0 AS score", "0 AS lang_pred")
    got = language_id.identified(docs, model)
    assert got.columns == [*edge_docs(spark).drop("text").columns, "lang_pred", "score"]
    assert got.count() == docs.count()
