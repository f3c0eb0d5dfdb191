import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dayledger.llm import packing, planes, token_counts
from dayledger.llm.text_ids import SpaceSplitIds, space_split_ids
from fixtures import EDGE, docs_of, edge_docs, empty_docs, prose

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = ["<|endoftext|>", " <|startoftext|>x", "it's", "'s", "e\u0301", "\u0301", " \u0301", "\x1c", "\u2028", "İ", "ΑΣ", "a\tb", "  ", "\n", "\u00a0", "日本", "🙂", "Word,", "word!?", "It's!", "Ünder.", "<|endoftext", "|>", "x|", "ab's.", "ª.", "ʰ,", "ǅ!", "1234", "\u1100\u1161"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=6), st.just(" ")), max_size=12).map("".join))
def test_ids_are_those_of_the_whole_text(whole, text):
    assert np.frombuffer(next(space_split_ids(WORD_BPE).encode([text])), "<u4").tolist() == whole(text)


@pytest.mark.parametrize("sign", [".", ",", ";", ":", "!", "?", "#", "$", "%", "&", "*", "|", "'", "\x01"])
def test_every_letter_before_every_sign(whole, sign):
    letters = [chr(c) for c in range(0x30000) if chr(c).isalpha()]
    text = " ".join(f"A{letter}{sign}" for letter in letters)
    assert np.frombuffer(next(SpaceSplitIds(WORD_BPE).encode([text])), "<u4").tolist() == whole(text)


def test_capitals_before_every_mark(whole):
    marks = [chr(c) for c in range(0x20000) if unicodedata.category(chr(c)).startswith("M")]
    text = " ".join(f"{c}{mark}, X{mark}{c}É" for mark in marks for c in "AIKS")
    assert np.frombuffer(next(SpaceSplitIds(WORD_BPE).encode([text])), "<u4").tolist() == whole(text)


def test_capitals_whose_small_letter_ends_in_a_mark(whole):
    text = "G\u00dcNE\u015eL\u0130. \u0130, \u0958! a\x01b \x01 <|endoftext|>\x01 X<|ENDOFTEXT|>"
    assert np.frombuffer(next(SpaceSplitIds(WORD_BPE).encode([text])), "<u4").tolist() == whole(text)


@pytest.mark.parametrize("before", ["", "don't", "1", "É", "e\u0301", "Σ", "\u0958", "--", "x\x01"])
def test_signs_behind_letters_of_ascii(whole, before):
    signs = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    runs = [*signs, *(a + b for a in signs for b in signs), "...'s", "$$$", "!'t!", "</", "=\u0338"]
    text = " ".join(f"{before}{letter}{run}" for letter in "aZ" for run in runs)
    own = SpaceSplitIds(WORD_BPE)
    assert own.words is not None
    assert np.frombuffer(next(own.encode([text])), "<u4").tolist() == whole(text)


def test_the_longer_way_gives_the_same(whole):
    own = SpaceSplitIds(WORD_BPE)
    own.words = None
    text = prose(1, 400) + " Word, word!? It's! <|endoftext|> x"
    assert np.frombuffer(next(own.encode([text])), "<u4").tolist() == whole(text)


def test_forgetting_changes_nothing(whole, monkeypatch):
    from dayledger.llm import text_ids

    monkeypatch.setattr(text_ids, "PARTS_KEPT", 20)
    monkeypatch.setattr(text_ids, "STEMS_KEPT", 30)
    own = SpaceSplitIds(WORD_BPE)
    monkeypatch.setattr(text_ids, "TOGETHER", 300)
    texts = [prose(n, 40) for n in range(20)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode([*texts, None])] == [*map(whole, texts), []]


def test_only_parts_that_end_in_signs_are_put_together():
    own = SpaceSplitIds(WORD_BPE)
    list(own.encode(["plain Words 12 ... x"]))
    assert set(own.stems.now) == {"plain", "words", "12", "...", "x"}  # no tail is looked up
    list(own.encode(["words, Words!"]))
    assert set(own.stems.now) == {"plain", "words", "12", "...", "x", ",", "!"}


def test_a_piece_with_the_sign_between_is_refused():
    own = SpaceSplitIds(WORD_BPE)
    with pytest.raises(ValueError):
        own._together(own.tokenizer, ["a", "b\x01"], "\x01")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packing(rows, got, whole, window):
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(whole(t) + [2])
    pieces = sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got)
    wanted = sorted(
        (i is not None, i or 0, s, len(ids[s : s + window]), crc(ids[s : s + window]), len(ids))
        for i, many in texts.items() for ids in many for s in range(0, len(ids), window)
    )
    assert pieces == wanted
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= window
    return sequences


def test_packing_edge_rows(spark, whole):
    got = packing.packed(edge_docs(spark), WORD_BPE, end_id=2).collect()
    check_packing(EDGE, got, whole, 4096)
    assert packing.packed(empty_docs(spark), WORD_BPE, end_id=2).collect() == []


def test_packing_in_several_groups_wastes_little(spark, whole):
    rows = [(i, prose(i, 5 + i * 37 % 90)) for i in range(400)]
    got = packing.packed(docs_of(spark, rows), WORD_BPE, end_id=2, window=128, group=150).collect()
    sequences = check_packing(rows, got, whole, 128)
    assert sum(length for parts in sequences.values() for _, length in parts) > 0.95 * 128 * len(sequences)


@given(st.lists(st.integers(1, 40), max_size=80))
def test_tightest_window_first(lengths):
    lengths.sort(reverse=True)
    tree, free = packing.OpenWindows(40), []
    for length in lengths:
        number, offset = tree.place(length)
        room = [f for f in free if f >= length]
        if room:
            assert 40 - offset == min(room)
            free.remove(min(room))
        else:
            assert (number, offset) == (tree.made - 1, 0)
        if 40 - offset - length:
            free.append(40 - offset - length)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=70), st.sampled_from([planes.BITS, planes.BYTES]), st.sampled_from([8, 16384]))
def test_planes_round_trip(ids, kind, block):
    assert planes.decode_payload(planes.encode_payload(np.array(ids, np.uint32), kind, block)).tolist() == ids


@pytest.mark.parametrize("kind", [planes.BITS, planes.BYTES])
def test_files_round_trip(spark, whole, tmp_path, monkeypatch, kind):
    rows = [*EDGE, *((1000 - i, prose(i, 3 * i)) for i in range(120))]
    planes.write_ids(docs_of(spark, rows).repartition(3), str(tmp_path / "ids"), WORD_BPE, end_id=1, kind=kind)
    got = sorted(planes.read_ids(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    at, ids_of = 0, defaultdict(list)
    for i, t in rows:
        ids_of[i].append(whole(t) + [1])
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    for r in got:
        assert r.start == at
        at += r.n_tokens
        assert (r.n_tokens, r.ids_crc32) in {(len(x), crc(x)) for x in ids_of[r.doc_id]}


def test_files_of_an_empty_table(spark, tmp_path):
    planes.write_ids(empty_docs(spark), str(tmp_path / "ids"), WORD_BPE, end_id=1)
    assert planes.read_ids(spark, str(tmp_path / "ids")).collect() == []


def test_not_a_payload():
    with pytest.raises(ValueError):
        planes.decode_payload(b"\0" * 32)


def test_counts_and_cache(spark, tmp_path):
    import sentencepiece

    plain = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    wanted = sorted(
        (i is not None, i or 0, len((t or "").encode()), n, n > 4096)
        for i, t in EDGE for n in [len(plain.encode(t or ""))]
    )
    cache = str(tmp_path / "cache")
    for docs in (edge_docs(spark), edge_docs(spark)):
        got = token_counts.counted(docs, PIECES, cache).collect()
        assert sorted((r[0] is not None, r[0] or 0, *r[1:]) for r in got) == wanted
    version = token_counts.version_of(PIECES)
    held = spark.read.parquet(f"{cache}/tokenizer={version}")
    assert held.count() == held.select("digest").distinct().count() == len({t or "" for _, t in EDGE})
    # Only what is new is encoded; another tokenizer has counts of its own.
    more = docs_of(spark, [(1, "brand new"), (2, "Two words"), (3, "brand new")])
    assert token_counts.counted(more, PIECES, cache).count() == 3
    assert spark.read.parquet(f"{cache}/tokenizer={version}").count() == len({t or "" for _, t in EDGE}) + 1
    assert token_counts.counted(more, WORD_BPE, cache).where("n_tokens = 2").count() == 3


def test_counts_of_an_empty_table(spark, tmp_path):
    assert token_counts.counted(empty_docs(spark), PIECES, str(tmp_path / "cache")).collect() == []
