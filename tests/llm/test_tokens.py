import math
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from docs import awkward, documents, words
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vintara.llm import packing, token_files as T
from vintara.llm import token_ids
from vintara.llm.token_ids import WordEncoder, tokenizer_file

BYTES, WORDS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a <|endoftext|> b", "don't it's  we'll 'tis x's' a'' b'", "tab\t x \n y\xa0z \xa0 q", "Ünï Çode, ok.. (a) a1b2 12 3 x.y z__ ÿ ß ﬁ ½",
    ". . , a", "x ́y z", "ÀÉ! ÀÉ?! ÀÉ'", "a  b", "日本 語 a", "w\n\nv  u", "<|startoftext|> HELLO", "é́ ́", "\x00 \x1c a", "abc's abc'S ABC'LL",
]


@pytest.fixture(scope="module", params=[BYTES, WORDS])
def both(request):
    plain = Tokenizer.from_file(request.param)
    return WordEncoder(request.param), lambda t: np.array(plain.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_words_give_the_ids_of_the_whole_text(both):
    for text in [*TEXTS, *[t or "" for _, t in awkward()]]:
        assert both[0].encode(text) == both[1](text), text


@given(text=st.text(alphabet=st.sampled_from(list("aBéÿ'’.,!-_ \n\t\xa0١2́日😀<|>")), max_size=40))
@settings(max_examples=200, deadline=None)
def test_any_text(both, text):
    assert both[0].encode(text) == both[1](text)


@given(parts=st.lists(st.sampled_from(["a", " ", "b c", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", ".", "\n", "é", "don't"]), max_size=12))
@settings(max_examples=200, deadline=None)
def test_markers_inside_a_text(both, parts):
    """The plain call takes a marker as one id, wherever it stands."""
    text = "".join(parts)
    assert both[0].encode(text) == both[1](text)


def test_forgetting_changes_nothing(both, monkeypatch):
    monkeypatch.setattr(token_ids, "GENERATION", 7)
    for text in [words(i, 30, 50) for i in range(20)]:
        assert both[0].encode(text) == both[1](text)


def test_words_beside_line_feeds_are_remembered(both, monkeypatch):
    """Each pair of words around a line feed used to be a word of its own, sent down the tokenizer's whole path."""
    own, plain = both
    starts, ends = ["Il", "thon", "Èré"], ["the.", "aeau,", "ont"]
    for text in ["\n".join([*starts, *ends]), " ".join([*starts, *ends]), *starts, *ends]:
        own.encode(text)
    calls = []
    whole = own.whole
    monkeypatch.setattr(own, "whole", lambda text: calls.append(text) or whole(text))
    for text in [f"{a} {b}\n{a}\n{b}" for a in starts for b in ends]:
        assert own.encode(text) == plain(text)
    assert calls == []


@given(parts=st.lists(st.sampled_from(["a", "Ab.", "é!", "''s", "9", " ", "\n", "  ", "\n\n", " \n", "\n ", "\r\n", "\t", "\xa0", "日", "\u0301", "\u2028"]), max_size=14))
@settings(max_examples=300, deadline=None)
def test_cuts_beside_white_space(both, parts):
    """What an unsafe cut has left behind in the memory is not wrong for the texts that follow."""
    text = "".join(parts)
    assert both[0].encode(text) == both[1](text)


# ---- token files -----------------------------------------------------------------------------------------------------


@given(st.lists(st.integers(0, 2**40), max_size=300))
@settings(max_examples=100, deadline=None)
def test_elias_fano(numbers):
    numbers = sorted(numbers)
    data = T.EliasFano.encoded(np.array(numbers, dtype=np.uint64))
    read, used = T.EliasFano.read(memoryview(data))
    assert used == len(data) and read.all().tolist() == numbers
    assert [read.select(i) for i in range(len(numbers))] == numbers
    with pytest.raises(IndexError):
        read.select(len(numbers))


def test_elias_fano_is_near_the_minimum():
    numbers = np.cumsum(np.random.default_rng(1).integers(1, 2000, 50_000))
    bits = 8 * (len(T.EliasFano.encoded(numbers)) - struct.calcsize(T.LIST))
    assert bits <= len(numbers) * (2.1 + math.log2(numbers[-1] / len(numbers)))


def ids_of(path, text, end):
    tokenizer = Tokenizer.from_file(path)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_files_round_trip(spark):
    rows = sorted([*awkward(), (-4, "before"), (8, words(1, 120))])
    at, expected = 0, []
    for i, t in rows:
        ids = ids_of(BYTES, t, 2)
        expected.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(tuple(r) for r in T.round_trip(documents(spark, rows), BYTES).collect()) == expected


def test_token_file_gives_single_documents(spark, tmp_path):
    rows = [*awkward(), (None, "no id")]
    manifest = T.write_token_files(documents(spark, rows), BYTES, str(tmp_path / "files"), tasks=1).collect()
    assert sum(m.documents for m in manifest) == len(rows) and sum(m.nulls for m in manifest) == 1
    stored = T.TokenFile(open(manifest[0].path, "rb").read())
    texts = ["no id", *[t for _, t in sorted(awkward(), key=lambda r: r[0])]]
    for i in (0, 5, len(rows) - 1):
        assert stored.document(i).tolist() == ids_of(BYTES, texts[i], 2)
    got = T.read_token_files(spark.createDataFrame(manifest, T.MANIFEST)).collect()
    assert [r.start for r in got if r.doc_id is None] == [0] and len(got) == len(rows)


def test_empty_table(spark):
    assert T.round_trip(documents(spark, []), BYTES).collect() == []
    assert packing.packed(documents(spark, []), WORDS).collect() == []


def test_ids_that_do_not_fit(spark, tmp_path):
    with pytest.raises(Exception, match="more than 1 bytes"):
        T.write_token_files(documents(spark, [(1, "a text")]), BYTES, str(tmp_path / "x"), width=1)


# ---- packing ---------------------------------------------------------------------------------------------------------


def sequences(plan):
    out = defaultdict(list)
    for length, _, pieces, each, first, offset in plan:
        for i in range(pieces):
            out[first + i // each].append((offset + i % each * length, length))
    return out


@given(st.lists(st.integers(1, 30), max_size=200))
@settings(max_examples=200, deadline=None)
def test_sweep_fills_sequences_without_gaps(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.sweep(counts, 30)
    seen = defaultdict(int)
    for length, rank, pieces, *_ in plan:
        assert rank == seen[length]
        seen[length] += pieces
    assert seen == counts
    filled = sequences(plan)
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 30
    assert sorted(filled) == list(range(len(filled)))
    assert len(filled) == best_fit(lengths, 30)


def best_fit(lengths, capacity):
    """Sequences that best fit in descending order opens, piece by piece."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= length]
        gap = min(fits) if fits else capacity
        if fits:
            gaps.remove(gap)
        gaps.append(gap - length)
    return len(gaps)


def test_packing_equals_brute_force(spark):
    rows = [*awkward(), *[(100 + i, words(i, 10 + i % 7)) for i in range(60)], (8, "again")]
    got = packing.packed(documents(spark, rows), WORDS, capacity=64, end_id=1).collect()
    expected = defaultdict(int)
    for i, t in rows:
        ids = ids_of(WORDS, t, 1)
        for piece, start in enumerate(range(0, len(ids), 64)):
            expected[i, piece, start, len(ids[start:start + 64]), crc(ids[start:start + 64])] += 1
    found, filled = defaultdict(int), defaultdict(list)
    for r in got:
        found[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        filled[r.sequence_id].append((r.offset, r.length))
    assert found == expected
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(filled) == best_fit([r.length for r in got], 64)


def test_packing_keeps_a_missing_id(spark):
    assert sorted(str(r.doc_id) for r in packing.packed(documents(spark, [(None, "a"), (2, None)]), WORDS).collect()) == ["2", "None"]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_every_text_has_the_ids_of_the_plain_call(path):
    plain, own = Tokenizer.from_file(path), WordEncoder(path)
    for text in TEXTS:
        assert np.array(plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes() == own.encode(text), text
