"""SentencePiece against its library; cutting and packing against the tokenizer and plain bin packing."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm import sentencepiece_bpe as sp
from tests.llm.conftest import by_id

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abcdeithns  ▁éß\n.,0123456789=-{}()_<>́日"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def ours(texts):
    ids, counts = sp.pieces(PIECES).encode(texts, {}, sp.WordStore())
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_encoding_and_decoding_equal_the_library(library):
    draw = random.Random(5)
    texts = ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 80))) for _ in range(1500)]
    texts += ["", " ", "     " * 30, "aaaaaaa" * 40, "ananananan banana", "a\x00b", "<s>hi</s><0x0A>", "▁x ▁ y", "    def f(x):\n\treturn  x"]
    ids = ours(texts)
    assert ids == library.encode(texts)
    flat = np.array([i for x in ids for i in x], np.int64)
    decoded = sp.pieces(PIECES).decode(flat, np.array([len(x) for x in ids])).to_pylist()
    assert decoded == library.decode(ids)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_any_text_encodes_as_the_library_does(text):
    assert ours([text]) == [sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(text)]


def test_bytes_that_are_no_character_become_marks():
    table = sp.pieces(PIECES)
    broken = np.array([table.of_byte[0xE6], table.of_byte[0x41]], np.int64)
    assert table.decode(broken, np.array([2])).to_pylist() == ["�A"]


def test_digest_of_whole_documents(documents, texts, library):
    got = by_id(sp.digest(documents, PIECES), "n_tokens", "ids_sha256", "decoded_sha256")
    for doc, text in texts.items():
        ids = library.encode(text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert got[doc] == want


def test_tokens_of_odd_rows(odd, none, library):
    rows = sp.encode(odd, PIECES).select("text", "ids", "tag").collect()
    assert len(rows) == odd.count()
    assert all(r.ids == library.encode(r.text or "") and r.tag == "x" for r in rows)
    assert sp.decode(sp.encode(odd, PIECES), PIECES).columns == [*odd.columns, "ids", "decoded"]
    assert sp.digest(none, PIECES).count() == 0


def want_pieces(text, library, most=2048):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
    return [(i // most, i, len(ids[i : i + most]), zlib.crc32(np.array(ids[i : i + most], "<u4").tobytes())) for i in range(0, len(ids), most)]


def check_places(rows):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        items.sort()
        assert [o for o, _ in items] == list(np.cumsum([0, *[n for _, n in items[:-1]]]))
        assert sum(n for _, n in items) <= 2048
    return bins


def test_packing_of_whole_documents(documents, texts):
    library = Tokenizer.from_file(WORDS)
    rows = packing.packed(documents, WORDS).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        found.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert found == {doc: want_pieces(text, library) for doc, text in texts.items()}
    bins = check_places(rows)
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 2048) * 1.02 + 1


def test_packing_of_odd_rows(odd, none):
    library = Tokenizer.from_file(WORDS)
    rows = packing.packed(odd, WORDS).collect()
    check_places(rows)
    want = sorted((p, s, n, c) for r in odd.collect() for p, s, n, c in want_pieces(r.text, library))
    assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert packing.packed(none, WORDS).count() == 0
    (row,) = packing.cut_documents(odd.filter("doc_id = 5 AND length(text) < 10"), WORDS, with_ids=True).collect()
    assert row.ids == [*library.encode("two words", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("text", ["it's I'M 'S x'sy,", "<|startoftext|>Hi<|endoftext|> a", "ΑΣ ΟΔΟΣ. İ", "a\x01b \x01", "a\x1cb\x85c\xa0d", "≮ a̸ ≮", "<|STARTOFTEXT|> <|"])
def test_words_tokenise_as_whole_texts_do(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = packing.cut_documents(df, WORDS, with_ids=True).collect()
    assert rows[0].ids == [*Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids, 0]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), max_size=12), st.integers(1, 60))
def test_fullest_combination_is_the_best_sum(counts, room):
    chosen = packing.fullest(counts, room)
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
    assert sum(chosen) == max(sums)
    assert all(chosen.count(x) <= counts[x] for x in chosen)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 9), max_size=15))
def test_planned_bins_use_every_piece_once(counts):
    plan = packing.plan_bins(counts, 30)
    used = {}
    for p in plan:
        assert sum(p.lengths) <= 30
        for x in p.lengths:
            used[x] = used.get(x, 0) + p.times
    assert used == counts
