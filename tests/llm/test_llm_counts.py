from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from silverair.llm import token_counts
from silverair.llm.queries import BYTES, QUERIES
from tokenizers import Tokenizer

PATH = public_tokenizers.path(BYTES)
ODD = ["'", "'s", "'re", "'r", "'ve", "'ll", "'l", " 's", "  ", "\t", "\n", "\xa0", "　", "\x1c", "\x85", "é", "ß", "中文", "١٢", "²",
       "\U0001f600", "́", "<|endoftext|>", "<|endof", "aaaa", "\0", "‍", "ǅ", "a", "e", "s", "T", "1", "!", "."]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return token_counts.TokenCounter(token_counts.Vocabulary.read(PATH))


def counted(library, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=3)), max_size=30).map("".join), max_size=5))
def test_any_text_counts_as_in_the_library(library, counter, texts):
    assert counter(texts)[0].tolist() == counted(library, texts)


def test_runs_and_long_words(library, counter):
    deal = random.Random(3)
    texts = [c * n for c in "a -=\n\t" for n in (*range(1, 140), 1000)]
    texts += [" " * n + "x" for n in range(70)] + ["".join(deal.choice("etaoin") for _ in range(n)) for n in (500, 20_000)]
    assert counter(texts)[0].tolist() == counted(library, texts)


def plain_starts(library, text: str) -> list[int]:
    return [low for _, (low, _) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_marks_are_where_the_library_splits(library, counter):
    deal = random.Random(5)
    for n in (0, 1, 63, 64, 65, 127, 128, 129, 1000, 40_000):
        text = "".join(deal.choice(ODD) for _ in range(n))[:n]
        kinds = counter.kinds[[*map(ord, text), 0]]
        kinds[-1] = token_counts.END
        assert token_counts.starts(kinds)[:-1].tolist() == plain_starts(library, text)


def test_chunk_maps_compose(counter):
    """The scan gives each chunk the state that one walk from the beginning reaches."""
    deal = random.Random(6)
    text = "".join(deal.choice(ODD) for _ in range(5000))
    kinds = counter.kinds[[*map(ord, text)]]
    kinds[-1] = token_counts.END
    state, begins = 0, set()
    for i, kind in enumerate(kinds):
        mark = token_counts.MARKS[state, kind]
        begins |= ({i} if mark & 1 else set()) | ({i - 1} if mark & 2 else set())
        state = token_counts.AFTER[state, kind]
    assert token_counts.starts(kinds).tolist() == sorted(begins)


def test_transitions_carry_the_tokens_that_a_byte_adds(library, counter):
    for word in ("wonderfully", "anticonstitutionnellement", "Donaudampfschiff", "日本語"):
        pieces, total, state = counter.pieces, 0, 0
        for n, byte in enumerate(word.encode(), 1):
            state, added = pieces.table.get(state << 8 | byte) or pieces.compile(state, byte)
            total += added
            assert total == pieces.count(word.encode()[:n])
        assert total == len(library.encode(word).ids)


def test_tables_may_be_dropped_at_any_time(library, monkeypatch):
    monkeypatch.setattr(token_counts, "TABLE_ENTRIES", 20)
    monkeypatch.setattr(token_counts, "WORDS", 7)
    counter = token_counts.TokenCounter(token_counts.Vocabulary.read(PATH))
    texts = ["The tables of a task are small, and they're refilled.\n" * 3, "", "so what? " * 20]
    for _ in range(3):
        assert counter(texts)[0].tolist() == counted(library, texts)


def test_query_equals_the_library(spark, folder, documents, library):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = QUERIES["op12_token_counts"](spark, folder).collect()
    want = dict(zip(texts, counted(library, list(texts.values())), strict=True))
    assert {r.doc_id: r.n_tokens for r in rows} == want and len(rows) == len(texts)
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 512) for r in rows)


def test_edge_rows(spark, edge, library):
    docs = edge.withColumnRenamed("row", "token_bytes").withColumnRenamed("c0", "n_tokens")
    rows = token_counts.count_tokens(docs, PATH, limit=30).collect()
    given = [(r.doc_id, r.text or "") for r in edge.collect()]
    want = [(i, len(t.encode()), n, n > 30) for (i, t), n in zip(given, counted(library, [t for _, t in given]), strict=True)]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))


def test_kinds_cover_all_code_points(counter):
    assert len(counter.kinds) == 0x110000 and counter.kinds.dtype == np.uint8
    assert [counter.kinds[ord(c)] for c in " \n\x85a1!'s"] == [
        token_counts.SPACE, token_counts.BLANK, token_counts.BLANK, token_counts.LETTER, token_counts.NUMBER,
        token_counts.OTHER, token_counts.QUOTE, token_counts.SHORT,
    ]
