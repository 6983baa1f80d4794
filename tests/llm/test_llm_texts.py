"""Operators that look at one text at a time, against plain code over the same texts."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import sys
import tracemalloc
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from silverair.llm import language_id, quality_crf, quality_rules, sentencepiece_codec, toxicity
from silverair.llm.queries import PIECES, QUERIES

MODEL = public_tokenizers.path(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_ids_and_text_equal_the_library(edge, library):
    got = sentencepiece_codec.encode_decode(edge, MODEL).collect()
    assert len(got) == edge.count()
    assert len({r.doc_id for r in got if r.doc_id == 11}) == 1
    want = Counter()
    for row in edge.select("doc_id", "text").collect():
        ids = library.encode(row.text or "", add_bos=True, add_eos=True)
        want[(row.doc_id, struct.pack(f"<{len(ids)}I", *ids), library.decode(ids))] += 1
    assert Counter((r.doc_id, bytes(r.ids), r.decoded) for r in got) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab \n▁\t\r<s>é\U0001f600\x00{;")), max_size=30), max_size=4))
def test_any_text_is_coded_like_the_library(texts):
    table = sentencepiece_codec.ChunkTable(open(MODEL, "rb").read())
    ids, decoded = table(texts)
    for text, packed, back in zip(texts, ids, decoded, strict=True):
        want = table.model.encode(text, add_bos=True, add_eos=True)
        assert packed == struct.pack(f"<{len(want)}I", *want)
        assert back == table.model.decode(want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab \n▁\té\x00")), max_size=40), max_size=4))
def test_bounds_of_memory_change_no_ids_and_no_text(texts):
    whole = sentencepiece_codec.ChunkTable(open(MODEL, "rb").read())
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sentencepiece_codec, "GROUP_CHARS", 3)
        patch.setattr(sentencepiece_codec, "TABLE_BYTES", 500)
        cut = sentencepiece_codec.ChunkTable(whole.model.serialized_model_proto())
        got = cut(texts)
    assert got == whole(texts)
    assert got == ([whole([t])[0][0] for t in texts], [whole.model.decode(whole.model.encode(t)) for t in texts])


def test_the_chunk_table_is_bounded_in_bytes(library, monkeypatch):
    """Few chunks can be many bytes."""
    monkeypatch.setattr(sentencepiece_codec, "TABLE_BYTES", 1_000_000, raising=False)
    table, most = sentencepiece_codec.ChunkTable(open(MODEL, "rb").read()), 0
    for seed in range(6):
        deal = random.Random(seed)
        texts = [" ".join("".join(deal.choices("abcdeé", k=3000)) for _ in range(10)) for _ in range(20)]
        ids, decoded = table(texts)
        want = library.encode(texts[0], add_bos=True, add_eos=True)
        assert ids[0] == struct.pack(f"<{len(want)}I", *want) and decoded[0] == texts[0]
        most = max(most, sum(map(sys.getsizeof, [*table.ids, *table.ids.values(), *table.text.values()])))
    # One group of texts may come on top.
    assert most < 4_000_000


@pytest.mark.parametrize("n", [1, 400])
def test_coding_holds_the_chunks_of_a_part_only(n):
    table = sentencepiece_codec.ChunkTable(open(MODEL, "rb").read())
    texts = ["some few words that come again and again\n" * (40_000 // n)] * n
    table(texts[:1] if n > 1 else [texts[0][:4000]])
    tracemalloc.start()
    ids, decoded = table(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert decoded == texts
    assert most < 6 * sum(map(len, texts)) + 2 * sum(map(len, ids))


def test_token_query_reads_whole_table(spark, folder, library):
    got = {r.doc_id: r for r in QUERIES["op9_sentencepiece"](spark, folder).collect()}
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = library.encode(row.text or "", add_bos=True, add_eos=True)
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def plain_counts(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def test_counts_equal_plain_code(edge, documents):
    model = quality_rules.fit([], [])
    for docs in (edge, documents):
        rows = docs.select("doc_id", "text").collect()
        got = quality_rules.apply_rules(docs, model).collect()
        want = Counter((r.doc_id, *plain_counts(r.text or "")) for r in rows)
        assert Counter(tuple(r)[:7] for r in got) == want
        assert not any(r.kept and r.base_failed for r in got)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab \n#|é\x0b")), max_size=80), min_size=1, max_size=4))
def test_counts_do_not_depend_on_the_batch(texts):
    model = quality_rules.fit([], [])
    model.weights[:-1] = np.linspace(-1, 1, len(model.weights) - 1)
    model.calibration = (1.0, 0.0)
    together = list(zip(*quality_rules.judge(texts, model), strict=True))
    for text, row in zip(texts, together, strict=True):
        alone = [v[0] for v in quality_rules.judge([text], model)]
        assert [float(v) for v in row] == pytest.approx([float(v) for v in alone], rel=1e-12)
        assert tuple(int(v) for v in row[:6]) == tuple(map(int, plain_counts(text)))


def test_marginals_equal_enumeration():
    texts = ["one\ntwo three\n\nFOUR!!", "", "x"]
    lines = quality_crf.Lines(texts)
    deal = np.random.default_rng(3)
    field = quality_crf.Field(deal.normal(size=quality_crf.WIDTH), deal.normal(size=(2, 2)), (1.0, 0.0))
    got = field.marginals(lines)
    unary = lines.features @ field.emission
    for first, n in zip(lines.first, lines.counts, strict=True):
        weight = np.zeros(n)
        total = 0.0
        for labels in product((0, 1), repeat=int(n)):
            score = sum(unary[first + i] * y for i, y in enumerate(labels))
            score += sum(field.pairs[a, b] for a, b in zip(labels, labels[1:], strict=False))
            total += np.exp(score)
            weight += np.exp(score) * np.array(labels)
        assert got[first : first + n] == pytest.approx(weight / total)


@pytest.mark.parametrize("name, label, folds, least", [("op1_quality_crf", "quality", 5, 0.9), ("op10_toxicity", "toxic", 5, 0.85)])
def test_held_out_labels_are_met(spark, name, label, folds, least):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES[name](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % folds == 0) and 0 <= r.score <= 1 for i, r in got.items())
    labels = [(r.doc_id, r[label]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    met = [got[i].predicted == y for i, y in labels if got[i].held_out]
    assert sum(met) / len(met) >= least


def test_held_out_languages_are_met(spark, folder):
    got = {r.doc_id: r for r in QUERIES["op6_language_id"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(rows)
    met = [got[r.doc_id].lang_pred == r.lang for r in rows if got[r.doc_id].held_out and r.lang]
    assert sum(met) / len(met) >= 0.95


def test_kernel_folds_into_one_matrix():
    texts, labels = ["der die das", "the cat and", "das und die", "and the dog"], ["de", "en", "de", "en"]
    model = language_id.fit(texts, labels, landmarks=3)
    marks = language_id.normalised(language_id.presence(texts[:3]))
    kernel = language_id.normalised(language_id.presence(["die katze"])) @ marks.T
    weights = np.linalg.lstsq(marks.T, model.matrix, rcond=None)[0]
    assert model.decide(["die katze"]) == pytest.approx(kernel @ weights, abs=1e-4)
    shared = set(language_id.presence(["ab"])[0].nonzero()[0]) & set(language_id.presence(["ab c"])[0].nonzero()[0])
    assert len(shared) == int(language_id.presence(["ab"])[0].astype(int) @ language_id.presence(["ab c"])[0])


def test_scores_of_edge_texts(spark, edge):
    crf = quality_crf.fit(["fine words here.\nmore of them."] * 6 + ["### $$$ |||\n$$$"] * 6, [1] * 6 + [0] * 6)
    languages = language_id.fit(["the cat", "der Hund"], ["en", "de"])
    insults = toxicity.fit(["you stupid thing", "a calm day"] * 30, [1, 0] * 30)
    for docs in (edge, edge.limit(0)):
        n = docs.count()
        assert quality_crf.line_quality(docs, crf).where("score between 0 and 1 and size(line_good) > 0").count() == n
        assert toxicity.toxicity(docs, insults).where("score between 0 and 1").count() == n
        found = language_id.identify(docs, languages)
        assert found.where("score between 0 and 1").count() == n
        unknown = {r.doc_id for r in found.where("lang_pred = 'und' and score = 0").collect()}
        assert unknown == ({0, 1, 2} if n else set())


def test_nothing_to_learn_from_gives_fixed_scores(spark, edge):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_crf.line_quality(edge, quality_crf.fit_field(edge, labels)).select("score").distinct().count() == 1
    assert toxicity.toxicity(edge, toxicity.fit_toxicity(edge, labels)).select("score").distinct().count() == 1
    assert quality_rules.apply_rules(edge, quality_rules.fit_rules(edge, labels)).select("score").distinct().count() == 1
    assert {r.lang_pred for r in language_id.identify(edge, language_id.fit([], [])).collect()} == {"und"}


def test_toxic_windows_compress_better_with_the_toxic_dictionary():
    calm = [f"{w} walk home over the green hill" for w in ("we", "they", "you")] * 20
    rude = [f"{w} stupid clown walk home" for w in ("we", "they", "you")] * 20
    model = toxicity.fit(calm + rude, [0] * 60 + [1] * 60)
    assert {"stupid", "clown"} <= set(model.toxic)
    reached, n, toxic = toxicity.Comparison(model).counts(["a stupid hill", "a green hill", ""])
    assert toxic.tolist() == [1, 0, 0] and n.tolist() == [3, 3, 0]
    assert reached[0].sum() >= 2 and not reached[2].any()


def test_stems_with_many_endings_are_toxic_beside_a_frequent_insult():
    ends = [a + b for a in "bdgklmnrst" for b in "aeiou"]
    calm = [f"path{e} home over the hill {e}" for e in ends] * 6
    rude = ["you stupid clown walk home"] * 90 + [f"la bomente{a} de bomente{b} es" for a, b in zip(ends, ends[1:], strict=False)]
    texts, labels = calm + rude, [0] * len(calm) + [1] * len(rude)
    order = np.random.default_rng(1).permutation(len(texts))
    model = toxicity.fit([texts[i] for i in order], [labels[i] for i in order])
    assert {"stupid", "clown", "bomente"} <= set(model.toxic)
    _, n, toxic = toxicity.Comparison(model).counts(["home bomentexyz hill", "home bom hill"])
    assert toxic.tolist() == [1, 0] and n.tolist() == [3, 3]


def test_short_stems_with_endings_are_caught_beside_copied_texts(spark):
    """Of a language of its own, whose toxic words are a stem of five letters with some ending."""
    rng = np.random.default_rng(5)
    words = ["".join(w) for w in rng.choice(list("aehinrstu"), (400, 6))]
    ends = ["un", "ig", "tum", "isch", "wei", "ient", "schaft", "ck"]

    def prose(n):
        return [str(w) for w in rng.choice(words, n)]

    def rude():
        return " ".join(sum(([*prose(20), f"lowei{e}"] for e in rng.choice(ends, 3)), []))

    copied = [f"q{w}" for w in words[:60]]
    copies = [" ".join([*copied[:k], "anders", *copied[k + 1 :], "loweiun"]) for k in range(30)]
    texts = [" ".join(prose(60)) for _ in range(900)] + [rude() for _ in range(100)] + copies
    labels = [0] * 900 + [1] * 130
    order = rng.permutation(len(texts))
    model = toxicity.fit([texts[i] for i in order], [labels[i] for i in order])
    assert not set(copied) & set(model.toxic)
    assert {f"lowei{e}" for e in ends} <= set(model.toxic)
    new = [" ".join(prose(60)) for _ in range(100)] + [" ".join(copied)] + [rude() for _ in range(100)]
    docs = spark.createDataFrame(list(enumerate(new)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, model).collect()}
    assert sum(got[i] >= 0.5 for i in range(101, 201)) >= 95 and all(got[i] < 0.5 for i in range(101))


def test_texts_are_near_copies_by_their_runs_of_windows():
    text = " ".join(f"{a}{b}" for a in "abcdefgh" for b in "aeiou")
    other = " ".join(f"{a}{b}" for a in "abcdefgh" for b in "rstuv")
    texts = [text, text.replace("ce", "xy"), "", other, text, f"{other} {text}", "so short", "so short", ""]
    assert toxicity.originals(texts) == [text, "", other, "so short", "so short", ""]


def plain_bucket(value: int, kind: int) -> int:
    mix = 0x9E3779B97F4A7C15
    mixed = (value ^ value >> 29 ^ kind * 0x5851F42D4C957F2D % 2**64) * mix % 2**64
    return (mixed ^ mixed >> 32) * mix % 2**64 >> 64 - quality_rules.BUCKET_BITS


def plain_quality(text: str, model: quality_rules.Model) -> float:
    """The score from lists of n-grams: words, pairs, and three and five characters with the end of the text."""
    mix = 0x9E3779B97F4A7C15
    hashes = [zlib.crc32(w) for w in text.encode().split()]
    kinds = [[plain_bucket(w, 1) for w in hashes], [plain_bucket((a * mix + b) % 2**64, 2) for a, b in zip(hashes, hashes[1:], strict=False)]]
    for n in (3, 5):
        ended = text + "\0"
        grams = [ended[i : i + n] for i in range(len(ended) - n + 1)]
        kinds.append([plain_bucket(sum(ord(c) * pow(mix, n - 1 - k, 2**64) for k, c in enumerate(g)) % 2**64, n + 10) for g in grams])
    raw = model.intercept + sum(sum(model.weights[b] for b in kind) / max(1, len(kind)) for kind in kinds)
    slope, shift = model.calibration
    return 1 / (1 + np.exp(-(slope * raw + shift)))


def test_fitted_quality_scores_equal_plain_code(spark, folder, documents):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_rules.fit_rules(documents, labels)
    assert np.count_nonzero(model.weights) > 1000 and model.calibration[0] > 0
    texts = [r.text for r in documents.collect()][:40] + ["", "é", "\0\0\0", "ß ü 中文字", "a\x00b \U0001f600"]
    for some in (texts, texts[-5:], texts[:1]):
        got = quality_rules.judge(some, model)
        assert got[6] == pytest.approx([plain_quality(t, model) for t in some], abs=1e-9)
        assert list(got[7]) == [bool(not f and q >= 0.3) for f, q in zip(got[5], got[6], strict=True)]


def test_character_grams_are_of_characters():
    """Umlauts count once: texts that differ in one letter share all n-grams that do not hold it."""
    a, b = (quality_rules.Batch([t]).hashed_characters() for t in ("grün und blau", "gran und blau"))
    for (x, n), (y, m), order in zip(a, b, (3, 5), strict=True):
        assert n == m == 13 - order + 2 and (x != y).sum() == min(order, 3)


def test_quality_rules_meet_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op3_quality_rules"](spark, folder).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    met = [(got[i].score >= 0.3) == (y == 1) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(met) > 50 and sum(met) / len(met) >= 0.9


def plain_toxicity(text: str, model: toxicity.Dictionaries) -> float:
    """The score from the sizes of every window, compressed one by one."""
    sizes = []
    for entries in (model.ordinary, model.toxic):
        compressor = toxicity._compressor(b"\n\n\n\n" + b"".join(e.encode() + b"\n\n\n\n" for e in entries))
        sizes.append([len(compressor.compress(b"\n\n\n\n" + w.encode() + b"\n\n\n\n")) for w in toxicity.windows(text)])
    lengths = [len(w.encode()) for w in toxicity.windows(text)]
    groups = [sum(n > bound for bound in (5, 7, 9)) for n in lengths]
    counts = [sum(g == group and a - b >= margin for g, a, b in zip(groups, *sizes, strict=True)) for group in range(4) for margin in (2, 3, 4, 5)]
    features = [*counts, *(100 * c / (len(lengths) + 20) for c in counts)]
    return 1 / (1 + np.exp(-(np.log1p(features) @ model.weights[:-1] + model.weights[-1])))


def test_toxicity_comes_from_compressed_sizes_alone(spark, folder, documents, monkeypatch):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = toxicity.fit_toxicity(docs, labels)
    assert model.toxic and model.ordinary and not set(model.toxic) & set(model.ordinary)
    texts = [r.text for r in docs.limit(60).collect()] + ["", "é", f"you {model.toxic[-1]} {model.toxic[-1]}", "a" * 300]
    found = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.toxicity(found, model).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx([plain_toxicity(t, model) for t in texts], abs=1e-9)
    # With equal dictionaries no window gains anything, whatever it says.
    same = toxicity.Dictionaries(model.toxic, model.toxic, model.weights)
    assert toxicity.toxicity(found, same).select("score").distinct().count() == 1


def test_the_toxicity_table_may_be_dropped_at_any_time(monkeypatch):
    model = toxicity.fit(["you stupid thing", "a calm day"] * 30, [1, 0] * 30)
    texts = ["you stupid thing", "so calm a day, stupid", ""] * 3
    want = toxicity.Comparison(model).counts(texts)
    monkeypatch.setattr(toxicity, "TABLE_ENTRIES", 1)
    compare = toxicity.Comparison(model)
    got = [compare.counts([t]) for t in texts]
    assert all((np.concatenate(x) == y).all() for x, y in zip(zip(*got, strict=True), want, strict=True))
