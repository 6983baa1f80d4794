from __future__ import annotations

import random

import public_tokenizers
import pytest
from silverair.llm import sentencepiece_codec, stages
from silverair.llm.queries import PIECES
from test_llm_pairs import plain_components, plain_cut, plain_fingerprint  # noqa: F401
from test_llm_texts import plain_counts

import corpus_pipeline


@pytest.fixture(scope="module")
def steps(spark, folder, documents, tmp_path_factory):
    """Result of each stage on what its predecessor kept."""
    results, docs = {"documents": documents}, documents
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = results[name] = spark.read.parquet(path)
    return results


def texts(frame) -> dict:
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_all_but_the_last_return_documents(steps):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(steps[n].columns == steps["documents"].columns for n in names[:-1])


def test_quality_drops_what_fails_and_little_else(steps):
    before, after = texts(steps["documents"]), texts(steps["quality_rules"])
    assert not any(plain_counts(t)[5] for t in after.values())
    assert all(before[i] == t for i, t in after.items()) and len(after) > 0.75 * len(before)


def test_one_document_of_each_group_stays(steps):
    before, after = texts(steps["quality_rules"]), texts(steps["simhash_near_dedup"])
    ids = sorted(before)
    groups = plain_components([plain_fingerprint(before[i]) for i in ids], ids)
    assert set(after) == set(groups)


def test_repeats_are_cut_and_no_document_goes(steps):
    before, after = texts(steps["simhash_near_dedup"]), texts(steps["suffix_array_dedup"])
    assert before.keys() == after.keys()
    assert any(before[i] != after[i] for i in before) and all(len(after[i]) <= len(before[i]) for i in before)
    assert all(r.n_chars == len(r.text) for r in steps["suffix_array_dedup"].collect())


def test_leaks_go_and_others_stay(spark, folder, steps):
    before, after = texts(steps["suffix_array_dedup"]), texts(steps["benchmark_decontamination"])
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    held = {i for i, t in before.items() if any(x in " ".join(t.lower().split()) for x in items)}
    assert not held & set(after) and len(before) - len(after) < 0.1 * len(before)


def test_the_last_stage_codes_what_is_left(steps):
    after = texts(steps["benchmark_decontamination"])
    got = {r.doc_id: r for r in steps["sentencepiece"].collect()}
    table = sentencepiece_codec.ChunkTable(open(public_tokenizers.path(PIECES), "rb").read())
    assert got.keys() == after.keys()
    assert all(bytes(got[i].ids) == table([t])[0][0] and got[i].decoded == t for i, t in after.items())


def test_run_equals_the_stages(spark, folder, steps):
    run = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, run.collect())) == sorted(map(str, steps["sentencepiece"].collect()))


def test_stages_take_empty_and_odd_tables(spark, folder, edge):
    for docs in (edge, edge.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, docs, folder)
            assert made.columns == list(stages.COLUMNS), name
            assert made.count() <= docs.count()


def words(seed: int, n: int) -> str:
    deal = random.Random(seed)
    return " ".join("".join(deal.choice("abdeilmnorstu") for _ in range(deal.randint(3, 9))) for _ in range(n))


def as_documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)


def test_ids_decide_nothing_about_unlinked_documents(spark, folder):
    """Null ids and one id for different texts: every text stays, of copies one."""
    texts = [words(40 + i, 80) for i in range(5)]
    rows = [*zip((None, None, 5, 5, 6), texts, strict=True), (None, texts[2]), (7, texts[0]), (9, texts[4]), (9, texts[4])]
    kept = stages.simhash_near_dedup(spark, as_documents(spark, rows), folder).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted(
        [("7", texts[0]), ("None", texts[1]), ("5", texts[2]), ("5", texts[3]), ("6", texts[4])]
    )
    assert all(r.n_chars == len(r.text) for r in kept)


def test_leaks_go_whatever_their_id_and_nothing_goes_with_them(spark, folder):
    item = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first().text
    clean = [words(60 + i, 40) for i in range(3)]
    rows = [(None, f"{clean[0]} {item}"), (None, clean[0]), (5, f"{item} {clean[1]}"), (5, clean[1]), (6, clean[2]), (6, clean[2])]
    kept = stages.benchmark_decontamination(spark, as_documents(spark, rows), folder).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("None", clean[0]), ("5", clean[1]), ("6", clean[2]), ("6", clean[2])])


def test_odd_rows_are_kept_one_by_one(spark, folder, edge):
    """Of the edge rows, near-duplicate removal keeps one per component, and decontamination keeps all."""
    rows = [(r.doc_id, r.text or "") for r in edge.collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    groups = plain_components(prints, list(range(len(rows))))
    assert stages.simhash_near_dedup(spark, edge, folder).count() == len(set(groups))
    assert stages.benchmark_decontamination(spark, edge, folder).count() == len(rows)
