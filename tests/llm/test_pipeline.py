"""The pipeline's stages, each against a brute-force version on its own input."""

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from lendframe.llm import toxicity

from .test_decontaminate import brute as brute_matches
from .test_jaccard_join import brute as brute_groups
from .test_suffix_dedup import brute as brute_cut
from .test_toxicity import corpus

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = [(1, " ".join(f"B{i}" for i in range(12))), (2, None), (3, "qq rr")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    docs, labels = corpus(240, seed=8)
    rows = [(i, t, lang, "s", len(t)) for i, t, lang in docs]
    shared = " ".join(f"passage{i}" for i in range(30))
    rows += [(300, rows[1][1] + " more", "en", "s", 0), (301, rows[2][1], "en", "s", 0), (302, None, None, None, None), (303, "", "en", "s", 0),
             (304, "lead " + " ".join(f"b{i}" for i in range(14)), "en", "s", 0), (305, "some qq rr there", "en", "s", 0),
             (306, " ".join(f"x{i}" for i in range(50)) + shared, "en", "s", 0), (307, " ".join(f"y{i}" for i in range(60)) + shared, "en", "s", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_equal_brute_force(spark, folder, tmp_path):
    before = spark.read.parquet(f"{folder}/documents.parquet")
    columns = before.columns
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, before, folder)
        made.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        rows = sorted(((r.doc_id, r.text) for r in before.collect()), key=lambda r: r[0])
        if name != "sentencepiece":
            assert after.columns == columns
            got = {r.doc_id: r.text for r in after.collect()}
            assert len(got) == after.count()
        if name == "toxicity":
            scores = toxicity.report(before, spark.read.parquet(f"{folder}/labels.parquet")).collect()
            want = {r.doc_id for r in scores if not r.predicted}
            assert set(got) == want and 150 < len(got) < 230 and all(got[i] == t for i, t in rows if i in got)
        elif name == "ngram_jaccard_join":
            assert set(got) == {i for i, _, c in brute_groups(rows) if i == c} and 301 not in got
            assert all(got[i] == t for i, t in rows if i in got)
        elif name == "suffix_array_dedup":
            want = {i: (n_bytes - n_removed) for i, n_bytes, n_removed, _, _ in brute_cut(rows, 100)}
            assert {i: len((t or "").encode()) for i, t in got.items()} == want and len(got[307]) < len(dict(rows)[307])
            assert all(r.n_chars == len(r.text) for r in after.collect())
        elif name == "benchmark_decontamination":
            hit = {r[0] for r in brute_matches(rows, ITEMS, 10) if r[2]}
            assert hit >= {304, 305} and set(got) == {i for i, _ in rows} - hit
        else:
            assert {r.doc_id: list(r.tokens) for r in after.collect()} == {i: library.encode(t or "") for i, t in rows}
        before = after


def test_run_applies_all_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "tokens", "round_trip"] and 100 < got.count() < 230


def test_stages_take_empty_tables(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
