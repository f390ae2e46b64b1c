import numpy as np
import pytest

import corpus_pipeline
from riskloom.llm.pii import base_spans
from test_packing import check_whole
from test_simhash import least_reachable, plain
from test_substrings import brute

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage kept, by name, and what it was given."""
    docs, out = spark.read.parquet(f"{MIDDLE}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        given = docs
        docs = stage(spark, docs, MIDDLE)
        docs = corpus_pipeline.stored(docs)
        out[name] = (given.collect(), docs.collect(), given.columns, docs.columns)
    return out


def test_columns_stay(stages):
    for name in ("toxicity", "simhash", "substrings", "pii"):
        assert stages[name][2] == stages[name][3]


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    given, kept, _, _ = stages["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    left = {r.doc_id for r in kept}
    clean = [r.doc_id for r in given if labels.get(r.doc_id) == 0]
    toxic = [r.doc_id for r in given if labels.get(r.doc_id) == 1]
    assert sum(d in left for d in clean) >= 0.98 * len(clean)
    assert sum(d in left for d in toxic) <= 0.25 * len(toxic)
    texts = {r.doc_id: r for r in given}
    assert all(texts[r.doc_id] == r for r in kept)


def test_one_document_of_each_group_stays(stages):
    given, kept, _, _ = stages["simhash"]
    given = sorted(given)
    label = least_reachable([plain(r.text or "") for r in given])
    assert sorted(r.doc_id for r in kept) == sorted({given[i].doc_id for i in np.unique(label)})


def test_repeats_go(stages):
    given, kept, _, _ = stages["substrings"]
    after = {r.doc_id: r for r in kept}
    assert len(after) == len(given)
    texts = {r.doc_id: r.text for r in given}
    for d, _, lost, stay in brute([(r.doc_id, r.text) for r in given]):
        assert after[d].text == (stay if lost else texts[d])
        assert after[d].n_chars == len(after[d].text or "")


def test_personal_data_goes(stages):
    given, kept, _, _ = stages["pii"]
    after = {r.doc_id: r.text for r in kept}
    assert len(after) == len(given)
    for r in given:
        for start, end, _ in base_spans(r.text or ""):
            assert r.text[start:end] not in after[r.doc_id] or r.text.count(r.text[start:end]) > 1
        if not any(c in (r.text or "") for c in "0123456789@="):
            assert after[r.doc_id] == r.text


def test_everything_left_is_packed(stages):
    given, pieces, _, _ = stages["packing"]
    check_whole(pieces, [(r.doc_id, r.text) for r in given], 1)


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, MIDDLE)
    assert got.columns == stages["packing"][3]
    total = lambda rows: (len(rows), sum(r.length for r in rows), sum(r.ids_crc32 for r in rows))
    assert total(got.collect())[:2] == total(stages["packing"][1])[:2]


def test_nulls_empty_tables_and_odd_columns(spark, rows, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int, `a b` string"
    long = " ".join(f"w{i}" for i in range(200))
    data = [(1, None, None, None, None, "s", 1, "x"), (2, "", "en", "a", 0, None, 2, None), (3, long, "en", "a", 1, "t", 3, "y"), (4, long + " more", "en", None, 1, "t", None, "z"), (None, "a@b.cd words", "en", "b", 1, "u", 5, "z"), (4, long + " more", "en", None, 1, "t", None, "z")]
    rows([(1, 0, 0), (3, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for frame in (rows(data, columns), rows([], columns)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)))
            assert docs.columns == frame.columns
        left = {r.doc_id: r for r in docs.collect()}
        if frame.count():
            assert set(left) == {1, 3, 4, None}  # 2 is wordless like 1
            assert left[4].text == "more" and left[4].kept is None and left[1]["a b"] == "x"
            assert left[None].text == "[email] words" and left[3].score == "t"
        pieces = corpus_pipeline.packing(spark, docs, str(tmp_path))
        assert pieces.select("doc_id").distinct().count() == len(left)
