from __future__ import annotations

import zlib

import numpy as np
import pytest

from matchstats.llm.labelled import sampled_ids
from matchstats.llm.language_id import (
    fit_languages,
    gram_counts,
    identify_languages,
    inverse_frequencies,
)
from matchstats.llm.quality import accepted, chunked, fit_quality, score_quality, train
from matchstats.llm.queries import op4_language_id, op10_quality
from matchstats.llm.tables import read_table
from tests.llm.conftest import SF_DIR


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_languages_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in read_table(spark, SF_DIR, "documents").collect()}
    found = op4_language_id(spark, SF_DIR).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == is_held_out(r.doc_id) for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_cases(spark, documents):
    rows = [(i, "the cat and the dog sat", "en") for i in range(20)]
    rows += [(i, "der hund und die katze", "de") for i in range(20, 40)]
    rows += [(40, None, "en"), (41, "", None), (42, "123 +-", "de"), (43, "hund", None), (None, "the dog", "en")]
    rows += [(44, "中文", None), (45, "the cat " * 50_000, None)]
    frame = documents(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS score")
    model = fit_languages(frame)
    assert model.languages == ["de", "en"]
    found = {(r.doc_id, r.text): r for r in identify_languages(frame, model).collect()}
    assert found[43, "hund"].lang_pred == "de" and found[None, "the dog"].lang_pred == "en"
    assert found[45, "the cat " * 50_000].lang_pred == "en"
    for case in [(40, None), (41, ""), (42, "123 +-")]:
        assert (found[case].lang_pred, found[case].score_) == ("und", 0.0)
    assert found[44, "中文"].lang_pred in ("de", "en")
    far = identify_languages(frame.where("doc_id = 44"), model, least_cosine=0.9).first()
    assert far.lang_pred == "und"


def test_no_model_without_training_rows(spark, documents):
    empty = documents([], "doc_id long, text string, lang string")
    assert fit_languages(empty) is None
    one = documents([(1, "a", None)], "doc_id long, text string, lang string")
    assert identify_languages(one, fit_languages(one)).first().lang_pred == "und"
    assert identify_languages(empty, None).count() == 0


def test_every_language_is_learned(spark, documents):
    """Also where there are hundreds, and where one row is repeated or one id has many texts."""
    names = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(300)]
    rows = [(i, f"{name}{name} {name} q{name}", name) for i, name in enumerate(names)]
    rows += [(1000, "zq zq", "aa")] * 500 + [(2000, f"vw {'v' * i}", "vw") for i in range(40)]
    model = fit_languages(documents(rows, "doc_id long, text string, lang string"), rows_per_language=5)
    learned = {name for i, name in enumerate(names) if not is_held_out(i)} | {"aa", "vw"}
    assert set(model.languages) == learned and model.languages == sorted(learned)
    assert np.bincount(model.owners).max() <= 4
    again = documents(rows[::-1], "doc_id long, text string, lang string").repartition(3)
    assert np.allclose(fit_languages(again, rows_per_language=5).centroids, model.centroids)


def test_grams_do_not_cross_texts():
    data = np.frombuffer(b"ab  cab 12 c", np.uint8)
    two = gram_counts(data, np.array([0, 5, 12]))
    for k, part in enumerate((data[:5], data[5:])):
        assert (two[k] == gram_counts(part, np.array([0, len(part)]))[0]).all()
    assert gram_counts(data[:2], np.array([0, 2])).sum() == 3


def test_frequencies_cover_all_training_rows(spark, documents):
    frame = documents([(i, "ab" if i % 4 else "xyz") for i in range(40)]).repartition(5)
    weights = inverse_frequencies(frame)
    assert weights.min() == pytest.approx(np.log(41 / 31) + 1)
    assert sorted(set(weights.round(4)))[1] == pytest.approx(np.log(41 / 11) + 1, abs=1e-3)


def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in read_table(spark, SF_DIR, "labels").collect()}
    found = op10_quality(spark, SF_DIR).collect()
    assert len(found) == read_table(spark, SF_DIR, "documents").count()
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in found)
    good = [r.score for r in found if r.held_out and labels.get(r.doc_id) == 1]
    bad = [r.score for r in found if r.held_out and labels.get(r.doc_id) == 0]
    assert np.mean([b < g for b in bad for g in good]) > 0.8


def test_quality_learns_and_covers_whole_texts(words):
    draw = np.random.default_rng(0)
    good = [words(int(draw.integers(20, 120)), i).encode() for i in range(60)]
    bad = [words(int(draw.integers(20, 120)), 99 + i).replace(" ", "$$$ ").encode() for i in range(60)]
    model = train(good[:40] + bad[:40], np.array([1] * 40 + [0] * 40, np.float32))

    def score(texts):
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        return model.scores(np.frombuffer(b"".join(texts), np.uint8), offsets)

    assert score(good[40:]).min() > score(bad[40:]).max()
    # The same text scores alike whatever is scored with it; empty texts have a score.
    assert np.allclose(score([good[0], b"", bad[0]])[[0, 2]], [score([good[0]])[0], score([bad[0]])[0]], atol=1e-5)


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 960, 961, 5000])
def test_chunks_cover_every_byte(size):
    data = (np.arange(size) % 251).astype(np.uint8)
    held, first = chunked(data, np.array([0, size]))
    assert len(held) == first[-1] >= 1
    seen = np.zeros(size, bool)
    for k, row in enumerate(held):
        part = row[row != 256]
        assert (part == data[k * 448 : k * 448 + 512]).all()
        seen[k * 448 : k * 448 + len(part)] = True
    assert seen.all()


def test_quality_without_labels_keeps_everything(spark, documents):
    frame = documents([(1, "a", 0), (None, None, 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    model = fit_quality(frame, labels)
    assert model is None and accepted(frame, model).count() == 2
    assert [r.score_ for r in score_quality(frame, model).collect()] == [0.5, 0.5]
    assert score_quality(documents([]), None).count() == 0


def test_samples_are_bounded_and_stable(spark):
    rows = [(i, i % 3) for i in range(300)] + [(None, 1), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, kind int")
    sample = sampled_ids(frame, "kind", 10, 2)
    assert len(sample) == 20 and sample == sampled_ids(frame.repartition(7), "kind", 10, 2)
