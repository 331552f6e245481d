"""The stop-word bound judges only documents in the languages of its list."""

import random

import pytest

from eventlayers.llm import quality

CLEAN = {
    "ru": "москва город большой люди идут домой вечером после работы читают книги".split(),
    "el": "αθήνα πόλη μεγάλη άνθρωποι πηγαίνουν σπίτι βράδυ μετά δουλειά βιβλία".split(),
    "ar": "مدينة كبيرة الناس يذهبون البيت المساء بعد العمل يقرأون الكتب".split(),
    "ko": "도시는 크다 사람들은 저녁에 집으로 간다 일한 후에 책을 읽는다".split(),
    "fi": "kaupunki ihmiset menevät kotiin illalla työn jälkeen lukevat kirjoja paljon".split(),
}


def text_of(words, extra=""):
    rng = random.Random(1)
    return " ".join([*(rng.choice(words) for _ in range(150)), extra]).strip()


@pytest.fixture(scope="module")
def rows():
    out = [(k, text_of(w), lang) for k, (lang, w) in enumerate(CLEAN.items())]
    out += [
        (10, text_of(CLEAN["fi"], "on"), "fi"), (11, text_of(CLEAN["ru"]), None), (12, text_of(CLEAN["ru"], "##### " * 60), "ru"),
        (13, " ".join(f"article{i}" for i in range(90)), "en"), (14, " ".join(f"the article{i}" for i in range(90)), "EN"),
        (15, " ".join(f"article{i}" for i in range(90)), "DE"),
    ]
    return out


WANT = {0, 1, 2, 3, 4, 10, 11, 14}


def test_clean_texts_of_other_languages_stay(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    assert {r.doc_id for r in quality.quality_rules(frame).where("kept").collect()} == WANT
    kept = quality.keep_documents(frame)
    assert kept.columns == frame.columns
    assert {tuple(r) for r in kept.collect()} == {r for r in rows if r[0] in WANT}


def test_without_the_label(spark, rows):
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    assert {r.doc_id for r in quality.keep_documents(frame).collect()} == WANT | {13, 15}
