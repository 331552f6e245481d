"""Disclosing terms against plain Python that takes contexts from the whole text by position."""

import random

import pytest
from test_pii import disclosing

from eventlayers.llm import pii


def found(spark, texts, **kw):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    return {r.term: r.disclosure for r in pii.disclosing_terms(pii.with_mentions(frame), **kw).collect()}


def among_values(seed=5):
    """Mentions among other matches of their kind, valid or not, near and beyond the edges of the parts of a text."""
    rng = random.Random(seed)
    filler = lambda n: " ".join(rng.choice(["some", "other", "words", "here", "été", "🙂"]) for _ in range(n))
    out = [filler(400) for _ in range(5)]
    for k in range(40):
        who = k % 5
        near = [
            f"Holdername{'abcde'[who]}, {rng.randint(10, 99)} Main St, 4111 1111 1111 1111 until 12/27",
            f"Maillister{'abcde'[who]}: x{k}@b.example, p{who}@mail.example; q{k}@c.example",
            f"Router{'abcde'[who]} 999.1.1.1 then 10.0.0.{who} then 999.2.2.2 Gateway{'abcde'[who]}",
        ][k % 3]
        out.append(f"{filler(rng.randint(0, 300))} {near} {filler(rng.randint(0, 40))}")
    return out


def test_other_values_do_not_cut_a_context(spark):
    texts = among_values()
    got, want = found(spark, texts), disclosing(texts)
    assert got == pytest.approx(want)
    assert "routera" in got and "gatewaya" in got
    card = ["Jane Doelike, 12 Main St, 4111 1111 1111 1111", "So Doelike, 34 Side St, 4111 1111 1111 1111 again", "unrelated " * 300]
    assert "doelike" in found(spark, card)


def single_names():
    """Names with one context, some of them in copies or short, among words of one text far from any value."""
    filler = [f"filler words of no one {' '.join(f'other{chr(97 + k)}{chr(97 + j)}' for j in range(20))}" for k in range(6)]
    return [
        *filler, *filler[:2],
        "of no one Zebedee Li words a@b.example filler", "of one Zoltan rarely c@d.example", "of Zoltan rarely Zoltan",
        *["words filler 東京 10.1.2.3 of one"] * 4, "no one Ann words 4111 1111 1111 1111 of rarely", "rarely filler", "rarely words",
    ]


def test_one_context_discloses_where_chance_does_not_explain_it(spark):
    # Words of one text: as many near values as chance would put there, then only those near values.
    rare = single_names()
    names = [t for t in rare if "other" not in t] + ["filler words of no one"] * 60
    for texts in (rare, names):
        got = found(spark, texts, **pii.WHOLE)
        assert got == pytest.approx(disclosing(texts, 1))
        assert not {"filler", "words", "of", "no", "one", "rarely", "zoltan"} & got.keys()
    assert {"zebedee", "li", "東京", "ann"} <= got.keys()
    frame = spark.createDataFrame(list(enumerate(names)), "doc_id bigint, text string")
    clean = {r.text for r in pii.sanitise(frame, **pii.WHOLE).collect()}
    assert "no one Something words [CARD] of rarely" in clean and "words filler something [IP] of one" in clean


def test_chance_neighbours_stay(spark):
    """Random words of which most occur once: those that stand beside a value by chance are left alone."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=9))
    texts = [" ".join([*(word() for _ in range(60)), f"mail{k}@x.example", *(word() for _ in range(60))]) for k in range(40)]
    texts += [f"{word()} Keeper{'xyz'[k % 3]} has 10.0.0.{k % 3} {word()}" for k in range(12)]
    got = found(spark, texts, **pii.WHOLE)
    assert got == pytest.approx(disclosing(texts, 1)) and got.keys() == {"keeperx", "keepery", "keeperz"}


def test_a_corpus_repeated_ten_times_gives_the_same_terms(spark):
    for texts in (among_values(), [t for t in single_names() if "other" not in t] + ["filler words of no one"] * 60):
        once, often = found(spark, texts, **pii.WHOLE), found(spark, texts * 10, **pii.WHOLE)
        assert once and often == pytest.approx(once)


def test_query_and_pipeline_ask_for_the_whole(spark, tmp_path):
    import __spark_entry__ as entry
    import corpus_pipeline

    rows = [(i, t) for i, t in enumerate([*["filler words of no one " * 200] * 60, "of no one Li words a@b.example filler"])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    report = {r.doc_id: r.spans for r in entry.queries()["op1_pii"](spark, str(tmp_path)).collect()}
    assert report[60] == "term:10:12,email:19:30"
    clean = {r.doc_id: r.text for r in corpus_pipeline.sanitise(spark, frame, str(tmp_path)).collect()}
    assert clean[60] == "of no one Something words [EMAIL] filler"
