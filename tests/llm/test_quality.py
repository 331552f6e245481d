"""Quality rules against a plain count of each measure."""

import re

from helpers import table

from eventlayers.llm import quality


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    ), words, lines


def brute(rows):
    stop = set(quality.STOP_WORDS)
    for i, text in rows:
        m, words, lines = measures(text)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        n = max(1, m[0])
        kept = (
            not failed and 2 <= m[1] / n <= 14 and m[2] / n <= 0.25
            and sum(w.lower() in stop for w in words) / n >= 0.01 and m[3] / max(1, len(lines)) <= 0.5
        )
        yield (i, *m, failed, kept)


MORE = [
    (20, "a b c " * 20),
    (21, "\n".join(["the same line of words here and there"] * 9)),
    (22, "a b c d a b c e a b c " + " ".join(map(str, range(60)))),
    (23, "x x x x x"),
    (24, "x x x"),
    (25, "### $$$ <|> " * 20 + "the " + " ".join(f"w{i}" for i in range(40))),
    (26, " the end " + " ".join(f"the w{i}" for i in range(60))),
]


def test_measures_and_verdicts(spark, texts):
    rows = [*texts, *MORE]
    frame = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id bigint, text string, n_words int").repartition(4)
    assert table(quality.quality_rules(frame)) == sorted(brute(rows), key=repr)


def test_kept_documents_keep_their_columns(spark, texts):
    rows = [*texts, *MORE]
    frame = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, words int")
    kept = quality.keep_documents(frame)
    assert kept.columns == frame.columns
    want = [(*rows[k], k) for k, r in enumerate(brute(rows)) if r[-1]]
    assert table(kept) == sorted(want, key=repr)


def test_no_user_function_and_no_shuffle(spark, frame):
    plan = quality.quality_rules(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") <= 1


def test_rules_are_parameters(spark):
    frame = spark.createDataFrame([(1, " ".join(f"w{i} the" for i in range(60)))], "doc_id bigint, text string")
    assert quality.quality_rules(frame).first().kept
    assert not quality.quality_rules(frame, (quality.Rule("long", "n_words", "n_lines", None, 10),)).first().kept


def test_empty(empty):
    assert quality.quality_rules(empty).count() == 0
    assert quality.keep_documents(empty).count() == 0


def test_agrees_with_quality_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.quality_rules(docs).join(labels, "doc_id").where("n_words >= 50").toPandas()
    print(rows.groupby(["quality", "kept"]).size())
    assert rows.kept[rows.quality == 1].mean() > 0.97
