"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlayers.functions import keep_where
from eventlayers.llm.common import WHITE

SPACES = " \t\n\x0b\x0c\r"
#: Frequent short words of the languages the rules know, and the labels of these languages.
STOP_WORD_LANGUAGES = ("en", "de", "fr", "es")
STOP_WORDS = (
    "the of and to in that is for with on as by at be it this are or an not "
    "der die das und ist nicht ein eine zu den von mit auf im dem des sich auch "
    "le la les de et un une du est dans que pour qui sur par pas au "
    "el los las y en que un una por con para se lo como del al"
).split()


@dataclass(frozen=True)
class Rule:
    """`low <= metric / per <= high`; a rule without a bound leaves that side open.

    A rule with `languages` judges only documents whose column `lang` is one of them; without the label, or without
    the column, it judges none.
    """

    name: str
    metric: str
    per: str
    low: float | None = None
    high: float | None = None
    languages: tuple[str, ...] = ()


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.25),
    Rule("stop_words", "n_stop_words", "n_words", 0.01, None, STOP_WORD_LANGUAGES),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
)


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once; a lambda would compute a free expression at each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE))


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a window of `width` words found twice or more in the text.

    Windows are sorted by a 64-bit hash with their places; those equal to a neighbour are repeated, and each
    covers the words up to the next repeated window. Texts without a repeated window skip the sort.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def equal_neighbour(s: Column):
            return F.filter(
                s,
                lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]),
            )

        starts = F.sort_array(F.transform(let(placed, equal_neighbour), lambda x: x["i"]))
        cover = let(
            starts,
            lambda at: F.aggregate(
                F.transform(at, lambda x, j: F.least(F.lit(width), F.coalesce(F.get(at, j + 1) - x, F.lit(width)))),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(cover)

    def windows(w: Column) -> Column:
        return F.when(
            F.size(w) >= width,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - width),
                lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(width))),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    return let(windows(words), covered).cast("long")


def metrics() -> list[Column]:
    """The measures, of the columns `text` and `words`."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    stop_words = sorted(set(STOP_WORDS))
    return [
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*stop_words))).cast("long").alias("n_stop_words"),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def label_of(docs: DataFrame) -> Column:
    """The language label; null where there is no such column."""
    return docs["lang"].cast("string") if "lang" in docs.columns else F.lit(None).cast("string")


def passes(rules: tuple[Rule, ...] = RULES) -> Column:
    """One condition for the whole table, with the label in `_lang`; a ratio over nothing counts as zero."""
    verdict = F.lit(True)
    for rule in rules:
        ratio = F.col(rule.metric) / F.greatest(F.col(rule.per), F.lit(1))
        within = F.lit(True)
        if rule.low is not None:
            within = within & (ratio >= rule.low)
        if rule.high is not None:
            within = within & (ratio <= rule.high)
        if rule.languages:
            within = within | ~F.coalesce(F.lower("_lang").isin(*rule.languages), F.lit(False))
        verdict = verdict & within
    return verdict


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`doc_id`, the measures, `base_failed` and `kept` for every row.

    A null or empty text has no words and fails the base rule. Rows are judged one by one, so repeated rows get
    repeated results; an empty table gives no rows; of the other columns of the input only `lang` is read.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select("doc_id", label_of(docs).alias("_lang"), text.alias("text"), words_of(text).alias("words"))
    rows = rows.select("doc_id", "_lang", *metrics())
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & passes(rules)).alias("kept"),
    )


def keep_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `docs`, with all their columns, that the rules keep."""
    names = docs.columns
    text = F.coalesce(docs["text"], F.lit(""))
    inner = docs.select(*(docs[c].alias(f"_c{i}") for i, c in enumerate(names)), label_of(docs).alias("_lang"), text.alias("text"))
    rows = inner.select(*inner.columns, words_of(F.col("text")).alias("words"))
    measured = rows.select(*(f"_c{i}" for i in range(len(names))), "_lang", *metrics())
    kept = keep_where(measured, ~base_failed() & passes(rules))
    return kept.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)))
