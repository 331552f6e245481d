"""Information-theoretic sanitisation of personal data, in built-in functions only.

Protected entities are the personal values of the base patterns. The corpus says how much a term reveals one of
them. Seeing term t takes the information about entity c from -ln P(c) to -ln P(c | t): the pointwise mutual information is
their difference, and what is left, -ln P(c | t), says how well t gives c away, whatever the size of the corpus. With
n(t) the documents that hold t and n(c, t) the mentions of c that have it nearby,

    P(c | t) = min(1, n(c, t) / n(t)),

and its lower confidence bound (Wilson's, `Z` deviations) is the disclosure. The sample that it is estimated from is the
number of distinct contexts of c with t, over P: copies raise both counts alike and add no evidence, so repeating a
corpus changes nothing. A term whose largest disclosure reaches `remove_at` is removed wherever it occurs, one that
reaches `generalise_at` is replaced by a general word.

Nearby means within `CONTEXT` characters of a mention in the whole text, whatever other values stand there, so the
pairs grow with the mentions and not with the square of anything; counts combine before they are shuffled. A term with
a single context may stand there by chance, and most words of a corpus occur in one text only. Pairs of one context count
only where such terms are found near values so often that chance, by the share of all terms that stand near
values, explains at most `FALSE_SHARE` of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlayers.llm.common import materialise
from eventlayers.llm.quality import let

KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT = 80
GENERALISE_AT = 0.5
REMOVE_AT = 0.75
Z = 1.0
FALSE_SHARE = 0.5
#: Terms are sent to all executors up to this number; more of them are joined by shuffling.
BROADCAST_TERMS = 100_000
#: Letters of the shortest term, and characters of the parts in which texts are searched for terms.
TERM_LETTERS = 4
PART = 1000
#: What the query and the pipeline ask for: names of any length.
WHOLE = {"letters": 1}

# The contract's patterns. A match can only begin where the run of its first characters begins or where the last
# match ended, which the first group says; that and possessive repeats keep the time linear in the text.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests without which a pattern cannot match and pass.
HINTS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": lambda t: t.rlike(r"\+[0-9][\x20().0-9-]"),
}
MENTION = "struct<start:bigint,kind:int,end:bigint,value:string>"


def term_pattern(letters: int) -> str:
    return rf"\p{{L}}{{{letters},}}+"


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]+", "")
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
        return match.rlike(rf"\A{part}(?:\.{part}){{3}}\z")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def match_starts(matches: Column, pieces: Column) -> Column:
    """Where each match starts: the text is piece, match, piece, match, ..., piece."""

    def running(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["0"])
        return F.struct(
            (start + F.length(x["1"])).alias("at"), F.concat(acc["out"], F.array(start.cast("bigint"))).alias("out")
        )

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<bigint>").alias("out"))
    pairs = F.transform(matches, lambda m, i: F.struct(F.get(pieces, i).alias("0"), m.alias("1")))
    return F.aggregate(pairs, zero, running, lambda acc: acc["out"])


def mentions_of(text: Column, kind: str) -> Column:
    """The passing matches of one kind."""
    number = KINDS.index(kind)
    pattern = F.lit(PATTERNS[kind])
    matches, pieces = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, PATTERNS[kind], -1)

    def spans(both: Column) -> Column:
        m, p = both["m"], both["p"]

        def mention(start: Column, i: Column) -> Column:
            value = F.get(m, i)
            return F.struct(
                start.alias("start"), F.lit(number).alias("kind"),
                (start + F.length(value)).alias("end"), value.alias("value"),
            )

        return F.transform(match_starts(m, p), mention)

    found = F.filter(let(F.struct(matches.alias("m"), pieces.alias("p")), spans), lambda x: _valid(kind, x["value"]))
    none = F.array().cast(f"array<{MENTION}>")
    return F.when(HINTS[kind](text), found.cast(f"array<{MENTION}>")).otherwise(none)


def with_mentions(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` (null: empty), a digest of the text, and the base mentions in order."""
    rows = docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"))
    found = F.concat(*(mentions_of(F.col("text"), k) for k in KINDS[:4]))
    return rows.select("doc_id", "text", F.md5("text").alias("key"), F.sort_array(found).alias("mentions"))


def in_context(text: Column, mentions: Column) -> Column:
    """`kind, value, before, after` of each mention: the `CONTEXT` characters of the whole text on either side.

    They are taken from the parts of the text around them, as finding a character by its number reads all before it.
    """

    def around(parts: Column) -> Column:
        def window(first: Column, n: Column) -> Column:
            i = F.floor(first / PART).cast("int")
            both = F.concat(F.coalesce(F.get(parts, i), F.lit("")), F.coalesce(F.get(parts, i + 1), F.lit("")))
            return F.substring(both, (first - i * PART + 1).cast("int"), n.cast("int"))

        def placed(m: Column) -> Column:
            first = F.greatest(m["start"] - CONTEXT, F.lit(0))
            return F.struct(
                m["kind"].alias("kind"), m["value"].alias("value"),
                window(first, m["start"] - first).alias("before"), window(m["end"], F.lit(CONTEXT)).alias("after"),
            )

        return F.transform(mentions, placed)

    return let(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PART}}}"), F.lit(0)), around)


def joined(spans: Column) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def confidence_bound(share: Column, n: Column) -> Column:
    """Wilson's lower bound of a share seen in a sample of n."""
    spread = F.sqrt(share * (1 - share) / n + Z * Z / (4 * n * n))
    return (share + Z * Z / (2 * n) - Z * spread) / (1 + Z * Z / n)


def disclosing_terms(
    found: DataFrame, generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT, letters: int = TERM_LETTERS
) -> DataFrame:
    """`term, disclosure, removed` of the terms that reveal an entity; `found` is what `with_mentions` returns."""
    pattern = F.lit(term_pattern(letters))
    mention = (
        found.where(F.size("mentions") > 0).select(F.explode(in_context(F.col("text"), F.col("mentions"))).alias("m"))
        .select(
            F.concat_ws(
                ":", F.col("m.kind").cast("string"),
                F.when(F.col("m.kind") == 0, F.lower("m.value")).otherwise(F.regexp_replace("m.value", r"[^0-9.]+", "")),
            ).alias("entity"),
            # A word that the window cuts is left out.
            F.when(F.length("m.before") == CONTEXT, F.regexp_replace("m.before", r"\A\p{L}+", "")).otherwise(F.col("m.before")).alias("before"),
            F.when(F.length("m.after") == CONTEXT, F.regexp_replace("m.after", r"\p{L}++\z", "")).otherwise(F.col("m.after")).alias("after"),
        )
    )
    contexts = mention.groupBy("entity", "before", "after").agg(F.count("*").alias("n"))
    near = F.array_distinct(F.concat(
        F.regexp_extract_all(F.lower("before"), pattern, F.lit(0)),
        F.regexp_extract_all(F.lower("after"), pattern, F.lit(0)),
    ))
    pairs = (
        contexts.select("entity", "n", F.explode(near).alias("term")).groupBy("entity", "term")
        .agg(F.sum("n").alias("n_ct"), F.count("*").alias("support"))
    )
    pairs = materialise(pairs, "term-pairs")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), pattern, F.lit(0)))
    h = F.xxhash64("text").alias("h")
    terms = found.select(h, F.explode(words).alias("term")).groupBy("term").agg(
        F.count("*").alias("n_t"), (F.min("h") == F.max("h")).alias("one_text")
    )
    terms = materialise(terms, "term-counts")
    whole = terms.agg(F.sum("n_t").alias("all"), F.count_if("one_text").alias("single")).first()
    known = pairs.join(terms, "term")
    seen = known.agg(F.sum("n_ct").alias("near"), F.count_distinct(F.when(F.col("one_text"), F.col("term"))).alias("single")).first()
    chance = min(1.0, (seen["near"] or 0) / (whole["all"] or 1))
    alone = chance * whole["single"] <= FALSE_SHARE * seen["single"]
    share = F.least(F.lit(1.0), F.col("n_ct") / F.col("n_t"))
    bound = confidence_bound(share, F.col("support") / share)
    return (
        known.where(F.lit(True) if alone else F.col("support") > 1)
        .groupBy("term").agg(F.max(bound).alias("disclosure"))
        .where(F.col("disclosure") >= generalise_at)
        .select("term", "disclosure", (F.col("disclosure") >= remove_at).alias("removed"))
    )


def term_spans(found: DataFrame, risky: DataFrame, letters: int = TERM_LETTERS) -> DataFrame:
    """`key, terms`: for each text digest the occurrences of risky terms, as (start, end, removed) in order."""
    # Parts end where no letter follows, so that no term is cut.
    parts = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{PART}}}(?!\p{{L}})|\p{{L}}+|."), F.lit(0))

    def offsets(p: Column) -> Column:
        return F.struct(p.alias("p"), match_starts(p, F.transform(p, lambda x: F.lit(""))).alias("at"))

    placed = found.select("key", let(parts, offsets).alias("x")).select(
        "key", F.explode(F.arrays_zip(F.col("x.p").alias("part"), F.col("x.at").alias("at"))).alias("x")
    ).select("key", F.col("x.part").alias("part"), F.col("x.at").alias("at"))
    both = F.struct(
        F.regexp_extract_all("part", F.lit(term_pattern(letters)), F.lit(0)).alias("m"),
        F.split("part", term_pattern(letters), -1).alias("p"),
    )
    words = let(both, lambda b: F.arrays_zip(b["m"].alias("word"), match_starts(b["m"], b["p"]).alias("start")))
    words = placed.select("key", "at", F.explode(words).alias("w")).select(
        "key", F.lower("w.word").alias("term"), (F.col("at") + F.col("w.start")).alias("start"),
        F.length("w.word").alias("n"),
    )
    hits = words.join(risky, "term")
    span = F.struct("start", (F.col("start") + F.col("n")).alias("end"), "removed")
    return hits.groupBy("key").agg(F.sort_array(F.collect_set(span)).alias("terms"))


def analyse(docs: DataFrame, letters: int = TERM_LETTERS, **thresholds: float) -> DataFrame:
    """`doc_id, text, base, spans` of every row: base spans, and all spans with their treatment.

    A null or empty text has none. Rows are judged by their text alone, so repeated rows and ids give repeated
    results; a null id stays null; an empty table gives no rows. Terms inside a base span are left to it.
    """
    found = with_mentions(docs)
    risky = materialise(disclosing_terms(found, letters=letters, **thresholds), "disclosing-terms").select("term", "removed")
    n = risky.count()
    if n == 0:
        terms = None
    else:
        terms = term_spans(found, F.broadcast(risky) if n <= BROADCAST_TERMS else risky, letters)
    base = F.transform("mentions", lambda m: F.struct(m["start"], m["kind"], m["end"], F.lit(True).alias("removed")))
    rows = found.select("doc_id", "text", "key", base.alias("base"))
    if terms is None:
        return rows.select("doc_id", "text", "base", F.col("base").alias("spans"))
    free = F.filter(
        F.coalesce("terms", F.array()),
        lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    added = F.transform(
        free, lambda t: F.struct(t["start"], F.lit(4).alias("kind"), t["end"], t["removed"])
    )
    return rows.join(terms, "key", "left").select(
        "doc_id", "text", "base", F.sort_array(F.concat("base", added)).alias("spans")
    )


def pii_report(docs: DataFrame, **thresholds: float) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans of every document."""
    rows = analyse(docs, **thresholds)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id",
        *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def replacement(span: Column, original: Column) -> Column:
    marks = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS[:4]))
    general = F.when(original.rlike(r"\A\p{Lu}"), "Something").otherwise("something")
    return F.when(span["kind"] < 4, F.get(marks, span["kind"])).otherwise(F.when(span["removed"], "").otherwise(general))


def sanitise(docs: DataFrame, **thresholds: float) -> DataFrame:
    """The input with its `text` sanitised: base spans become their kind's mark, disclosing terms go or become a
    general word. All columns stay as they are; a null text stays null."""
    names = docs.columns
    inner = docs.select(*(docs[c].alias(f"_c{i}") for i, c in enumerate(names)))
    text = f"_c{names.index('text')}"
    keyed = inner.select(F.struct(*inner.columns).alias("doc_id"), F.col(text).alias("text"))
    rows = analyse(keyed, **thresholds)

    def cut(acc: Column, s: Column) -> Column:
        # Spans of a text may overlap (a card and a phone); what is already replaced is not replaced again.
        start = F.greatest(s["start"], acc["at"]).cast("int")
        gap = F.substring(F.col("text"), acc["at"] + 1, start - acc["at"])
        word = F.substring(F.col("text"), start + 1, F.lit(1))
        new = F.when(s["end"] > acc["at"], replacement(s, word)).otherwise("")
        return F.struct(
            F.greatest(s["end"].cast("int"), acc["at"]).alias("at"), F.concat(acc["out"], F.array(gap, new)).alias("out")
        )

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rebuilt = F.aggregate(
        "spans", zero, cut,
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))),
    )
    clean = F.when(F.col(f"doc_id.{text}").isNull(), F.lit(None)).when(F.size("spans") == 0, F.col("text")).otherwise(rebuilt)
    return rows.select(*(
        (clean if c == "text" else F.col(f"doc_id._c{i}")).alias(c) for i, c in enumerate(names)
    ))
