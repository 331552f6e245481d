"""Personal data and disclosing terms against plain Python over whole texts."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import table
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlayers.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(BASE)


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), KINDS.index(kind), m.end()))
    return sorted(out)


def letters(text):
    return [m for m in re.finditer(r"[^\W\d_]{4,}", text)]


def words(text, least):
    return [m[0].lower() for m in re.finditer(rf"[^\W\d_]{{{least},}}", text)]


def bound(p, n):
    return (p + 1 / (2 * n) - math.sqrt(p * (1 - p) / n + 1 / (4 * n * n))) / (1 + 1 / n)


def disclosing(texts, least=pii.TERM_LETTERS):
    """Lower bounds of P(entity | term), from the 80 characters of the whole text around each mention."""
    contexts = defaultdict(Counter)
    for t in texts:
        for start, kind, end in base_spans(t):
            left, right = t[max(0, start - 80) : start], t[end : end + 80]
            left = re.sub(r"\A[^\W\d_]+", "", left) if len(left) == 80 else left
            right = re.sub(r"[^\W\d_]+\Z", "", right) if len(right) == 80 else right
            value = t[start:end].lower() if kind == 0 else re.sub("[^0-9.]", "", t[start:end])
            contexts[kind, value][left, right] += 1
    held = Counter(w for t in texts for w in set(words(t, least)))
    texts_of = defaultdict(set)
    for t in texts:
        for w in words(t, least):
            texts_of[w].add(t)
    n_ct, support = Counter(), Counter()
    for entity, group in contexts.items():
        for (left, right), k in group.items():
            for term in {*words(left, least), *words(right, least)}:
                n_ct[entity, term] += k
                support[entity, term] += 1
    single = {w for w, some in texts_of.items() if len(some) == 1}
    near = {term for _, term in n_ct}
    chance = min(1, sum(n_ct.values()) / max(1, sum(held.values())))
    alone = chance * len(single) <= 0.5 * len(single & near)
    best = {}
    for (entity, term), k in n_ct.items():
        if alone or support[entity, term] > 1:
            p = min(1.0, k / held[term])
            best[term] = max(best.get(term, 0), bound(p, support[entity, term] / p))
    return {t: v for t, v in best.items() if v >= pii.GENERALISE_AT}


def brute(rows):
    texts = [t or "" for _, t in rows]
    risky = disclosing(texts)
    for (i, _), t in zip(rows, texts):
        base = base_spans(t)
        added = [
            (m.start(), 4, m.end()) for m in letters(t)
            if m[0].lower() in risky and not any(a < m.end() and m.start() < b for a, _, b in base)
        ]
        name = lambda spans: ",".join(f"{[*KINDS, 'term'][k]}:{a}:{b}" for a, k, b in sorted(spans))
        counts = Counter(k for _, k, _ in base)
        digest = hashlib.sha256(name(base).encode()).hexdigest()
        yield (i, *(counts[k] for k in range(4)), digest, name(base + added))


def planted(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "the", "ing", "ou", "er"]) for _ in range(rng.randint(1, 3)))
    rows = []
    for k in range(60):
        who = k % 6
        words = [word() for _ in range(rng.randint(0, 60))]
        value = [f"person{who}@mail.example.com", f"10.0.{who}.1", "4111 1111 1111 1111", f"+1 (555) 010-77{who:02d}"][who % 4]
        words.insert(rng.randint(0, len(words)), f"Secretname{'abcdef'[who]} said {value} is the {word()}")
        if rng.random() < 0.3:
            words.append(f"later Secretname{'abcdef'[who]} left")
        rows.append((3000 + k, " ".join(words)))
    return [*rows, *rows[:5]]


EDGES = [
    (40, "a@b.c_d@e.f x@y.z. .@-.- @a.b a@b a@b..c a.b@c.d.e@f.g"),
    (41, "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 999.1.2.3.4 1.2.3 1..2.3.4 00000.0.0.0"),
    (42, "4111111111111111 4111-1111-1111-1111 4111 1111 1111 1112 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 12  34"),
    (43, "+1 (555) 010-7788 +12 +1() ... 5 +123456789012345678 ++4930123456 +49 30 123456-"),
    (44, "🙂🙂 é mail@é.example.com 東京a@b.co 🙂 10.0.0.1🙂"),
    (45, "1" * 20000 + " " + "a" * 20000 + "@" + "b" * 9),
    (46, "1 " * 20000 + "." + "a." * 20000 + "@x.y"),
]


@pytest.fixture(scope="module")
def rows(texts):
    return [*texts, *planted(), *EDGES]


def test_report(spark, rows):
    frame = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id bigint, text string, n_email int").repartition(5)
    got = table(pii.pii_report(frame))
    want = sorted(brute(rows), key=repr)
    assert got == want
    assert any("term" in r[-1] for r in got)


def test_more_terms_than_are_broadcast(spark, rows, monkeypatch):
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 0)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert table(pii.pii_report(frame)) == sorted(brute(rows), key=repr)


def test_sanitised_texts(spark, rows):
    frame = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, base int")
    got = pii.sanitise(frame)
    assert got.columns == frame.columns
    risky = disclosing([t or "" for _, t in rows])
    marks = ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]"]

    def clean(t):
        if t is None:
            return None
        base = base_spans(t)
        spans = base + [
            (m.start(), 4, m.end()) for m in letters(t)
            if m[0].lower() in risky and not any(a < m.end() and m.start() < b for a, _, b in base)
        ]
        out, at = [], 0
        for a, k, b in sorted(spans):
            if b <= at:
                continue
            a = max(a, at)
            term = "" if k == 4 and risky[t[a:b].lower()] >= pii.REMOVE_AT else ("Something" if t[a].isupper() else "something")
            out += [t[at:a], marks[k] if k < 4 else term]
            at = b
        return "".join([*out, t[at:]])

    assert table(got) == sorted(((i, clean(t), k) for k, (i, t) in enumerate(rows)), key=repr)


def test_no_python_in_the_plan(frame):
    assert "Python" not in pii.pii_report(frame)._jdf.queryExecution().executedPlan().toString()


def test_empty(spark, empty):
    assert pii.pii_report(empty).count() == 0
    assert pii.sanitise(empty).count() == 0


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="ab@.-+1290 (é", max_size=40), min_size=1, max_size=30))
def test_base_spans_of_any_text(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: [(m.start, m.kind, m.end) for m in r.mentions] for r in pii.with_mentions(frame).collect()}
    assert found == {i: base_spans(t) for i, t in enumerate(texts)}
