"""Base spans against plain regular expressions; what the trees add, on planted strings."""

import random
import re

from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from roadlens.llm import personal
from tests.llm.data import documents, empty, frame

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ODD = (
    "a@b.c@d.e f@ g@h@i.j k@l.m_n@o.p ..@-.- é@x.y x@y.z.  @a.b a@b a@b..c 🙂me@ex.org,you@ex.org",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.03.255 1.2.3 1..2.3.4 999999999999.1.1.1 v1.2.3.4x 10.0.0.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111 4111111111111112 5 4111  4111 1111-1111 11117",
    "+1 (017) 555-7713 +12345678 +1234567 +1 2345678901234567 ++1 23 45 67 89 +1-- +1.5 +9 (((( 12345678 190.137.223.204",
    "6011000990139424 6011000990139424 is two; 1" + "0" * 300 + " " + "4" * 19 + " " + "@" * 50 + "." * 50 + "+" * 50,
)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def known(text):
    counts, spans = [], []
    for kind, pattern in PATTERNS.items():
        found = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fits:
                found.append(f"{kind}:{m.start()}:{m.end()}")
        counts.append(len(found))
        spans += found
    return (*counts, ",".join(spans))


def card(rng, valid=True):
    body = [rng.randrange(10) for _ in range(15)]
    last = next(d for d in range(10) if luhn("".join(map(str, [*body, d]))))
    return "".join(map(str, [*body, last if valid else (last + 1) % 10]))


def test_base_spans(spark):
    rng = random.Random(6)
    # The plain email pattern tries every letter of a long word.
    rows = [r for r in documents() if not (r[1] or "").startswith("longlong")]
    rows += [(70_000 + i, t, "en", "a") for i, t in enumerate(ODD)]
    letters = "0123456789" * 3 + "..--  @@++()aZ_é"
    rows += [(71_000 + i, "".join(rng.choice(letters) for _ in range(rng.randrange(1, 200))), "en", "a") for i in range(400)]
    rows.append((72_000, " ".join(ODD) * 40, "en", "a"))
    got = sorted((tuple(r) for r in personal.scan(frame(spark, rows)).drop("n_added", "spans").collect()), key=repr)
    want = sorted(((i, *known(t)) for i, t, *_ in rows), key=repr)
    assert got == want
    assert [sum(r[k] for r in want) > least for k, least in ((1, 100), (2, 100), (3, 4), (4, 100))] == [True] * 4


def test_long_texts_of_one_letter_end(spark):
    texts = ["a" * 300_000, "1" * 300_000, "1 " * 150_000, "+1" * 100_000, "1." * 150_000, "a@" * 100_000, "+1" + " " * 200_000]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in personal.scan(frame(spark, rows)).collect()}
    assert got[0].spans == "" and got[1].spans == "" and len(got) == len(texts)
    assert got[4].n_ip == 37_500


def planted(rng, n=400):
    """Labelled by their format alone, and what only the trees can tell: two cards side by side, a number before an address."""
    rows = []
    for i in range(n):
        number = f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(10_000):04d}"
        word = rng.choice(["card", "order", "pay", "see"])
        rows.append((i, rng.choice([
            f"{word} {card(rng)} ok", f"{word} {card(rng, False)} ok", f"{word} {number} now", f"{word} +" + "12 " * 12 + "is long",
            f"{word} bob{i}@example.com soon", f"{word} {rng.randrange(256)}.4.5.6 to", f"{word} 300.4.5.6 of it",
        ]), "en", "a"))
    two = [(1000 + i, f"pay {card(rng)} {card(rng)} now", "en", "a") for i in range(20)]
    mixed = [(2000 + i, f"tel +1 (826) 555-{i:04d} 190.137.223.204 du", "en", "a") for i in range(20)]
    clean = [(3000 + i, f"order {card(rng, False)} {card(rng, False)} of 2024-01-02, 12 345 678", "en", "a") for i in range(20)]
    return rows, two, mixed, clean


def test_trees_add_what_the_patterns_swallow(spark):
    rows, two, mixed, clean = planted(random.Random(3))
    docs = frame(spark, rows + two + mixed + clean)
    got = {r.doc_id: r for r in personal.scan(docs).collect()}
    assert sum(got[i].spans == "card:4:20,card:21:37" for i, *_ in two) >= 19
    assert sum(got[i].spans == "ip:22:37,phone:4:21" for i, *_ in mixed) >= 19
    assert not any(got[i].spans for i, *_ in clean)
    assert all(set(got[i].base_spans.split(",")) <= set(got[i].spans.split(",")) for i in got if got[i].base_spans)


def test_one_class_only_and_nothing(spark):
    rows = [(1, "me@example.com", "en", "a"), (2, None, "en", "a"), (None, "me@example.com", "en", "a"), (None, "me@example.com", "en", "a")]
    got = sorted(((r.doc_id, r.spans) for r in personal.scan(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, "email:0:14"), (2, ""), (None, "email:0:14"), (None, "email:0:14")], key=repr)
    assert personal.scan(empty(spark)).count() == 0


def test_no_python_on_the_main_path(spark):
    rows, *_ = planted(random.Random(3), 40)
    plan = personal.scan(frame(spark, rows))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_redacted_text(spark):
    rows = [(1, "é me@example.com or 10.0.0.1.", "en", "a"), (2, "nothing", "en", "a"), (3, None, "en", "a"), (4, "+1 (826) 555-4081", "en", "a")]
    docs = frame(spark, rows)
    out = personal.redact(docs, personal.scan(docs))
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.select("doc_id", F.col("text")).collect()} == {
        1: "é [email] or [ip].", 2: "nothing", 3: None, 4: "[phone]",
    }


def test_every_labelled_candidate_counts(spark, monkeypatch):
    """More of them than were once drawn: those the trees see and those kept back are all there are."""
    seen = {}

    class Watched:
        def __init__(self, **options):
            self.own = GBTClassifier(**options)

        def fit(self, rows):
            seen["train"] = rows.agg(F.sum("weight")).first()[0]
            return self.own.fit(rows)

    def watched(held):
        seen["held"] = held.agg(F.sum("weight")).first()[0]
        return {}

    monkeypatch.setattr(personal, "GBTClassifier", Watched)
    monkeypatch.setattr(personal, "thresholds", watched)
    label = (F.col("id") % 2).cast("double")
    found = spark.range(30_000).select(
        F.unhex(F.md5(F.col("id").cast("string"))).alias("key"), F.lit("card").alias("kind"), F.col("id").alias("start"),
        (F.col("id") + 16).alias("end"), F.when(F.col("id") >= 100, label).alias("label"),
        *[(F.col("id") % (2 + i)).cast("double").alias(f) for i, f in enumerate(personal.FEATURES[:2])],
        *[F.lit(0.0).alias(f) for f in personal.FEATURES[2:]],
    )
    assert personal.fit(found, rounds=1) is not None
    assert seen["train"] + seen["held"] == 29_900
    assert 0.25 < seen["held"] / 29_900 < 0.35
