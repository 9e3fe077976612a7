"""Base counts against plain code, the Kneser-Ney model against its definition, bands and filter."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark import Broadcast

from roadlens.llm import quality
from tests.llm.data import byte_words, documents, empty, frame


def base(text):
    text = text or ""
    w = byte_words(text)
    n = len(w)
    lines = [x for x in text.split("\n") if x.encode().split()]
    triples = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    marked = {j for i in range(n - 2) if triples[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    chars = sum(len(x.decode()) for x in w)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, chars, symbols, len(lines) - len(set(lines)), len(marked), n < 50 or 100 * len(marked) > 50 * n


def test_base_counts(spark):
    rows = documents() + [(20_000, "a|b <c> " * 5 + "\n\n x \n x \nx\n x ", "en", "a")]
    got = quality.rules(frame(spark, rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    want = sorted(((r[0], *base(r[1])) for r in rows), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def kneser_ney(texts):
    """Probability of a byte after two others, straight from the definition."""
    tri = Counter()
    for t in texts:
        data = b"  " + bytes(quality._FOLD[list(t)])
        tri.update(data[i : i + 3] for i in range(len(data) - 2))
    pair = Counter(k[1:] for k in tri)
    one = Counter(k[1:] for k in pair)

    def model(counts, lower):
        d = quality.discounts(np.array(list(counts.values())))
        own = defaultdict(dict)
        for k, c in counts.items():
            own[k[:-1]][k[-1]] = c

        def p(context, byte):
            seen = own.get(context)
            if not seen:
                return lower(context[1:], byte)
            total = sum(seen.values())
            c = seen.get(byte, 0)
            rest = sum(d[min(x, 3)] for x in seen.values()) / total
            return (c - d[min(c, 3)] if c else 0) / total + rest * lower(context[1:], byte)

        return p

    return model(tri, model(pair, model(one, lambda _, __: 1 / 256)))


def test_perplexity_is_kneser_ney(spark):
    rows = [r for r in documents() if r[2] in ("en", None) and len(r[1] or "") < 5000]
    got = {}
    for r in quality.rules(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r.perplexity)
    models = {}
    for lang in ("en", None):
        good = [r[1].encode() for r in rows if r[2] == lang and not base(r[1])[5]]
        models[lang] = kneser_ney(good)
    checked = 0
    for doc_id, text, lang, _ in rows[:40] + rows[-5:]:
        data = (text or "").encode()
        if not data:
            assert None in got[doc_id]
            continue
        folded = b"  " + bytes(quality._FOLD[list(data)])
        logs = [math.log(models[lang](folded[i : i + 2], folded[i + 2])) for i in range(len(data))]
        assert any(p is not None and abs(math.log(p) + sum(logs) / len(logs)) < 1e-9 for p in got[doc_id])
        checked += 1
    assert checked > 20
    assert abs(sum(models["en"](b"w1", b) for b in range(256)) - 1) < 1e-9


def test_language_sets_give_the_same(spark, monkeypatch):
    rows = documents()
    whole = sorted(map(repr, quality.rules(frame(spark, rows)).collect()))
    monkeypatch.setattr(quality, "MODEL_ENTRIES", 1)
    assert sorted(map(repr, quality.rules(frame(spark, rows)).collect())) == whole


def test_bands_reject_foreign_text_and_keep_the_rest(spark):
    rng = np.random.default_rng(1)
    junk = " ".join("".join(chr(c) for c in rng.integers(0x2500, 0x9000, 8)) for _ in range(60))
    rows = [r for r in documents() if r[2] == "en"] + [(30_000, junk, "en", "a")]
    docs = frame(spark, rows)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    # Text of foreign bytes lies above the band, a word of 200 000 letters that repeats itself below it.
    want = sorted((r[0] for r in rows if not base(r[1])[5] and r[0] != 30_000 and not (r[1] or "").startswith("longlong")), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want


def test_empty_table(spark):
    assert quality.rules(empty(spark)).count() == 0
    assert quality.keep(empty(spark)).count() == 0


def fifth(texts):
    """Probability of a byte after four others, straight from the definition."""
    levels = [Counter()]
    for t in texts:
        data = b"    " + bytes(quality._FOLD[list(t)])
        levels[0].update(data[i : i + 5] for i in range(len(data) - 4))
    for _ in range(4):
        levels.append(Counter(k[1:] for k in levels[-1]))

    def model(counts, lower):
        d = quality.discounts(np.array(list(counts.values())))
        own = defaultdict(dict)
        for k, c in counts.items():
            own[k[:-1]][k[-1]] = c

        def p(context, byte):
            seen = own.get(context)
            if not seen:
                return lower(context[1:], byte)
            total = sum(seen.values())
            c = seen.get(byte, 0)
            rest = sum(d[min(x, 3)] for x in seen.values()) / total
            return (c - d[min(c, 3)] if c else 0) / total + rest * lower(context[1:], byte)

        return p

    found = lambda _, __: 1 / 256
    for counts in reversed(levels):
        found = model(counts, found)
    return found


def test_order_five_is_kneser_ney_of_the_other_folds(spark):
    rows = [r for r in documents() if r[2] in ("en", "de") and len(r[1] or "") < 2000]
    got = {}
    for r in quality.rules(frame(spark, rows), order=5, folds=3).collect():
        got.setdefault(r.doc_id, []).append(r.perplexity)
    fold = {text: zlib.crc32(text.encode()) % 3 for _, text, _, _ in rows if text}
    models = {
        (lang, f): fifth([r[1].encode() for r in rows if r[2] == lang and not base(r[1])[5] and fold[r[1]] != f])
        for lang in ("en", "de") for f in range(3)
    }
    checked = 0
    for doc_id, text, lang, _ in rows[::4]:
        if not text:
            continue
        folded = b"    " + bytes(quality._FOLD[list(text.encode())])
        p = models[lang, fold[text]]
        logs = [math.log(p(folded[i : i + 4], folded[i + 4])) for i in range(len(folded) - 4)]
        assert any(x is not None and abs(math.log(x) + sum(logs) / len(logs)) < 1e-9 for x in got[doc_id])
        checked += 1
    assert checked > 15


def test_a_language_in_several_parts_gives_the_same(spark, monkeypatch):
    rows = [r for r in documents() if len(r[1] or "") < 2000]
    docs = frame(spark, rows)
    whole = sorted(map(repr, ((r.doc_id, r.base_failed, r.kept, r.perplexity and round(r.perplexity, 9)) for r in quality.rules(docs, order=5).collect())))
    model = quality.fit(docs, order=5)
    size = {r.key: r.entries for r in model.collect()}
    assert len(size) == model.count()
    monkeypatch.setattr(quality, "BLOCK_ENTRIES", 1500)
    monkeypatch.setattr(quality, "MODEL_ENTRIES", max(size.values()) // 2)
    parts = quality._parts(quality.fit(docs, order=5))
    assert max(Counter(key for p in parts for key in p.span).values()) > 1
    split = sorted(map(repr, ((r.doc_id, r.base_failed, r.kept, r.perplexity and round(r.perplexity, 9)) for r in quality.rules(docs, order=5).collect())))
    assert split == whole


def test_query_tells_what_trigrams_do_not(spark, tmp_path):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 8)) for _ in range(150)]
    texts = [" ".join(rng.choice(words, 150)) for _ in range(120)]
    after = defaultdict(list)
    for t in texts:
        for i in range(len(t) - 2):
            after[t[i : i + 2]].append(t[i + 2])
    walk = texts[0][:2]
    while len(walk) < 4000 or len(walk.split()) < 200:
        walk += rng.choice(after[walk[-2:]])  # every trigram is one of the texts, as often as there
    foreign = " ".join("".join(chr(c) for c in rng.integers(0x2500, 0x9000, 8)) for _ in range(60))
    rows = [(i, t, "en") for i, t in enumerate([*texts, walk, foreign])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    lost = [r.doc_id for r in quality.op10_quality(spark, str(tmp_path)).collect() if not r.kept]
    assert sorted(lost) == [120, 121]
    # A model of order five that has counted the texts it judges finds unique bytes cheap.
    by_heart = {r.doc_id: r.kept for r in quality.rules(docs, order=5, high=quality.HELD_OUT_HIGH).collect()}
    assert by_heart[121]


def test_one_part_of_the_model_is_out_at_a_time(spark, monkeypatch):
    docs = frame(spark, [r for r in documents() if r[2] in ("en", "de") and len(r[1] or "") < 2000])
    model = quality.fit(docs, order=5, folds=2)
    size = Counter()
    for r in model.collect():
        size[r.key] += r.entries
    out, most, sent = set(), 0, 0
    context = spark.sparkContext
    send, destroy = type(context).broadcast, Broadcast.destroy

    def counted_send(self, value):
        nonlocal most, sent
        shared = send(self, value)
        if value:
            out.add(id(shared))
            sent += 1
            most = max(most, len(out))
        return shared

    def counted_destroy(self, *args):
        out.discard(id(self))
        return destroy(self, *args)

    monkeypatch.setattr(type(context), "broadcast", counted_send)
    monkeypatch.setattr(Broadcast, "destroy", counted_destroy)
    # Parts of one key each, then keys in several parts.
    for entries, blocks in ((max(size.values()), quality.BLOCK_ENTRIES), (max(size.values()) // 2, 1500)):
        monkeypatch.setattr(quality, "MODEL_ENTRIES", entries)
        monkeypatch.setattr(quality, "BLOCK_ENTRIES", blocks)
        most = sent = 0
        assert quality.rules(docs, order=5, folds=2).count() == docs.count()
        assert sent > 1 and most == 1 and not out


def test_keys_that_fit_in_a_part_are_not_split(spark, monkeypatch):
    rows = [(key, first, 4) for key in ("a", "b", "c") for first in (0, 10, 20)] + [("d", first, 4) for first in range(8)]
    model = spark.createDataFrame(rows, "key string, first int, entries long")
    monkeypatch.setattr(quality, "MODEL_ENTRIES", 16)
    parts = quality._parts(model)
    times = Counter(key for part in parts for key in part.span)
    assert [times[key] for key in "abc"] == [1, 1, 1] and times["d"] > 1
    assert all(part.span[key] == (0, quality.PAIRS) for part in parts for key in part.span if key != "d")
    ends = [part.span["d"] for part in parts if "d" in part.span]
    assert ends[0][0] == 0 and ends[-1][1] == quality.PAIRS and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_parts_are_fetched_in_pieces(spark, monkeypatch):
    model = quality.fit(frame(spark, [r for r in documents() if r[2] == "en" and len(r[1] or "") < 2000]), order=5, folds=2)
    (part,) = quality._parts(model)
    want = {r.key: quality._joined(0, quality.PAIRS, [r.tables]) for r in model.collect()}

    def whole(self):
        raise AssertionError("a part came to the driver at once")

    monkeypatch.setattr(type(model), "collect", whole)
    got = part.load(model)
    assert got.keys() == want.keys() and len(got) == 2
    for key, one in got.items():
        for a, b in zip(one.orders, want[key].orders, strict=True):
            assert all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))
