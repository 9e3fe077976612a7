"""Small tables with the cases every operator has to bear."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " size int, shard string, slot string, kept string, n_words string, node string, target string, __lang string"
)


def sentence(rng, n, words=None):
    words = words or [f"w{i}" for i in range(400)]
    return " ".join(rng.choice(words) for _ in range(n))


def documents(seed=5):
    """(doc_id, text, lang, source): nulls, empty and very long texts, ties, copies, repeated rows."""
    rng = random.Random(seed)
    rows = []

    def add(text, doc_id=-1, lang="en", source=None):
        rows.append((len(rows) if doc_id == -1 else doc_id, text, lang, source or rng.choice(["a", "b", "ä", None, "hot", "hot", "hot"])))

    base = sentence(rng, 120)
    for _ in range(6):
        add(base)
    for k in range(20):
        words = base.split()
        for _ in range(1 + k % 4):
            words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
        add(" ".join(words).upper() if k % 5 == 0 else " ".join(words))
    for text in (None, None, "", " \n\t\r ", "one", "One", "two words", "two\nwords", "three little words", "three little words"):
        add(text)
    add(sentence(rng, 30_000), lang=None)
    add("long" * 50_000 + " " + sentence(rng, 60))
    add(("same line of text here\n" * 60) + sentence(rng, 10), lang="de")
    add("Ünïcödé ñandú 漢字 🙂 " * 20, lang="fr")
    for lang in ("en", "de", None):
        for _ in range(25):
            add(sentence(rng, rng.randrange(50, 200)), lang=lang)
    rows.append((rows[0][0], *rows[0][1:]))  # the same row once more
    rows.append((None, base, "en", "hot"))
    rows.append((None, sentence(rng, 70), None, None))
    rows.append((10_000, sentence(rng, 70), "rare", "only"))
    return rows


def frame(spark, rows):
    """The rows as a table with columns whose names operators use themselves."""
    full = [(i, t, lg, s, len(t or ""), 7, "shard", "slot", "kept", "n_words", "node", "target", "lang") for i, t, lg, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def byte_words(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()
