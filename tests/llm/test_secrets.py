"""Known patterns against a character-by-character reading; the tokenizer test on planted strings."""

import hashlib
import random
import re
import string

from roadlens.llm import credentials as secrets
from tests.llm.data import documents, empty, frame

PLANTED = (
    'x password = "abc123" y PASSWD:zzzzzz api_key=short tOkEn: \'aaaaaaa apikey==a ſecret=abcdefgh secret=Ünïcode'
    " AKIA" + "Q" * 16 + " AKIA" + "Q" * 15 + " xAKIAAKIA" + "7" * 20 + " " + "deadbeef" * 3 + "X" + "deadbeef" * 8 + " é🙂 token=" + "f" * 40
)


def known(text):
    found = []
    for kind, pattern, least, group in (
        ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
        ("access", "(AKIA[A-Z0-9]+)", 20, 1),
        ("hex", "([0-9a-f]+)", 24, 1),
    ):
        found.append([(m.start(), kind, m.end()) for m in re.finditer(pattern, text or "") if len(m[group]) >= least])
    order = {"assign": 0, "access": 1, "hex": 2}
    every = sorted((s for f in found for s in f), key=lambda s: (s[0], order[s[1]]))
    return [len(f) for f in found], ",".join(f"{k}:{a}:{b}" for a, k, b in every)


def test_known_patterns(spark):
    rows = documents() + [(60_000, PLANTED, "en", "a"), (60_001, PLANTED * 50, "en", "a")]
    got = sorted(secrets.scan(frame(spark, rows)).collect(), key=repr)
    assert len(got) == len(rows)
    text = {}
    for doc_id, t, *_ in rows:
        text.setdefault(doc_id, []).append(t)
    for r in got:
        options = [known(t) for t in text[r.doc_id]]
        assert ([r.n_assign, r.n_access, r.n_hex], r.base_spans) in options
        assert set(filter(None, r.base_spans.split(","))) <= set(r.spans.split(","))
    assert known(PLANTED)[0] == [6, 2, 3] or sum(known(PLANTED)[0]) > 5
    assert secrets.scan(empty(spark)).count() == 0


def test_random_strings_stand_out(spark):
    rng = random.Random(2)
    letters = string.ascii_letters + string.digits
    hidden = ["".join(rng.choice(letters) for _ in range(rng.choice([24, 32, 40]))) for _ in range(200)]
    plain = [
        hashlib.md5(b"x").hexdigest(), hashlib.sha256(b"x").hexdigest().upper(), "550e8400-e29b-41d4-a716-446655440000",
        "12345678901234567890", "a-long-title-of-some-article-2023", "SomeClassNameWithManyParts", "snake_case_name_of_function",
        "Donaudampfschifffahrtsgesellschaft", "====================", "path/to/some/module/file",
    ]
    rows = [(i, f"say {x}, then", "en", "a") for i, x in enumerate(hidden + plain)]
    got = {r.doc_id: r.spans for r in secrets.scan(frame(spark, rows)).collect()}
    caught = sum(got[i] == f"random:4:{4 + len(x)}" for i, x in enumerate(hidden))
    assert caught >= 190
    assert not any("random" in got[200 + k] for k in range(len(plain)))


def test_letters_alone(spark):
    """Random letters, also as parts of a run, are found; words are not."""
    rng = random.Random(4)
    drawn = ["".join(rng.choice(string.ascii_letters) for _ in range(n)) for n in [16, 20, 32, 40] * 25]
    drawn += ["".join(rng.choice(string.ascii_lowercase) for _ in range(32)) for _ in range(50)]
    drawn += [f"key_{x}" for x in drawn[:50]]
    plain = ["internationalization", "Rechtsschutzversicherung", "a_b_c_d_e_f_g_h_i", "2023-01-02/03-04-05", "HttpRequestHandlerFactory"]
    rows = [(i, f"say {x}, then", "en", "a") for i, x in enumerate(drawn + plain)]
    got = {r.doc_id: r.spans for r in secrets.scan(frame(spark, rows)).collect()}
    assert sum(got[i] == f"random:4:{4 + len(x)}" for i, x in enumerate(drawn)) >= 190
    assert not any("random" in got[len(drawn) + k] for k in range(len(plain)))
