"""Keys of letters alone, keys behind paths, and the words that look like neither."""

import random

from reelrank.llm import secrets

WORDS = ["Donaudampfschifffahrtsgesellschaft", "internationalization", "counterrevolutionaries",
         "AbstractSingletonProxyFactoryBean", "getElementsByTagNameFromDocument",
         "abcdefghijklmnopqrstuvwxyz", "ACGTACGGTCAATCGGATTCACGATCGA", "x" * 40,
         "anticonstitutionnellement", "electroencefalografistas", "antidisestablishmentarianism",
         "state-of-the-art-natural-language-processing", "12345678901234567890123456789012"]


def _found(spark, texts):
    out = secrets.scan_secrets(spark.createDataFrame(
        [(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    return {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]
                          if secrets.KINDS[s["kind"]] == "random"] for r in out}


def test_letters_alone(spark):
    r = random.Random(5)
    keys = ["".join(r.choice(a) for _ in range(n)) for _, a in secrets.LETTERS
            for n in (32, 40, 64) for _ in range(20)]
    keys = [k for k in keys if not secrets.base_spans(k)]
    found = _found(spark, [f"key {k} end" for k in keys] + [f"a {w} b" for w in WORDS] * 20)
    hit = [i for i in range(len(keys)) if found[i] == [(4, 4 + len(keys[i]))]]
    assert len(hit) > 0.9 * len(keys)
    assert not [i for i in range(len(keys), len(found)) if found[i]]


def test_short_mixed_keys_of_which_some_have_no_digit(spark):
    r = random.Random(8)
    base62 = secrets.ALPHABETS[3][1]
    keys = ["".join(r.choice(base62) for _ in range(20)) for _ in range(400)]
    assert any(k.isalpha() for k in keys)
    found = _found(spark, [f"({k})" for k in keys])
    assert sum(found[i] == [(1, 21)] for i in range(len(keys))) > 0.95 * len(keys)
    assert any(found[i] for i, k in enumerate(keys) if k.isalpha())


def test_keys_behind_paths(spark):
    r = random.Random(6)
    base62 = secrets.ALPHABETS[3][1]
    keys = ["".join(r.choice(base62) for _ in range(24)) for _ in range(60)]
    path = "https://hooks.example.com/services/T0000/B0000/"
    texts = [path + k for k in keys]
    plain = ["https://www.example.com/services/about/the/company/history/2019/page"] * 60
    found = _found(spark, texts + plain)
    assert sum(any(e == len(path) + 24 for _, e in found[i]) for i in range(60)) > 54
    assert not [i for i in range(60, 120) if found[i]]


def test_pieces_against_a_plain_split():
    r = random.Random(7)
    for _ in range(300):
        parts = ["".join(r.choice("abcdefgh0123") for _ in range(r.randint(0, 26)))
                 for _ in range(r.randint(1, 4))]
        token = "/".join(parts)
        got = secrets.judged(10, token)
        if secrets.judge(token) < 1 or "/" not in token:
            assert [(a, b) for a, b, _ in got] == [(10, 10 + len(token))]
            continue
        want, at = [], 10
        for p in parts:
            if len(p) >= secrets.LEAST:
                want.append((at, at + len(p), secrets.judge(p)))
            at += len(p) + 1
        assert got == (want or [(10, 10 + len(token), 1.0)])
