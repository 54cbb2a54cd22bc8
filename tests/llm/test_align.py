"""Cross-tokenizer alignment against brute force."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelrank.llm import align, queries

SF_DIR = "/root/testdata/sf0.001"
A, B = (queries.tokenizer_file(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def byte_letters():
    keep = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    table, extra = {}, 0
    for b in range(256):
        if b in keep:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), byte_letters()


def brute(texts, libraries):
    """Rows of whole texts, encoded at once."""
    a_lib, b_lib, letters = libraries
    out, per_doc = [], []
    for text in texts:
        a_ids, b_ids = [], []
        if text:
            a_ids = a_lib.encode(" " + text, add_special_tokens=False).ids
            b_ids = b_lib.encode(text)
        a_raw = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a_ids]
        b_raw = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()
                 for i, p in zip(b_ids, b_lib.id_to_piece(b_ids))]
        want = (" " + text).encode() if text else b""
        if b"".join(a_raw) != want or b"".join(b_raw) != want:
            a_ids, b_ids, a_raw, b_raw = [], [], [], []
        a_ends = list(itertools.accumulate(map(len, a_raw)))
        b_ends = list(itertools.accumulate(map(len, b_raw)))
        ends = sorted(set(a_ends) & set(b_ends))
        a_group, b_group = [[] for _ in ends], [[] for _ in ends]
        for x, e in zip(a_ids, a_ends):
            a_group[int(np.searchsorted(ends, e))].append(x)
        for x, e in zip(b_ids, b_ends):
            b_group[int(np.searchsorted(ends, e))].append(x)
        links = Counter()
        for x, y in zip(a_group, b_group):
            for i, n in Counter(x).items():
                for j, m in Counter(y).items():
                    links[i, j] += n * m
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y))
                        for x, y in zip(a_group, b_group))
        per_doc.append(links)
        out.append([len(a_ids), len(b_ids), len(ends), sum(links.values()), 0, 0,
                    hashlib.sha256(text.encode()).hexdigest() if text else ""])
    count = Counter(p for links in per_doc for p in links)
    best = {}
    for (i, _), n in count.items():
        best[i] = max(n, best.get(i, 0))
    for row, links in zip(out, per_doc):
        row[4] = sum(n for p, n in links.items() if count[p] == best[p[0]])
        row[5] = sum(n * count[p] for p, n in links.items())
    total = Counter()
    for links in per_doc:
        total.update(links)
    return [tuple(r) for r in out], {p: (n, total[p], n == best[p[0]]) for p, n in count.items()}


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def test_query(spark, libraries):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = [(r[0], *x) for r, x in zip(rows, brute([r[1] for r in rows], libraries)[0])]
    got = [tuple(r) for r in queries.op13_align(spark, SF_DIR).collect()]
    assert sorted(got) == sorted(want)


def odd_texts():
    rng = random.Random(4)
    signs = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", " ", " ",
             "　", "​", "﻿", "a", "Word", "don't", "'s", "12", "3.14", "--", "é",
             "中文字", "🎉", "👩‍👩‍👧", "\x00", "\x7f", "<s>", "</s>", "<unk>", "<0x41>", "_", "ﬁ",
             "<|endoftext|>", "ا", "ไทย", "é", "%%%%", "the", "and"]
    return ["".join(rng.choices(signs, k=rng.randint(1, 14))) for _ in range(600)]


TEXTS = [None, "", " ", "  ", "\n", " lead", "trail ", "a▁b", "▁", "same text", "same text",
         "x" * 5000, "ab" * 3000 + " " + "=" * 3000, "word " * 9000, "\n".join("line" * 400),
         "".join(chr(33 + i * 7 % 90) for i in range(9000)), *odd_texts()]


@pytest.mark.parametrize("small", [False, True])
def test_edges(spark, libraries, monkeypatch, small):
    if small:  # many chunks and windows, all groups weighted
        for name, value in (("POSTINGS", 500), ("WINDOW", 50), ("ENUMERATED", 0)):
            monkeypatch.setattr(align, name, value)
    rows = [(None if i == 3 else i // 2 if i < 20 else i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("id", "chunk", "place", "pair", "count", "best", "__hot")})
    found = align.Alignment(docs, A, B)
    want, pairs = brute([t for _, t in rows], libraries)
    got = [tuple(r) for r in found.documents().collect()]
    assert sorted(got, key=key) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=key)
    counted = {(r[0], r[1]): (r[2], r[3], r[4]) for r in found.pairs().collect()}
    assert counted == pairs
    if small:
        none = align.Alignment(docs.limit(0), A, B)
        assert none.documents().collect() == [] and none.pairs().collect() == []


def test_both_encoders(libraries):
    """The library takes over for files that tiktoken can't stand in for."""
    import json

    with open(A, "rb") as f, open(B, "rb") as g:
        spec, model = json.load(f), g.read()
    fast = align.Aligner(json.dumps(spec).encode(), model)
    spec["pre_tokenizer"]["trim_offsets"] = False
    spec["model"]["merges"] = spec["model"]["merges"][:-1]
    slow = align.Aligner(json.dumps(spec).encode(), model)
    assert "tiktoken" in str(type(fast._encode_a.__self__))
    assert not hasattr(slow._encode_a, "__self__")
    for text in [t for t in TEXTS[1:] if t][-50:]:
        assert fast._encode_a(text) == libraries[0].encode(text, add_special_tokens=False).ids
        assert slow.a_size[slow._encode_a(text)].sum() == len(text.encode())


def test_bitmaps():
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.choice(align.DOCUMENTS, n, replace=False))
            for n in (1, 5, 2047, 2048, 30_000, 3, 2048)]
    number = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    offsets, raw = align._bitmaps(number, np.concatenate(sets))
    back, place = align.unpacked(offsets, raw)
    for i, s in enumerate(sets):
        assert (np.sort(place[back == i]) == s).all()
    assert np.diff(offsets).tolist() == [2, 10, 4094, 4096, 4096, 6, 4096]
