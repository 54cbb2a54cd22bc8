"""Registered queries of the training-data operators against brute force (whole tables)."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from reelrank.llm import queries, spm

SF_DIR, MORE_DIR = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def read_texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r[0]: r[1] or "" for r in rows}


@pytest.fixture(scope="module")
def texts(spark):
    return read_texts(spark, SF_DIR)


def test_token_ids(spark, texts):
    tokenizer = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    got = {r["doc_id"]: r for r in queries.op3_token_ids(spark, SF_DIR).collect()}
    assert got.keys() == texts.keys()
    start = 0
    for doc_id in sorted(texts):
        ids = tokenizer.encode(texts[doc_id], add_special_tokens=False).ids + [2]
        row = got[doc_id]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_licenses(spark, texts):
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl",
               ("all", "rights", "reserved"): "reserved"}
    found = 0
    for row in queries.op4_licenses(spark, SF_DIR).collect():
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in texts[row["doc_id"]])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        places = [(i, label) for i in range(len(words)) for p, label in phrases.items()
                  if tuple(words[i:i + len(p)]) == p]
        at = [i for i, _ in places]
        assert (row["n_words"], row["n_base"]) == (len(words), len(at))
        assert (row["first_word"], row["last_word"]) == (
            (min(at), max(at)) if at else (None, None))
        base = sorted({label for _, label in places})
        assert row["base_labels"] == ",".join(base)
        assert set(base) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1
        found += len(at)
    assert found


def test_secrets(spark):
    texts = read_texts(spark, MORE_DIR)
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                        r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    total = 0
    for row in queries.op8_secrets(spark, MORE_DIR).collect():
        text, spans = texts[row["doc_id"]], []
        spans += [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text)
                  if len(m[2]) >= 8]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
                  if len(m[0]) >= 16]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text)
                  if len(m[0]) >= 32]
        want = [f"{k}:{s}:{e}" for s, _, k, e in sorted(spans)]
        kinds = [k for _, _, k, _ in spans]
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [
            kinds.count(k) for k in ("assign", "access", "hex")]
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        every = row["spans"].split(",") if row["spans"] else []
        assert [s for s in every if not s.startswith("random")] == want
        total += len(want)
    assert total


def test_sentencepiece(spark, texts):
    path = queries.tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = queries.op10_sentencepiece(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]]
        ids = library.encode(text)
        assert row["n_pieces"] == len(ids)
        assert row["n_bytes"] == sum(library.is_byte(i) for i in ids)
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_sentencepiece_odd_texts():
    path = queries.tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    with open(path, "rb") as f:
        machine = spm.Transducer(f.read())
    rng = np.random.default_rng(5)
    odd = ["", " ", "  a", "a  ", "\n\n x", "你好 \U0001f600 é́ \x00", "a" * 500, " " * 100,
           "hello    world\t\tfoo", "<s> </s> <unk> <0x41>", "▁a▁ b"]
    letters = list("abcdeth onisr  .,éüñ你\n")
    odd += ["".join(rng.choice(letters, rng.integers(1, 60))) for _ in range(500)]
    for text in odd:
        ids = np.frombuffer(machine.encode(text), "<u4").tolist()
        assert ids == library.encode(text)
        if spm.SPACE not in text:
            assert machine.decode(ids) == text


def test_sentencepiece_words_are_made_once():
    """Signs after a word are cut off, and a path tries a part of its neighbours only."""
    path = queries.tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    with open(path, "rb") as f:
        machine = spm.Transducer(f.read())
    words = ["under", "standing", "whole", "Größe", "ciónes"]
    text = " ".join(w + sign for w in words for sign in ["", ".", ",", ";", "!)", "\u201d.", "\u00b2"])
    ids = np.frombuffer(machine.encode(text), "<u4").tolist()
    assert ids == library.encode(text)
    assert sum(w in key for w in words for key in machine.stretches) <= 2 * len(words)
    rng = np.random.default_rng(6)
    units = ["".join(rng.choice(list("aeinorst"), rng.integers(1, 40))) for _ in range(300)]
    tried, settled = [], machine.pairs.make
    for unit in units:
        machine.pairs.clear()
        machine.pairs.make = lambda pair: tried.append(pair) or settled(pair)
        got = machine._path(unit)
        assert [machine.pieces[i] for i in got] == machine._merged(unit)
    assert len(tried) < sum(map(len, units))
