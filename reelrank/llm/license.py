"""License scan: notice phrases and identifier tags by Aho-Corasick, tag expressions by shunting-yard.

A text is lower-cased in A-Z and cut into words; one automaton over the words
joined by single spaces finds every phrase at word boundaries, however many
phrases there are. Where the words of an identifier tag occur, the expression
behind the tag is read from the text, turned into postfix order (WITH binds
tighter than AND, AND than OR) and evaluated: OR lets the licensee choose the
milder side, AND takes the stricter, WITH softens its licence. What follows a
whole expression on its line is a comment.

Of further notices that overlap only the longest counts ("GNU Lesser General
Public License" is no notice of the GPL); base phrases always count and give
their labels, but within a longer notice not their strictness.

Defined results: null text counts as empty (no words, no labels, score 0);
an empty table gives an empty result; every row gives one row, repeated rows
and ids included, and null ids stay null; texts are read whole, however long,
in time linear in them; equal findings are one label; only id and text are
read, so other columns may have any name.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import map_texts, ship, words_of

ship(__name__)

# The phrases whose places are counted, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# More notices; they add labels, not places. Names, then sentences of the licence texts.
MORE_PHRASES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "apache license": "apache",
    "licensed under the apache license": "apache",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "zlib license": "zlib",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noderivs": "cc-by-nd",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0 1 0 universal": "cc0",
    "public domain": "public-domain",
    "free and unencumbered software released into the public domain": "unlicense",
    "without permission": "no-permission",
    "may not be reproduced": "no-permission",
    "no part of this publication may be reproduced": "no-permission",
    "all rights are reserved": "reserved",
    "proprietary and confidential": "reserved",
}
TAG_PHRASES = ("spdx license identifier", "license expression")
TAG_NAMES = ("spdx-license-identifier", "license-expression")
BEHIND_TAG = re.compile(r"[ \t]*:[ \t]*([^\r\n]*)")
TOKEN = re.compile(r"[()/]|[a-z0-9][a-z0-9.+:-]*")
# How much a licence restricts reuse: 0 not at all, 1 entirely.
STRICTNESS = {
    "public-domain": 0.0, "cc0": 0.0, "unlicense": 0.0, "0bsd": 0.0,
    "mit": 0.1, "isc": 0.1, "bsd": 0.1, "bsl": 0.1, "zlib": 0.1, "apache": 0.2, "cc-by": 0.2,
    "mpl": 0.4, "epl": 0.4, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.7, "agpl": 0.8,
    "cc-by-nd": 0.8, "cc-by-nc": 0.9, "no-permission": 0.9, "reserved": 1.0,
}
UNKNOWN = 0.6
SOFTENED = 0.5
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def strictness(licence: str) -> float:
    """Of an identifier: its longest known stem, e.g. gpl for gpl-3.0-only."""
    parts = licence.rstrip("+").split("-")
    for n in range(len(parts), 0, -1):
        if (stem := "-".join(parts[:n])) in STRICTNESS:
            return STRICTNESS[stem]
    return UNKNOWN


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: operands and operators in postfix order; None if malformed.

    A slash between licences is the old way to write OR. An open bracket after
    a whole expression starts a comment.
    """
    out, stack, operand_next = [], [], True
    for token in TOKEN.findall(expression):
        token = "or" if token == "/" else token
        if token == "(":
            if not operand_next:
                if "(" in stack:
                    return None
                break
            stack.append(token)
        elif token == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif token in PRECEDENCE:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        else:
            if not operand_next:
                break  # words after a whole expression are a comment
            out.append(token)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(tokens: list[str]) -> tuple[float, set[str]]:
    """Strictness and licences of a postfix expression."""
    values: list[tuple[float, set[str]]] = []
    for token in tokens:
        if token not in PRECEDENCE:
            values.append((strictness(token), {token}))
            continue
        (right, more), (left, names) = values.pop(), values.pop()
        if token == "with":  # the right side names an exception, not a licence
            values.append((left * SOFTENED, names))
        else:
            values.append(((min if token == "or" else max)(left, right), names | more))
    return values[0]


def automaton(notices: dict[str, str]) -> tuple:
    """Of the phrases at word boundaries, and of the tags as they are written."""
    words, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase in {*BASE_PHRASES, *notices, *TAG_PHRASES}:
        # latin-1 of the UTF-8 bytes, as in the text that is searched
        key = f" {phrase} ".encode().decode("latin-1")
        words.add_word(key, (phrase, len(key)))
    for name in TAG_NAMES:
        tags.add_word(name, name)
    words.make_automaton()
    tags.make_automaton()
    return words, tags


def longest(places: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Of (start, end, phrase): those that no other place contains."""
    out, reach = [], -1
    for start, end, phrase in sorted(places, key=lambda p: (p[0], -p[1])):
        if end > reach:
            out.append((start, end, phrase))
            reach = end
    return out


def scan(text: str, automata: tuple, notices: dict[str, str]) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of a text."""
    phrases, tag_names = automata
    words = words_of(text)
    stream = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts, places, base, labels, score, tagged = [], [], set(), set(), 0.0, False
    for end, (phrase, size) in phrases.iter(stream):
        start = end - size + 1
        if phrase in TAG_PHRASES:
            tagged = True
            continue
        if phrase in BASE_PHRASES:
            starts.append(start)
            base.add(BASE_PHRASES[phrase])
        places.append((start, end, phrase))
    for _, _, phrase in longest(places):
        label = BASE_PHRASES.get(phrase) or notices[phrase]
        labels.add(label)
        score = max(score, strictness(label))
    labels |= base
    if tagged:
        lowered = text.lower()
        for end, _ in tag_names.iter(lowered):
            tag = BEHIND_TAG.match(lowered, end + 1)
            if not tag:
                continue
            order = postfix(tag[1])
            value, names = evaluate(order) if order else (UNKNOWN, {"unreadable"})
            labels |= names
            score = max(score, value)
    first = stream.count(" ", 0, min(starts)) if starts else None
    last = stream.count(" ", 0, max(starts)) if starts else None
    return (len(words), len(starts), first, last, ",".join(sorted(base)),
            ",".join(sorted(labels)), score)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  notices: dict[str, str] = MORE_PHRASES) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Places are counted in words from 0 and cover BASE_PHRASES; ``labels`` adds
    the further ``notices`` (phrase -> label; lower-case words joined by single
    spaces) and the licences of identifier tags; ``score`` is the strictness of
    the strictest finding (0 without any; UNKNOWN for a label without a place
    in STRICTNESS). Null texts are empty; see the module for the other cases.
    """
    for phrase in notices:
        if " ".join(w.decode() for w in words_of(phrase)) != phrase:
            raise ValueError(f"not lower-case words joined by single spaces: {phrase!r}")

    def kernel(texts: list[str]) -> list:
        automata = automaton(notices)
        rows = [scan(t, automata, notices) for t in texts]
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(7)]

    return map_texts(docs, id_col, text_col, kernel,
                     "n_words long, n_base long, first_word long, last_word long, "
                     "base_labels string, labels string, score double").withColumnRenamed(
                         "id", id_col)
