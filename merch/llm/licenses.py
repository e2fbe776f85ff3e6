"""Licence scan: Aho-Corasick over the word stream, shunting-yard over tagged expressions.

``scan_licenses`` adds, for every row of a table with a text column,

* ``n_words``: words of the lower-cased text (runs of ASCII letters and digits and of all characters above 0x7F);
* ``hits``: every place of a phrase as (label, first word, words), in order;
* ``expression`` and ``obligations``: the licence expressions behind identifier tags in canonical form, and what they ask for;
* ``labels``: base labels, notice labels and expression labels, sorted;
* ``score``: 0 to 1, how sure the scan is that the text carries a licence.

Null and empty texts have no words, no hits, score 0. Repeated rows get the same answer each. Very long texts are scanned
whole; the automaton needs one pass and no backtracking. Other columns pass through; a result column whose name is already
taken replaces it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merch.llm.common import fresh, lower_ascii

#: Phrases of the contract and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notice phrases beyond the base, with how much each says about a licence.
NOTICES = {
    "all rights reserved": ("all-rights-reserved", 0.5),
    "bsd license": ("bsd", 0.9),
    "creative commons": ("creative-commons", 0.8),
    "cc0": ("cc0", 0.8),
    "cc by nc": ("cc-by-nc", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "cc by sa": ("cc-by-sa", 0.9),
    "gnu affero general public license": ("agpl", 0.95),
    "gnu lesser general public license": ("lgpl", 0.95),
    "mozilla public license": ("mpl", 0.95),
    "affero general public license": ("agpl", 0.9),
    "boost software license": ("bsl", 0.95),
    "common development and distribution license": ("cddl", 0.95),
    "creative commons attribution": ("cc-by", 0.9),
    "creative commons zero": ("cc0", 0.9),
    "eclipse public license": ("epl", 0.95),
    "european union public licence": ("eupl", 0.95),
    "isc license": ("isc", 0.9),
    "lesser general public license": ("lgpl", 0.9),
    "library general public license": ("lgpl", 0.9),
    "open database license": ("odbl", 0.95),
    "open software license": ("osl", 0.95),
    "zlib license": ("zlib", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.6),
    "redistribution and use in source and binary forms": ("bsd", 0.6),
    "this is free and unencumbered software": ("unlicense", 0.9),
    "public domain": ("public-domain", 0.5),
    "licensed under": ("notice", 0.3),
    "released under": ("notice", 0.2),
}
TAG = "spdx license identifier"
TAG_TEXT = re.compile(rb"spdx-license-identifier[ \t]*:[ \t]*")
TOKEN = re.compile(rb"[ \t]*(\(|\)|[a-z0-9][a-z0-9.+_-]*)")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: Licence families by the leading tokens of an identifier (up to "-"), with what they ask for.
FAMILIES = {
    "0bsd": "public-domain", "cc0": "public-domain", "unlicense": "public-domain",
    "apache": "permissive", "bsd": "permissive", "bsl": "permissive", "cc-by": "permissive", "isc": "permissive", "mit": "permissive", "zlib": "permissive",
    "cddl": "weak copyleft", "epl": "weak copyleft", "lgpl": "weak copyleft", "mpl": "weak copyleft",
    "cc-by-sa": "share-alike", "odbl": "share-alike",
    "agpl": "copyleft", "eupl": "copyleft", "gpl": "copyleft", "osl": "copyleft",
    "cc-by-nc": "non-commercial", "cc-by-nc-nd": "non-commercial", "cc-by-nc-sa": "non-commercial",
    "cc-by-nd": "no derivatives",
}
#: From mild to strict; an identifier of no family is unknown, and nobody can tell how strict it is.
KINDS = ["public-domain", "permissive", "weak copyleft", "share-alike", "copyleft", "no derivatives", "non-commercial", "unknown"]
STRICTNESS = {kind: i for i, kind in enumerate(KINDS)}

_WORD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def automaton(phrases: dict[str, tuple[str, float]]) -> ahocorasick.Automaton:
    """One automaton over all phrases; a phrase matches whole words only, as both ends are spaces."""
    built = ahocorasick.Automaton()
    for phrase, (label, weight) in phrases.items():
        built.add_word(f" {phrase} ", (label, weight, phrase.count(" ") + 1))
    built.make_automaton()
    return built


def all_phrases(notices: dict[str, tuple[str, float]] = NOTICES) -> dict[str, tuple[str, float]]:
    """The phrases of the contract, the notices (phrase: label, weight) and the tag."""
    base = {phrase: (label, 0.9) for phrase, label in BASE.items()}
    return dict(notices) | base | {TAG: ("#tag", 0.0)}


def to_postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: infix tokens to postfix, or None when the expression is malformed."""
    out: list[str] = []
    waiting: list[str] = []
    operand = True  # an operand may come next
    for token in tokens:
        if token == "(":
            if not operand:
                return None
            waiting.append(token)
        elif token == ")":
            if operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif token in PRECEDENCE:
            if operand:
                return None
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        else:
            if not operand:
                return None
            out.append(token)
            operand = False
    if operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def family(identifier: str) -> str:
    """The longest family whose tokens lead the identifier, else the identifier itself."""
    tokens = identifier.rstrip("+").split("-")
    starts = ("-".join(tokens[:n]) for n in range(len(tokens), 0, -1))
    return next((start for start in starts if start in FAMILIES), identifier.rstrip("+"))


def evaluate(postfix: list[str]) -> tuple[frozenset[str], str, str] | None:
    """Licences named, canonical text, and obligation, one of ``KINDS``.

    ``and`` binds to both sides, so the stricter one counts; ``or`` lets the reader choose, so the milder one counts;
    ``with`` adds an exception to the licence on its left, which must be a single licence.
    """
    stack: list[tuple[frozenset[str], str, str]] = []
    for token in postfix:
        if token not in PRECEDENCE:
            label = family(token)
            stack.append((frozenset([label]), token, FAMILIES.get(label, "unknown")))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            if " " in left[1] or " " in right[1]:
                return None
            stack.append((left[0], f"{left[1]} with {right[1]}", left[2]))
            continue
        kind = (max if token == "and" else min)(left[2], right[2], key=STRICTNESS.get)
        stack.append((left[0] | right[0], f"({left[1]} {token} {right[1]})", kind))
    return stack[0] if len(stack) == 1 else None


def expression_tokens(text: bytes, at: int = 0) -> list[str]:
    """Tokens from ``at`` as far as an expression can reach, the end of the line at most."""
    tokens: list[str] = []
    depth, operand = 0, True
    while found := TOKEN.match(text, at):
        token = found[1].decode()
        if token == "(":
            if not operand:
                break
            depth += 1
        elif token == ")":
            if operand or not depth:
                break
            depth -= 1
        elif token in PRECEDENCE:
            if operand:
                break
            operand = True
        elif operand:
            operand = False
        else:
            break
        tokens.append(token)
        at = found.end()
    while tokens and tokens[-1] in PRECEDENCE:  # "mit or" before prose
        tokens.pop()
    return [t.rstrip(".") if t not in PRECEDENCE and t not in "()" else t for t in tokens]


def scan_text(text: str | None, machine: ahocorasick.Automaton) -> tuple:
    lowered = lower_ascii(text)
    words = lowered.translate(_WORD).split()
    if not words:
        return 0, [], [], None, 0.0
    stream = f" {b' '.join(words).decode('latin-1')} "
    hits, labels, doubt = [], set(), 1.0
    tagged, seen, index = False, 0, 0
    for end, (label, weight, length) in machine.iter(stream):
        index += stream.count(" ", seen, end)  # words that have ended before this blank
        seen = end
        if label == "#tag":
            tagged = True
            continue
        hits.append((label, index - length, length, weight))
    hits.sort(key=lambda h: (h[1], h[2], h[0]))
    obligations, canonical = None, []
    if tagged:
        for tag in TAG_TEXT.finditer(lowered):
            postfix = to_postfix(expression_tokens(lowered, tag.end()))
            value = evaluate(postfix) if postfix else None
            if value:
                labels |= value[0]
                canonical.append(value[1])
                obligations = max(obligations or value[2], value[2], key=STRICTNESS.get)
                doubt *= 0.02
    for weight in {label: weight for label, _, _, weight in hits}.values():
        doubt *= 1 - weight
    labels |= {label for label, *_ in hits}
    return len(words), hits, sorted(labels), ("; ".join(canonical) or None, obligations), 1 - doubt


HITS = "array<struct<label:string,first_word:bigint,words:bigint>>"


def scan_licenses(df: DataFrame, text: str = "text", notices: dict[str, tuple[str, float]] = NOTICES) -> DataFrame:
    """``df`` with n_words, hits, expression, obligations, labels and score of each row's whole text.

    ``notices`` are the phrases looked for beside those of the contract: words in lower case with single blanks, and for each
    its label and how much it says about a licence, from 0 to 1.
    """

    @F.pandas_udf(f"n_words bigint, hits {HITS}, expression string, obligations string, labels array<string>, score double")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = automaton(all_phrases(notices))
        for batch in texts:
            rows = []
            for value in batch:
                n, hits, labels, found, score = scan_text(value, machine)
                expression, obligations = found or (None, None)
                rows.append((n, [{"label": a, "first_word": b, "words": c} for a, b, c, _ in hits], expression, obligations, labels, score))
            yield pd.DataFrame(rows, columns=["n_words", "hits", "expression", "obligations", "labels", "score"])

    rest = [c for c in df.columns if c.lower() not in ("n_words", "hits", "expression", "obligations", "labels", "score")]
    name = fresh(df, "_scan")
    return df.withColumn(name, scan(F.col(text).cast("string"))).select(*[F.col(f"`{c}`") for c in rest], f"{name}.*")
