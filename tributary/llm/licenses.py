"""Licences a text names: identifier tags with licence expressions, and phrases of notices.

One Aho-Corasick automaton over the words of a text finds the phrases, another
over its lower-cased characters finds the tags. The expression after a tag is
parsed by the shunting-yard method (``with`` binds before ``and`` before ``or``) and evaluated:
who takes it meets the obligations of all that ``and`` joins and of the least that ``or`` leaves to choose, and an
exception after ``with`` may lower those of the licence before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import ASCII_LOWER, WORD_BYTES, mapped

# The phrases of the contract and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Phrases of notices and the licence each speaks of.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "licensed under cc by": "cc-by",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nc": "cc-by-nc",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc0 1 0 universal": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "isc license": "isc",
    "boost software license": "bsl",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "all rights reserved": "proprietary",
    "gnu free documentation license": "gfdl",
    "server side public license": "sspl",
    "business source license": "busl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "artistic license": "artistic",
    "academic free license": "afl",
    "sil open font license": "ofl",
    "open database license": "odbl",
    "python software foundation license": "psf",
    "postgresql license": "postgresql",
    "zlib license": "zlib",
    "expat license": "mit",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
}

# Tags that a licence expression follows.
TAGS = ("spdx-license-identifier:", "license-identifier:", "license-expression:")

# Families of the identifiers, by prefix; the longest prefix counts.
FAMILIES = {
    "mit": "mit", "apache-": "apache", "gpl-": "gpl", "lgpl-": "lgpl", "agpl-": "agpl", "bsd-": "bsd", "0bsd": "bsd",
    "mpl-": "mpl", "epl-": "epl", "isc": "isc", "cc0-": "cc0", "cc-by-": "cc-by", "cc-by-sa-": "cc-by-sa",
    "cc-by-nc-": "cc-by-nc", "unlicense": "unlicense", "bsl-": "bsl", "zlib": "zlib", "wtfpl": "wtfpl",
    "licenseref-": "proprietary", "gfdl-": "gfdl", "sspl-": "sspl", "busl-": "busl", "cddl-": "cddl", "eupl-": "eupl",
    "artistic-": "artistic", "afl-": "afl", "ofl-": "ofl", "odbl-": "odbl", "psf-": "psf", "python-2": "psf", "postgresql": "postgresql",
}

# What a licence asks for, the least first; a licence that is not known may ask for anything.
OBLIGATIONS = ("none", "notice", "file copyleft", "copyleft", "network copyleft", "no commerce", "unknown")
# The obligations of each family.
ASKS = {
    "cc0": 0, "unlicense": 0, "wtfpl": 0, "mit": 1, "apache": 1, "bsd": 1, "isc": 1, "zlib": 1, "bsl": 1, "cc-by": 1, "psf": 1, "postgresql": 1,
    "afl": 1, "ofl": 1, "artistic": 2, "lgpl": 2, "mpl": 2, "epl": 2, "cddl": 2, "eupl": 3, "gpl": 3, "gfdl": 3, "odbl": 3, "cc-by-sa": 3,
    "agpl": 4, "sspl": 4, "cc-by-nc": 5, "busl": 5, "proprietary": 6,
}
# Exceptions, by prefix, that let a copyleft work be linked or distributed with others.
LINKING = ("classpath-exception", "gcc-exception", "llvm-exception", "linux-syscall-note", "font-exception", "autoconf-exception", "bison-exception", "openssl-exception", "universal-foss-exception")
POWER = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")


def family(identifier: str) -> str | None:
    known = [prefix for prefix in FAMILIES if identifier.startswith(prefix)]
    return FAMILIES[max(known, key=len)] if known else None


def postfix(tokens: list[str]) -> list[str]:
    """The tokens in postfix order; ``ValueError`` if they are no expression."""
    out: list[str] = []
    pending: list[str] = []
    operand_next = True
    for token in tokens:
        if token == "(":
            if not operand_next:
                raise ValueError("an operator is missing")
            pending.append(token)
        elif token == ")" or token in POWER:
            if operand_next:
                raise ValueError("an identifier is missing")
            least = 0 if token == ")" else POWER[token]
            while pending and pending[-1] != "(" and POWER[pending[-1]] >= least:
                out.append(pending.pop())
            if token == ")":
                if not pending:
                    raise ValueError("a bracket is missing")
                pending.pop()
            else:
                pending.append(token)
                operand_next = True
        else:
            if not operand_next:
                raise ValueError("an operator is missing")
            out.append(token)
            operand_next = False
    if operand_next or "(" in pending:
        raise ValueError("the expression is not complete")
    return out + pending[::-1]


@dataclass(frozen=True)
class Terms:
    """The families and exceptions that an expression names, and what it asks for."""

    families: frozenset[str] = frozenset()
    exceptions: frozenset[str] = frozenset()
    asks: int = len(OBLIGATIONS) - 1


def evaluated(expression: list[str]) -> Terms:
    """``and`` asks for what either side does, ``or`` for the lesser of both, ``with`` for less if its exception is for linking."""
    stack: list[Terms] = []
    for token in postfix(expression):
        if token not in POWER:
            name = family(token)
            stack.append(Terms(frozenset({name} if name else ()), frozenset({token}), ASKS.get(name, len(OBLIGATIONS) - 1)))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            eased = any(each.startswith(LINKING) for each in right.exceptions)
            asks = min(left.asks, OBLIGATIONS.index("file copyleft")) if eased and left.asks <= OBLIGATIONS.index("copyleft") else left.asks
            stack.append(Terms(left.families, frozenset(f"with {each}" for each in right.exceptions), asks))
        else:
            named = frozenset(each for side in (left, right) for each in side.exceptions if each.startswith("with "))
            stack.append(Terms(left.families | right.families, named, (max if token == "and" else min)(left.asks, right.asks)))
    end = stack.pop()
    return Terms(end.families, frozenset(each.removeprefix("with ") for each in end.exceptions if each.startswith("with ")), end.asks)


def longest_expression(tokens: Iterable[str]) -> list[str]:
    """The most of the first tokens that are an expression."""
    taken: list[str] = []
    whole = depth = 0
    operand_next = True
    for token in tokens:
        starts_operand = token == "(" or token != ")" and token not in POWER
        if starts_operand != operand_next or token == ")" and not depth:
            break
        depth += (token == "(") - (token == ")")
        operand_next = token == "(" or token in POWER
        taken.append(token)
        if not operand_next and not depth:
            whole = len(taken)
    return taken[:whole]


def tagged(line: str) -> Terms | None:
    """The terms of the longest expression at the start of a line; none if it starts with none."""
    expression = longest_expression(match[0] for match in TOKEN.finditer(line))
    return evaluated(expression) if expression else None


@cache
def _phrases() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for phrase, label in (NOTICES | BASE_PHRASES).items():
        automaton.add_word(f" {phrase} ", (phrase, label))
    automaton.make_automaton()
    return automaton


@cache
def _tags() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for tag in TAGS:
        automaton.add_word(tag, tag)
    automaton.make_automaton()
    return automaton


def scan(text: str) -> tuple[int, int, int | None, int | None, str, str, float, str | None, str]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, obligation and exceptions of a text."""
    data = text.encode()
    words = data.translate(WORD_BYTES).split()
    # One character for each byte, so that the automaton sees words only where words are.
    flat = f" {b' '.join(words).decode('latin-1')} "
    starts: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    counted = at = 0
    for end, (phrase, label) in _phrases().iter(flat):
        labels.add(label)
        if phrase in BASE_PHRASES:
            start = end - len(phrase) - 1
            counted += flat.count(" ", at, start)
            at = start
            starts.append(counted)
            base.add(label)
    strength, asks, exceptions = 0.0, -1, set()
    lower = data.translate(ASCII_LOWER).decode()
    for end, _ in _tags().iter(lower):
        stop = lower.find("\n", end)
        terms = tagged(lower[end + 1 : stop if stop >= 0 else len(lower)])
        if terms:
            labels |= terms.families
            exceptions |= terms.exceptions
            asks = max(asks, terms.asks)
        strength = max(strength, 1.0 if terms and terms.families else 0.5)
    if labels:
        strength = max(strength, 0.9 if base else 0.6)
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        strength,
        OBLIGATIONS[asks] if asks >= 0 else None,
        ",".join(sorted(exceptions)),
    )


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, obligation string, exceptions string"
)


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()] + [pa.string()] * 2
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    for batch in batches:
        rows = [scan(scalar.as_py() or "") for scalar in batch.column(1)]
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: places of the base phrases, labels, a score, and what tags say.

    ``obligation`` is what all the tags' expressions together ask for, null without any; ``exceptions`` are those after ``with``.

    The score is 1 for a tag with a licence, 0.9 for a base phrase, 0.6 for another
    notice, 0.5 for a tag that names no known licence, else 0. Null and empty texts
    have no words and no labels; a null id stays null; repeated rows are each
    reported. Labels are sorted and distinct. Other columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return mapped(rows, scan_batches, SCHEMA)
