import itertools
import random

import plain
import pytest

from tributary.llm import licenses
from tributary.llm.common import table

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def base(text):
    w = plain.words(text)
    found = [
        (i, label)
        for phrase, label in BASE.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    places = [i for i, _ in found]
    return len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


ODD = [
    None,
    "",
    "The MIT License. mit license mit License",
    "MIT-license; the Apache  License\nGeneral, Public: License general public license",
    "submit license mit licenses",
    "éMIT license MIT license MİT license",
    "mit " * 5000 + "license",
]


def test_base_phrases(spark):
    texts = ODD + [row["text"] for row in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    for i, text in enumerate(texts):
        row = got[i]
        assert tuple(row)[1:6] == base(text)
        assert set(filter(None, row["base_labels"].split(","))) <= set(filter(None, row["labels"].split(",")))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) >= bool(row["labels"])


@pytest.mark.parametrize(
    "line, names",
    [
        ("MIT", {"mit"}),
        ("Apache-2.0 OR MIT", {"apache", "mit"}),
        ("(GPL-2.0-only WITH Classpath-exception-2.0 OR BSD-3-Clause) AND ISC", {"gpl", "bsd", "isc"}),
        ("LGPL-2.1+ */", {"lgpl"}),
        ("MIT OR", {"mit"}),
        ("(MIT", set()),
        ("", set()),
        ("MIT and more words", {"mit"}),
        ("CC-BY-NC-4.0", {"cc-by-nc"}),
        ("unknown-1.0", set()),
    ],
)
def test_expressions_after_a_tag(line, names):
    labels = licenses.scan(f"// SPDX-License-Identifier: {line}\n other")[5]
    assert set(filter(None, labels.split(","))) == names


def test_postfix_keeps_the_meaning():
    """Against Python's own parser, for all short expressions."""
    for a, b, c in itertools.product(["and", "or"], repeat=3):
        for text in (f"w {a} x {b} y {c} z", f"( w {a} x ) {b} y {c} z", f"w {a} ( x {b} ( y {c} z ) )"):
            for values in itertools.product([False, True], repeat=4):
                given = dict(zip("wxyz", values, strict=True))
                stack = []
                for token in licenses.postfix(text.split()):
                    if token in licenses.POWER:
                        right, left = stack.pop(), stack.pop()
                        stack.append(left and right if token == "and" else left or right)
                    else:
                        stack.append(given[token])
                assert stack == [eval(text, {}, given)]


def test_the_longest_expression_is_taken():
    for tokens in itertools.product(["(", ")", "and", "with", "a"], repeat=5):
        found = []
        for end in range(1, 6):
            try:
                licenses.postfix(list(tokens[:end]))
                found = list(tokens[:end])
            except ValueError:
                pass
        assert licenses.longest_expression(tokens) == found
    assert len(licenses.longest_expression(["a", "or"] * 500 + ["b", "c"])) == 1001


@pytest.mark.parametrize("tokens", ["( a", "a )", "a b", "and a", "a or", "( )", ""])
def test_what_is_no_expression(tokens):
    with pytest.raises(ValueError):
        licenses.postfix(tokens.split())


def test_rows_that_are_odd(spark):
    rows = [(1, "MIT license", 3), (1, "MIT license", 3), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels long")
    got = sorted(((r["doc_id"], r["labels"], r["score"]) for r in licenses.scan_licenses(docs).collect()), key=repr)
    assert got == [(1, "mit", 0.9), (1, "mit", 0.9), (None, "", 0.0)]
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def choices(tree):
    """All the ways to take a tree of and/or: sets of leaves that are to be met together."""
    if isinstance(tree, str):
        return [{tree}]
    left, op, right = tree
    if op == "or":
        return choices(left) + choices(right)
    return [a | b for a in choices(left) for b in choices(right)]


def written(tree):
    return tree if isinstance(tree, str) else f"( {written(tree[0])} {tree[1]} {written(tree[2])} )"


def test_and_joins_obligations_and_or_leaves_a_choice():
    asks = {"mit": 1, "gpl-3.0": 3, "lgpl-2.1": 2, "agpl-3.0": 4, "cc0-1.0": 0, "odd-1": 6, "gpl-2.0 with classpath-exception-2.0": 2, "gpl-2.0 with some-words": 3}
    rng = random.Random(1)

    def grown(depth):
        return rng.choice(sorted(asks)) if not depth or rng.random() < 0.3 else (grown(depth - 1), rng.choice(["and", "or"]), grown(depth - 1))

    for _ in range(500):
        tree = grown(4)
        terms = licenses.evaluated(written(tree).split())
        assert terms.asks == min(max(asks[leaf] for leaf in each) for each in choices(tree)), tree
        leaves = set().union(*choices(tree))
        assert terms.exceptions == {leaf.split(" with ")[1] for leaf in leaves if " with " in leaf}


@pytest.mark.parametrize(
    "text, obligation, exceptions",
    [
        ("SPDX-License-Identifier: GPL-2.0-only OR MIT", "notice", ""),
        ("SPDX-License-Identifier: GPL-2.0-only AND MIT", "copyleft", ""),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "file copyleft", "classpath-exception-2.0"),
        ("SPDX-License-Identifier: AGPL-3.0 WITH Classpath-exception-2.0", "network copyleft", "classpath-exception-2.0"),
        ("SPDX-License-Identifier: MIT\nSPDX-License-Identifier: AGPL-3.0", "network copyleft", ""),
        ("SPDX-License-Identifier: strange-1.0", "unknown", ""),
        ("SPDX-License-Identifier: (", None, ""),
        ("the MIT license", None, ""),
    ],
)
def test_what_tags_ask_for(text, obligation, exceptions):
    assert licenses.scan(text)[7:] == (obligation, exceptions)
