import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import plain
from tributary.llm import bpe
from tributary.llm.common import table

PATH = public_tokenizers.path(bpe.VOCABULARY)
ODD = [
    "",
    "a<|endoftext|>b  c\n\n\t x",
    "<|endoftext|>",
    "<|endoftext|",
    "x" * 5000,
    " " * 300 + "x",
    "aaaaaaaa" * 77 + " b",
    "-" * 1000,
    "'ll's''re don't",
    "日本" * 100,
    "　hé 12abc ١½ ​ \n \r\n e",
    "\U0001f44d\U0001f3fd ok\x00\x1c\x85 \xa0z",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_text(rng):
    ranges = [(32, 127), (128, 0x3000), (0x1F000, 0x1FAFF)]
    return "".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(200)))


def test_ids_and_texts_are_those_of_the_library(spark, library):
    rng = random.Random(1)
    texts = ODD + [random_text(rng) for _ in range(200)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = bpe.encode_documents(docs)
    got = {row["doc_id"]: row["ids"] for row in encoded.collect()}
    expected = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert got == {i: e.ids for i, e in enumerate(expected)}
    back = {row["doc_id"]: row["text"] for row in bpe.decode_documents(encoded).collect()}
    assert back == {i: library.decode(e.ids, skip_special_tokens=False) for i, e in enumerate(expected)}


def test_digests_of_a_whole_table(spark, library):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = docs.collect()
    got = {row["doc_id"]: tuple(row)[1:] for row in bpe.round_trip(docs).collect()}
    expected = {}
    for row, encoded in zip(rows, library.encode_batch([r["text"] for r in rows], add_special_tokens=False), strict=True):
        ids = b"".join(i.to_bytes(4, "little") for i in encoded.ids)
        decoded = library.decode(encoded.ids, skip_special_tokens=False)
        expected[row["doc_id"]] = len(encoded.ids), bpe.sha256(ids).hexdigest(), plain.sha(decoded)
    assert got == expected


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 20)
    own, rng = bpe.Encoder(PATH), random.Random(2)
    for _ in range(20):
        texts = [random_text(rng) + " the cat <|endoftext|>" for _ in range(3)]
        expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [bpe.np.frombuffer(ids, "<u4").tolist() for ids in own.encode(texts)] == expected


def test_rows_that_are_odd(spark):
    columns = "doc_id long, text string, n_tokens string, ids string, lang string"
    rows = [(1, "a b", "x", "y", None), (1, "a b", "x", "y", None), (None, None, None, None, None), (2, "", None, None, "")]
    docs = spark.createDataFrame(rows, columns)
    got = sorted((tuple(r) for r in bpe.round_trip(docs).collect()), key=repr)
    assert [(r[0], r[1]) for r in got] == [(1, 2), (1, 2), (2, 0), (None, 0)]
    assert got[-1][2] == got[-1][3] == plain.sha("")
    assert bpe.round_trip(docs.limit(0)).count() == 0
    assert bpe.decode_documents(docs.select("doc_id", bpe.F.lit(None).cast("array<int>").alias("ids"))).first()["text"] is None
