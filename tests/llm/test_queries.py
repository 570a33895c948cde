"""Each registered query against its SQL, and the pipeline against its stages in plain Python."""

import os
import random

import corpus_pipeline
import duckdb
import plain
import pytest
from test_lines import expected as without_blocks
from test_quality import verdicts
from tokenizers import Tokenizer

from tributary.llm import bpe, lines, quality
from tributary.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("CONFORMANCE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{SF_DIR}/{file}')")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, oracle, name):
    expected = oracle.execute(ORACLES[name])
    order = [column[0] for column in expected.description]
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(order)
    want = sorted((tuple(row[order.index(c)] for c in sorted(order)) for row in expected.fetchall()), key=repr)
    assert sorted((tuple(row[c] for c in sorted(order)) for row in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_a_row_for_every_row(spark, name):
    def rows(of):
        return spark.read.parquet(f"{SF_DIR}/{of}.parquet")

    if "op12" in name:
        want = rows("conversations").select("conv_id").distinct().count()
    else:
        want = sum(rows(of).count() for of in (("documents", "pages") if "op8" in name else ("documents",)))
    assert QUERIES[name](spark, SF_DIR).count() == want


def corpus(rng):
    boilerplate, passage = plain.sentence(rng, 7), "\n".join(plain.sentence(rng, 11) for _ in range(5))
    item = plain.sentence(rng, 20)
    texts = []
    for i in range(60):
        text = [plain.sentence(rng, rng.randrange(2, 30)) for _ in range(4)]
        text += [boilerplate] if i % 2 else []
        text += [passage] if i % 7 == 0 else []
        text += [item + " end"] if i % 9 == 0 else []
        texts.append("\n".join(text))
    texts += texts[:5] + [" ".join(texts[8].split()[1:]), texts[10].replace("w1", "q1"), "", None, "few words"]
    # Near copies whose lines differ, so that only their shingles tell.
    texts += [" ".join(t.split()[::1]) + " tail" for t in texts[20:26]]
    return [(i, f"h{i % 2}", t) for i, t in enumerate(texts)], [(1, item), (2, "some other words")]


def test_the_pipeline_does_what_its_stages_say(spark, tmp_path):
    docs, items = corpus(random.Random(1))
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, s, t in docs]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = {i: v[-1] for (i, _), v in verdicts(docs, quality.LineLimits()).items() if v[-2]}
    deduped = without_blocks(sorted(left.items()), lines.Blocks())
    left = {i: t for i, (t, gone) in deduped.items() if not gone or len(plain.parts(t)) >= max(10, len(plain.parts(left[i])) * 0.4)}
    pairs = sorted(left.items())
    groups = [g for _, g in plain.similar_groups(pairs)]
    left = {i: t for (i, t), g in zip(pairs, groups, strict=True) if i == g}
    bad = plain.contamination(sorted(left.items()), items)
    left = {i: t for i, t in left.items() if not bad[i, t][-1]}
    library = Tokenizer.from_file(bpe.public_tokenizers.path(bpe.VOCABULARY))
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in left.items()}

    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"]: (r["n_tokens"], r["decoded_sha256"]) for r in got.collect()} == {i: (n, plain.sha(left[i])) for i, n in want.items()}
    assert 20 < len(want) < len(docs) - 12


def test_stages_keep_the_columns(spark, tmp_path):
    docs, items = corpus(random.Random(2))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, t, "en", s, 1, "k") for i, s, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node string")
    for given in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            given = stage(spark, given, str(tmp_path))
            assert given.columns == df.columns, name
        assert given.count() >= 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


CLASHES = ("lines_removed", "words_removed", "_found_", "_verdict_", "_gone_", "kept", "text_hash", "node", "key")


def test_stages_take_tables_whose_columns_clash(spark, tmp_path):
    docs, items = corpus(random.Random(3))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, t, "en", s, 1, *range(len(CLASHES))) for i, s, t in docs]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{name} int" for name in CLASHES)
    df = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        first = stage(spark, df, str(tmp_path))
        assert first.count() > 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert first.columns == df.columns
            again = stage(spark, first, str(tmp_path))
            assert again.columns == df.columns and again.count() > 0
    twice = lines.dedupe_lines(lines.dedupe_lines(df))
    assert sorted(twice.columns) == sorted(df.columns) and {r["lines_removed"] for r in twice.collect()} == {0}
