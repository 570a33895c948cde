import html
import random
import re
import time

import numpy as np
import pytest

from tributary.llm import language
from tributary.llm.common import table
from tributary.llm.language import Fusion, TextModel

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(table(spark, SF, "documents"))


def test_labelled_texts_of_other_rows(spark, model):
    docs = table(spark, "/root/testdata/sf0.1", "documents").where("doc_id >= 1000 and length(text) > 100")
    found = language.identify(docs, model, "doc_id", "text", "source", markup=False)
    labels = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = found.collect()
    assert len(rows) == len(labels)
    assert sum(r["lang"] == labels[r["id"]] for r in rows) / len(rows) > 0.99


def test_counts_are_those_of_all_texts(spark, model):
    docs = table(spark, SF, "documents").collect()
    for k, lang in enumerate(model.languages):
        n = np.zeros(language.BUCKETS)
        for row in docs:
            if row["lang"] == lang:
                buckets, spans = language.trigrams([row["text"]])
                n += np.bincount(buckets[: max(spans[0, 1], 0)], minlength=language.BUCKETS)
        p = (n + 0.5) / (n + 0.5).sum()
        assert model.likelihood[k] == pytest.approx(np.log(p), abs=1e-4)


def test_a_text_is_scored_alike_alone_and_among_others(model):
    texts = ["the cat", "", "el perro y los gatos", "x", "  ", "über die Brücke"]
    buckets, spans = language.trigrams(texts)
    for text, (start, end) in zip(texts, spans, strict=True):
        alone, (own,) = language.trigrams([text])
        assert buckets[start : max(start, end)].tolist() == alone[own[0] : max(own[1], 0)].tolist()


def test_pages(spark, model):
    pages = table(spark, SF, "pages")
    rows = language.identify(pages, model, "page_id", "html", "url", markup=True).collect()
    assert len(rows) == pages.count()
    assert sum(r["lang"] == r["declared"] for r in rows) / len(rows) > 0.95
    assert all(0 < r["probability"] <= 1 + 1e-9 for r in rows)


def fused(rows, n, rule):
    """The posterior of each record by Bayes' rule, record by record."""
    out = []
    p = np.array([r["p"] for r in rows])
    everyone = (p.sum(0) + 1 / n) / (len(rows) + 1)
    for i, r in enumerate(rows):
        prior = everyone
        for level, weight in (("domain", rule.domain_weight), ("host", rule.host_weight)):
            if r[level] is not None:
                others = [j for j, s in enumerate(rows) if j != i and s[level] == r[level]]
                prior = (p[others].sum(0) + weight * prior) / (len(others) + weight)
        post = (p[i] + 1e-12) * prior
        for kind in ("declared", "suffix"):
            if r[kind] is not None:
                known = [j for j, s in enumerate(rows) if s[kind] is not None]
                alike = [j for j in known if rows[j][kind] == r[kind]]
                values = len({rows[j][kind] for j in known})
                post = post * (p[alike].sum(0) + rule.smoothing) / (p[known].sum(0) + values * rule.smoothing)
        out.append(post / post.sum())
    return out


def test_evidence_is_put_together_by_bayes(spark):
    rng, rule, names = np.random.default_rng(1), Fusion(), ("de", "en", "fr")
    rows = []
    for i in range(60):
        host, domain, suffix = [("a.x.de", "x.de", "de"), ("b.x.de", "x.de", "de"), ("c.com", "c.com", "com"), ("lone", None, None), (None, None, None)][i % 5]
        declared = [None, "de", "en", "fr"][rng.integers(4)]
        rows.append({"id": i, "host": host, "domain": domain, "suffix": suffix, "declared": declared, "n_trigrams": 9, "p": rng.dirichlet([0.4] * 3).tolist()})
    scored = spark.createDataFrame([tuple(r.values()) for r in rows], language.SCORED)
    got = {r["id"]: r for r in language.fuse(scored, names, rule).collect()}
    for i, post in enumerate(fused(rows, 3, rule)):
        assert got[i]["probability"] == pytest.approx(post.max())
        assert got[i]["lang"] == names[int(post.argmax())]


def test_hosts_speak_where_texts_do_not(spark, model):
    english, german = "the other one is of that and to the in it for are", "der die das nicht und ist mit den von auf"
    rows = [(i, f"http://h.de/{i}", f"<html><p>{german}") for i in range(30)] + [(i + 50, f"http://h.com/{i}", english) for i in range(30)]
    rows += [(100, "http://h.de/x", "<p>"), (101, "http://h.com/x", None), (102, None, ""), (103, "http://[bad", "1 2 3")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["id"]: r for r in language.identify(pages, model, "page_id", "html", "url", markup=True).collect()}
    assert (got[100]["lang"], got[101]["lang"]) == ("de", "en")
    assert got[100]["text_lang"] is None and got[102]["lang"] in model.languages
    assert len(got) == len(rows)


def test_what_a_page_declares():
    for html, lang in (('<html lang="de-AT">', "de"), ("<HTML class=x LANG=fr>", "fr"), ("<html xml:lang='es'>", "es"), ("<html data-lang='de'>", None), ("<p lang='de'>", None)):
        found = language.DECLARED.search(html)
        assert (found and found[1].lower()) == lang
    assert language.plain("<script>a</script>b<!-- c -->d<p x='y'>&eacute;").split() == ["b", "d", "é"]
    assert language.address("https://A.b.co.uk:8080/x") == ("a.b.co.uk", "co.uk", "uk")
    assert language.address("src1") == ("src1", None, None) and language.address("") == (None, None, None)


def test_rows_that_are_odd(spark):
    labelled = spark.createDataFrame([("the cat", "en", 1), (None, "de", 1), ("x", None, 2), ("", "en", 3)], "text string, lang string, bucket int")
    assert language.fit(labelled).languages == ("en",)
    nothing = language.fit(labelled.limit(0))
    assert nothing.languages == ("und",) and isinstance(nothing, TextModel)
    docs = spark.createDataFrame([(1, "a", "s", 3), (1, "a", "s", 3), (None, None, None, None)], "doc_id long, text string, source string, host long")
    got = language.identify(docs, nothing, "doc_id", "text", "source", markup=False)
    assert [r["lang"] for r in got.collect()] == ["und"] * 3
    assert language.identify(docs.limit(0), nothing, "doc_id", "text", "source", markup=False).count() == 0


SLOW = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.IGNORECASE | re.DOTALL)


def test_markup_is_left_out_as_one_pattern_would():
    rng = random.Random(1)
    pieces = ["<", ">", "<!--", "-->", "<script", "</script", "</SCRIPT >", "<style>", "</style\n>", "a", " ", "</p>", "<scripted>", "--", "!", "/", "<p x='"]
    for _ in range(3000):
        markup = "".join(rng.choices(pieces, k=rng.randrange(12)))
        assert language.plain(markup) == html.unescape(SLOW.sub(" ", markup)), markup


def test_hostile_pages_take_time_in_proportion():
    for piece in ("<!--", "<script ", "<html ", "<style>", "</script", "<html lang = ", "<", "lang=\t", "<html lang" + " " * 50):
        markup = "<html " + piece * (10_000_000 // len(piece))
        start = time.perf_counter()
        language.plain(markup)
        language.declared_language(markup)
        assert time.perf_counter() - start < 15, piece


def test_more_labels_than_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    rows = [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("xyz", "junk1"), ("xyz", "junk2")]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ("de", "en")
