"""Functions on small inputs, against plain restatements of what they mean."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from quillspark.config import Settings, env_bool
from quillspark.functions import html, text, urls, vectors
from quillspark.operators import chunking, topics

PAGE = """<html><body><header><h1>Chrome</h1></header><h1 class="entry-title">The <b>Title</b></h1>
<div class="intro-text section-inner"><p>2026/60 60/2026</p></div><article><h2>Part</h2><p>Some <strong>bold</strong> words &amp; more
<ul><li>one</li><li>two</li></ul><table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table><script>var t="</p>"</script></article></body></html>"""


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_markdown_and_parts_of_a_page(spark):
    md = html.markdown_of(PAGE)
    assert "# The Title" in md and "## Part" in md and "- one" in md and "| A | B |\n\n" not in md and "| A | B |\n| --- | --- |" in md
    assert "Some **bold** words & more" in md and "Chrome" not in md and "var t" not in md and md.endswith("\n") and "\n\n\n" not in md
    assert html.title_of(PAGE) == "The Title" and html.title_of("<p>x</p>") is None
    assert html.article_of(PAGE).startswith("<article>") and html.article_of("plain") == "plain"
    assert one(spark, html.detail_number(F.lit(PAGE))) == "60/2026"
    assert one(spark, html.detail_number(F.lit(PAGE.replace("60/2026", "61/2026")))) is None
    assert html.plain_of("&lt;b&gt;A &amp;amp; B&lt;/b&gt;") == "A & B" and html.plain_of(None) is None
    assert html.clean_of('<p class="x" onclick="y"><a href="/z" rel="q">k</a><img src="s" width="3"></p><nav>n</nav>') == '<p><a href="/z">k</a><img src="s"/></p>'


def test_links_of_a_page(spark):
    page = '<p>see <a href="/p/2024/b">b</a></p><a href="https://translation.example/e">plain</a> <a class="decree-link" href="https://translation.example/f">x</a><a>no</a> https://data.corpus.example/q.pdf <a href="https://data.corpus.example/r.PDF">pdf</a>'
    links = html.links_of(page)
    assert [x[1] for x in links] == ["/p/2024/b", "https://translation.example/e", "https://translation.example/f", "https://data.corpus.example/r.PDF"]
    assert links[0][4] == "see b" and links[1][4] == "plain"
    assert one(spark, html.english_link(html.page_links(F.lit(page)))) == "https://translation.example/f"
    assert one(spark, html.pdf_urls(html.page_links(F.lit(page)), F.lit(page))) == ["https://data.corpus.example/r.PDF", "https://data.corpus.example/q.pdf"]


def test_relations_in_order_of_strength(spark):
    assert [one(spark, text.relation_of(F.lit(c))) for c in ("وعلى القانون", "يعدل", "يعدل و يلغى", "x", None)] == ["REFERENCES", "AMENDS", "REPEALS", "REFERENCES", "REFERENCES"]


def test_urls(spark):
    assert one(spark, urls.slug_of(F.lit("https://corpus.example/p/2024/rd1/?x#y"))) == "rd1" and one(spark, urls.slug_of(F.lit("::bad::"))) is None
    assert tuple(one(spark, urls.pdf_metadata(F.lit("https://d.example/ar/md/mol/2026-007.pdf")))) == ("md", "2026", "mol", "7")
    assert tuple(one(spark, urls.pdf_metadata(F.lit("x.pdf")))) == (None, None, None, None)
    assert one(spark, urls.absolute_url(F.lit("https://a.example/b/"), F.lit("../c"))) == "https://a.example/c"
    assert one(spark, urls.is_gazette_slug(F.lit("og12"))) and not one(spark, urls.is_gazette_slug(F.lit("og12x")))


def test_search_terms(spark):
    assert one(spark, text.any_of_query(F.lit("Which Law of the sea?"))) == "law OR sea" and one(spark, text.any_of_query(F.lit("of the"))) == "of OR the" and one(spark, text.any_of_query(F.lit("?!"))) == "?!"


def test_hash_embedding(spark):
    words = ["Alpha beta alpha", "", None, "x"]
    got = {r.k: r.embedding for r in vectors.hash_embedding(spark.createDataFrame(list(enumerate(words)), "k int, t string"), "k", "t").collect()}
    for k, t in enumerate(words):
        want = [0.0] * 384
        for w in (t or "").lower().split():
            h = hashlib.sha256(w.encode()).digest()
            want[int.from_bytes(h[:4], "big") % 384] += 1 if h[4] % 2 == 0 else -1
        size = math.sqrt(sum(x * x for x in want)) or 1
        assert got[k] == pytest.approx([x / size for x in want])


def test_cosine(spark):
    rows = spark.createDataFrame([([1.0, 0.0], [2.0, 0.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0])], "a array<float>, b array<float>")
    assert [r.c for r in rows.select(vectors.cosine("a", "b").alias("c")).collect()] == [1.0, 0.0, None]
    with pytest.raises(Exception, match="differ in length"):
        spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<double>, b array<double>").select(vectors.cosine("a", "b")).collect()


def _chunks(md, most, overlap):
    """Plain restatement: sections by heading, greedy packing, long ones in windows."""
    word = re.compile(r"\S+")
    sections, heading, lines = [], None, []
    for line in md.split("\n"):
        m = re.match(r"^(#{1,6})\s+(.+)$", line.strip())
        if m:
            sections.append((heading, lines))
            heading, lines = m[2].strip(), [line]
        else:
            lines = [*lines, line]
    sections.append((heading, lines))
    out, held, at = [], "", None

    def windows(t):
        w = word.findall(t)
        if len(w) <= most:
            return [t]
        return [" ".join(w[i : i + most]) for i in range(0, len(w) - overlap, most - overlap)]

    for head, part in sections:
        body = "\n".join(part).strip()
        n = len(word.findall(body))
        if not body:
            continue
        if held and len(word.findall(held)) + n > most:
            out.append((held, at))
            held = ""
        at = head or at
        if n > most:
            out += [(w, at) for w in windows(body)]
        else:
            held = f"{held}\n\n{body}".strip()
    return [*out, (held, at)] if held else out


def test_chunks_against_restatement(spark):
    rnd = random.Random(6)
    texts = ["", "  \n ", "# only", "before\n# A\none two\n# B\n" + "w " * 50, "# A\n# B\n\n# C\nx"]
    for _ in range(60):
        texts.append("\n".join(rnd.choice(["", " # H%d a" % rnd.randint(0, 9), "word " * rnd.randint(0, 9), "## %d" % rnd.randint(0, 9), "x y z"]) for _ in range(rnd.randint(0, 14))))
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "document_id int, language string, content string")
    got = {}
    for r in chunking.chunk(docs, max_tokens=12, overlap=3).orderBy("document_id", "order").collect():
        assert r.id == f"{r.document_id}:en:{r.order:04d}"
        got.setdefault(r.document_id, []).append((r.text, r.heading_path))
    for i, t in enumerate(texts):
        assert got.get(i, []) == _chunks(t, 12, 3), t
    with pytest.raises(ValueError):
        chunking.window_texts("x", 5, 5)


def test_topic_names_and_rules(spark):
    names = ["  banking  AND finance", "3rd non-resident", "oil and gas"]
    assert [one(spark, topics.normalized_name(F.lit(n))) for n in names] == ["Banking and Finance", "3Rd Non-Resident", "Oil and Gas"]
    docs = spark.createDataFrame([("a", "Taxi court", None, None, None, "law"), ("b", "x", "", None, None, "royal_decree"), ("c", None, None, None, None, None)], "id string, title_en string, title_ar string, content_ar string, content_en string, document_type string")
    got = [(r.document_id, r.canonical_name, r.confidence) for r in topics.extract_topics(docs).orderBy("document_id", "seq").collect()]
    assert got == [("a", "Taxation", 0.62), ("a", "Judiciary", 0.62), ("b", "Royal Decree", 0.45)]
    reply = '{"topics":[{"name":"sports"},{"name":""},{"name":"new thing","canonical_name":"New","confidence":0.5,"evidence":"e"}]}'
    own = [(r.document_id, r.canonical_name) for r in topics.extract_topics(docs, lambda t, c: reply if t == "x" else None).orderBy("document_id", "seq").collect()]
    assert own == [("a", "Taxation"), ("a", "Judiciary"), ("b", "Sports"), ("b", "New")]


def test_duplicate_names(spark):
    rows = spark.createDataFrame([("ab", [1.0, 0.0]), ("abc", [1.0, 0.1]), ("ba", [0.99, 0.0]), ("z", [0.0, 1.0]), (None, [1.0, 1.0])], "canonical_name string, embedding array<double>")
    pairs = topics.duplicate_pairs(topics.centroids(rows), 0.9)
    assert sorted((r.canonical, r.duplicate) for r in pairs.collect()) == [("ab", "abc"), ("ab", "ba"), ("ba", "abc")]
    merged = [r.canonical_name for r in topics.apply_merges(rows, pairs).collect()]
    assert sorted(map(str, merged)) == ["None", "ab", "ab", "ba", "z"] or sorted(map(str, merged)) == ["None", "ab", "ab", "ab", "z"]


def test_settings(spark):
    assert env_bool("X", env={"X": " Yes "}) and not env_bool("X", env={"X": "no"}) and env_bool("Y", True, env={"X": "1"})
    spark.conf.set("spark.quillspark.top_k", "7")
    assert Settings.of(spark).top_k == 7
    spark.conf.unset("spark.quillspark.top_k")
