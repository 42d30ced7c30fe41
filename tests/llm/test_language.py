import html
import math
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest

from dispatchboard.llm import language, queries
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.cases import from_table


def test_query_agrees_with_the_markup(spark):
    pages = {r["page_id"]: r for r in from_table(spark, SF_ORACLE, "pages").collect()}
    rows = queries.op7_language(spark, SF_ORACLE).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    said = {p: re.search(r'<html[^>]*lang="(\w+)', r["html"] or "") for p, r in pages.items()}
    known = [r for r in rows if said[r["page_id"]]]
    assert sum(r["lang"] == said[r["page_id"]].group(1) for r in known) >= 0.95 * len(known)
    assert all(0 < r["confidence"] <= 1 for r in rows)


def plain(pages, model):
    """The fusion rule page by page."""
    langs, m = model.languages, language.SMOOTHING
    seen = []
    for page_id, url, page in pages:
        text = model.likelihood(language.visible(page or ""))
        e = [math.exp(x - max(text)) for x in text]
        belief = [x / sum(e) for x in e] if text.any() else [0.0] * len(langs)
        seen.append((page_id, language.address(url), language.declared(page or ""), text, belief))
    heard = defaultdict(lambda: [0.0] * len(langs))
    for _, _, said, _, belief in seen:
        kind = said if said in langs else "*" if said else ""
        heard[kind] = [a + b for a, b in zip(heard[kind], belief)]
    out = {}
    for k, (page_id, (host, domain, suffix), said, text, _) in enumerate(seen):
        share = [1 / len(langs)] * len(langs)
        for level in (lambda a: True, lambda a: a[2] == suffix, lambda a: a[1] == domain, lambda a: a[0] == host):
            sums = [sum(s[4][i] for j, s in enumerate(seen) if j != k and level(s[1])) for i in range(len(langs))]
            share = [(x + m * p) / (sum(sums) + m) for x, p in zip(sums, share)]
        kind = said if said in langs else "*" if said else ""
        odds = []
        for i, lang in enumerate(langs):
            column = {q: heard[q][i] + (language.HONEST if q == lang else language.OTHERWISE)
                      for q in [*langs, "*", ""]}
            odds.append(math.log(share[i]) + text[i] + math.log(column[kind] / sum(column.values())))
        e = [math.exp(x - max(odds)) for x in odds]
        best = int(np.argmax(odds))
        out[page_id] = (langs[best], e[best] / sum(e))
    return out


def test_fusion_against_brute_force(spark):
    model = language.train(from_table(spark, SF_SMALL))
    pages = from_table(spark, SF_SMALL, "pages")
    short = [(9000 + i, f"https://h{i % 3}.example.{'fr' if i % 2 else 'de'}/x",
              [None, "", "<html lang=xx>la", "<html lang='FR-ca'><p>the of", "<p>&eacute;t&eacute;"][i % 5])
             for i in range(30)]
    frame = pages.select("page_id", "url", "html").union(
        spark.createDataFrame(short, "page_id long, url string, html string"))
    want = plain([tuple(r) for r in frame.collect()], model)
    got = {r["page_id"]: (r["lang"], r["confidence"]) for r in
           language.fused(frame, from_table(spark, SF_SMALL), model).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(got[k][1] == pytest.approx(want[k][1]) for k in want)


def test_a_host_decides_for_a_page_without_words(spark):
    docs = from_table(spark, SF_SMALL)
    texts = [r["text"] for r in docs.where("lang = 'fr'").limit(20).collect()]
    frame = spark.createDataFrame([(i, "http://a.b.org/x", f"<p>{t}</p>") for i, t in enumerate(texts)]
                                  + [(99, "http://A.b.org", "<p>1</p>")], "page_id long, url string, html string")
    row = language.fused(frame, docs).where("page_id = 99").first()
    assert row["lang"] == "fr"


def test_cases(spark):
    docs = from_table(spark, SF_SMALL)
    data = [(1, None, None), (1, None, None), (None, "http://[bad", "<html lang=de>"), (2, "", ""),
            (3, "http://x.de", "<!-- <html lang=fr> --> <script>x</script>" + "<p>wort " * 20000)]
    frame = spark.createDataFrame([(*r, "x", "x") for r in data],
                                  "page_id long, url string, html string, host string, text string")
    rows = language.fused(frame, docs).collect()
    assert sorted(map(repr, (r["page_id"] for r in rows))) == sorted(repr(r[0]) for r in data)
    assert all(r["lang"] for r in rows) and {r["host"] for r in rows} == {"", "x.de"}
    assert language.fused(frame.where("false"), docs).collect() == []
    none = language.fused(frame, docs.where("false")).collect()
    assert len(none) == len(data) and {r["lang"] for r in none} == {None}


@pytest.mark.parametrize("opening", ["<!--", "<script ", "<", "<html ", "<style", "<html lang= ", "</script "])
def test_long_broken_pages_are_read_in_one_pass(opening):
    page = opening * (2_000_000 // len(opening))
    began = time.monotonic()
    language.visible(page)
    assert language.declared(page) is None
    assert time.monotonic() - began < 2


def test_closed_tags_are_hidden_as_by_the_plain_patterns():
    hidden = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>", re.S | re.I)
    rng = random.Random(3)
    parts = ["<!--", "-->", "<script ", "</script >", "<style>", "</STYLE>", "<html ", "lang=", "'en-US'", " ", ">",
             "<", "x", "&amp;", "</script", "<!-->"]
    for _ in range(5000):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert language.visible(page) == html.unescape(re.sub(r"<[^>]*>", " ", hidden.sub(" ", page)))


@pytest.mark.parametrize("page, lang", [
    ('<html lang="english">', "english"), ("<HTML class=a LANG = 'de-AT'>", "de"), ("<html lang=pt_BR>", "pt"),
    ("<html><html lang=fr>", "fr"), ('<html a="b" lang="">', None), ("<html lang=es", "es"), ("<p lang=en>", None)])
def test_whole_primary_subtag_is_read(page, lang):
    assert language.declared(page) == lang
