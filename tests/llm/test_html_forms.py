"""Main text of pages in other forms: text that must stay, clutter that must go, on every page."""

import html
import re

import pytest

from eventindex.llm import html_crf
from eventindex.llm.html_blocks import blocks
from tests.llm.conftest import SF

S = "The pump was set to forty bar. It ran for two days."
KEPT = {
    "list of words": ("<ul><li>red pump</li><li>two valves</li><li>oil</li></ul>", ["red pump", "two valves", "oil"]),
    "list of sentences": (f"<ol><li>{S}</li><li>Nobody was hurt.</li></ol>", [S, "Nobody was hurt."]),
    "caption": ("<figure><img src=x><figcaption>The hall at night</figcaption></figure>", ["The hall at night"]),
    "table": ("<table><tr><td>bar</td><td>40</td></tr></table>", ["bar", "40"]),
    "section": (f"<section><h2>Results</h2><p>{S}</p></section>", ["Results", S]),
    "division": (f"<div><h3>More</h3><p>{S}</p><p>{S}</p></div>", ["More", S, S]),
}
GONE = {
    "not displayed": f'<p style="color:red; display: none">{S}</p>',
    "hidden": f"<div hidden><p>{S}</p></div>",
    "hidden from readers": f'<div aria-hidden="true">{S}</div>',
    "hidden words": f"<p><span hidden>{S}</span></p>",
    "named": f'<div class="comments"><p>{S}</p><p>Nice one.</p></div>',
    "named in German": f'<section class="kommentare"><p>{S}</p><p>Nice one.</p></section>',
    "headed": f"<section><h3>Comments</h3><p>{S}</p><p>Nice one.</p></section>",
    "headed in French": f"<div><h4>Commentaires (2)</h4><div><p>Eva, 12.03.2020 10:12</p><p>{S}</p></div></div>",
    "author lines": f"<section><p>Eva 3 hours ago</p><p>{S}</p><p>Reply</p><p>Otto 5 hours ago</p><p>Ah.</p></section>",
    "sayings": f"<section><p>Eva: {S}</p><p>Otto wrote: Nice one.</p></section>",
}


@pytest.fixture(scope="module")
def learnt(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    return html_crf.fit(pages), [r[0] for r in pages.select("html").collect() if r[0]]


def article(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split())
             for p in re.split(r"</?(?:p|h1)>", inside)]
    return [p for p in parts if p]


@pytest.mark.parametrize("form", KEPT)
def test_text_of_other_forms_stays(learnt, form):
    field, pages = learnt
    added, more = KEPT[form]
    for page in pages:
        assert html_crf.main_text(page.replace("</article>", added + "</article>", 1), field) == (
            "\n\n".join(article(page) + more))


@pytest.mark.parametrize("form", GONE)
def test_clutter_of_other_forms_goes(learnt, form):
    field, pages = learnt
    for page in pages:
        for new in (GONE[form] + "</article>", "</article>" + GONE[form]):
            assert html_crf.main_text(page.replace("</article>", new, 1), field) == "\n\n".join(article(page))


def test_hidden_elements_end_where_they_close():
    page = ('<p>a <i hidden>b <i>c</i> d</i> e<p data-x="hidden">f<div style=visibility:hidden>g<p>h</div>i'
            '<p title="display:none">j<p hidden=""><b>k</b><p>l')
    assert [b.text for b in blocks(page)] == ["a e", "f", "i", "j", "l"]
