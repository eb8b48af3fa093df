"""The page tree, the cascade and its quirks, in plain Python."""

from __future__ import annotations

from dirlens.html import pages, people
from dirlens.html.dom import parse
from dirlens.html.people import cascade, next_page, read_directory
from dirlens.plans.fixtures import PAGES


def test_broken_markup_is_read():
    page = parse("<p>a<p>b<li>c<li>d<b>e</p></i><table><tr><td>1<td>2<tr><td>3</table><script>var t='</p>';</script>")
    assert [n.text() for n in page.all("p")][0] == "a"
    assert [len(r.all("td")) for r in page.all("tr")] == [2, 1]
    assert "var" not in page.text()


def test_text_between_strings():
    page = parse("<div>a<b>b</b>&amp;c</div>")
    assert page.text() == "ab&c"
    assert page.text(" ") == "a b &c"


def test_selectors():
    page = parse('<div class="staff-list x"><ul><li id="k" data-a="Abc">1</li></ul></div><li>2</li>')
    assert [n.text() for n in page.select(".staff-list li")] == ["1"]
    assert [n.text() for n in page.select('[class*="staff"], #k')] == ["1", "1"]
    assert len(page.select('[data-a*="ABC" i]')) == 1 and not page.select('[data-a*="ABC"]')
    assert len(page.select("li[data-a^='Ab']")) == 1 and len(page.select("li[data-a]")) == 1
    assert page.one(".none") is None


def test_noise_goes_before_the_next_link_is_looked_for():
    page = parse(PAGES["https://fir.example.org/nav/1"])
    assert next_page(page, "https://fir.example.org/nav/1") == "https://fir.example.org/nav/2"
    cascade(page, "")
    assert next_page(page, "https://fir.example.org/nav/1") is None


def test_links_of_too_few_definitions_are_lost():
    assert read_directory(PAGES["https://fir.example.org/people/lostdefinition"], "")["people"] == []


def test_unreadable_data_is_an_error_not_a_crash():
    found = read_directory(PAGES["https://fir.example.org/people/badjson"], "")
    assert found["people"] == [] and found["error"]


def test_third_cell_with_an_address_is_the_department():
    row = people.tables(parse(PAGES["https://fir.example.org/people/table"]), "")[0]
    assert row["dept"] == "gus.hill@fir.example.org" and row["phone"] == "743-555-0100"


def test_one_generic_card_is_too_few():
    assert read_directory(PAGES["https://fir.example.org/people/onecard"], "")["strategy"] == "mailto"


def test_countries_of_a_menu_are_no_people():
    assert read_directory(PAGES["https://fir.example.org/people/countries"], "")["people"] == []


def test_directory_page_thresholds():
    link, row = '<a href="mailto:a@x.example.org">a</a>', "<tr><td>a</td></tr>"
    assert pages.is_directory(parse(link * 3)) and not pages.is_directory(parse(link * 2))
    assert pages.is_directory(parse(f"<table>{row * 3}<tr><td>{link}</td></tr></table>"))
    assert not pages.is_directory(parse(f"<table>{row * 2}<tr><td>{link}</td></tr></table>"))
    assert pages.is_directory(parse('<i class="Team-Member"></i>' * 3)) and not pages.is_directory(parse('<i class="Team-Member"></i>' * 2))


def test_null_and_empty_pages():
    for html in (None, "", "<"):
        assert read_directory(html, None)["people"] == []
        assert pages.links(html, None) == [] and pages.facts(html)["n_mailto"] == 0
        assert pages.vendor_people(html, None) == [] and people.email_hits(html) == []
        assert pages.sitemap(html) == []
