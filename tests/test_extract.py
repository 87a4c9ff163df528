"""Chapter pages: each case states the page and the rows it must give."""

import pytest

from lectern.functions import text as T
from lectern.operators.extract import OMITTED_TEXT, parse_chapter, parse_list_items


def verse(refs, text="", label=None, note="", spacer=""):
    label = f'<span class="c__label">{label}</span>' if label is not None else ""
    content = f'<span class="c__content">{text}</span>' if text else ""
    return f'<span data-usfm="{refs}" class="c__verse v">{label}{content}{note}{spacer}</span>'


def note(inner):
    return f'<span class="c__note f"><span class="c__label">#</span><span class="c__body">{inner}</span></span>'


def page(*blocks, key="GEN.1"):
    return f'<html><body><div data-usfm="{key}">' + "".join(f'<div class="c__p">{b}</div>' for b in blocks) + "</div></body></html>"


def heading(text):
    return f'<span class="c__heading">{text}</span>'


def got(html, usfm="GEN", chapter=1):
    return [r[1:] for r in parse_chapter(html, usfm, chapter)]


def test_plain_verses():
    assert got(page(verse("GEN.1.1", "In the", 1) + verse("GEN.1.2", "And", 2))) == [(1, "", "In the", "", ""), (2, "", "And", "", "")]


def test_headings_go_to_the_next_new_verse():
    html = page(heading("old") , heading("One "), verse("GEN.1.1", "a") + verse("GEN.1.2", "b"), heading("Two"), verse("GEN.1.2", "c"), verse("GEN.1.3", "d"))
    assert got(html) == [(1, "One", "a", "", ""), (2, "", "b c", "", ""), (3, "Two", "d", "", "")]


def test_verses_inside_a_heading_block_are_ignored():
    assert got(page(heading("x") + verse("GEN.1.1", "lost"), verse("GEN.1.2", "b"))) == [(2, "x", "b", "", "")]


def test_notes_and_labels_are_left_out():
    html = page(f'<span data-usfm="GEN.1.1" class="c__verse"><span class="c__label">1</span><span class="c__content">Before </span>{note("<span>n</span>")}<span class="c__content">after</span></span>')
    assert got(html) == [(1, "", "Before after", "", "")]


def test_poetry_is_joined_and_space_collapsed():
    html = page(verse("GEN.1.5", "one\n  line"), verse("GEN.1.5", " two "), verse("GEN.1.5", "three"), verse("GEN.1.5", "   "))
    assert got(html) == [(5, "", "one line two three", "", "")]


def test_wrapped_words_are_kept():
    assert got(page(verse("GEN.1.1", 'the <span class="nd">Lord</span> spoke'))) == [(1, "", "the Lord spoke", "", "")]


@pytest.mark.parametrize("html", ["", "<p>none</p>", page(verse("GEN.1.1", "a"), key="EXO.1")])
def test_no_container(html):
    with pytest.raises(ValueError, match="chapter div not found"):
        parse_chapter(html, "GEN", 1)


@pytest.mark.parametrize("usfm,chapter", [("gen", 1), ("", 1), ("GEN", 0), ("GEN", 201), ("TOOLONG", 1)])
def test_bad_keys(usfm, chapter):
    with pytest.raises(ValueError):
        parse_chapter(page(), usfm, chapter)


def test_container_of_the_whole_book():
    assert got(page(verse("GEN.1.1", "a"), key="GEN")) == [(1, "", "a", "", "")]


@pytest.mark.parametrize("refs", ["2SA.3.9+2SA.3.10 2SA.3.11", "2SA.3.11 2SA.3.9 2SA.3.10"])
def test_merged_verses(refs):
    html = page(heading("H"), verse("2SA.3.8", "e"), verse(refs, "text"), verse("2SA.3.12", "l"), key="2SA.3")
    assert got(html, "2SA", 3) == [(8, "H", "e", "", ""), (9, "", "text", "", ""), (10, "", T.MERGED, "merged", ""), (11, "", T.MERGED, "merged", ""), (12, "", "l", "", "")]


def test_later_text_of_a_merged_verse_is_appended():
    assert got(page(verse("GEN.1.3 GEN.1.4", "a"), verse("GEN.1.4", "own"))) == [(3, "", "a", "", ""), (4, "", f"{T.MERGED} own", "merged", "")]


def test_strays_and_bounds():
    html = page(verse("EXO.1.1", "no"), verse("GEN.2.1", "no"), verse("GEN.1.0", "no"), verse("GEN.1.301", "no"), verse("GEN.1.x", "no"), verse("GEN.1.300 EXO.1.4", "yes"))
    assert got(html) == [(300, "", "yes", "", "")]


def test_omitted_verse_with_reference():
    html = page(verse("MAT.17.21", label="[21]", note=note('<span class="fr__fr">17:21 </span><span data-usfm="MRK.9.29" class="ref">Mark</span>'), spacer='<span class="c__content">  </span>'), key="MAT.17")
    assert got(html, "MAT", 17) == [(21, "", "", "ref:MRK.9.29", "MRK.9.29")]


def test_reference_with_plus_falls_back_to_the_note():
    html = page(verse("MAT.17.21", label="[21]", note=note('<span class="x__fr">17:21</span><span data-usfm="MRK.9.29+MRK.9.30" class="ref">Mark 9</span>')), key="MAT.17")
    assert got(html, "MAT", 17) == [(21, "", "Mark 9", "omitted", "")]


def test_omitted_verses_with_text_or_nothing():
    html = page(
        heading("S"),
        verse("MRK.9.44", label="[44]", note=note('<span class="ft">Some  say</span> bare')),
        verse("MRK.9.44", label="[44]", note=note("again")),
        verse("MRK.9.45", "prose", label="[45]"),
        verse("MRK.9.46", label="[46]", note=note("only bare")),
        verse("MRK.9.47", label="[47]"),
        verse("MRK.9.48", label="48"),
        key="MRK.9",
    )
    assert got(html, "MRK", 9) == [(44, "S", "Some say", "omitted", ""), (45, "", "prose", "", ""), (46, "", "only bare", "omitted", ""), (47, "", OMITTED_TEXT, "omitted", "")]


def test_ref_spans_are_no_verses():
    html = page('<span data-usfm="GEN.1.9" class="ref">Gen 1:9</span>' + verse("GEN.1.1", "a"))
    assert got(html) == [(1, "", "a", "", "")]


def test_list_items():
    html = '<ol><li value="3"> a <a>x</a>b</li><li>c<li value="zero">d</ol><ul><li>no</li></ul><script>var x="<ol><li>";</script><ol><li>e &amp; f</li></ol>'
    assert parse_list_items(html) == [(0, "3", " a b"), (1, None, "c"), (2, "zero", "d"), (3, None, "e & f")]
    assert parse_list_items(None) == []


def test_numbered_items(spark):
    from lectern.operators.extract import list_items, numbered, verse_counts, within_spec

    pages = spark.createDataFrame([(1, '<ol><li value="notanumber">text</li><li value="1">  </li></ol>'), (2, '<ol><li value="5">far</li><li value="-2">　b　</li></ol>'), (3, None)], "page_id long, html string")
    items = numbered(list_items(pages))
    bounds = spark.createDataFrame([(1, 2), (2, 4)], "page_id long, max_verses int")
    assert sorted(map(tuple, numbered(items_of := list_items(pages)).select("page_id", "verse_sort", "content").collect())) == [(1, 1, "text"), (2, 2, "b"), (2, 5, "far")]
    kept = sorted((r["page_id"], r["verse_sort"], r["content"]) for r in within_spec(items, bounds).collect())
    assert kept == [(1, 1, "text"), (2, 2, "b")]
    assert sorted(map(tuple, verse_counts(items_of).collect())) == [(1, 1, None), (2, 5, None), (3, None, "no verses found")]


def test_bad_pages_become_error_rows(spark):
    from lectern.operators.extract import MAX_PAGE, failed_pages, list_items, numbered, verse_counts

    long = "<ol><li>a</li>" + " " * MAX_PAGE
    items = list_items(spark.createDataFrame([(1, "<ol><li>a</ol>"), (2, "<ul><li>a</ul>"), (3, long), (4, "<ol><li> </ol>")], "page_id long, html string")).cache()
    assert sorted(map(tuple, failed_pages(items).collect())) == [(2, "no verses found"), (3, "page too large, possibly cut off")]
    assert [r["page_id"] for r in numbered(items).collect()] == [1]
    assert {r["page_id"]: r["verses"] for r in verse_counts(items).collect()} == {1: 1, 2: None, 3: None, 4: 1}


def test_chapter_operator_reports_bad_pages(spark):
    from lectern.operators.extract import chapters

    pages = spark.createDataFrame([(1, page(verse("GEN.1.1", "a")), "GEN", 1), (2, "<p>", "GEN", 1), (3, None, "GEN", 1)], "page_id long, html string, usfm string, chapter_sort int")
    found = chapters(pages)
    assert [tuple(r) for r in found.filter("error IS NULL").select("page_id", "verse_sort", "content").collect()] == [(1, 1, "a")]
    assert found.filter("error IS NOT NULL").count() == 2


def test_big5(spark):
    from lectern.operators.extract import decode_big5

    data = [("你好世界".encode("big5"), "你好世界"), (b"", ""), (b"plain", "plain"), (None, None)]
    df = spark.createDataFrame([(bytearray(a) if a is not None else None, b) for a, b in data], "raw binary, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", decode_big5(df["raw"]).alias("got")).collect())
    bad = spark.createDataFrame([(bytearray(b"\xa7\xff!"),)], "raw binary")
    assert "!" in bad.select(decode_big5(bad["raw"])).first()[0]
