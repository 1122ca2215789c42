"""Operator 9 on pages whose tags and names mislead."""

import pytest

from tidemark.llm import extract

PROSE = "The man who was in the house of the king and all the others were there for the day and the night"
LONG = f"{PROSE}, but it was not so for the people of the town, who had to be at the gate when the man came in and who could not see what he had in his hand"
RUSSIAN = "Старый дом стоял у самой реки, где летом собирались дети со всей деревни и долго играли на берегу"
LINKS = "<ul><li><a href=x>One link of the page</a></li></ul>"


@pytest.mark.parametrize(
    "page, text",
    [
        # The article tag is used for reader comments, the body stands in a plain element.
        (f"<div><p>{LONG}.</p><p>Yes.</p><p>{LONG}!</p></div><article><p>Nice one.</p></article>", f"{LONG}.\nYes.\n{LONG}!"),
        # An article in a closed aside is not the page's.
        (f"<div><p>{PROSE}.</p><p>{PROSE}!</p></div><aside><article><p>{PROSE}?</p><p>{PROSE}</p><p>{LONG}</p></article></aside>", f"{PROSE}.\n{PROSE}!"),
        # Long dense text beside the article, and what stands between such text.
        (f"<div><p>{LONG}.</p><p>Yes.</p><p>{LONG}!</p></div><article><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article><p>{PROSE}</p>", f"{LONG}.\nYes.\n{LONG}!\n{LONG}\n{LONG}\n{LONG}"),
        # Between links of the article.
        (f"<article><h1>Title</h1>{LINKS}<p>{PROSE}</p>{LINKS}<p>Tags</p>{LINKS}</article>", f"Title\n{PROSE}"),
        # The tag decides where no stop word is known, and a form may stand around the page.
        (f"<article><h1>Дом</h1><p>{RUSSIAN}</p>{LINKS}<p>{RUSSIAN}.</p>{LINKS}</article><p>{PROSE}</p>", f"Дом\n{RUSSIAN}\n{RUSSIAN}."),
        (f"<form><article><p>{PROSE}</p></article></form>", PROSE),
        # All prose in an aside.
        (f"<aside><p>{LONG}</p></aside>", LONG),
    ],
)
def test_article_tags_are_a_weight(page, text):
    assert extract.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class='layout has-sidebar'><p>{PROSE}</p></div>", PROSE),
        (f"<html class='has-navbar'><body><p>{PROSE}</p></body></html>", PROSE),
        (f"<html class=navbar><body class=modal><main class=sidebar><p>{PROSE}</p></main></body></html>", PROSE),
        (f'<div class="elementor-widget elementor-widget-text-editor"><p>{PROSE}</p></div>', PROSE),
        (f'<article class="post tag-social comments-open"><h1>Title</h1><p>{PROSE}</p><p>Yes.</p></article>', f"Title\n{PROSE}\nYes."),
        # Other attributes, and values that look like one.
        (f"<div data-id=share data-class='ad' title='class=ad id=ad'><p>{PROSE}</p></div>", PROSE),
        # Prose in marked elements; a mark in them holds still, and one without prose.
        (f"<div class='widget'><h2>Title</h2><p>{LONG}</p><div class='share'><p>Share</p></div><p>{LONG}.</p></div><div class='promo'>{PROSE}</div>", f"Title\n{LONG}\n{LONG}."),
        (f"<article class='widget'><p>{PROSE}</p></article>", PROSE),
        (f"<form><p>{LONG}</p></form>", LONG),
        # Comments and notices are written like an article; names of known words are marks.
        (f"<article><p>{PROSE}</p><ol class='comment-list'><li>{LONG}</ol><div id=cookie-notice>{LONG}</div></article><article class=comment>{LONG}</article>", PROSE),
        (f"<div CLASS = \"main-nav ad-1\">{PROSE}</div><p>{PROSE}.</p><div role=navigation>{PROSE}</div>", f"{PROSE}."),
        (f"<div class=comments><p>{LONG}</p></div>", LONG),
        # An open menu whose end is lost.
        (f"<div class=menu>Menu<article><p>{PROSE}</article>", PROSE),
    ],
)
def test_names_mark_whole_and_not_for_good(page, text):
    assert extract.main_text(page) == text


def test_nested_marks_do_not_slow_extraction():
    assert extract.main_text("<div class=ad>" * 50_000 + f"<p>{LONG}</p>") == LONG


@pytest.mark.parametrize(
    "page, text",
    [
        # A headline that links to itself, in an article and without one.
        (f"<article><h1><a href=x>Title</a></h1><p>{PROSE}</p></article>", f"Title\n{PROSE}"),
        (f"<div><h1><a href=x>Title</a></h1><p>{PROSE}</p></div>", f"Title\n{PROSE}"),
        # Linked lines between prose, and sources at an article's end; other links at its edges are none of it.
        (f"<p>{PROSE}</p><p><a href=x>The report</a></p><p>{PROSE}.</p>", f"{PROSE}\nThe report\n{PROSE}."),
        (f"<article>{LINKS}<p>{PROSE}</p><h2>Sources</h2><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></article>", f"{PROSE}\nSources\nOne\nTwo"),
        (f"<article>{LINKS}<p>{PROSE}</p>{LINKS}</article>", PROSE),
        (f"<div>{LINKS}</div><p>{PROSE}</p>{LINKS}", PROSE),
        (f"<article><p>{PROSE}</p><p><a href=x>{LONG}</a></p></article>", PROSE),
        # Only a link has a href.
        (f"<p><a name=x>{PROSE}</p>", PROSE),
        (f"<p><a id=x data-href=y>{PROSE}</p>", PROSE),
        # Characters as they are read.
        (f"<p>{PROSE}<a href=x>\n{' ' * 200}here\n{' ' * 200}</a>.</p>", f"{PROSE} here ."),
        (f"<p>{PROSE}<a href=x>{'&nbsp;&eacute;' * 9}</a></p>", f"{PROSE}{' é' * 9}"),
    ],
)
def test_linked_text(page, text):
    assert extract.main_text(page) == text
