"""HTML text: articles in left-out elements, and class names on wrappers."""

import pytest

from fleetpulse.llm.html_text import main_text

P = "This is a paragraph of the article and it has lots of the words that are stop words in it, as is usual."
C = "I think that this is the best article of all that I have read in this year and it is so good."


@pytest.mark.parametrize("page", [
    f'<div class=content><p>{P}</p></div><div class="comments"><article class="comment"><p>{C}</p></article><article><p>{C}</p></article></div>',
    f"<article><p>{P}</p></article><aside><article><p>{C}</p></article><article><p>{C}</p></article></aside>",
    f'<article><p>{P}</p></article><article class="comment"><p>{C}</p></article>',
    f'<article><div class="comments"><article><p>{C}</p></article></div><p>{P}</p></article>',
    f"<article><p>{P}</p><aside>{C}</article><form>{C}</form>",
    f"<nav>{C}<article><p>{P}</p></article>",
    f'<article class="post category-social"><p>{P}</p></article><p class="ad">{C}</p>',
    f'<div class="sidebar-left"><main><p>{P}</p></main></div>',
    f'<div class="layout with-sidebar"><div class="sidebar"><p>{C}</p></div><p>{P}</p></div>',
    f'<div class="post no-comments"><p>{P}</p></div><div class="comments"><p>{C}</p></div>',
    f'<div class="layout sidebar-left"><div class="sidebar"><p>{C}</p></div><p>{P}</p></div>',
    f'<div class="social"><div class="widget"><p>{P}</p></div></div><div class="ad">x</div>',
])
def test_only_the_article(page):
    assert main_text(page) == P
