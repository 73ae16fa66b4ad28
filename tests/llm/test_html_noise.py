"""Blocks of pages that are no text of the article, by their names and labels."""

import pytest

from gristmill.llm import html_text


NOISY = "adsbygoogle siteFooter copyright bottom top-bar user-reviews login-form alert legal notice site-notice promoted social-share related related-posts ad-slot AdBox cookie-consent".split()


@pytest.mark.parametrize("attributes", [*[f'class="{w}"' for w in NOISY], *[f'id="{w}"' for w in NOISY], 'role="note"', 'aria-label="Advertisement"'])
@pytest.mark.parametrize("page", ["<article>{0}{1}{2}</article>", "<div class=content>{0}{2}</div>{1}", "<div><div class=content>{0}{1}{2}</div></div>"])
def test_noise_beside_paragraphs_goes(attributes, page):
    first, second = ("<p>" + "A sentence, of an article, that goes on for a while and says a thing. " * 3 + "</p>" for _ in range(2))
    noise = f"<div {attributes}>" + "Words that are not of the article, which nobody asked for, stand in this block of about a hundred characters.</div>"
    text = html_text.main_text(f"<html><body><nav>menu</nav>{page.format(first, noise, second)}</body></html>")
    assert "nobody asked" not in text and text.count("goes on for a while") == 6


@pytest.mark.parametrize("name", ["noticeable", "hasSidebar", "article-body", "socialist", "leadStory", "reviewBody", "bottomline"])
def test_names_that_only_look_like_noise_stay(name):
    text = html_text.main_text(f"<html><body><article><p>One, two, three, four.</p><div class='{name}'>Five, six.</div></article></body></html>")
    assert text == "One, two, three, four. Five, six."
