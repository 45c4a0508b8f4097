"""Labelled pages for the extraction weights: common page layouts whose content words are ``x`` and all others ``o``."""

from __future__ import annotations

import numpy as np

#: Names that pages give to parts of one purpose (fixed values).
CONTAINERS = ("<article>", "<main>", "<article class='post'>", "<div class='content'>", "<div id='main-content'>", "<section class='entry-content'>",
              "<div class='article-body'>", "<div class='story'>", "<div class='post-body text'>", "<div itemprop='articleBody'>", "<body>", "<div>",
              "<main><article>", "<div role='main'>", "<article class='page hentry'>")
MENUS = ("nav", "div class='menu'", "ul class='navbar'", "div id='navigation'", "div class='breadcrumb breadcrumbs'", "div class='pagination pager'",
         "div class='skip-link'", "div class='toc'", "div role='navigation'", "div class='tags'", "div class='topbar'")
HEADS = ("header", "div class='site-header'", "div id='header'", "div class='masthead'", "div role='banner'", "div class='logo'")
FEET = ("footer", "div class='site-footer'", "div id='footer'", "div class='copyright'", "div role='contentinfo'", "div class='legal'")
SIDES = ("aside", "div class='sidebar'", "div id='side'", "div class='widget'", "section class='related'", "div class='recommended'",
         "div class='more-stories'", "div class='popular trending'", "div role='complementary'", "div class='author-bio'", "div class='teaser'")
NOTICES = ("div class='notice'", "div class='cookie-banner'", "div id='consent'", "div class='gdpr'", "div role='alert'", "div class='alert warning'",
           "div class='modal popup'", "div class='paywall'", "div role='dialog'", "div class='announcement'", "div class='privacy'", "div class='cookies'")
ADVERTS = ("div class='ad'", "div class='ads'", "div id='advert'", "div class='advertisement'", "div class='sponsored'", "div class='promo promotion'",
           "aside class='ad'", "ins class='adsbygoogle'", "div class='banner'", "div class='sponsor'")
FORMS = ("form", "form class='search'", "div class='newsletter'", "div class='subscribe signup'", "form id='login'", "div class='share social'", "fieldset",
         "div class='poll'", "div class='feedback'")
COMMENTS = ("section class='comments'", "div id='comments'", "ol class='commentlist'", "div class='comment'", "div class='comment-list'", "div id='disqus'",
            "section class='discussion'", "div class='responses replies'", "article class='comment'", "div class='reply'", "div class='user-reviews'")
PLAIN = ("noscript", "template", "svg", "iframe", "object", "select", "button", "textarea", "head><title", "div hidden", "div style='display:none'")
OTHERS = (MENUS, MENUS, HEADS, FEET, SIDES, NOTICES, ADVERTS, FORMS, COMMENTS, PLAIN)


def closing(opening: str) -> str:
    names = [part.split()[0].strip("<>") for part in opening.replace("><", "> <").split("<") if part.strip()] if opening[0] == "<" else [
        part.split()[0] for part in opening.split("><")]
    return "".join(f"</{n}>" for n in reversed(names))


def page(rng: np.random.Generator) -> str:
    pick = lambda options: options[rng.integers(len(options))]
    some = lambda word, a, b: " ".join([word] * int(rng.integers(a, b)))

    def other() -> str:
        kind = pick(OTHERS)
        opening = pick(kind)
        if kind in (MENUS, FEET, SIDES) and rng.random() < 0.6:
            inner = "<ul>" + "".join(f"<li><a href='#'>{some('o', 1, 4)}</a></li>" for _ in range(rng.integers(2, 6))) + "</ul>"
        elif kind is FORMS:
            inner = f"<label>{some('o', 1, 4)}</label><input name='q'><p>{some('o', 3, 12)}</p><button>{some('o', 1, 2)}</button>"
        elif kind is COMMENTS:
            inner = "".join(f"<div class='comment'><p>{some('o', 4, 40)}</p></div>" for _ in range(rng.integers(1, 5)))
        elif kind is HEADS:
            inner = pick((f"<h1>{some('o', 1, 4)}</h1>", f"<p>{some('o', 1, 6)}</p>", some("o", 1, 5)))
        else:
            inner = pick((some("o", 2, 25), f"<p>{some('o', 2, 25)}</p>", f"<h3>{some('o', 1, 4)}</h3><p>{some('o', 4, 25)}</p>"))
        return f"<{opening}>{inner}{closing(opening)}"

    def content() -> str:
        kind = rng.integers(0, 12)
        text = some("x", 4, 60)
        if kind < 7:
            return pick((f"<p>{text}</p>", f"<p><b>{text}<br>", f"<p>{text} <a href='#'>{some('x', 1, 3)}</a> {text}</p>", f"<p>{text}"))
        return (f"<h2>{some('x', 1, 8)}</h2>", f"<ul><li>{text}</li><li>{text}</li></ul>", f"<blockquote><p>{text}</p></blockquote>",
                f"<table><tr><td>{text}</td><td>{text}</td></tr></table>", f"<pre>{text}</pre>")[kind - 7]

    opening = pick(CONTAINERS)
    inside = [f"<h1>{some('x', 2, 10)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.integers(1, 10)):
        inside.append(content())
        if rng.random() < 0.15:
            inside.append(other())
    before = [other() for _ in range(rng.integers(0, 4))]
    after = [other() for _ in range(rng.integers(0, 5))]
    body = "".join(before) + opening + "".join(inside) + closing(opening) + "".join(after)
    return f"<html><head><title>{some('o', 2, 9)}</title></head><body>{body}</body></html>"


def pages(n: int, seed: int = 8) -> list[str]:
    rng = np.random.default_rng(seed)
    return [page(rng) for _ in range(n)]
