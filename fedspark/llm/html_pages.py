"""Made-up web pages with known labels, and the labeller trained on them.

Pages differ in layout, class names, order and nesting; words are invented anew for
each page, so the labeller learns structure and a few set phrases, no vocabulary.
"""

from __future__ import annotations

import random
from functools import cache

import numpy as np

from . import html_extract, lstm

PAGES, EPOCHS, SEED = 1500, 6, 11

_MAIN = [("article", ""), ("main", ""), ("div", "content"), ("div", "post-content"), ("div", "entry"), ("div", "article-body"), ("div", "story text"), ("section", "article"), ("td", "main"), ("div", ""), ("div", "main-column"), ("article", "post")]
_NOISE = ["", "", "", "wrapper", "container", "row", "inner", "col-md-8", "page", "site", "clearfix", "block", "box"]
_MENU = [("nav", ""), ("nav", "navbar"), ("div", "menu"), ("ul", "nav"), ("div", "navigation"), ("div", "breadcrumbs"), ("div", "topbar links"), ("div", "pagination"), ("div", "tags"), ("div", "share-buttons social")]
_HEAD = [("header", ""), ("header", "site-header"), ("div", "header"), ("div", "masthead"), ("div", "branding logo")]
_FOOT = [("footer", ""), ("div", "footer"), ("footer", "site-footer"), ("div", "copyright"), ("div", "bottom legal")]
_SIDE = [("aside", ""), ("div", "sidebar"), ("aside", "widget"), ("div", "related-posts"), ("section", "recommended"), ("div", "popular trending"), ("td", "side"), ("div", "teaser more")]
_NOTE = [("div", "cookie-notice"), ("div", "consent banner"), ("div", "notice"), ("div", "alert"), ("div", "popup modal"), ("section", "newsletter subscribe"), ("div", "paywall"), ("div", "gdpr")]
_ADS = [("div", "ad"), ("div", "ads"), ("div", "advert"), ("aside", "sponsored"), ("div", "promo"), ("div", "ad-banner"), ("section", "advertisement"), ("ins", "adsbygoogle")]
_FORM = [("form", ""), ("form", "search"), ("form", "login"), ("form", "contact-form"), ("div", "form signup")]
_TALK = [("section", "comments"), ("div", "comments"), ("ol", "comment-list"), ("div", "discussion"), ("section", "replies"), ("div", "responses reader"), ("div", "disqus thread"), ("ul", "reviews")]
_SAYINGS = {
    "note": ["We use cookies to improve your experience. Accept all", "Subscribe to our newsletter", "This site uses cookies.", "Please enable JavaScript", "Sign up for free and never miss a story"],
    "foot": ["© 2024 All rights reserved.", "Copyright 2021", "Privacy policy · Terms of use · Contact", "Powered by", "Imprint", "© example.com"],
    "form": ["Search", "Your name", "Email", "Log in", "Password", "Submit", "Send", "Leave a comment"],
    "talk": ["Comments", "3 comments", "Reply", "says:", "Leave a reply", "Great post, thanks!"],
    "side": ["Related articles", "Most read", "You may also like", "Popular", "Recent posts", "Archive"],
    "ads": ["Advertisement", "Sponsored", "Buy now", "Shop the sale today"],
}


class _Page:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        syllables = ["".join(self.r.choice("bcdfghlmnprstvwzäéñ") + self.r.choice("aeiouyüóè") + self.r.choice(["", "n", "r", "s", "t"]) for _ in range(1)) for _ in range(40)]
        self.words = ["".join(self.r.choices(syllables, k=self.r.randint(1, 4))) for _ in range(150)]
        self.labels: dict[str, int] = {}

    def sentence(self, lo=3, hi=22):
        s = " ".join(self.r.choices(self.words, k=self.r.randint(lo, hi))).capitalize()
        return s + self.r.choice(".....!?")

    def say(self, text: str, label: int) -> str:
        """Text that is new on the page, so that its label can be found again."""
        while text in self.labels and self.labels[text] != label:
            text += " " + self.r.choice(self.words)
        self.labels[text] = label
        return text.replace("&", "&amp;").replace("<", "&lt;") if self.r.random() < 0.9 else text.replace("<", "&lt;").replace("©", "&copy;").replace("é", "&eacute;")

    def open(self, kind):
        tag, name = kind
        if self.r.random() < 0.15:
            name = (name + " " + self.r.choice(_NOISE)).strip()
        attribute = self.r.choice(["class", "class", "class", "id"])
        return (f'<{tag} {attribute}="{name}">' if name else f"<{tag}>"), f"</{tag}>"

    def links(self, n, label=0, linked=0.9):
        out = []
        for _ in range(n):
            t = self.say(" ".join(self.r.choices(self.words, k=self.r.randint(1, 4))), label)
            out.append(f'<li><a href="/{self.r.choice(self.words)}">{t}</a></li>' if self.r.random() < linked else f"<li>{t}</li>")
        return "<ul>" + "".join(out) + "</ul>"

    def plain(self, kinds, saying, lo, hi):
        """A container whose text is no article text."""
        a, b = self.open(self.r.choice(kinds))
        out = []
        for _ in range(self.r.randint(lo, hi)):
            t = self.r.choice(_SAYINGS[saying]) if self.r.random() < 0.4 else " ".join(self.sentence() for _ in range(self.r.randint(1, 4)))
            tag = self.r.choice(["p", "div", "span", "h3", "p", ""])
            t = self.say(t, 0)
            out.append(f"<{tag}>{t}</{tag}>" if tag else t)
        if self.r.random() < 0.3:
            out.append(self.links(self.r.randint(1, 6)))
        return a + "".join(out) + b

    def form(self):
        a, b = self.open(self.r.choice(_FORM))
        out = [f"<label>{self.say(self.r.choice(_SAYINGS['form']), 0)}</label><input name=x>" for _ in range(self.r.randint(1, 3))]
        if self.r.random() < 0.4:
            out.append("<select>" + "".join(f"<option>{self.say(self.r.choice(self.words), 0)}" for _ in range(3)) + "</select>")
        if self.r.random() < 0.3:
            out.append(f"<p>{self.say(self.sentence(), 0)}</p>")
        return a + "".join(out) + f"<button>{self.say(self.r.choice(_SAYINGS['form']), 0)}</button>" + b

    def talk(self):
        a, b = self.open(self.r.choice(_TALK))
        if self.r.random() < 0.2:  # a lone remark
            said = self.say(self.sentence(2, 12), 0)
            return a + self.r.choice([f"<p>{said}</p>", f"<div>{said}</div>", said]) + b
        inner = self.r.choice(["li", "div", "article", "p"])
        out = [f"<h3>{self.say(self.r.choice(_SAYINGS['talk']), 0)}</h3>"] if self.r.random() < 0.7 else []
        for _ in range(self.r.randint(1, 6)):
            who = f"<b>{self.say(self.r.choice(self.words).capitalize(), 0)}</b>"
            said = self.say(" ".join(self.sentence() for _ in range(self.r.randint(1, 4))), 0)
            out.append(f'<{inner} class="{self.r.choice(["comment", "reply", "review", ""])}"><div>{who}</div><p>{said}</p></{inner}>')
        return a + "".join(out) + b

    def article(self):
        a, b = self.open(self.r.choice(_MAIN))
        out = []
        if self.r.random() < 0.85:
            h = f"<h1>{self.say(self.sentence(), 1)}</h1>"
            out.append(f"<header>{h}</header>" if self.r.random() < 0.05 else h)
        style = self.r.random()
        for _ in range(self.r.randint(1, 14)):
            x = self.r.random()
            if x < 0.12:
                h = self.say(self.sentence(), 1)
                out.append(self.r.choice([f"<h2>{h}</h2>", f"<p><b>{h}</b></p>", f"<p><b>{h}<br>", f"<h3>{h}</h3>"]))
            elif x < 0.17:
                out.append("<ul>" + "".join(f"<li>{self.say(self.sentence(), 1)}" + self.r.choice(["", "</li>"]) for _ in range(self.r.randint(2, 5))) + "</ul>")
            elif x < 0.20:
                out.append(f"<blockquote>{self.say(self.sentence(), 1)}</blockquote>")
            elif x < 0.26:
                out.append(self.plain(_ADS, "ads", 1, 2))
            elif x < 0.28:
                out.append(self.form() if self.r.random() < 0.5 else self.plain(_NOTE, "note", 1, 2))
            elif x < 0.30:
                out.append(f"<table><tr><td>{self.say(self.sentence(), 1)}<td>{self.say(self.sentence(1, 3), 1)}</table>")
            else:
                t = " ".join(self.sentence() for _ in range(self.r.choice([1, 1, 2, 3, 5, 9])))
                if self.r.random() < 0.1:
                    t = t[:-1]
                if self.r.random() < 0.04:  # poor pages repeat themselves
                    t = " ".join([self.r.choice(self.words).capitalize()] + [self.r.choice(self.words)] * self.r.randint(5, 40))
                t = self.say(t, 1)
                if self.r.random() < 0.2:
                    first, _, rest = t.partition(" ")
                    t = f'<a href="#">{first}</a> {rest}' if rest else t
                out.append(f"<p>{t}</p>" if style < 0.8 else f"<p>{t}" if style < 0.9 else f"<div>{t}</div>")
        if self.r.random() < 0.2:  # readers' comments inside the article's element
            out.append(self.talk())
        return a + "".join(out) + b

    def make(self) -> str:
        r = self.r
        before = [lambda: self.plain(_HEAD, "side", 1, 2), lambda: self.open_links(_MENU), lambda: self.plain(_NOTE, "note", 1, 2), lambda: self.plain(_ADS, "ads", 1, 2), self.form, lambda: self.open_links(_SIDE), lambda: self.plain(_SIDE, "side", 1, 4)]
        after = [self.talk, lambda: self.plain(_SIDE, "side", 1, 5), lambda: self.open_links(_SIDE), self.form, lambda: self.plain(_ADS, "ads", 1, 2), lambda: self.plain(_NOTE, "note", 1, 2), lambda: self.open_links(_MENU)]
        parts = [f() for f in r.sample(before, r.randint(1, 4))]
        body = self.article()
        for _ in range(r.randint(0, 2)):
            name = r.choice(_NOISE)
            body = f'<div class="{name}">{body}</div>' if name else f"<div>{body}</div>"
        parts.append(body)
        parts += [f() for f in r.sample(after, r.randint(0, 3))]
        if r.random() < 0.85:
            parts.append(self.plain(_FOOT, "foot", 1, 3))
        inner = "".join(parts)
        if r.random() < 0.2:
            inner = f'<div class="{r.choice(_NOISE) or "all"}">{inner}</div>'
        return f"<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style></head><body>{inner}</body></html>"

    def open_links(self, kinds):
        a, b = self.open(self.r.choice(kinds))
        return a + self.links(self.r.randint(2, 9)) + b


def sample(seed: int) -> tuple[list[html_extract.Block], np.ndarray]:
    """The blocks of one made-up page and their labels."""
    page = _Page(seed)
    blocks = html_extract.blocks_of(page.make())
    known = {" ".join(k.split()): v for k, v in page.labels.items()}
    pairs = [(b, known[b.text]) for b in blocks if b.text in known]
    return [b for b, _ in pairs], np.array([v for _, v in pairs], dtype=np.float32)


@cache
def trained(pages: int = PAGES, epochs: int = EPOCHS, seed: int = SEED) -> lstm.Labeller:
    """The labeller; the same numbers give the same one."""
    made = [sample(seed * 100_003 + i) for i in range(pages)]
    blocks = [b for b, _ in made]
    rows = html_extract.vectors(blocks)
    model = lstm.Labeller.fresh(rows.shape[1], seed)
    sizes = [len(b) for b in blocks]
    labels = np.concatenate([y for _, y in made])
    model.train(rows, sizes, labels, epochs, seed)
    model.train(rows, sizes, labels, 2, seed + 1, rate=0.002)
    return model
