"""Labelled pages to train on: layouts of all sorts, the main text marked with ``data-main``."""

from __future__ import annotations

import random

SYLLABLES = "ka lo mi ter sun ve qua ri no be ost ed an in".split()


class Page:
    """One made page; every choice follows from the seed."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.closed = self.rng.random() < 0.7

    def maybe(self, share: float, *parts: str) -> str:
        return "".join(parts) if self.rng.random() < share else ""

    def words(self, low: int, high: int) -> str:
        rng = self.rng
        return " ".join(
            "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))
        )

    def sentences(self, low: int, high: int) -> str:
        many = range(self.rng.randint(low, high))
        style = self.rng.random()
        if style < 0.06:
            return " ".join(self.words(5, 60).replace(" ", self.rng.choice(["!! ", " | ", " - "])) + "." for _ in many)
        if style < 0.2:
            return " ".join(self.words(20, 70).capitalize() + "." for _ in many)
        return " ".join(self.words(2, 18).capitalize() + self.rng.choice([".", ".", ".", "!", "?", ", ..."]) for _ in many)

    def title(self) -> str:
        found = self.words(2, 12) if self.rng.random() < 0.5 else self.sentences(1, 3)
        return found[: self.rng.randint(20, 90)] if self.rng.random() < 0.3 else found

    def wrap(self, choices: str, inside: str, mark: str = "") -> str:
        """One of ``tag name|tag name``; a name stands as class or id, ``-`` for none."""
        tag, name = self.rng.choice(choices.split("|")).split()
        given = "" if name == "-" else f' {self.rng.choice(["class", "id"])}="{name}"'
        return f"<{tag}{given}{mark}>{inside}</{tag}>"

    def links(self, low: int, high: int) -> str:
        found = [f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(self.rng.randint(low, high))]
        listed = self.rng.random() < 0.6
        return f"<ul><li>{'</li><li>'.join(found)}</li></ul>" if listed else " | ".join(found)

    def paragraph(self) -> str:
        text = self.sentences(1, self.rng.choice([1, 2, 4, 9]))
        if self.rng.random() < 0.15:
            text = self.words(1, 4) + self.rng.choice([".", ".", "", " |"])
        if self.rng.random() < 0.25:
            text += f' <a href="/x">{self.words(1, 4)}</a> {self.sentences(1, 1)}'
        if self.rng.random() < 0.15:
            text = f"<b>{text}<br>"
        return f"<p>{text}</p>" if self.closed or self.rng.random() < 0.6 else f"<p>{text}"

    def passage(self) -> str:
        kind = self.rng.random()
        if kind < 0.78:
            return self.paragraph()
        if kind < 0.83:
            return f"<h2>{self.title()}</h2>{self.paragraph()}"
        if kind < 0.88:
            items = [self.sentences(1, 2) for _ in range(self.rng.randint(2, 5))]
            return f"<ul><li>{'</li><li>'.join(items)}</li></ul>"
        if kind < 0.91:
            return f"<blockquote>{self.paragraph()}</blockquote>"
        if kind < 0.93:
            return f"<figure><img src='i.png'><figcaption>{self.words(3, 12)}.</figcaption></figure>"
        if kind < 0.95:
            return f"<table><tr><th>{self.words(1, 2)}<td>{self.words(1, 4)}<tr><th>{self.words(1, 2)}<td>{self.words(1, 4)}</table>"
        if kind < 0.97:
            return f"<pre>{self.words(4, 20)}</pre>"
        return f"<div>{self.sentences(1, 4)}</div>"

    def advert(self, mark: str = "") -> str:
        text = self.rng.choice([self.sentences(1, 2), self.words(2, 9), self.links(1, 3)])
        return self.wrap("div ad|div ads|aside advert|div sponsored|div promo-box|section banner", text, mark)

    def notice(self) -> str:
        text = f"<p>{self.sentences(1, 2)}</p>{self.maybe(0.6, '<button>', self.words(1, 2), '</button>')}"
        return self.wrap("div cookie-banner|div notice|section consent|div alert|aside -|dialog -", text)

    def form(self, mark: str = "") -> str:
        text = f"<label>{self.words(1, 3)}</label><input><button>{self.words(1, 2)}</button>{self.maybe(0.5, '<p>', self.sentences(1, 1), '</p>')}"
        return f"<form{mark}>{text}</form>" if self.rng.random() < 0.5 else self.wrap("div newsletter|div search|section signup", f"<form>{text}</form>", mark)

    def comments(self, mark: str = "") -> str:
        one = lambda: self.rng.choice(["<li>{}</li>", "<div>{}</div>", "<div class='comment'>{}</div>", "<article class='comment'>{}</article>"]).format(f"<b>{self.words(1, 2)}</b><p>{self.sentences(1, 4)}</p>{self.maybe(0.3, '<a href=#>', self.words(1, 1), '</a>')}")
        many = "".join(one() for _ in range(self.rng.randint(1, 6)))
        head = self.maybe(0.7, "<h3>", self.words(1, 3), "</h3>")
        return self.wrap("section comments|div comments|div commentlist|div discussion|ol commentlist|div respond", head + many, mark)

    def aside(self) -> str:
        text = f"<h3>{self.words(1, 3)}</h3>{self.links(2, 8)}{self.maybe(0.5, '<p>', self.sentences(1, 2), '</p>')}"
        return self.wrap("aside -|div sidebar|div widget|section related|div side", text)

    def article(self) -> str:
        title = f"<h1>{self.title()}</h1>"
        if self.rng.random() < 0.3:
            title = f"<header>{title}</header>"
        parts = [self.passage() for _ in range(self.rng.choice([1, 2, 4, 7, 12, 20]))]
        for extra, share in ((self.advert, 0.25), (self.form, 0.08), (self.comments, 0.08)):
            if self.rng.random() < share:
                parts.insert(self.rng.randint(0, len(parts)), extra(' data-main="0"'))
        if self.rng.random() < 0.15:
            parts.append(f'<footer data-main="0"><p>{self.words(2, 6)}</p>{self.links(1, 4)}</footer>')
        if self.rng.random() < 0.2:
            parts.append(self.wrap("div share|div tags|nav -|ul social", self.links(2, 5), ' data-main="0"'))
        inside = self.maybe(0.85, title) + "".join(parts)
        return self.wrap(
            "article -|article -|article post|main -|div content|div post-content|div entry|div article-body|div story|div -|section -",
            inside,
            ' data-main="1"',
        )

    def html(self) -> str:
        top = self.maybe(0.6, self.wrap("header -|div header|div masthead|div topbar", self.maybe(0.5, "<h1>", self.words(1, 3), "</h1>") + self.maybe(0.5, "<p>", self.words(2, 8), "</p>") + self.maybe(0.4, self.links(2, 7))))
        menu = self.maybe(0.85, self.wrap("nav -|nav -|div menu|div navbar|div -|ul -", self.links(3, 10)))
        before = [self.maybe(0.35, self.notice()), self.maybe(0.4, self.advert()), self.maybe(0.3, self.aside())]
        after = [self.maybe(0.3, self.comments()), self.maybe(0.35, self.aside()), self.maybe(0.3, self.advert()), self.maybe(0.2, self.form())]
        self.rng.shuffle(before)
        self.rng.shuffle(after)
        foot = self.maybe(0.9, self.wrap("footer -|footer -|div footer|div copyright|div -", f"&copy; {self.words(1, 3)} &middot; {self.rng.choice([self.sentences(1, 2), self.words(2, 6), self.links(2, 6)])}"))
        middle = "".join(before) + self.article() + "".join(after)
        if self.rng.random() < 0.4:
            middle = self.wrap("div wrapper|div -|div container|main -|div page", middle)
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 9)}</title></head><body>{top}{menu}{middle}{foot}</body></html>"


def labelled_pages(count: int, seed: int = 1) -> list[str]:
    return [Page(seed * 1_000_003 + i).html() for i in range(count)]
