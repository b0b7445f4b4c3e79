"""Labelled pages to train on: layouts of web pages, filled with sentences of the pages at hand.

Every element that begins main text carries ``data-main="yes"``, every element in it that does not belong
to it ``data-main="no"``; text takes the mark of the nearest element that has one, and none is "no".
"""

from __future__ import annotations

import html
import random

MARK = "data-main"

# Words that page authors use in class names and ids, by the part of the page they name.
NAMES = {
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs pagination pager toc tabs links categories skip toolbar",
    "header": "header masthead topbar top banner branding logo site-title tagline search",
    "footer": "footer bottom copyright colophon legal credits imprint site-info contact",
    "sidebar": "sidebar side aside rail widget secondary complementary column-right column-left archive",
    "notice": "notice cookie cookies consent gdpr alert popup modal message overlay disclaimer warning toast paywall privacy",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion dfp commercial adbox banner-ad outbrain",
    "form": "form newsletter subscribe signup login search-form subscription register contact-form",
    "share": "share sharing social buttons follow print tools",
    "related": "related recommended trending popular more-stories teaser teasers read-more tags latest",
    "comments": "comments comment comment-list commentlist replies reply discussion disqus responses respond thread feedback",
    "main": "content article post entry story main text body post-content entry-content article-body main-content page",
}
FALLBACK = (
    "The river rose in the night, and by noon the bridge was closed.",
    "Nobody had expected the answer to be so simple.",
    "In spring the old town fills with visitors from the coast, who stay for a week or two.",
    "Read more here.",
    "It was, she said, the best year of all.",
)


class _Writer:
    def __init__(self, sentences: list[str], draw: random.Random):
        self.sentences, self.draw = sentences, draw
        self.named = draw.random() < 0.85  # some authors name few of their blocks
        self.closes = draw.random() < 0.6  # and some leave paragraphs open
        self.break_ = draw.choice(["", "", "\n", "\n  "])

    def chance(self, p: float) -> bool:
        return self.draw.random() < p

    def some(self, low: int, high: int) -> range:
        return range(self.draw.randint(low, high))

    def sentence(self) -> str:
        return html.escape(self.draw.choice(self.sentences))

    def words(self, low: int, high: int) -> str:
        pool = self.draw.choice(self.sentences).split()
        n = self.draw.randint(low, high)
        at = self.draw.randint(0, max(0, len(pool) - n))
        return html.escape(" ".join(pool[at : at + n]))

    def prose(self, low: int, high: int) -> str:
        return " ".join(self.sentence() for _ in self.some(low, high))

    def link(self, text: str) -> str:
        return f'<a href="/{self.draw.randint(1, 999)}">{text}</a>'

    def name(self, role: str, always: bool = False) -> str:
        """A class, id or role attribute, or nothing."""
        if not always and not (self.named and self.chance(0.8)):
            return ""
        word = self.draw.choice(NAMES[role].split())
        other = self.draw.choice(["", "", "", "box", "wrap", "inner", "block", "container", "css-x", "row", "col"])
        value = self.draw.choice([word, f"{word}-{other}", f"{word} {other}", f"{other}_{word}"]) if other else word
        return f' {self.draw.choice(["class", "class", "id"])}="{value}"'

    def box(self, tags: str, role: str, inside: str, mark: str = "", always: bool = False) -> str:
        tag = self.draw.choice(tags.split())
        named = self.name(role, always or tag in ("div", "section", "ul", "p") and self.named)
        return f"<{tag}{named}{mark}>{inside}</{tag}>{self.break_}"

    # --- parts of a page that are not main text ---

    def menu(self) -> str:
        items = [self.link(self.words(1, 3)) for _ in self.some(3, 12)]
        listed = "".join(f"<li>{i}</li>" for i in items) if self.chance(0.7) else self.draw.choice([" | ", " ", " &middot; "]).join(items)
        if listed.startswith("<li>"):
            listed = f"<ul>{listed}</ul>"
        return self.box("nav nav div", "menu", listed)

    def site_header(self) -> str:
        title = self.draw.choice(["<h1>{}</h1>", "<div>{}</div>", "<a href='/'>{}</a>"]).format(self.words(1, 4))
        parts = [title] + [f"<p>{self.words(3, 9)}</p>"] * self.chance(0.4) + [self.menu()] * self.chance(0.4) + [self.form()] * self.chance(0.2)
        return self.box("header header div", "header", "".join(parts))

    def footer(self) -> str:
        said = self.draw.choice(["&copy; {}", "© 2024 {}", "{}", "Copyright {}"]).format(self.draw.choice([self.words(1, 5), self.sentence()]))
        parts = [f"<p>{said}</p>" if self.chance(0.4) else said]
        parts += [f" &middot; {self.sentence()}"] * self.chance(0.4) + [f"<p>{self.prose(1, 3)}</p>"] * self.chance(0.3) + [self.menu()] * self.chance(0.4)
        return self.box("footer footer div", "footer", "".join(parts))

    def titled_links(self) -> str:
        items = "".join(
            f"<li>{self.link(self.words(2, 9))}{' ' + self.sentence() if self.chance(0.3) else ''}</li>" for _ in self.some(2, 7)
        )
        return f"<h3>{self.words(1, 4)}</h3><ul>{items}</ul>"

    def sidebar(self) -> str:
        widgets = []
        for _ in self.some(1, 4):
            inside = self.draw.choice([self.titled_links(), f"<h3>{self.words(1, 4)}</h3><p>{self.prose(1, 4)}</p>", f"<p>{self.prose(1, 2)}</p>"])
            widgets.append(self.box("div section", "sidebar", inside) if self.chance(0.6) else inside)
        return self.box("aside aside div", "sidebar", "".join(widgets))

    def notice(self) -> str:
        inside = self.prose(1, 3)
        inside = f"<p>{inside}</p>" if self.chance(0.5) else inside
        inside += self.draw.choice(["", f"<button>{self.words(1, 2)}</button>", self.link(self.words(1, 2))])
        if self.chance(0.3):
            return f'<div role="{self.draw.choice(["alert", "alertdialog", "dialog", "banner"])}">{inside}</div>'
        return self.box("div section p aside", "notice", inside, always=True)

    def advert(self) -> str:
        inside = self.draw.choice([self.prose(1, 2), self.words(2, 8), self.link(self.words(2, 9)), f"<p>{self.prose(1, 3)}</p>"])
        return self.box("div div section aside ins p span", "advert", inside, always=True)

    def form(self) -> str:
        fields = "".join(
            f"<label>{self.words(1, 3)}</label><input type=text>" if self.chance(0.7) else f"<select><option>{self.words(1, 1)}</select>"
            for _ in self.some(1, 4)
        )
        said = f"<p>{self.prose(1, 2)}</p>" if self.chance(0.4) else ""
        form = f"<form{self.name('form')}>{said}{fields}<button>{self.words(1, 2)}</button></form>"
        return form if self.chance(0.7) else self.box("div section", "form", f"<h3>{self.words(1, 4)}</h3>" + form)

    def share(self) -> str:
        return self.box("div ul", "share", " ".join(self.link(self.words(1, 1)) for _ in self.some(2, 5)), always=True)

    def related(self) -> str:
        return self.box("div section aside", "related", self.titled_links(), always=True)

    def comments(self) -> str:
        item = self.draw.choice(["div", "li", "article", "p"])
        listed = ""
        for _ in self.some(1, 8):
            who = self.draw.choice([f"<b>{self.words(1, 2)}</b>", f"<span>{self.words(1, 2)}</span>", f"<cite>{self.words(1, 2)}</cite>", ""])
            said = self.prose(1, 5)
            said = f"<p>{said}</p>" * (item != "p") or f" {said}"
            listed += f"<{item}{self.name('comments')}>{who}{said}{self.link(self.words(1, 1)) if self.chance(0.4) else ''}</{item}>"
        listed = f"<ol>{listed}</ol>" if item == "li" else listed
        parts = [f"<h{self.draw.choice('234')}>{self.words(1, 3)}</h3>"] * self.chance(0.6) + [listed] + [self.form()] * self.chance(0.4)
        return self.box("section div div", "comments", "".join(parts), always=True)

    # --- main text ---

    def inline(self) -> str:
        text = self.prose(1, 6)
        if self.chance(0.25):
            text += " " + self.draw.choice([self.link("{}"), "<b>{}</b>", "<em>{}</em>", "<span>{}</span>", "<code>{}</code>"]).format(self.words(1, 4))
            text += " " + self.sentence()
        return text

    def paragraph(self) -> str:
        text = self.inline()
        if self.chance(0.08):
            return f"<p><b>{self.sentence()}<br>"  # never closed
        if self.chance(0.1):
            return f"{text}<br><br>"
        if self.chance(0.08):
            return f"<div>{text}</div>"
        return f"<p>{text}</p>" if self.closes else f"<p>{text}"

    def extra(self) -> str:
        rows = "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 6)}</td></tr>" for _ in self.some(2, 6))
        items = "".join(f"<li>{self.draw.choice([self.sentence(), self.words(1, 6)])}</li>" for _ in self.some(2, 7))
        return self.draw.choice([
            f"<ul>{items}</ul>", f"<ol>{items}</ol>", f"<blockquote><p>{self.prose(1, 4)}</p></blockquote>", f"<table>{rows}</table>",
            f"<pre>{self.words(3, 20)}</pre>", f"<figure><img src=x><figcaption>{self.words(2, 9)}</figcaption></figure>",
            f"<h{self.draw.choice('23')}>{self.words(2, 7)}</h2>", f"<section><h2>{self.words(2, 6)}</h2><p>{self.prose(1, 5)}</p></section>",
        ])

    def aside_of_main(self) -> str:
        made = self.draw.choice([self.advert, self.share, self.related, self.form, self.notice, self.sidebar, self.menu])()
        return made.replace(">", f' {MARK}="no">', 1)

    def main_text(self) -> str:
        title = self.draw.choice(["<h1>{}</h1>", "<h1>{}</h1>", "<h2>{}</h2>", "<header><h1>{}</h1></header>", ""]).format(
            self.draw.choice([self.words(2, 9), self.sentence()]))
        byline = f"<p>{self.words(2, 5)}</p>" * self.chance(0.15) + f"<time>{self.words(1, 3)}</time>" * self.chance(0.1)
        body = []
        for _ in self.some(1, self.draw.choice([2, 6, 15])):
            body.append(self.paragraph())
            if self.chance(0.12):
                body.append(self.extra())
            if self.chance(0.06):
                body.append(self.aside_of_main())
        if self.chance(0.1):
            body.append(f'<footer {MARK}="no">{self.words(2, 9)}</footer>')
        text = self.break_.join(body)
        if self.chance(0.25):
            text = f"<div{self.name('main')}>{text}</div>"
        inside = title + byline + text
        if self.chance(0.15):
            inside += self.comments().replace(">", f' {MARK}="no">', 1)
        tag = self.draw.choice("article article article main div div section td".split())
        return f'<{tag}{self.name("main", tag == "div")} {MARK}="yes">{inside}</{tag}>{self.break_}'

    def page(self) -> str:
        before = [self.site_header()] * self.chance(0.5) + [self.menu()] * self.chance(0.6) + [self.notice()] * self.chance(0.25)
        before += [self.advert()] * self.chance(0.5) + [self.form()] * self.chance(0.1)
        self.draw.shuffle(before)
        middle = [self.main_text()] if not self.chance(0.04) else [self.related() for _ in self.some(1, 4)]
        if self.chance(0.35):
            middle.insert(self.draw.randint(0, 1), self.sidebar())
        after = [self.share()] * self.chance(0.15) + [self.related()] * self.chance(0.25) + [self.comments()] * self.chance(0.35)
        after += [self.advert()] * self.chance(0.2) + [self.form()] * self.chance(0.1)
        inner = "".join(middle) + "".join(after)
        if middle[0].startswith("<td"):
            inner = f"<table><tr>{inner}</table>"
        elif self.chance(0.5):
            inner = self.box("div div main", "main", inner)
        whole = "".join(before) + inner + self.footer() * self.chance(0.8) + self.notice() * self.chance(0.1)
        if self.chance(0.3):
            whole = f"<div{self.name('main')}>{whole}</div>"
        head = f"<head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style></head>"
        return f"<!DOCTYPE html><html>{head}<body>{whole}{'</body></html>' if self.chance(0.9) else ''}"


def labelled_pages(sentences: list[str], n: int, seed: int = 13) -> list[str]:
    """``n`` labelled pages with these sentences, the same for the same ``seed``."""
    draw = random.Random(seed)
    pool = [*sentences, *FALLBACK]
    return [_Writer(pool, draw).page() for _ in range(n)]
