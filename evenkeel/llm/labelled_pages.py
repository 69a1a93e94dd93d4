"""Labelled pages to train on: layouts in which comments mark the content.

The layouts are those of plain web pages; texts are drawn from a few words, since
only their lengths, links and places tell anything.
"""

from __future__ import annotations

import random

WORDS = ("river stone market letter window garden paper bridge winter music doctor silver "
         "station report village summer engine teacher question morning").split()

# Names that elements around the content have, and names of content. Both are drawn, with
# others that mean nothing, so that no layout depends on one name.
AROUND = ("cookie consent gdpr privacy notice banner popup modal overlay sidebar widget promo sponsor advert ad "
          "related recommended share social newsletter subscribe signup footer legal copyright menu nav breadcrumb "
          "pagination toolbar login search comments replies respond alert header topbar").split()
CONTENT = "content entry post story text body page copy prose".split()

# {p} is a paragraph, {s} a short line, {l} list items with links, {c} list items without;
# {q} is a paragraph, {Q} paragraphs, {k} list items and {h} a line that may hold links.
# {B} is a name around the content, {N} one of content, one that means nothing, or none.
LAYOUTS = (
    '<nav><ul>{l}</ul></nav><div class="ad">{s}</div><!--main--><article><h1>{s}</h1>{P}</article>'
    '<!--/main--><footer>{s}</footer>',
    '<nav><ul>{l}</ul></nav><div class="ad">{p}</div><!--main--><article><h1>{s}</h1>'
    '<p><b>{s}<br><p>{p}</p>{P}</article><!--/main--><footer>{p}</footer>',
    '<header><a href="/">{s}</a><nav class="menu">{a}</nav></header><main><!--main--><article>'
    '<h1>{s}</h1>{P}<h2>{s}</h2>{P}</article><!--/main--></main>'
    '<aside class="sidebar"><h3>{s}</h3><ul>{l}</ul></aside><footer><p>{s}</p>{a}</footer>',
    '<div id="header"><h1><a href="/">{s}</a></h1></div><div id="menu"><ul>{l}</ul></div>'
    '<div id="content"><!--main--><div class="post"><h2>{s}</h2>{P}</div><!--/main--></div>'
    '<div id="sidebar"><div class="widget"><h4>{s}</h4><ul>{l}</ul></div></div>'
    '<div id="footer"><p>{s}</p></div>',
    '<div class="cookie notice banner"><p>{p}</p><button>{s}</button></div><nav>{a}</nav><!--main-->'
    '<article><header><h1>{s}</h1></header>{P}<blockquote><p>{p}</p></blockquote>{P}</article>'
    '<!--/main--><section class="comments"><h3>{s}</h3>{P}</section><footer>{s} {a}</footer>',
    '<div class="navbar">{a}</div><!--main--><div class="entry content"><h1>{s}</h1>{P}<ul>{c}</ul>{P}'
    '</div><!--/main--><form class="newsletter"><p>{s}</p><input><label>{s}</label></form>'
    '<div class="social share">{a}</div><div id="comments"><ol>{C}</ol></div>',
    '<table><tr><td class="nav menu">{a}<td class="main text"><!--main--><h1>{s}</h1>{P}<!--/main-->'
    '<tr><td class="footer">{s}</table>',
    '<div class="topbar header">{a}</div><div class="story body"><!--main--><h1>{s}</h1>{P}<!--/main-->'
    '</div><div class="related promo"><h3>{s}</h3><ul>{l}</ul></div><div class="advert">{p}</div>'
    '<div class="footer copyright">{s}</div>',
    '<nav class="breadcrumb">{a}</nav><!--main--><article><h1>{s}</h1><p>{p}</p></article><!--/main-->'
    '<div class="subscribe">{p}</div><aside>{p}</aside><footer>{s}</footer>',
    '<header class="site"><p>{s}</p></header><main id="main"><!--main--><h1>{s}</h1>{P}'
    '<figure><img><figcaption>{s}</figcaption></figure>{P}<pre>{p}</pre><table><tr><td>{s}<td>{s}</table>'
    '<!--/main--></main><div role="complementary"><ul>{l}</ul></div><footer><ul>{l}</ul></footer>',
    '<nav><ul>{l}</ul></nav><!--main--><article><h1>{s}</h1>{P}<!--/main--><aside class="related">{a}</aside>'
    '<!--main-->{P}</article><!--/main--><div class="comment list">{P}</div><footer>{p}</footer>',
    '<div class="alert notice">{p}</div><div class="search form"><form>{s}</form></div>'
    '<section class="article text"><!--main--><h1>{s}</h1>{P}<ol>{c}</ol><!--/main--></section>'
    '<section class="reader comments">{P}{P}</section><nav class="pagination">{a}</nav><footer>{s}</footer>',
    '<nav><ul>{l}</ul></nav><!--main--><article><h1>{s}</h1><p>{s}</p></article><!--/main--><footer>{s}</footer>',
    '<!--main--><article><p>{s}</p></article><!--/main-->',
    '<header><h1>{s}</h1><p>{s}</p></header><div class="wrap"><div><!--main--><article><div><div><p>{s}</p>'
    '</div></div></article><!--/main--></div><aside class="sidebar"><p>{p}</p></aside></div><footer><p>{p}</p>',
    '<header><h1>{s}</h1></header><div><div><!--main--><article><header><h1>{s}</h1></header><div><div>{P}'
    '<div>{P}</div></div></div></article><!--/main--></div></div><section class="comments"><div><p>{p}</p></div>',
    '<div class="{B}">{p}</div><nav>{a}</nav><div class="{N}"><!--main--><h1>{s}</h1>{Q}<ul>{k}</ul>{Q}<!--/main-->'
    '</div><div class="{B}"><ul>{l}</ul></div><div class="{B}">{s}</div>',
    '<header>{a}</header><!--main--><article><h1>{s}</h1>{Q}<h2>{h}</h2>{Q}<table><tr><td>{h}<td>{q}</table>'
    '<figure><img><figcaption>{q}</figcaption></figure></article><!--/main--><aside>{Q}</aside><footer>{q}</footer>',
    '<div id="{B}">{q}</div><div class="{N}"><div class="{N}"><!--main--><h2>{s}</h2>{Q}<ol>{k}</ol><blockquote>{Q}'
    '</blockquote><!--/main--></div></div><div class="{B}"><p>{q}</p></div><div id="{B}">{Q}</div>',
    '<nav><ul>{l}</ul></nav><section class="{N}"><!--main--><h1>{h}</h1>{Q}<dl><dt>{s}<dd>{q}</dl>{Q}<!--/main-->'
    '</section><section class="{B}"><h3>{s}</h3>{Q}</section><footer>{s}{a}</footer>',
    '<!--main--><article><h1>{s}</h1>{Q}<p>{q}</p><ul>{k}</ul></article><!--/main--><footer>{q}</footer>',
    '<div class="{B}">{a}</div><main><!--main--><h1>{s}</h1>{Q}<h3>{h}</h3><p>{q}</p><!--/main--></main>'
    '<div class="{B}">{q}</div>',
    '<section class="{N}"><!--main--><p>{q}</p>{Q}<table><tr><th>{s}<th>{s}<tr><td>{h}<td>{s}</table><!--/main--></section>'
    '<div class="{B}"><p>{s}</p><button>{s}</button></div><div class="{B}">{Q}</div>',
)


def pages(each: int = 15, seed: int = 11) -> list[str]:
    draw = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join(draw.choices(WORDS, k=draw.randint(low, high)))

    def sentence(low: int, high: int) -> str:
        return words(low, high).capitalize() + draw.choice((".", ".", ".", "", "?"))

    def links(wrap: str) -> str:
        return "".join(wrap.format(f'<a href="/x">{words(1, 3)}</a>') for _ in range(draw.randint(2, 8)))

    def linked(low: int, high: int) -> str:
        """A sentence; now and then some of its words are a link."""
        said = sentence(low, high).split(" ")
        if draw.random() < 0.6:
            at = draw.choice((0, draw.randrange(len(said))))
            stop = at + draw.randint(1, 4)
            said[at:stop] = [f'<a href="/x">{" ".join(said[at:stop])}</a>']
        return " ".join(said)

    def paragraph() -> str:
        return " ".join(linked(2, 25) for _ in range(draw.randint(1, 5)))

    fill = {
        "{B}": lambda: " ".join(draw.sample(AROUND, draw.randint(1, 2))),
        "{N}": lambda: draw.choice((draw.choice(CONTENT), "".join(draw.choices("bdglmnrst", k=5)), "")),
        "{q}": paragraph,
        "{Q}": lambda: "".join(f"<p>{paragraph()}</p>" for _ in range(draw.randint(1, 6))),
        "{k}": lambda: "".join(f"<li>{linked(3, 20)}</li>" for _ in range(draw.randint(2, 6))),
        "{h}": lambda: linked(2, 8),
        "{p}": lambda: " ".join(sentence(1, 25) for _ in range(draw.randint(1, 6))),
        "{s}": lambda: sentence(1, 9),
        "{P}": lambda: "".join(f"<p>{' '.join(sentence(1, 25) for _ in range(draw.randint(1, 6)))}</p>"
                               for _ in range(draw.randint(1, 7))),
        "{l}": lambda: links("<li>{}</li>"),
        "{a}": lambda: links("{} "),
        "{c}": lambda: "".join(f"<li>{sentence(2, 20)}</li>" for _ in range(draw.randint(2, 6))),
        "{C}": lambda: "".join(f'<li class="comment"><p>{sentence(3, 40)}</p></li>'
                               for _ in range(draw.randint(1, 6))),
    }
    made = []
    for layout in LAYOUTS:
        for _ in range(each):
            page = layout
            for mark, text in fill.items():
                while mark in page:
                    page = page.replace(mark, text(), 1)
            made.append(f"<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style></head>"
                        f"<body>{page}</body></html>")
    return made
