"""Labelled pages for the block model of ``html_extract``.

A few pages written by hand, and a writer that puts further ones together from
sentences in five languages, frames around the main text, and furniture (the
parts of a page that are not its main text) under many names.  An element with ``data-main`` (and all below it)
holds main text, one with ``data-rest`` (and all below it) does not; without
either, text is not main.  The model never sees these two attributes.
"""

import random

LOREM = ("The committee met on Tuesday to review the proposal, and several members asked for more time. "
         "A decision is expected next month, after the figures have been checked again.")
SHORT = "Rain is likely in the north."
LONG = LOREM + " " + LOREM + " Nothing in the report suggests that costs will rise before the end of the year."

SITE_TOP = ('<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li>'
            '<li><a href="/about">About us</a></li><li><a href="/x">Contact</a></li></ul></nav>')
SITE_END = '<footer>&copy; 2020 Example &middot; All rights reserved. Some words about the publisher.</footer>'
ADVERT = '<div class="ad">Buy two and get one free, today only in every shop of the town.</div>'

LABELLED_PAGES = [
    # a plain article between navigation, an advert and a footer
    f'<html><head><title>x</title></head><body>{SITE_TOP}{ADVERT}<article data-main><h1>Committee meets</h1>'
    f'<p><b>{LOREM}<br><p>{LONG}</p><p>{SHORT}</p></article>{SITE_END}</body></html>',
    f'<body>{SITE_TOP}<div class="ad">{SHORT}</div><article data-main><h1>Rain</h1><p>{SHORT}<p>{SHORT}</p>'
    f'<p>See <a href="/more">the full report</a> for more.</p><ul><li>{SHORT}</li><li>{SHORT}</li></ul></article>'
    f'<footer>&copy; a.example &middot; {LOREM}</footer>',
    # long footers and adverts, short articles
    f'<body>{SITE_TOP}<div class="ad">{LONG}</div><article data-main><h1>Short</h1><p>One line.</p></article>'
    f'<footer>{LONG}</footer></body>',
    f'<body>{SITE_TOP}<!-- ad 7 --><div class="ad">{SHORT}\n{SHORT}</div><article data-main><h1>Licence</h1><p>{LOREM}</p>'
    f'<p>Released under the MIT License.</p><p>{SHORT}</p></article><footer>&copy; b.example &middot; {SHORT}</footer>',
    # main, sections, and a page header
    f'<body><header><h2>Example Daily</h2><p>{SHORT}</p></header>{SITE_TOP}<main data-main><h1>Title</h1>'
    f'<section><h2>Part one</h2><p>{LOREM}</p></section><section><h2>Part two</h2><p>{LONG}</p>'
    f'<blockquote>{SHORT}</blockquote></section></main><aside><h3>Related</h3><ul><li><a href="/1">Another story</a></li>'
    f'<li><a href="/2">A third story</a></li></ul><p>{LOREM}</p></aside>{SITE_END}</body>',
    # content by class, sidebars, comments, notices
    f'<body><div id="header"><a href="/">Example</a></div><div class="menu"><a href="/a">One</a> <a href="/b">Two</a></div>'
    f'<div class="cookie-notice">We use cookies to improve this site. {LOREM} <button>Accept</button></div>'
    f'<div id="content" class="post"><h1 data-main>A post</h1><p data-main>{LONG}</p><p data-main>{SHORT}</p>'
    f'<div class="share"><a href="/s">Share</a> <a href="/t">Print</a></div></div>'
    f'<div class="sidebar"><h3>Popular</h3><p>{LOREM}</p><ul><li><a href="/q">Most read</a></li></ul></div>'
    f'<div class="comments"><h3>3 comments</h3><div class="comment"><p>{LOREM}</p></div>'
    f'<div class="comment"><p>{SHORT}</p></div></div><div class="footer">Imprint {SHORT}</div></body>',
    # comments, forms and adverts inside the article
    f'<body>{SITE_TOP}<article><div data-main><h1>Inside</h1><p>{LOREM}</p></div><div class="advert">{LOREM}</div>'
    f'<p data-main>{LONG}</p><form><label>Your e-mail</label><p>{SHORT}</p><button>Subscribe</button></form>'
    f'<section class="comments"><h2>Comments</h2><p>{LOREM}</p><p>{SHORT}</p></section></article>{SITE_END}</body>',
    f'<body><nav class="breadcrumb"><a href="/">Home</a> &gt; <a href="/n">News</a></nav><article class="entry" data-main>'
    f'<header><h1>With a header</h1></header><p>{LONG}</p><table><tr><td>1</td><td>{SHORT}</td></tr></table>'
    f'<aside class="related" data-rest><p>{SHORT}</p></aside><div class="ad" data-rest>{SHORT}</div><p>{LOREM}</p>'
    f'<div class="newsletter" data-rest><p>{LOREM}</p></div><footer data-rest><p>Filed under news. {SHORT}</p></footer></article>'
    f'<div id="disqus" class="reader-comments"><p>{LONG}</p></div>{SITE_END}</body>',
    # no marked container at all
    f'<body>{SITE_TOP}<h1 data-main>Bare page</h1><p data-main>{LONG}</p><p data-main>{LOREM}</p><p data-main>{LONG}</p>'
    f'<div class="banner">{SHORT}</div><p data-main>{LOREM}</p>{SITE_END}</body>',
    f'<body><div><a href="/">Home</a> | <a href="/x">Index</a> | <a href="/y">Login</a></div><div><p data-main>{LONG}</p>'
    f'<p data-main>{LONG}</p><p data-main>{LOREM}</p></div><div class="notice" role="alert">{LOREM}</div>'
    f'<div><a href="/p">Previous</a> <a href="/q">Next</a></div><p>&copy; 2019 Example</p></body>',
    f'<body><div role="navigation"><ul><li><a href="/">Start</a></li><li>Archive</li></ul></div>'
    f'<div role="main" data-main><h2>By role</h2><p>{LOREM}</p><pre>{SHORT}</pre></div>'
    f'<div role="complementary"><p>{LONG}</p></div><div role="contentinfo">{SHORT}</div></body>',
    # nothing but furniture
    f'<body>{SITE_TOP}{ADVERT}<form><p>{SHORT}</p></form><aside>{LOREM}</aside>{SITE_END}</body>',
]

# Words by which pages name what is not their main text, by kind, in the languages of the training pages.
FURNITURE = {
    "advert": """ad ads advert adverts advertisement advertising adslot adunit banner promo promos promotion promoted
sponsor sponsored sponsoring teaser werbung anzeige anzeigen publicite publicidad anuncio anuncios pubblicita reclame""",
    "comments": """comment comments commentary disqus discussion discussions replies reply respond responses thread feedback
kommentar kommentare commentaires comentarios commenti reacties""",
    "navigation": """nav navigation navbar menu menus submenu breadcrumb breadcrumbs pagination pager paging sitemap toc skip
topbar navi navigazione navegacion""",
    "notice": """notice notices cookie cookies consent gdpr ccpa privacy alert alerts popup modal overlay paywall disclaimer
hinweis avis aviso avviso""",
    "related": """related recommended recommendations more popular trending mostread similar widget widgets sidebar rail
outbrain taboola aside complementary seitenleiste similaires relacionados correlati""",
    "form": """form forms newsletter subscribe subscription signup login search register suche recherche buscar cerca""",
    "share": """share sharing social socials follow tools toolbar teilen partager compartir condividi""",
    "footer": """footer foot copyright imprint impressum contentinfo colophon legal pied fusszeile""",
    "header": """masthead header logo branding sitename banniere kopfzeile cabecera testata""",
}
KIND_OF = {w: kind for kind, words in FURNITURE.items() for w in words.split()}
# Words by which pages name their main text.
CONTENT = frozenset("""article articlebody body content entry main maincontent post story text beitrag inhalt contenu contenido
contenuto artikel nota cuerpo""".split())

TEXTS = {
    "en": """The council approved the new timetable after a long debate. | Engineers found the crack during a routine inspection. |
She had written three novels before the war began. | Prices rose by four percent in the first quarter. | The road will stay closed
until repairs are finished, officials said. | None of the witnesses could describe the driver. | Heat the oil, add the onions and stir
until they are soft. | The museum owns more than two thousand drawings. | Why did nobody notice the error earlier? | A small team
keeps the lighthouse running""",
    "de": """Der Rat stimmte dem neuen Fahrplan nach langer Debatte zu. | Fachleute fanden den Riss bei einer Kontrolle. | Sie hatte
schon drei Romane geschrieben, bevor der Krieg begann. | Die Preise stiegen im ersten Quartal um vier Prozent. | Die Straße bleibt
gesperrt, bis alles repariert ist. | Niemand konnte den Fahrer beschreiben. | Das Museum besitzt mehr als zweitausend Zeichnungen. |
Warum fiel der Fehler niemandem auf?""",
    "fr": """Le conseil a approuvé le nouvel horaire après un long débat. | Des ingénieurs ont trouvé la fissure pendant un contrôle. |
Elle avait écrit trois romans avant le début de la guerre. | Les prix ont augmenté de quatre pour cent. | La route restera fermée
jusqu'à la fin des travaux. | Aucun témoin n'a pu décrire le conducteur. | Le musée possède plus de deux mille dessins.""",
    "es": """El consejo aprobó el nuevo horario tras un largo debate. | Los ingenieros hallaron la grieta en una inspección. | Había
escrito tres novelas antes de la guerra. | Los precios subieron un cuatro por ciento. | La carretera seguirá cerrada hasta el final de
las obras. | Ningún testigo pudo describir al conductor. | El museo posee más de dos mil dibujos.""",
    "it": """Il consiglio ha approvato il nuovo orario dopo un lungo dibattito. | Gli ingegneri hanno trovato la crepa durante un
controllo. | Aveva scritto tre romanzi prima della guerra. | I prezzi sono aumentati del quattro per cento. | La strada resterà chiusa
fino alla fine dei lavori. | Nessuno ha saputo descrivere l'autista.""",
}
LABELS = "Home News Sport Archive Contact Start Kontakt Accueil Inicio Temi 2 3 Login".split()
# how a page may hold its main text: the elements around it
FRAMES = ["article", "main", "main|article", 'div id="{c}"', 'div class="{c}"', 'div class="page"|div class="{c}-body"', "",
          'article class="{c}"|section', 'table|tr|td', 'div|div class="{c}"', 'section id="{c}"', 'div role="main"',
          'div class="wrap"|main id="{c}"|article']


def opened(frame: str) -> tuple[str, str]:
    parts = [p for p in frame.split("|") if p]
    return "".join(f"<{p}>" for p in parts), "".join(f"</{p.split()[0]}>" for p in reversed(parts))


class Writer:
    """Pages put together by rule from sentences, frames and furniture, each with its labels."""

    def __init__(self, rng: random.Random, names: dict[str, list[str]]):
        self.rng, self.names = rng, names
        self.texts = [" ".join(s.split()) for s in rng.choice(list(TEXTS.values())).split("|")]

    def text(self, n: int = 0) -> str:
        return " ".join(self.rng.choice(self.texts) for _ in range(n or self.rng.choice((1, 1, 2, 3, 5))))

    def links(self, n: int) -> str:
        item = '<li><a href="/x">{}</a></li>' if self.rng.random() < 0.6 else '<a href="/y">{}</a> '
        inner = "".join(item.format(self.rng.choice(LABELS + self.texts)) for _ in range(n))
        return f"<ul>{inner}</ul>" if item.startswith("<li") else f"<p>{inner}</p>"

    def paragraph(self) -> str:
        r, t = self.rng.random(), self.text()
        if r < 0.7:
            return f"<p>{t}</p>"
        if r < 0.78:
            return f'<p>{t} <a href="/z">{self.text(1)}</a> {self.text(1)}</p>'
        if r < 0.84:
            return f"<h2>{self.text(1).rstrip('.')}</h2><p>{t}</p>"
        if r < 0.90:
            return f"<ul><li>{t}</li><li>{self.text(1)}</li></ul>"
        if r < 0.94:
            return f"<blockquote><p>{t}</p></blockquote>"
        if r < 0.97:
            return f"<table><tr><td>{self.rng.randint(1, 99)}</td><td>{t}</td></tr></table>"
        return f"<figure><figcaption>{t}</figcaption></figure><pre>{self.text(1)}</pre>"

    def body_of(self, kind: str) -> str:
        some = f"<p>{self.text()}</p>"
        links = self.links(self.rng.randint(2, 6)) if self.rng.random() < 0.8 else some
        return {"advert": some, "notice": f"<p>{self.text()}</p><button>OK</button>", "navigation": links,
                "comments": "".join(f'<div><b>{self.rng.choice("ABCDE")}.</b><p>{self.text()}</p></div>'
                                    for _ in range(self.rng.randint(1, 4))),
                "related": f"<h3>{self.text(1)}</h3>{self.links(2)}{some}", "form": f"<label>E-mail</label>{some}<button>OK</button>",
                "share": self.links(2), "footer": f"<p>&copy; 2021 Example. {self.text(1)}</p>", "header": f"<h2>Example</h2>{some}"}[kind]

    def furniture(self, kind: str) -> str:
        tag = {"navigation": "nav", "related": "aside", "form": "form", "footer": "footer", "header": "header"}.get(kind)
        inner = self.body_of(kind)
        if tag and self.rng.random() < 0.5:
            return f"<{tag} data-rest>{inner}</{tag}>"
        name = self.rng.choice(self.names[kind])
        name = self.rng.choice((name, f"{name}-box", f"site-{name}", f"{name}_1", name.capitalize() + "Block"))
        key = self.rng.choice(("class", "class", "id"))
        tag = self.rng.choice(("div", "div", "section"))
        return f'<{tag} {key}="{name}" data-rest>{inner}</{tag}>'

    def page(self) -> str:
        rng = self.rng
        begin, end = opened(rng.choice(FRAMES).replace("{c}", rng.choice(self.names["content"])))
        inside = [f"<h1 data-main>{self.text(1)}</h1>"]
        for _ in range(rng.randint(2, 7)):
            inside.append(f"<div data-main>{self.paragraph()}</div>" if not begin else self.paragraph())
            if begin and rng.random() < 0.25:
                inside.append(self.furniture(rng.choice(("advert", "related", "form", "share", "comments", "notice", "navigation",
                                                          "footer", "advert"))))
        if begin:
            cut = begin.rindex(">")
            begin = begin[:cut] + " data-main" + begin[cut:]
        top = [self.furniture(k) for k in ("header", "navigation", "notice", "advert") if rng.random() < 0.6]
        tail = [self.furniture(k) for k in ("share", "comments", "related", "form", "advert", "navigation", "notice") if rng.random() < 0.35]
        rng.shuffle(tail)
        foot = [self.furniture("footer")] if rng.random() < 0.8 else []
        return f"<html><body>{''.join(top)}{begin}{''.join(inside)}{end}{''.join(tail + foot)}</body></html>"


def written_pages(n: int, seed: int = 3, part: int = 0) -> list[str]:
    """``n`` pages whose names are every other word of the lists: those of an
    even place (``part`` 0, for training) or of an odd one (1, for tests)."""
    names = {k: w.split()[part::2] for k, w in FURNITURE.items()} | {"content": sorted(CONTENT)[part::2]}
    rng = random.Random(seed)
    return [Writer(rng, names).page() for _ in range(n)]
