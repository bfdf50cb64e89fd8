"""Elements that are left out end where HTML ends them."""

import pytest

from marquee.llm import html_extract, html_pages


@pytest.mark.parametrize("page, want", [
    # an svg that closes itself, also by attribute values with a slash
    ('<p>a<svg class="icon"/>b</p><p>c</p>', ["a b", "c"]),
    ("<p>a<svg/></p><p>b<svg />c</p><p>d<svg><path d='M0 0'/></svg>e</p>", ["a", "b c", "d e"]),
    # nested ones, their titles and HTML inside
    ("<p>a<svg><svg><text>x</text></svg><text>y</text></svg>b</p>", ["a b"]),
    ("<p>a<svg><title>t</title><desc>u</desc><title/><g/>v</svg>b</p>", ["a b"]),
    ("<p>a<svg><foreignObject><div><p>x</div></foreignObject>y</svg>b</p>", ["a b"]),
    ("<p>a<svg><style/><style>p{}</style><script/>x</svg>b</p>", ["a b"]),
    # left open: ended by the next HTML element or by the end of the block around it
    ("<div>a<svg><path><p>b</p><p>c</div>d", ["a", "b", "c", "d"]),
    ("<article><p>a<svg><text>x</p><p>b</p></article>c", ["a", "b", "c"]),
    ("<div>a<button>x</div><p>b</p>", ["a", "b"]),
    ("<article>a<button>x<p>b</p><p>c</p></article>", ["a", "b", "c"]),
    ("<article>a<button>x<p>b</p><button>y</button>c</article>", ["a", "b", "c"]),
    ("<div>a<select><option>x</div>b", ["a", "b"]),
    ("<div>a<template><p>x</div>b<noscript>y", ["a", "b"]),
    ("<div>a<noscript><img></div>b", ["a", "b"]),
    ("<p>a<iframe src='x'>b</p><p>c<textarea>d", ["a b", "c d"]),
    # well closed controls: their blocks are theirs
    ("<p>a<button><div>x</div><svg><path/></svg></button>b</p>", ["a b"]),
    ("<p>a<select><optgroup><option>x<option>y</select>b", ["a b"]),
    ("<div>a<template><div>x</div><template>y</template>z</template>b</div>", ["a b"]),
    ("<p>a<iframe><p>x</iframe>b<textarea><p>y</textarea>c", ["a b c"]),
    # text in math and object is text, open or closed
    ("<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds<math/>.</p>", ["if x=1 holds."]),
    ("<p>see <object data=x>the <object>inner</object> figure</object> here</p>", ["see the inner figure here"]),
    ("<p>a <object>b</p><p>c <math><mi>d</p><p>e</p>", ["a b", "c d", "e"]),
    ("<a href=x>l<svg></svg>k</a></button></svg> m", ["l k m"]),
])
def test_blocks_of_left_out_elements(page, want):
    assert [b.text for b in html_extract.blocks(page)] == want


def test_an_article_with_figures_is_kept_whole():
    line = "The committee met on Tuesday to review the proposal, and several members asked for more time."
    page = (f'<body><nav><a href="/">Home</a></nav><article><h1>Title</h1><p>{line}<svg class="i"/></p><p>{line}</p>'
            f'<p>So <math><mi>x</mi></math> is large.<button>Share</p><p>{line}</p></article><footer>&copy; x</footer>')
    assert html_extract.train().text(page) == f"Title\n{line}\n{line}\nSo x is large.\n{line}"


LINE = "The committee met on Tuesday to review the proposal, and several members asked for more time."


@pytest.fixture(scope="module")
def model():
    return html_extract.train()


@pytest.mark.parametrize("part", [
    "<aside><p>{}</p></aside>", "<form><p>{}</p></form>", '<div class="promo"><p>{}</p></div>',
    '<div class="sponsored-content"><p>{}</p></div>', '<div id="discussion"><p>{}</p></div>', '<section class="userComments"><p>{}</p></section>',
    '<div id="gdpr-consent"><p>{}</p></div>', '<div class="widget"><p>{}</p></div>', '<div class="werbung">{}</div>',
    "<nav><p>{}</p></nav>", "<footer><p>{}</p></footer>", '<div class="newsletter-signup"><p>{}</p></div>'])
def test_furniture_is_left_out_wherever_it_stands(model, part):
    x = part.format("Buy two today, and get one free in every shop of the town.")
    body = f"<h1>Title</h1><p>{LINE}</p><p>{LINE}</p>"
    want = f"Title\n{LINE}\n{LINE}"
    assert model.text(f"<body>{x}<article>{body}</article></body>") == want
    assert model.text(f"<body><article>{body}</article>{x}</body>") == want
    assert model.text(f"<body><article>{body}{x}<p>{LINE}</p></article></body>") == f"{want}\n{LINE}"


@pytest.mark.parametrize("page, want", [
    ('<body><div class="masthead"><a href="/">The Paper</a></div><div class="story-body"><h1>Flood</h1><p>Water rose overnight &amp; fell.'
     '</p><p>Nobody was\n hurt.</p><ul class="share-tools"><li><a href="#">Post</a></li></ul></div><div class="reader-comments">'
     '<p>Bob: I saw it from my window and it was high.</p></div><div class="colophon">&copy; The Paper</div></body>',
     "Flood\nWater rose overnight & fell.\nNobody was hurt."),
    ('<body><header><h2>Blatt</h2></header><main id="inhalt"><h1>Brand</h1><p>Das Haus brannte die ganze Nacht.</p><div class="anzeigen">'
     '<p>Jetzt kaufen und sparen.</p></div><p>Die Ursache ist nicht bekannt.</p></main><footer>Impressum</footer></body>',
     "Brand\nDas Haus brannte die ganze Nacht.\nDie Ursache ist nicht bekannt."),
    ("<body><nav><a href='/'>Home</a></nav><article><header><h1>With header</h1></header><p>One paragraph of text.</p>"
     "<figure><figcaption>A map of the town.</figcaption></figure></article></body>",
     "With header\nOne paragraph of text.\nA map of the town."),
    ("<body><div class='cookies'>We use them. <button>OK</button></div><form><p>Your e-mail</p></form></body>", ""),
])
def test_texts_written_by_hand(model, page, want):
    assert model.text(page) == want


def share_right(model, pages):
    pairs = [(y, html_extract.marked(b)) for p in pages for f in [html_extract.blocks(p)] for b, y in zip(f, model.decode(f))]
    return sum(a == b for a, b in pairs) / len(pairs), len(pairs)


def test_names_left_out_of_training(model):
    right, n = share_right(model, html_pages.written_pages(150, seed=77, part=1))
    assert n > 2000 and right > 0.95


def test_frames_left_out_of_training(monkeypatch):
    """Trained without every third frame, tested on those frames and on the other names."""
    frames = html_pages.FRAMES
    monkeypatch.setattr(html_pages, "FRAMES", [f for k, f in enumerate(frames) if k % 3])
    m = html_extract.train(html_pages.LABELLED_PAGES + html_pages.written_pages(150))
    monkeypatch.setattr(html_pages, "FRAMES", frames[::3])
    right, n = share_right(m, html_pages.written_pages(120, seed=5, part=1))
    assert n > 1500 and right > 0.95


def test_every_kind_of_furniture_is_trained():
    from collections import Counter
    found = Counter()
    for page in html_pages.written_pages(html_extract.WRITTEN):
        for b in html_extract.blocks(page):
            if not html_extract.marked(b):
                found.update({s for e in b.path for s in html_extract.sense(e)} & set(html_pages.FURNITURE))
    assert set(found) == set(html_pages.FURNITURE) and min(found.values()) >= 30 and sum(found.values()) > 1000
