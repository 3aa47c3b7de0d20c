"""Labelled pages. ``data-y`` says whether a node is main text; it holds for all below it.

``{L}``, ``{M}``, ``{S}`` stand for texts of several sentences, of one sentence and of some words,
``{N}`` for a list of links.
"""

LONG = (
    "The council met on Tuesday and spoke about the harbour for three hours. Nobody left early, which is rare. "
    "In the end the members agreed on a plan that keeps the old walls, moves the market to the north side and "
    "gives the boats more room. Work begins in spring, and most of it should be done before the first ships come."
)
MIDDLE = "She walked along the river until the light was gone, then turned back."
SHORT = "Quiet days by the sea"
LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Culture", "About"))

_PAGES = [
    # plain article with a menu, an advert before it and a foot line
    '<body><nav><ul>{N}</ul></nav><div class="ad">{M}</div><article data-y="1"><h1>{S}</h1><p>{L}</p><p>{M}</p>'
    "<p>{L}</p><p>{S}.</p></article><footer>&copy; site &middot; {M}</footer></body>",
    '<body><nav><ul>{N}</ul></nav><div class="ad">{S}. {S}.</div><article data-y="1"><h1>{M}</h1><p><b>{M}<br></p>'
    "<p>{M}</p><p>{S}</p><ul><li>{M}</li><li>{S}</li></ul><p>{L}</p></article><footer>&copy; {L}</footer></body>",
    # header, sidebar, notices and comments around and inside the article
    '<body><header id="top"><a href="/">{S}</a><nav><a href="/a">{S}</a></nav></header><div class="cookie-notice"><p>{M}</p>'
    '<button>OK</button></div><main><article data-y="1"><header><h1>{S}</h1></header><p>{L}</p><blockquote><p>{M}</p>'
    '</blockquote><aside data-y="0" class="related"><h3>{S}</h3><ul>{N}</ul></aside><p>{L}</p><pre>{M}</pre>'
    '<div data-y="0" class="ad-slot">{M}</div><p>{M}</p><table><tr><th>{S}</th><td>{S}</td></tr><tr><td>{M}</td></tr></table>'
    '<footer data-y="0"><p>{M}</p></footer></article><section id="comments"><h2>{S}</h2><div class="comment"><p>{L}</p></div>'
    '<div class="comment"><p>{M}</p></div><form><label>{S}</label></form></section></main><aside class="sidebar"><p>{L}</p>'
    "<ul>{N}</ul></aside><footer><ul>{N}</ul><p>{M}</p></footer></body>",
    # no article element, only named boxes
    '<body><div id="header"><h2>{S}</h2><ul class="menu">{N}</ul></div><div id="wrapper"><div class="sidebar"><h3>{S}</h3>'
    '<p>{M}</p><ul>{N}</ul></div><div data-y="1" class="post-content"><h1>{S}</h1><p>{L}</p><h2>{S}</h2><p>{M}</p><p>{L}</p>'
    '<ol><li>{M}</li><li>{M}</li></ol><div data-y="0" class="share-buttons"><a href="#">{S}</a></div></div>'
    '<div class="comments"><div class="comment-body">{L}</div><p>{M}</p></div></div><div id="footer"><p>{M}</p></div></body>',
    # boxes without names
    '<body><div><ul>{N}</ul></div><div data-y="1"><h1>{S}</h1><p>{L}</p><p>{L}</p><p>{M}</p></div><div><a href="/a">{S}</a> '
    '<a href="/b">{S}</a></div></body>',
    '<body><div data-y="1"><h1>{S}</h1><div>{L}</div><div>{M}</div><div>{L}</div></div><div><ul>{N}</ul></div></body>',
    '<body data-y="1"><h1>{S}</h1><p>{L}</p><p>{M}</p><p>{L}</p></body>',
    # running text without any element, and cut by line breaks alone
    '<body data-y="1">{L} {L}</body>',
    '<body data-y="1">{S}<br>{L}<br><br>{M} {L}</body>',
    # main without article, adverts, sign-up and search forms
    '<body><header><p>{S}</p><form role="search"><label>{S}</label></form></header><div class="banner notice"><p>{L}</p></div>'
    '<main data-y="1"><h1>{S}</h1><p>{L}</p><figure><figcaption>{M}</figcaption></figure><p>{M}</p><div data-y="0" '
    'class="advertisement"><p>{L}</p></div><p>{L}</p><form data-y="0" class="newsletter"><p>{M}</p></form><h3>{S}</h3><p>{M}</p>'
    '<dl><dt>{S}</dt><dd>{M}</dd></dl><nav data-y="0"><ul>{N}</ul></nav></main><div class="promo"><p>{M}</p></div>'
    '<footer class="site-footer"><p>{L}</p></footer></body>',
    '<body><div class="header"><p>{M}</p></div><div class="content"><div data-y="1" class="article-body"><h1>{S}</h1><p>{L}</p>'
    '<section><h2>{S}</h2><p>{L}</p><p>{S}</p></section></div><div class="sponsored"><p>{M}</p></div><ul class="related">{N}</ul>'
    '<div id="disqus_thread" class="reader-comments"><p>{L}</p><p>{M}</p><p>{L}</p></div></div><div class="alert">{M}</div></body>',
    '<body><aside><p>{L}</p><p>{M}</p></aside><article data-y="1"><h1>{S}</h1><div class="body"><p>{L}</p><p>{M}</p></div>'
    '<section data-y="0" class="comments"><h2>{S}</h2><article class="comment"><p>{L}</p></article><article class="comment">'
    '<p>{M}</p></article></section></article><div role="alert"><p>{M}</p></div></body>',
    '<body><div class="popup modal"><p>{L}</p></div><div class="breadcrumb"><a href="/">{S}</a></div><section data-y="1" '
    'class="story"><h1>{S}</h1><p>{M}</p><p>{L}</p><p>{M}</p><p>{M}</p></section><section class="comment-list"><ul><li><p>{L}</p>'
    "</li><li><p>{M}</p></li></ul></section><footer><p>{L}</p><p>{M}</p></footer></body>",
]

FILL = {"{L}": LONG, "{M}": MIDDLE, "{S}": SHORT, "{N}": LINKS}


# The same page with a box of each name inside and beside the main text.
_BOX = (
    '<body><nav><div><ul>{N}</ul></div></nav><div class="%s"><div><p>{L}</p><div>{M}</div></div></div><article data-y="1">'
    '<h1>{S}</h1><p>{L}</p><div><p>{M}</p></div><div data-y="0" class="%s"><div><h3>{S}</h3><p>{M}</p></div></div><p>{L}</p>'
    '</article><div class="%s">{L}</div><footer><div><p>{L}</p><div>{S}</div></div></footer></body>'
)
_NAMED = '<body><ul>{N}</ul><div data-y="1" class="%s"><h1>{S}</h1><p>{L}</p><p>{M}</p><p>{L}</p></div><footer>{M}</footer></body>'


def labelled_pages(names):
    """The labelled pages as HTML. ``names`` holds words for each kind of box, ``content`` for main text."""
    pages = []
    boxes = [_BOX % ((w,) * 3) for kind, words in names.items() if kind != "content" for w in words.split()]
    for page in [*_PAGES * 4, *boxes, *[_NAMED % w for w in names["content"].split()]]:
        for mark, text in FILL.items():
            page = page.replace(mark, text)
        pages.append(f"<html>{page}</html>")
    return pages
