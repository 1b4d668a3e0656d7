"""HTML extraction: content and boilerplate blocks separated by a minimum cut.

Each text block has a cost of being called content and one of being called boilerplate, from a logistic classifier over
structural and text features that is trained on labelled pages (see labelled_pages); these are the capacities to the
terminals. Edges join neighbours in page order and the blocks of one container, also across container borders, the weaker
the farther they are apart in the tree. The source side of a minimum cut is the content.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[^\W\d_]+")
CLASS_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: Code, or what a browser with scripts doesn't show: ends only at its own end tag.
RAW = frozenset("script style noscript template iframe noembed noframes xmp".split())
RCDATA = frozenset("title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label "
    "legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
#: An open p ends where one of these begins.
ENDS_P = BLOCK - frozenset("button label legend option optgroup caption td th tr tbody thead tfoot".split())
P_SCOPE = ("button", "table", "article", "section", "div", "td", "li", "form")
#: These end where one of their own kind begins, inside the same container.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
CONTAINERS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
TABLE_TAGS = frozenset("table tbody thead tfoot tr td th".split())
INLINE = frozenset(
    "a abbr audio b bdi bdo big canvas cite code data del dfn em font i ins kbd mark math mfrac mi mn mo mover mrow msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover object output picture "
    "q rp rt ruby s samp semantics small span strike strong sub sup svg text time tspan tt u var video".split()
)

#: What an element's tag, role, style, class or id may say of it. Each is one bit of Node.signs; none decides by itself.
NAV, HEADER, FOOTER, ASIDE, FORM, CONTROL, HIDDEN, ARTICLE, NOT_NAMED, NAMED = (1 << k for k in range(10))
TAG_SIGNS = {"nav": NAV, "menu": NAV, "search": FORM, "header": HEADER, "footer": FOOTER, "aside": ASIDE, "form": FORM, "dialog": HIDDEN, "head": HIDDEN, "title": HIDDEN, "article": ARTICLE, "main": ARTICLE}
TAG_SIGNS |= dict.fromkeys("button select option optgroup label legend textarea".split(), CONTROL)
ROLE_SIGNS = {"navigation": NAV, "menu": NAV, "menubar": NAV, "banner": HEADER, "contentinfo": FOOTER, "complementary": ASIDE, "search": FORM, "form": FORM, "toolbar": NAV, "dialog": HIDDEN, "alertdialog": HIDDEN, "alert": ASIDE, "main": ARTICLE, "article": ARTICLE}
#: Words of class and id that hint at one of the two; a hint is one feature of many, with a weight from labelled pages.
NOT_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login nav navbar navigation menu menus breadcrumb breadcrumbs sidebar widget widgets related recommended recommendations share sharing social comment comments reply "
    "replies disqus respondent footer header masthead topbar copyright legal disclaimer pagination pager tags toolbar search skip outbrain taboola".split()
)
HINTS = frozenset("article articlebody content entry post story main maincontent body prose text".split())


class Node:
    """An element: signs are its own, above its own and those of all around it; size and linked its characters of text."""

    __slots__ = ("tag", "parent", "depth", "holder", "signs", "above", "size", "linked", "prose", "controls", "wide", "core")

    def __init__(self, tag: str, parent: Node | None, signs: int):
        self.tag, self.parent, self.signs, self.above = tag, parent, signs, 0
        self.depth = parent.depth + 1 if parent else 0
        self.holder = parent.holder if parent and tag in INLINE else self
        self.size = self.linked = self.prose = self.controls = 0
        self.wide = self.core = False


class Block:
    """A run of text inside one element that is no inline one."""

    __slots__ = ("node", "parts", "linked", "text")

    def __init__(self, node: Node):
        self.node, self.parts, self.linked, self.text = node, [], 0, ""


def _signs(tag: str, attributes: str) -> int:
    signs = TAG_SIGNS.get(tag, 0)
    if "=" in attributes or "hidden" in attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id"):
                if tag not in ("html", "body"):  # those tell of the page, not of a part
                    words = {w.lower() for w in CLASS_WORD.findall(html.unescape(max(values, key=len)))}
                    signs |= (NOT_NAMED if words & NOT_HINTS else 0) | (NAMED if words & HINTS else 0)
            elif name == "role":
                signs |= ROLE_SIGNS.get(max(values, key=len).lower(), 0)
            elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", max(values, key=len).lower()):
                signs |= HIDDEN
    return signs


def blocks(page: str) -> tuple[list[Block], list[Node]]:
    """The page's text blocks in order, with decoded and joined text, and its elements, parents first.

    Markup, comments and the text of raw elements are left out. Time is linear in the page: open elements are kept by
    tag, so none is looked for by walking up.
    """
    root = Node("", None, 0)
    nodes, found = [root], []
    node, now, at, links = root, None, 0, 0
    open_by: dict[str, list[Node]] = {}

    def add(raw: str) -> None:
        nonlocal now
        text = html.unescape(raw) if "&" in raw else raw
        if now is None or now.node is not node.holder:
            now = Block(node.holder)
            found.append(now)
        now.parts.append(text)
        if links:
            now.linked += len(text)

    def close(n: Node) -> None:
        nonlocal node, now, links
        while True:
            open_by[node.tag].pop()
            if node.tag == "a":
                links -= 1
            if node.tag not in INLINE:
                now = None
            last, node = node, node.parent
            if last is n:
                return

    def opened(tags: tuple[str, ...], until: tuple[str, ...]) -> Node | None:
        """The innermost open element of these tags, if no open one of `until` is further in."""
        best = None
        for t in tags:
            if (o := open_by.get(t)) and (best is None or o[-1].depth > best.depth):
                best = o[-1]
        if best is not None:
            for t in until:
                if (o := open_by.get(t)) and o[-1].depth > best.depth:
                    return None
        return best

    while at < len(page):
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:  # an end tag
            if tag == "br":
                add(" ")
            elif n := opened((tag,), ("table",) if tag in INLINE else ()):
                close(n)
            elif tag == "p":
                now = None
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                now = None
            elif tag == "br":
                add(" ")
            continue
        if tag in ENDS_P and (n := opened(("p",), P_SCOPE)):
            close(n)
        if tag in SIBLINGS and (n := opened(SIBLINGS[tag], CONTAINERS[tag])):
            close(n)
        attributes = m[3] or ""
        if attributes.endswith("/") and tag in INLINE:  # <mi/>, <path/> and the like have no text
            continue
        node = Node(tag, node, _signs(tag, attributes))
        nodes.append(node)
        open_by.setdefault(tag, []).append(node)
        if tag == "a":
            links += 1
        if tag not in INLINE:
            now = None
        if tag in RCDATA and not open_by.get("svg"):
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            add(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
            close(node)
    for b in found:
        b.text = SPACE.sub(" ", "".join(b.parts)).strip()
    return [b for b in found if b.text], nodes


PARAGRAPH, HEADING = frozenset("p blockquote pre dd figcaption".split()), frozenset("h1 h2 h3 h4 h5 h6".split())
CELL = frozenset("li td th dt caption".split())
NOT_INSIDE = NAV | FOOTER | ASIDE | FORM | HIDDEN | NOT_NAMED | CONTROL
NOT_ARTICLE = NAV | FOOTER | ASIDE | HIDDEN | NOT_NAMED | CONTROL


def _measure(found: list[Block], nodes: list[Node]) -> None:
    """Sizes of all elements, which of them are page-wide, signs from above, and the core: the innermost container of most prose.

    A page-wide element says nothing by its class, and as a form nothing at all: it wraps the page. That is one around an
    article of a quarter of the text, or one of more than 60 % of it while nothing named as an article stands outside.
    """
    for b in found:
        n = b.node
        n.size += len(b.text)
        n.linked += min(b.linked, len(b.text))
        if n.signs & CONTROL:
            n.controls += len(b.text)
    for n in reversed(nodes[1:]):
        p = n.parent
        p.size, p.linked, p.controls = p.size + n.size, p.linked + n.linked, p.controls + n.controls
    total = max(1, nodes[0].size)
    around, within = {nodes[0]: (0, 0)}, Counter()  # signs of all around an element, and how many of these are named as articles
    for n in nodes[1:]:
        signs, names = around[n.parent]
        good = bool(n.signs & (NAMED | ARTICLE) and n.size and not (signs | n.signs) & NOT_ARTICLE)
        around[n] = signs | n.signs, names + good
        within[n] += good
    for n in reversed(nodes[1:]):
        within[n.parent] += within[n]
    for n in reversed(nodes):
        outside = within[nodes[0]] - within[n] - (around[n.parent][1] if n.parent else 0)
        if 5 * n.size > 3 * total and not outside or n.signs & ARTICLE and 4 * n.size >= total:
            n.wide = True
    for n in reversed(nodes[1:]):  # what is around something wide by its article is wide as well
        if n.wide and n.parent is not None and not n.signs & (NAV | FOOTER | ASIDE | HIDDEN):
            n.parent.wide = True
    wraps = {n.parent for n in nodes[1:] if n.wide and n.tag not in PARAGRAPH | HEADING | CELL}  # around the innermost wide one
    for n in nodes[1:]:
        own = n.signs
        if n.wide:
            own &= ~(NOT_NAMED | FORM | HEADER | (NAMED if n in wraps else 0))
        n.signs = own
        n.above = n.parent.above | own
    for b in found:
        n = b.node
        if not n.above & NOT_ARTICLE and 2 * b.linked < len(b.text) and (len(b.text) >= 80 or n.tag == "p"):
            n.prose += len(b.text)
    inner = {}
    for n in reversed(nodes[1:]):
        p = n.parent
        p.prose += n.prose
        if p not in inner or n.prose > inner[p].prose:
            inner[p] = n
    core = nodes[0]
    while core in inner and 2 * inner[core].prose > core.prose and inner[core] in inner:
        core = inner[core]
    core.core = True
    for n in nodes[1:]:
        n.core = n.core or n.parent.core and core.prose > 0


FEATURES = 29


def features(found: list[Block], nodes: list[Node], cues: dict[str, float]) -> np.ndarray:
    """A row of FEATURES numbers for each block: its text, its element, what it stands in and its container."""
    _measure(found, nodes)
    marked = any(n.signs & ARTICLE and n.size for n in nodes)
    out = []
    for b in found:
        n, text = b.node, b.text
        size, above = len(text), n.above
        low = WORD.findall(text.lower())
        cue = sum(cues.get(w, 0.0) for w in low) / (len(low) + 2)
        stops = sum(map(text.count, ".,;:!?"))
        up = n.parent if n.parent is not None and n.size == size else n
        near = up.linked / max(1, up.size)
        inside = above & ARTICLE
        out.append(
            (
                1.0,
                min(1.0, math.log1p(size) / 6),
                min(1.0, size / 400),
                min(1.0, b.linked / size),
                min(1.0, 20 * stops / size) if size > 20 else 0.0,
                0.0 if inside and not above & NOT_INSIDE else cue,  # an article may speak of anything
                n.tag in PARAGRAPH,
                n.tag in HEADING,
                n.tag in CELL,
                bool(above & CONTROL),
                bool(inside),
                marked and not inside,
                bool(above & NAV),
                above & HEADER and not inside,
                above & HEADER and inside,
                above & FOOTER and not inside,
                above & FOOTER and inside,
                bool(above & ASIDE),
                bool(above & FORM),
                bool(above & HIDDEN),
                bool(above & NOT_NAMED),
                bool(above & NAMED),
                n.core,
                bool(n.core and not marked),
                min(1.0, near),
                min(1.0, up.size / 800),
                bool(inside and not above & NOT_INSIDE),
                n.core and not above & NOT_INSIDE,
                any(x in text for x in "\u00a9\u00bb\u2190\u2192"),
            )
        )
    return np.array(out, dtype=np.float64).reshape(-1, FEATURES)


#: Phrases of page furniture in four languages, for the labelled pages.
FURNITURE = {
    "menu": "Home|About us|Contact|News|Products|Services|Blog|Archive|Sports|Culture|Startseite|Über uns|Kontakt|Nachrichten|Produkte|Accueil|À propos|Actualités|Produits|Inicio|Acerca de|Contacto|Noticias|Productos|Log in|Sign up|Anmelden|Connexion|Entrar|Search|Suche|Rechercher|Buscar",
    "notice": "We use cookies to improve your experience on this site|This website uses cookies. Accept all cookies or change your settings|Wir verwenden Cookies, um Ihr Erlebnis zu verbessern. Alle akzeptieren|Nous utilisons des cookies. Tout accepter|Usamos cookies para mejorar su experiencia. Aceptar|Please enable JavaScript to view this page|You have reached your limit of free articles. Subscribe now to continue",
    "footer": "© {n} All rights reserved|Copyright {n}|Privacy policy|Terms of use|Imprint|Impressum|Datenschutz|Alle Rechte vorbehalten|Mentions légales|Tous droits réservés|Aviso legal|Todos los derechos reservados|Powered by a free theme",
    "share": "Share on Facebook|Tweet|Share this article|Pin it|Print|Teilen|Partager|Compartir|Follow us|Email this",
    "form": "Subscribe to our newsletter|Your email address|Enter your name|Send|Submit|Newsletter abonnieren|Absenden|S'abonner|Envoyer|Suscribirse|Enviar|Password|Remember me",
    "ad": "Advertisement|Sponsored|Anzeige|Publicité|Publicidad|Buy now and save {n} percent today|Shop the sale, free shipping on all orders|Promoted by our partners|Order now for only {n} euros",
    "related": "Related articles|You may also like|Read more|More from this author|Most popular|Das könnte Sie auch interessieren|À lire aussi|Te puede interesar|Recent posts|Trending now|Tags",
    "comment": "{n} comments|Leave a reply|Comments|Kommentare|Commentaires|Comentarios|Join the discussion|Post a comment|Log in to reply",
    "byline": "Reply|Antworten|Répondre|Responder|Anna says: {n} May at 10:14|max_{n} wrote 2 days ago|posted by guest{n} on 3 June|Like {n} Reply Report|Paul says:",
    "opinion": "I really like this, thanks for sharing|Great post, thank you|I don't agree with you at all, you are wrong|Thanks, this helped me a lot|First|Danke für den Artikel, sehr hilfreich|Merci pour cet article|Gracias por la información|lol, nice one|Can you tell me where you found that?",
}
FURNITURE = {k: v.split("|") for k, v in FURNITURE.items()}
COMMON = (
    "the of and to a in that is was for with at by on it as be are this from or an have not you your we our us all my me no if any so can do what now here i its he they "
    "more read post like first great find see get say says time day days year new old good people work help may also out may reach page site free save order name one two well very much many some "
    "about over after before other than then them there where who how world life part place home news story word words list print email author place today only use using change settings limit view "
    "neu mehr alle auch sehr noch kann wird sind aus bei nach über plus tout tous toute aussi avec bien être fait très más todo todos esta ser tiene muy bien sin sobre te también "
    "der die und das ist von den mit zu im auf für nicht ein eine es dem sie auch wir ihr um le la les des et est que pour un une du dans qui sur pas ne nous votre "
    "el los las por con de en se su es al lo como más y o una para nos"
).split()
SYLLABLES = "ka lo mi ren tas vel dor shi bru net pal gim ost ure fen lan quo zi hel tri mo sta per no ja wex".split()
#: Stands before the text of blocks that are content in labelled pages; taken out before features are made.
MARK = ""


def labelled_pages(count: int = 400, seed: int = 11) -> list[str]:
    """Made-up pages whose content blocks begin with MARK.

    Each page draws how its parts are named: by elements, by telling classes, or by classes that tell nothing (as made by
    build tools); some wrap the page in a form, name body or a wrapper misleadingly, leave the article unmarked, lay out
    by tables, or put adverts, notices, forms and comments inside the article's own container.
    """
    import random

    r = random.Random(seed)
    pick = lambda kind: r.choice(FURNITURE[kind]).format(n=r.randrange(2, 2030))

    spoken = [w.lower() for kind in FURNITURE.values() for phrase in kind for w in WORD.findall(phrase)]

    def word() -> str:
        kind = r.random()
        return r.choice(COMMON) if kind < 0.4 else r.choice(spoken) if kind < 0.44 else "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))

    def sentence(least: int = 3, most: int = 22) -> str:
        w = [word() for _ in range(r.randint(least, most))]
        return " ".join(x + ("," if r.random() < 0.08 else "") for x in w).capitalize() + r.choice("....?!")

    def prose(most: int = 7) -> str:
        return " ".join(sentence() for _ in range(r.randint(1, most)))

    def links(kind: str, n: int, tag: str = "li") -> str:
        return "".join(f"<{tag}><a href='/{word()}'>{pick(kind) if r.random() < 0.6 else sentence(1, 4)}</a></{tag}>" for _ in range(n))

    def page() -> str:
        style = r.choice(("elements", "elements", "classes", "obscure"))

        def part(element: str, name: str, inner: str) -> str:
            if style == "elements" and element:
                return f"<{element}>{inner}</{element}>"
            label = name if style != "obscure" else r.choice("abcxyz") + str(r.randrange(99))
            return f"<{r.choice(('div', 'div', 'section'))} {r.choice(('class', 'id'))}='{label}'>{inner}</div></section>"

        def comments() -> str:
            each = "".join(f"<div><b>{pick('byline')}</b><p>{pick('opinion') if r.random() < 0.6 else prose(3)}</p><a href=#>{pick('byline')}</a></div>" for _ in range(r.randint(1, 5)))
            return part("", r.choice(("comments", "comment-list", "replies")), f"<h3>{pick('comment')}</h3>{each}")

        def advert() -> str:
            return part("", r.choice(("ad", "advert", "banner", "promo")), r.choice((f"<p>{pick('ad')}</p>", pick("ad"), f"<a href=x>{pick('ad')}</a>", sentence(4, 12), f"<p>{sentence(4, 12)}</p>" if style != "obscure" else pick("ad"))))

        def newsletter() -> str:
            return f"<form><label>{pick('form')}</label><input><button>{pick('form')}</button><p>{pick('form')}</p></form>"

        def extra() -> str:
            return r.choice((advert, newsletter, lambda: part("aside", "related", f"<h4>{pick('related')}</h4><ul>{links('related', r.randint(2, 5))}</ul>"), lambda: part("", "share", links("share", 3, "span")), lambda: part("", "cookie-notice", f"<p>{pick('notice')}</p>"), lambda: f"<div {r.choice(('hidden', 'style=\"display: none\"'))}><p>{prose(3)}</p></div>"))()

        body = [f"<h1>{MARK}{sentence(2, 8)}</h1>"] if r.random() < 0.85 else []
        short = r.random() < 0.15
        for _ in range(1 if short else r.randint(1, 9)):
            kind = 0.7 if short else r.random()
            if kind < 0.62:
                body.append(f"<p>{MARK}{prose()}</p>")
            elif kind < 0.74:
                body.append(f"<p>{MARK}{sentence(1, 4)}</p>")
            elif kind < 0.80:
                body.append(f"<h2>{MARK}{sentence(1, 5)}</h2><p>{MARK}{prose(3)}</p>")
            elif kind < 0.85:
                body.append("<ul>" + "".join(f"<li>{MARK}{sentence(1, 9)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.88:
                body.append(f"<blockquote>{MARK}{prose(2)}</blockquote>")
            elif kind < 0.91:
                body.append("<table>" + "".join(f"<tr><td>{MARK}{word()}<td>{MARK}{r.randrange(999)}</tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif kind < 0.93:
                body.append(f"<pre>{MARK}{word()}({word()}) = {r.randrange(9)}</pre>")
            elif kind < 0.97:  # an article may speak of what furniture speaks of
                body.append(f"<p>{MARK}{sentence(1, 6) if r.random() < 0.5 else ''} {pick(r.choice(('footer', 'notice', 'opinion', 'related', 'ad')))}</p>")
            elif kind < 0.985:
                body.append(f"<p>{MARK}{sentence()} <a href=x>{sentence(1, 4)}</a> {sentence()}</p>")
            else:
                body.append(f"<section><h3>{MARK}{sentence(1, 4)}</h3><div>{MARK}{prose(2)}</div></section>")
        if not short and not any("<p>" in x for x in body):
            body.append(f"<p>{MARK}{prose()}</p>")
        for _ in range(r.choice((0, 0, 1, 2))):
            body.insert(r.randint(1, len(body)), extra())
        inner, late = "".join(body), comments() if r.random() < 0.45 else ""
        inside = late and r.random() < 0.4
        inner += late if inside else ""
        how = r.random()
        if style == "elements":
            tag = "main" if how < 0.25 else "article"
            main = f"<{tag}>{inner}</{tag}>" if how < 0.85 else inner
        elif style == "classes":
            main = f"<div class='{r.choice(('post', 'entry-content', 'article-body', 'story', 'main-content', 'single'))}'>{inner}</div>"
        else:
            main = f"<div class='q{r.randrange(99)}'>{inner}</div>" if how < 0.8 else f"<table><tr><td>{links('menu', 5, 'div')}</td><td>{inner}</td></tr></table>"
        top = part("header", "header", (f"<p>{pick('menu')}</p>" if r.random() < 0.3 else "") + part("nav", r.choice(("nav", "menu", "topbar")), f"<ul>{links('menu', r.randint(3, 8))}</ul>")) if r.random() < 0.9 else ""
        side = part("aside", "sidebar", f"<h3>{pick('related')}</h3><ul>{links('related', r.randint(2, 6))}</ul>" + (f"<p>{sentence()}</p>" if style != "obscure" and r.random() < 0.5 else "")) if r.random() < 0.5 else ""
        foot = part("footer", "footer", r.choice((f"<p>{pick('footer')}</p><ul>{links('footer', 3)}</ul>", f"© {word()}.example &middot; {prose(2) if style != 'obscure' else pick('footer')}", pick("footer")))) if r.random() < 0.9 else ""
        whole = top + (advert() if r.random() < 0.4 else "") + (side if r.random() < 0.3 else "") + main + (late if not inside else "") + side * (r.random() < 0.6) + (extra() if r.random() < 0.3 else "") + foot
        if r.random() < 0.12:
            whole = f"<form action=x>{whole}</form>"
        if r.random() < 0.3:
            whole = f"<div class='{r.choice(('wrapper', 'has-sidebar no-comments', 'header-fixed', 'page menu-open', 'banner-off'))}'>{whole}</div>"
        named = r.choice(("", "", " class='single no-sidebar'", " class=comments-open", " id=nav-page"))
        return f"<!DOCTYPE html><html><head><title>{sentence(2, 8)}</title><script>x('</p>')</script></head><body{named}>{whole}</body></html>"

    return [page() for _ in range(count)]


def _labelled(page: str) -> tuple[list[Block], list[Node], list[bool]]:
    found, nodes = blocks(page)
    keep = [b.text.startswith(MARK) for b in found]
    for b in found:
        b.text = b.text.replace(MARK, "")
    return found, nodes, keep


class Model:
    """Weights of the features and the cues: how far a word speaks for furniture, from the labelled pages' words."""

    def __init__(self, pages: list[str]):
        rows = [_labelled(p) for p in pages]
        times: tuple[Counter, Counter] = (Counter(), Counter())
        for found, _, keep in rows:
            for b, k in zip(found, keep):
                times[k].update(set(WORD.findall(b.text.lower())))
        total = [sum(t.values()) + 1 for t in times]
        seen = {w for t in times for w, n in t.items() if n >= 3}
        odds = {w: math.log((times[1][w] + 1) / total[1]) - math.log((times[0][w] + 1) / total[0]) for w in seen}
        self.cues = {w: o for w, o in odds.items() if o < -1.2}  # made-up prose says nothing for content
        x = np.concatenate([features(found, nodes, self.cues) for found, nodes, _ in rows])
        y = np.array([k for *_, keep in rows for k in keep], dtype=np.float64)
        w = np.zeros(FEATURES)
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(FEATURES)
            w = w - np.linalg.solve(h, x.T @ (p - y) + RIDGE * w)
        self.weights = w


RIDGE = 0.2


@functools.cache
def trained() -> Model:
    return Model(labelled_pages())


GRAIN = 1_000_000


def min_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each block whether it is on the source side of a minimum cut (content).

    gain > 0: capacity from the source (the cost of calling it boilerplate); < 0: to the sink; edges (a, b, capacity) go
    both ways. Capacities are whole numbers of a millionth. First each block whose gain outweighs all its edges takes its
    side, which is that of a minimum cut whatever the others do, and its edges become its neighbours' gains; then maximum
    flow by blocking flows (Dinic) over what is left. The source side is what the source still reaches.
    """
    n = len(gain)
    g = [round(x * GRAIN) for x in gain]
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, c in edges:
        if a != b and (c := round(c * GRAIN)):
            near[a][b] = near[a].get(b, 0) + c
            near[b][a] = near[b].get(a, 0) + c
    left, side = [sum(x.values()) for x in near], [-1] * n
    todo = deque(range(n))
    while todo:
        a = todo.popleft()
        if side[a] >= 0 or -left[a] < g[a] <= left[a]:
            continue
        side[a] = 1 if g[a] > 0 else 0
        for b, c in near[a].items():
            if side[b] < 0:
                g[b] += c if side[a] else -c
                left[b] -= c
                todo.append(b)
    rest = [a for a in range(n) if side[a] < 0]
    if rest:
        at = {a: k for k, a in enumerate(rest)}
        flow = _flow([g[a] for a in rest], [(at[a], at[b], c) for a in rest for b, c in near[a].items() if b in at and a < b])
        for a, s in zip(rest, flow):
            side[a] = s
    return [s == 1 for s in side]


def _flow(gain: list[int], edges: list[tuple[int, int, int]]) -> list[int]:
    """1 for the nodes that the source reaches after a maximum flow."""
    n = len(gain)
    source, sink = [max(g, 0) for g in gain], [max(-g, 0) for g in gain]
    arcs: list[list[int]] = [[] for _ in range(n)]
    to, cap = [], []
    for a, b, c in edges:  # arc k and its reverse k ^ 1
        arcs[a].append(len(to))
        arcs[b].append(len(to) + 1)
        to += [b, a]
        cap += [c, c]
    while True:
        far = [0 if s else -1 for s in sink]  # arcs to a node from which the sink can be reached
        todo = deque(k for k in range(n) if sink[k])
        while todo:
            v = todo.popleft()
            for e in arcs[v]:
                u = to[e]
                if far[u] < 0 and cap[e ^ 1]:
                    far[u] = far[v] + 1
                    todo.append(u)
        starts = [k for k in range(n) if source[k] and far[k] >= 0]
        if not starts:
            break
        turn = [0] * n
        for s in starts:
            path, u = [], s
            while source[s]:
                if sink[u]:
                    f = min([source[s], sink[u], *(cap[e] for e in path)])
                    source[s] -= f
                    sink[u] -= f
                    back = len(path)
                    for k, e in enumerate(path):
                        cap[e] -= f
                        cap[e ^ 1] += f
                        if not cap[e] and k < back:
                            back = k
                    if back < len(path):  # go on from before the first full arc
                        u = to[path[back] ^ 1]
                        del path[back:]
                    continue
                own = arcs[u]
                while turn[u] < len(own):
                    e = own[turn[u]]
                    if cap[e] and far[to[e]] == far[u] - 1:
                        break
                    turn[u] += 1
                if turn[u] < len(own) and far[u] > 0:
                    path.append(e)
                    u = to[e]
                elif path:
                    u = to[path.pop() ^ 1]
                    turn[u] += 1
                else:
                    break
    side = [1 if s else 0 for s in source]
    todo = deque(k for k in range(n) if side[k])
    while todo:
        u = todo.popleft()
        for e in arcs[u]:
            if cap[e] and not side[to[e]]:
                side[to[e]] = 1
                todo.append(to[e])
    return side


def distance(a: Node, b: Node) -> int:
    """Steps between two elements in the tree."""
    n = 0
    while a is not b:
        if a.depth < b.depth:
            a, b = b, a
        a, n = a.parent, n + 1
    return n


def smoothness(found: list[Block], smooth: float) -> list[tuple[int, int, float]]:
    """Edges: neighbours in page order, and each block with the last one before it under its parent and grandparent.

    An edge over d steps of the tree weighs 2 * smooth / d, so siblings are tied most and blocks across a container's
    border less; an edge into what isn't shown (hidden, head) is none.
    """
    edges, last = [], {}
    for k, b in enumerate(found):
        ties = {k - 1} if k else set()
        for up in (b.node.parent, b.node.parent and b.node.parent.parent):
            if up is not None:
                if up in last:
                    ties.add(last[up])
                last[up] = k
        for j in ties:
            if (found[j].node.above ^ b.node.above) & HIDDEN:
                continue
            edges.append((j, k, 2 * smooth / max(2, distance(found[j].node, b.node))))
    return edges


def extract(page: str | None, model: Model | None = None, smooth: float = 0.8) -> str:
    """The main text: content blocks joined by newlines; empty for null or if there is none."""
    m = model or trained()
    found, nodes = blocks(page or "")
    if not found:
        return ""
    gain = (features(found, nodes, m.cues) @ m.weights).tolist()
    keep = min_cut(gain, smoothness(found, smooth))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", smooth: float = 0.8) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of pages, whole pages, no shuffle.

    A null or empty page, or one without content, has an empty text. Broken markup is read as browsers do in the main:
    p, li, cells and options end where the next begins, what isn't closed ends with the page. A page of many blocks takes
    time in proportion to them in reading, features and edges; the flow runs over the undecided ones only. Null ids and
    urls and repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    model = trained()  # some hundred words and numbers, sent with the task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                texts = [extract(x.as_py(), model, smooth) for x in b.column(2)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
