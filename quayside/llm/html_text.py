"""Main text of HTML pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks (runs of text between block-level tags) with their ancestor tags
and the class and id words of these. Each block has features of its ancestors and its text; the
chain's two labels are article text and everything else. The weights of features, transitions
and ends are trained by gradient ascent on the conditional likelihood of labelled pages, with the
forward-backward recursions, and pages are decoded by Viterbi.

``labelled_pages`` makes the training pages: documents of several layouts (semantic tags, class
names only, tables, plain markup) whose blocks are labelled as they are written. Texts there are
random letters, so nothing of a language is learned but the few cue words below.

Character references are decoded, white space in a block becomes one space, blocks are trimmed
and joined by one space in page order. Scripts, styles, titles and other contents that are never
page text are no blocks. Defined results: null and empty pages and pages without article text
give an empty text; an unfinished tag at the end of a page is dropped; repeated rows and null ids
are rows like others; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.exchange import release_memory

# HTML's block-level, void and raw-text elements.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html label legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style title template textarea iframe".split())  # not shown
FOREIGN = frozenset(("svg", "math"))  # in these, and for these, "/>" ends an element
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# an open element that a start tag of the same kind ends
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Words of class and id names, and of texts, that tell what a block is.
OTHER_NAMES = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo promotion sidebar side rail menu nav navigation navbar breadcrumb breadcrumbs topbar masthead header head "
    "footer foot copyright legal cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login register search form share sharing social related recommended "
    "recommendations popular trending widget toolbar pagination pager tags comment comments reply replies respond disqus discussion feedback".split()
)
TEXT_NAMES = frozenset("article content post entry story body main text page blog news paragraph".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus discussion feedback".split())
CUES = ("©", "cookie", "subscribe", "sign up", "log in", "newsletter", "advertisement", "sponsored", "privacy", "all rights reserved", "comments", "reply", "share", "read more", "related")

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>|<[/!?a-zA-Z][^>]*\Z""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    path: tuple  # (tag, names) of each open element, outermost first
    linked: int  # characters inside links


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    held: list[str] = []
    linked, in_link, skip, at, foreign = 0, False, 0, 0, 0

    def close():
        nonlocal held, linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(Block(text, tuple(stack), min(linked, len(text))))
            held, linked = [], 0

    def put(raw, verbatim=False):
        nonlocal linked
        text = entities.unescape(raw) if "&" in raw and not verbatim else raw
        held.append(text)
        if in_link:
            linked += len(text)

    page = page or ""
    for m in _TAG.finditer(page):
        if m.start() < skip:
            continue
        if m.start() > at:
            put(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        if m[1] or m[4]:
            if name == "a":
                in_link = False
            elif name in FOREIGN:
                foreign = max(0, foreign - 1)
            elif name in BLOCKS:
                close()
                in_link = False
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        del stack[i:]
                        break
            continue
        closed = (m[3] or m[6] or "").endswith("/")
        if name in FOREIGN:
            foreign += not closed
        elif name in RAW and foreign and closed:
            pass
        elif name in RAW or name == "xmp":
            end = re.compile(f"</{re.escape(name)}", re.I).search(page, at)
            stop = page.find(">", end.end()) if end else -1
            if name == "xmp":  # shown as it is written
                put(page[at : end.start() if end else len(page)], verbatim=True)
            at = skip = stop + 1 if stop >= 0 else len(page)
        elif name == "a":
            in_link = True
        elif name == "br":
            held.append(" ")
        elif name in BLOCKS:
            close()
            in_link = False
            ends = ENDS.get(name)
            if ends:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        del stack[i:]
                        break
                    if stack[i][0] in ("ul", "ol", "dl", "table", "div", "select"):
                        break
            if name not in VOID:
                attributes = m[3] or m[6] or ""
                names = tuple(sorted({w for x in _NAMES.findall(attributes) for w in _WORD.findall("".join(x).lower())})) if "=" in attributes else ()
                stack.append((name, names))
    if at < len(page):
        put(page[at:])
    close()
    return out


def path_features(path: tuple) -> list[str]:
    tags = [t for t, _ in path]
    names = {n for _, ns in path for n in ns}
    out = [f"tag {tags[-1]}" if tags else "tag none"]
    out += [f"in {t}" for t in set(tags) & {"nav", "header", "footer", "aside", "article", "main", "form", "section", "ul", "ol", "table", "figure", "button", "label", "select", "menu", "dialog", "blockquote"}]
    if "article" in tags:
        inside = tags[tags.index("article") + 1 :]
        out += [f"article over {t}" for t in set(inside) & {"nav", "header", "footer", "aside", "form", "article", "section", "ul", "button", "figure"}]
    if names & OTHER_NAMES:
        out.append("other name")
    if names & COMMENT_NAMES:
        out.append("comment name")
    if names & TEXT_NAMES and not names & OTHER_NAMES:
        out.append("text name")
    if path and set(path[-1][1]) & OTHER_NAMES:
        out.append("own other name")
    return out


def text_features(b: Block) -> list[str]:
    n = len(b.text)
    out = [f"size {min(n.bit_length(), 10)}", f"links {min(4, 5 * b.linked // n)}"]
    if b.text[-1] in ".!?…\"”»":
        out.append("ends a sentence")
    if b.text.count(",") + b.text.count(".") >= 3:
        out.append("many stops")
    low = b.text[:400].lower() if n < 400 else ""  # cue words tell only of short blocks
    out += [f"cue {c}" for c in CUES if c in low]
    return out


class Model(NamedTuple):
    weights: dict  # feature -> weight for "article text" against "other"
    moves: np.ndarray  # 2 x 2 log weights from label to label
    ends: np.ndarray  # 2 x 2: log weights of the first and the last label


def _emissions(page: list[Block], model: Model, memo: dict) -> list[float]:
    w = model.weights.get
    out = []
    for b in page:
        s = memo.get(b.path)
        if s is None:
            s = memo[b.path] = sum(w(f, 0.0) for f in path_features(b.path))
        out.append(s + sum(w(f, 0.0) for f in text_features(b)))
    return out


def viterbi(scores: list[float], model: Model) -> list[bool]:
    """The best labels of a chain; ties go to "other"."""
    (oo, ot), (to, tt) = model.moves.tolist()
    first, last = model.ends.tolist()
    other, text, back = first[0], first[1] + scores[0], []
    for s in scores[1:]:
        from_text = (text + to > other + oo, text + tt > other + ot)
        other, text = max(other + oo, text + to), max(other + ot, text + tt) + s
        back.append(from_text)
    label = text + last[1] > other + last[0]
    out = [label]
    for from_text in reversed(back):
        label = from_text[label]
        out.append(label)
    return out[::-1]


def train(pages: list[tuple[list[Block], list[bool]]], steps: int = 300, rate: float = 0.1, decay: float = 1e-3) -> Model:
    """Maximum conditional likelihood by Adam, all pages at once, padded to the longest."""
    pages = [p for p in pages if p[0]]
    found = [[path_features(b.path) + text_features(b) for b in bs] for bs, _ in pages]
    names = sorted({f for page in found for fs in page for f in fs})
    at = {f: i for i, f in enumerate(names)}
    n, most = len(pages), max(len(p[0]) for p in pages)
    size = np.array([len(p[0]) for p in pages])
    page_of, place_of, feature = (np.array(x) for x in zip(*((i, j, at[f]) for i, page in enumerate(found) for j, fs in enumerate(page) for f in fs)))
    y = np.zeros((n, most), np.int64)
    for i, (_, labels) in enumerate(pages):
        y[i, : len(labels)] = labels
    inside = np.arange(most) < size[:, None]
    pair = inside[:, 1:]
    theta = np.zeros(len(names) + 8)
    m1, m2, rows = np.zeros_like(theta), np.zeros_like(theta), np.arange(n)
    for step in range(1, steps + 1):
        w, moves, ends = theta[: len(names)], theta[-8:-4].reshape(2, 2), theta[-4:].reshape(2, 2)
        e = np.zeros((n, most, 2))
        np.add.at(e[:, :, 1], (page_of, place_of), w[feature])
        forward, backward = np.zeros((n, most, 2)), np.zeros((n, most, 2))
        forward[:, 0] = ends[0] + e[:, 0]
        for t in range(1, most):
            new = np.logaddexp(forward[:, t - 1, :1] + moves[0], forward[:, t - 1, 1:] + moves[1]) + e[:, t]
            forward[:, t] = np.where(inside[:, t, None], new, forward[:, t - 1])
        backward[:, most - 1] = ends[1]
        for t in range(most - 2, -1, -1):
            after = e[:, t + 1] + backward[:, t + 1]
            new = np.logaddexp(moves[:, 0] + after[:, :1], moves[:, 1] + after[:, 1:])
            backward[:, t] = np.where(inside[:, t + 1, None], new, ends[1])
        z = np.logaddexp(*(forward[:, most - 1] + ends[1]).T)
        p = np.exp(forward + backward - z[:, None, None]) * inside[:, :, None]
        g = np.zeros_like(theta)
        np.add.at(g, feature, (y - p[:, :, 1])[page_of, place_of])
        for a in range(2):
            for b in range(2):
                joint = np.exp(forward[:, :-1, a] + moves[a, b] + e[:, 1:, b] + backward[:, 1:, b] - z[:, None]) * pair
                g[len(names) + 2 * a + b] = (((y[:, :-1] == a) & (y[:, 1:] == b)) * pair - joint).sum()
            g[len(names) + 4 + a] = ((y[:, 0] == a) - p[:, 0, a]).sum()
            g[len(names) + 6 + a] = ((y[rows, size - 1] == a) - p[rows, size - 1, a]).sum()
        g = g / n - decay * theta
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        theta = theta + rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return Model(dict(zip(names, theta.tolist())), theta[-8:-4].reshape(2, 2), theta[-4:].reshape(2, 2))


# ---- labelled pages --------------------------------------------------------------------------

_MARK = "\x01"  # starts each text that is article text


def _layouts(r: random.Random):
    word = lambda: "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 9)))
    words = lambda n: " ".join(word() for _ in range(n))
    sentence = lambda: words(r.randint(1, 22)).capitalize() + r.choice(["", ",", ","]) + " " + words(r.randint(0, 6)) + r.choice("...?!")
    pick = r.choice

    def text(n=None):
        body = " ".join(sentence() for _ in range(n or r.choice([1, 1, 2, 3, 6])))
        if r.random() < 0.15:
            body = words(r.randint(1, 4)) + pick(["", "."])
        if r.random() < 0.2:
            body = f"<b>{body}</b>" if r.random() < 0.5 else f"<b>{body}"
        if r.random() < 0.15:
            body += f" <a href='/x'>{words(2)}</a> {sentence()}"
        return _MARK + body

    def links(tag="ul"):
        items = [f"<a href='/{i}'>{words(r.randint(1, 3))}</a>" for i in range(r.randint(2, 8))]
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if tag == "ul" else pick([" | ", " "]).join(items)

    def article(heading=True):
        out = [f"<h1>{_MARK}{words(r.randint(2, 9)).capitalize()}{pick(['', '.'])}</h1>"] if heading else []
        if heading and r.random() < 0.25:
            out = []
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14])):
            kind = r.random()
            if kind < 0.75:
                out.append(f"<p>{text()}" + pick(["</p>", "</p>", "</p>", "<br>", ""]))
            elif kind < 0.82:
                out.append(f"<h2>{_MARK}{words(r.randint(1, 6))}</h2>")
            elif kind < 0.88:
                out.append("<ul>" + "".join(f"<li>{text(1)}</li>" for _ in range(r.randint(1, 4))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote>{text(2)}</blockquote>")
            elif kind < 0.95:
                out.append(f"<table><tr><td>{_MARK}{words(2)}</td><td>{_MARK}{words(2)}</td></tr></table>")
            elif kind < 0.98:
                out.append(f"<div>{text()}</div>")
            else:
                out.append(f"<div class='{pick(['ad', 'promo', 'related', 'share'])}'>{sentence()}</div>")
        return "".join(out)

    named = lambda *n: f'{pick(["class", "id"])}="{pick(n)}"'
    advert = lambda: f"<div {named('ad', 'ads', 'banner', 'advert', 'sponsored', 'promo-box')}>{pick([sentence(), 'Advertisement', words(4)])}</div>"
    notice = lambda: f"<div {named('cookie-notice', 'consent', 'notice', 'alert', 'popup', 'gdpr')}>{pick(['We use cookies. ', ''])}{sentence()} <button>{words(1)}</button></div>"
    form = lambda: f"<form action='/s'><label>{words(1)}</label><input name='q'><p>{pick(['Subscribe to our newsletter. ', 'Sign up. ', ''])}{sentence()}</p><select><option>{words(1)}<option>{words(1)}</select><button>{words(1)}</button></form>"
    comments = lambda: f"<section {named('comments', 'comment-list', 'discussion', 'disqus')}><h3>{pick(['Comments', words(2)])}</h3>" + "".join(f"<div {named('comment', 'reply')}><b>{word()}</b><p>{sentence()} {sentence()}</p></div>" for _ in range(r.randint(1, 5))) + "</section>"
    bare_comments = lambda: "<section class='comments'>" + "".join(f"<article><p>{sentence()}</p></article>" for _ in range(r.randint(1, 4))) + "</section>"
    side = lambda: f"<aside>{pick([links(), f'<h3>{words(2)}</h3>{links()}', f'<p>{sentence()}</p>'])}</aside>"
    soup_side = lambda: f"<div {named('sidebar', 'right-rail', 'widget', 'related')}><h4>{words(2)}</h4>{pick([links(), f'<p>{sentence()}</p>'])}</div>"
    foot = lambda: pick([f"&copy; {word()}.example &middot; {sentence()}", f"<p>Copyright {words(2)}. All rights reserved.</p>", links("p"), f"<p>{sentence()}</p>"])
    extra = lambda *kinds: "".join(k() for k in kinds if r.random() < 0.4)

    def semantic():
        inner = article()
        if r.random() < 0.25:
            inner = f"<header><h1>{_MARK}{words(4)}</h1></header>" + article(False)
        if r.random() < 0.15:
            inner += f"<footer>{pick([links('p'), words(4)])}</footer>"
        main = f"<article{pick(['', ' class=post'])}>{inner}</article>"
        if r.random() < 0.4:
            main = f"<main>{main}{extra(comments)}</main>"
        head = f"<header>{pick([words(2), f'<h1>{words(2)}</h1>', f'<p>{sentence()}</p>'])}{pick(['', links('p')])}</header>" if r.random() < 0.5 else ""
        return f"{head}<nav>{links()}</nav>{extra(advert, notice, form)}{main}{extra(side, advert, comments, bare_comments, form, notice)}<footer>{foot()}</footer>"

    def soup():
        body = f"<div {named('content', 'post-body', 'entry-content', 'article-text', 'story', 'main-content')}>{article()}</div>"
        return f"<div {named('header', 'masthead', 'topbar')}>{pick([words(3), f'<h1>{words(2)}</h1>'])}</div><div {named('menu', 'navbar', 'nav-main')}>{pick([links(), links('p')])}</div>{extra(advert, notice)}{body}{extra(soup_side, comments, form, advert)}<div {named('footer', 'legal', 'copyright')}>{foot()}</div>"

    def tables():
        return f"<table><tr><td>{links('p')}</td></tr><tr><td {named('nav', 'side')}>{links()}</td><td>{article()}</td></tr><tr><td>{foot()}</td></tr></table>"

    def plain():
        return f"{links('p')}{advert()}{article()}<p>{links('p')}</p>{pick(['', f'<p>&copy; {words(3)}</p>'])}"

    def bare():
        body = pick([f"<article>{article()}</article>", f"<main>{article()}</main>", f"<div class='content'>{article()}</div>"])
        return f"{pick(['', f'<nav>{links()}</nav>', f'<nav>{links()}</nav>', advert()])}{body}{extra(side, comments)}"

    return [semantic, semantic, semantic, soup, soup, tables, plain, bare, bare]


def labelled_pages(n: int = 600, seed: int = 11) -> list[tuple[str, list[Block], list[bool]]]:
    """(page, blocks, labels) of n made pages; some are cut off, as fetched pages are."""
    r = random.Random(seed)
    layouts, out = _layouts(r), []
    for _ in range(n):
        body = r.choice(layouts)()
        page = f"<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"
        if r.random() < 0.1:
            page = page[: r.randint(len(page) // 3, len(page))]
        marked = blocks(page)
        out.append((page.replace(_MARK, ""), [b._replace(text=b.text.replace(_MARK, "")) for b in marked if b.text.strip(_MARK)], [_MARK in b.text for b in marked if b.text.strip(_MARK)]))
    return out


_trained: list[Model] = []


def default_model() -> Model:
    """The model of the made pages, trained once per process (seconds)."""
    if not _trained:
        _trained.append(train([(b, y) for _, b, y in labelled_pages()]))
    return _trained[0]


def extract_text(page: str | None, model: Model, memo: dict) -> str:
    found = blocks(page)
    if not found:
        return ""
    return " ".join(b.text for b, keep in zip(found, viterbi(_emissions(found, model, memo), model)) if keep)


def extract(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    sent = pages.sparkSession.sparkContext.broadcast(model or default_model())  # a few hundred weights

    def run(batches):
        memo: dict = {}
        for batch in batches:
            for at in range(0, len(batch), 200):
                some = batch.slice(at, 200)
                texts = [extract_text(p, sent.value, memo) for p in some.column(2).to_pylist()]
                if len(memo) > 20_000:
                    memo.clear()
                yield pa.record_batch([some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
        release_memory()

    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")
