"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read into leaf blocks: runs of text between block-level tags, with the tags (and the words of
class, id and role) that are open around them.  Each block is labelled main or other.  The field scores a
label by features of the ancestors and of the text, and two neighbouring labels by a transition; Viterbi
decoding picks the best labelling of the whole page, and the main blocks are its text.

The field is trained on labelled pages.  At most ``SAMPLE_PAGES`` pages of the table, those with the
smallest hash of their id, are labelled by their landmarks (inside ``article`` or ``main``, outside menus,
sidebars, notices and the like).  Their texts are then written anew into ``LAYOUTS`` pages each, in which
landmarks, class names and the order of parts are drawn at random and every block's label is known, so
that the field does not hang on one way of writing pages.  Training is gradient descent on the exact
likelihood (forward-backward), in numpy on the driver, over this bounded sample alone.

Text: character references are decoded, white space inside a block becomes one space, blocks are joined
by an empty line.  ``script``, ``style`` and other raw or hidden elements hold no blocks; tags that do not
end take the rest of the page with them, as in a browser; a missing end tag closes with its parent.

Edge cases: null and empty pages have an empty text, and so have pages without a main block; null ids
and urls are kept; repeated rows give equal texts; an empty table gives an empty result (the field is then
trained on written pages with made-up words).  Only ``page_id``, ``url`` and ``html`` are read: other
columns, whatever their names, are left out.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Pages that are learned from at most, and the longest of them in characters.
SAMPLE_PAGES, SAMPLE_CHARS = 250, 100_000
#: Pages written from the texts of each of these, and times that the page itself counts.
LAYOUTS, REPEAT = 3, 3
FEATURES = 1 << 15
ROUNDS, RATE, PENALTY = 100, 0.15, 3e-5
OTHER, MAIN = 0, 1

# Names of HTML elements by their kind.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody "
    "td tfoot th thead tr ul".split()
)
HIDDEN = frozenset("script style title textarea iframe noembed noframes noscript xmp template svg math object audio video canvas".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element on the left ends open ones in the middle, no further up than one on the right.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
LANDMARKS = frozenset(("t:article", "t:main", "c:main"))

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_UNSEEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
_CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in HIDDEN}


class Block:
    """A leaf block: its text, the characters of it inside links, and the features of its ancestors."""

    __slots__ = ("ancestors", "linked", "text")

    def __init__(self, text: str, linked: int, ancestors: tuple):
        self.text, self.linked, self.ancestors = text, linked, ancestors


def _element(name: str, attributes: str) -> tuple[str, ...]:
    """Features of an open element."""
    found = [f"t:{name}"]
    if attributes and "=" in attributes:
        for _, *values in _ATTRIBUTE.findall(attributes):
            found += {f"c:{part.lower()}" for part in _PART.findall("".join(values))}
    if attributes and _UNSEEN.search(attributes):
        found.append("unseen")
    return tuple(found)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    # ancestors as linked pairs (features of the innermost, those further out), shared between blocks
    ancestors: tuple = ()
    text: list[str] = []
    linked, in_link, at, size, tag = 0, False, 0, len(page), _TAG

    def add(piece: str) -> None:
        nonlocal linked
        if "&" in piece:
            piece = html.unescape(piece)
        text.append(piece)
        if in_link:
            linked += len(piece)

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append(Block(joined, linked, ancestors))
            text.clear()
        linked = 0

    def pop() -> None:
        nonlocal ancestors
        stack.pop()
        ancestors = stack[-1][1] if stack else ()

    while at < size:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        if start > at:
            add(page[at:start])
        after = page[start + 1 : start + 3]
        if after[:1] in ("!", "?") or (after[:1] == "/" and not after[1:].isalpha()):
            if page.startswith("<!--", start):
                end = page.find("-->", start + 2)  # "<!-->" is a whole comment
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", start)
                at = size if end < 0 else end + 1
            continue
        if not (after[:1].isascii() and after[:1].isalpha()) and after[:1] != "/":
            add("<")
            at = start + 1
            continue
        match = tag.match(page, start)
        if match is None and tag is _TAG:
            tag = _LOOSE  # a quotation mark without a partner: from here on a tag ends at the next ">"
            match = tag.match(page, start)
        if match is None:
            break
        at = match.end()
        closing, name, attributes = match.group(1), match.group(2).lower(), match.group(3)
        if name in BLOCKS:
            flush()
            if closing:
                in_link = False
                if any(open_name == name for open_name, _ in stack):
                    while stack[-1][0] != name:
                        pop()
                    pop()
                continue
            if stack and stack[-1][0] == "p" or stack and name in HEADINGS and stack[-1][0] in HEADINGS:
                pop()
            if name in CLOSES:
                ended, limit = CLOSES[name]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in limit:
                        break
                    if stack[k][0] in ended:
                        while len(stack) > k:
                            pop()
                        if name != "tr":
                            break
            if name != "hr":
                ancestors = (_element(name, attributes), ancestors)
                stack.append((name, ancestors))
        elif closing:
            if name == "a":
                in_link = False
        elif name in HIDDEN:
            if not attributes.endswith("/") or name in ("script", "style", "title", "textarea", "iframe"):
                end = _CLOSING[name].search(page, at)
                at = end.end() if end else size
        elif name == "a":
            in_link = True
        elif name == "br":
            text.append(" ")
    flush()
    return out


def _within(ancestors: tuple) -> Iterator[str]:
    while ancestors:
        yield from ancestors[0]
        ancestors = ancestors[1]


def text_features(text: str, linked: int) -> list[str]:
    size = len(text)
    found = [f"n:{size.bit_length()}", f"link:{4 * linked // size}", f"commas:{min(text.count(','), 3)}"]
    last = text[-1]
    found.append("end:stop" if last in ".!?…»”\"'" else "end:word" if last.isalnum() else "end:mark")
    if size <= 60:
        found += [f"w:{w.strip('.,:;!?').lower()}" for w in text.split(" ", 5)[:5]]
        if "©" in text:
            found.append("copyright")
    return found


def place_features(ancestors: tuple, inside: bool, landmark: bool) -> list[str]:
    """Features of a block's place: ``inside`` a landmark of the page, if it has one, and in which element."""
    side = "inside" if inside else "outside" if landmark else "open"
    return [side, *(f"{side}:{f}" for f in (ancestors[0] if ancestors else ()))]


def in_landmark(block: Block) -> bool:
    return any(f in LANDMARKS for f in _within(block.ancestors))


def features(page: list[Block]) -> list[list[str]]:
    """All features of each block."""
    inside = [in_landmark(b) for b in page]
    return [
        [*_within(b.ancestors), *text_features(b.text, b.linked), *place_features(b.ancestors, inside[k], any(inside))]
        for k, b in enumerate(page)
    ]


def place(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % FEATURES


class Field:
    """Weights of a trained field; every label's score is relative to that of ``OTHER``."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.weights, self.transitions, self.start, self.end = weights, transitions, start, end

    def emissions(self, page: list[list[str]]) -> list[float]:
        return [float(sum(self.weights[place(f)] for f in block)) for block in page]

    def viterbi(self, emissions: list[float]) -> list[int]:
        """The best labels of a chain."""
        return viterbi(emissions, self.transitions.tolist(), self.start.tolist(), self.end.tolist())


def viterbi(emissions: list[float], transitions: list[list[float]], start: list[float], end: list[float]) -> list[int]:
    if not emissions:
        return []
    (stay, enter), (leave, go_on) = transitions
    other, main = start[OTHER], start[MAIN] + emissions[0]
    came = []
    for e in emissions[1:]:
        a, b, c, d = other + stay, main + leave, other + enter, main + go_on
        came.append((b > a, d >= c))
        other, main = max(a, b), max(c, d) + e
    label = int(main + end[MAIN] > other + end[OTHER])
    labels = [label]
    for from_main in reversed(came):
        label = int(from_main[label])
        labels.append(label)
    return labels[::-1]


class Likelihood:
    """Log-likelihood of labelled pages and its gradient, for all pages at once."""

    def __init__(self, pages: list[list[list[str]]], labels: list[list[int]]):
        self.lengths = np.array([len(p) for p in pages], np.int64)
        longest = int(self.lengths.max(initial=0))
        flat = [block for page in pages for block in page]
        self.ids = np.array([place(f) for block in flat for f in block], np.int64)
        self.of = np.repeat(np.arange(len(flat)), [len(b) for b in flat])
        self.there = np.arange(longest) < self.lengths[:, None]
        self.labels = np.zeros(self.there.shape, np.int64)
        self.labels[self.there] = [y for page in labels for y in page]
        self.blocks = len(flat)

    def __call__(self, weights: np.ndarray, transitions: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[float, list[np.ndarray]]:
        pages, longest = self.there.shape
        score = np.zeros((pages, longest, 2))
        score[self.there, MAIN] = np.bincount(self.of, weights[self.ids], self.blocks)
        last = self.lengths - 1
        every = np.arange(pages)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            on = self.there[:, t, None]
            step = np.logaddexp(forward[:, t - 1, 0, None] + transitions[0], forward[:, t - 1, 1, None] + transitions[1]) + score[:, t]
            forward[:, t] = np.where(on, step, forward[:, t - 1])
        total = np.logaddexp.reduce(forward[:, -1] + end, axis=1)
        backward[:, -1] = end
        for t in range(longest - 2, -1, -1):
            on = self.there[:, t + 1, None]
            ahead = score[:, t + 1] + backward[:, t + 1]
            step = np.logaddexp(ahead[:, 0, None] + transitions[:, 0], ahead[:, 1, None] + transitions[:, 1])
            backward[:, t] = np.where(on, step, end)
        chance = np.exp(forward + backward - total[:, None, None])
        pair = np.zeros((2, 2))
        seen_pair = np.zeros((2, 2))
        if longest > 1:
            both = self.there[:, 1:]
            joint = forward[:, :-1, :, None] + transitions + (score + backward)[:, 1:, None, :] - total[:, None, None, None]
            pair = np.exp(joint[both]).sum(0)
            np.add.at(seen_pair, (self.labels[:, :-1][both], self.labels[:, 1:][both]), 1)
        label = np.eye(2)[self.labels]
        value = (label[..., MAIN] * score[..., MAIN])[self.there].sum() + (seen_pair * transitions).sum() - total.sum()
        value += start[self.labels[:, 0]].sum() + end[self.labels[every, last]].sum()
        wrong = (label - chance)[self.there][:, MAIN]
        gradient = np.bincount(self.ids, wrong[self.of], FEATURES)
        return float(value), [gradient, seen_pair - pair, (label - chance)[:, 0].sum(0), (label - chance)[every, last].sum(0)]


def fit(pages: list[list[list[str]]], labels: list[list[int]]) -> Field:
    """Gradient ascent with a rate of its own for each weight (Adam); the same for equal input."""
    known = [k for k, p in enumerate(pages) if p]
    parameters = [np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2), np.zeros(2)]
    if not known:
        return Field(*parameters)
    likelihood = Likelihood([pages[k] for k in known], [labels[k] for k in known])
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, ROUNDS + 1):
        _, gradients = likelihood(*parameters)
        for k, g in enumerate(gradients):
            g = g / len(known) - PENALTY * parameters[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            parameters[k] = parameters[k] + RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Field(*parameters)


# Words and names that the parts of written pages are drawn from.
PHRASES = {
    "menu": "Home|About us|Contact|Log in|Sign up|Search|News|Blog|Shop|Help|Products|Archive|Start|Impressum|Inicio|Accueil|Kontakt".split("|"),
    "header": "Welcome|The daily page|Your source of news|Skip to content|Menu|Language".split("|"),
    "sidebar": "Related articles|Popular|Recent posts|Most read|Tags|Categories|Follow us|See also|You may also like|Archives".split("|"),
    "notice": "This site uses cookies to improve your experience.|We value your privacy.|Accept all|Reject|Cookie settings|Please enable JavaScript.|You have reached your free limit.".split("|"),
    "advert": "Advertisement|Sponsored|Buy now and save 50%!|Special offer|Ads by partner|Limited time deal, order today.|Anzeige|Publicidad".split("|"),
    "form": "Subscribe to our newsletter|Your email|Name|Submit|Send|Password|Remember me|Enter your address|Leave a reply".split("|"),
    "comment": "3 comments|Reply|Great post, thanks!|I do not agree with this.|says:|Report|2 hours ago|Add a comment|Log in to comment|first!".split("|"),
    "footer": "© 2024 All rights reserved.|Terms of use|Privacy policy|Imprint|Sitemap|Powered by our platform|Back to top|Copyright".split("|"),
}
NAMES = {
    "menu": "nav menu navbar navigation breadcrumb topnav pagination tabs".split(),
    "header": "header masthead top branding banner site-header".split(),
    "sidebar": "sidebar related widget aside rail recommended popular tags share social".split(),
    "notice": "cookie notice consent gdpr alert modal popup overlay paywall".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad ad-slot".split(),
    "form": "form newsletter subscribe login search signup contact-form".split(),
    "comment": "comments comment comment-list reply discussion respond disqus comment-body".split(),
    "footer": "footer copyright bottom colophon site-footer legal".split(),
    "main": "content main article post entry story article-body post-content entry-content text".split(),
    "plain": "wrapper container row col page inner box section site layout".split(),
}
TAGS = {
    "menu": ("nav", "div", "ul"), "header": ("header", "div"), "sidebar": ("aside", "div", "section"), "notice": ("div", "section", "p", "dialog"),
    "advert": ("div", "aside", "p", "section"), "form": ("form", "div"), "comment": ("section", "div", "ul", "ol"), "footer": ("footer", "div"),
}


def _attributes(r: random.Random, kind: str) -> str:
    name = r.choice(NAMES[kind])
    return r.choice((f' class="{name}"', f' id="{name}"', f' class="{r.choice(NAMES["plain"])} {name}"', f" class={name}"))


def _part(r: random.Random, kind: str, texts: list[str]) -> list[tuple[str, int]]:
    """Markup of one part that is not main text, as (markup, label or -1 for markup without a block)."""
    tag = r.choice(TAGS[kind])
    named = tag in ("div", "p", "ul", "ol", "section") or r.random() < 0.4
    pieces: list[tuple[str, int]] = [(f"<{tag}{_attributes(r, kind) if named else ''}>", -1)]
    for _ in range(r.choice((1, 1, 2, 3, 6)) if kind != "menu" else r.randint(2, 7)):
        # part of the texts are phrases, the others look like any other text: a label must not hang on words
        phrase = r.choice(PHRASES[kind]) if r.random() < 0.5 or not texts else r.choice(texts)
        words = phrase.split()
        longest = {"comment": 60, "sidebar": 12, "advert": 25, "notice": 25, "footer": 20}.get(kind, 4)
        phrase = html.escape(" ".join(words[: r.randint(1, longest)]))
        if kind == "menu" or kind in ("sidebar", "footer") and r.random() < 0.5:
            phrase = f'<a href="/x">{phrase}</a>'
        inner = "li" if tag in ("ul", "ol") else r.choice(("p", "div", "span") if kind not in ("form", "menu") else ("li", "div", "button", "label"))
        inner = "div" if inner in ("span", "label") else inner
        pieces.append((f"<{inner}>{phrase}</{inner}>" if tag != "p" else f"{phrase}</p><p{_attributes(r, kind)}>", OTHER))
    return [*pieces, (f"</{tag}>", -1)]


def _article(r: random.Random, main: list[str], texts: list[str]) -> list[tuple[str, int]]:
    """The article: a heading, paragraphs and lists, at times broken by an advert or followed by comments."""
    tag = r.choice(("article", "main", "div", "div", "section"))
    out: list[tuple[str, int]] = [(f"<{tag}{_attributes(r, 'main') if tag in ('div', 'section') or r.random() < 0.3 else ''}>", -1)]
    inner = r.random() < 0.3
    if inner:
        out.append((f"<div{_attributes(r, r.choice(('plain', 'main')))}>", -1))
    for k, text in enumerate(main):
        # an article may say what other parts say
        text = html.escape(r.choice(PHRASES[r.choice(list(PHRASES))]) if r.random() < 0.08 else text)
        kind = "h1" if k == 0 and r.random() < 0.8 else r.choice(("p",) * 12 + ("h2", "li", "blockquote", "pre", "div"))
        if kind == "li":
            out.append((f"<ul><li>{text}</ul>", MAIN))
        else:
            out.append((f"<{kind}>{text}" + ("" if kind == "p" and r.random() < 0.3 else f"</{kind}>"), MAIN))
        if k and r.random() < 0.08:
            out += _part(r, r.choice(("advert", "sidebar", "notice", "form")), texts)
    if inner:
        out.append(("</div>", -1))
    after = _part(r, r.choice(("comment", "comment", "form", "sidebar")), texts) if r.random() < 0.4 else []
    return [*out, *after, (f"</{tag}>", -1)] if r.random() < 0.5 else [*out, (f"</{tag}>", -1), *after]


def written(r: random.Random, main: list[str], texts: list[str]) -> tuple[str, list[int]]:
    """A page with the blocks of ``main`` as its article and other parts around it, and its blocks' labels."""
    much, more = r.choice((0, 0.5, 0.6)), r.choice((0, 0.5, 0.6))
    before = [k for k in ("notice", "header", "menu", "advert", "sidebar", "form") if r.random() < much]
    behind = [k for k in ("sidebar", "comment", "advert", "form", "menu", "notice", "footer") if r.random() < more]
    pieces = [p for k in before for p in _part(r, k, texts)] + _article(r, main, texts) + [p for k in behind for p in _part(r, k, texts)]
    if r.random() < 0.5:
        pieces = [(f"<div{_attributes(r, 'plain')}>", -1), *pieces, ("</div>", -1)]
    labels = [label for markup, label in pieces if label >= 0]
    return "<html><head><title>x</title></head><body>" + "".join(m for m, _ in pieces) + r.choice(("</body></html>", "")), labels


#: Features that mark a block as other even inside a landmark, when pages of the table are labelled.
_ASIDE = frozenset(
    [f"t:{t}" for t in ("nav", "aside", "footer", "form", "button", "select", "dialog")] + [f"c:{n}" for k, names in NAMES.items() if k not in ("main", "plain") for n in names if "-" not in n]
)


def labelled(page: list[Block]) -> list[int] | None:
    """Labels by landmarks; none for a page without any."""
    labels = [int(in_landmark(b) and not any(f in _ASIDE for f in _within(b.ancestors))) for b in page]
    return labels if any(labels) else None


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Field:
    """Fit the field on a bounded sample of ``pages`` (page_id, html) and on pages written from their texts."""
    # the pages are chosen by numbers alone, so that tasks do not send texts that others displace
    numbered = pages.select(F.xxhash64("page_id").alias("at"), F.xxhash64("html").alias("of"), "html").where(F.length("html").between(1, SAMPLE_CHARS))
    chosen = numbered.groupBy("at", "of").agg(F.lit(1)).orderBy("at", "of").limit(sample_pages).select("at", "of")
    sample = numbered.join(F.broadcast(chosen), ["at", "of"]).dropDuplicates(["at", "of"]).orderBy("at", "of").limit(sample_pages).collect()
    found = [(page, labels) for page in (blocks(row.html) for row in sample) if (labels := labelled(page))]
    found = [(page[:200], labels[:200]) for page, labels in found]
    mains = [[b.text for b, y in zip(page, labels) if y][:12] for page, labels in found]
    r = random.Random(11)
    if not mains:
        mains = [[" ".join("".join(r.choice("aeinorst") for _ in range(r.randint(2, 8))) for _ in range(r.randint(3, 60))) + "." for _ in range(r.randint(2, 8))] for _ in range(100)]
    texts = [t for m in mains for t in m]
    inputs, targets = [features(page) for page, _ in found] * REPEAT, [labels for _, labels in found] * REPEAT
    for main in mains:
        for _ in range(LAYOUTS):
            page, labels = written(r, main, texts)
            inputs.append(features(blocks(page)))
            targets.append(labels)
    return fit(inputs, targets)


def decoder(field: Field):
    """A function from a page to its main text, with the scores of features kept by name."""
    weights, transitions, start, end = field.weights.tolist(), field.transitions.tolist(), field.start.tolist(), field.end.tolist()

    class Known(dict):
        def __missing__(self, feature: str) -> float:
            value = weights[place(feature)]
            if len(self) < 100_000:
                self[feature] = value
            return value

    known = Known()
    around: dict[tuple, tuple[float, bool]] = {}

    def outer(ancestors: tuple) -> tuple[float, bool]:
        """Score of all ancestors, and if one of them is a landmark; equal chains are scored once."""
        if not ancestors:
            return 0.0, False
        value = around.get(ancestors)
        if value is None:
            score, inside = outer(ancestors[1])
            value = score + sum(map(known.__getitem__, ancestors[0])), inside or not LANDMARKS.isdisjoint(ancestors[0])
            if len(around) > 20_000:
                around.clear()
            around[ancestors] = value
        return value

    def extract(page: str) -> str:
        found = blocks(page)
        outers = [outer(b.ancestors) for b in found]
        landmark = any(inside for _, inside in outers)
        scores = []
        for block, (score, inside) in zip(found, outers):
            score += sum(map(known.__getitem__, text_features(block.text, block.linked)))
            score += sum(map(known.__getitem__, place_features(block.ancestors, inside, landmark)))
            scores.append(score)
        return "\n\n".join(b.text for b, label in zip(found, viterbi(scores, transitions, start, end)) if label == MAIN)

    return extract


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""
    field = field or train(pages)
    shared = pages.sparkSession.sparkContext.broadcast((field.weights, field.transitions, field.start, field.end))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = decoder(Field(*shared.value))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [read(page) if page else "" for page in batch.column("html").to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return pages.select("page_id", "url", "html").mapInArrow(run, f"{kinds}, text string, n_chars long")
