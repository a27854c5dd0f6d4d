"""Main text of web pages by maximum-scoring subsequence (dealt operator 3).

A page is a sequence of tokens: words score by what they stand in, tags score
negative.  All weights are log-odds counted over labelled pages (``labelled_pages``,
where <mark> encloses the content and <del> what doesn't belong to it inside): a
word's score sums the weights of the elements around it, their classes, ids and
roles, whether the page has an article or main element that the word is not in,
and links outside paragraphs; a tag's weight compares how often it stands in and
out of the content.  One linear scan finds the contiguous region of the largest
sum.  Its words whose own score is positive are the text: boilerplate inside
the region is left out by the same learned scores.

A name that the labelled pages don't have (or have on both sides) decides
nothing.  A negative element costs the region a bounded sum, so that a long
notice in the middle doesn't cut an article in two, and nothing where the elements around
it are content by a wide margin.
"""

from __future__ import annotations

import html
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW = {"script", "style", "textarea", "title"}
NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
QUOTE_OR_END = re.compile("[\"'>]")
ATTR = re.compile(r"(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORD = re.compile(r"\S+")
CAP = 3.0        # what a negative element may cost a region, in sums of word scores
WIDE = 2.0       # score of the elements around it from which it costs nothing
INLINE = 6       # elements looked up for a link or paragraph around a word
CLIP = 6.0       # most that one name weighs
WORDS, TAGS = ("words",), ("tags",)

# Elements that end a block of text, and those that never hold any.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
                   "search section summary table tbody tfoot thead tr ul caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no text of the page; those of NESTED may hold one of their own kind.
DROPPED = frozenset("noscript template iframe svg head select button object canvas".split())
NESTED = frozenset("template svg object canvas".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
CONTAINERS = frozenset("article main section div nav aside header footer form ul ol menu table td tr li dialog body figure "
                       "blockquote details span p search fieldset dl dd dt a label".split())



class Token:
    """A piece of a page: a tag, an element without text (raw) or a stretch of text."""

    __slots__ = ("attr", "end", "raw", "tag", "text")

    def __init__(self, tag=None, attr="", end=False, raw=None, text=None):
        self.tag, self.attr, self.end, self.raw, self.text = tag, attr, end, raw, text

    def __getitem__(self, name):
        return getattr(self, name)


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Place of the > that ends a tag, quoted ones skipped; -1 if there is none."""
    while m := QUOTE_OR_END.search(page, at):
        if m[0] == ">":
            return m.start()
        # a quote that is never closed is a character like any other
        at = page.index(m[0], m.end()) + 1 if last[m[0]] > m.start() else m.end()
    return -1


def _scan(page: str) -> Iterator[Token]:
    """Tokens of a page in one pass; inside svg a self-closed title, style or script has no content."""
    n, at, svg, quoted = len(page), 0, 0, True
    last = {c: page.rfind(c) for c in "\"'>"}
    while at < n:
        begin = page.find("<", at)
        if begin != at:
            yield Token(text=page[at:begin if begin >= 0 else n])
            if begin < 0:
                return
            at = begin
        if page.startswith("<!--", at):
            stop = page.find("-->", at)
            at = n if stop < 0 else stop + 3
            continue
        if page.startswith(("<!", "<?"), at) and last[">"] > at:
            at = page.index(">", at) + 1
            continue
        end = page.startswith("</", at)
        name = NAME.match(page, at + 1 + end)
        stop = -1
        if name and last[">"] >= name.end():
            stop = _tag_end(page, name.end(), last) if quoted else page.index(">", name.end())
            if stop < 0:      # the rest of the page has no end of a tag outside quotes: look no further for one
                quoted, stop = False, page.index(">", name.end())
        if stop < 0:
            yield Token(text="<")
            at += 1
            continue
        tag, attr, at = name[0].lower(), page[name.end():stop], stop + 1
        if tag in RAW and not end and not (svg and attr.endswith("/")):
            close = RAW_END[tag].search(page, at)
            at = close.end() if close else n
            yield Token(raw=tag)
            continue
        if tag == "svg":
            svg = max(0, svg - 1) if end else svg + (not attr.endswith("/"))
        yield Token(raw=tag) if tag in RAW and not end else Token(tag, attr, end)


def _dropped(found: list[re.Match]) -> dict[int, int]:
    """Start tags of DROPPED elements and where their content ends, as places in ``found``.

    An element without an end tag of its own drops nothing.  head needs none:
    it ends before body, the first element that can't stand in it, or text.
    """
    until: dict[int, int] = {}
    waiting: dict[str, list[int]] = {tag: [] for tag in DROPPED}
    for i, m in enumerate(found):
        tag = (m["tag"] or "").lower()
        if tag not in DROPPED or tag == "head":
            continue
        if not m["end"]:
            if tag == "svg" and m["attr"].endswith("/"):
                continue
            if tag not in NESTED:
                waiting[tag].clear()
            waiting[tag].append(i)
        elif waiting[tag]:
            until[waiting[tag].pop()] = i + 1
    i, head = 0, None
    while i < len(found):
        m, tag = found[i], (found[i]["tag"] or found[i]["raw"] or "").lower()
        if head is None:
            if tag == "head" and not m["end"]:
                head = i
        elif tag == "head" and m["end"]:
            until[head], head = i + 1, None
        elif tag and not m["end"] and tag not in IN_HEAD or m["text"] and not m["text"].isspace():
            until[head], head = i, None
            continue
        i = max(i + 1, until.get(i, 0))
    if head is not None:
        until[head] = len(found)
    return until



def names_of(tag: str, attr: str, inside: bool) -> frozenset:
    """What an element is known by: its tag (and whether it stands in an article or main element), classes, ids, role."""
    found = {("tag", tag, inside)}
    for name, a, b, c in ATTR.findall(attr) if attr and tag not in ("html", "body") else ():
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            found.add(("hidden", "", False))
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            found.add(("hidden", "", False))
        elif name == "role":
            found.add(("role", value.strip(), False))
        elif name in ("class", "id"):
            for part in value.split():
                whole = re.sub(r"\d+", "", part).strip("-_")
                found.add(("name", whole, False))
                pieces = [p for p in re.split(r"[-_]+", whole) if p]
                if len(pieces) > 1:
                    found |= {("piece", p, False) for p in pieces}
    return frozenset(found)


class Item:
    """A token of the scan: kind word, tag or end, its text, and for words the open elements' names from the outside in."""

    __slots__ = ("kind", "marks", "path", "text")

    def __init__(self, kind, text, path, marks=()):
        self.kind, self.text, self.path, self.marks = kind, text, path, marks


class Path:
    """An open element, the names that no element around it has, and the one around it; shared by all tokens inside."""

    __slots__ = ("above", "fresh", "names", "scored", "tag", "top")

    def __init__(self, above, tag: str, names, fresh, top: str):
        self.above, self.tag, self.names, self.fresh, self.top, self.scored = above, tag, names, fresh, top, None


def items_of(page: str) -> list[Item]:
    """The tokens of a page in order, each with the elements that are open there."""
    found = list(_scan(page))
    dropped = _dropped(found)
    out, path, upto = [], None, 0
    open_, known = Counter(), Counter()       # open elements by tag, and by name

    def close():
        nonlocal path
        open_[path.tag] -= 1
        known.subtract(path.names)
        path = path.above

    for i, m in enumerate(found):
        if i < upto:
            continue
        if i in dropped:
            out.append(Item("tag", m.tag, path))
            upto = dropped[i]
        elif m.tag and not m.end:
            tag = m.tag
            if tag in VOID or tag not in CONTAINERS or m.attr.endswith("/") and tag not in ("a", "p"):
                out.append(Item("tag", tag, path))
                continue
            if tag == "p" and path is not None and path.tag == "p":      # an open paragraph ends here
                close()
            top = path.top if path else ""
            names = names_of(tag, m.attr, bool(top))
            own = "article" if tag == "article" else "main" if tag == "main" or ("role", "main", False) in names else ""
            path = Path(path, tag, names, frozenset(n for n in names if not known[n]), top or own)
            open_[tag] += 1
            known.update(names)
            out.append(Item("tag", tag, path))
        elif m.tag:
            out.append(Item("end", m.tag, path))
            if open_[m.tag]:
                while path.tag != m.tag:
                    close()
                close()
        elif m.raw:
            out.append(Item("tag", m.raw, path))
        else:
            out.append(Item("word", m.text, path))
    tops = {x.path.top for x in out if x.path}
    top = "article" if "article" in tops else "main" if "main" in tops else ""
    for x in out:
        if x.kind == "word":
            tags, p = set(), x.path
            for _ in range(INLINE):
                if not p or p.tag not in ("a", "p", "span", "label"):
                    break
                tags.add(p.tag)
                p = p.above
            marks = [("link", "", False)] if "a" in tags and "p" not in tags else []
            if top and (not x.path or x.path.top != top):
                marks.append(("beside", top, False))
            x.marks = tuple(marks)
    return out


def _names(x: Item) -> Iterator[tuple]:
    """All names that tell where a word stands, each once."""
    yield from x.marks
    p = x.path
    while p:
        yield from p.fresh
        p = p.above


# Parts of the labelled pages.  Names on the first side stand around content, on the second around what isn't;
# names of both sides are in pages of either kind, so they decide little.
CONTENT = ("<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div id=main-content>{}</div>", "<div class=post-body>{}</div>",
           "<section>{}</section>", "<div>{}</div>", "{}", "<div role=main>{}</div>", "<main><article class=post>{}</article></main>",
           "<div class=entry-content>{}</div>", "<table><tr><td>{}</td></tr></table>", "<div class=story><div>{}</div></div>")
BODY = ("<h1>{w4}</h1><p>{w30}</p><p>{w20} <b>{w3}</b> <a>{w2}</a> {w9}.</p>", "<header><h1>{w4}</h1></header><p>{w25}</p><ul><li>{w6}</li><li>{w5}</li></ul><p>{w12}</p>",
        "<h2>{w4}</h2><p>{w20}</p><blockquote><p>{w9}</p></blockquote><figure><figcaption>{w5}</figcaption></figure><p>{w9}</p>",
        "<h1>{w5}</h1><div><p>{w15}</p><pre>{w9}</pre></div><ol><li>{w8}</li></ol><dl><dt>{w2}</dt><dd>{w7}</dd></dl>",
        "<h1>{w4}</h1>{w30}<br>{w20}<br>{w12}", "<h3>{w3}</h3><table><tr><th>{w2}</th><td>{w4}</td></tr></table><p class=lead>{w22}</p>",
        "<h1>{w4}</h1><section id={both}><h2>{w3}</h2><p>{w20}</p></section><p class={either}>{w14}</p><div class={both}><p>{w11}</p></div>")
MIXED = ("social-history", "search-results-map", "comment-on-policy", "share-prices", "related-work", "notice-of-meeting", "reply-to-critics", "menu-of-the-day",
         "widget-design", "header-image", "footer-note-text", "login-security", "form-of-government", "promo-code-law", "cookie-recipe", "ad-hoc-report",
         "banner-history", "sidebar-text", "navigation-at-sea", "popup-books", "newsletter-history", "subscription-law", "toolbar-guide", "tags-explained",
         "consent-law", "sponsor-history", "modal-logic", "pager-history", "skip-logic", "teaser-text", "topbar-design", "privacy-law", "signup-rates")
EITHER = ("reply", "note", "quote", "text", "intro", "author", "date", "tags", "share", "social", "search", "related", "header")
ELEMENTS = ("<nav><ul><li><a>{w1}</a></li><li><a>{w2}</a></li></ul></nav>", "<header>{w3} <a>{w2}</a></header>", "<footer>{w9} <a>{w1}</a></footer>",
            "<aside><h3>{w2}</h3><p>{w12}</p></aside>", "<form><label>{w2}</label><p>{w5}</p><button>{w1}</button></form>", "<menu><li>{w2}</li></menu>",
            "<dialog><p>{w8}</p></dialog>", "<search><p>{w3}</p></search>", "<ul><li><a>{w2}</a></li><li><a>{w1}</a></li><li><a>{w2}</a></li></ul>",
            "<table><tr><td><a>{w1}</a></td><td><a>{w1}</a></td></tr></table>", "<div><a>{w2}</a> <a>{w1}</a> <a>{w2}</a></div>", "<div hidden><p>{w9}</p></div>",
            "<div style='display:none'><p>{w7}</p></div>", "<div aria-hidden=true>{w4}</div>")
ROLES = ("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar").split()
KINDS = ("ad ads advert advertisement advertorial banner breadcrumb breadcrumbs comment comments commentlist comment-list comments-area consent cookie cookies "
         "cookie-banner cookie-notice cookie-consent disqus footer site-footer gdpr site-header login masthead menu main-menu modal nav navbar navigation newsletter "
         "newsletter-signup notice notices notification pager pagination paywall popup privacy-notice promo promoted promotion reader-comments related-articles related-posts "
         "read-more replies responses respond search-box search-form share-buttons sharing sidebar side-bar signup skip-link social-links social-share sponsor sponsored "
         "subscribe subscription talkback discussion feedback teaser toolbar topbar widget widgets").split()


def _filled(part: str, turn: int) -> str:
    """A part with its words and names; ``turn`` chooses among names of both sides."""
    part = part.replace("{both}", MIXED[turn % len(MIXED)]).replace("{either}", EITHER[turn % len(EITHER)])
    return re.sub(r"\{w(\d+)\}", lambda m: " ".join(["word"] * int(m[1])), part)


def labelled_pages() -> Iterator[str]:
    """Pages of every kind of content beside and around every kind of other element, by a fixed rule."""
    others = [*ELEMENTS, *(f"<div role={r}><p>{{w9}}</p></div>" for r in ROLES),
              *(f"<{t} {a}={k}>{x}</{t}>" for k in KINDS for t, a, x in (("div", "class", "<p>{w9}</p>"), ("div", "id", "{w6} <a>{w2}</a>"), ("ul", "class", "<li>{w5}</li>"))),
              *(f"<div class={k}><a>{{w1}}</a></div>" for k in EITHER if k not in ("note", "quote", "text", "intro"))]
    turn = itertools.count()
    # every kind of other element before, after and inside every kind of content, then each inside the common ones
    plan = [(content, body, k, None) for content, body in itertools.product(CONTENT, BODY) for k in range(6)]
    plan += [(content, BODY[i % len(BODY)], 1, other) for i, other in enumerate(others) for content in CONTENT[:7]]
    for content, body, k, other in plan:
        t = next(turn)
        before, after, inner = (others[(t * 3 + j) % len(others)] for j in range(3))
        inner = f"<del>{other or inner}</del>" if k % 2 else ""
        if "<article" not in content and "<main" not in content:     # a header of its own is an article's
            body = body.replace("<header>", "").replace("</header>", "")
        front, _, rest = body.partition("</p>")
        whole = f"{front}</p>{inner}{rest}" if rest else body + inner
        yield "<html><body>" + _filled(before, t) + content.format("<mark>" + _filled(whole, t) + "</mark>") + _filled(after, t) + "</body></html>"


def learn(pages=None) -> dict:
    """Weights: log-odds of each name around a word, of any word (WORDS) and of a tag among tokens (TAGS), smoothed, at most CLIP.

    Log-odds compare the content with all else on the labelled pages.
    """
    inside, outside = Counter(), Counter()
    for page in labelled_pages() if pages is None else pages:
        content, left_out = 0, 0
        for x in items_of(page):
            if x.kind != "word" and x.text in ("mark", "del"):
                change = 1 if x.kind == "tag" else -1
                content, left_out = content + change * (x.text == "mark"), left_out + change * (x.text == "del")
                continue
            into = inside if content and not left_out else outside
            if x.kind == "word":
                n = len(WORD.findall(x.text))
                into[WORDS] += n
                for name in _names(x):
                    into[name] += n
            else:
                into[TAGS] += 1

    def odds(key, a, b):
        return max(-CLIP, min(CLIP, math.log((inside[key] + 0.5) / (a + 1)) - math.log((outside[key] + 0.5) / (b + 1))))

    a, b = inside[WORDS], outside[WORDS]
    weights = {key: odds(key, a, b) for key in inside | outside if key not in (WORDS, TAGS)}
    return {**weights, WORDS: math.log((a + 1) / (b + 1)), TAGS: odds(TAGS, a + inside[TAGS], b + outside[TAGS])}


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run of largest sum; empty if no sum is positive; the first of equals."""
    best = total = 0.0
    found, start = (0, 0), 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, found = total, (start, i + 1)
    return found


def _around(path: Path | None, weights: dict) -> tuple[float, object, bool]:
    """(score of a word in these elements, the outermost negative element, whether what is around that is content by a wide margin)."""
    chain = []
    while path is not None and path.scored is None:
        chain.append(path)
        path = path.above
    total, bad, wide = path.scored if path is not None else (weights.get(WORDS, 0.0), None, False)
    for p in reversed(chain):
        before = total
        total += sum(weights.get(n, 0.0) for n in p.fresh)
        if total >= 0:
            bad, wide = None, False
        elif bad is None:
            bad, wide = p, before >= WIDE
        p.scored = total, bad, wide
    return total, bad, wide


def scored(items: list[Item], weights: dict) -> list[float]:
    """Each token's score: words between -1 and 1 a word, tags below 0; a negative element costs CAP at most."""
    out, spent = [], Counter()
    for x in items:
        total, bad, wide = _around(x.path, weights)
        if x.kind == "word":
            total += sum(weights.get(n, 0.0) for n in x.marks)
            value = max(-1.0, min(1.0, total)) * len(WORD.findall(x.text))
        else:
            value = min(0.0, weights.get(TAGS, 0.0)) / 4
        if value < 0 and bad is not None:
            value = 0.0 if wide else max(value, -CAP - spent[id(bad)])
            spent[id(bad)] += value
        out.append(value)
    return out


def main_text(page: str | None, weights: dict, whole: bool = False) -> str:
    """Text of the best region (of the page, if ``whole``): blocks joined by line feeds, white space inside one turned into one space."""
    if not page:
        return ""
    items = items_of(page)
    scores = scored(items, weights)
    a, b = (0, len(items)) if whole else best_region(scores)
    blocks, now = [], []
    for x in items[a:b]:
        if x.kind == "word":
            total = _around(x.path, weights)[0] + sum(weights.get(n, 0.0) for n in x.marks)
            if total > 0:
                now.append(x.text)
        elif x.text in BLOCKS:
            blocks.append("".join(now))
            now = []
        elif x.text in ("br", "td", "th", "img", "wbr"):
            now.append(" ")
    blocks.append("".join(now))
    clean = (" ".join(html.unescape(x).split()) for x in blocks)
    return "\n".join(x for x in clean if x)


def extract(pages: DataFrame, weights: dict | None = None) -> DataFrame:
    """(row, text, n_chars) per row of ``pages`` (html); ``row`` is the whole input row as a struct.

    Null and empty html, and pages where no region scores above zero, have an
    empty text.  Repeated rows get equal texts; pages of any length are read
    whole, in time that grows with their length; an empty table gives an empty result.
    """
    weights = learn() if weights is None else weights
    rows = pages.select(F.struct("*").alias("row"), F.col("html").cast("string").alias("html"))

    def run(batches):
        for batch in batches:
            text = [main_text(x.as_py(), weights) for x in batch.column("html")]
            yield pa.record_batch({"row": batch.column("row"), "text": pa.array(text, pa.string()),
                                   "n_chars": pa.array([len(t) for t in text], pa.int64())})

    return rows.mapInArrow(run, T.StructType([rows.schema["row"]]).add("text", "string").add("n_chars", "long"))
