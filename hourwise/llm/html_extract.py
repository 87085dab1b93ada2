"""Main text of web pages by a maximum-scoring subsequence of their tokens.

A page is a sequence of tags and text runs. Each word scores +1; each tag scores a negative weight, and so does, once and
whatever its size, each element that is not content. One linear scan finds the contiguous region with the highest
sum, and the blocks of its content words are the text. Tags inside a labelled article, and all that stands outside of
the articles of a page that has some, cost nothing, so that no article, and no part of one behind an advert, is lost.

Weights come from labelled pages: those with one outermost ``article`` or ``main`` element, whose words inside are
content (articles of a discussion are none). Spark counts, for each tag and each (tag, class or id word), how many of its words and tags lie inside and
outside, over the ``train_pages`` labelled pages with the lowest hash of id and html, or all if there are fewer. The model
holds every tag and word found in ``MIN_PAGES`` of them, so its size is bounded by the sample, not by a cut. An element known by
a class, id or role word that stands outside (log-odds under ``OUT``, in ``MIN_PAGES`` pages) is not content; a
tag that often stands outside costs up to ``TAG``. Elements that never hold article text by their meaning are named in
``NOT_TAGS`` and ``NOT_WORDS``; the header of an article does.

Where names are not taken at their word: html and body; names that tell a state ("no-sidebar", ``STATE``); inside an
article, names of paragraphs, headings, cells and phrases, and ids of several words that are not all names of page parts
("related-work"). Any other element named so is left out, at any size, if there is content outside of such elements (on a page with
``article`` or ``main`` elements, content in these). If all content is in named elements, the largest that is no discussion is
read like one without a name, and so on inside it. A form or fieldset, which often wraps a page, is also read so if it
holds more than half of the words and the content beside it is under a ``BESIDE``-th of its own.

Defined cases: null or empty html, and pages without a positive region, give an empty text; an unclosed
element ends with its parent; a paragraph ends at the next block; the head is not an element of its own, as its end
may be left out; a quoted attribute value may hold any character but its quote. An element of ``RAW`` or ``HIDDEN`` reaches to its end tag. Without one, a script or style ends where the page's
structure goes on (``_STRUCTURE``) or with the page, a title or textarea at the next tag, and the others, like a self-closed
svg, are empty. Of regions with the same sum the one that ends first is taken, and then the shortest. No length limit; the work is linear in the page, however deep it
nests. Repeated rows give a row each and are learned from once; an empty table gives no rows; only page_id, url and html are
read, other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwise.llm.common import travels

travels(__name__)

#: Labelled pages that training reads.
TRAIN_PAGES = 5000
#: Cost of a tag that is always outside, and of a tag of which nothing is known.
TAG, UNKNOWN_TAG = -3.25, -0.5
OUT, MIN_PAGES = -2.0, 5

# Elements and class, id or role words that are not article text.
NOT_TAGS = frozenset("aside button datalist dialog fieldset footer form header menu nav".split())
NOT_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment commentlist comments "
    "complementary consent contentinfo cookie cookies disclaimer disqus footer form gdpr header login masthead menu "
    "modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted "
    "promotion related replies reply respond search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget widgets".split())
# Elements named above that may also hold the whole page, and names of what readers add, which may be longer than an article.
WRAPS = frozenset("fieldset form".split())
REPLIES = frozenset("comment commentlist comments disqus replies reply respond".split())
BESIDE = 5
# Words of names that tell a state of the page, words of page parts, and elements that are no containers.
STATE = frozenset("closed disabled enabled has hide is no off on open show with without".split())
PARTS = NOT_WORDS | frozenset(
    "area articles bar block box container content inner links list main outer page posts section site stories top "
    "wrap wrapper".split())
PHRASES = frozenset(
    "a abbr b blockquote caption cite code dd dfn dt em figcaption h1 h2 h3 h4 h5 h6 i kbd li mark p pre q s small span "
    "strong sub summary sup td th time tr u".split())
# Elements that hold characters and no elements, and elements whose content is not read as text.
RAW = frozenset("iframe noembed noframes noscript script style textarea title".split())
HIDDEN = frozenset("annotation annotation-xml applet audio canvas object select svg template video".split())
#: Those that a reader of the whole page sees as text.
SEEN = frozenset("object select textarea".split())
#: Formulas are words of their sentence; their tags cost nothing.
MATH = frozenset(
    "maction math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
CONTENT = ("article", "main")
OWN_HEADER = frozenset("article entry post story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<({'|'.join(sorted(RAW | HIDDEN))})(?=[\s/>])[^>]*+>"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^<>])*+)>|<[!?/][^<>]*+>", re.I | re.S)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I) for name in RAW}
_STRUCTURE = re.compile(r"</?(?:head|body|html|article|main)(?=[\s/>])", re.I)
_TAG = re.compile(r"<(?=[a-z/!])", re.I)
_HINT = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z0-9]+")


def _keys(tag: str, attributes: str, in_article: bool = False) -> tuple[str, ...]:
    """What an element is known by: tag and class, id and role words, or the tag alone."""
    words = []
    for m in _HINT.finditer(attributes) if attributes else ():
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            parts = _NAME.findall(name)
            if STATE & set(parts) or in_article and m[1].lower() == "id" and len(parts) > 1 and not PARTS >= set(parts):
                words.append("_".join(parts))  # a name as a whole
                continue
            # the header of an article holds its heading
            words += [w for w in parts if w != "header" or not OWN_HEADER & set(parts)]
    return tuple(f"{tag}.{w}" for w in words) or (tag,)


class _Element:
    """An open element; the page itself is one without a parent."""

    __slots__ = ("parent", "tag", "keys", "article", "inside", "reply", "never", "named", "words", "plain", "other", "out")

    def __init__(self, parent: _Element | None, tag: str, keys: tuple[str, ...]):
        self.parent, self.tag, self.keys = parent, tag, keys
        above = parent is not None
        named = tag not in ("html", "body") and not (above and parent.article and tag in PHRASES)
        self.article = tag == "article" or above and parent.article
        self.reply = above and parent.reply or named and any(k.partition(".")[2] in REPLIES for k in keys)
        # a content element or in one; an article of a discussion is none
        self.inside = above and parent.inside or tag in CONTENT and not self.reply
        # the header of an article holds its heading
        self.never = above and (parent.never or tag in NOT_TAGS and tag not in WRAPS and not (tag == "header" and parent.article))
        # whether a name counts
        self.named = named
        self.out = False
        self.words = self.plain = self.other = 0


def _marks(page: str, seen: frozenset) -> tuple[list, dict[int, int]]:
    """Comments and tags as (match, end of the raw content, end), and the places of the start and end tags of hidden elements."""
    marks: list[tuple] = []
    starts: dict[str, list[int]] = {}
    until: dict[int, int] = {}
    endless = set()  # raw elements without an end tag in the rest of the page
    at = 0
    while m := _TOKEN.search(page, at):
        stop = at = m.end()
        if m[1]:
            name = m[1].lower()
            if name in RAW:
                if end := None if name in endless else _END[name].search(page, at):
                    stop, at = end.span()
                else:
                    endless.add(name)
                    if name in ("script", "style"):
                        stop = at = found.start() if (found := _STRUCTURE.search(page, at)) else len(page)
                    elif name in ("textarea", "title"):
                        stop = at = found.start() if (found := _TAG.search(page, at)) else len(page)
            elif name not in seen and not (name == "svg" and m[0].endswith("/>")):
                starts.setdefault(name, []).append(len(marks))
        elif m[2] and (own := starts.get(m[3].lower())):
            until[own.pop()] = len(marks)
        marks.append((m, stop, at))
    return marks, until


def tokens(page: str, seen: frozenset = frozenset(), made: list[_Element] | None = None):
    """(kind, value, element it stands in) in page order: ("tag", name, element) or ("text", raw text, element).

    ``seen``: elements of ``SEEN`` whose content counts as text. ``made`` gets all elements, the page first.
    """
    made = [] if made is None else made
    made.append(here := _Element(None, "", ()))
    marks, until = _marks(page, seen)
    at = i = 0
    opened: Counter = Counter()  # open elements by tag

    def closed(e: _Element, tag: str) -> _Element:
        """What is open once the innermost element of the tag has ended; nothing ends if there is none."""
        if not opened[tag]:
            return e
        while e.tag != tag:
            opened[e.tag] -= 1
            e = e.parent
        opened[tag] -= 1
        return e.parent

    while i < len(marks):
        m, stop, end = marks[i]
        if m.start() > at:
            yield "text", page[at:m.start()], here
        if i in until:
            i = until[i]
            end = marks[i][2]
        i += 1
        at = end
        if m[1]:
            if (tag := m[1].lower()) in seen:
                yield "tag", tag, here
                if stop > m.end():
                    yield "text", page[m.end():stop], here
            continue
        if not (tag := m[3]):
            if (raw := m[0])[:9].upper() == "<![CDATA[":
                yield "text", raw[9:-3], here
            continue
        tag = tag.lower()
        if m[2]:
            here = closed(here, tag)
            yield "tag", tag, here
            continue
        if tag in BLOCK and tag != "br":
            here = closed(here, "p")
        yield "tag", tag, here
        if tag not in VOID and tag != "head" and not m[4].endswith("/"):
            made.append(here := _Element(here, tag, _keys(tag, m[4], here.article)))
            opened[tag] += 1
    if at < len(page):
        yield "text", page[at:], here


def _judge(found: list[tuple], made: list[_Element], out, labelled: bool) -> bool:
    """Sets ``out`` of the elements that are not content; whether any words are. Of a labelled page only words of its content elements count."""
    named = {}
    for e in made:
        e.words, e.out = 0, False
        named[e] = e.never or e.tag in WRAPS or e.named and any(k in out or k.partition(".")[2] in NOT_WORDS for k in e.keys)
    for kind, value, e in found:
        if kind == "text" and (e.inside or not labelled) and not e.never:
            e.words += len(value.split())
    for e in made:
        e.plain = e.words
    for e in reversed(made):
        if e.parent is not None:
            e.parent.words += e.words
            e.parent.plain += 0 if named[e] else e.plain
    words, content, read = made[0].words, made[0].plain, set()
    wraps = lambda e: e.tag in WRAPS and 2 * e.words > words and BESIDE * content < e.words
    while True:
        outer, changed = [], False  # the outermost named elements that are not read
        for e in made[1:]:
            e.out = e.parent.out
            if not e.out and named[e] and e not in read:
                if wraps(e) and not e.reply:
                    read.add(e)
                    content += e.plain
                else:
                    e.out = True
                    outer.append(e)
        if not content:
            # an article that is named so is none of the labels
            best = max((e for e in outer if e.words and not e.never and not (labelled and (e.tag in CONTENT or e.reply))), key=lambda e: (not e.reply, e.words), default=None)
            if best is not None:
                read.add(best)
                content += best.plain
                changed = True
        if not changed:
            return content > 0


def _labelled(made: list[_Element]) -> bool:
    return sum(e.inside and not e.parent.inside for e in made) == 1


def count_page(page: str) -> Counter:
    """(kind, key, inside) -> count, of a labelled page; empty for others."""
    out: Counter = Counter()
    made: list[_Element] = []
    found = list(tokens(page, made=made))
    if not _labelled(made):
        return out
    for kind, value, e in found:
        if kind == "tag":
            out["tag", value, e.inside] += 1
        elif e.inside:
            e.words += len(value.split())
        else:
            e.other += len(value.split())
    for e in reversed(made[1:]):
        e.parent.words += e.words
        e.parent.other += e.other
    # a key counts where no element around has it too
    around, above = [made[0]], Counter()
    for e in made[1:]:
        while around[-1] is not e.parent:
            above.subtract(around.pop().keys)
        for k in set(e.keys):
            if not above[k]:
                for inside, n in ((True, e.words), (False, e.other)):
                    if n:
                        out["word", k, inside] += n
        above.update(e.keys)
        around.append(e)
    return out


def _counts(batches):
    for batch in batches:
        total, pages = Counter(), Counter()
        for page in batch.column("html").to_pylist():
            found = count_page(page)
            total.update(found)
            pages.update({(kind, key) for kind, key, _ in found})
        keys = sorted(pages)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([total[(*k, True)] for k in keys], pa.int64()), pa.array([total[(*k, False)] for k in keys], pa.int64()),
             pa.array([pages[k] for k in keys], pa.int64())], names=["kind", "key", "inside", "outside", "pages"])


def _hashes(batches):
    """Hashes of labelled pages."""
    for batch in batches:
        found = []
        for page, h in zip(batch.column("html").to_pylist(), batch.column("h").to_pylist()):
            for _ in tokens(page, made=(made := [])):
                pass
            if _labelled(made):
                found.append(h)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["h"])


def sample(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """(h, html) of ``train_pages`` different labelled pages, those of the lowest hashes, or of all if there are fewer.

    A surplus of pages is drawn by hash and parsed; more are drawn only if too few of them are labelled.
    """
    # a page without such a tag has no label
    p = pages.filter(F.col("html").rlike(rf"(?i)<(?:{'|'.join(CONTENT)})[\s/>]")).select(F.xxhash64("page_id", "html").alias("h"), "html")
    below = lambda share: p if share >= 1 else p.filter(F.col("h") < int((share - 0.5) * 2.0 ** 64))
    share = min(1.0, 2 * train_pages / max(1, p.count()))
    while True:
        chosen = below(share).mapInArrow(_hashes, "h long").distinct().orderBy("h").limit(train_pages).collect()
        if len(chosen) == train_pages or share >= 1:
            break
        share = min(1.0, 4 * share)
    return below(share).join(F.broadcast(pages.sparkSession.createDataFrame(chosen, "h long")), "h").dropDuplicates(["h"])


def learn(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> dict:
    """{"tag": weight of each tag, "out": keys whose words are not content}."""
    counts = sample(pages, train_pages).select("html").mapInArrow(_counts, "kind string, key string, inside long, outside long, pages long")
    found = (counts.groupBy("kind", "key")
             .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"), F.sum("pages").alias("pages"))
             .filter(F.col("pages") >= MIN_PAGES)
             .filter((F.col("kind") == "tag") | F.col("key").contains(".") & (F.col("outside") > F.col("inside"))).collect())
    weights = {r.key: TAG * r.outside / (r.inside + r.outside) for r in found if r.kind == "tag"}
    out = [r.key for r in found if r.kind == "word" and math.log((r.inside + 1) / (r.outside + 1)) < OUT
           and "." in r.key and r.key.partition(".")[0] not in CONTENT]
    return {"tag": weights, "out": out}


def extract(page: str | None, model: dict) -> str:
    """The main text of a page."""
    if not page:
        return ""
    weights, out = model["tag"], model["out"]
    made: list[_Element] = []
    found = list(tokens(page, made=made))
    labelled = any(kind == "text" and e.inside and value.strip() for kind, value, e in found)
    if not _judge(found, made, out, labelled) and labelled:
        labelled = False  # nothing in its content elements is content
        _judge(found, made, out, labelled)
    runs: list[str | None] = []  # content text, "\n" between blocks, or None
    best = total = 0.0
    start = first = last = 0
    left_out = False  # in an element that is not content
    for i, (kind, value, e) in enumerate(found):
        if e.out and not labelled:
            score, left_out = 0.0 if left_out else TAG, True  # once, whatever its size
        else:
            score, left_out = 0.0, e.out
        if kind == "tag":
            runs.append("\n" if value in BLOCK else None)
            # on a page with articles a tag says nothing about where they end
            if not (value in MATH or labelled or e.out):
                score = min(0.0, weights.get(value, UNKNOWN_TAG))
        else:
            fine = not e.out and (e.inside or not labelled)
            runs.append(value if fine else None)
            if fine:
                score = float(len(value.split()))
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, first, last = total, start, i + 1
    if not best:
        return ""
    blocks, block = [], []
    for run in [*runs[first:last], "\n"]:
        if run != "\n":
            block.append(run or "")
            continue
        if text := " ".join(html.unescape("".join(block)).split()):
            blocks.append(text)
        block = []
    return "\n".join(blocks)


def extracted(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    model = learn(pages, train_pages)
    model["out"] = frozenset(model["out"])
    shared = pages.sparkSession.sparkContext.broadcast(model)  # at most the keys of the sample

    def run(batches):
        for batch in batches:
            texts = [extract(page, shared.value) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])
    p = pages.select("page_id", "url", "html")
    return p.mapInArrow(run, T.StructType([p.schema["page_id"], p.schema["url"], T.StructField("text", T.StringType()),
                                           T.StructField("n_chars", T.LongType())]))
