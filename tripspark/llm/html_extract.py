"""Main text of web pages by consensus host paths.

First every page's containers are scored by the text that stands in them.  A container is named by
its generalised path, the tags and classes from the root with digits left out.  Pages vote: scores
of equal paths are added up over all pages of a host in Spark, and the best path wins.  It is raised
to the article around it: to an article or main element, or to containers that add text and not
links.  Then every page is read again and its text taken from the containers on the raised path, with
the text that stands directly in the containers around; a page that lacks it votes alone.

Votes are summed in tasks before they are shuffled, so a host with very many pages is no burden.

Time and memory grow in proportion to a page, however deep its elements are nested: its paths are
nodes of a trie, and elements point to what stands around them.  A path of more than ``NAMED`` steps
is written as its first steps, its own tag and a hash of the rest; equal paths are still equal and
others differ, but only its first steps count as what stands around it when it is raised.
"""

import heapq
import html
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ..sources.shared import materialise

#: Hosts' winners that may be broadcast, about 200 bytes each; beyond it they are joined by shuffle.
BROADCAST_HOSTS = 50_000
#: Votes that a task holds before it hands them on.
HELD = 200_000
#: Steps of a path that are written out.
NAMED = 64

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(
    r"""([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

#: Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noframes template".split())
#: Elements that hold no main text.
DROPPED = frozenset("""script style noscript template iframe noframes object embed svg math canvas
    audio video map button select option textarea input label nav header footer aside menu dialog
    head title xmp""".split())
#: Elements that hold none unless the page stands in them.
FORMS = frozenset(["form", "fieldset"])
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl
    dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main
    menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
CONTAINERS = frozenset("article body center div main section td html".split())
#: A start tag that ends open elements of these kinds, up to the nearest of the second kind.
ENDS = [({"li"}, {"ul", "ol", "menu"}), ({"dt", "dd"}, {"dl"}), ({"tr", "td", "th"}, {"table"}),
        ({"td", "th"}, {"tr", "table"}), ({"option"}, {"select"})]
_ENDING = frozenset().union(*(closed | bound for closed, bound in ENDS))
CLOSES = {"li": 0, "dt": 1, "dd": 1, "tr": 2, "td": 3, "th": 3, "option": 4}
#: Words of class, id or role that mark what is not main text.
MARKS = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment
    comments consent cookie cookies disqus footer masthead menu modal nav navbar navigation
    newsletter notice pagination popup promo promoted related respond sidebar share sharing social
    sponsor sponsored subscribe toolbar widget""".split())
#: Last words of names like comment-list, which tell a mark's part of the page ...
PARTS = frozenset("""area bar block body box button buttons column container content footer form group
    header holder icons inner item items link links list main outer panel region row section slot
    thread top bottom unit wrap wrapper zone""".split())
#: ... and words of names like has-sidebar, which tell something of another element.
ABOUT = frozenset("has have no non not with without show shows hide hides is".split())
#: A marked element that holds this share of the page's unlinked text is the page.
BULK = 0.75
#: The whole body is the article if it adds this share of a host's text.
BODY = 0.25
_NAMES = re.compile(r"[a-z]+")
_INLINE_SPACE = re.compile(r"\s+")


class _Path:
    """A generalised path as a node of its page's trie; ``first`` and ``last`` number its subtree."""

    __slots__ = ("step", "depth", "kids", "head", "key", "first", "last")

    def __init__(self, up=None, step=""):
        self.step, self.kids = step, {}
        self.depth = up.depth + 1 if up else 0
        if self.depth <= NAMED:
            self.head, self.key = f"{up.head}/{step}" if up else "", ""
        else:
            self.head = up.head
            self.key = xxhash.xxh3_128_hexdigest(f"{up.key}/{step}")

    def below(self, step):
        found = self.kids.get(step)
        if found is None:
            found = self.kids[step] = _Path(self, step)
        return found

    @property
    def name(self):
        if not self.key:
            return self.head
        return f"{self.head}/{self.step.split('.')[0]}.~{self.key}"


def _numbered(root):
    """{name: path} of a trie, whose subtrees are numbered."""
    names, stack, number = {}, [(root, False)], 0
    while stack:
        path, done = stack.pop()
        if done:
            path.last = number - 1
            continue
        path.first, number = number, number + 1
        names[path.name] = path
        stack.append((path, True))
        stack += [(kid, False) for kid in path.kids.values()]
    return names


class _Node:
    """An element; ``marked``, ``story``, ``container`` and ``block`` are the nearest that is marked,
    the nearest article or main, container and block, itself or around it.  ``open`` holds, by kind
    of ``ENDS``, the outermost element that a start tag would end."""

    __slots__ = ("tag", "path", "dropped", "link", "parent", "marked", "story", "container", "block",
                 "open")

    def __init__(self, tag, path, dropped, link, parent, marked=False):
        self.tag, self.path, self.dropped, self.link, self.parent = tag, path, dropped, link, parent
        self.marked = self if marked else parent and parent.marked
        self.story = self if tag in ("article", "main") else parent and parent.story
        self.container = self if parent is None or tag in CONTAINERS else parent.container
        self.block = self if parent is None or tag in BLOCKS else parent.block
        self.open = parent.open if parent else (None,) * len(ENDS)
        if tag in _ENDING:
            self.open = tuple(None if tag in bound else top or (self if tag in closed else None)
                              for top, (closed, bound) in zip(self.open, ENDS))


def _attributes(text):
    out = {}
    for match in _ATTRIBUTE.finditer(text):
        out.setdefault(match[1].lower(), match[2] or match[3] or match[4] or "")
    return out


def _names_mark(name):
    """Whether a class, id or role says that the element itself holds no main text."""
    own = _NAMES.findall(name)
    if not own or not ABOUT.isdisjoint(own):
        return False
    return own[-1] in MARKS or own[-1] in PARTS and not MARKS.isdisjoint(own)


def _open(tag, raw, parent):
    """A new element below ``parent``."""
    classes, dropped, marked = "", parent.dropped or tag in DROPPED, tag in FORMS
    if raw and not raw.isspace():
        found = _attributes(raw)
        classes = " ".join(sorted(re.sub(r"\d+", "", c) for c in found.get(
            "class", "").replace("/", "|").split()))  # a slash parts the steps of a path
        if tag not in ("html", "body", "main", "article"):
            names = " ".join(found.get(k, "") for k in ("class", "id", "role")).lower()
            marked = marked or any(map(_names_mark, names.split()))
            dropped = dropped or (
                "hidden" in found or found.get("aria-hidden") == "true"
                or "display:none" in found.get("style", "").replace(" ", "").lower())
    step = f"{tag}.{classes.replace(' ', '.')}" if classes else tag
    return _Node(tag, parent.path.below(step), dropped, parent.link or tag == "a", parent, marked)


def _kept_marks(cut):
    """The marked elements that are the page itself and stay.

    While no article or main has text outside of dropped elements, the marked element with most
    text of such is kept; so is one with the bulk of the page's unlinked text, unless an article
    stands outside of it and it is no form.
    """
    texts, stories, order, total = {}, {}, {}, 0
    free = None  # text of an article or main that is in no marked element
    for pieces in cut:
        for node, text in pieces:
            size = 0 if node.link else len(text.strip())
            if not size:
                continue
            total += size
            if node.marked is None:
                free = free or node.story
                continue
            texts[node.marked] = texts.get(node.marked, 0) + size
            if node.story is not None and node.story.marked is node.marked:
                stories[node.marked] = stories.get(node.marked, 0) + size
    if not texts:
        return frozenset()
    for node in texts:  # number what is marked, the outer before the inner
        chain = []
        while node is not None and node not in order:
            chain.append(node)
            node = node.parent.marked
        for own in reversed(chain):
            order[own] = len(order)
    sums, told = dict.fromkeys(order, 0), dict.fromkeys(order, 0)
    for node in reversed(order):
        sums[node] += texts.get(node, 0)
        told[node] += stories.get(node, 0)
        around = node.parent.marked
        if around is not None:
            sums[around] += sums[node]
            told[around] += told[node]
    inner = {}
    for node in order:
        inner.setdefault(node.parent.marked, []).append(node)
    kept, reached, at = set(), [], None
    while free is None:
        for node in inner.get(at, ()):
            if told[node]:
                heapq.heappush(reached, (-told[node], order[node], node))
        if not reached:
            break
        at = heapq.heappop(reached)[2]
        kept.add(at)
        if at in stories:
            free = at
    for node in order:
        around = node.parent.marked
        if (around is None or around in kept) and sums[node] >= BULK * total and (
                free is None or node.tag in FORMS):
            kept.add(node)
    return kept


def blocks(source, root=None):
    """[(element that holds it, text)] of each block of a page in order; markup may be broken.

    Paths are put below ``root``.  A block is the text between two borders of block elements.  Dropped elements give none.
    """
    cut = list(_cut(source, root or _Path()))
    kept, stays, found = _kept_marks(cut), {None: True}, []
    for pieces in cut:
        own = []
        for node, text in pieces:
            chain, at = [], node.marked
            while at not in stays:
                chain.append(at)
                at = at.parent.marked
            for mark in reversed(chain):
                stays[mark] = mark in kept and stays[mark.parent.marked]
            if stays[node.marked]:
                own.append((node, text))
        text = " ".join(html.unescape("".join(t for _, t in own)).split())
        if text:
            found.append((own[0][0], text))
    return found


def _cut(source, path):
    """Yield each block as its pieces, (element, text), with those of marked elements."""
    root = _Node("", path, False, False, None)
    here, pieces, at, depths = root, [], 0, Counter()  # how many elements of a tag are open

    def end(node):
        while node is not here:
            depths[node.tag] -= 1
            node = node.parent

    while at < len(source):
        match = _TOKEN.search(source, at)
        if not match:
            if not here.dropped:
                pieces.append((here, source[at:]))
            break
        if match.start() > at and not here.dropped:
            pieces.append((here, source[at:match.start()]))
        at = match.end()
        tag = match[2].lower() if match[2] else None
        if tag is None:
            continue
        ends = match[1] == "/"
        if tag in BLOCKS and pieces:
            yield pieces
            pieces = []
        if tag in ("br", "wbr"):
            if pieces and tag == "br":
                pieces.append((here, " "))
            continue
        if ends:
            if depths[tag]:
                left = here
                while here.tag != tag:
                    here = here.parent
                here = here.parent
                end(left)
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            closing = re.compile(rf"</{tag}\s*(?:>|\Z)", re.I).search(source, at)
            at = closing.end() if closing else len(source)
            continue
        left = here
        if tag in BLOCKS and here.block.tag == "p":  # a paragraph ends where another block begins
            here = here.block.parent
        if tag in CLOSES and here.open[CLOSES[tag]]:
            here = here.open[CLOSES[tag]].parent
        end(left)
        if not match[3].rstrip().endswith("/") or tag not in ("path", "g", "circle"):
            here = _open(tag, match[3], here)
            depths[tag] += 1
    if pieces:
        yield pieces


def _value(text):
    return len(text) + 25.0 * len(re.findall(r"[.,;:!?]", text))


def scored(source, root=None):
    """{container: score} and the blocks of a page as (container, text, whether it is a link).

    A block of running text counts its length for the container in which it stands and half of it
    for the next one around; links count nothing.
    """
    scores, found = {}, []
    for node, text in blocks(source, root):
        holder = node.container
        found.append((holder, text, node.link))
        if node.link:
            continue
        value = _value(text)
        scores[holder] = scores.get(holder, 0.0) + value
        if holder.parent is not None:
            above = holder.parent.container
            scores[above] = scores.get(above, 0.0) + value / 2
    return scores, found


def page_votes(source, root=None):
    """({path: [score, value of text directly there, value of links]}, blocks) of a page.

    A page has one vote, shared among its paths.
    """
    scores, found = scored(source, root)
    total, own = sum(scores.values()), {}
    if total:
        for node, score in scores.items():
            own.setdefault(node.path, [0.0, 0.0, 0.0])[0] += score / total
        for node, text, link in found:
            own.setdefault(node.path, [0.0, 0.0, 0.0])[1 + link] += _value(text) / total
    return {path.name: values for path, values in own.items()}, found


def _depth(path, other):
    """How many steps two paths have in common from the root."""
    same = 0
    for a, b in zip(path.split("/")[1:], other.split("/")[1:]):
        if a != b:
            break
        same += 1
    return same


def _within(path, inside):
    return inside is not None and inside.first <= path.first <= inside.last


def raised(path, levels):
    """The path of the article around the winning one.

    ``levels``: {depth: (value of text, value of links)} of what shares so many steps with the path.
    """
    steps = path.split("/")
    tags = [step.split(".")[0] for step in steps]
    for k in range(len(steps) - 1, 0, -1):
        if tags[k] in ("article", "main"):
            return "/".join(steps[:k + 1])
    top, text, links = len(steps) - 1, 0.0, 0.0
    whole = sum(own for own, _ in levels.values())
    for k in range(len(steps) - 2, 0, -1):
        own = levels.get(k, (0.0, 0.0))
        text, links = text + own[0], links + own[1]
        if tags[k] not in CONTAINERS or not text:
            continue
        if links > text or tags[k] in ("body", "html") and text < BODY * whole:
            break
        top, text, links = k, 0.0, 0.0
    return "/".join(steps[:top + 1])


def _taken(found, names, path, top):
    """The blocks of the article; none if the page has nothing on the raised path."""
    story = top.rpartition("/")[2].split(".")[0] in ("article", "main")
    path, top = names.get(path), names.get(top)
    out, hit = [], False
    for node, text, link in found if top else ():
        if _within(node.path, top):
            hit = True
            if story or not link or _within(node.path, path):
                out.append(text)
        elif not link and _within(top, node.path) and (not story or node.tag == "main"):
            out.append(text)
    return out if hit else []


def extract(source, path, top=None):
    """The main text of a page by its host's winning path and that path raised, or by its own."""
    root = _Path()
    own, found = page_votes(source, root)
    names = _numbered(root)
    taken = _taken(found, names, path, path if top is None else top) if path is not None else []
    if not taken and own:
        best = max(own, key=lambda p: (own[p][0], p))
        levels = {}
        for other, (_, text, links) in own.items():
            at = levels.setdefault(_depth(best, other), [0.0, 0.0])
            at[0], at[1] = at[0] + text, at[1] + links
        taken = _taken(found, names, best, raised(best, levels))
    return "\n".join(taken or [text for _, text, _ in found])


_VOTES = "host string, path string, score double, text double, links double"
_LEVELS = "host string, path string, depth int, text double, links double"


def _votes(batches):
    def rows():
        hosts, paths = zip(*votes)
        return pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
             *map(pa.array, zip(*votes.values()))],
            names=["host", "path", "score", "text", "links"])

    votes = {}
    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(),
                                batch.column("html").to_pylist()):
            for path, values in page_votes(source or "")[0].items():
                held = votes.setdefault((host, path), [0.0, 0.0, 0.0])
                for i, value in enumerate(values):
                    held[i] += value
            if len(votes) > HELD:
                yield rows()
                votes.clear()
    if votes:
        yield rows()


def _levels(batches):
    for batch in batches:
        depths = [_depth(a, b) for a, b in zip(batch.column("path").to_pylist(),
                                               batch.column("other").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("path"), pa.array(depths, pa.int32()),
             batch.column("text"), batch.column("links")],
            names=["host", "path", "depth", "text", "links"])


def _raise(batches):
    for batch in batches:
        paths = batch.column("path")
        tops = [raised(path, {x["depth"]: (x["text"], x["links"]) for x in levels})
                for path, levels in zip(paths.to_pylist(), batch.column("levels").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), paths, pa.array(tops, pa.string())],
            names=["host", "path", "top"])


def _texts(batches):
    for batch in batches:
        texts = [extract(source or "", path, top) for source, path, top in zip(
            *(batch.column(c).to_pylist() for c in ("html", "path", "top")))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64()), batch.column("path")],
            names=["page_id", "url", "text", "n_chars", "path"])


def host_of(url):
    """The host in lower case, without user and port; a null or other url has the host ''."""
    host = F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def host_paths(pages):
    """The winning path of each host, and that path raised: host, path, top."""
    docs = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string"))
    votes = materialise(docs.mapInArrow(_votes, _VOTES).groupBy("host", "path").agg(
        *[F.round(F.sum(c), 6).alias(c) for c in ("score", "text", "links")]), "votes")
    best = votes.groupBy("host").agg(F.max(F.struct("score", "path")).alias("best")).select(
        "host", "best.path")
    # One row for each depth of a host's path.
    levels = votes.withColumnRenamed("path", "other").join(best, "host").select(
        "host", "path", "other", "text", "links").mapInArrow(_levels, _LEVELS).groupBy(
        "host", "path", "depth").agg(*[F.round(F.sum(c), 6).alias(c) for c in ("text", "links")])
    return levels.groupBy("host", "path").agg(F.collect_list(F.struct(
        "depth", "text", "links")).alias("levels")).mapInArrow(
        _raise, "host string, path string, top string")


def extract_pages(pages):
    """One row per input row: page_id, url, text, n_chars, path (the host's, for reference).

    A null html is empty and gives ''.  Repeated rows and null ids or urls are rows like others.
    """
    winners = materialise(host_paths(pages), "paths")
    docs = pages.select("page_id", F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"),
                        host_of(F.col("url")).alias("host"))
    if winners.count() <= BROADCAST_HOSTS:
        winners = F.broadcast(winners)
    kind = pages.schema["page_id"].dataType.simpleString()
    return docs.join(winners, "host", "left").select(
        "page_id", "url", "html", "path", "top").mapInArrow(
        _texts, f"page_id {kind}, url string, text string, n_chars long, path string")
