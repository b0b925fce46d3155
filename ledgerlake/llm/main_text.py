"""Main text of web pages: site templates found by counting subtrees, then removed.

1. A page is read into nested elements, as browsers do where end tags are missing. Every block
   element that has text gets a hash of its tag, its text and its children's hashes.
2. Spark counts, per host, on how many pages each subtree occurs. A template is a subtree on
   at least ``LEAST_PAGES`` pages of a host that hold at least a share of the host's pages:
   ``SHARE_OUTSIDE`` outside the page's article, ``SHARE_INSIDE`` within it, since copied
   articles recur too. However large the host, it also is one if it has ``MANY`` different
   surroundings and these are at least ``DIFFERENT`` of its pages: a part of a copied article
   has the same ones each time. Surroundings are the page's longest block (the article's, for
   what is in it); what holds that block is no template this way. Lone cells, items and headings recur as words do, and go by
   the share alone.
3. Menus and footers whose words differ from page to page recur by their shape: path, tags, class
   names and kinds of leaves, without text, equal children in a row as one. Two kinds of subtrees
   are counted so, by the same pass: those of ``LINKS`` link-only blocks at least, and, on pages without
   an article, a last one of short texts without a paragraph or heading beside what holds the longest block.
   Neither may hold the longest block; outside an article neither may stand beside it in the same parent. A shape is a template at
   ``SHARE_SHAPE`` of the host's pages, at ``SHARE_NAMED`` if the subtree has a noisy name.
4. A page's text are the blocks of its article (of its body, if it has no article or main
   element) without templates and without what is no article by its element, class, id or
   role: menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles.
   Within the article a name alone decides only if a whole class or id is made of noisy words that mean
   nothing else (``comments``, ``ad-box``); ``entry-header`` or ``discussion`` only lower the share of 3.
   A form or an element of such a name that holds the article is its wrapper, not noise.

Counts are pre-aggregated before they are shuffled, as numbers: by subtree and surroundings,
then by subtree. A host has fewer than (subtrees of a page) / ``SHARE_OUTSIDE`` templates by
share and (subtrees of its pages) / ``MANY`` others; the list is joined to the host's pages by
whatever join the sizes call for, which Spark may split at a host with very many pages, and
made a set once for all pages of a host that follow each other.
"""

from __future__ import annotations

import html as html_text
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_arrow, settle

LEAST_PAGES = 5
SHARE_OUTSIDE = 0.1
SHARE_INSIDE = 0.5
MANY = 500
DIFFERENT = 0.25
SHARE_SHAPE = 0.5
SHARE_NAMED = 0.1
#: Link-only blocks that make a list of links, and characters of a short text.
LINKS = 3
SHORT = 200
#: How a subtree is counted: by its words outside or in the article, by its shape, by its shape with a noisy name.
OUTSIDE, INSIDE, SHAPE, NAMED = range(4)
#: Share of a page's text that makes a form or an element of a noisy name its wrapper, if it has no article.
WRAPS = 0.75

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of these ends an open one of the same set, up to the nearest element of the second set.
SIBLINGS = [
    (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    (frozenset("dt dd".split()), frozenset(["dl"])),
    (frozenset("td th".split()), frozenset("tr table".split())),
    (frozenset(["tr"]), frozenset("table tbody thead tfoot".split())),
    (frozenset(["option"]), frozenset("select datalist".split())),
]
ENDS_PARAGRAPH = BLOCK - frozenset("td th tr tbody thead tfoot caption body html head legend summary".split())
KEEPS_PARAGRAPH = frozenset("td th caption body html article main section div li blockquote button".split())

#: Elements that are no template by ``MANY``.
LONE = frozenset("li dt dd td th tr caption figcaption legend summary h1 h2 h3 h4 h5 h6".split())

NOISE_TAGS = frozenset(
    "head nav footer aside form menu noscript iframe template button select option svg canvas object audio "
    "video map search".split()
)
#: Noise outside the article only.
NOISE_TAGS_OUTSIDE = frozenset("header dialog fieldset datalist label".split())
#: What may stand in a head; anything else that starts ends an open one.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: What holds a page's own words; a subtree with one of these is a template by its shape only as a list of links.
WORDY = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 article main".split())
#: Nothing in these is the page's article: they are not shown, or not as text.
NEVER_SHOWN = frozenset("head noscript iframe template select option datalist button svg canvas object audio video map".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial banner sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup login menu menus nav navbar navigation navi topnav breadcrumb breadcrumbs pagination pager sidebar "
    "sidebars aside rail widget widgets header masthead footer foot comment comments respond replies reply disqus "
    "discussion share sharing social related recommended recommendations outbrain taboola toc skip form".split()
)
#: Within the article a class or id is noise alone if one of its words is of the first set and all are of either.
SURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies gdpr newsletter signup nav navbar "
    "topnav breadcrumb breadcrumbs pagination pager sidebar sidebars comment comments disqus share sharing popup modal "
    "outbrain taboola".split()
)
BESIDE_SURE = NOISE_WORDS | frozenset(
    "area bar block box bottom button buttons container count inner item items left link links list page post right site "
    "slot top unit wrap wrapper".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class _Traits:
    """What class, id and role of an element say.

    ``noise``: a noisy word (or a form by its role); ``sure``: a name of nothing but such; ``by_role``:
    noise by role; ``comment``: reader comments; ``main``: main content. ``names``: its classes without digits.
    """

    __slots__ = ("noise", "sure", "by_role", "comment", "main", "names")

    def __init__(self, attributes: str):
        self.noise = self.sure = self.by_role = self.comment = self.main = False
        self.names = ""
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = html_text.unescape("".join(values))
            name = name.lower()
            if name == "role":
                role = value.strip().lower()
                self.noise = self.noise or role == "form"
                self.sure = self.sure or role == "form"
                self.by_role = self.by_role or role in NOISE_ROLES - {"form"}
                self.main = self.main or role == "main"
                continue
            if name == "class":
                self.names = " ".join(sorted(set(re.sub(r"[0-9]+", "", value).split())))
            for token in value.split():
                words = frozenset(_PART.findall(_CAMEL.sub(" ", token).lower()))
                self.noise = self.noise or not NOISE_WORDS.isdisjoint(words)
                self.comment = self.comment or "comment" in words or "comments" in words
                self.sure = self.sure or (not SURE_WORDS.isdisjoint(words) and all(w in BESIDE_SURE or w.isdigit() for w in words))


_PLAIN = _Traits("")


class _Noise:
    """An element that is noise by its tag, class, id or role, in the one around it.

    ``named``: a form, or noise by class or id alone; such an element may be a wrapper of the article.
    ``within`` is the noise that the article around it stands in.
    """

    __slots__ = ("outer", "within", "named", "only_named")

    def __init__(self, outer: _Noise | None, within: _Noise | None, named: bool):
        self.outer, self.within, self.named = outer, within, named
        self.only_named = named and (outer is None or outer.only_named)

    def path(self) -> Iterator[_Noise]:
        at: _Noise | None = self
        while at is not None:
            yield at
            at = at.outer


class _Region:
    """What an article or main element holds, or the body outside them.

    ``named``: a main element or role. ``noise`` is what it stands in, ``chars`` its text without noise.
    """

    __slots__ = ("main", "named", "noise", "chars")

    def __init__(self, main: bool, named: bool, noise: _Noise | None):
        self.main, self.named, self.noise = main, named, noise
        self.chars = 0


class _Element:
    """An open element; ``kinds`` are its leaves and its children's shapes, ``links``, ``texts`` its leaves by kind.

    ``path`` hashes the block elements from the body down to it with their names, ``noisy`` if its own name is.
    """

    __slots__ = ("tag", "noise", "region", "closed", "begin", "parts", "path", "noisy", "kinds", "links", "texts", "wordy")

    def __init__(self, tag: str, noise: _Noise | None, region: _Region, closed: bool, begin: int, path: int, noisy: bool):
        self.tag, self.noise, self.region, self.closed, self.begin = tag, noise, region, closed, begin
        self.path, self.noisy = path, noisy
        self.parts: list[str] = []
        self.kinds: list[str] = []
        self.links = self.texts = 0
        self.wordy = False  # a paragraph, a heading or a long text is in it

    def add_kind(self, kind: str) -> None:
        if not self.kinds or self.kinds[-1] != kind:
            self.kinds.append(kind)


class _Shape:
    """A subtree that may be a template by its shape; ``around`` are the first block of its parent and the one after its last."""

    __slots__ = ("key", "region", "begin", "end", "listed", "noisy", "around")

    def __init__(self, key: int, region: _Region, begin: int, end: int, listed: bool, noisy: bool):
        self.key, self.region, self.begin, self.end, self.listed, self.noisy = key, region, begin, end, listed, noisy
        self.around = (0, 0)


class Page:
    """The blocks of a page and the hashed subtrees that hold them.

    ``blocks``: (text, whether in the article, whether noise). ``subtrees``: (hash, OUTSIDE, INSIDE, SHAPE
    or NAMED, first block, block after the last). ``lone``: the hashes of cells, items and headings.
    """

    def __init__(self, html: str):
        self.blocks: list[tuple[str, bool, bool]] = []
        self.subtrees: list[tuple[int, int, int, int]] = []
        self.has_main = False
        self._body = _Region(False, False, None)
        self._regions: list[_Region] = []
        self._found: list[tuple[str, _Region, _Noise | None]] = []
        self._trees: list[tuple[int, _Region, int, int]] = []
        self._noises: list[_Noise] = []
        self.lone: set[int] = set()
        self._shapes: list[_Shape] = []
        self._unlinked = False
        self._open = [_Element("", None, self._body, False, 0, 0, False)]
        self._within: list[list[_Shape]] = [[]]  # the shapes right below each open element
        self._count: Counter[str] = Counter()
        self._text: list[str] = []
        self._read(html)
        self._judge()

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        self._text.clear()
        if text:
            top = self._open[-1]
            self._found.append((text, top.region, top.noise))
            if top.noise is top.region.noise:
                top.region.chars += len(text)
            top.parts.append(text)
            if not self._unlinked:
                top.add_kind("a")
                top.links += 1
            else:
                top.add_kind("s" if len(text) <= SHORT else "t")
                top.texts += 1
                top.wordy = top.wordy or len(text) > SHORT
        self._unlinked = False

    def _start(self, tag: str, attributes: str) -> None:
        if self._count["head"] and (tag == "body" or self._open[-1].tag == "head" and tag not in IN_HEAD):
            self._end("head")
        if tag in BLOCK:
            self._flush()
            if tag in ENDS_PARAGRAPH and self._count["p"]:
                self._end_within(frozenset(["p"]), KEEPS_PARAGRAPH)
            for same, within in SIBLINGS:
                if tag in same and any(self._count[t] for t in same):
                    self._end_within(same, within)
        elif tag == "br":
            self._text.append(" ")
        if tag in VOID:
            return
        parent = self._open[-1]
        traits = _Traits(attributes) if attributes else _PLAIN
        by_name, by_role, comment = traits.noise, traits.by_role, traits.comment
        if tag in ("html", "body"):
            by_name = by_role = comment = False
        named = traits.main or tag == "main"
        main = (named or tag == "article") and not comment and not parent.closed
        region, noise = parent.region, parent.noise
        if main and (not region.main or noise is not region.noise):
            # It ends the noise around it for what it holds, if it turns out to be the page's article.
            region = _Region(True, named, noise)
            self._regions.append(region)
        if region.main:
            is_noise = tag in NOISE_TAGS or by_role or by_name and traits.sure and (tag in BLOCK or not comment)
        else:
            is_noise = tag in NOISE_TAGS or tag in NOISE_TAGS_OUTSIDE or by_name or by_role
        if not main and is_noise:
            named_only = tag == "form" or tag not in NOISE_TAGS | NOISE_TAGS_OUTSIDE and not by_role
            noise = _Noise(noise, region.noise, not comment and named_only)
            self._noises.append(noise)
        changed = region is not parent.region or (noise is None) != (parent.noise is None)
        if changed and tag not in BLOCK:
            self._flush()
        closed = parent.closed or comment or tag in NEVER_SHOWN
        path = _hashed(f"{parent.path:x} {tag} {traits.names}") if tag in BLOCK else parent.path
        self._open.append(_Element(tag, noise, region, closed, len(self._found), path, by_name))
        self._within.append([])
        self._count[tag] += 1

    def _end_within(self, tags: frozenset[str], barriers: frozenset[str]) -> None:
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at].tag in tags:
                self._close(at)
                return
            if self._open[at].tag in barriers:
                return

    def _end(self, tag: str) -> None:
        if not self._count[tag]:
            return
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at].tag == tag:
                self._close(at)
                return

    def _close(self, at: int) -> None:
        """Ends the element at this depth and all within it."""
        while len(self._open) > at:
            top = self._open[-1]
            if top.tag in BLOCK or (top.noise, top.region) != (self._open[-2].noise, self._open[-2].region):
                self._flush()
            self._open.pop()
            within = self._within.pop()
            self._count[top.tag] -= 1
            parent = self._open[-1]
            if not top.parts:
                continue
            if top.tag in BLOCK:
                end = len(self._found)
                key = _hashed("\x00".join([top.tag, *top.parts]))
                self._trees.append((key, top.region, top.begin, end))
                if top.tag in LONE:
                    self.lone.add(key)
                parent.parts.append(format(key, "x"))
                for shape in within:
                    shape.around = (top.begin, end)
                shape_key = _hashed("\x00".join([format(top.path, "x"), *top.kinds]))
                parent.add_kind(format(shape_key, "x"))
                parent.wordy = parent.wordy or top.wordy or top.tag in WORDY
                listed = top.links >= LINKS and not top.texts
                if listed or not top.wordy and top.tag not in WORDY:
                    shape = _Shape(shape_key, top.region, top.begin, end, listed, top.noisy)
                    self._shapes.append(shape)
                    self._within[-1].append(shape)
            else:
                parent.parts.extend(top.parts)
                for kind in top.kinds:
                    parent.add_kind(kind)
                parent.wordy = parent.wordy or top.wordy
                self._within[-1].extend(within)
            parent.links += top.links
            parent.texts += top.texts

    def _read(self, html: str) -> None:
        at = 0
        while True:
            found = _TAG.search(html, at)
            if found is None:
                break
            if found.start() > at:
                self._add(html[at : found.start()])
            at = found.end()
            tag = (found[2] or found[5] or "").lower()
            if not tag:
                continue
            if found[1] or found[4]:
                self._end_tag(tag)
                continue
            attributes = found[3] or found[6] or ""
            if tag in RAW and not attributes.endswith("/"):
                close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
                at = close.end() if close else len(html)
                continue
            self._start(tag, attributes)
        if at < len(html):
            self._add(html[at:])
        self._close(1)
        self._flush()

    def _add(self, text: str) -> None:
        if self._open[-1].tag == "head" and not text.isspace():
            self._end("head")
        text = html_text.unescape(text)
        if not self._count["a"] and not self._unlinked:
            self._unlinked = any(map(str.isalnum, text))
        self._text.append(text)

    def _judge(self) -> None:
        """Decides what is the article and which noise only wraps it; fills blocks and subtrees.

        Articles outside noise always are. One within noise is if it has more text than what
        is there without it (or is a main element, and the only one): then what it stands in is
        no noise for it, nor for others in the same. Without any, a wrapper that holds at
        least ``WRAPS`` of the text outside menus and comments is no noise.
        """
        wraps: set[_Noise] = set()
        clean = [r for r in self._regions if r.noise is None]
        noisy = [r for r in self._regions if r.noise is not None]
        if noisy:
            best = max(noisy, key=lambda r: (r.named and not clean, r.chars))
            there = sum(r.chars for r in clean) if clean else self._body.chars
            if (best.named and not clean) or best.chars > there:
                wraps.update(best.noise.path())
        shown = {r: r.noise is None or r.noise in wraps for r in self._regions}
        self.has_main = any(shown.values())
        if not self.has_main:
            held: Counter[_Noise | None] = Counter()
            for text, _, noise in self._found:
                if noise is None or noise.only_named:
                    held[noise] += len(text)
            for noise in reversed(self._noises):
                held[noise.outer] += held[noise]
            wraps.update(n for n in self._noises if held[n] and held[n] >= WRAPS * held[None])
        # From the outer to the inner: noise that is no wrapper, and all within it up to the next article.
        hides: set[_Noise] = set()
        for noise in self._noises:
            if noise not in wraps or not noise.named or (noise.outer is not noise.within and noise.outer in hides):
                hides.add(noise)

        def hidden(region: _Region, noise: _Noise | None) -> bool:
            return noise is not region.noise and noise in hides

        self.blocks = [
            (text, shown.get(region, False), hidden(region, noise) or not shown.get(region, region is self._body))
            for text, region, noise in self._found
        ]
        self.subtrees = [(key, INSIDE if shown.get(region, False) else OUTSIDE, begin, end) for key, region, begin, end in self._trees]
        at = self._longest(self.has_main)
        last, container = len(self._found), self._container(at)
        for shape in self._shapes:
            beside = shape.around == container
            inside = shown.get(shape.region, False)
            if shape.begin <= at < shape.end or inside < self.has_main:
                continue
            if shape.listed:
                fits = inside or not beside
            else:
                fits = not self.has_main and shape.end == last and shape.around[0] <= at < shape.begin and not beside
            if fits:
                self.subtrees.append((shape.key, NAMED if shape.noisy else SHAPE, shape.begin, shape.end))

    def _longest(self, within: bool) -> int:
        """The longest block that is no noise, of the article or of all; -1 without one."""
        sizes = [len(text) if not noise and (inside or not within) else 0 for text, inside, noise in self.blocks]
        at = max(range(len(sizes)), key=sizes.__getitem__, default=-1)
        return at if at >= 0 and sizes[at] else -1

    def _container(self, at: int) -> tuple[int, int]:
        """The blocks of the least element that holds this block and others, none if there is no such element."""
        held = [(end - begin, begin) for _, _, begin, end in self._trees if begin <= at < end and end - begin > 1]
        size, begin = min(held, default=(0, 0))
        return begin, begin + size

    def _end_tag(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        self._end(tag)

    def surroundings(self) -> dict[tuple[int, int], int]:
        """By (hash, kind) of a subtree, a hash of the longest block, 0 if that is part of it and for shapes."""
        found: dict[tuple[int, int], int] = {}
        longest = []
        for within in (False, True):
            at = self._longest(within)
            longest.append((at, _hashed(self.blocks[at][0]) if at >= 0 else 0))
        for key, kind, begin, end in self.subtrees:
            if kind in (SHAPE, NAMED):
                found[key, kind] = 0
                continue
            at, hashed = longest[kind == INSIDE]
            found.setdefault((key, kind), 0 if begin <= at < end or key in self.lone else hashed)
        return found

    def text(self, templates: frozenset[tuple[int, int]] = frozenset()) -> str:
        gone = np.zeros(len(self.blocks) + 1, np.int64)
        for key, kind, begin, end in self.subtrees:
            if (key, kind) in templates:
                gone[begin] += 1
                gone[end] -= 1
        covered = np.cumsum(gone)
        return "\n\n".join(
            text
            for k, (text, inside, noise) in enumerate(self.blocks)
            if not noise and not covered[k] and (inside or not self.has_main)
        )


def _hashed(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def _signed(key: int) -> int:
    return key - (1 << 64) if key >= 1 << 63 else key


def _subtree_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    hosts, keys, kinds, beside = [], [], [], []
    for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        for (key, kind), around in Page(html).surroundings().items():
            hosts.append(host)
            keys.append(_signed(key))
            kinds.append(kind)
            beside.append(_signed(around))
    yield pa.RecordBatch.from_arrays(
        [pa.array(hosts, pa.int64()), pa.array(keys, pa.int64()), pa.array(kinds, pa.int32()), pa.array(beside, pa.int64())],
        names=["host", "subtree", "kind", "beside"],
    )


def _texts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    out = []
    keep = batch.columns[:-3]
    ends = batch.column(batch.num_columns - 2).offsets.to_numpy()
    all_keys, all_kinds = (column.values.to_numpy(zero_copy_only=False) for column in batch.columns[-2:])
    last, templates = b"", frozenset()
    for k, html in enumerate(batch.columns[-3].to_pylist()):
        keys = all_keys[ends[k] : ends[k + 1]]
        if (packed := keys.tobytes()) != last:
            kinds = all_kinds[ends[k] : ends[k + 1]].tolist()
            last, templates = packed, frozenset((key % (1 << 64), kind) for key, kind in zip(keys.tolist(), kinds))
        out.append(Page(html).text(templates))
    yield pa.RecordBatch.from_arrays(
        [*keep, pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())],
        names=[*batch.schema.names[:-3], "text", "n_chars"],
    )


def host_of(url: str) -> Column:
    """A hash of the address's host in lower case; null if it has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(F.length(host) > 0, F.xxhash64(host))


def site_templates(pages: DataFrame) -> DataFrame:
    """(host, subtrees, kinds): the template subtrees of each host that has any."""
    keyed = pages.select(host_of("url").alias("host"), F.coalesce("html", F.lit("")).alias("html")).where("host is not null")
    per_host = keyed.groupBy("host").agg(F.count("*").alias("pages"))
    subtrees = map_arrow(keyed, _subtree_rows, "host long, subtree long, kind int, beside long")
    counted = subtrees.groupBy("host", "subtree", "kind", "beside").agg(F.count("*").alias("n"))
    # No surroundings, 0, are no different ones.
    different = F.sum((F.col("beside") != 0).cast("long"))
    frequent = counted.groupBy("host", "subtree", "kind").agg(F.sum("n").alias("n"), different.alias("different"))
    frequent = frequent.where(F.col("n") >= LEAST_PAGES)
    shares = {OUTSIDE: SHARE_OUTSIDE, INSIDE: SHARE_INSIDE, SHAPE: SHARE_SHAPE, NAMED: SHARE_NAMED}
    share = F.element_at(F.create_map(*(F.lit(x) for pair in shares.items() for x in pair)), F.col("kind"))
    many = (F.col("different") >= MANY) & (F.col("different") >= DIFFERENT * F.col("n"))
    found = frequent.join(per_host, "host").where((F.col("n") >= share * F.col("pages")) | many)
    return found.groupBy("host").agg(F.collect_list("subtree").alias("subtrees"), F.collect_list("kind").alias("kinds"))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages(page_id, url, html)``.

    Null and empty html give an empty text. Pages without a host in their url, null urls too,
    have no templates. Repeated rows count as several pages and come back as often. Other
    columns are ignored; an empty table gives no row.
    """
    templates = settle(site_templates(pages), "templates")
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of("url").alias("host"))
    joined = keyed.join(templates, "host", "left").select("page_id", "url", "html", "subtrees", "kinds")
    schema = ", ".join(f"{name} {kind}" for name, kind in pages.select("page_id", "url").dtypes)
    return map_arrow(joined, _texts, f"{schema}, text string, n_chars long")
