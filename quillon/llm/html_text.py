"""Main text of web pages by the maximum-scoring subsequence.

A page is read as a sequence of words and tags. Words score by where they stand,
mostly positive, tags negative; one linear scan finds the contiguous region with the
largest sum, and its text is taken without the boilerplate elements inside it.

The weights are learned from labelled pages: those that mark their main text up
themselves (``article``, ``main``, ``role=main`` or ``itemprop=articleBody``). Over all
such pages the words inside and outside the marked element are counted by the elements
around them, and the tags likewise; a weight is the log ratio of the two. Counts are
added up per batch before the shuffle. Every feature seen has its weight. Up to
``SHARED_FEATURES`` weights are broadcast; of a larger model the most frequent are, and
the others are joined to the pages that they occur in. Results do not depend on which.

Boilerplate elements are those of certain tags and roles, and those with a class or id
all of whose parts are in ``BOILERPLATE_NAMES`` ("cookie-notice", not "related-work");
of elements inside a marked one only the class counts, as an id there is the slug of a
heading. Any other name is a feature with a learned weight, no more. Such a name says nothing on ``html``, ``body``,
``main``, an article that stands in no other article, or an element around the marked
main element (a marked one found only inside named elements must be of some size beside
the rest of the page, or it is a comment or a teaser). Nor does it where it leaves next
to nothing: in the marked element, or in a page that marks none, the largest named
element counts as content when it holds ``NAMED_SHARE`` of the words outside the other
named ones, and so on inside it.

A boilerplate element inside a marked one is cut out and costs the region nothing. In a
page that marks none it costs ``SIDE_BLOCK`` once, however long it is; outside the
marked elements of a page its words cost as any.

Text: character references decoded, white space inside a block one blank, blocks in
page order joined by one blank. Headings inside the main text belong to it.

Cases: null html counts as empty; a page without words in a positive place gives an
empty text. Markup cut off at the end of a page is dropped, an element left open ends
with the page. Each row stands for itself, also with a null or repeated ``page_id``. An
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import html
import math
import re
from collections import ChainMap, Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.batches import each_batch
from quillon.operators.joins import lookup_join
from quillon.session import stored

#: Weights held in one broadcast.
SHARED_FEATURES = 200_000
#: Words where nothing is known; bounds of a word's and of a tag's score.
PLAIN_WORD, WORD_BOUND, TAG_MOST, TAG_LEAST = 0.3, 3.0, -0.05, -2.0
SIDE_BOUND, MAIN_BOUND = 3.0, 12.0
#: Score of a whole boilerplate element where no element is marked.
SIDE_BLOCK = -3.0

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|title|head)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-z!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
NAME_PARTS = re.compile(r"[a-z]+", re.IGNORECASE)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: A start tag of these ends an open paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header"
    " hr main nav ol p pre section table ul".split()
)
#: A start tag ends an open element of the same name.
ENDS_OWN = frozenset("li dt dd tr td th option".split())
CONTAINERS = frozenset("div section span td tr table tbody body html center".split())
BOILERPLATE_TAGS = frozenset(
    "nav footer aside form button select dialog menu object fieldset head".split()
)
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar footer masthead banner cookie cookies consent notice alert"
    " popup modal comment comments reply disqus share sharing social related recommended"
    " newsletter subscribe signup login search widget pagination pager copyright".split()
)
MAIN_NAMES = frozenset(("main", "articlebody"))
#: Share of the words from which a named element is the content.
NAMED_SHARE = 0.9
#: Words of a marked element inside named ones to the words outside those, from which it counts.
MARKED_SHARE = 0.25


class _Element:
    """An open element; what its ancestors decide for it is inherited when it is made."""

    __slots__ = (
        "tag", "parent", "features", "main", "side", "named", "in_main", "in_article",
        "direct", "words", "outer_side", "score",
    )

    def __init__(self, tag: str, rest: str, parent: _Element | None) -> None:
        classes, ids, marks = [], [], set()
        for key, value in ATTRIBUTE.findall(rest) if rest else ():
            tokens = [NAME_PARTS.findall(t) for t in value.strip("\"'").lower().split()]
            if key.lower() in ("role", "itemprop"):
                marks.update(value.strip("\"'").lower().split())
            else:
                (ids if key.lower() == "id" else classes).extend(t for t in tokens if t)
        self.tag, self.parent = tag, parent
        self.features = sorted({f".{'-'.join(parts)}" for parts in (*classes, *ids)})
        if tag and tag not in CONTAINERS:
            self.features.append(tag)
        self.main = tag in ("article", "main") or not marks.isdisjoint(MAIN_NAMES)
        in_main, in_article = (parent.in_main, parent.in_article) if parent else (False, False)
        self.side = (
            tag in BOILERPLATE_TAGS
            or (tag == "header" and not in_main)
            or not marks.isdisjoint(("navigation", "banner", "complementary", "contentinfo"))
        )
        # An id inside a marked element is as a rule the slug of a heading.
        names = classes if in_main else classes + ids
        self.named = not self.side and any(BOILERPLATE_NAMES.issuperset(parts) for parts in names)
        if self.named and (tag in ("html", "body") or self.main and not (tag == "article" and in_article)):
            self.forget_names()
        self.in_main, self.in_article = in_main or self.main, in_article or tag == "article"
        #: Words of its own, and of all below it that are in no element set aside by its tag.
        self.direct = self.words = 0
        self.outer_side: _Element | None = None
        self.score = 0.0

    def forget_names(self) -> None:
        """The listed names of this element say nothing about its words."""
        self.named = False
        self.features = [
            f for f in self.features if f[0] != "." or not BOILERPLATE_NAMES.issuperset(f[1:].split("-"))
        ]


Event = tuple[str, str, _Element]


class Page:
    """The tags and texts of a page, each with the innermost open element.

    ``elements`` holds every element after its parent, the first being the page itself.
    Reading and judging take time in proportion to the page, however deep it nests.
    """

    def __init__(self, source: str) -> None:
        self.elements = [_Element("", "", None)]
        self.events: list[Event] = list(_read(source, self.elements))
        if any(element.named for element in self.elements):
            self._judge_names()
        for element in self.elements[1:]:
            above = element.parent.outer_side
            element.outer_side = above or (element if element.side else None)

    def _judge_names(self) -> None:
        """Decide which elements with a listed name are boilerplate."""
        elements = self.elements
        aside = {}
        for element in elements:
            aside[element] = element.side or (element.parent is not None and aside[element.parent])
        for tag, text, element in self.events:
            if not tag and not aside[element]:
                element.words += _words(text)
        for element in reversed(elements[1:]):
            element.parent.words += element.words
        total = elements[0].words
        # Per element, above it: the outermost named one, and how many.
        outermost: dict[_Element, _Element | None] = {elements[0]: None}
        count = {elements[0]: 0}
        for element in elements[1:]:
            above = element.parent
            outermost[element] = outermost[above] or (above if above.named else None)
            count[element] = count[above] + above.named
        marked = [e for e in elements[1:] if e.main and e.words and not e.parent.in_main]
        if marked:
            # Articles below a named element, such as comments, do not count beside others,
            # nor where the page has its words elsewhere.
            least = min(count[e] for e in marked)
            marked = [e for e in marked if count[e] == least]
            if least:
                elsewhere = total - sum(e.words for e in {outermost[e] for e in marked})
                if max(e.words for e in marked) < MARKED_SHARE * elsewhere:
                    marked = []
            seen = set()
            for element in marked:
                outer = element.parent
                while outer is not None and outer not in seen:
                    seen.add(outer)
                    if outer.named:
                        outer.forget_names()
                    outer = outer.parent
        self._release_names({e: e.words for e in marked} or {elements[0]: total})
        for element in elements:
            element.side |= element.named

    def _release_names(self, regions: dict[_Element, int]) -> None:
        """Named elements that hold nearly all words of their region are content."""
        inside: dict[_Element, list[_Element]] = {}
        # The innermost region or named element above; no region below None.
        above: dict[_Element, _Element | None] = {self.elements[0]: None}
        for element in self.elements:
            if element.parent is not None:
                parent = element.parent
                above[element] = parent if parent.named or parent in regions else above[parent]
            if element.named and element not in regions and above[element] is not None:
                inside.setdefault(above[element], []).append(element)
        todo = list(regions.items())
        while todo:
            region, words = todo.pop()
            named = inside.get(region)
            if named:
                largest = max(named, key=lambda e: e.words)
                others = words - sum(e.words for e in named)
                if largest.words and largest.words >= NAMED_SHARE * (largest.words + others):
                    largest.named = False
                    todo.append((largest, largest.words))


def read_page(source: str) -> Page:
    """(tag or empty, text, innermost open element) of each tag and text of the page."""
    return Page(source)


def _read(source: str, made: list[_Element]) -> Iterator[Event]:
    opened = [made[0]]
    # Of each open element: the innermost one, itself included, that is no inline one.
    blocks = [0]
    open_tags: Counter = Counter()

    def close(size: int) -> None:
        for element in opened[size:]:
            open_tags[element.tag] -= 1
        del opened[size:], blocks[size:]

    for found in TOKEN.finditer(source):
        text = found["text"]
        if text is not None:
            yield "", text, opened[-1]
            continue
        if found["raw"]:
            yield found["raw"].lower(), "", opened[-1]
            continue
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        if found["close"]:
            if open_tags[tag]:
                place = len(opened) - 1
                while opened[place].tag != tag:
                    place -= 1
                close(place)
        else:
            name = opened[blocks[-1]].tag
            if name == tag and tag in ENDS_OWN or name == "p" and tag in ENDS_PARAGRAPH:
                close(blocks[-1])
            if tag not in VOID:
                opened.append(_Element(tag, found["rest"], opened[-1]))
                blocks.append(blocks[-1] if tag in INLINE else len(opened) - 1)
                open_tags[tag] += 1
                made.append(opened[-1])
        yield tag, "", opened[-1]


def _words(text: str) -> int:
    return len(text.split())


def _new_features(elements: list[_Element]) -> Iterator[tuple[_Element, list[str]]]:
    """Each element with those of its features that no element around it has."""
    path: list[tuple[_Element, list[str]]] = []
    known: set[str] = set()
    for element in elements:
        while path and path[-1][0] is not element.parent:
            known.difference_update(path.pop()[1])
        new = [feature for feature in element.features if feature not in known]
        known.update(new)
        path.append((element, new))
        yield element, new


def count_features(source: str) -> Counter:
    """(feature, is it a tag, is it main text) -> how often, for a labelled page.

    Words count for every feature around them once: each element hands the words of all
    below it to the features that are new with it.
    """
    found: Counter = Counter()
    page = read_page(source)
    within = {e: [0, 0] for e in page.elements}
    labelled = False
    for tag, text, element in page.events:
        main = element.in_main and element.outer_side is None
        labelled |= main
        if tag:
            found[tag, True, main] += 1
        elif words := _words(text):
            within[element][main] += words
            found["", False, main] += words
    if not labelled:
        return Counter()
    for element in reversed(page.elements[1:]):
        for main in (0, 1):
            within[element.parent][main] += within[element][main]
    for element, new in _new_features(page.elements):
        for main in (False, True):
            if words := within[element][main]:
                for feature in new:
                    found[feature, False, main] += words
    return found


def _learned(pages: DataFrame) -> DataFrame:
    """``feature, is_tag, inside, outside`` of all features of the labelled pages."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for source in batch["html"]:
            total.update(count_features(source.as_py() or ""))
        keys = list(total)
        columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate(
            (pa.string(), pa.bool_(), pa.bool_())
        )]
        yield pa.record_batch(
            [*columns, pa.array([total[k] for k in keys], pa.int64())],
            ["feature", "is_tag", "is_main", "n"],
        )

    counted = pages.select("html").mapInArrow(
        each_batch(make), "feature string, is_tag boolean, is_main boolean, n bigint"
    )
    return counted.groupBy("feature", "is_tag").agg(
        F.sum(F.when(F.col("is_main"), F.col("n")).otherwise(0)).alias("inside"),
        F.sum(F.when(F.col("is_main"), 0).otherwise(F.col("n"))).alias("outside"),
    )


def _weights(rows: Iterable) -> dict[tuple[str, bool], float]:
    return {
        (row["feature"], row["is_tag"]): math.log((row["inside"] + 1) / (row["outside"] + 1))
        for row in rows
    }


def learn_weights(pages: DataFrame) -> dict[tuple[str, bool], float]:
    """Weight of each feature: of the words in an element, or of a tag.

    All of them, on the driver; ``main_text`` does without where they are many.
    """
    return _weights(_learned(pages).collect())


def _with_rare(rows: DataFrame, rare: DataFrame) -> DataFrame:
    """``rows`` with ``rare``: the weights out of that table that a page needs, or null.

    Pages are known by the digest of their html, so equal pages are looked up once.
    """
    key = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, features, tags = [], [], []
        for at, source in zip(batch["page"].to_pylist(), batch["html"], strict=True):
            page = read_page(source.as_py() or "")
            found = {(tag, True) for tag, _, _ in page.events if tag}
            found |= {(f, False) for element in page.elements for f in element.features}
            keys += [at] * len(found)
            features += [feature for feature, _ in found]
            tags += [is_tag for _, is_tag in found]
        columns = [pa.array(keys, pa.string()), pa.array(features, pa.string()), pa.array(tags, pa.bool_())]
        yield pa.record_batch(columns, ["page", "feature", "is_tag"])

    needed = rows.select(key.alias("page"), "html").mapInArrow(
        each_batch(make), "page string, feature string, is_tag boolean"
    )
    found = (
        lookup_join(needed, rare, ["feature", "is_tag"], "inner", [F.col("page")])
        .groupBy("page")
        .agg(F.collect_set(F.struct("feature", "is_tag", "inside", "outside")).alias("rare"))
    )
    keyed = rows.withColumn("page", key)
    spread = [F.col("page_id"), F.col("url")]
    return lookup_join(keyed, found, ["page"], "left", spread, small=False).drop("page")


class Extractor:
    """Scores pages with learned weights."""

    def __init__(self, weights: dict[tuple[str, bool], float]) -> None:
        self.weights = weights

    def _score_words(self, elements: list[_Element]) -> None:
        """``score`` of a word in each element, by the distinct features around it."""
        sums: dict[_Element | None, float] = {None: PLAIN_WORD}
        for element, new in _new_features(elements):
            total = sums[element.parent]
            for feature in new:
                own = self.weights.get((feature, False), 0.0)
                total += min(max(own, -SIDE_BOUND), MAIN_BOUND)
            sums[element] = total
            element.score = -WORD_BOUND if element.outer_side else min(max(total, -WORD_BOUND), WORD_BOUND)

    def _tag(self, tag: str) -> float:
        return min(max(self.weights.get((tag, True), 0.0), TAG_LEAST), TAG_MOST)

    def event_scores(self, page: Page) -> list[float]:
        """What each tag and text of the page adds to a region that holds it."""
        self._score_words(page.elements)
        marked = any(e.in_main and not e.outer_side for e in page.elements)
        scores, block = [], None
        for tag, text, element in page.events:
            side, score = element.outer_side, 0.0
            if side and (not marked or side.parent.in_main):
                if side is not block and not marked:
                    score = SIDE_BLOCK
                block = side
            elif tag:
                score = self._tag(tag)
            else:
                score = element.score * _words(text)
            scores.append(score)
        return scores

    def extract(self, source: str) -> str:
        page = read_page(source)
        first, last = best_region(self.event_scores(page))
        parts = []
        for tag, text, element in page.events[first:last]:
            if tag:
                parts.append("" if tag in INLINE else " ")
            elif not element.outer_side:
                parts.append(html.unescape(text))
        return " ".join("".join(parts).split())


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous range with the largest sum above 0, in one scan; else an empty one.

    Of several with that sum the one that ends first, and of these the shortest.
    """
    best, start, total = (0.0, 0, 0), 0, 0.0
    for end, score in enumerate(scores, 1):
        total += score
        if total <= 0:
            start, total = end, 0.0
        elif total > best[0]:
            best = (total, start, end)
    return best[1], best[2]


def main_text(
    pages: DataFrame,
    weights: dict[tuple[str, bool], float] | None = None,
    shared_features: int = SHARED_FEATURES,
) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row; learns from ``pages`` unless given weights."""
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "html")
    if weights is None:
        learned = stored(_learned(pages), "weights")
        if learned.count() > shared_features:
            order = [F.desc(F.col("inside") + F.col("outside")), "feature", "is_tag"]
            often = stored(learned.orderBy(*order).limit(shared_features), "often")
            rare = learned.join(often, ["feature", "is_tag"], "left_anti")
            rows, learned = _with_rare(rows, rare), often
        weights = _weights(learned.collect())
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = batch["rare"].to_pylist() if "rare" in batch.schema.names else [None] * batch.num_rows
        plain = Extractor(shared.value)
        texts = [
            (Extractor(ChainMap(_weights(rare), shared.value)) if rare else plain).extract(source.as_py() or "")
            for source, rare in zip(batch["html"], own, strict=True)
        ]
        sizes = pa.array([len(text) for text in texts], pa.int64())
        columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string()), sizes]
        yield pa.record_batch(columns, ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(
        each_batch(make), "page_id bigint, url string, text string, n_chars bigint"
    )
