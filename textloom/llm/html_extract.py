"""Main text of web pages by paths that the pages of a host agree on."""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from textloom.session import stored

# Characters of all hosts' paths that are broadcast; beyond, each set of paths that pages of a host
# contain is joined to the votes by host and path.
BROADCAST_CHARS = 1 << 25

# What an inner container passes on of the score of its text.
DECAY = 0.7

# Share of the page's unlinked text above which a dropped element holds the article; of the unlikely ones.
MOST, NEARLY_ALL = 0.5, 0.9

# What drops an element: nothing, an element or name that gives way to much text, or more so, or one that never does.
NOT, SOFT, UNLIKE, HARD, OUT = range(5)

# Of the winner's length, the text directly in the body that makes the whole body the article.
LOOSE = 0.1

CONTAINERS = frozenset("article main section div td body".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup td th time tt u var wbr".split()
)
# elements that are never part of the article
DROPPED = frozenset(
    "head script style noscript template svg nav header footer aside form button select option textarea input iframe "
    "object embed canvas dialog menu title noembed noframes xmp audio video map".split()
)
# parts of a class or id that name furniture of a page
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion promoted "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup "
    "share sharing social comment comments commentlist respond disqus replies related recommended recommendations "
    "widget widgets pagination pager login search".split()
)
# of the dropped elements those that may hold the article all the same
LIFTED = frozenset("nav header footer aside form dialog menu".split())
# names that stay dropped however much text they hold
KEPT_OUT = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored cookie cookies consent gdpr "
    "comment comments commentlist respond disqus replies".split()
)
# names and elements that are the article only if nearly all text is theirs
UNLIKELY = frozenset("nav navbar navigation menu breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar toolbar header".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
# a class such as has-sidebar tells of the page, not of the element
ABOUT_PAGE = ("has", "with", "no", "without", "is", "page", "single")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an element that ends when another of these begins
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
        "header hr main menu nav ol p pre section table ul li dd dt td th tr tbody thead".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr", "tbody"]),
    "th": frozenset(["td", "th", "tr", "tbody"]),
    "tr": frozenset(["tr", "tbody"]),
    "option": frozenset(["option"]),
    "head": frozenset(["body", "article", "main", "div", "p", "nav", "header", "section"]),
}
# an end or a next item looks no further up than these
BARRIERS = {"li": frozenset(["ul", "ol", "menu"]), "td": frozenset(["table"]), "th": frozenset(["table"]), "tr": frozenset(["table"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "option": frozenset(["select"])}

# A quote opens a value behind an equals sign only; a value may be of any length and hold any sign. What
# has no end as such a tag ends at the next angle bracket.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S,
)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Elements in the order they open, and blocks of text in page order."""

    tags: list[str] = field(default_factory=lambda: ["body"])
    parents: list[int] = field(default_factory=lambda: [-1])
    steps: list[str] = field(default_factory=lambda: ["body"])
    ends: list[int] = field(default_factory=lambda: [0])
    reasons: list[int] = field(default_factory=lambda: [NOT])
    dropped: list[bool] = field(default_factory=lambda: [False])
    runs: list[list[tuple[int, str, int]]] = field(default_factory=list)  # blocks of any element, in pieces
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # element, text, characters in links

    def path(self, element: int) -> str:
        steps = []
        while element > 0:
            steps.append(self.steps[element])
            element = self.parents[element]
        return ">".join(reversed(steps))

    def settle(self) -> None:
        """Decide what is dropped, then fill the blocks.

        A dropped element is lifted if it holds the page's largest article or main, unless one
        that is not dropped is there and larger than the rest; or if it holds most of the unlinked
        text, of that article where it is inside.
        """
        count = len(self.tags)
        worth, never = [0] * count, [False] * count
        for run in self.runs:
            for element, text, linked in run:
                if element >= 0 and not linked:
                    worth[element] += len(text.strip())
        for e in range(1, count):
            never[e] = never[self.parents[e]] or self.reasons[e] >= HARD
        for e in range(count - 1, 0, -1):
            if not never[e]:
                worth[self.parents[e]] += worth[e]
        free = [False] * count  # under nothing that may drop it
        free[0] = True
        for e in range(1, count):
            free[e] = free[self.parents[e]] and self.reasons[e] == NOT
        marked = [e for e in range(1, count) if self.tags[e] in ("article", "main") and not never[e] and worth[e]]
        article = max(marked, key=worth.__getitem__, default=0)  # the outermost of equals
        alone = article > 0 and (not any(free[e] for e in marked) or worth[article] > MOST * worth[0])

        def lifts(e: int) -> bool:
            if self.reasons[e] >= HARD:
                return False
            if alone and e <= article < self.ends[e]:
                return True
            inside = 0 < article < e < self.ends[article]
            least = NEARLY_ALL if self.reasons[e] == UNLIKE or article and not inside else MOST
            return worth[e] > least * worth[article if inside else 0]

        for e in range(1, count):
            parent = self.parents[e]
            drop = self.dropped[parent] or self.reasons[e] != NOT and not lifts(e)
            if drop and self.tags[e] in HEADINGS and _in_article_header(self, parent):
                drop = False  # the title of an article may stand in a header of its own
            self.dropped[e] = drop
        for run in self.runs:
            kept = [piece for piece in run if piece[0] < 0 or not self.dropped[piece[0]]]
            owner = next((e for e, _, _ in kept if e >= 0), None)
            if owner is not None and (text := " ".join("".join(text for _, text, _ in kept).split())):
                self.blocks.append((owner, text, min(sum(linked for _, _, linked in kept), len(text))))
        self.runs.clear()

    @cached_property
    def scores(self) -> dict[int, float]:
        """For each container the text of its own paragraphs, and a falling part of that of inner containers."""
        found: dict[int, float] = {}
        for element, text, linked in self.blocks:
            worth = float(len(text) - 2 * linked)
            while element >= 0 and abs(worth) > 1e-6:  # what is left for outer containers no longer counts
                if self.tags[element] in CONTAINERS:
                    found[element] = found.get(element, 0.0) + worth
                    worth *= DECAY
                element = self.parents[element]
        return found

    def paths(self) -> dict[int, str]:
        """The path of each container that holds text."""
        return {element: self.path(element) for element in self.scores}

    def best(self, votes: dict[str, int] | None = None) -> int | None:
        """The container with the highest score, the first of equals.

        It is sought among those with the path of most votes, the first by name of equals, if the page has any with votes.
        """
        scores = self.scores
        if votes:
            paths = self.paths()
            known = [(-votes[path], path) for path in paths.values() if path in votes]
            if known:
                winner = min(known)[1]
                scores = {e: s for e, s in scores.items() if paths[e] == winner}
        return max(sorted(scores), key=scores.__getitem__) if scores else None

    def container(self, element: int) -> int:
        """The nearest container around the element, itself included."""
        while self.tags[element] not in CONTAINERS:
            element = self.parents[element]
        return element

    def whole(self, element: int) -> int:
        """The container of the whole article that the element is part of.

        This is the outermost article around it, else the outermost main. Without these it is the
        outermost container that is reached by adding mostly unlinked text, none of it in a
        container with a higher score. The body holds all of a page, so it counts only if it has
        considerable text of its own, or parts with the element's tag and classes.
        """
        around = [element]
        while around[-1] > 0:
            around.append(self.parents[around[-1]])
        for tag in ("article", "main"):
            if marked := [e for e in around if self.tags[e] == tag]:
                return marked[-1]
        top, score = element, self.scores.get(element, 0.0)
        for outer in around[1:]:
            if self.tags[outer] not in CONTAINERS:
                continue
            start, end = top, self.ends[top]
            limit = self.ends[outer] if outer else len(self.tags)
            added = [(e, len(text), linked) for e, text, linked in self.blocks if outer <= e < start or end <= e < limit]
            if added:
                if 2 * sum(linked for _, _, linked in added) > sum(size for _, size, _ in added):
                    break
                if any(s > score for e, s in self.scores.items() if outer < e < start and e not in around or end <= e < limit):
                    break
                if outer == 0:
                    loose = sum(size - 2 * linked for e, size, linked in added if self.container(e) == 0)
                    alike = any(self.parents[e] == self.parents[top] and self.steps[e] == self.steps[top] for e in self.scores if e != top)
                    if loose < LOOSE * len(self.text(top)) and not alike:
                        break
            top = outer
        return top

    def text(self, element: int) -> str:
        end = self.ends[element] if element else len(self.tags)
        return "\n\n".join(text for e, text, _ in self.blocks if element <= e < end)


def _reason(tag: str, names: list[tuple[str, str]]) -> int:
    """What drops the element, the strongest of its tag, role, classes and id."""
    found = NOT
    if tag in DROPPED:
        found = HARD if tag not in LIFTED else UNLIKE if tag in UNLIKELY else SOFT
    for kind, value in names:
        if kind == "role":
            if (role := value.strip().lower()) in ROLES:
                found = max(found, SOFT if role in ("search", "form", "dialog", "alertdialog", "alert") else UNLIKE)
            continue
        for name in value.lower().split():
            parts = _PARTS.findall(name)
            if parts and parts[0] not in ABOUT_PAGE:
                for part in (parts[0], parts[-1]):
                    if part in FURNITURE:
                        found = max(found, OUT if part in KEPT_OUT else UNLIKE if part in UNLIKELY else SOFT)
    return found


def _step(tag: str, names: list[tuple[str, str]]) -> str:
    """Tag and classes, with numbers and other values that change from page to page taken out."""
    classes = sorted({re.sub(r"\d+", "#", c.lower()) for kind, value in names if kind == "class" for c in value.split()})
    return ".".join([tag, *classes])


def parse(source: str | None) -> Page:
    """Elements and blocks of a page; markup that is not closed or badly nested is read as browsers do, roughly."""
    page, source = Page(), source or ""
    open_ = [0]  # elements from the body down
    words: list[tuple[int, str, int]] = []  # element, text, characters in links
    links = 0
    hidden = [False]  # by element, whether its text is never read
    opened: Counter[str] = Counter()  # names of open elements, so that a stray end is not looked for
    at, end = 0, len(source)

    def flush() -> None:
        if words:
            page.runs.append(words.copy())
            words.clear()

    def close(count: int) -> None:
        nonlocal links
        while len(open_) > count:
            element = open_.pop()
            tag = page.tags[element]
            opened[tag] -= 1
            page.ends[element] = len(page.tags)
            if tag not in INLINE:
                flush()
            elif tag in ("td", "th") and words:  # text that follows belongs to the cell it stands in
                words.append((-1, " ", 0))
            links -= tag == "a"

    def say(text: str) -> None:
        element = open_[-1]
        if hidden[element]:
            return
        if "&" in text:
            text = markup.unescape(text)
        words.append((element, text, len(text) if links > 0 else 0))

    while at < end:
        token = _TOKEN.search(source, at)
        if token is None:
            say(source[at:])
            break
        if token.start() > at:
            say(source[at : token.start()])
        at = token.end()
        name = token[2] or token[5]
        if name is None:
            continue
        tag, attributes = name.lower(), token[3] if token[2] else token[6]
        if token[1] or token[4]:
            if not opened[tag]:
                continue
            barrier = BARRIERS.get(tag, ())
            for i in range(len(open_) - 1, 0, -1):
                if page.tags[open_[i]] == tag:
                    close(i)
                    break
                if page.tags[open_[i]] in barrier:
                    break
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in ("html", "body"):
            continue
        names = [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _NAMES.finditer(attributes)] if attributes else []
        if tag not in INLINE:
            for i in range(len(open_) - 1, 0, -1):
                inner = page.tags[open_[i]]
                if tag in CLOSED_BY.get(inner, ()):
                    close(i)
                    break
                if inner in BARRIERS.get(tag, ()) or inner in CONTAINERS and tag != "tr":
                    break
            flush()
        elif tag in ("td", "th"):
            for i in range(len(open_) - 1, 0, -1):
                if page.tags[open_[i]] in ("td", "th"):
                    close(i)
                    break
                if page.tags[open_[i]] in ("tr", "table"):
                    break
        parent = open_[-1]
        element = len(page.tags)
        reason = _reason(tag, names)
        page.tags.append(tag)
        page.parents.append(parent)
        page.steps.append(_step(tag, names) if tag in CONTAINERS else tag)
        page.ends.append(element + 1)
        page.reasons.append(reason)
        page.dropped.append(False)
        hidden.append(hidden[parent] or reason == HARD)
        if tag in VOID or attributes.endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            stop = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(source, at)
            at = stop.end() if stop else end
            continue
        open_.append(element)
        opened[tag] += 1
        links += tag == "a"
    close(1)
    flush()
    page.settle()
    return page


def _in_article_header(page: Page, element: int) -> bool:
    """Whether the element is a header right inside an article that is not dropped itself."""
    parent = page.parents[element]
    return page.tags[element] == "header" and parent >= 0 and page.tags[parent] == "article" and not page.dropped[parent]


def best_path(source: str | None) -> str | None:
    """The generalised path of the page's best container; None for a page without text."""
    page = parse(source)
    found = page.best()
    return None if found is None else page.path(found)


def main_text(source: str | None, votes: dict[str, int] | None = None) -> str:
    """Blocks of the article around the container whose path has most votes of those in this page, else around its own best."""
    page = parse(source)
    found = page.best(votes)
    return "" if found is None else page.text(page.whole(found))


@F.arrow_udf(StringType())
def _best_path(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([best_path(source) for source in batch.to_pylist()], pa.string())


@F.arrow_udf(ArrayType(StringType()))
def _paths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([sorted(set(parse(source).paths().values())) for source in batch.to_pylist()], pa.list_(pa.string()))


@F.arrow_udf(StringType())
def _text_by_path(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for sources, paths in batches:
        yield pa.array([main_text(s, None if p is None else {p: 1}) for s, p in zip(sources.to_pylist(), paths.to_pylist())], pa.string())


def host_of(url):
    """Host name of a URL in lower case; NULL where there is none."""
    host = F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/:?#\s]+)", 1))
    return F.when(F.length(host) > 0, host)


def host_votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, path, n)``: for each host all container paths with votes, one vote a page.

    Votes are counted before the shuffle, so a host may have any share of the pages.
    """
    votes = pages.select(host_of(F.col(url_col)).alias("host"), _best_path(html_col).alias("path"))
    return votes.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("n"))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, paths)``: the paths of ``host_votes``, most votes first."""
    ranked = host_votes(pages, url_col, html_col).groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "path"))).alias("ranked"))
    return ranked.select("host", F.col("ranked.path").alias("paths"))


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", out: str = "text") -> DataFrame:
    """Add ``out``, the blocks of the page's main text joined by two line breaks.

    Every page votes with the path of its best container; it is then read by the path with most
    votes on its host that holds text in it, however many paths the host has, or by its own best
    container where it has none of the host's paths or no host. From there the text is that of the whole article around it, with
    its title, lead and all sections (``Page.whole``). Whole pages are read. Menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles and reader comments are left out, by element, role, class and
    id, except where one such element holds the article (``Page.settle``). Character references are decoded; white space in a block becomes one space. NULL and
    pages without text give the empty text. Rows keep all their columns and repeat as they do.
    """
    votes = stored(host_votes(pages, url_col, html_col), "host_votes")
    size = votes.agg(F.coalesce(F.sum(F.length("host") + F.length("path")), F.lit(0)).alias("n")).first()["n"]
    if size <= BROADCAST_CHARS:
        hosts: dict[str, dict[str, int]] = {}
        for batch in votes.toArrow().to_batches():
            for host, path, n in zip(*(column.to_pylist() for column in batch.columns)):
                hosts.setdefault(host, {})[path] = n
        shared = pages.sparkSession.sparkContext.broadcast(hosts)

        @F.arrow_udf(StringType())
        def text_by_votes(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for sources, names in batches:
                yield pa.array([main_text(s, shared.value.get(h)) for s, h in zip(sources.to_pylist(), names.to_pylist())], pa.string())

        return pages.withColumn(out, text_by_votes(F.col(html_col), host_of(F.col(url_col))))
    # pages of a host with the same paths are read alike, so votes are joined once for each such set
    marked = pages.withColumn("_host", host_of(F.col(url_col))).withColumn("_paths", _paths(F.col(html_col)))
    marked = marked.withColumn("_set", F.sha2(F.to_json("_paths"), 256))
    sets = marked.where("_host IS NOT NULL").groupBy("_host", "_set").agg(F.first("_paths").alias("_paths"))
    found = sets.select("_host", "_set", F.explode("_paths").alias("path")).join(votes.withColumnRenamed("host", "_host"), ["_host", "path"])
    chosen = found.groupBy("_host", "_set").agg(F.min(F.struct((-F.col("n")).alias("n"), "path"))["path"].alias("_path"))
    joined = marked.drop("_paths").join(stored(chosen, "chosen_paths"), ["_host", "_set"], "left")
    return joined.withColumn(out, _text_by_path(F.col(html_col), F.col("_path"))).drop("_host", "_set", "_path")
