"""The main text of a web page: text-to-tag ratio per line, smoothed, and clustered by a threshold.

The standard library's parser streams events. Each block element begins a new line, so lines do not depend on how the
source is wrapped. Text of elements that are never content (menus, headers, footers, asides, forms, scripts, adverts,
notices, reader comments; by tag, role and class words) counts for nothing. The ratio of a line is its characters of
text by its tags; a Gaussian blurs the ratios along the page, and the lines above the threshold (their standard
deviation, or the top where all are alike) are its seeds. Lines of an article or main element count twice in that, and
where such elements hold at least as much of the seeds' text as the rest, all their lines are the content. Else it is all lines
of the division around the seeds, short ones included, but not menus, nor articles without a seed (teasers). A class word
is a hint only: it does not count on an article, on what holds an article, main or most of the text, nor behind has-, no- or with-.

Edge cases: null and empty pages, and pages without text outside such elements, give an empty text. Elements that are
never closed end with the element around them, and a declaration that cannot be read is a comment up to its next `>`. The work
grows with the length of a page, whatever its tags. Repeated pages are read one by one. An empty table gives an empty
result. Whole pages are read, whatever their length. Other columns stay as they are.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Blur in lines, and the share of the largest seed's text under which a division of links is a menu.
SIGMA = 2.0
MENU_SHARE = 0.2
#: What the ratio of a line in an article or main element counts.
PRIOR = 2.0

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hr html legend li main menu nav noscript ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "aside audio button canvas datalist dialog footer form head header iframe input label menu nav noscript object script select style svg template textarea "
    "title video".split()
)
NEVER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation note search status toolbar".split())
NEVER_WORDS = frozenset(
    "ad ads adbox adslot advert advertisement adverts banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer "
    "disqus footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pagination popup promo promos "
    "promotion related replies reply respond share sharing sidebar sidebars signup skip social sponsor sponsored subscribe teaser teasers toolbar widget "
    "widgets".split()
)
#: Words of reader comments, adverts and notices, which may be longer than the article, and words that turn what follows into a remark on the layout.
APART = frozenset(
    "ad ads adbox adslot advert advertisement adverts comment comments commentlist consent cookie cookies disclaimer disqus gdpr newsletter notice notices "
    "popup promo promos promotion replies reply respond signup sponsor sponsored subscribe".split()
)
MODIFIERS = frozenset("has no not with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LANDMARKS = frozenset(["article", "main"])
DIVISIONS = LANDMARKS | {"section", "div", "td", "body"}
#: What the start of a block ends, if open.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
UNFINISHED = re.compile(r"<[a-zA-Z/!?]")


def _never(tag: str, attributes: list) -> bool:
    if tag in NEVER:
        return True
    if tag in ("html", "body", "main"):
        return False
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if not value:
            continue
        if name == "role" and value.lower() in NEVER_ROLES:
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def hint_words(attributes: list) -> set[str]:
    """The words of class and id that hint at something else than content; not those behind has-, no-, with-."""
    found = set()
    for name, value in attributes:
        if name in ("class", "id") and value:
            for part in value.split():
                for word in map(str.lower, WORD.findall(part)):
                    if word in MODIFIERS:
                        break
                    if word in NEVER_WORDS:
                        found.add(word)
    return found


class Lines(HTMLParser):
    """Collects the lines of a page: text, number of tags, and the region that each belongs to.

    Whether an element with a hint word goes is known once the page is read, so pieces of text carry their innermost one.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, bool, int]] = []  # tag, region, never content, in a landmark, hint
        # Where each tag and where blocks stand in it, and how many elements other than headers are never content.
        self.depths: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.never_others = 0
        self.texts: list[str] = []
        self.pieces: list[list[tuple[str, int]]] = []
        # By hint, the first stands for none: the hint around it, its words, its characters, whether it holds an article or main.
        self.around, self.words, self.sizes, self.holds = [0], [set()], [0], [True]
        self.tags: list[int] = []
        self.regions: list[int] = []
        self.parents = [0]
        self.linked = [0]
        self.landmarks: set[int] = set()
        self.parts: list[tuple[str, int]] = []
        self.count = 0
        self.region_count = 0

    def _state(self) -> tuple[int, bool, bool, int]:
        return self.open[-1][1:] if self.open else (0, False, False, 0)

    def end_line(self) -> None:
        if self.count or any(text.strip() for text, _ in self.parts):
            self.pieces.append(self.parts)
            self.tags.append(self.count)
            self.regions.append(self._state()[0])
        self.parts, self.count = [], 0

    def resolve(self) -> None:
        """Make the texts of the lines without the elements whose hints hold.

        A hint is void where its element holds an article or main without hint words, or most of the page's text. Reader
        comments, adverts and notices may be longer than the article, so they stay only if there is nothing else.
        """
        for parts in self.pieces:
            for text, hint in parts:
                self.sizes[hint] += len("".join(text.split()))
        for hint in range(len(self.sizes) - 1, 0, -1):
            self.sizes[self.around[hint]] += self.sizes[hint]
        total = self.sizes[0]
        gone = [False]
        for hint in range(1, len(self.sizes)):
            size = self.sizes[hint]
            void = self.holds[hint] or (size == total if self.words[hint] & APART else 2 * size > total)
            gone.append(gone[self.around[hint]] or not void)
        self.texts = [" ".join("".join(text for text, hint in parts if not gone[hint]).split()) for parts in self.pieces]

    def _counts(self, tag: str, never: bool) -> bool:
        return never and tag != "header" and tag not in LANDMARKS

    def _close(self, depth: int) -> None:
        while len(self.open) > depth:
            tag, _, never, *_ = self.open.pop()
            self.depths[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
            self.never_others -= self._counts(tag, never)

    def parse_html_declaration(self, i: int) -> int:
        """As in browsers, `<![...` is a comment up to the next `>`."""
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.end_line()
            ends = ENDED_BY.get(tag, ())
            while self.blocks:
                name = self.open[self.blocks[-1]][0]
                if name != "p" and name not in ends:
                    break
                self._close(self.blocks[-1])
                if name != "p":
                    break
        self.count += 1
        region, never, landmark, hint = self._state()
        if tag == "br":
            self.parts.append((" ", hint))
        if tag in VOID:
            return
        if never and landmark and tag in HEADINGS and self.depths["header"] and not self.never_others:
            never = False  # the title in an article's own header
        elif not never:
            never = _never(tag, attrs)
        words = hint_words(attrs) if attrs and not never and tag not in ("html", "body", "main") else set()
        if words and tag != "article":
            self.around.append(hint)
            self.words.append(words)
            self.sizes.append(0)
            self.holds.append(False)
            hint = len(self.around) - 1
        if tag in LANDMARKS and not never and not words:
            outer = hint
            while not self.holds[outer]:
                self.holds[outer] = True
                outer = self.around[outer]
        if tag in DIVISIONS and not never and (tag in LANDMARKS or not landmark):
            self.region_count += 1
            self.parents.append(region)
            self.linked.append(0)
            region = self.region_count
            if tag in LANDMARKS:
                landmark = True
                self.landmarks.add(region)
        self.depths[tag].append(len(self.open))
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.never_others += self._counts(tag, never)
        self.open.append((tag, region, never, landmark, hint))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.count += 1
        if not self.depths[tag]:
            return
        depth = self.depths[tag][-1]
        # The end of an inline element does not end the block around it.
        if tag in BLOCKS or tag in NEVER or not self.blocks or self.blocks[-1] < depth:
            self._close(depth)

    def handle_data(self, data: str) -> None:
        region, never, _, hint = self._state()
        if not never:
            self.parts.append((data, hint))
            if any(name == "a" for name, *_ in self.open[-4:]):
                self.linked[region] += len("".join(data.split()))


def blur(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """A Gaussian along the lines; beyond the page the ratio is nothing."""
    reach = int(np.ceil(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(values, weights / weights.sum())[reach : reach + len(values)]


def smoothed_ratios(lines: Lines) -> tuple[np.ndarray, float]:
    """The blurred ratio of each line, nothing for lines without text, and the threshold."""
    chars = np.array([len(t) for t in lines.texts], float)
    inside = np.array([r in lines.landmarks for r in lines.regions])
    smooth = blur(chars / np.maximum(np.array(lines.tags), 1)) * np.where(inside, PRIOR, 1)
    smooth[chars == 0] = 0
    return smooth, min(smooth.std(), smooth.max())


def content_regions(lines: Lines) -> set[int]:
    """The regions of the content: all landmarks, if they hold most of the seeds' text, or all divisions under the one around the seeds.

    Seeds are the divisions around the lines above the threshold; where there is one alone, its siblings belong to it.
    Left out are menus (small divisions whose own text is mostly links), unless there is nothing else, and landmarks without a seed.
    """
    letters = Counter()
    for text, region in zip(lines.texts, lines.regions, strict=True):
        letters[region] += len("".join(text.split()))
    if not any(letters.values()):
        return set()
    smooth, threshold = smoothed_ratios(lines)
    seeds, found = set(), Counter()
    for text, region, ratio in zip(lines.texts, lines.regions, smooth, strict=True):
        if text and ratio >= threshold:
            seeds.add(region)
            found[region in lines.landmarks] += len(text)
    if found[True] >= found[False]:
        return lines.landmarks
    seeds -= lines.landmarks
    largest = max(letters[r] for r in seeds)
    menus = {r for r, n in letters.items() if 2 * lines.linked[r] > n and n < MENU_SHARE * largest}
    seeds = seeds - menus or seeds
    # Regions are numbered in order of their starts, so the greatest of several is not around the others.
    tops, queue = set(seeds), [-r for r in seeds]
    heapq.heapify(queue)
    while len(tops) > 1:
        last = -heapq.heappop(queue)
        tops.remove(last)
        outer = lines.parents[last]
        if outer not in tops:
            tops.add(outer)
            heapq.heappush(queue, -outer)
    container = tops.pop()
    if seeds == {container}:
        container = lines.parents[container]
    under = {container}
    for region in range(container + 1, lines.region_count + 1):
        if lines.parents[region] in under:
            under.add(region)
    return under - (menus - seeds) - (lines.landmarks - {container})


def main_text(html: str | None) -> str:
    if not html:
        return ""
    lines = Lines()
    lines.feed(html)
    if UNFINISHED.match(lines.rawdata):
        lines.rawdata = ""  # a tag that the page ends in
    lines.close()
    lines.end_line()
    lines.resolve()
    keep = content_regions(lines)
    return " ".join(t for t, r in zip(lines.texts, lines.regions, strict=True) if t and r in keep)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add `text`, the main text of each page, and `n_chars`, its code points."""
    kind = pa.struct([("text", pa.string()), ("n_chars", pa.int64())])

    @F.arrow_udf("struct<text: string, n_chars: bigint>")
    def extracted(sources: pa.Array) -> pa.Array:
        texts = [main_text(s.as_py()) for s in sources]
        return pa.array([{"text": t, "n_chars": len(t)} for t in texts], kind)

    # Another name than those that are there: all of them stay.
    name = "_main"
    while name in pages.columns:
        name += "_"
    result = pages.withColumn(name, extracted(F.col(f"`{html}`")))
    return result.withColumns({"text": F.col(f"{name}.text"), "n_chars": F.col(f"{name}.n_chars")}).drop(name)
