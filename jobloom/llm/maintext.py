"""Main text of web pages by two passes of block rules.

A page is read once into blocks: text between block-level tags, with white space as one blank and
character references decoded. Each block knows its share of characters in links, its density of
stop words, and where it stands: in an article, or in an element that never holds main text
(navigation, header, footer, sidebar, form, advert, notice, comments), by tag, role or class. A form
around most of the page is a wrapper and says nothing, nor does a class of a layout ("has-sidebar",
or one beside "content").

Stop words are learned from the pages: of each page language (as the page says) and script the `TOP`
most frequent words, over the whole texts of all pages. A block's density is compared with that of
all text of its language and script, so no language is preferred; characters of scripts without
blanks count as words. Where nothing is known of a script, density says nothing.

First pass, each block alone: what stands in such an element is bad, also what is mostly links;
a block with many stop words is good if it is long and likely if not; in an article other blocks
are likely too, without one long blocks with few stop words are bad, and long ones of unknown
density likely. Short blocks stay open.
Second pass: on a page without an article or a good block the likely ones are good, or if there are
none the dense ones of more than `TINY` characters. Then blocks that are open or likely take the label of their nearest decided
neighbours in the same section (what a menu or footer is does not tell what stands beside it); where these differ, likely blocks and headings above a good block
are good, and open ones like the nearer neighbour (if both are as near, good if dense).
An article's likely blocks are good.

Defined cases: a null or empty page, and one without main text, give the empty text; pages of any
length are read whole, broken and unclosed markup as far as it goes; repeated pages give a row each;
an empty table gives an empty result; input columns other than key, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

# Common function words by language, for single pages of which no others are known.
STOP_WORDS = {
    "en": "a about all an and are as at be been but by for from had has have he her his i if in is "
          "it its no not of on one or our she so than that the their them then there they this to "
          "up was we were what when which who will with would you your",
    "de": "aber als am an auch auf aus bei bin bis da das dass dem den der des die doch ein eine "
          "einem einen einer es für hat ich ihr im in ist ja kann mit nach nicht noch nur oder sein "
          "sich sie sind so und von vor war was wenn wie wir wird zu zum zur über",
    "fr": "à au aux avec ce ces cette dans de des du elle elles en est et eux il ils je la le les leur "
          "lui ma mais me même mes moi mon ne nos nous on ont ou où par pas pour qu que qui sa se "
          "ses son sont sur ta tu un une vous",
    "es": "a al como con cuando de del desde donde el ella ellos en entre era es esta este esto ha "
          "hay la las le les lo los más me mi muy no nos o para pero por porque que se ser si sin "
          "sobre son su sus también un una y ya yo",
}

BLOCKS = set("address article aside blockquote body button caption center dd details dialog dir div "
             "dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header "
             "hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre search "
             "section select summary table tbody td tfoot th thead tr ul".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no text of the page. Those without an end tag are read on after their start tag.
OPAQUE = set("script style template svg math object applet audio video canvas iframe noscript "
             "title textarea select".split())
# Of these, browsers read the content as mere characters, up to the end of the page if none ends it.
RAW = set("script style iframe noscript title textarea".split())
NEVER = set("nav header footer aside form menu dialog button search fieldset".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
            "menubar toolbar".split())
NAMES = set("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo "
            "promotion banner cookie cookies consent gdpr notice alert popup modal overlay newsletter "
            "subscribe subscription signup login sidebar side aside widget widgets nav navbar "
            "navigation menu menus breadcrumb breadcrumbs header masthead topbar footer bottombar "
            "comment comments reply replies disqus respond share sharing social related recommended "
            "recommendations pagination pager search toolbar skip".split())
COMMENTS = {"comment", "comments", "reply", "replies", "disqus", "respond"}

# An attribute, or what stands between two. As browsers read it: a quote opens a value only after "=",
# and ends with the next same quote, however far; one that never ends is a character like others.
ITEM = r"""[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+"""
NEXT_ITEM = re.compile(ITEM)
START = re.compile("<(?:[!?/]|[a-zA-Z])")
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
TAG = re.compile(rf"{NAME.pattern}((?:{ITEM})*+)>")
OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/][^>]*+>?", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""",
                       re.I)
NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
# Class names after these, or beside one of these, describe a layout.
LAYOUT = {"has", "with", "no", "without", "is"}
CONTENT = {"content", "main", "article", "post", "entry"}
# Scripts written without blanks (Thai to Khmer, kana, Han) have a word per character.
WORDS = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]|"
                   r"[^\W\d_\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]+")
MARKUP = re.compile(r"<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^<>]*>", re.S | re.I)
PAGE_LANGUAGE = re.compile(r"""<html\b[^<>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})\b""", re.I)

GOOD, LIKELY, OPEN, BAD = "good", "likely", "open", "bad"
LONG, SHORT, TINY = 200, 70, 20
# Shares of the density of all text, and of a block's characters.
DENSE, SPARSE, LINKED = 0.7, 0.35, 0.5
NEAR = 8
TOP = 100
# Longer words are no stop words; no table of a task has more entries.
LONGEST_STOP, MOST_ENTRIES = 16, 500_000


def script_of(word: str) -> int:
    """A number for the script of a word: that of its first character, in blocks of code points."""
    code = ord(word[0])
    if code < 0x370 or 0x1E00 <= code < 0x1F00:
        return 0
    return 0x3400 >> 8 if 0x3040 <= code < 0xA000 else code >> 8


def page_language(page: str) -> str:
    """As the page says, else empty."""
    found = PAGE_LANGUAGE.search(page)
    return found[1].lower() if found else ""


class StopWords:
    """Stop words by page language and script, each with their share of all words there."""

    def __init__(self, groups: dict[tuple[str, int], tuple[frozenset[str], float]]):
        self.groups = groups

    @classmethod
    def fixed(cls, words: frozenset[str], share: float = 0.43) -> "StopWords":
        """For pages of any language in Latin script."""
        return cls({("", 0): (words, share)} if words else {})

    def density(self, text: str, language: str) -> float | None:
        """The text's share of stop words by that of all text; None where nothing is known."""
        words = WORDS.findall(text.lower())
        if not words:
            return None
        script = Counter(map(script_of, words)).most_common(1)[0][0]
        known = self.groups.get((language, script)) or self.groups.get(("", script))
        if known is None:
            return None
        return sum(w in known[0] for w in words) / len(words) / known[1]


class Block:
    """A stretch of text, where it stands and how it is judged."""

    __slots__ = ("text", "linked", "heading", "article", "barred", "stops", "label")

    def __init__(self, text: str, linked: int, heading: bool, article: int, barred: bool):
        self.text, self.linked, self.heading = text, linked, heading
        self.article, self.barred = article, barred
        self.stops, self.label = None, OPEN


def _hints(attributes: str) -> tuple[set[str], bool]:
    """Words of class, id and role, and whether the element is hidden."""
    words, hidden = set(), False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name == "hidden":
            hidden |= "=" not in m[0] or value.lower() != "false"
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
        elif name == "role":
            words |= {f"role:{value.lower()}"}
        else:
            tokens = [[p.lower() for p in NAME_PARTS.findall(x)] for x in value.split()]
            layout = any(len(x) == 1 and x[0] in CONTENT for x in tokens)
            for x in tokens:
                if x and x[0] not in LAYOUT:
                    words |= set(x) & COMMENTS if layout else set(x)
    return words, hidden


def _plain(pieces: list[str]) -> str:
    """Text with character references decoded and white space as one blank."""
    return " ".join(entities.unescape("".join(pieces)).split())


class Tags:
    """Finds the tags, comments and declarations of a page, each in time linear in the page."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        # Where attributes begin from which no end of a tag is reached.
        self.endless: set[int] = set()
        # By tag, where the element that begins at a place ends.
        self.ends: dict[str, dict[int, int]] = {}

    def _has_end(self, pos: int) -> bool:
        seen = []
        while pos not in self.endless and (m := NEXT_ITEM.match(self.page, pos)):
            seen.append(pos)
            pos = m.end()
        if self.page.startswith(">", pos):
            return True
        self.endless.update(seen)
        self.endless.add(pos)
        return False

    def search(self, pos: int) -> re.Match | None:
        """The first one from pos on; groups 1 to 3 are a tag's slash, name and attributes."""
        while m := START.search(self.page, pos):
            pos = m.start()
            if name := NAME.match(self.page, pos):
                if pos < self.last and (not self.endless or self._has_end(name.end())):
                    if tag := TAG.match(self.page, pos):
                        return tag
                    self._has_end(name.end())
            if other := OTHER.match(self.page, pos):
                return other
            # A tag without an end is text, as are all that begin within its name.
            pos = name.end()
        return None

    def end_of(self, start: re.Match) -> int | None:
        """Where the element of this start tag ends, None if it is left open."""
        tag = start[2].lower()
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(self.page, start.end())
            return end.end() if end else len(self.page)
        if tag not in self.ends:
            ends, left = {}, []
            for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I).finditer(
                    self.page, start.start(), self.last + 1):
                if not m[1]:
                    if not m[0].endswith("/>"):
                        left.append(m.start())
                elif left:
                    ends[left.pop()] = m.end()
            self.ends[tag] = ends
        return self.ends[tag].get(start.start())


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order."""
    out: list[Block] = []
    # Open elements: tag, barred for good, barred by name only, number of the article.
    stack: list[tuple[str, bool, bool, int]] = []
    parts: list[str] = []
    # The pieces of each link of the block.
    links: list[list[str]] = [[]]
    in_link, articles, pos = 0, 0, 0
    heading = False

    def flush():
        nonlocal parts, links
        if parts:
            text = _plain(parts)
            if text:
                _, firm, named, article = stack[-1] if stack else ("", False, False, 0)
                linked = sum(len(_plain(pieces)) for pieces in links if pieces)
                out.append(Block(text, linked, heading, article, firm or named))
            parts, links = [], [[]]

    tags = Tags(page)
    for m in iter(lambda: tags.search(pos), None):
        if m.start() > pos:
            piece = page[pos:m.start()]
            parts.append(piece)
            if in_link:
                links[-1].append(piece)
        pos = m.end()
        if m.re is not TAG:
            continue
        tag = m[2].lower()
        closing = m[1] == "/"
        if tag == "a":
            in_link = 0 if closing else 1
            links.append([])
            continue
        if tag == "br":
            parts.append(" ")
            links[-1].append(" ")
            continue
        if tag in OPAQUE:
            if tag in BLOCKS:
                flush()
            if not closing and not m[3].endswith("/"):
                pos = tags.end_of(m) or pos
            continue
        if tag not in BLOCKS:
            continue
        flush()
        if tag in VOID:
            continue
        if closing:
            in_link = 0  # a link that was left open ends with the block
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        else:
            # These end where the next of their kind, or any block, begins.
            while stack and (stack[-1][0] == "p" or stack[-1][0] in HEADINGS
                             or stack[-1][0] == tag and tag in ("li", "td", "th", "tr", "dd", "dt")):
                stack.pop()
            _, firm, named, article = stack[-1] if stack else ("", False, False, 0)
            words, hidden = _hints(m[3]) if m[3] else (set(), False)
            if tag in ("article", "main") or "role:main" in words:
                # A name around it (as of a layout with a side bar) says nothing about it.
                named = False
                if not firm and not article:
                    articles += 1
                    article = articles
            wrapper = tag == "form" and ((tags.end_of(m) or len(page)) - m.start()) * 2 > len(page)
            firm |= hidden or tag in NEVER and not wrapper and not (tag == "header" and article)
            firm |= any(f"role:{r}" in words for r in ROLES) or bool(words & COMMENTS)
            if tag not in ("html", "body", "article", "main"):
                named |= bool(words & NAMES) and not (tag in HEADINGS and article)
            if tag == "header" and article:
                named = True
            elif article and tag in HEADINGS and stack and stack[-1][0] == "header":
                named = False
            stack.append((tag, firm, named, article))
        heading = bool(stack) and stack[-1][0] in HEADINGS
    parts.append(page[pos:])
    flush()
    return out


def _first_pass(blocks: list[Block], stop_words: StopWords, language: str) -> None:
    for b in blocks:
        size = len(b.text)
        if b.barred or b.linked > LINKED * size:
            b.label = BAD
            continue
        b.stops = stops = stop_words.density(b.text, language)
        if stops is None:
            b.label = LIKELY if b.article or size > LONG else OPEN
        elif stops >= DENSE and size > LONG:
            b.label = GOOD
        elif b.article or stops >= DENSE and size > SHORT or stops >= SPARSE and size > LONG:
            b.label = LIKELY
        elif size > LONG:
            b.label = BAD


def _dense(b: Block) -> bool:
    return b.stops is not None and b.stops >= DENSE


def _second_pass(blocks: list[Block]) -> None:
    """Undecided blocks inherit from the nearest decided ones of their section."""
    if not any(b.label == GOOD or b.article for b in blocks):
        # No block is long and dense: the likely ones are the best there are, or else dense ones.
        likely = [b for b in blocks if b.label == LIKELY]
        for b in likely or [b for b in blocks if b.label == OPEN and _dense(b) and len(b.text) > TINY]:
            b.label = GOOD
    first = [b.label for b in blocks]
    n = len(blocks)
    before, after = [None] * n, [None] * n
    for order, near in ((range(n), before), (range(n - 1, -1, -1), after)):
        last, section = None, None
        for i in order:
            if blocks[i].article != section:
                last, section = None, blocks[i].article
            near[i] = last
            if first[i] in (GOOD, BAD) and not blocks[i].barred:
                last = (first[i], i)
    for i, b in enumerate(blocks):
        if first[i] in (GOOD, BAD):
            continue
        near = {x[0]: abs(x[1] - i) for x in (before[i], after[i]) if x}
        if b.article:
            b.label = GOOD
        elif BAD not in near:
            b.label = GOOD if near or first[i] == LIKELY else BAD
        elif GOOD not in near:
            b.label = BAD
        else:
            ahead = after[i][0] == GOOD and near[GOOD] <= NEAR
            nearer = near[GOOD] < near[BAD] or near[GOOD] == near[BAD] and _dense(b)
            b.label = GOOD if first[i] == LIKELY or nearer or b.heading and ahead else BAD


def main_text(page: str | None, stop_words: StopWords | frozenset[str]) -> str:
    known = stop_words if isinstance(stop_words, StopWords) else StopWords.fixed(stop_words)
    blocks = blocks_of(page or "")
    _first_pass(blocks, known, page_language(page or ""))
    _second_pass(blocks)
    return "\n\n".join(b.text for b in blocks if b.label == GOOD)


def count_words(page: str, counts: dict[str, Counter]) -> None:
    """Add the page's words to those of its language."""
    text = MARKUP.sub(" ", page)
    if "&" in text:
        text = entities.unescape(text)
    counts.setdefault(page_language(page), Counter()).update(WORDS.findall(text.lower()))


def word_rows(counts: dict[str, Counter]) -> pa.RecordBatch:
    """Language, script, word and count; under the empty word, all words of the script."""
    rows, totals = [], Counter()
    for language, words in counts.items():
        for word, n in words.items():
            script = script_of(word)
            totals[language, script] += n
            if len(word) <= LONGEST_STOP:
                rows.append((language, script, word, n))
    rows += [(*key, "", n) for key, n in totals.items()]
    columns = list(zip(*rows)) or [()] * 4
    kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      ["lang", "script", "word", "n"])


def learn_stop_words(pages: DataFrame, html: str = "html", top: int = TOP) -> StopWords:
    """From the whole texts of all pages. What comes to the driver is `top` words and a total for each
    code of up to three letters and script, however many pages there are."""
    def work(batches):
        counts: dict[str, Counter] = {}
        for batch in batches:
            for page in batch.column(0).to_pylist():
                count_words(page or "", counts)
                if sum(map(len, counts.values())) > MOST_ENTRIES:
                    yield word_rows(counts)
                    counts = {}
        yield word_rows(counts)

    found = pages.select(F.col(html).alias("_html")).mapInArrow(
        work, "lang string, script int, word string, n bigint")
    found = found.groupBy("lang", "script", "word").agg(F.sum("n").alias("n"))
    # The total is the largest count of its group, or ties with its only word.
    order = Window.partitionBy("lang", "script").orderBy(F.desc("n"), "word")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top + 1)
    groups: dict[tuple[str, int], dict[str, int]] = {}
    for r in best.select("lang", "script", "word", "n").collect():
        groups.setdefault((r.lang, r.script), {})[r.word] = r.n
    known = {}
    for key, words in groups.items():
        total = words.pop("")
        if words:
            known[key] = frozenset(words), sum(words.values()) / total
    return StopWords(known)


def extract(pages: DataFrame, stop_words: StopWords | None = None, *, key: str = "page_id",
            url: str = "url", html: str = "html") -> DataFrame:
    """key, url, text and n_chars of each page. One pass without a shuffle, after one that learns the
    stop words if none are given."""
    known = learn_stop_words(pages, html) if stop_words is None else stop_words
    words = pages.sparkSession.sparkContext.broadcast(known)
    kind = pages.schema[key].dataType.simpleString()

    def work(batches):
        for batch in batches:
            texts = [main_text(p, words.value) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["_key", "_url", "text", "n_chars"])

    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.col(html).alias("_html"))
    found = rows.mapInArrow(work, f"_key {kind}, _url string, text string, n_chars bigint")
    return found.select(F.col("_key").alias(key), F.col("_url").alias(url), "text", "n_chars")
