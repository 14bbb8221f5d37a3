"""Main text of web pages by wrapper induction.

The pages of a host come from a few templates. All of them are parsed to trees
and aligned by simple tree matching, by layout; runs of like siblings count as one
iterated node. Each task aligns its pages with wrappers of its own, which are then
aligned with each other. Blocks whose text stays the same are template, nodes whose
text varies are slots, and the part that holds the article is the content. Every page
is then aligned with the wrapper of its layout, and the text of what meets the
content, without template and furniture, is the result.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.tables import PICKED_IN_MEMORY, materialize

#: Pages and their share from which an unchanging text is template.
CONSTANT_PAGES = 4
CONSTANT_SHARE = 0.9
#: Wrappers held by every executor at most, in characters; beyond, they meet the pages in a shuffled join.
WRAPPERS_IN_MEMORY = 32_000_000

#: Levels whose elements tell the layouts of a host apart: those down to the parts of the body.
LAYOUT_LEVELS = 3
#: Entries that a task counts before it hands them on, and slots of its wrappers.
COUNTED = 200_000
SLOTS = 100_000
#: Slots from which on those of a wrapper that fewer of its pages have than this share count as text of the slot above.
MANY_SLOTS = 2000
RARE_SHARE = 0.001
#: Groups in which the layouts of a host are brought together first.
LAYOUT_GROUPS = 64

#: Levels that a wrapper aligns; what is nested deeper is read as it stands.
MAX_DEPTH = 200

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)(?:((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|([^>]*+)(?:>|\Z))", re.S
)
_CLASS = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WHITE = re.compile(r"[\x20\x09-\x0D]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noframes noembed xmp".split())
#: Elements that hold no article text wherever they stand.
_FURNITURE = frozenset(
    "nav header footer aside form script style noscript template iframe noframes noembed button select textarea input "
    "object embed svg canvas audio video dialog menu title head".split()
)
#: Those of them that some layouts put around the whole page; its controls are furniture all the same.
_FRAMES = frozenset(["form", "dialog"])
#: Words of a class, id or role that say the same.
_FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead cookie cookies consent notice notices alert popup modal overlay comment comments disqus share "
    "sharing social related recommended newsletter subscribe signup login search pagination pager widget toolbar complementary "
    "contentinfo".split()
)
#: Words that leave a class a name of furniture, such as "ad-box" or "sidebar-left".
_PLACE_WORDS = frozenset(
    "area bar block bottom box col column container content footer group header holder inner item left link links list main new "
    "outer panel placeholder posts primary right row secondary section site slot small top unit wrap wrapper zone".split()
)
#: Words of a class that the content is in, whatever stands beside them.
_CONTENT_WORDS = frozenset("article content entry post story main body text hentry article-body post-content entry-content".split())
#: Elements that no word makes furniture, and those whose ids are anchors in a text.
_NEVER = frozenset("html body main article h1 h2 h3 h4 h5 h6 p".split())
_ANCHORS = frozenset("section li dt dd span a figure blockquote table tr td th".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
_ENDS_P = _BLOCKS - {"body", "html", "dd", "dt", "li", "tbody", "tfoot", "thead", "tr"}
#: What an opening tag closes, and what stops the search for it.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


class Node:
    """An element: ``children`` holds elements and texts; ``words`` come from class, id and role.

    ``chars`` counts its text and ``linked`` what of it is in links; ``holds`` tells
    whether an article or main element is inside, ``whole`` whether most of the page's text is.
    """

    __slots__ = ("tag", "label", "words", "children", "chars", "linked", "holds", "whole", "path")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag = self.label = tag
        self.words: tuple[str, ...] = ()
        self.children: list[Node | str] = []
        self.chars = self.linked = 0
        self.holds = self.whole = False
        self.path = b""
        if attributes:
            found: list[str] = []
            kept: list[str] = []
            for name, *values in _CLASS.findall(attributes):
                value = next((v for v in values if v), "hidden" if name.lower() == "hidden" else "")
                found += value.lower().split()
                if name.lower() != "id" or tag not in _ANCHORS:
                    kept += value.lower().split()
            if found:
                self.words = tuple(kept)
                self.label = f"{tag}.{found[0]}"

    def elements(self) -> list[Node]:
        return [c for c in self.children if not isinstance(c, str)]

    def is_furniture(self, in_article: bool) -> bool:
        if self.tag in _FRAMES and (self.holds or self.whole):
            return False
        if self.tag in _FURNITURE:
            # An article's own header holds its title.
            return not (in_article and self.tag == "header")
        if not self.words or self.tag in _NEVER:
            return False
        if "hidden" in self.words:
            return True
        if self.holds or not _CONTENT_WORDS.isdisjoint(self.words):
            return False
        plain = any(w in _FURNITURE_WORDS for w in self.words)
        if not plain and not any(_names_furniture(w) for w in self.words):
            return False
        # Mostly links, or nothing.
        if 2 * self.linked >= self.chars:
            return True
        # In an article a word alone is not enough; elsewhere "right-sidebar" may be the layout of the page.
        return not in_article and (plain or not self.whole)

    def own_text(self) -> str:
        return _WHITE.sub(" ", " ".join(c for c in self.children if isinstance(c, str))).strip(" ")


def _names_furniture(word: str) -> bool:
    parts = re.split(r"[-_]+", word)
    return any(p in _FURNITURE_WORDS for p in parts) and all(p in _FURNITURE_WORDS or p in _PLACE_WORDS for p in parts)


def parse(page: str) -> Node:
    """The tree of a page, its nodes with what they hold."""
    root = _tree(page)
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        for child in node.elements():
            child.path = hashlib.blake2b(node.path + child.label.encode("utf-8", "surrogatepass"), digest_size=8).digest()
            todo.append(child)
    # From the inside out.
    for node in reversed(order):
        if node.tag in _FURNITURE and node.tag not in ("header", "form", "dialog"):
            continue
        inner = node.elements()
        node.chars = sum(len(c.strip()) for c in node.children if isinstance(c, str)) + sum(c.chars for c in inner)
        node.linked = node.chars if node.tag == "a" else sum(c.linked for c in inner)
        node.holds = any(c.holds or c.tag in ("article", "main") for c in inner)
    for node in order:
        node.whole = 2 * node.chars > root.chars
    return root


def _tree(page: str) -> Node:
    """A tree with the end tags that HTML leaves out put in; character references are decoded."""
    root = Node("#")
    stack = [root]
    open_tags: Counter[str] = Counter()
    at = 0

    def leave(first: int) -> None:
        open_tags.subtract(n.tag for n in stack[first:])
        del stack[first:]

    def text(part: str) -> None:
        if part:
            stack[-1].children.append(html.unescape(part))

    while True:
        m = _TAG.search(page, at)
        text(page[at : m.start()] if m else page[at:])
        if m is None:
            return root
        at = m.end()
        # A tag that the page ends in is none.
        if not m.group(2) or page[at - 1] != ">":
            continue
        tag = m.group(2).lower()
        if m.group(1):
            # Without a look through all open elements for a tag that is not among them.
            for i in range(len(stack) - 1, 0, -1) if open_tags[tag] > 0 else ():
                if stack[i].tag == tag:
                    leave(i)
                    break
            continue
        closes, stop = _CLOSES.get(tag, ((), ()))
        if tag in _ENDS_P:
            closes, stop = {"p"}, {"table", "button", "object", "td", "th"}
        if any(open_tags[t] > 0 for t in closes):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    leave(i)
                    break
                if stack[i].tag in stop:
                    break
        attributes = m.group(3) if m.group(3) is not None else m.group(4) or ""
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag in _RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            node.children.append(page[at : end.start()] if end else page[at:])
            if end is None:
                return root
            close = page.find(">", end.start())
            at = len(page) if close < 0 else close + 1
        elif tag not in _VOID and not attributes.endswith("/"):
            stack.append(node)
            open_tags[tag] += 1


def _key(path: bytes, text: str) -> int:
    return int.from_bytes(hashlib.blake2b(path + text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _is_leaf(node: Node) -> bool:
    return node.tag in _BLOCKS and not any(not isinstance(c, str) for c in node.children)


def layout_of(root: Node) -> int:
    """A hash of the elements' paths in the upper levels; 0 stands for all layouts."""
    level, paths = [root], set()
    for _ in range(LAYOUT_LEVELS):
        level = [c for n in level for c in n.elements()]
        paths |= {n.path for n in level}
    return _key(b"", "".join(p.hex() for p in sorted(paths))) or 1


def leaf_blocks(root: Node) -> dict[tuple[int, int | None], int]:
    """Characters by ``(path, key)`` of the whole blocks of a page, and 0 by ``(path, None)`` for each of their paths."""
    found: dict[tuple[int, int | None], int] = {}
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag in _FURNITURE and node.tag != "header" and not (node.tag in _FRAMES and (node.holds or node.whole)):
            continue
        if _is_leaf(node) and (text := node.own_text()):
            path = int.from_bytes(node.path, "big", signed=True)
            found[path, None] = 0
            found[path, _key(node.path, text)] = len(text)
        todo += node.elements()
    return found


def declares(root: Node) -> bool:
    """Whether an element outside of furniture says that it is the article."""
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag in ("article", "main") or node.label.endswith(".main"):
            return True
        todo += [c for c in node.elements() if not c.is_furniture(False)]
    return False


def runs(nodes: list) -> list[list]:
    """Neighbouring siblings of one label together."""
    out: list[list] = []
    for node in nodes:
        if out and out[-1][0].label == node.label:
            out[-1].append(node)
        else:
            out.append([node])
    return out


class Slot:
    """A node of a wrapper: how often its own texts were met, and whether it is part of the content."""

    __slots__ = ("label", "tag", "children", "texts", "pages", "chars", "content", "constant", "marked", "path")

    def __init__(self, label: str, tag: str):
        self.label, self.tag = label, tag
        self.children: list[Slot] = []
        self.texts: Counter[str] = Counter()
        self.pages: float = 0
        self.chars: float = 0
        #: Pages where it is furniture outside of an article, and in one.
        self.marked = [0, 0]
        #: 1 where the article declares itself, 2 where pages that declare none have theirs.
        self.content = 0
        self.constant: str | None = None
        self.path = b""

    def elements(self) -> list[Slot]:
        return self.children


#: Pairs of siblings up to which all are weighed; of longer lists those near the diagonal are.
_WHOLE_TABLE = 4096
_BAND = 16


def _match_long(slots: list[Slot], found: list[list[Node]], depth: int) -> tuple[int, list[tuple[int, int]]]:
    """As :func:`_match` for long lists, in linear time: equal labels at both ends are paired, and what is between within a band."""
    n, m = len(slots), len(found)
    head = 0
    while head < min(n, m) and slots[head].label == found[head][0].label:
        head += 1
    tail = 0
    while tail < min(n, m) - head and slots[n - 1 - tail].label == found[m - 1 - tail][0].label:
        tail += 1
    ends = [(i, i) for i in range(head)]
    behind = [(n - tail + i, m - tail + i) for i in range(tail)]
    total = sum(_similarity(slots[i], found[j][0], depth) for i, j in ends + behind)
    p, q = n - head - tail, m - head - tail
    if not p or not q:
        return total, ends + behind

    def bounds(i: int) -> tuple[int, int]:
        # Neighbouring rows overlap, so that the last cell can be reached.
        return max(0, i * q // p - _BAND), min(q, (i + 1) * q // p + _BAND)

    weight: dict[tuple[int, int], int] = {}
    best: list[dict[int, int]] = [dict.fromkeys(range(bounds(0)[1] + 1), 0)]
    for i in range(1, p + 1):
        row, above = {}, best[i - 1]
        for j in range(bounds(i)[0], bounds(i)[1] + 1):
            most = max(above.get(j, -1), row.get(j - 1, -1), 0 if j == 0 else -1)
            if j and above.get(j - 1, -1) >= 0:
                weight[i, j] = _similarity(slots[head + i - 1], found[head + j - 1][0], depth)
                most = max(most, above[j - 1] + weight[i, j])
            row[j] = most
        best.append(row)
    pairs = []
    i, j = p, q
    while i and j:
        gain = weight.get((i, j), 0)
        if gain and best[i][j] == best[i - 1][j - 1] + gain:
            pairs.append((head + i - 1, head + j - 1))
            i, j = i - 1, j - 1
        elif best[i - 1].get(j, -1) == best[i][j]:
            i -= 1
        else:
            j -= 1
    return total + best[p][q], ends + pairs[::-1] + behind


def _match(slots: list[Slot], found: list[list[Node]], depth: int) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two sibling lists: the most nodes matched in order, and the pairs."""
    if not slots or not found:
        return 0, []
    if len(slots) * len(found) > _WHOLE_TABLE:
        return _match_long(slots, found, depth)
    weight = [[_similarity(s, f[0], depth) for f in found] for s in slots]
    best = [[0] * (len(found) + 1) for _ in range(len(slots) + 1)]
    for i in range(1, len(slots) + 1):
        row, above, given = best[i], best[i - 1], weight[i - 1]
        for j in range(1, len(found) + 1):
            row[j] = max(above[j], row[j - 1], above[j - 1] + given[j - 1])
    pairs = []
    i, j = len(slots), len(found)
    while i and j:
        if weight[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + weight[i - 1][j - 1]:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[-1][-1], pairs[::-1]


#: Levels that are weighed when two nodes are compared; deeper ones are matched once their parents are.
_LOOK_AHEAD = 2


def _similarity(slot: Slot, node: Node, depth: int = _LOOK_AHEAD) -> int:
    if slot.label != node.label:
        return 0
    return 1 + (_match(slot.children, runs(node.elements()), depth - 1)[0] if depth else 0)


def _whole_text(node: Node) -> str:
    parts, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(item)
        elif item.tag not in _FURNITURE or (item.tag in _FRAMES and (item.holds or item.whole)):
            todo += reversed(item.children)
    return _WHITE.sub(" ", " ".join(parts)).strip(" ")


def _learn(slot: Slot, nodes: list[Node], depth: int = 0) -> None:
    """Align the nodes of one page with their slot, and add what the wrapper does not have yet."""
    slot.pages += 1
    slot.path = nodes[0].path
    for i in (0, 1):
        slot.marked[i] += all(node.is_furniture(bool(i)) for node in nodes)
    deepest = depth >= MAX_DEPTH
    texts = {_whole_text(node) if deepest else node.own_text() for node in nodes} - {""}
    slot.texts.update(texts)
    slot.chars += sum(map(len, texts))
    if deepest:
        return
    for node in nodes:
        found = runs(node.elements())
        _, pairs = _match(slot.children, found, _LOOK_AHEAD)
        of_run = {j: slot.children[i] for i, j in pairs}
        place = 0
        for j, run in enumerate(found):
            if j not in of_run:
                of_run[j] = Slot(run[0].label, run[0].tag)
                slot.children.insert(place, of_run[j])
            place = slot.children.index(of_run[j]) + 1
    # One visit a page and slot, so that iterated nodes are told from constant ones.
    gathered: dict[int, tuple[Slot, list[Node]]] = {}
    for node in nodes:
        found = runs(node.elements())
        for i, j in _match(slot.children, found, _LOOK_AHEAD)[1]:
            gathered.setdefault(i, (slot.children[i], []))[1].extend(found[j])
    for child, members in gathered.values():
        _learn(child, members, depth + 1)


def _aligned(slot: Slot, found: list[list]) -> list[Slot]:
    """The slot below for each run, with new ones put in for those that match none."""
    slots = slot.children
    if [s.label for s in slots] == [run[0].label for run in found]:
        return slots[:]
    of_run = {j: i for i, j in _match(slots, found, _LOOK_AHEAD)[1]}
    out = []
    place = added = 0
    for j, run in enumerate(found):
        if j in of_run:
            place = of_run[j] + added
        else:
            slots.insert(place, Slot(run[0].label, run[0].tag))
            added += 1
        out.append(slots[place])
        place += 1
    return out


def _count(slot: Slot, nodes: list[Node], weight: float, varies: bool, depth: int = 0) -> int:
    """Add the nodes of one page to a wrapper that counts; the number of new slots.

    What no page is searched in has no slots: articles are read whole, furniture
    not at all. Characters are those of pages that declare no article.
    """
    slot.pages += weight
    slot.path = nodes[0].path
    nodes = [n for n in nodes if not n.is_furniture(False)]
    if not nodes:
        slot.marked[0] += weight
        return 0
    deepest = depth >= MAX_DEPTH
    if varies:
        texts = {_whole_text(node) if deepest else node.own_text() for node in nodes}
        slot.chars += weight * sum(map(len, texts))
    if deepest or slot.tag == "article":
        return 0
    before = len(slot.children)
    gathered: dict[int, tuple[Slot, list[Node]]] = {}
    for node in nodes:
        found = runs(node.elements())
        for child, run in zip(_aligned(slot, found), found):
            gathered.setdefault(id(child), (child, []))[1].extend(run)
    new = len(slot.children) - before
    return new + sum(_count(child, members, weight, varies, depth + 1) for child, members in gathered.values())


def _add(slot: Slot, other: Slot) -> None:
    """Align a wrapper that counts with another one, and add it."""
    slot.pages += other.pages
    slot.chars += other.chars
    slot.marked[0] += other.marked[0]
    slot.path = slot.path or other.path
    found = [[c] for c in other.children]
    for child, (given,) in zip(_aligned(slot, found), found):
        _add(child, given)


def _size(slot: Slot) -> int:
    return 1 + sum(map(_size, slot.children))


def _without_rare(wrapper: Slot) -> Slot:
    """A wrapper of many slots without those that hardly a page has, whose text goes to the slot above."""

    def fold(slot: Slot) -> None:
        kept = []
        for child in slot.children:
            if child.pages < RARE_SHARE * wrapper.pages:
                slot.chars += _varying(child)
            else:
                fold(child)
                kept.append(child)
        slot.children = kept

    if _size(wrapper) > MANY_SLOTS:
        fold(wrapper)
    return wrapper


def _is_furniture(slot: Slot, in_article: bool) -> bool:
    return 2 * slot.marked[in_article] > slot.pages


def _varying(slot: Slot, in_article: bool = False) -> int:
    """Characters of the slots below that change from page to page."""
    if _is_furniture(slot, in_article):
        return 0
    own = 0 if slot.constant is not None else slot.chars
    return own + sum(_varying(c, in_article or slot.tag == "article") for c in slot.children)


def _settle(slot: Slot, template: set[int] | None) -> None:
    # Template are whole blocks only: a bold word that all pages share is part of their text.
    if slot.texts and not slot.children and slot.tag in _BLOCKS:
        text, n = slot.texts.most_common(1)[0]
        if template is not None:
            constant = _key(slot.path, text) in template
        else:
            constant = slot.pages >= CONSTANT_PAGES and n >= CONSTANT_SHARE * slot.pages and len(slot.texts) <= n
        if constant:
            slot.constant = text
    for child in slot.children:
        _settle(child, template)


def _articles(slot: Slot) -> list[Slot]:
    """The outermost elements that declare themselves the article, outside of furniture."""
    if _is_furniture(slot, False):
        return []
    if slot.tag == "article":
        return [slot]
    found = [a for c in slot.children for a in _articles(c)]
    if not found and (slot.tag == "main" or slot.label.endswith(".main")):
        return [slot]
    return found


def induce(pages: list[str], template: set[int] | None = None) -> Slot:
    """The wrapper of some pages of one host; without the keys of its ``template`` blocks these pages alone tell them."""
    wrapper = Slot("#", "#")
    for page in pages:
        _learn(wrapper, [parse(page)])
    _settle(wrapper, template)
    for slot in _articles(wrapper) or [_fullest(wrapper)]:
        slot.content = 1
    return wrapper


def _fullest(wrapper: Slot) -> Slot:
    """The deepest node that holds most of what varies."""
    node, total = wrapper, _varying(wrapper)
    while total:
        deeper = [c for c in node.children if _varying(c) >= 0.7 * total]
        if not deeper or deeper[0].tag in ("p", "li", "span", "a", "b"):
            break
        node = deeper[0]
    return node


def _choose(wrapper: Slot, fixed: dict[int, float]) -> Slot:
    """Mark the content in a wrapper that counts, given the share of each path's characters that is template."""

    def settle(slot: Slot) -> None:
        slot.chars *= 1 - fixed.get(int.from_bytes(slot.path, "big", signed=True), 0.0)
        for child in slot.children:
            settle(child)

    settle(wrapper)
    if _varying(wrapper) > 0:
        _fullest(wrapper).content = 2
    for slot in _articles(wrapper):
        slot.content = 1
    return wrapper


def _counts_to_json(slot: Slot) -> str:
    def plain(s: Slot) -> list:
        return [s.label, s.tag, s.pages, s.chars, s.marked[0], s.path.hex(), [plain(c) for c in s.children]]

    return json.dumps(plain(slot), ensure_ascii=False, separators=(",", ":"))


def _counts_from_json(text: str) -> Slot:
    def built(given: list) -> Slot:
        slot = Slot(given[0], given[1])
        slot.pages, slot.chars, slot.marked[0] = given[2:5]
        slot.path = bytes.fromhex(given[5])
        slot.children = [built(c) for c in given[6]]
        return slot

    return built(json.loads(text))


def to_json(slot: Slot) -> str:
    """What leads to the content, and what is weighed on the way."""

    leading: set[int] = set()

    def mark(s: Slot) -> bool:
        if any([mark(c) for c in s.children]):
            leading.add(id(s))
        return s.content > 0 or id(s) in leading

    def plain(s: Slot, levels: int) -> list:
        levels = _LOOK_AHEAD if id(s) in leading else levels
        return [s.label, s.tag, s.content, [plain(c, levels - 1) for c in s.children] if levels > 0 else []]

    mark(slot)
    return json.dumps(plain(slot, _LOOK_AHEAD), ensure_ascii=False, separators=(",", ":"))


def from_json(text: str) -> Slot:
    def built(given: list) -> Slot:
        slot = Slot(given[0], given[1])
        slot.content = given[2]
        slot.children = [built(c) for c in given[3]]
        return slot

    return built(json.loads(text))


def extract(page: str, wrapper: Slot | dict[int, Slot], templates: dict[int, set[int]] | None = None) -> list[str]:
    """The text blocks of a page's content, without the host's ``templates``: keys by layout, those of 0 for all pages.

    Wrappers may be given by layout in the same way.
    """
    root = parse(page)
    layout = layout_of(root) if templates or isinstance(wrapper, dict) else 0
    general = own = frozenset()
    if templates:
        general, own = templates.get(0, general), templates.get(layout, own)
    blocks: list[str] = []
    parts: list[str] = []

    def close() -> None:
        block = _WHITE.sub(" ", "".join(parts)).strip(" ")
        if block:
            blocks.append(block)
        parts.clear()

    def read(top: Node, of_top: Slot, within: bool) -> None:
        # By a list of what is to come, as pages may be nested to any depth; None ends a block.
        todo: list[tuple[Node, Slot | None, bool] | str | None] = [(top, of_top, within)]
        while todo:
            item = todo.pop()
            if item is None:
                close()
                continue
            if isinstance(item, str):
                parts.append(item)
                continue
            node, slot, in_article = item
            if node.is_furniture(in_article):
                continue
            if templates is None:
                if slot is not None and slot.constant is not None and node.own_text() == slot.constant:
                    continue
            elif (general or own) and _is_leaf(node):
                key = _key(node.path, node.own_text())
                if key in general or key in own:
                    continue
            if node.tag == "br":
                parts.append(" ")
                continue
            if node.tag in _BLOCKS:
                close()
                todo.append(None)
            elif node.tag in ("td", "th"):
                parts.append(" ")
            # Template is told by its path where it was counted.
            of_child = _slots_of(node, slot) if templates is None else {}
            inner = in_article or node.tag == "article"
            todo += [c if isinstance(c, str) else (c, of_child.get(id(c)), inner) for c in reversed(node.children)]

    def seek(node: Node, slot: Slot, wanted: tuple[int, ...] = (1, 2)) -> bool:
        """Read all nodes that meet a content slot; whether there were any."""
        if slot.content in wanted:
            read(node, slot, node.tag == "article")
            close()
            return True
        of_child = _slots_of(node, slot)
        return any([seek(c, of_child[id(c)], wanted) for c in node.elements() if id(c) in of_child and not c.is_furniture(False)])

    if isinstance(wrapper, Slot):
        met = seek(root, wrapper)
    else:
        wanted = (1,) if declares(root) else (2,)
        met = any(seek(root, wrapper[n], wanted) for n in (layout, 0) if n in wrapper)
    if not met:
        # Not built like its host's other pages: it is its own wrapper.
        alone = induce([page])
        seek(root, alone)
    return blocks


def _slots_of(node: Node, slot: Slot | None) -> dict[int, Slot]:
    if slot is None or not slot.children:
        return {}
    found = runs(node.elements())
    if [s.label for s in slot.children] == [run[0].label for run in found]:
        return {id(n): s for s, run in zip(slot.children, found) for n in run}
    return {id(n): slot.children[i] for i, j in _match(slot.children, found, _LOOK_AHEAD)[1] for n in found[j]}


def host_of(url: Column) -> Column:
    """The host in lower case, without port or user; empty when there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _counted(pages: DataFrame) -> DataFrame:
    """Counts of blocks, ``(host, layout, path, key, n, open, chars)``, and wrappers of each task, ``(host, layout, wrapper)``, of all pages.

    Equal pages of a host weigh as one. ``open`` is the part of ``n`` from pages that declare no article.
    """
    pages = pages.select("host", "html", F.xxhash64("html").alias("page")).where("html <> ''")
    repeated = pages.groupBy("host", "page").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    repeated = materialize(repeated)
    if repeated.count() <= PICKED_IN_MEMORY:
        repeated = F.broadcast(repeated)
    weighed = pages.join(repeated, ["host", "page"], "left").select("host", "html", (1 / F.coalesce("times", F.lit(1))).alias("weight"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, int, int | None], list[float]] = {}
        wrappers: dict[tuple[str, int], Slot] = {}
        slots = 0

        def counts() -> pa.RecordBatch:
            rows = [(*place, *n, None) for place, n in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        def learned(places: list[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(places), 1000):
                rows = [(*p, None, None, None, None, None, _counts_to_json(_without_rare(wrappers.pop(p)))) for p in places[at : at + 1000]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for host, page, weight in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                root = parse(page.as_py())
                layout = layout_of(root)
                varies = not declares(root)
                for (path, key), chars in leaf_blocks(root).items():
                    entry = held.setdefault((host, layout, path, key), [0.0, 0.0, chars])
                    entry[0] += weight
                    entry[1] += weight if varies else 0.0
                if len(held) >= COUNTED:
                    yield counts()
                wrapper = wrappers.get((host, layout))
                if wrapper is None:
                    wrapper = wrappers[host, layout] = Slot("#", "#")
                new = _count(wrapper, [root], weight, varies)
                slots += new + 1
                # Only a wrapper that grows with its pages is looked at.
                if new and _size(wrapper) > 2 * MANY_SLOTS:
                    yield from learned([(host, layout)])
                if slots >= SLOTS:
                    yield from learned([*wrappers])
                    slots = 0
        if held:
            yield counts()
        yield from learned([*wrappers])

    names = ["host", "layout", "path", "key", "n", "open", "chars", "wrapper"]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.string())
    ddl = "host string, layout long, path long, key long, n double, open double, chars long, wrapper string"
    return materialize(weighed.mapInArrow(count, ddl))


def _templates(counted: DataFrame) -> DataFrame:
    """``(host, template, fixed)``: the layouts and keys of the blocks that stay the same, and the share they have of a path's characters.

    A block is template when ``CONSTANT_SHARE`` of the pages with its path have it,
    among those of its layout or among all.
    """
    sums = (F.sum("n").alias("n"), F.sum("open").alias("open"), F.max("chars").alias("chars"))
    by_layout = materialize(counted.where("wrapper is null").groupBy("host", "layout", "path", "key").agg(*sums))
    over_all = by_layout.groupBy("host", F.lit(0).cast("long").alias("layout"), "path", "key").agg(*sums)
    places = (
        by_layout.unionByName(over_all)
        # Sums of parts of equal pages are whole numbers but for rounding.
        .withColumn("n", F.round("n").cast("long"))
        .groupBy("host", "layout", "path")
        .agg(
            F.max(F.when(F.col("key").isNull(), F.col("n"))).alias("pages"),
            F.max(F.when(F.col("key").isNotNull(), F.struct("n", "key", "open", "chars"))).alias("top"),
            F.count("key").alias("texts"),
            F.sum(F.col("open") * F.col("chars")).alias("all"),
        )
    )
    constant = (F.col("pages") >= CONSTANT_PAGES) & (F.col("top.n") >= CONSTANT_SHARE * F.col("pages")) & (F.col("texts") <= F.col("top.n"))
    places = places.withColumn("entry", F.when(constant, F.concat_ws(":", "layout", "top.key"))).withColumn(
        "fixed", F.when(constant, F.col("top.open") * F.col("top.chars")).otherwise(0.0)
    )

    def share(layout: Column, fixed: Column, whole: Column) -> Column:
        return F.concat_ws(":", layout, "path", F.least(F.lit(1.0), F.coalesce(F.try_divide(fixed, whole), F.lit(0.0))))

    general = F.col("layout") == 0
    of_layout = F.when(F.col("entry").isNotNull() & ~general, share(F.col("layout"), F.col("fixed"), F.col("all")))
    paths = (
        places.groupBy("host", "path")
        .agg(
            F.collect_list("entry").alias("entries"),
            F.collect_list(of_layout).alias("shares"),
            F.max(F.when(general, F.col("fixed"))).alias("fixed"),
            F.sum(F.when(general, 0.0).otherwise(F.col("fixed"))).alias("fixed_parts"),
            F.max(F.when(general, F.col("all"))).alias("all"),
        )
        .where(F.size("entries") > 0)
        .withColumn("shares", F.array_append("shares", share(F.lit(0), F.greatest("fixed", "fixed_parts"), F.col("all"))))
    )
    return materialize(
        paths.groupBy("host").agg(
            *[F.concat_ws(",", F.array_sort(F.flatten(F.collect_list(c)))).alias(name) for c, name in (("entries", "template"), ("shares", "fixed"))]
        )
    )


def _by_layout(template: str | None) -> dict[int, set[int]]:
    found: dict[int, set[int]] = {}
    for entry in (template or "").split(",") if template else ():
        layout, key = entry.split(":")
        found.setdefault(int(layout), set()).add(int(key))
    return found


def _fixed(shares: str | None) -> dict[int, dict[int, float]]:
    found: dict[int, dict[int, float]] = {}
    for entry in (shares or "").split(",") if shares else ():
        layout, path, share = entry.split(":")
        found.setdefault(int(layout), {})[int(path)] = float(share)
    return found


def _wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper, template)``, counted and aligned over all pages of each host.

    ``wrapper`` holds those of the layouts that ``CONSTANT_PAGES`` pages have, and under 0 the one of all layouts.
    """
    counted = _counted(pages)
    templates = _templates(counted)

    def by_layout(table: pa.Table) -> pa.Table:
        host = table.column("host")[0].as_py()
        fixed = _fixed(table.column("fixed")[0].as_py())
        whole = Slot("#", "#")
        rows: list[tuple[int, str]] = []
        given = sorted(zip(table.column("layout").to_pylist(), table.column("wrapper").to_pylist()))
        for layout, parts in groupby(given, lambda row: row[0]):
            wrapper = Slot("#", "#")
            for _, part in parts:
                _add(wrapper, _counts_from_json(part))
                _without_rare(wrapper)
            _add(whole, wrapper)
            _without_rare(whole)
            # Sums of parts of equal pages are whole numbers but for rounding.
            if round(wrapper.pages) >= CONSTANT_PAGES:
                rows.append((layout, to_json(_choose(wrapper, fixed.get(0, {}) | fixed.get(layout, {})))))
        rows.append((0, _counts_to_json(whole)))
        return pa.table({"host": pa.array([host] * len(rows), pa.string()), "layout": pa.array([n for n, _ in rows], pa.int64()), "wrapper": [w for _, w in rows]})

    def by_host(table: pa.Table) -> pa.Table:
        host = table.column("host")[0].as_py()
        whole = Slot("#", "#")
        found: dict[int, str] = {}
        for layout, wrapper in sorted(zip(table.column("layout").to_pylist(), table.column("wrapper").to_pylist())):
            if layout:
                found[layout] = wrapper
            else:
                _add(whole, _counts_from_json(wrapper))
                _without_rare(whole)
        found[0] = to_json(_choose(whole, _fixed(table.column("fixed")[0].as_py()).get(0, {})))
        return pa.table({"host": pa.array([host], pa.string()), "wrapper": pa.array([json.dumps(found, ensure_ascii=False)], pa.string())})

    fixed = templates.select("host", "fixed")
    parts = counted.where("wrapper is not null").select("host", "layout", "wrapper").join(fixed, "host", "left")
    groups = parts.groupBy("host", F.pmod("layout", F.lit(LAYOUT_GROUPS)))
    layouts = materialize(groups.applyInArrow(by_layout, "host string, layout long, wrapper string"))
    wrappers = layouts.join(fixed, "host", "left").groupBy("host").applyInArrow(by_host, "host string, wrapper string")
    return materialize(materialize(wrappers).join(templates.drop("fixed"), "host", "full_outer"))


def main_texts(pages: DataFrame, sample: int | None = None, in_memory: int = WRAPPERS_IN_MEMORY) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``, blocks in page order joined by an empty line.

    A null or empty page has an empty text. Pages without a host share one
    wrapper; a host with one page, or a page unlike its host's others, is its own
    wrapper. Repeated rows give repeated results and weigh as one; a null id stays
    null. No rows give no rows. Wrappers are learned from all pages: ``sample``, once
    the number of them, has no effect.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).withColumn("host", host_of(F.col("url")))
    wrappers = _wrappers(rows)
    size = wrappers.agg(F.sum(F.length(F.concat_ws("", "wrapper", "template")))).first()[0] or 0
    joined = rows.join(F.broadcast(wrappers) if size <= in_memory else wrappers, "host", "left")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str | None, str | None], tuple[dict[int, Slot], dict[int, set[int]]]] = {}
        for batch in batches:
            texts = []
            for page, *found in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                wrapper, template = given = tuple(found)
                if given not in known:
                    if len(known) >= 256:
                        known.clear()
                    by_layout = {int(n): from_json(w) for n, w in json.loads(wrapper or "{}").items()}
                    known[given] = (by_layout, _by_layout(template))
                page = page.as_py()
                texts.append("\n\n".join(extract(page, *known[given])) if page else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    schema = "page_id long, url string, text string, n_chars long"
    return joined.select("page_id", "url", "html", "wrapper", "template").mapInArrow(read, schema)
