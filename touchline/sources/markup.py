"""A page as a small element tree, for the table readers that run inside tasks."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OPEN = re.compile(r"</?([a-zA-Z][^\s/>]*)")
# The text up to the next <, and the tag that begins there, if it is one and closes outside of quotes; with it the text
# up to its own closing tag, if there is nothing else between them. Tags of raw texts are left to the scanner.
TOKEN = re.compile(
    r"""([^<]*+)(?:<(/?)(?![sS](?i:cript|tyle)[\s/>])([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>(?:([^<]*+)</\3>)?)?"""
)
RAW_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style")}
ATTR = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
# The first two bytes of all white space beyond ASCII.
WIDE_BLANKS = sorted({int.from_bytes(chr(c).encode()[:2]) for c in range(0x80, 0x3001) if chr(c).isspace()})
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Opening one of these ends an open element of the listed kinds.
ENDS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th")}


def attributes(source: str) -> dict[str, str]:
    return {k.lower(): unescape(v.strip("\"'")) for k, v in ATTR.findall(source)}


class Tree:
    """Elements by number and texts, both in document order: what lies below an element is a run of each.

    ``ends`` and ``last_texts`` of an element that is not closed are None.
    """

    def __init__(self):
        self.tags, self.sources, self.parents, self.ends, self.attrs = ["#root"], [""], [-1], [None], {}
        self.texts, self.first_texts, self.last_texts = [], [0], [None]


class Element:
    """A view on an element of a tree."""

    __slots__ = ("tree", "number")

    def __init__(self, tree: Tree, number: int):
        self.tree, self.number = tree, number

    def __eq__(self, other) -> bool:
        return isinstance(other, Element) and self.number == other.number and self.tree is other.tree

    def __hash__(self) -> int:
        return hash(self.number)

    @property
    def tag(self) -> str:
        return self.tree.tags[self.number]

    @property
    def source(self) -> str:
        return self.tree.sources[self.number]

    @property
    def parent(self) -> Element | None:
        above = self.tree.parents[self.number]
        return Element(self.tree, above) if above >= 0 else None

    @property
    def end(self) -> int:
        end = self.tree.ends[self.number]
        return len(self.tree.tags) if end is None else end

    @property
    def children(self) -> list[Element]:
        out, at, end = [], self.number + 1, self.end
        while at < end:
            out.append(Element(self.tree, at))
            at = out[-1].end
        return out

    @property
    def attrs(self) -> dict[str, str]:
        known = self.tree.attrs
        if self.number not in known:
            known[self.number] = attributes(self.source)
        return known[self.number]

    def walk(self):
        """All elements below, in document order."""
        return (Element(self.tree, at) for at in range(self.number + 1, self.end))

    def all(self, tag: str, classes=()):
        """All elements of a tag below, in document order."""
        tags, at, end = self.tree.tags, self.number, self.end
        while True:
            try:
                at = tags.index(tag, at + 1, end)
            except ValueError:
                return
            e = Element(self.tree, at)
            if not classes or not set(classes).isdisjoint(e.attrs.get("class", "").split()):
                yield e

    def first(self, tag: str, classes=(), **attrs: str) -> Element | None:
        for e in self.all(tag, classes):
            if all(e.attrs.get(k) == v for k, v in attrs.items()):
                return e
        return None

    def text(self, joiner: str = "") -> str:
        """All text below, stripped; with a joiner every piece is stripped before joining."""
        pieces = self.tree.texts[self.tree.first_texts[self.number] : self.tree.last_texts[self.number]]
        if not joiner:
            return "".join(pieces).strip()
        return joiner.join(p for p in map(str.strip, pieces) if p)


class Scanner:
    """What begins at a <, for all that is no plain tag.

    A search that came to the end of the page without a hit is not repeated, nor one up to its hit, so time is linear also for pages full of
    unclosed tags and comments. What does not close is text.
    """

    def __init__(self, html: str):
        self.html, self.missing, self.seen, self.broken = html, {}, {}, 0
        self.raw_ends: dict[str, list[tuple[int, int]]] = {}

    def find(self, what: str, at: int) -> int:
        if at >= self.missing.get(what, len(self.html)):
            return -1
        since, found = self.seen.get(what, (0, -1))
        if since <= at <= found:
            return found
        found = self.html.find(what, at)
        if found < 0:
            self.missing[what] = at
        else:
            self.seen[what] = at, found
        return found

    def tag_end(self, at: int) -> int:
        """The place of the ``>`` that closes a tag, outside of quotes; -1 if there is none."""
        first = self.find(">", at)
        if first < 0 or self.broken >= 2:  # quotes do not match up: the next > will do
            return first
        place = at
        while True:
            close = self.find(">", place)
            quotes = [q for q in (self.find('"', place), self.find("'", place)) if q >= 0]
            quote = min(quotes, default=-1)
            if close < 0 or (quote < 0 or close < quote):
                break
            place = self.find(self.html[quote], quote + 1) + 1
            if not place:
                close = -1
                break
        if close < 0:
            self.broken += 1
        return close

    def token(self, at: int) -> tuple[tuple | None, int]:
        """A comment, raw, open or close token that begins at a <, or none, and the place after it."""
        html = self.html
        if html.startswith("<!--", at):
            end = self.find("-->", at + 4)
            if end >= 0:
                return ("comment", html[at + 4 : end], ""), end + 3
        elif match := OPEN.match(html, at):
            name, closing = match[1].lower(), html[at + 1] == "/"
            end = self.tag_end(match.end())
            if end >= 0 and name in RAW_ENDS and not closing:
                if name not in self.raw_ends:
                    self.raw_ends[name] = [m.span() for m in RAW_ENDS[name].finditer(html)]
                ends = self.raw_ends[name]
                k = bisect_left(ends, (end + 1, 0))
                if k < len(ends):
                    return ("raw", name, html[match.end() : end], html[end + 1 : ends[k][0]]), ends[k][1]
            elif end >= 0:
                return ("close" if closing else "open", name, html[match.end() : end]), end + 1
        return None, at + 1

    def tokens(self):
        """(text before, kind, name or comment, ...) of all tokens, then the text after the last as (text, None, None)."""
        html, at, text_from = self.html, 0, 0
        last = html.rfind(">")  # nothing closes behind it
        while at <= last:
            # Plain tags one after the other, as long as quotes match up.
            for match in TOKEN.finditer(html, at) if self.broken < 2 else ():
                text, closing, name, source, inner = match.groups()
                if name is None:
                    at = match.end()
                    break
                name = name.lower()
                if match.start() > text_from:
                    text = html[text_from : match.end(1)]
                at = text_from = match.end()
                if inner is not None and not closing and name in VOID:
                    yield text, "open", name, source
                    yield inner, "close", name, ""
                elif inner is None or closing:
                    yield text, "close" if closing else "open", name, source
                    if closing and inner is not None:
                        yield inner, "close", name, ""
                else:
                    yield text, "whole", name, source, inner
            at = self.find("<", at)
            if at < 0:
                break
            token, after = self.token(at)
            if token is not None:
                yield html[text_from:at], *token
                text_from = after
            at = after
        yield html[text_from:], None, None


def parse(html: str | None) -> tuple[Element, list[str]]:
    """The element tree of a page, and the text of its comments."""
    tree, comments, open_tags = Tree(), [], Counter()
    tags, sources, parents, ends = tree.tags, tree.sources, tree.parents, tree.ends
    texts, first_texts, last_texts = tree.texts, tree.first_texts, tree.last_texts
    at = 0
    for text, kind, name, *more in Scanner(html or "").tokens():
        if text:
            texts.append(unescape(text) if "&" in text else text)
        if kind == "close":
            while open_tags[name]:
                closed = tags[at]
                open_tags[closed] -= 1
                ends[at], last_texts[at] = len(tags), len(texts)
                at = parents[at]
                if closed == name:
                    break
        elif kind == "comment":
            comments.append(name)
        elif kind is not None:
            if name in ENDS and kind != "raw":
                while tags[at] in ENDS[name]:
                    open_tags[tags[at]] -= 1
                    ends[at], last_texts[at] = len(tags), len(texts)
                    at = parents[at]
            number = len(tags)
            tags.append(name)
            sources.append(more[0])
            parents.append(at)
            first_texts.append(len(texts))
            if kind == "open" and name not in VOID:
                ends.append(None)
                last_texts.append(None)
                at = number
                open_tags[name] += 1
            else:
                # A raw text is taken as it is. A void element has nothing inside, so what a closing tag would end goes on.
                inner = more[1] if kind != "open" else ""
                if inner:
                    texts.append(inner if kind == "raw" or "&" not in inner else unescape(inner))
                ends.append(number + 1)
                last_texts.append(len(texts))
    return Element(tree, 0), comments


def expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for ``count`` numbers, one run after the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Forest:
    """The tags of many pages at once, as arrays in document order; what lies below an element is a run of them.

    It holds the pages that are ``regular``: every < begins a plain tag that ends at the next >, and what is opened is closed in
    order, no element by another. There :func:`parse` finds these elements and texts too. Other pages hold no tags here.
    Elements are numbers of tags, and ``ends`` those of their closing tags; a tag that occurs often is read once.
    """

    def __init__(self, pages: pa.Array):
        pages = pages.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = pages.buffers()
        first = np.frombuffer(offsets, np.int64)[pages.offset : pages.offset + len(pages) + 1]
        self.data = np.frombuffer(data, np.uint8)[: first[-1]] if data else np.zeros(0, np.uint8)
        begin, end = (np.flatnonzero(self.data[first[0] :] == ord(c)) + first[0] for c in "<>")
        counts, ends = (np.diff(np.searchsorted(x, first)) for x in (begin, end))
        self.regular = counts == ends
        self.tags = {"begin": begin[np.repeat(self.regular, counts)], "end": end[np.repeat(self.regular, ends)]}
        self.tags["page"] = np.repeat(np.arange(len(pages)), np.where(self.regular, counts, 0))
        begin, end, page = self.tags.values()
        crossed = end < begin
        crossed[:-1] |= (page[1:] == page[:-1]) & (begin[1:] < end[:-1])
        self._drop(page[crossed])
        self._read_tags()
        self._pair()

    def __getattr__(self, name: str) -> np.ndarray:
        try:
            return self.__dict__["tags"][name]
        except KeyError:
            raise AttributeError(name) from None

    def _drop(self, pages: np.ndarray) -> None:
        self.regular[pages] = False
        self._keep(self.regular[self.page])

    def _keep(self, kept: np.ndarray) -> None:
        if not kept.all():
            self.tags = {name: values[kept] for name, values in self.tags.items()}

    def _read_tags(self) -> None:
        texts = self._bytes(self.begin + 1, self.end).dictionary_encode()
        found = [f"<{text.decode()}>" for text in texts.dictionary.to_pylist()]
        plain = [TOKEN.fullmatch(text) for text in found]
        # What neither is nor might be a tag or a comment is text.
        text = [m is None and not OPEN.match(t) and not t.startswith("<!--") for m, t in zip(plain, found, strict=True)]
        names = [m[3].lower() if m else "" for m in plain]
        closing = [bool(m and m[2]) for m in plain]
        self.sources, self.codes = [m[4] if m else "" for m in plain], {name: i for i, name in enumerate(dict.fromkeys(names))}
        odd = [not t and (m is None or (name in VOID and c)) for m, t, name, c in zip(plain, text, names, closing, strict=True)]
        kind = texts.indices.to_numpy().astype(np.int64)
        of_kind = {"code": [self.codes[n] for n in names], "opens": [not c for c in closing], "void": [n in VOID for n in names], "text": text}
        types = {"code": np.int64}
        self.tags |= {"kind": kind, **{name: np.array(values, types.get(name, bool))[kind] for name, values in of_kind.items()}}
        self._drop(self.page[np.array(odd, bool)[kind]])
        self._keep(~self.text)

    def _levels(self) -> tuple[np.ndarray, np.ndarray]:
        """The number of open elements after each tag, and the depth at which its element lies."""
        after = np.cumsum(np.where(self.void, 0, np.where(self.opens, 1, -1)))
        return after, after + ~self.opens

    def _pair(self) -> None:
        after, _ = self._levels()
        last = np.ones(len(after), bool)
        last[:-1] = self.page[1:] != self.page[:-1]
        # A page has to close as much as it opens, and never more.
        before = np.concatenate([[0], after[last]])[np.cumsum(last) - last]
        self._drop(self.page[(after < before) | (last & (after != before))])
        _, level = self._levels()
        deepest = int(level.max(initial=0))
        real = np.flatnonzero(~self.void)
        order = real[np.argsort(level[real].astype(np.min_scalar_type(deepest)), kind="stable")]
        opened, closed = order[0::2], order[1::2]
        self.ends = np.arange(1, len(level) + 1)
        self.ends[opened] = closed
        odd = np.zeros(len(level), bool)
        odd[opened] = self.code[opened] != self.code[closed]
        # No element may be ended by one that opens right below it.
        ending = np.zeros((len(self.codes),) * 2, bool)
        for name, above in ENDS.items():
            for other in above:
                if name in self.codes and other in self.codes:
                    ending[self.codes[name], self.codes[other]] = True
        bounds = np.searchsorted(level[opened], np.arange(1, deepest + 2)).tolist()
        for a, b, c in zip(bounds[:-2], bounds[1:-1], bounds[2:]):
            above, below = opened[a:b], opened[b:c]
            odd[below] |= ending[self.code[below], self.code[above[np.searchsorted(above, below) - 1]]]
        self.regular[self.page[odd]] = False

    def _bytes(self, begin: np.ndarray, end: np.ndarray) -> pa.Array:
        size = end - begin
        offsets = np.concatenate([[0], np.cumsum(size)])
        data = pa.py_buffer(self.data[expand(begin, size)])
        return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), data])

    def all(self, tag: str, classes=()) -> np.ndarray:
        """All elements of a tag in the regular pages."""
        found = np.flatnonzero((self.code == self.codes.get(tag, -1)) & self.opens & self.regular[self.page])
        if not classes:
            return found
        kinds, which = np.unique(self.kind[found], return_inverse=True)
        named = [not set(classes).isdisjoint(attributes(self.sources[k]).get("class", "").split()) for k in kinds.tolist()]
        return found[np.array(named, bool)[which]]

    def below(self, found: np.ndarray, elements: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each element where in ``found`` those below it begin, and how many they are."""
        first = np.searchsorted(found, elements, "right")
        return first, np.searchsorted(found, self.ends[elements]) - first

    def texts(self, elements: np.ndarray) -> pa.Array:
        """The text below each element, stripped."""
        begin, close = self.end[elements] + 1, self.ends[elements]
        leaf = (close == elements + 1) & ~self.void[elements]
        end = np.where(leaf, self.begin[np.minimum(close, len(self.begin) - 1)], begin)
        texts = self._bytes(begin, end)
        # Those that may begin or end with white space, and those that hold references or other elements.
        some = np.flatnonzero(end > begin)
        head, last = self.data[begin[some]].astype(np.int64), self.data[end[some] - 1]
        wide = head << 8 | self.data[begin[some] + 1]  # a tag follows, so there is a next byte
        odd = ~leaf & ~self.void[elements]
        odd[some[(head <= 0x20) | np.isin(wide, WIDE_BLANKS) | (last <= 0x20) | (last >= 0x7F)]] = True
        odd |= pc.match_substring(texts, "&").to_numpy(zero_copy_only=False)
        texts = texts.cast(pa.large_string())
        return pc.replace_with_mask(texts, pa.array(odd), pa.array([self._text(e) for e in elements[odd].tolist()], pa.large_string()))

    def _text(self, element: int) -> str:
        ends = zip(self.end[element : self.ends[element]].tolist(), self.begin[element + 1 : self.ends[element] + 1].tolist())
        pieces = (self.data[a + 1 : b].tobytes().decode() for a, b in ends)
        return "".join(unescape(p) if "&" in p else p for p in pieces).strip()
