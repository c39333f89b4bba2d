"""A small DOM for main-text extraction: elements with parents, text runs with blocks."""

from __future__ import annotations

import html
import re
from collections import Counter

#: Fixed values of HTML: elements without content, with raw text, that break lines, and what ends what.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg".split())
BLOCK = frozenset("""html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th
thead tr ul head title""".split())
ENDS_P = BLOCK - frozenset("html body head title td th tr tbody thead tfoot li dd dt".split())
ENDS_SAME = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"),
          "th": ("tr", "table"), "option": ("select",)}

_MARK = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">]|["'])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
                   re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|data-y)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Page:
    """Elements in document order (parent before child) and text runs.

    ``tag``, ``parent``, ``depth``, ``tokens`` (words of class, id and role)
    per element; ``runs`` are (element, block, text). A block number changes
    where a block-level element begins or ends.
    """

    def __init__(self, source: str) -> None:
        self.tag: list[str] = ["#page"]
        self.parent: list[int] = [-1]
        self.depth: list[int] = [0]
        self.tokens: list[frozenset[str]] = [frozenset()]
        self.marked: list[str] = [""]
        self.runs: list[tuple[int, int, str]] = []
        self._parse(source)

    def _open(self, stack: list[int], tag: str, attributes: str) -> None:
        words: set[str] = set()
        marked = ""
        for name, value in _ATTRIBUTE.findall(attributes) if "=" in attributes else ():
            value = value.strip("\"'")
            if name.lower() == "data-y":
                marked = value
            else:
                words.update(t.lower() for t in _TOKEN.findall(value))
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.depth.append(self.depth[stack[-1]] + 1)
        self.tokens.append(frozenset(words))
        self.marked.append(marked)

    def _parse(self, source: str) -> None:
        stack, block, at, end = [0], 0, 0, len(source)
        tags = self.tag
        # Open elements by tag: the stack is searched only for what it holds, however deep it is.
        opened: Counter[str] = Counter()

        def close(first: int) -> None:
            opened.subtract(tags[i] for i in stack[first:])
            del stack[first:]
        while at < end:
            found = _MARK.search(source, at)
            stop = found.start() if found else end
            if stop > at:
                text = source[at:stop]
                self.runs.append((stack[-1], block, html.unescape(text) if "&" in text else text))
            if not found:
                break
            at = found.end()
            if found.group(2) is None:
                continue
            tag = found.group(2).lower()
            if found.group(1):
                block += tag in BLOCK
                for i in range(len(stack) - 1, 0, -1) if opened[tag] > 0 else ():
                    if tags[stack[i]] == tag:
                        if tag in BLOCK:
                            close(i)
                        else:  # an inline end leaves blocks opened inside it open
                            del stack[i]
                            opened[tag] -= 1
                        break
                continue
            block += tag in BLOCK
            if tag in ENDS_P and opened["p"] > 0:
                for i in range(len(stack) - 1, 0, -1):
                    if tags[stack[i]] == "p":
                        close(i)
                        break
                    if tags[stack[i]] in ("td", "th", "table", "button"):
                        break
            if tag in ENDS_SAME and any(opened[t] > 0 for t in ENDS_SAME[tag]):
                for i in range(len(stack) - 1, 0, -1):
                    if tags[stack[i]] in ENDS_SAME[tag]:
                        close(i)
                        break
                    if tags[stack[i]] in SCOPES[tag]:
                        break
            if tag == "br":
                self.runs.append((stack[-1], block, " "))
            if tag in VOID:
                continue
            self._open(stack, tag, found.group(3))
            if tag in RAW:
                over = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
                at = over.end() if over else end
            elif not found.group(3).endswith("/") or tag in BLOCK:  # "<div/>" is just "<div>" in HTML
                stack.append(len(tags) - 1)
                opened[tag] += 1
