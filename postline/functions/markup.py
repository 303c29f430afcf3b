"""Small HTML helpers on the standard parser, used inside pandas UDFs."""

from __future__ import annotations

import re
from html.parser import HTMLParser

SILENT = {"script", "style", "template"}
BLOCK = {"p", "div", "section", "article", "ul", "ol", "table", "tr", "blockquote", "pre"}


class _Plain(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.quiet = 0

    def handle_starttag(self, tag, attrs):
        self.quiet += tag in SILENT

    def handle_endtag(self, tag):
        if tag in SILENT and self.quiet:
            self.quiet -= 1

    def handle_data(self, data):
        if not self.quiet:
            self.out.append(data)


def to_plain(html: str) -> str:
    """Text nodes with one space between them."""
    parser = _Plain()
    parser.feed(html)
    parser.close()
    return re.sub(r"\s+", " ", " ".join(parser.out)).strip()


class _Markdown(HTMLParser):
    """Headings, paragraphs, breaks, lists, links, emphasis and code."""

    WRAP = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.quiet = 0
        self.lists: list[int | None] = []
        self.links: list[str | None] = []

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.quiet += 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "br":
            self.out.append("  \n")
        elif tag == "hr":
            self.out.append("\n\n---\n\n")
        elif tag == "li":
            number = self.lists[-1] if self.lists else None
            depth = max(len(self.lists) - 1, 0)
            sign = "*" if number is None else f"{number}."
            if number is not None:
                self.lists[-1] = number + 1
            self.out.append("\n" + "  " * depth + sign + " ")
        elif tag in self.WRAP:
            self.out.append(self.WRAP[tag])
        elif tag == "a":
            self.links.append(dict(attrs).get("href"))
            self.out.append("[" if self.links[-1] else "")
        if tag in ("ul", "ol"):
            self.lists.append(1 if tag == "ol" else None)
        if tag in BLOCK and len(self.lists) < 2:
            self.out.append("\n\n")

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.quiet = max(self.quiet - 1, 0)
        elif tag in self.WRAP:
            self.out.append(self.WRAP[tag])
        elif tag == "a" and self.links:
            target = self.links.pop()
            self.out.append(f"]({target})" if target else "")
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n")
        if tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        if tag in BLOCK and not self.lists:
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.quiet:
            self.out.append(re.sub(r"\s+", " ", data))


def to_markdown(html: str) -> str:
    """Our own documented subset of Markdown."""
    parser = _Markdown()
    parser.feed(html)
    parser.close()
    text = "".join(parser.out)
    text = re.sub(r"[ \t]*\n[ \t]*(?=\n)", "\n", text)
    text = re.sub(r"\n{3,} *|\n\n +", "\n\n", text)
    return "\n".join(line.rstrip(" ") if not line.endswith("  ") else line for line in text.split("\n")).strip()


VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Node:
    """One element; children are nodes and texts in order."""

    __slots__ = ("tag", "attrs", "items", "up", "start", "stop")

    def __init__(self, tag, attrs, up, start):
        self.tag, self.attrs, self.up, self.start, self.stop = tag, attrs, up, start, None
        self.items = []

    def walk(self):
        """All elements below, in page order."""
        todo = [x for x in reversed(self.items) if isinstance(x, Node)]
        while todo:
            node = todo.pop()
            yield node
            todo += [x for x in reversed(node.items) if isinstance(x, Node)]

    def text(self, joiner: str = " ") -> str:
        out, todo = [], [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                if node.strip():
                    out.append(node.strip())
            elif node is self or node.tag not in SILENT:
                todo += reversed(node.items)
        return joiner.join(out)


class _Tree(HTMLParser):
    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.lines = [0]
        for line in html.split("\n"):
            self.lines.append(self.lines[-1] + len(line) + 1)
        self.root = self.here = Node("", {}, None, 0)

    def place(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def close_to(self, node, at):
        while self.here is not node:
            self.here.stop = at
            self.here = self.here.up

    def handle_starttag(self, tag, attrs):
        at = self.place()
        if tag in CLOSES and self.here.tag in CLOSES[tag]:
            self.close_to(self.here.up, at)
        node = Node(tag, dict(attrs), self.here, at + len(self.get_starttag_text()))
        self.here.items.append(node)
        if tag in VOID:
            node.stop = node.start
        else:
            self.here = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        node = self.here
        while node is not None and node.tag != tag:
            node = node.up
        if node is not None and node.up is not None:
            self.close_to(node.up, self.place())

    def handle_data(self, data):
        self.here.items.append(data)


def parse(html: str) -> Node:
    tree = _Tree(html)
    tree.feed(html)
    tree.close()
    tree.close_to(tree.root, len(html))
    return tree.root


STEP = re.compile(r"(?P<tag>[a-zA-Z][\w-]*|\*)?(?P<rest>(?:[.#][\w-]+|\[[^\]]+\])*)$")
TEST = re.compile(r"""[.#][\w-]+|\[[^\]]+\]""")
ATTR = re.compile(r"""\[\s*([\w-]+)\s*(?:([*^$~]?=)\s*["']?([^"'\]]*)["']?\s*)?\]""")


def fits(node: Node, step: str) -> bool:
    """Tag, .class, #id and attribute tests of one selector step."""
    m = STEP.match(step)
    if not m:
        raise ValueError(f"unsupported selector: {step}")
    if m["tag"] not in (None, "*") and node.tag != m["tag"].lower():
        return False
    for test in TEST.findall(m["rest"]):
        if test[0] == ".":
            ok = test[1:] in (node.attrs.get("class") or "").split()
        elif test[0] == "#":
            ok = node.attrs.get("id") == test[1:]
        else:
            name, sign, wanted = ATTR.match(test).groups()
            value = node.attrs.get(name)
            ok = value is not None and (
                sign is None
                or (sign == "=" and value == wanted)
                or (sign == "*=" and wanted in value)
                or (sign == "^=" and value.startswith(wanted))
                or (sign == "$=" and value.endswith(wanted))
                or (sign == "~=" and wanted in value.split())
            )
        if not ok:
            return False
    return True


def select(root: Node, selector: str):
    """Elements matched by tag, class, id, attribute, descendant and child selectors, in page order."""
    chains = [re.split(r"\s+", re.sub(r"\s*>\s*", " > ", s.strip())) for s in selector.split(",")]
    for node in root.walk():
        if any(_chain_fits(node, chain, root) for chain in chains):
            yield node


def _chain_fits(node: Node, chain: list[str], root: Node) -> bool:
    if not fits(node, chain[-1]):
        return False
    if len(chain) == 1:
        return True
    if chain[-2] == ">":
        return node.up is not None and node.up is not root and _chain_fits(node.up, chain[:-2], root)
    up = node.up
    while up is not None and up is not root:
        if _chain_fits(up, chain[:-1], root):
            return True
        up = up.up
    return False


def first_match(root: Node, selector: str) -> Node | None:
    return next(select(root, selector), None)
