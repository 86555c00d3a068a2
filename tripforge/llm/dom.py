"""A small tolerant HTML reader: a page as a list of block nodes in page order."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# one token: a comment or declaration, a tag (quoted values may hold ">"), or text
TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+>?|</?[a-zA-Z][^\s/>]*+(?:[^"'>]|"[^"]*+"|'[^']*+')*+>|</?[a-zA-Z][^>]*+>?|[^<]++|<""", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
# Fixed sets of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript object ol option p pre "
    "section select summary svg table tbody td template tfoot th thead title tr ul video audio script style textarea iframe".split())
ENDS_P = BLOCK - frozenset("body html head button noscript object option svg video audio script style textarea iframe title template".split())
# a start tag ends these open ones, up to the ones that hold them
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}


@dataclass
class Node:
    tag: str
    label: str                       # tag, classes and id: what aligns with what
    parent: "Node | None"
    depth: int
    names: frozenset = frozenset()   # the names in class and id, lower-case
    role: str = ""
    children: list = field(default_factory=list)
    parts: list = field(default_factory=list)       # text by itself, in runs between child blocks


@dataclass
class Block:
    """A stretch of text of a block node, white space made single."""

    node: Node
    text: str
    linked: int                      # characters of it inside links


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): html.unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(raw)}


def parse(page: str) -> tuple[Node, list[Block]]:
    """The root and the blocks of a page in page order."""
    root = Node("#root", "#root", None, 0)
    stack, inline, blocks = [root], [], []       # open blocks; open inline tags
    run, linked = [], 0
    at, size = 0, len(page)

    def flush():
        nonlocal run, linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                blocks.append(Block(stack[-1], text, linked))
            run, linked = [], 0

    def close(upto: int):
        nonlocal inline
        flush()
        del stack[upto:]
        inline = []
    while at < size:
        m = TOKEN.match(page, at)
        tok, at = m[0], m.end()
        if tok[0] != "<" or tok == "<":
            text = html.unescape(tok)
            run.append(text)
            if "a" in inline:
                linked += len(text.strip())
            continue
        n = NAME.match(tok)
        if not n:
            continue
        tag = n[1].lower()
        if tok[1] == "/":
            if tag in BLOCK:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close(i)
                        break
            elif tag in inline:
                while inline.pop() != tag:
                    pass
            continue
        if tag in RAW and not tok.endswith("/>"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            body, at = (page[at:end.start()], end.end()) if end else (page[at:], size)
            if tag in BLOCK:
                flush()
            continue
        if tag not in BLOCK:
            if tag == "br":
                run.append("\n")
            elif tag not in VOID and not tok.endswith("/>"):
                inline.append(tag)
            continue
        upto = len(stack)
        if tag in ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    upto = i
                    break
                if stack[i].tag in ("button", "td", "th", "table", "caption", "object"):
                    break
        if tag in ENDS:
            own, within = ENDS[tag]
            for i in range(upto - 1, 0, -1):
                if stack[i].tag in within:
                    break
                if stack[i].tag in own:
                    upto = i
        close(upto)
        if tag in VOID:
            continue
        a = _attributes(tok[n.end():]) if "=" in tok else {}
        node = Node(tag, f"{tag}|{' '.join(sorted(a.get('class', '').split()))}|{a.get('role', '')}", stack[-1], len(stack))
        if a:
            # a name in camel case is told apart by hyphens like the others
            name = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", f"{a.get('class', '')} {a.get('id', '')}")
            node.names, node.role = frozenset(name.lower().split()), a.get("role", "").strip().lower()
        stack[-1].children.append(node)
        if not tok.endswith("/>"):
            stack.append(node)
    flush()
    return root, blocks
