"""HTML to typed blocks: scopes, headings with their paths, key-value pairs, and tables with spans resolved."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.sources.html import BLOCK, HIDDEN

VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
#: Tags that an opening tag of the same set closes.
CLOSES = {"li": {"li"}, "p": BLOCK - {"br"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
SCOPES = {"nav": "navigation", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "main": "main", "article": "main"}
SCOPE_WORDS = {"nav": "navigation", "navbar": "navigation", "menu": "navigation", "breadcrumb": "navigation", "footer": "footer", "sidebar": "aside", "related": "related", "cookie": "cookie", "ad": "advert", "ads": "advert"}
MAX_SPAN = 50


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.kids = tag, attrs, []


class _Tree(HTMLParser):
    """A lenient tree: unclosed paragraphs, items and cells end where the next begins."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack = [Node("root", {})]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        while len(self.stack) > 1 and tag in CLOSES.get(self.stack[-1].tag, ()):
            self.stack.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].kids.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.stack.pop()

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data: str) -> None:
        self.stack[-1].kids.append(data)


def squeeze(s: str) -> str:
    return re.sub(r"\s+", " ", s).strip()


def inline(root: Node) -> str:
    """The shown text under a node, without recursion, for any depth."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.tag == "br":
            out.append(" ")
        elif x.tag not in HIDDEN:
            if "data-count" in x.attrs and squeeze("".join(k for k in x.kids if isinstance(k, str))) in ("", "0"):
                out.append(x.attrs["data-count"])
            else:
                todo.extend(reversed(x.kids))
    return squeeze("".join(out))


def under(root: Node, tags: set[str], stop: set[str]) -> list[Node]:
    out, todo = [], list(reversed(root.kids))
    while todo:
        x = todo.pop()
        if isinstance(x, Node):
            if x.tag in tags:
                out.append(x)
            elif x.tag not in stop:
                todo.extend(reversed(x.kids))
    return out


def span_of(cell: Node, name: str) -> int:
    v = cell.attrs.get(name, "1")
    return min(MAX_SPAN, max(1, int(v))) if v.isascii() and v.isdigit() else 1


def grid(table: Node) -> list[list[tuple[str, bool]]]:
    """Rows of (text, is header), each span written into every cell it covers; rows are as wide as the widest, gaps empty."""
    rows = under(table, {"tr"}, {"table"})
    at: dict[tuple[int, int], tuple[str, bool]] = {}
    for r, tr in enumerate(rows):
        c = 0
        for cell in under(tr, {"td", "th"}, {"table"}):
            while (r, c) in at:
                c += 1
            value, wide, deep = (inline(cell), cell.tag == "th"), span_of(cell, "colspan"), span_of(cell, "rowspan")
            at.update({(r + i, c + j): value for i in range(min(deep, len(rows) - r)) for j in range(wide)})
            c += wide
    width = 1 + max((c for _, c in at), default=-1)
    return [[at.get((r, c), ("", False)) for c in range(width)] for r in range(len(rows))]


def row_texts(cells: list[list[tuple[str, bool]]]) -> list[str | None]:
    """A table's rows as text: `label: value` of two columns, `label — header: value; ...` of more; None for header rows."""
    heads = 0
    while heads < min(3, len(cells)) and cells[heads] and all(h or not t for t, h in cells[heads]) and any(h for _, h in cells[heads]):
        heads += 1
    if heads == 0 and len(cells) > 1 and len(cells[0]) > 2 and not any(re.search(r"[0-9]", t) for t, _ in cells[0]):
        heads = 1
    width = len(cells[0]) if cells else 0
    names = [" / ".join(dict.fromkeys(cells[r][c][0] for r in range(heads) if cells[r][c][0])) for c in range(width)]
    out: list[str | None] = [None] * heads
    for row in cells[heads:]:
        texts = [t for t, _ in row]
        if width == 2:
            out.append(": ".join(t for t in texts if t))
        elif heads and width > 2:
            values = "; ".join(f"{n}: {t}" if n else t for n, t in zip(names[1:], texts[1:], strict=True) if t)
            out.append(f"{texts[0]} — {values}" if texts[0] else values)
        else:
            out.append(" | ".join(t for t in texts if t))
    return out


def is_layout(cells: list[list[tuple[str, bool]]]) -> bool:
    """Tables with over 40 % of long cells, or of one cell, only place things."""
    texts = [t for row in cells for t, _ in row if t]
    return len(texts) < 2 or sum(len(t) > 200 for t in texts) > 0.4 * len(texts)


def _scope(node: Node, inherited: str) -> str:
    """A landmark tag decides; class words only for elements outside the main content that are not the body."""
    if node.tag in SCOPES:
        return SCOPES[node.tag]
    if node.tag in ("body", "html", "root") or inherited == "main":
        return inherited
    words = set(re.split(r"[\s]+", f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower()))
    return next((SCOPE_WORDS[w] for w in sorted(words) if w in SCOPE_WORDS), inherited)


def json_lines(value: object, limit: int = 60) -> list[str]:
    """`key: value` of nested data, five levels and `limit` lines at most."""
    out, todo = [], [("", value, 0)]
    while todo and len(out) < limit:
        key, v, depth = todo.pop(0)
        if isinstance(v, dict) and depth < 5:
            todo = [(k, x, depth + 1) for k, x in v.items() if not k.startswith("@")] + todo
        elif isinstance(v, list) and depth < 5:
            todo = [(key, x, depth + 1) for x in v] + todo
        elif isinstance(v, (str, int, float)) and key:
            out.append(f"{key}: {squeeze(str(v))[:2000]}")
    return out


def block_rows(html: str | None) -> list[dict]:
    """Blocks of a page in order: ord, type, text, scope, level, section, path, table_no, row_no, source."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    out: list[dict] = []
    heads: list[tuple[int, str]] = []
    state = {"section": 0, "table": 0}
    loose: list[str] = []

    def emit(kind: str, text: str, scope: str, level: int | None = None, table: int | None = None, row: int | None = None, source: str = "body") -> None:
        if text:
            out.append({"ord": len(out) + 1, "type": kind, "text": text, "scope": scope, "level": level, "section": state["section"], "path": [t for _, t in heads], "table_no": table, "row_no": row, "source": source})

    def flush(scope: str) -> None:
        text = squeeze("".join(loose))
        loose.clear()
        emit("paragraph", text, scope)

    todo: list[tuple] = [("node", tree.stack[0], "unknown")]
    while todo:
        what, x, scope = todo.pop()
        if what == "end":
            flush(scope)
        elif isinstance(x, str):
            loose.append(x)
        elif x.tag == "title":
            emit("title", inline(x), "metadata", source="head")
        elif x.tag == "meta":
            name = x.attrs.get("property") or x.attrs.get("name", "")
            if name in ("description", "og:title", "og:description") and x.attrs.get("content"):
                emit("metadata", f"{name}: {squeeze(x.attrs['content'])}", "metadata", source="meta")
        elif x.tag == "script" and "ld+json" in x.attrs.get("type", ""):
            try:
                data = json.loads("".join(k for k in x.kids if isinstance(k, str)))
            except (ValueError, RecursionError):
                continue
            for line in json_lines(data):
                emit("metadata", line, "metadata", source="jsonld")
        elif x.tag in HIDDEN - {"head"}:
            continue
        elif x.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            flush(scope)
            text, level = inline(x), int(x.tag[1])
            if text:
                while heads and heads[-1][0] >= level:
                    heads.pop()
                heads.append((level, text))
                state["section"] += 1
                emit("heading", text, scope, level)
        elif x.tag == "table" and not is_layout(cells := grid(x)):
            flush(scope)
            state["table"] += 1
            for r, text in enumerate(row_texts(cells)):
                emit("table_header" if text is None else "table_row", " | ".join(t for t, _ in cells[r] if t) if text is None else text, scope, table=state["table"], row=r)
        elif x.tag == "dl":
            flush(scope)
            term = None
            for item in under(x, {"dt", "dd"}, {"dl"}):
                if item.tag == "dt":
                    if term:
                        emit("paragraph", term, scope)
                    term = inline(item)
                else:
                    emit("key_value" if term else "paragraph", f"{term}: {inline(item)}" if term else inline(item), scope)
                    term = None
            if term:
                emit("paragraph", term, scope)
        elif x.tag == "li" and not under(x, {"ul", "ol", "table"}, set()):
            flush(scope)
            emit("list_item", inline(x), scope)
        elif x.tag == "div" and len(pair := [k for k in x.kids if isinstance(k, Node)]) == 2 and not under(x, BLOCK - {"div"}, set()) and [k.attrs.get("class", "") for k in pair] == ["label", "value"]:
            flush(scope)
            emit("key_value", f"{inline(pair[0])}: {inline(pair[1])}", scope)
        elif "data-count" in x.attrs:
            loose.append(inline(x))
        elif x.tag in BLOCK or x.tag in ("html", "body", "head", "root"):
            flush(scope)
            own = _scope(x, scope)
            todo.append(("end", None, own))
            todo.extend(("node", k, own) for k in reversed(x.kids))
        else:
            todo.extend(("node", k, scope) for k in reversed(x.kids))
    return out


def blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, ord, type, text, scope, level, section, path, table_no, row_no, source); a null or empty page has none.

    `section` counts the headings so far, `path` is the headings that hold the block, outermost first.
    """
    kind = pages.schema[key].dataType.simpleString()
    types = {"ord": pa.int32(), "type": pa.string(), "text": pa.string(), "scope": pa.string(), "level": pa.int32(), "section": pa.int32(), "path": pa.list_(pa.string()), "table_no": pa.int32(), "row_no": pa.int32(), "source": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = block_rows(page)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(rows), batch.schema.field(0).type), *[pa.array([r[c] for r in rows], t) for c, t in types.items()]], names=[key, *types])

    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, ord int, type string, text string, scope string, level int, section int, path array<string>, table_no int, row_no int, source string")
