"""Markup removal: wikitext, document trees, and readers that make such trees from Markdown and wikitext.

The column functions at the end are Arrow-batched: one crossing between JVM and Python for a whole chain of steps.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BREAK = "\x07"
RESULT = "content string, error string"
STRUCT = pa.struct([("content", pa.string()), ("error", pa.string())])
#: Characters of results that are held as Python's before they go to Arrow.
AT_ONCE = 1 << 20

# --- wikitext before parsing -------------------------------------------------------------------------------------------

#: What a page is made of. A tag begins with b, r, / or a table sign; before anything else an opening sign stands for
#: itself. Opening signs within a tag that could begin one belong to it, at any other one it is given up.
_PAGE = re.compile(
    r"<(?=[br/|{}<>])(?P<tag>(?>[^<>]+|<(?=[br/|{}<>]))*+)>"
    r"|(?P<odd><[^br/|{}<>])"
    r"|<(?>[^<>]+|<(?=[br/|{}<>]))*+(?=<)"
    r"|(?P<open><.*)"
    r"|(?P<signs>[|{}]+)"
    r"|(?P<text>[^<|{}]+)",
    re.S,
)
_SIGNS = re.compile(r"[|{}]+")
_KINDS = re.compile(r"\|+|\{+|\}+")


class _Shown:
    """What is left of a page. Notes and tables hide what is added while they last."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.hidden = False

    def add(self, text: str, always: bool = False) -> None:
        if text and (always or not self.hidden):
            self.parts.append(text)

    def second_of_a_line(self) -> bool:
        """Whether at most one character stands on the last line."""
        end = "".join(self.parts[-2:])[-2:]
        return len(end) < 2 or end[0] == "\n"

    def without_last(self, sign: str) -> None:
        if self.parts and self.parts[-1].endswith(sign):
            rest = self.parts.pop()[:-1]
            self.add(rest, True)

    def signs(self, run: str) -> None:
        """Equal signs are text. Where one kind follows another, what is hidden ends, or a table begins on a new line."""
        kinds = _KINDS.findall(run)
        self.add(kinds[0])
        for last, now in zip(kinds, kinds[1:]):
            if self.hidden:
                self.hidden = False
                self.add(now[1:])
            elif self.second_of_a_line():
                self.without_last(last[0])
                self.hidden = True
            else:
                self.add(now)

    def tag(self, body: str, strict: bool) -> None:
        for run in _SIGNS.findall(body):
            self.signs(run)
        name = re.sub(r"[|{}<]+", "", body)
        single = name.startswith("references") or name.startswith("ref") and name.endswith("/")
        if name.startswith(("ref", "/ref")):
            if not (strict and single):
                self.hidden = name[0] != "/"
        elif not name.startswith(("blockquote", "/blockquote")):
            self.add(f"<{name}>", not strict)


def strip_wikitext(text: str, strict: bool = False) -> tuple[str | None, str | None]:
    """(content, error): text without reference notes, quotation tags and tables that begin a line.

    exact: a tag that begins with `ref` starts a note, whatever its end, and a note ends at `/ref` only; other tags stay,
    even inside notes; two different table signs in a row open or close a table. strict: self-closing notes and
    `references` lists are single tags, and tags inside notes go. A tag that is never closed is an error.
    """
    out = _Shown()
    for m in _PAGE.finditer(text):
        kind = m.lastgroup
        if kind == "text":
            out.add(m["text"])
        elif kind == "signs":
            out.signs(m["signs"])
        elif kind == "tag":
            out.tag(m["tag"], strict)
        elif kind == "odd":
            out.add(m["odd"], not strict)
        elif kind == "open":
            return None, f"text after opening <: {re.sub(r'[|{}<]+', '', m['open'])}"
    return "".join(out.parts), None


# --- document trees ----------------------------------------------------------------------------------------------------

#: Signs among the nodes that are still to be read.
_GAP, _END, _LABEL, _CAPTION = (object() for _ in range(4))
CAPTION_WORDS = 3


class Rule(NamedTuple):
    """Where a node has its text: all of its content, or one part of so many. What is to be done after it."""

    part: int | None = None
    size: int = 0
    after: object = None


#: How the kinds of nodes are read.
SPACES = {"Space", "LineBreak", "SoftBreak"}
SILENT = {"CodeBlock", "RawBlock", "HorizontalRule", "Table", "Superscript", "Subscript", "Cite", "Code", "Math", "RawInline", "Null", "DoubleQuote", "LineBlock"}
RULES = {
    **dict.fromkeys(("Str", "Emph", "Strong", "Strikeout", "SmallCaps", "Note"), Rule()),
    **dict.fromkeys(("Para", "Plain", "BlockQuote", "BulletList", "DefinitionList", "Quoted"), Rule(after=_END)),
    "Header": Rule(2, 3, _END),
    "OrderedList": Rule(1, 2, _END),
    "Div": Rule(1, 2, _END),
    "Span": Rule(1, 2),
    "Link": Rule(1, 3, _LABEL),
    "Image": Rule(1, 3, _CAPTION),
}


class BadTree(ValueError):
    pass


class _Text:
    def __init__(self, strict: bool = False) -> None:
        self.parts: list[str] = []
        self.tail = ""
        self.strict = strict

    def add(self, text: str) -> None:
        if text:
            self.parts.append(text)
            self.tail = (self.tail + text[-2:])[-2:]

    def space(self) -> None:
        if self.tail and not self.tail[-1].isspace():
            self.add(" ")

    def end_context(self) -> None:
        # exact: a text of one character has no end yet; strict: it has
        if len(self.tail) == 2 and self.tail[0] != BREAK or self.strict and len(self.tail) == 1 and not self.tail.isspace():
            self.add(f" {BREAK} ")

    def __str__(self) -> str:
        return "".join(self.parts)


def _read(tree, strict: bool = False) -> str:
    """The text of a tree, without recursion: nodes that are still to be read wait on a stack, texts of links and images
    are gathered apart."""
    texts = [_Text(strict)]
    todo = [tree]
    while todo:
        node = todo.pop()
        out = texts[-1]
        if isinstance(node, dict):
            kind = node.get("t")
            if kind in SPACES:
                out.space()
            elif kind not in SILENT:
                rule = RULES.get(kind)
                if rule is None:
                    raise BadTree(f"unknown node type: {kind}")
                content = node.get("c")
                if rule.part is not None:
                    if not isinstance(content, list) or len(content) != rule.size:
                        raise BadTree(f"{kind}: expected an array of {rule.size}")
                    content = content[rule.part]
                if rule.after is not None:
                    todo.append(rule.after)
                    if rule.after is not _END:
                        texts.append(_Text(strict))
                todo.append(content)
        elif isinstance(node, list):
            for k in range(len(node) - 1, -1, -1):
                todo.append(node[k])
                if k:
                    todo.append(_GAP)
        elif node is _GAP:
            out.space()
        elif node is _END:
            out.end_context()
        elif node is _LABEL or node is _CAPTION:
            inner = str(texts.pop())
            if node is _LABEL or len(inner.split()) >= CAPTION_WORDS:
                texts[-1].add(inner)
        elif isinstance(node, str):
            out.add(node)
        elif isinstance(node, (bool, int, float)):
            out.add(json.dumps(node) if isinstance(node, bool) else f"{node:g}" if isinstance(node, float) else str(node))
    return str(texts[0])


def tree_text(tree: str, strict: bool = False) -> tuple[str | None, str | None]:
    """(content, error) of a document tree in JSON, an object with `blocks`; contexts end with a break sign."""
    try:
        data = json.loads(tree)
    except ValueError as e:
        return None, f"JsonError: {e}"
    except RecursionError:
        return None, "ErroneousStructure: nested too deeply"
    return blocks_text(data, strict)


def blocks_text(data, strict: bool = False) -> tuple[str | None, str | None]:
    if not isinstance(data, dict) or "blocks" not in data:
        return None, "ErroneousStructure: expected an object with blocks"
    try:
        return _read(_without_single_quotes(data["blocks"]) if strict else data["blocks"], strict), None
    except BadTree as e:
        return None, f"ErroneousStructure: {e}"
    except RecursionError:
        return None, "ErroneousStructure: nested too deeply"


def _without_single_quotes(node):
    if isinstance(node, list):
        return [_without_single_quotes(x) for x in node if not (isinstance(x, dict) and x.get("t") == "SingleQuote")]
    if isinstance(node, dict):
        return {k: _without_single_quotes(v) for k, v in node.items()}
    return node


# --- readers -----------------------------------------------------------------------------------------------------------


def _strings(text: str) -> list[dict]:
    """A text as one string with single spaces, and what white space stands at its ends."""
    words = text.split()
    out: list[dict] = [{"t": "Str", "c": " ".join(words)}] if words else []
    if text[:1].isspace():
        out.insert(0, {"t": "Space"})
    if words and text[-1:].isspace():
        out.append({"t": "Space"})
    return out


_ATTR = ["", [], []]
#: Signs that begin a span; other characters are told by this alone.
_BEGINS = re.compile(r"[`!\[<*_~\\]")
_INLINE = re.compile(
    r"(?=[`!\[<*_~\\])(?:"
    r"(?P<code>(?P<tick>`+)(?P<codetext>.+?)(?P=tick)(?!`))|(?P<image>!\[(?P<alt>[^\]]*)\]\([^)\s]*(?:\s+\"[^\"]*\")?\))|(?P<link>\[(?P<label>[^\]]*)\]\([^)\s]*(?:\s+\"[^\"]*\")?\))"
    r"|(?P<auto><https?://[^>\s]+>)|(?P<html></?[A-Za-z][^>]*>)|(?P<strong>(?P<s>\*\*|__)(?=\S)(?P<strongtext>.+?)(?<=\S)(?P=s))|(?P<strike>~~(?P<striketext>.+?)~~)"
    r"|(?P<emph>(?P<e>[*_])(?=\S)(?P<emphtext>[^*_]+?)(?<=\S)(?P=e))|(?P<esc>\\[!-/:-@\[-`{-~]))",
    re.S,
)


def _inline(text: str) -> list[dict]:
    if not _BEGINS.search(text):
        return _strings(text)
    out: list[dict] = []
    literal = ""
    done = 0

    def flush() -> None:
        nonlocal literal
        out.extend(_strings(literal))
        literal = ""

    for m in _INLINE.finditer(text):
        literal += text[done : m.start()]
        done = m.end()
        if m["esc"]:
            literal += m["esc"][1]
            continue
        flush()
        if m["code"]:
            out.append({"t": "Code", "c": [_ATTR, m["codetext"].strip()]})
        elif m["image"]:
            out.append({"t": "Image", "c": [_ATTR, _strings(m["alt"]), ["", ""]]})
        elif m["link"]:
            out.append({"t": "Link", "c": [_ATTR, _inline(m["label"]), ["", ""]]})
        elif m["auto"]:
            out.append({"t": "Link", "c": [_ATTR, _strings(m["auto"][1:-1]), ["", ""]]})
        elif m["html"]:
            out.append({"t": "RawInline", "c": ["html", m["html"]]})
        elif m["strong"]:
            out.append({"t": "Strong", "c": _inline(m["strongtext"])})
        elif m["strike"]:
            out.append({"t": "Strikeout", "c": _inline(m["striketext"])})
        else:
            out.append({"t": "Emph", "c": _inline(m["emphtext"])})
    literal += text[done:]
    flush()
    return out


_ITEM = re.compile(r"^ {0,3}(?:(?P<bullet>[-+*])|(?P<number>\d{1,9})[.)])(?:[ \t]+|$)")
_FENCE = re.compile(r"^ {0,3}(`{3,}|~{3,})")
_RULE = re.compile(r"^ {0,3}([-*_])[ \t]*(?:\1[ \t]*){2,}$")
_HEAD = re.compile(r"^ {0,3}(#{1,6})(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$")


def read_markdown(text: str) -> dict:
    """The document tree of a useful part of Markdown: headings, paragraphs, lists, quotes, code, rules, tables, emphasis, links and images."""
    return {"blocks": _markdown(text.replace("\t", "    ").split("\n"))}


def _markdown(lines: list[str]) -> list[dict]:
    out: list[dict] = []
    para: list[str] = []
    i = 0

    def close() -> None:
        if para:
            out.append({"t": "Para", "c": _inline("\n".join(x.strip() for x in para))})
            para.clear()

    while i < len(lines):
        line = lines[i]
        if not line.strip():
            close()
        elif fence := _FENCE.match(line):
            close()
            end = next((j for j in range(i + 1, len(lines)) if lines[j].strip().startswith(fence[1]) and not lines[j].strip().strip(fence[1][0])), len(lines))
            out.append({"t": "CodeBlock", "c": [_ATTR, "\n".join(lines[i + 1 : end])]})
            i = end
        elif line.startswith("    ") and not para:
            start = i
            while i + 1 < len(lines) and (lines[i + 1].startswith("    ") or not lines[i + 1].strip()):
                i += 1
            out.append({"t": "CodeBlock", "c": [_ATTR, "\n".join(x[4:] for x in lines[start : i + 1]).rstrip()]})
        elif head := _HEAD.match(line):
            close()
            out.append({"t": "Header", "c": [len(head[1]), _ATTR, _inline(head[2] or "")]})
        elif para and re.match(r"^ {0,3}(=+|-+)\s*$", line):
            text = "\n".join(x.strip() for x in para)
            para.clear()
            out.append({"t": "Header", "c": [1 if "=" in line else 2, _ATTR, _inline(text)]})
        elif _RULE.match(line):
            close()
            out.append({"t": "HorizontalRule"})
        elif "|" in line and i + 1 < len(lines) and re.match(r"^\s*\|?\s*:?-+:?\s*(\|\s*:?-+:?\s*)+\|?\s*$", lines[i + 1]):
            close()
            i += 1
            while i + 1 < len(lines) and "|" in lines[i + 1]:
                i += 1
            out.append({"t": "Table", "c": []})
        elif re.match(r"^ {0,3}>", line):
            close()
            quote = []
            while i < len(lines) and lines[i].strip():
                quote.append(re.sub(r"^ {0,3}> ?", "", lines[i]))
                i += 1
            out.append({"t": "BlockQuote", "c": _markdown(quote)})
        elif _ITEM.match(line) and (not para or _ITEM.match(line)["bullet"]):
            close()
            i = _list(lines, i, out) - 1
        else:
            para.append(line)
        i += 1
    close()
    return out


def _list(lines: list[str], i: int, out: list[dict]) -> int:
    """Reads the list that begins at line i; the line after it."""
    first = _ITEM.match(lines[i])
    numbered = bool(first["number"])
    items: list[list[str]] = []
    loose = False
    indent = 0
    while i < len(lines):
        line = lines[i]
        m = _ITEM.match(line)
        if m and bool(m["number"]) == numbered and not _RULE.match(line):
            indent = m.end()
            items.append([line[indent:]])
        elif not line.strip():
            after = next((x for x in lines[i + 1 :] if x.strip()), "")
            if not (after.startswith(" " * min(indent, 2)) or _ITEM.match(after)):
                break
            loose = True
            items[-1].append("")
        elif line.startswith(" " * min(indent, 2)):
            items[-1].append(line[min(indent, len(line) - len(line.lstrip())) :])
        elif items[-1][-1].strip() and not _HEAD.match(line) and not _FENCE.match(line) and not m:
            items[-1].append(line)
        else:
            break
        i += 1
    bodies = [_markdown(x) for x in items]
    if not loose:
        bodies = [[{**b, "t": "Plain"} if b["t"] == "Para" else b for b in body] for body in bodies]
    out.append({"t": "OrderedList", "c": [[1, {"t": "Decimal"}, {"t": "Period"}], bodies]} if numbered else {"t": "BulletList", "c": bodies})
    return i


_WIKI = re.compile(
    r"(?P<bold>'''(?P<boldtext>.+?)''')|(?P<italic>''(?P<italictext>.+?)'')|\[\[(?P<target>[^\[\]|]*)(?:\|(?P<shown>[^\[\]]*))?\]\]|\[(?P<url>https?://[^\s\]]+)(?:\s+(?P<urltext>[^\]]*))?\]"
    r"|(?P<nowiki><nowiki>(?P<raw>.*?)</nowiki>)|(?P<mathcode><(?:math|code|pre|syntaxhighlight|source)\b[^>]*>.*?</(?:math|code|pre|syntaxhighlight|source)>)|(?P<html><!--.*?-->|</?[A-Za-z][^>]*>)",
    re.S,
)
_MEDIA = re.compile(r"^(?:File|Image|Datei|Bild|Fichier|Archivo|Imagen)\s*:", re.I)
_CATEGORY = re.compile(r"^(?:Category|Kategorie|Catégorie|Categoría)\s*:", re.I)


def _without_templates(text: str) -> str:
    out: list[str] = []
    depth = done = 0
    for m in re.finditer(r"\{\{|\}\}", text):
        if m[0] == "{{":
            if depth == 0:
                out.append(text[done : m.start()])
                done = m.start()
            depth += 1
        elif depth:
            depth -= 1
            if depth == 0:
                done = m.end()
    out.append(text[done:])
    return "".join(out)


def _wiki_inline(text: str) -> list[dict]:
    out: list[dict] = []
    done = 0
    for m in _WIKI.finditer(text):
        out += _strings(text[done : m.start()])
        done = m.end()
        if m["bold"]:
            out.append({"t": "Strong", "c": _wiki_inline(m["boldtext"])})
        elif m["italic"]:
            out.append({"t": "Emph", "c": _wiki_inline(m["italictext"])})
        elif m["target"] is not None:
            target, shown = m["target"].strip(), m["shown"]
            if _MEDIA.match(target):
                caption = (shown or "").split("|")[-1]
                out.append({"t": "Image", "c": [_ATTR, _wiki_inline(caption), ["", ""]]})
            elif not _CATEGORY.match(target):
                out.append({"t": "Link", "c": [_ATTR, _wiki_inline(shown if shown else target.lstrip(":")), ["", ""]]})
        elif m["url"]:
            if m["urltext"]:
                out.append({"t": "Link", "c": [_ATTR, _wiki_inline(m["urltext"]), ["", ""]]})
        elif m["nowiki"]:
            out += _strings(m["raw"])
        elif m["mathcode"]:
            out.append({"t": "Code", "c": [_ATTR, ""]})
        else:
            out.append({"t": "RawInline", "c": ["html", m[0]]})
    return out + _strings(text[done:])


def read_wikitext(text: str) -> dict:
    """The document tree of a useful part of wikitext: headings, paragraphs, lists, rules, tables, emphasis and links; templates go."""
    out: list[dict] = []
    para: list[str] = []
    lines = _without_templates(text).split("\n")
    i = 0

    def close() -> None:
        if para:
            out.append({"t": "Para", "c": _wiki_inline("\n".join(para))})
            para.clear()

    while i < len(lines):
        line = lines[i]
        if not line.strip():
            close()
        elif m := re.match(r"^(={1,6})\s*(.+?)\s*\1\s*$", line):
            close()
            out.append({"t": "Header", "c": [len(m[1]), _ATTR, _wiki_inline(m[2])]})
        elif line.startswith("{|"):
            close()
            depth = 0
            while i < len(lines):
                depth += lines[i].startswith("{|") - lines[i].startswith("|}")
                if not depth:
                    break
                i += 1
            out.append({"t": "Table", "c": []})
        elif line.startswith("----"):
            close()
            out.append({"t": "HorizontalRule"})
        elif line[0] in "*#:;":
            close()
            sign = line[0]
            items = []
            while i < len(lines) and lines[i].startswith(sign):
                items.append([{"t": "Plain", "c": _wiki_inline(lines[i].lstrip("*#:; "))}])
                i += 1
            out.append({"t": "OrderedList", "c": [[1, {"t": "Decimal"}, {"t": "Period"}], items]} if sign == "#" else {"t": "BulletList", "c": items})
            continue
        else:
            para.append(line)
        i += 1
    close()
    return {"blocks": out}


READERS = {"markdown": read_markdown, "mediawiki": read_wikitext}


def unformat(text: str, markup: str, strict: bool) -> tuple[str | None, str | None]:
    """(content, error): plain text with break signs of a marked-up text, all steps in one go."""
    if markup == "mediawiki":
        cleaned, error = strip_wikitext(text, strict)
        if error:
            return None, f"ErroneousStructure: {error}"
        text = cleaned or ""
    try:
        tree = READERS[markup](text)
    except RecursionError:
        return None, "ErroneousStructure: nested too deeply"
    return blocks_text(tree, strict)


# --- column functions --------------------------------------------------------------------------------------------------


def _pieces(texts: pa.Array, run: Callable[[str], tuple[str | None, str | None]]) -> Iterator[pa.Array]:
    """The results of a batch of texts, in pieces. One text at a time becomes Python's, and what is made of some 1 MB of
    texts goes back to Arrow at once."""
    rows: list[dict | None] = []
    held = 0
    for x in texts:
        text = x.as_py()
        content, error = (None, None) if text is None else run(text)
        rows.append({"content": content, "error": error})
        held += len(content or "") + len(error or "")
        if held >= AT_ONCE:
            yield pa.array(rows, STRUCT)
            rows, held = [], 0
    if rows:
        yield pa.array(rows, STRUCT)


def _results(texts: pa.Array, run: Callable[[str], tuple[str | None, str | None]]) -> pa.Array:
    """All results of a batch of texts in one array."""
    return pa.concat_arrays([pa.array([], STRUCT), *_pieces(texts, run)])


def _mapped(text: Column, run: Callable[[str], tuple[str | None, str | None]]) -> Column:
    """struct<content, error> of a function of texts. Pieces leave the worker as they are made, so it holds the batch it
    reads and a piece of results, however much these are in all."""

    @F.arrow_udf(RESULT)
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield from _pieces(texts, run)
            del texts  # before the next batch is read

    return once(each)(text)


def once(run):
    """A function that the optimizer neither copies into other expressions nor runs again in a filter."""
    return run.asNondeterministic()


def wikitext(text: Column, strict: bool = False) -> Column:
    """struct<content, error> of strip_wikitext."""
    return _mapped(text, lambda t: strip_wikitext(t, strict))


def plain_text(tree: Column, strict: bool = False) -> Column:
    """struct<content, error> of tree_text."""
    return _mapped(tree, lambda t: tree_text(t, strict))


def unformatted(text: Column, markup: str, strict: bool = False) -> Column:
    """struct<content, error> of unformat."""
    return _mapped(text, lambda t: unformat(t, markup, strict))
