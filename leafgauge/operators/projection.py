"""Markdown sections as facts: what each pass finds, with its page, and the words that are left.

A pass is a pattern, the facts its matches give, and the text that stands in their place for the passes after it. The
order matters: tables first, then comments, footnotes, images, directives, chips, links, emphasis, headings, items and
blocks, and the escapes last. Built-ins can't rewrite a text and gather what they rewrote in one pass over it, so whole
sections go through one Arrow-batched function, row by row, with nothing held but one section.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import shipped

# The patterns of the Markdown dialect, by kind.
HEADER = re.compile(r"<!--\s*source: source\.pdf pages (\d+)-(\d+)\s*-->")
MARKER = re.compile(r"<!--\s*p\.(\d+)\s*-->")
TABLE = re.compile(r"<table.*?</table>", re.S)
SUP = re.compile(r"<sup>(.*?)</sup>", re.S)
TAG = re.compile(r"</?[a-zA-Z][^>]*>")
SKIPPED = re.compile(r"<!--\s*figure (p(\d+)-\d+\.png) skipped: ([^>]*?)\s*-->")
COMMENT = re.compile(r"<!--.*?-->", re.S)
PIPE_RULE = re.compile(r"^\|[-| :]+\|$", re.M)
NOTE = re.compile(r"^\[\^(\d+)\]:[ \t]*(.*(?:\n[ ]{4}.*)*)", re.M)
IMAGE = re.compile(r"!\[[^\]]*\]\([^)]+\)")
DIRECTIVE = re.compile(r"^:{3,}(\w*)(\{[^}]*\})?\s*$", re.M)
LABEL = re.compile(r'label="([^"]*)"')
CHIP = re.compile(r":chip\[([^\]]+)\]")
LINK = re.compile(r"\[([^\]]*)\]\(([^)]+)\)")
AUTOLINK = re.compile(r"<(https?://[^>\s]+)>")
NOTE_REF = re.compile(r"\[\^(\d+)\]")
BOLD = re.compile(r"\*\*([^*\n]+)\*\*|__([^_\n]+(?:_[^_\n]+)*?)__")
B_TAG = re.compile(r"<b>(.*?)</b>", re.S)
ITALIC = re.compile(r"(?<!\*)\*([^*\n]+)\*(?!\*)")
TICK = re.compile(r"(?<!`)`(?!`)")
HEADING = re.compile(r"^#{1,6}\s+(.*)$", re.M)
QUOTE = re.compile(r"^>\s?", re.M)
ITEM = re.compile(r"^[ \t]*[-*+][ \t]+(.*)$", re.M)
NUMBERED = re.compile(r"^\d{1,2}\.\s+(\S.*)$", re.M)
BLOCK = re.compile(r"(?:^|\n\n)[ \t]*([^\s#:>|!\[<‌-][^\n]{0,79})")
FENCE = re.compile(r"^```.*$", re.M)
ESCAPE = re.compile(r"\\([*_\[\]()#`~.!|])")
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ft", "ﬆ": "st"}
INVISIBLE = "­​‌‍⁠﻿"
FOLDS = tuple(zip("‘’“”‑\xa0", "''\"\"- ", strict=True))
BULLETS = "●•◦▪‣○"

#: A page mark inside a text: its number between two private characters.
OPEN, CLOSE = "\ue000", "\ue001"
MARK = re.compile(f"{OPEN}(\\d+){CLOSE}")
#: An item's line, once taken, begins with this, so that no block starts there.
TAKEN = "\u200c"
#: Literal characters of a dialect that later passes would take for marks, and what stands for them meanwhile.
HIDDEN = (("\\*", "\x03", "*"), ("\\`", "\x04", "`"), ("\\<", "\x05", "<"))
#: Characters of an item or block that are kept.
LEAD = 80


def plain(text: str) -> str:
    """text without page marks, trimmed."""
    return MARK.sub(" ", text).strip()


@dataclass(slots=True)
class Fact:
    kind: str
    page: int
    text: str
    target: str | None = None


class Section:
    """One section on its way through the passes."""

    def __init__(self, text: str):
        head = HEADER.search(text)
        self.first = int(head[1]) if head else 0
        self.facts: list[Fact] = []
        self.text = MARKER.sub(self._marked, text)

    def _marked(self, m: re.Match) -> str:
        self.facts.append(Fact("marker", int(m[1]), m[1]))
        return f" {OPEN}{m[1]}{CLOSE} "

    def replace(self, pattern: re.Pattern, by: str | Callable, *kinds: Callable) -> None:
        """Each match gives the facts that kinds make of it and its page; by (a string or a function of the match) takes its place."""
        if not kinds:
            self.text = pattern.sub(by if callable(by) else lambda _: by, self.text)
            return
        marks = [(m.end(), int(m[1])) for m in MARK.finditer(self.text)]
        ends = [e for e, _ in marks]

        def one(m: re.Match) -> str:
            k = bisect_right(ends, m.start())
            page = marks[k - 1][1] if k else self.first
            for kind in kinds:
                self.facts.extend(kind(m, page))
            return by(m) if callable(by) else by

        self.text = pattern.sub(one, self.text)


def _tables(m: re.Match, page: int) -> Iterator[Fact]:
    for p in {page, *(int(x) for x in MARK.findall(m[0]))}:
        yield Fact("table_page", p, str(p))
    for cell in SUP.findall(m[0]):
        yield from (Fact("fn_ref", page, d) for d in re.findall(r"\d+", MARK.sub(" ", cell)))


def _cells(m: re.Match) -> str:
    return TAG.sub(" ", SUP.sub(" ", m[0]))


def _note(m: re.Match, page: int) -> Iterator[Fact]:
    yield from (Fact("link", page, plain(x[1]), x[2]) for x in LINK.finditer(m[2]))
    yield from (Fact("link", page, x, x) for x in AUTOLINK.findall(m[2]))
    body = AUTOLINK.sub(r"\1", LINK.sub(r"\1", m[2]))
    yield Fact("fn_def", page, plain(re.sub(r"(?m)^\s*[-*+][ \t]+", " ", body)), m[1])


def _label(m: re.Match) -> re.Match | None:
    return LABEL.search(m[2] or "")


def _item(group: int) -> Callable:
    def facts(m: re.Match, page: int) -> Iterator[Fact]:
        lead = MARK.match(m[1].strip())  # an item that begins with a page mark is that page's
        yield Fact("item", int(lead[1]) if lead else page, m[group][:LEAD])

    return facts


def _of(kind: str, group: int = 1, target: int | None = None) -> Callable:
    return lambda m, page: [Fact(kind, page, plain(m[group] or ""), m[target] if target else None)]


def _passes() -> list[tuple]:
    """(pattern, what takes a match's place, facts of a match...), in order."""
    bold = lambda m: m[1] or m[2]
    return [
        (TABLE, _cells, _tables),
        (SKIPPED, " ", lambda m, page: [Fact("fig_skip", int(m[2]), m[1], m[3])]),
        (re.compile(r"</?u>"), ""),
        (re.compile(r"\\\n"), " "),
        *((re.compile(re.escape(a)), b) for a, b, _ in HIDDEN),
        (COMMENT, " "),
        (PIPE_RULE, " ", lambda m, page: [Fact("table_page", page, str(page))]),
        (re.compile(r"\|"), " "),
        (NOTE, " ", _note),
        (IMAGE, " ", lambda m, page: [Fact("image", page, m[0])]),
        (DIRECTIVE, lambda m: f"{x[1]}:" if (x := _label(m)) else " ", lambda m, page: [Fact("turn_label", page, plain(x[1]))] if (x := _label(m)) else []),
        (CHIP, lambda m: m[1], _of("chip")),
        (re.compile(r"</?span[^>]*>"), ""),
        (LINK, lambda m: m[1], _of("link", 1, 2)),
        (AUTOLINK, lambda m: m[1], _of("link", 1, 1)),
        (NOTE_REF, " ", _of("fn_ref")),
        (BOLD, bold, lambda m, page: [Fact("bold", page, plain(bold(m)))]),
        (B_TAG, lambda m: m[1], _of("bold")),
        (re.compile(r"</?pre>"), " "),
        (SUP, " "),
        (ITALIC, lambda m: m[1]),
        (TICK, ""),
        *((re.compile(b), c) for _, b, c in HIDDEN),
        (HEADING, lambda m: m[1], _of("heading")),
        (QUOTE, ""),
        (ITEM, lambda m: TAKEN + m[1], _item(1)),
        (NUMBERED, lambda m: TAKEN + m[0], _item(0)),
    ]


PASSES = _passes()


def normal(text: str) -> str:
    """Composed, ligatures spelt out, invisible characters dropped, wraps after a hyphen closed, quotes and blanks plain."""
    import unicodedata

    text = unicodedata.normalize("NFC", text)
    # Few characters and long texts: a replacement each is many times as fast as a translation table.
    for a, b in (*LIGATURES.items(), *((c, "") for c in INVISIBLE)):
        text = text.replace(a, b)
    text = re.sub(r"(\w)-\s+(?=[a-z])", r"\1-", text)
    for a, b in FOLDS:
        text = text.replace(a, b)
    return text


def project(text: str) -> list[Fact]:
    """All facts of a section, those of one kind in order; kind token: the words that are left."""
    s = Section(text)
    for pattern, by, *kinds in PASSES:
        s.replace(pattern, by, *kinds)
    marks = [(m.end(), int(m[1])) for m in MARK.finditer(s.text)]
    ends = [e for e, _ in marks]
    for m in BLOCK.finditer(s.text):
        k = bisect_right(ends, m.start())
        s.facts.append(Fact("block", marks[k - 1][1] if k else s.first, m[1][:LEAD]))
    left = html.unescape(TAG.sub(" ", FENCE.sub(" ", s.text).replace("`", "")))
    page = s.first
    for word in normal(ESCAPE.sub(r"\1", left)).split():
        if m := MARK.fullmatch(word):
            page = int(m[1])
        elif word := word.lstrip(BULLETS):
            s.facts.append(Fact("token", page, word))
    return s.facts


#: Facts that are handed on at once.
FACTS = 5000


def project_all(sections: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id_col, ord, kind, page, text, target) of every section's facts; a null text has none."""

    def work(batches):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())

        def made(columns):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [id_col, "ord", "kind", "page", "text", "target"])

        columns = [[] for _ in kinds]
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                facts = project(t) if (t := text.as_py()) is not None else []
                rows = ([i.as_py()] * len(facts), range(len(facts)), *([getattr(f, c) for f in facts] for c in ("kind", "page", "text", "target")))
                for c, more in zip(columns, rows, strict=True):
                    c.extend(more)
                if len(columns[0]) >= FACTS:
                    yield made(columns)
                    columns = [[] for _ in kinds]
        yield made(columns)

    rows = sections.select(F.col(id_col).cast("bigint").alias(id_col), text_col)
    return shipped(rows).mapInArrow(work, f"{id_col} bigint, ord bigint, kind string, page bigint, text string, target string")
