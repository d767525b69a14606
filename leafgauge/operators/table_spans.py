"""Repairs of tables that need the page: cells beside the spans that lie in the table's box.

A table is rows of cells (tag, attrs, html) and the spans of its box. What a cell says is compared without blanks; a wrapped
cell is a stack of spans under each other. Each repair only deals text out anew that the page shows so; what it can't
match it leaves alone. Built-ins can't carry the state of matching, so a table at a time goes through one Arrow-batched
function; tables are small and independent of each other.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import shipped
from .tables import ROWS

SPAN = "struct<text:string,x0:double,y0:double,x1:double,y1:double,bold:boolean,zone:string>"
#: How far a row's middles may lie apart, a stack's lines and edges, and lines of one paragraph; spans of a stack at most.
BAND, STACK_GAP, STACK_EDGE, PARAGRAPH_GAP, STACK = 7.0, 9.0, 2.0, 9.0, 6
#: Letters of a cell that may be split to paragraphs, or have a bold lead, at least.
LONG, LEAD = 120, 8
# Quotes and dashes that compare as plain ones.
FOLDS = str.maketrans("‘’“”\"–—", "'''''--")
HIDDEN = dict.fromkeys(map(ord, "​‌‍﻿­"))


def key(text: str) -> str:
    text = "".join(text.split())
    return text.replace('"', "'") if text.isascii() else text.translate(FOLDS)


def said(html: str) -> str:
    return entities.unescape(re.sub(r"<[^>]+>", "", html))


@dataclass
class Cell:
    tag: str
    attrs: str
    html: str

    @cached_property
    def key(self) -> str:
        return key(said(self.html) if "<" in self.html or "&" in self.html else self.html)

    def of(self, text: str) -> Cell:
        return self.saying(entities.escape(text.strip(), quote=False))

    def saying(self, html: str) -> Cell:
        return Cell(self.tag, self.attrs, html)


@dataclass
class Span:
    text: str
    x0: float
    y0: float
    x1: float
    y1: float
    bold: bool
    zone: str

    @cached_property
    def middle(self) -> float:
        return (self.y0 + self.y1) / 2

    @cached_property
    def key(self) -> str:
        return key(self.text)


def joined(texts) -> str:
    """Wrapped lines as one: a blank between them, but for a number after a full stop or hyphen."""
    out = ""
    for t in (t.strip() for t in texts):
        if t:
            out += ("" if not out or (out[-1] in ".-" and t[0].isdigit()) else " ") + t
    return out


def by_length(texts) -> list[int]:
    return sorted({len(t) for t in texts})


def begins(text: str, lengths: list[int]):
    """The beginnings of text of those lengths."""
    return (text[:n] for n in lengths if n <= len(text))


def places(text: str, words: str):
    """Where words end in text."""
    at = text.find(words)
    while at >= 0:
        yield at + len(words)
        at = text.find(words, at + 1)


class Sheet:
    """The spans of a table's box, by what they say and by their stacks. What a cell may match is looked up by its beginnings."""

    def __init__(self, spans: list[Span]):
        self.spans = [s for s in spans if s.text.strip() and s.zone != "fnref"]
        self.notes = [s for s in spans if s.zone == "fnref"]
        self.one = {s.key: s for s in reversed(self.spans)}
        self.columns: list[list[Span]] = []
        edges: list[float] = []
        for s in self.spans:
            at = next((k for k, e in enumerate(edges) if abs(e - s.x0) <= STACK_EDGE), None)
            if at is None:
                edges.append(s.x0)
                self.columns.append([])
                at = -1
            self.columns[at].append(s)
        self.runs: dict[str, list[list[Span]]] = {}
        for column in self.columns:
            column.sort(key=lambda s: s.y0)
            for i in range(len(column)):
                text = ""
                for j in range(i, min(i + STACK, len(column))):
                    if j > i and column[j].y0 - column[j - 1].y1 >= STACK_GAP:
                        break
                    text += column[j].key
                    self.runs.setdefault(text, []).append(column[i : j + 1])
        self._rows: dict[float, list[Span]] = {}

    @cached_property
    def _ones(self) -> tuple[dict[str, int], list[int]]:
        return {k: i for i, k in enumerate(self.one)}, by_length(self.one)

    @cached_property
    def _run_lengths(self) -> list[int]:
        return by_length(self.runs)

    @cached_property
    def _longer(self) -> dict[str, list[str]]:
        """What a stack's first lines say, with the stacks that go on."""
        out: dict[str, list[str]] = {}
        for k, rs in self.runs.items():
            for head in dict.fromkeys(h for r in rs for h in self._heads(r)):
                out.setdefault(head, []).append(k)
        return out

    @staticmethod
    def _heads(run: list[Span]):
        text = ""
        for s in run[:-1]:
            text += s.key
            yield text

    @cached_property
    def _starts(self) -> tuple[dict[str, list[tuple[int, int]]], list[int]]:
        """Where in the columns a span says something."""
        out: dict[str, list[tuple[int, int]]] = {}
        for n, column in enumerate(self.columns):
            for i, s in enumerate(column):
                out.setdefault(s.key, []).append((n, i))
        return out, by_length(out)

    @cached_property
    def _heights(self) -> tuple[list, list, list, list]:
        middles, tops = (sorted((f(s), i) for i, s in enumerate(self.spans)) for f in (lambda s: s.middle, lambda s: s.y0))
        return [m for m, _ in middles], [i for _, i in middles], [t for t, _ in tops], [i for _, i in tops]

    def band(self, row: list[Cell]) -> float | None:
        """The middle of the row on the page: the upper median of what its cells match once, if those agree."""
        ys = [r[0][0].middle for c in row if c.key and len(r := self.runs.get(c.key, [])) == 1]
        if not ys:
            for c in row:
                hits = [r for k in begins(c.key, self._run_lengths) if len(k) >= 4 and len(r := self.runs.get(k, [])) == 1]
                ys += [hits[0][0][0].middle] if len(hits) == 1 else []
        ys.sort()
        return ys[len(ys) // 2] if ys and ys[-1] - ys[0] <= BAND else None

    def near(self, middle: float) -> list[Span]:
        """Spans of a row from left to right, with what hangs close below them."""
        if middle not in self._rows:
            middles, by_middle, tops, by_top = self._heights
            some = by_middle[bisect_left(middles, middle - BAND - 1) : bisect_right(middles, middle + BAND + 1)]
            at = sorted(i for i in some if abs(self.spans[i].middle - middle) <= BAND)
            for _ in range(2):
                there, chosen = set(at), [self.spans[i] for i in at]
                low, high = min((m.y1 for m in chosen), default=0) - 2, max((m.y1 for m in chosen), default=0) + 6
                some = sorted(i for i in by_top[bisect_left(tops, low) : bisect_right(tops, high)] if i not in there)
                at += [i for i in some for s in [self.spans[i]] if any(min(s.x1, m.x1) > max(s.x0, m.x0) and -1 <= s.y0 - m.y1 <= 5 for m in chosen)]
            self._rows[middle] = sorted((self.spans[i] for i in at), key=lambda s: (s.x0, s.y0))
        return self._rows[middle]

    def split_glued(self, row: list[Cell]) -> list[Cell]:
        """Two spans side by side in one cell, beside one empty cell, get a cell each."""
        empty = [k for k, c in enumerate(row) if not c.key]
        if len(empty) != 1:
            return row
        for i, c in enumerate(row):
            order, lengths = self._ones
            for k in sorted((k for k in begins(c.key, lengths) if k in order), key=order.get):
                a, b = self.one[k], self.one.get(c.key[len(k) :])
                if b is None:
                    continue
                left, right = sorted((a, b), key=lambda s: s.x0)
                if right.x0 >= left.x1 - 2:
                    out = list(row)
                    out[i], out[empty[0]] = (c.of(right.text), row[empty[0]].of(left.text)) if empty[0] < i else (c.of(left.text), row[empty[0]].of(right.text))
                    return out
        return row

    def split_anew(self, row: list[Cell]) -> list[Cell]:
        """Neighbours that match nothing, though both together are two spans of the row, are parted where those are."""
        middle = self.band(row)
        if middle is None:
            return row
        there = {s.key: s for s in self.near(middle)}
        for i in range(len(row) - 1):
            a, b = row[i].key, row[i + 1].key
            if not a or a in there or b in there:
                continue
            both = a + b
            if cut := next((k for k in there if both.startswith(k) and both[len(k) :] in there), None):
                return [*row[:i], row[i].of(there[cut].text), row[i + 1].of(there[both[len(cut) :]].text), *row[i + 2 :]]
        return row

    def merge_split(self, row: list[Cell]) -> list[Cell]:
        """Neighbours that match nothing, though both together are one span, become one cell over both columns."""
        for i in range(len(row) - 1):
            a, b = row[i], row[i + 1]
            if a.key and b.key and a.key not in self.runs and b.key not in self.runs and (s := self.one.get(a.key + b.key)):
                wide = sum(int(m[1]) if (m := re.search(r'colspan="(\d+)"', c.attrs)) else 1 for c in (a, b))
                attrs = re.sub(r'\s*colspan="\d+"', "", a.attrs) + f' colspan="{wide}"'
                return [*row[:i], replace(a, attrs=attrs).of(s.text), *row[i + 2 :]]
        return row

    def in_order(self, row: list[Cell]) -> list[Cell]:
        """Cells that all match a span of the row stand in the order of the spans' left edges."""
        middle = self.band(row)
        if middle is None or any(not c.key for c in row):
            return row
        pool: dict[str, list[Span]] = {}
        for s in self.near(middle):
            pool.setdefault(s.key, []).append(s)
        placed = [(pool[c.key].pop(0).x0, k) if pool.get(c.key) else None for k, c in enumerate(row)]
        if None in placed or [k for _, k in sorted(placed)] == list(range(len(row))):
            return row
        return [slot.saying(row[k].html) for slot, (_, k) in zip(row, sorted(placed), strict=True)]

    def rebuilt(self, row: list[Cell]) -> list[Cell]:
        """A row whose cells don't match is dealt out anew from its spans, if those are as many cells and the same letters."""
        middle = self.band(row)
        if middle is None or all(not c.key or c.key in self.runs for c in row):
            return row
        groups: list[list[Span]] = []
        for s in self.near(middle):
            if groups and min(s.x1, max(m.x1 for m in groups[-1])) > max(s.x0, groups[-1][0].x0):
                groups[-1].append(s)
            else:
                groups.append([s])
        texts = [joined(s.text.translate(HIDDEN) for s in sorted(g, key=lambda s: (round(s.y0), s.x0))) for g in groups]
        if len(texts) < max(2, len(row)):
            return row
        have, want = Counter("".join(c.key for c in row).translate(HIDDEN)), Counter(key("".join(texts)))
        notes = Counter("".join(n.key for n in self.notes if abs(n.middle - middle) <= BAND))
        if have != want and (not notes or have - notes != want):
            return row
        return [Cell(row[0].tag, "", "").of(t) for t in texts]

    def extended(self, table: list[list[Cell]]) -> list[list[Cell]]:
        """A cell that is the beginning of one stack only, whose rest no cell has, gets the whole stack."""
        claimed = {c.key for row in table for c in row}

        def whole(c: Cell) -> Cell:
            if not c.key or c.key in self.runs and len(self.runs[c.key]) != 1:
                return c
            longer = [r[0] for k in self._longer.get(c.key, []) if len(r := self.runs[k]) == 1]
            run = max(longer, key=len, default=None)
            if run is None:
                return c
            n = next(n for n, head in enumerate(self._heads(run), 1) if head == c.key)
            rest = [s.key for s in run[n:]]
            tails = {"".join(rest[a:b]) for a in range(len(rest)) for b in range(a + 1, len(rest) + 1)}
            return c if claimed & tails else c.of(joined(s.text for s in run))

        return [[whole(c) for c in row] for row in table]

    def fragments(self, table: list[list[Cell]]) -> list[list[Cell]]:
        """A row whose filled cells all go on with the stacks of the cells above joins that row."""
        out: list[list[Cell]] = []
        for row in table:
            above = out[-1] if out else []
            filled = [k for k, c in enumerate(row) if c.key]
            goes_on = lambda k: above[k].key and any(run.startswith(above[k].key + row[k].key) for run in self._longer.get(above[k].key, []))  # noqa: B023, E731
            if filled and len(above) == len(row) and all(goes_on(k) for k in filled):
                out[-1] = [a.saying(f"{a.html.rstrip()} {c.html.strip()}") if c.key else a for a, c in zip(above, row, strict=True)]
            else:
                out.append(row)
        return out

    def styled(self, row: list[Cell], signifies: bool) -> list[Cell]:
        """Cells in the words of their spans, longest first from the left; bold ones as such where bold says something."""
        middle = self.band(row)
        if middle is None:
            return row
        pool: dict[str, list[Span]] = {}
        for s in self.near(middle):
            pool.setdefault(s.key, []).append(s)
        out = []
        for c in row:
            parts, at = [], 0
            while at < len(c.key):
                best = max((k for k in pool if k and c.key.startswith(k, at)), key=len, default=None)
                if best is None:
                    break
                parts.append(pool[best].pop(0) if len(pool[best]) > 1 else pool[best][0])
                at += len(best)
            if not c.key or at < len(c.key) or "<" in c.html:
                out.append(c)
                continue
            texts = [(entities.escape(s.text.strip(), quote=False), s.bold and signifies) for s in parts]
            out.append(c.saying(" ".join(f"<b>{t}</b>" if b else t for t, b in texts)))
        return out

    def _stack(self, c: Cell) -> list[Span] | None:
        """The spans under each other, whatever their gaps, that say what a cell without tags says."""
        if "<" in c.html:
            return None
        starts, lengths = self._starts
        for n, i in sorted(x for k in begins(c.key, lengths) for x in starts.get(k, ())):
            column, text = self.columns[n], ""
            for j in range(i, len(column)):
                text += column[j].key
                if text == c.key:
                    return column[i : j + 1]
                if not c.key.startswith(text):
                    break
        return None

    def bold_lead(self, c: Cell) -> Cell:
        """The bold lines that a cell of a stack begins with, where others follow."""
        run = self._stack(c) if len(c.key) >= LEAD else None
        n = next((k for k, s in enumerate(run) if not s.bold), 0) if run else 0
        if not n:
            return c
        left, at = sum(len(s.key) for s in run[:n]), 0
        while left:
            left -= not c.html[at].isspace()
            at += 1
        return c.saying(f"<b>{c.html[:at]}</b>{c.html[at:]}")

    def paragraphs(self, c: Cell) -> Cell:
        """A long cell's lines, parted where the page leaves a gap."""
        run = self._stack(c) if len(c.key) >= LONG else None
        if not run:
            return c
        parts = [[run[0]]]
        for a, b in zip(run, run[1:], strict=False):
            if b.y0 - a.y1 >= PARAGRAPH_GAP:
                parts.append([])
            parts[-1].append(b)
        return c.saying("".join(f"<p>{entities.escape(joined(s.text for s in p), quote=False)}</p>" for p in parts)) if len(parts) > 1 else c

    def noted(self, table: list[list[Cell]]) -> list[list[Cell]]:
        """Footnote references after the text that ends last before them on their line; a digit that stood for one goes."""
        for n in self.notes:
            left = [s for s in self.spans if s.x1 <= n.x0 + 2 and min(s.y1, n.y1) > max(s.y0, n.y0)]
            if not left or not (anchor := max(left, key=lambda s: s.x1).text.strip()):
                continue
            number, words = n.text.strip(), entities.escape(anchor, quote=False)
            rest = re.compile(rf"(?:\s*{re.escape(number)}\b)?(?![^<]*</sup>)")
            for row in table:
                at, cut = next(((k, (i, m.end())) for k, c in enumerate(row) if words in c.html for i in places(c.html, words) if (m := rest.match(c.html, i))), (None, None))
                if at is not None:
                    new = f"{row[at].html[: cut[0]]}<sup>[^{number}]</sup>{row[at].html[cut[1] :]}"
                    row[at] = row[at].saying(re.sub(rf"(</sup>(?:</\w+>)*)\s*{re.escape(number)}\b", r"\1", new))
                    break
        return table


def repaired(rows: list[list[Cell]], spans: list[Span], bold_share: float = 0.9) -> list[list[Cell]]:
    """All repairs, in order: rows and cells first, then their words and styles, notes last."""
    sheet = Sheet(spans)
    signifies = sum(s.bold for s in sheet.spans) < bold_share * max(1, len(sheet.spans))
    rows = sheet.fragments(rows)
    rows = [sheet.split_anew(sheet.split_glued(r)) for r in rows]
    rows = sheet.extended(rows)
    rows = [sheet.rebuilt(sheet.in_order(sheet.merge_split(r))) for r in rows]
    rows = [[sheet.paragraphs(sheet.bold_lead(c)) for c in r] for r in rows]
    return sheet.noted([sheet.styled(r, signifies) for r in rows])


def repair_all(tables: DataFrame, id_col: str = "tid", rows_col: str = "rows", spans_col: str = "spans") -> DataFrame:
    """Rows (id_col, rows_col) of tables (id_col, rows, spans) after all repairs; null spans are none."""

    def work(batches):
        import pyarrow as pa

        kind = pa.list_(pa.list_(pa.struct([("tag", pa.string()), ("attrs", pa.string()), ("html", pa.string())])))
        for batch in batches:
            out = []
            for rows, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                done = repaired([[Cell(**c) for c in r] for r in rows or []], [Span(**s) for s in spans or []])
                out.append([[{"tag": c.tag, "attrs": c.attrs, "html": c.html} for c in r] for r in done])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], [id_col, rows_col])

    rows = tables.select(F.col(id_col).cast("bigint").alias(id_col), F.col(rows_col).cast(ROWS).alias(rows_col), F.col(spans_col).cast(f"array<{SPAN}>").alias(spans_col))
    return shipped(rows).mapInArrow(work, f"{id_col} bigint, {rows_col} {ROWS}")
