"""All checks of a section against its pages at once, document by document.

Documents are independent of each other, so a document with its page facts is one row, and all checks of it are one pass of one
Arrow-batched function: nothing is shuffled, sorted or joined between them. The checks are those of gates.py, which has each of
them over separate tables; test_audit.py holds the two together. Page facts have a page each.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..shipping import shipped
from . import gates, projection, sequence

# White space and line ends as Unicode and the JVM have them, letters outside the categories, and patterns of gates.py.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
GAPS = re.compile(f"[{WHITE}]+")
SEPARATORS = re.compile("[\x1c-\x1f]")
WRAP = re.compile(f"-[{WHITE}]+(?=[a-z])")
SLASHES = re.compile("/+(?=(?:\r\n|[\n\r\x85\u2028\u2029])?\\Z)")
WORD = {"Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Mn", "Me", "Mc", "Nd", "Pc"}
CIRCLED = ((0x24B6, 0x24E9), (0x1F130, 0x1F149), (0x1F150, 0x1F169), (0x1F170, 0x1F189))
INVISIBLE, FOLDS = dict.fromkeys(map(ord, T.INVISIBLE)), str.maketrans(T.FOLD_FROM, T.FOLD_TO)
LIST_MARK, NUMBERED = re.compile(gates.LIST_MARK, re.A), re.compile(gates.NUMBERED, re.A)

#: The columns of a document: its page facts and their fields.
FACTS = {
    "spans": ("page", "line", "seg", "text", "bold", "size", "color", "zone", "x0", "y0", "y1"),
    "links": ("page", "k", "kind", "anchor", "uri", "dest_page", "unresolvable", "name"),
    "pills": ("page", "text", "color"), "notes": ("page", "n", "text"), "figures": ("page",), "expected": ("page",), "starts": ("page",),
}
#: Documents that are unpacked at once.
DOCUMENTS = 50


def _is_word(c: str) -> bool:
    return unicodedata.category(c) in WORD or any(a <= ord(c) <= b for a, b in CIRCLED)


def normal(s: str) -> str:
    """gates' normal form (functions.text.normalize)."""
    if not s.isascii():
        s = unicodedata.normalize("NFC", s)
        for a, b in T.LIGATURES.items():
            s = s.replace(a, b)
        s = s.translate(INVISIBLE)
    if "-" in s:
        s = WRAP.sub(lambda m: "-" if m.start() and _is_word(s[m.start() - 1]) else m[0], s)
    return s if s.isascii() else s.translate(FOLDS)


def words(s: str) -> list[str]:
    """functions.text.tokens."""
    parts = GAPS.split(s) if SEPARATORS.search(s) else s.split()
    return [w for x in parts if (w := x.lstrip(T.BULLETS))]


def key(s: str | None) -> str | None:
    return None if s is None else "".join(words(normal(s)))


def bare(s: str | None) -> str | None:
    return None if s is None else SLASHES.sub("", s)


def by(*at: int) -> Callable:
    """A sorting key of some fields, nulls first and NaN last."""
    return lambda row: [(0,) if (x := row[i]) is None else (1, x) if x == x else (2,) for i in at]


def _cut(s: str | None, n: int) -> str | None:
    return None if s is None else s[:n]


def _near(counts: dict, page: int) -> int:
    return counts.get(page - 1, 0) + counts.get(page, 0) + counts.get(page + 1, 0)


class Pages:
    """What the checks ask of a document's pages, worked out once however many texts are held against them."""

    def __init__(self, facts: dict[str, list[tuple]]):
        self.facts = facts
        lines, spans = defaultdict(list), defaultdict(list)
        for s in facts["spans"]:
            spans[s[0]].append(s)
            if s[7] == "body":
                lines[s[0], s[1]].append(s)
        self.lines = []  # (page, line, text, y0, y1, size, bold, colors)
        least = lambda f, xs: f((x for x in xs if x is not None), default=None)
        for (page, line), ss in lines.items():
            text = "".join(s[3] for s in sorted(ss, key=by(8, 2, 3)) if s[3] is not None)
            bold = [s[4] for s in ss if s[4] is not None]
            colors = sorted({s[6] for s in ss if s[6] is not None})
            self.lines.append((page, line, text, least(min, (s[9] for s in ss)), least(max, (s[10] for s in ss)), least(max, (s[5] for s in ss)), all(bold) if bold else None, colors))
        self.lines.sort(key=by(0, 1))
        self.words, self.word_pages = [], []
        starts = defaultdict(list)
        marks = defaultdict(list)
        of_page = defaultdict(list)
        for x in self.lines:
            w = words(normal(x[2]))
            self.words += w
            self.word_pages += [x[0]] * len(w)
            starts[x[0]].append("".join(w))
            of_page[x[0]].append(x)
            if LIST_MARK.match(x[2].lstrip(WHITE)):
                marks[x[0]].append(x[2])
        self.starts, self.marks = starts, marks
        self.headings = [(page, t, k) for page, xs in of_page.items() for t in heading_groups(xs) if len(k := key(t)) >= 4]
        bold = defaultdict(list)
        for page, ss in spans.items():
            for t in bold_runs(ss):
                if len(k := key(t.strip(gates.RUN_EDGES))) >= 6:
                    bold[page, k].append(t)
        self.bold = bold
        self.notes = whole_notes(facts["notes"])
        self.n_refs = sum(s[7] == "fnref" for s in facts["spans"])


def heading_groups(lines: list[tuple]) -> list[str]:
    """gates.heading_groups of one page."""
    out, cur = [], None
    for _, _, text, y0, y1, size, bold, colors in lines:
        number = m[1] if (m := NUMBERED.match(text)) else ""
        grey = colors == [gates.HEAD_COLOR]
        head = (size is not None and size >= gates.HEAD_SIZE) or (grey and number != "") or (bool(bold) and number.count(".") >= 2)
        alike = cur is not None and None not in (size, cur[2]) and abs(size - cur[2]) < 0.6
        gap = y0 - cur[1] if alike and None not in (y0, cur[1]) else None
        on = head or (gap is not None and gap < 6 and colors == cur[4] and None not in (bold, cur[3]) and bold == cur[3] and (grey or bool(cur[3])))
        if on and gap is not None and gap < 10:
            cur = (f"{cur[0]} {text}", y1, *cur[2:])
            continue
        if cur:
            out.append(cur[0])
        cur = (text, y1, size, bold, colors) if on else None
    return [*out, cur[0]] if cur else out


def bold_runs(spans: list[tuple]) -> list[str]:
    """gates.bold_runs of one page."""
    runs, last = [], None
    for s in sorted(spans, key=by(1, 2)):
        ok = s[7] == "body" and bool(s[4]) and s[6] == gates.BODY_COLOR and s[5] is not None and s[5] < gates.BOLD_SIZE
        if ok and last is not None and last == s[1]:
            runs[-1].append(s)
        elif ok:
            runs.append([s])
        last = s[1] if ok else None
    return ["".join(s[3] for s in sorted(r, key=by(1, 2, 3)) if s[3] is not None) for r in runs]


def whole_notes(notes: list[tuple]) -> dict[int, tuple[int, str]]:
    """Page and text of each note, tails with the last one before."""
    parts, top = defaultdict(list), None
    for page, n, text in sorted(notes, key=lambda x: (x[0], x[1] is not None, x[1] or 0)):
        if n is not None:
            top = n if top is None else max(top, n)
        if top is not None:
            parts[top].append((page, text))
    return {n: (min(p for p, _ in x), " ".join(t for _, t in sorted(x, key=by(0, 1)) if t is not None)) for n, x in parts.items()}


Flag = tuple[str, int, str, dict]


def t1(md: dict, pages: Pages, zone: set) -> Iterator[Flag]:
    """gates.displaced of gates.t1."""
    shown = [f.text for _, f in md["token"]]
    if shown == pages.words:
        return
    at, flags = pages.word_pages, []
    for op, a0, a1, b0, b1 in sequence.differences(pages.words, shown):
        page = at[min(a0, len(at) - 1)] if at else 0
        n = max(a1 - a0, b1 - b0)
        severity = "major" if n >= 3 and page not in zone else "minor"
        flags.append((op, page, severity, " ".join(pages.words[a0:a1])[:160], " ".join(shown[b0:b1])[:160], n, a0))
    nth, moved = {"insert": defaultdict(list), "delete": defaultdict(list)}, {}
    for f in sorted(flags, key=lambda f: (f[1], f[6])):
        if f[0] in nth:
            nth[f[0]][f[4] if f[0] == "insert" else f[3]].append(f)
    for text, there in nth["insert"].items():
        for a, b in zip(there, nth["delete"].get(text, ()), strict=False):
            if abs(a[1] - b[1]) <= 2:
                moved[id(a)], moved[id(b)] = b[1], None
    for f in flags:
        op, page, severity, missing, extra, n, a0 = f
        if id(f) not in moved:
            yield "T1", page, severity, {"at": a0, "extra": extra, "missing": missing, "n": n, "op": op}
        elif op == "insert":
            yield "T1", page, "minor", {"op": "displaced", "text": extra[:120], "from_page": moved[id(f)]}


def l1(md: dict, pages: Pages) -> Iterator[Flag]:
    have, links = Counter(bare(f.target) for _, f in md["link"]), defaultdict(list)
    jumps = []
    for x in pages.facts["links"]:
        if x[2] == "uri":
            links[bare(x[4])].append(x)
        elif x[2] == "goto":
            jumps.append(x)
    for missing, there in links.items():
        lack = len(there) - (have[missing] if missing is not None else 0)
        for x in sorted(there, key=by(0, 1))[: max(lack, 0)]:
            auto = missing is not None and x[3] is not None and missing.startswith("http://") and bare(x[3].strip(WHITE)) in missing
            yield "L1", x[0], "minor" if auto else "major", {"anchor": _cut(x[3], 80), "kind": "auto-link" if auto else "uri", "missing": missing}
    if not jumps:
        return
    shown = " | ".join(normal(f.text) for _, f in md["link"])
    for page, _, _, anchor, _, dest, dead, name in jumps:
        anchor = None if anchor is None else normal(anchor).strip(gates.ANCHOR_EDGES)
        if anchor is not None and len(anchor) >= 3 and anchor not in shown:
            to = name if dead else dest
            yield "L1", page, "minor" if dead else "major", {"anchor": anchor[:80], "kind": "unresolvable" if dead else "goto", "to": "" if to is None else to}


def p1(md: dict, pages: Pages) -> Iterator[Flag]:
    seen = Counter()
    for _, f in md["marker"]:
        seen[f.page] += 1
        if seen[f.page] > 1:
            yield "P1", f.page, "major", {"kind": "duplicate", "nth": seen[f.page]}
    for page in {p for (p,) in pages.facts["expected"]} - set(seen) - {p for (p,) in pages.facts["starts"]}:
        yield "P1", page, "major", {"kind": "missing-marker"}


def f1(md: dict, pages: Pages) -> Iterator[Flag]:
    src, out = Counter(p for (p,) in pages.facts["figures"] if p != 1), Counter(f.page for k in ("image", "fig_skip") for _, f in md[k])
    for page in src.keys() | out.keys():
        if src[page] != out[page]:
            yield "F1", page, "minor" if _near(src, page) == _near(out, page) else "major", {"expected": src[page], "found": out[page]}


def s1(md: dict, pages: Pages, zone: set) -> Iterator[Flag]:
    have, hay = Counter(), None
    shown = sorted(((o, f.page, f.text) for k in ("bold", "heading", "turn_label") for o, f in md[k]), key=lambda x: (x[1], x[0]))
    for _, page, text in shown:
        k = key(text.strip(gates.RUN_EDGES))
        for p in (page - 1, page, page + 1):
            have[p, k] += 1
    for (page, k), texts in pages.bold.items():
        if page in zone or have[page, k] >= len(texts):
            continue
        if len(texts) == 1:
            hay = hay or ([p for _, p, _ in shown], [key(t) for _, _, t in shown])
            if k in "".join(hay[1][bisect_left(hay[0], page - 1) : bisect_right(hay[0], page + 1)]):
                continue
        yield "S1", page, "major", {"kind": "bold-run-missing", "text": min(texts)[:80]}


def _deficit(src: Counter, out: Counter) -> Iterator[tuple]:
    for page, n in src.items():
        if out[page] < n and _near(out, page) < _near(src, page):
            yield page, n, out[page]


def s2(md: dict, pages: Pages, colors: set) -> Iterator[Flag]:
    src, out = defaultdict(Counter), defaultdict(Counter)
    for page, text, color in pages.facts["pills"]:
        if color in colors:
            src[key(text)][page] += 1
    for _, f in md["chip"]:
        out[key(f.text)][f.page] += 1
    for label, n in src.items():
        for page, want, have in _deficit(n, out[label] if label is not None else Counter()):
            yield "S2", page, "major", {"have": have, "kind": "chip-missing", "text": _cut(label, 60), "want": want}


def s3(md: dict, labels: set) -> Iterator[Flag]:
    for _, f in md["chip"]:
        if f.text not in labels:
            yield "S3", f.page, "major", {"kind": "label-not-in-registry", "label": f.text[:60]}


def st1(md: dict, pages: Pages, zone: set) -> Iterator[Flag]:
    for page, n, have in _deficit(Counter({p: len(x) for p, x in pages.marks.items()}), Counter(f.page for _, f in md["item"])):
        if page not in zone:
            yield "ST1", page, "major", {"items": have, "kind": "items-missing", "marks": n, "sample": pages.marks[page][0][:60]}


def st2(md: dict, pages: Pages, zone: set) -> Iterator[Flag]:
    for _, f in md["block"]:
        k = key(f.text)[:24]
        starts = pages.starts.get(f.page)
        if len(k) < 14 or f.page in zone or not starts or k not in "".join(starts):
            continue
        if not any(s and (s.startswith(k) or (len(s) >= 6 and k.startswith(s))) for s in starts):
            yield "ST2", f.page, "major", {"kind": "block-starts-mid-line", "text": f.text[:60]}


def st3(md: dict, pages: Pages, zone: set) -> Iterator[Flag]:
    heads = {(f.page, key(f.text)) for _, f in md["heading"]}
    for page, text, k in pages.headings:
        if page not in zone and not any((p, k) in heads for p in (page - 1, page, page + 1)):
            yield "ST3", page, "major", {"kind": "heading-split-or-missing", "text": text[:70]}


def fn1(md: dict, pages: Pages) -> Iterator[Flag]:
    refs, made = md["fn_ref"], defaultdict(list)
    if pages.n_refs != len(refs):
        yield "FN1", 0, "major", {"found": len(refs), "kind": "reference-count", "refs": pages.n_refs}
    targets = {f.target for _, f in md["fn_def"]}
    for _, f in refs:
        if f.text not in targets:
            yield "FN1", f.page, "major", {"kind": "ref-without-def", "n": f.text}
    for _, f in md["fn_def"]:
        made[int(f.target)].append(f.text)
    stars = lambda s: key(s).replace("*", "")
    for n, (page, body) in pages.notes.items():
        if n not in made:
            yield "FN1", page, "major", {"kind": "body-without-def", "n": n}
        elif len(made[n]) == 1 and stars(made[n][0]) != stars(body):
            yield "FN1", page, "minor", {"found": made[n][0][:80], "kind": "body-text-mismatch", "n": n, "source": body[:80]}


def checked(text: str, pages: Pages, colors: set, labels: set, only: set | None = None) -> list[Flag]:
    """All flags of a section, or those of some invariants; details as strings."""
    md = defaultdict(list)
    for o, f in enumerate(projection.project(text)):
        md[f.kind].append((o, f))
    zone = {f.page + d for _, f in md["table_page"] for d in (-1, 0, 1)}
    checks = {"T1": t1(md, pages, zone), "L1": l1(md, pages), "P1": p1(md, pages), "F1": f1(md, pages), "S1": s1(md, pages, zone), "S2": s2(md, pages, colors), "S3": s3(md, labels), "ST1": st1(md, pages, zone), "ST2": st2(md, pages, zone), "ST3": st3(md, pages, zone), "FN1": fn1(md, pages)}
    return [(i, p, s, {k: None if v is None else str(v) for k, v in d.items()}) for name, flags in checks.items() if only is None or name in only for i, p, s, d in flags]


def _values(column) -> list:
    """A column's values; by way of numpy, which is faster, where no null would become a NaN."""
    import pyarrow as pa

    by_object = pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
    return column.to_numpy(zero_copy_only=False).tolist() if by_object or not column.null_count else column.to_pylist()


def _lists(column, fields: tuple) -> list[list[tuple]]:
    """The rows of a column of lists of structs, as tuples of some fields; null lists are empty."""
    inner, out, at = column.flatten(), [], 0
    rows = list(zip(*(_values(inner.field(f)) for f in fields), strict=True))
    for xs in column.value_lengths().to_pylist():
        out.append(rows[at : at + (xs or 0)])
        at += xs or 0
    return out


def audit(documents: DataFrame, colors: list[str], labels: list[str], keep: tuple = (), change: Callable | None = None, given: tuple = ()) -> DataFrame:
    """Rows (doc, *keep, flags) of the documents; flags: array of (invariant, page, severity, detail), detail a map of strings.

    documents: doc, text, keep, given, and a column of each of FACTS, an array of structs of its fields. With change, a function
    of the text and the columns given, the flags are those that the changed text has and the text itself has not, by invariant
    and detail; where it gives none there is no row, nor is there for a null text.
    """
    colors, labels = set(colors), set(labels)
    same = lambda f: (f[0], tuple(sorted(f[3].items())))
    names = ["doc", *keep, *given, "text", *FACTS]
    rows = documents.select(F.col("doc").cast("bigint").alias("doc"), *keep, *(F.col(c).alias(f"_{c}") for c in given), "text", *FACTS)
    types = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keep)
    schema = f"doc bigint, {types + ', ' if keep else ''}flags array<struct<invariant:string,page:bigint,severity:string,detail:map<string,string>>>"

    def work(batches):
        import gc

        import pyarrow as pa

        # Facts hold no cycles; looking for them among so many takes a quarter of the time. The worker's collector comes back at the end.
        collects = gc.isenabled()
        gc.disable()
        try:
            yield from made(batches, pa)
        finally:
            if collects:
                gc.enable()

    def made(batches, pa):
        flag = pa.struct([("invariant", pa.string()), ("page", pa.int64()), ("severity", pa.string()), ("detail", pa.map_(pa.string(), pa.string()))])
        for batch in batches:
            for start in range(0, batch.num_rows, DOCUMENTS):
                some = batch.slice(start, DOCUMENTS)
                at = dict(zip(names[: -len(FACTS)], (some.column(i) for i in range(len(names) - len(FACTS))), strict=True))
                facts = {k: _lists(some.column(len(names) - len(FACTS) + i), FACTS[k]) for i, k in enumerate(FACTS)}
                args = list(zip(*(some.column(1 + len(keep) + i).to_pylist() for i in range(len(given))), strict=True)) or [()] * some.num_rows
                took, out = [], []
                for i, text in enumerate(at["text"].to_pylist()):
                    new = text if text is None or change is None else change(text, *args[i])
                    if new is None:
                        continue
                    pages = Pages({k: facts[k][i] for k in FACTS})
                    flags = checked(new, pages, colors, labels)
                    if change is not None and flags:
                        old = set(map(same, checked(text, pages, colors, labels, {f[0] for f in flags})))
                        flags = [f for f in flags if same(f) not in old]
                    took.append(i)
                    out.append([{"invariant": a, "page": p, "severity": s, "detail": list(d.items())} for a, p, s, d in flags])
                kept = [some.column(i).take(pa.array(took, pa.int64())) for i in range(1 + len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.list_(flag))], ["doc", *keep, "flags"])

    return shipped(rows).mapInArrow(work, schema)


def flags_of(audited: DataFrame) -> DataFrame:
    """The flags of audit as rows like gates.collect's."""
    return audited.select("doc", F.explode("flags").alias("f")).select("doc", "f.*")


def recall(audited: DataFrame, of: dict[str, str]) -> DataFrame:
    """Rows (kind, invariant, tried, caught): of each kind how many documents, and for how many a flag of its invariant came up."""
    names = F.create_map(*(F.lit(x) for kv in of.items() for x in kv))
    rows = audited.withColumn("invariant", names[F.col("kind")]).withColumn("hit", F.array_contains(F.col("flags.invariant"), F.col("invariant")))
    return rows.groupBy("kind", "invariant").agg(F.count("*").alias("tried"), F.count(F.when(F.col("hit"), 1)).alias("caught"))
