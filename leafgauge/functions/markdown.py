"""Markdown as sites, search indexes and other programs read it: Column expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

# Comments, markers, figure paths and directive lines of the dialect.
COMMENT = r"<!--[\s\S]*?-->"
MARKER = r"<!--\s*p\.(\d+)\s*-->"
FIGURES = r"\]\(assets/figures/"
LEADING_TITLE = r"^(<!--[\s\S]*?-->\s*)*# .*\n+(?:\*?[A-Z][a-z]+ \d{1,2}, \d{4}\*?\n+)?"


def site_markdown(c: Column, base: str) -> Column:
    """For a site: no title and date at the start, markers as anchors into the source, no comments, figures below base."""
    c = F.regexp_replace(c, LEADING_TITLE, "$1")
    mark = f'<a class="pagemark" id="p-$1" href="{base}/source.pdf#page=$1" title="Page $1 of the source PDF" aria-label="Page $1 of the source PDF" data-page="p.$1" target="_blank" rel="noopener"></a>'
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, MARKER, mark), COMMENT, ""), FIGURES, f"]({base}/figures/")


def portable_markdown(c: Column, base: str) -> Column:
    """For other programs: no source comment, markers kept, figures below base."""
    return F.regexp_replace(F.regexp_replace(c, r"<!--\s*source: [^>]*-->\n?", ""), FIGURES, f"]({base}/figures/")


def page_text(html: Column) -> Column:
    """What a page says: tags as blanks, entities decoded, blanks made one."""
    return T.trim(F.regexp_replace(T.unescape(T.strip_tags(html, " ")), r"(?U)\s+", " "))


def chip_html(label: Column, color: Column) -> Column:
    """A chip as a coloured pill; grey where the registry has no colour."""
    return F.concat(F.lit('<span class="chip chip-'), F.coalesce(color, F.lit("gray")), F.lit('">'), label, F.lit("</span>"))


def box_html(line: Column) -> Column:
    """A directive line as the start or end of its box, other lines as they are; inside boxes labels come first."""
    name = F.regexp_extract(line, r"^:{3,}(turn|caption|transcript|example)(?:\{.*\})?\s*$", 1)
    value = lambda key: F.nullif(F.regexp_extract(line, key + r'="?([^"}\s]*)"?', 1), F.lit(""))
    quoted = lambda key: F.when(line.contains(f'{key}="'), F.regexp_extract(line, key + r'="([^"]*)"', 1))
    role = F.when(value("role") == "user", "user").otherwise("assistant")
    turn = F.concat(F.lit('<div class="turn turn-'), role, F.lit('"><div class="turn-label">'), F.coalesce(quoted("label"), F.initcap(role)), F.lit("</div>"))
    box = F.concat(F.lit('<aside class="box box-'), name, F.lit('"><div class="box-label">'), F.coalesce(quoted("title"), F.initcap(name)), F.lit("</div>"))
    start = F.when(name == "turn", turn).when(name == "caption", '<div class="caption">').when(name != "", box)
    return F.coalesce(start, line)


def glued_lead(c: Column) -> Column:
    """A blank between a caption's bracketed lead and the title that abuts it."""
    return F.regexp_replace(c, r"\](?=[A-Za-z0-9])", "] ")


def footnote(n: Column, body: Column) -> Column:
    """A footnote's definition; of a body with two bullets or more the pieces become a list inside the note."""
    parts = F.transform(F.split(body, "●"), T.trim)
    items = F.filter(F.slice(parts, 2, F.size(parts)), lambda p: p != "")
    lead = F.concat(F.lit("[^"), n.cast("string"), F.lit("]: "))
    listed = F.concat_ws("\n", F.concat(F.array(F.regexp_replace(F.concat(lead, F.get(parts, F.lit(0))), r"\s+$", "")), F.transform(items, lambda p: F.concat(F.lit("    - "), p))))
    return F.concat(F.when(F.size(items) >= 2, listed).otherwise(F.concat(lead, body)), F.lit("\n\n"))


def list_item(body: Column, level: Column, quote: Column, raw: Column) -> Column:
    """An item's line: numbers kept with a full stop, bullets a hyphen, lettered ones a level deep at least; indented by level."""
    mark = F.when(quote, "> ").otherwise("")
    step = F.when(quote, "   ").otherwise("    ")
    number = F.regexp_extract(body, r"^[‌ ]*(\d{1,2})[.)]​?\s*", 1)
    rest = F.regexp_replace(body, r"^[‌ ]*\d{1,2}[.)]​?\s*", "")
    bare = F.regexp_replace(F.regexp_replace(body, r"^[●•◦▪‣○​‌ ]+", ""), r"^(\**)[●•◦▪‣○​‌ ]+", "$1")
    lettered = raw.rlike(r"^\s*[a-z][.)]​")
    bare = F.when(lettered, F.regexp_replace(bare, r"^(\**[a-z][.)])(?=\S)", "$1 ")).otherwise(bare)
    deep = F.when((number == "") & lettered, F.greatest(level, F.lit(1))).otherwise(level).cast("int")
    return F.concat(mark, F.repeat(step, deep), F.when(number != "", F.concat(number, F.lit(". "), rest)).otherwise(F.concat(F.lit("- "), bare)))


def letter_list(items: Column) -> Column:
    """Of a list's items without their letters, if they all lead with a., b., c. and so on and are two at least; else null."""
    letter = lambda x: F.regexp_extract(x, r"^([a-z])[.)]\s+", 1)
    every = F.forall(F.transform(items, lambda x, i: F.ascii(letter(x)) == 97 + i), lambda ok: ok)
    return F.when((F.size(items) >= 2) & every, F.transform(items, lambda x: F.regexp_replace(x, r"^[a-z][.)]\s+", "")))


def article_html(c: Column) -> Column:
    """A page's images loaded when they are seen, tables that may scroll, paragraphs that are captions of tables as such."""
    c = F.regexp_replace(c, r"<img (?![^>]*\bloading=)", '<img loading="lazy" decoding="async" ')
    c = F.regexp_replace(c, r'(?s)(?<!<div class="table-wrap">)(<table\b.*?</table>)', '<div class="table-wrap">$1</div>')
    return F.regexp_replace(c, r"<p>(?=(?:\s|<[^>]+>)*\[(?:Table|Figure)\b)", '<p class="tablecap">')
