"""Markdown sections as pages: blocks, inline marks, boxes, figures, notes and a table of contents, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import markdown as M
from . import text as T


def slug(heading: Column) -> Column:
    return T.slugify(F.regexp_replace(T.strip_tags(heading), r"[*_`\[\]]", ""))


def inline(c: Column, colors: dict[str, str], base: str) -> Column:
    """Marks inside a block's text: code first, then images, chips, notes, links, bold and italics; anything else is escaped."""
    c = F.regexp_replace(F.regexp_replace(c, r"&(?![a-zA-Z#0-9]+;)", "&amp;"), r"<(?![a-zA-Z/!])", "&lt;")
    c = F.regexp_replace(c, r"(?<!`)`([^`\n]+)`(?!`)", "<code>$1</code>")
    c = F.regexp_replace(c, r"!\[([^\]]*)\]\(([^)]+)\)", '<img src="$2" alt="$1" loading="lazy" decoding="async">')
    for label, color in colors.items():
        c = F.replace(c, F.lit(f":chip[{label}]"), F.lit(f'<span class="chip chip-{color}">{label}</span>'))
    c = F.regexp_replace(c, r":chip\[([^\]]+)\]", '<span class="chip chip-gray">$1</span>')
    c = F.regexp_replace(c, r"\[\^(\d+)\]", '<sup><a href="#fn-$1" id="fnref-$1">$1</a></sup>')
    c = F.regexp_replace(c, r"\[([^\]]*)\]\(([^)]+)\)", '<a href="$2">$1</a>')
    c = F.regexp_replace(c, r"<(https?://[^>\s]+)>", '<a href="$1">$1</a>')
    c = F.regexp_replace(c, r"\*\*([^*\n]+)\*\*", "<strong>$1</strong>")
    c = F.regexp_replace(c, r"(?<!\*)\*([^*\n]+)\*(?!\*)", "<em>$1</em>")
    return F.regexp_replace(c, r"\\([*_`<\[\]])", "$1")


def block(b: Column, colors: dict[str, str], base: str) -> Column:
    """One block: a heading with its id, a list, a quote, a figure, a note, a box's edge, code, raw HTML or a paragraph."""
    level = F.length(F.regexp_extract(b, r"^(#{1,6})\s", 1)).cast("string")
    title = F.regexp_replace(b, r"^#{1,6}\s+", "")
    heading = F.concat(F.lit("<h"), level, F.lit(' id="'), slug(title), F.lit('">'), inline(title, colors, base), F.lit("</h"), level, F.lit(">"))
    items = F.transform(F.split(b, "\n"), lambda x: F.concat(F.lit("<li>"), inline(F.regexp_replace(x, r"^\s*(?:[-*+]|\d{1,2}\.)\s+", ""), colors, base), F.lit("</li>")))
    listed = lambda tag: F.concat(F.lit(f"<{tag}>"), F.array_join(items, ""), F.lit(f"</{tag}>"))
    quote = F.concat(F.lit("<blockquote><p>"), inline(F.regexp_replace(b, r"(?m)^>\s?", ""), colors, base), F.lit("</p></blockquote>"))
    figure = F.concat(F.lit('<figure><div class="figure-card">'), F.regexp_replace(b, r"(?m)^!\[([^\]]*)\]\(([^)]+)\)\s*$", '<a href="$2" class="figure-zoom"><img src="$2" alt="$1" loading="lazy" decoding="async"></a>'), F.lit("</div></figure>"))
    note = F.concat(F.lit('<aside class="note" id="fn-'), F.regexp_extract(b, r"^\[\^(\d+)\]:", 1), F.lit('">'), inline(F.regexp_replace(b, r"^\[\^\d+\]:\s*", ""), colors, base), F.lit("</aside>"))
    code = F.concat(F.lit("<pre><code>"), F.replace(F.replace(F.regexp_replace(F.regexp_replace(b, r"^```[^\n]*\n", ""), r"\n?```\s*$", ""), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</code></pre>"))
    edge = F.when(b.rlike(r"^:{3,}\s*$"), "</div>").otherwise(M.box_html(b))
    return (
        F.when(level != "0", heading).when(b.startswith("```"), code).when(b.rlike(r"^[-*+]\s"), listed("ul")).when(b.rlike(r"^\d{1,2}\.\s"), listed("ol")).when(b.startswith(">"), quote).when(b.rlike(r"^!\[[^\]]*\]\([^)]+\)\s*(?:\n|$)"), figure)
        .when(b.rlike(r"^\[\^\d+\]:"), note).when(b.startswith(":::"), edge).when(b.rlike(r"^<(?:table|div|p|pre|aside|figure)\b"), M.article_html(b)).otherwise(F.concat(F.lit("<p>"), inline(b, colors, base), F.lit("</p>")))
    )


def render(c: Column, base: str, colors: dict[str, str]) -> Column:
    """A section's page: markers become anchors, those before a heading inside it; quotes are turned; blocks stand on lines.

    Images that follow each other in paragraphs of their own, without a marker between, are one figure. A null text is null.
    """
    c = M.site_markdown(c, base)
    c = F.regexp_replace(c, r"(?m)^(#{1,6} )(.*)$", "\n\n$1$2\n\n")
    mark = r'<a class="pagemark"[^>]*></a>'
    c = F.regexp_replace(c, rf"({mark})\s*\n\s*(#{{1,6}} )", "$2$1")
    c = F.regexp_replace(c, r"(?m)(^!\[[^\]]*\]\([^)]+\)[ \t]*)\n\s*\n(?=!\[)", "$1\n")
    blocks = F.filter(F.transform(F.split(c, r"\n[ \t]*\n\s*"), T.trim), lambda b: b != "")
    return T.smart_quotes_html(F.array_join(F.transform(blocks, lambda b: block(b, colors, base)), "\n"))
