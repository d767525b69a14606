"""Text functions as Column expressions: normal forms, tokens, keys, tags, headings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Ligatures and what they stand for; invisible characters; quotes and blanks folded for comparison.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ft", "ﬆ": "st"}
INVISIBLE = "­​‌‍⁠﻿"
FOLD_FROM, FOLD_TO = "‘’“”‑ ", "''\"\"- "
BULLETS = "●•◦▪‣○"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def once(c: Column, use) -> Column:
    """use(c), with c evaluated once: a value that a lambda mentions is otherwise worked out anew for every element."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


@pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    import unicodedata

    return s if s.isna().all() else s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def nfc(c: Column) -> Column:
    """Composed form; plain ASCII never leaves the JVM, the function gets nulls for it."""
    plain = c.rlike(r"^[\x00-\x7F]*$")
    return F.when(plain, c).otherwise(_nfc(F.when(~plain, c)))


def normalize(c: Column, fold: bool = True, compose: bool = True) -> Column:
    """Composed, ligatures spelt out, invisible characters dropped, wraps after a hyphen closed; fold: quotes and blanks plain."""
    c = nfc(c) if compose else c
    for a, b in LIGATURES.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    c = F.regexp_replace(F.translate(c, INVISIBLE, ""), r"(?U)(\w)-\s+(?=[a-z])", "$1-")
    return F.translate(c, FOLD_FROM, FOLD_TO) if fold else c


def tokens(c: Column) -> Column:
    """Words between white space, without bullets before them, none empty."""
    words = F.transform(F.split(c, r"(?U)\s+"), lambda x: F.regexp_replace(x, f"^[{BULLETS}]+", ""))
    return F.filter(words, lambda x: x != "")


def squash(c: Column) -> Column:
    """All tokens without anything between them."""
    return F.array_join(tokens(c), "")


def strip_tags(c: Column, by: str = "") -> Column:
    return F.regexp_replace(c, "<[^>]+>", by)


def unescape(c: Column) -> Column:
    """The six entities that pages use; the ampersand last, so that nothing is decoded twice."""
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


@pandas_udf(StringType())
def _decoded(s: pd.Series) -> pd.Series:
    import html

    return s.map(lambda x: None if x is None else html.unescape(x))


def decoded(c: Column) -> Column:
    """All named and numbered entities; texts without an ampersand never leave the JVM's value."""
    return F.when(c.contains("&"), _decoded(c)).otherwise(c)


def cell_key(c: Column) -> Column:
    """What cells are compared by: no tags, entities, blanks; quotes and dashes plain."""
    c = F.regexp_replace(unescape(strip_tags(c)), r"(?U)\s+", "")
    return F.translate(c, "‘’“”\"–—", "'''''--")


def trim(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def slugify(c: Column) -> Column:
    return F.regexp_replace(trim(F.regexp_replace(F.lower(c), r"(?U)[^\w\s-]", "")), " ", "-")


def heading_number(c: Column) -> Column:
    return F.regexp_extract(c, r"^(\d+(?:\.\d+)*)\s+\S", 1)


def heading_level(c: Column) -> Column:
    """2 and one more for each dot of its number, 6 at most."""
    n = heading_number(c)
    return F.least(F.lit(6), F.length(n) - F.length(F.replace(n, F.lit("."), F.lit(""))) + 2)


def join_wraps(c: Column, keep_hyphen: bool) -> Column:
    """Close a hyphen and one blank before a small letter, unless and, or, to follows."""
    return F.regexp_replace(c, r"(?U)(\w)- (?!(?:and|or|to)\b)(?=[a-z])", "$1-" if keep_hyphen else "$1")


def hex_color(c: Column) -> Column:
    return F.concat(F.lit("#"), F.lower(F.lpad(F.hex(c), 6, "0")))


def smart_quotes(c: Column) -> Column:
    """Straight quotes turned: opening after white space, brackets, dashes and opening quotes, else closing."""
    before = r"(^|[\s(\[{=—–‘“>])"
    c = F.regexp_replace(F.regexp_replace(c, before + '"', "$1“"), '"', "”")
    c = F.regexp_replace(c, r"'(?=\d)", "’")
    return F.regexp_replace(F.regexp_replace(c, before + "'", "$1‘"), "'", "’")


#: Pieces of a page that are folded together.
STRETCH = 256
#: Tags at which a sentence begins anew, and elements whose quotes stay as they are.
BLOCK_TAG = r"^</?(?:p|div|li|ul|ol|t[dhr]|table|h[1-6]|blockquote|figcaption|aside|br|section|article)\b"
VERBATIM = r"<(?:pre|code)\b[^>]*>.*?</(?:pre|code)>"


def smart_quotes_html(c: Column) -> Column:
    """smart_quotes of a page's text: tags and code stay, what stands before an inline tag counts, each block begins anew."""
    pieces = F.regexp_extract_all(c, F.lit(f"(?s){VERBATIM}|<[^>]+>|[^<]+|<"), 0)
    start = F.struct(F.lit("").alias("out"), F.lit("").alias("prev"))

    def step(acc, x):
        code = x.rlike(f"(?s)^{VERBATIM}$")
        tag = x.rlike(r"(?s)^<[^>]+>$")
        turned = F.substring(smart_quotes(F.concat(acc["prev"], x)), F.length(acc["prev"]) + 1, F.length(x))
        prev = F.when(code, "x").when(tag & x.rlike(BLOCK_TAG), "").when(tag, acc["prev"]).otherwise(F.right(x, F.lit(1)))
        return F.struct(F.concat(acc["out"], F.when(code | tag, x).otherwise(turned)).alias("out"), prev.alias("prev"))

    # By stretches of pieces, each folded from an empty text: the whole text is copied once for a stretch, not for every piece.
    stretch = lambda all, k: F.slice(all, k * STRETCH + 1, F.lit(STRETCH))

    def stretched(acc, xs):
        got = F.aggregate(xs, F.struct(F.lit("").alias("out"), acc["prev"].alias("prev")), step)
        return once(got, lambda g: F.struct(F.concat(acc["out"], g["out"]).alias("out"), g["prev"].alias("prev")))

    fold = lambda p: F.aggregate(F.transform(F.sequence(F.lit(0), F.floor(F.size(p) / STRETCH).cast("int")), lambda k: stretch(p, k)), start, stretched, lambda a: a["out"])
    return F.when(c.isNotNull(), once(pieces, fold))
