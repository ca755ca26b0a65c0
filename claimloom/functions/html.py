"""Text and preview image of a stored web page, as column expressions.

No parser runs: the page is cut at tags by regular expressions. A paragraph
ends at its closing tag or at the next opening one, so each paragraph is given
once, whether or not its tag was closed.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import as_column, let
from claimloom.functions.text import strip
from claimloom.functions.urls import resolve_url

# A removed element leaves "<>", which still separates the text around it.
GONE = "<>"
_SCRIPTED = (
    r"(?is)<script(?:\s[^>]*)?>.*?(?:</script\s*>|\z)|<style(?:\s[^>]*)?>.*?(?:</style\s*>|\z)"
    r"|<!--.*?-->"
)
HIDDEN = _SCRIPTED + r"|<noscript(?:\s[^>]*)?>.*?(?:</noscript\s*>|\z)"
ROLE_MAIN = r"""<([a-zA-Z][a-zA-Z0-9]*)\s(?:[^>]*\s)?role\s*=\s*(?:"main"|'main'|main(?=[\s/>]))[^>]*>"""
_P_OPEN = r"(?i)<p(?:\s[^>]*)?>"
_P_CUT = r"(?is)</p\s*>.*"
_TAG = r"(?s)<[^>]*>"

# Meta names that may hold the preview image, best first.
IMAGE_META = ("og:image", "twitter:image", "twitter:image:src")

# Named character references, from the table the standard library carries.
_NAMED = "\x02".join(
    f"{name.rstrip(';')}\x01{text}" for name, text in html.entities.html5.items() if name.endswith(";")
)
# Those that texts are full of are looked up first.
_FREQUENT = "\x02".join(
    f"{name}\x01{html.entities.html5[f'{name};']}"
    for name in "nbsp quot lt gt apos rsquo lsquo rdquo ldquo ndash mdash hellip laquo raquo eacute egrave agrave ccedil ecirc "
    "acirc ocirc icirc ucirc ugrave euml iuml auml ouml uuml szlig aacute iacute oacute uacute ntilde copy reg euro middot".split()
)
# Numbers 128..159 stand for the Windows code page, as browsers read them.
_WINDOWS = "\x02".join(
    f"{n}\x01{bytes([n]).decode('cp1252')}" for n in range(128, 160) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)
)


def _table(packed: str) -> Column:
    return F.str_to_map(F.lit(packed), F.lit("\x02"), F.lit("\x01"))


def _code_point(number: Column) -> Column:
    bytes_ = F.unhex(F.lpad(F.hex(number), 8, "0"))
    known = F.try_element_at(_table(_WINDOWS), number.cast("string"))
    usable = number.between(0, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(usable, F.coalesce(known, F.decode(bytes_, "UTF-32"))).otherwise(F.lit("�"))


def _reference(piece: Column) -> Column:
    """Text that followed an ampersand, with its character reference replaced."""
    general = let(
        F.regexp_extract(piece, r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][-.a-zA-Z0-9]*)", 1),
        lambda name: _named_or_numbered(name, piece),
    )
    return F.when(
        piece.startswith("amp;"), F.concat(F.lit("&"), F.substring(piece, F.lit(5), F.char_length(piece)))
    ).otherwise(general)


def _named_or_numbered(name: Column, piece: Column) -> Column:
    rest = F.substring(piece, F.char_length(name) + 1, F.char_length(piece))
    rest = F.when(rest.startswith(";"), F.substring(rest, F.lit(2), F.char_length(rest))).otherwise(rest)
    hexed = F.conv(F.when(name.rlike(r"^#[xX].{1,8}$"), F.substring(name, 3, 8)), 16, 10).try_cast("bigint")
    number = F.coalesce(hexed, F.substring(name, 2, 20).try_cast("bigint"), F.lit(-1).cast("bigint"))
    value = F.when(name.startswith("#"), let(number, _code_point)).otherwise(
        F.coalesce(F.try_element_at(_table(_FREQUENT), name), F.try_element_at(_table(_NAMED), name), F.concat(F.lit("&"), name))
    )
    return F.when(name == "", F.concat(F.lit("&"), piece)).otherwise(F.concat(value, rest))


def unescape(c: Column | str) -> Column:
    """Character references replaced once, left to right (``&amp;lt;`` gives ``&lt;``)."""
    c = as_column(c)

    def joined(pieces: Column) -> Column:
        return F.concat(pieces[0], F.array_join(F.transform(_after_first(pieces), _reference), ""))

    return F.when(F.contains(c, F.lit("&")), let(F.split(c, "&"), joined)).otherwise(c)


def _after_first(items: Column) -> Column:
    return F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0)))


def _inside(page: Column, open_tag: str, name: Column) -> Column:
    """Content of the first element that ``open_tag`` matches, same-named children included."""
    rest = F.regexp_extract(page, rf"(?is){open_tag}(.*)\z", 2)
    pieces = F.split(rest, F.concat(F.lit("(?i)</"), name, F.lit(r"\s*>")))
    return let(pieces, lambda cut: _balanced(cut, name))


def _balanced(pieces: Column, name: Column) -> Column:
    opening = F.concat(F.lit("(?i)<"), name, F.lit(r"(?:\s[^>]*)?>"))
    walked = F.aggregate(
        pieces,
        F.struct(F.lit(1).alias("depth"), F.lit(0).alias("taken")),
        lambda acc, piece: F.when(acc["depth"] == 0, acc).otherwise(
            F.struct(
                (acc["depth"] + F.size(F.split(piece, opening)) - 2).alias("depth"),
                (acc["taken"] + 1).alias("taken"),
            )
        ),
    )
    return F.array_join(F.slice(pieces, 1, walked["taken"]), GONE)


def _scope(page: Column) -> Column:
    """Content of the first article, else main, else role=main element, else the whole page."""
    article, main = r"<(article)(?:\s[^>]*)?>", r"<(main)(?:\s[^>]*)?>"
    role_name = F.regexp_extract(page, f"(?is){ROLE_MAIN}", 1)
    return (
        F.when(page.rlike(f"(?is){article}"), _inside(page, article, F.lit("article")))
        .when(page.rlike(f"(?is){main}"), _inside(page, main, F.lit("main")))
        .when(role_name != "", _inside(page, ROLE_MAIN, role_name))
        .otherwise(page)
    )


def _paragraph(piece: Column) -> Column:
    strings = F.split(F.regexp_replace(piece, _P_CUT, ""), _TAG)
    kept = F.filter(F.transform(strings, lambda s: strip(unescape(s))), lambda s: s != "")
    return F.array_join(kept, " ")


def article_text(page: Column | str) -> Column:
    """Paragraph texts of the page's main element, one per line; empty without any."""
    visible = F.regexp_replace(as_column(page), HIDDEN, GONE)
    pieces = F.split(let(visible, _scope), _P_OPEN)
    lines = F.transform(let(pieces, _after_first), _paragraph)
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{2,}", "\n"))


def _attribute(tag: Column, name: str) -> Column:
    return let(tag, lambda t: _attribute_of(t, name))


def _attribute_of(tag: Column, name: str) -> Column:
    quoted = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    found = F.concat(*[F.regexp_extract(tag, quoted, group) for group in (1, 2, 3)])
    return F.when(tag.rlike(quoted), unescape(found))


def preview_image(page: Column | str, page_url: Column | str) -> Column:
    """Address of the page's preview image, made absolute, or null.

    For each meta name the first tag that carries it as ``property`` counts, or
    else as ``name``; an empty one hands over to the next meta name.
    """
    tags = F.regexp_extract_all(
        F.regexp_replace(as_column(page), _SCRIPTED, GONE),
        F.lit(r"""(?is)<meta[\s/](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""),
        F.lit(0),
    )
    metas = F.transform(
        F.filter(tags, lambda tag: tag.rlike("(?i)image")),
        lambda tag: F.struct(
            _attribute(tag, "property").alias("property"),
            _attribute(tag, "name").alias("name"),
            F.coalesce(_attribute(tag, "content"), F.lit("")).alias("content"),
        ),
    )

    def best(found: Column) -> Column:
        def first(attribute: str, meta: str) -> Column:
            return F.try_element_at(F.filter(found, lambda m: m[attribute] == meta), F.lit(1))["content"]

        def content_of(meta: str) -> Column:
            return F.nullif(F.coalesce(first("property", meta), first("name", meta)), F.lit(""))

        return F.coalesce(*[content_of(meta) for meta in IMAGE_META])

    return let(let(metas, best), lambda link: F.when(link.isNotNull(), resolve_url(page_url, link)))
