"""Article text with unclosed paragraphs nested, as a lenient HTML tree has them.

In such a tree a ``<p>`` that is never closed holds all that follows it inside
its parent, further paragraphs included, and those come again on their own.
Which tags close which needs a stack: a page's tags are folded over one, in the
column expression itself. ``claimloom.functions.html`` gives each paragraph
once and needs no fold; prefer it unless texts must equal those of a tree
parser.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import as_column, let
from claimloom.functions.html import GONE, HIDDEN, ROLE_MAIN, unescape
from claimloom.functions.text import strip

# Elements without content.
VOID = (
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta "
    "nextid param source spacer track wbr"
).split()

_PIECE = r"(?s)<[^>]*>|[^<]+|<"
_NAME = r"^</?([a-zA-Z][^\s/>]*)"
_ELEMENT = "struct<name: string, main: boolean, at: int, end: int>"
_STATE = f"struct<open: array<{_ELEMENT}>, closed: array<{_ELEMENT}>>"


def _element(name: Column, main: Column, at: Column, end: Column) -> Column:
    return F.struct(name.alias("name"), main.alias("main"), at.alias("at"), end.alias("end"))


def _elements(pieces: Column) -> Column:
    """Paragraphs and possible main elements: where each begins, and the first piece after it."""
    def tag(piece: Column, at: Column) -> Column:
        return F.struct(
            F.lower(F.regexp_extract(piece, _NAME, 1)).alias("name"),
            piece.startswith("</").alias("ends"),
            piece.endswith("/>").alias("empty"),
            piece.rlike(f"(?is){ROLE_MAIN}").alias("main"),
            at.alias("at"),
        )

    tags = F.filter(F.transform(pieces, tag), lambda t: (t["name"] != "") & ~t["name"].isin(*VOID))
    return F.aggregate(tags, F.struct(F.array().alias("open"), F.array().alias("closed")).cast(_STATE), _step, lambda s: _finish(s, F.size(pieces)))


def _wanted(elements: Column) -> Column:
    return F.filter(elements, lambda e: e["name"].isin("p", "article", "main") | e["main"])


def _ended(elements: Column, at: Column) -> Column:
    return F.transform(_wanted(elements), lambda e: _element(e["name"], e["main"], e["at"], at))


def _step(state: Column, tag: Column) -> Column:
    # An end tag closes up to the nearest open element of its name; without one it is ignored.
    names = F.reverse(F.transform(state["open"], lambda e: e["name"]))
    depth = F.array_position(names, tag["name"]).cast("int")
    left = F.size(state["open"]) - depth
    closing = F.struct(
        F.slice(state["open"], F.lit(1), left).alias("open"),
        F.concat(state["closed"], _ended(F.slice(state["open"], left + 1, depth), tag["at"])).alias("closed"),
    )
    own = F.array(_element(tag["name"], tag["main"], tag["at"], tag["at"]))
    alone = F.struct(state["open"].alias("open"), F.concat(state["closed"], _wanted(own)).alias("closed"))
    opening = F.struct(F.concat(state["open"], own).alias("open"), state["closed"].alias("closed"))
    nothing = F.struct(state["open"].alias("open"), state["closed"].alias("closed"))
    new = F.when(tag["ends"] & (depth > 0), closing).when(tag["ends"], nothing).when(tag["empty"], alone).otherwise(opening)
    return new.cast(_STATE)


def _finish(state: Column, end: Column) -> Column:
    return F.array_sort(
        F.transform(F.concat(state["closed"], _ended(state["open"], end)), lambda e: F.struct(e["at"].alias("at"), e["end"].alias("end"), e["name"].alias("name"), e["main"].alias("main")))
    )


def _lines(pieces: Column, elements: Column) -> Column:
    """The lines of the paragraphs inside the first article, else main, else role=main element, else of all."""
    def first(kind) -> Column:
        return F.try_element_at(F.filter(elements, kind), F.lit(1))

    scope = F.coalesce(first(lambda e: e["name"] == "article"), first(lambda e: e["name"] == "main"), first(lambda e: e["main"]))

    def line(p: Column) -> Column:
        # The fold counts pieces from 0, a slice from 1.
        held = F.slice(pieces, p["at"] + 2, F.greatest(p["end"] - p["at"] - 1, F.lit(0)))
        texts = F.filter(held, lambda s: ~s.rlike(r"(?s)\A<.*>\z"))
        return F.array_join(F.filter(F.transform(texts, lambda s: strip(unescape(s))), lambda s: s != ""), " ")

    paragraphs = F.filter(elements, lambda e: e["name"] == "p")
    within = let(scope, lambda around: F.filter(paragraphs, lambda p: around.isNull() | ((around["at"] < p["at"]) & (p["at"] < around["end"]))))
    return F.transform(within, line)


def article_text_nested(page: Column | str) -> Column:
    """Paragraph texts of the page's main element, one per line, each with all that its tree holds; empty without any."""
    visible = F.regexp_replace(as_column(page), HIDDEN, GONE)
    lines = let(F.regexp_extract_all(visible, F.lit(_PIECE), F.lit(0)), lambda pieces: let(_elements(pieces), lambda found: _lines(pieces, found)))
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{2,}", "\n"))
