"""Listings inside stored web pages: one output row per listed item, all native expressions.

``listing`` cuts pages by patterns; ``elements`` cuts them by tag, class and attribute, whatever is nested in them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import first_non_empty, plain_number


@dataclass(frozen=True)
class Cell:
    """Patterns tried in turn for one value (first group, first non-blank match wins)."""

    patterns: Sequence[str]
    suffixes: Sequence[str] | None = None

    def read(self, fragment: Column) -> Column:
        value = first_non_empty(*[F.regexp_extract(fragment, pattern, 1) for pattern in self.patterns])
        return value if self.suffixes is None else plain_number(value, self.suffixes)


def listing(pages: DataFrame, html: str, row_pattern: str, cells: Mapping[str, Cell]) -> DataFrame:
    """Cut every page into row fragments (first group of ``row_pattern``) and read the cells of each.

    ``item`` is the zero-based position of the fragment in its page.
    """
    keep = [c for c in pages.columns if c != html]
    fragments = pages.select(
        *keep, F.posexplode(F.regexp_extract_all(html, F.lit(row_pattern), F.lit(1))).alias("item", "_fragment")
    )
    return fragments.select(*keep, "item", *[cell.read(F.col("_fragment")).alias(n) for n, cell in cells.items()])


def cell_texts(pages: DataFrame, html: str, row_pattern: str, cell_pattern: str) -> DataFrame:
    """Row fragments as arrays of their cell texts, for tables without a fixed set of columns."""
    rows = listing(pages, html, row_pattern, {"row": Cell([r"(?s)(.*)"])})
    cells = F.transform(F.regexp_extract_all("row", F.lit(cell_pattern), F.lit(1)), lambda cell: F.trim(cell))
    return rows.withColumn("cells", cells).drop("row")


_REST_OF_TAG = r"""(?:"[^"]*"|'[^']*'|[^"'>])*>"""
_VALUE = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_BEFORE_NAME = r"""^<[^\s>/]+(?:"[^"]*"|'[^']*'|[^"'>])*?\s"""


@dataclass(frozen=True)
class Selector:
    """Elements by tag, by the classes they have at least, and by attributes (None: there with any value)."""

    tag: str
    classes: Sequence[str] = ()
    attributes: Mapping[str, str | None] = field(default_factory=dict)

    def __post_init__(self):
        if not self.tag.isalnum():
            raise ValueError(f"not a tag: {self.tag!r}")

    def matches(self, opening: Column) -> Column:
        """Whether an opening tag of the right name has the classes and attributes."""
        found = F.lit(True)
        if self.classes:
            present = F.split(attribute(opening, "class"), r"\s+")
            found = F.coalesce(F.size(F.array_except(F.lit(list(self.classes)), present)) == 0, F.lit(False))
        for name, value in self.attributes.items():
            held = attribute(opening, name)
            found = found & (held.isNotNull() if value is None else held.eqNullSafe(F.lit(value)))
        return found


def attribute(opening: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, quotes taken off; null if it has none of that name."""
    if not name.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"not an attribute: {name!r}")
    raw = F.regexp_extract(opening, f"(?is){_BEFORE_NAME}{name}{_VALUE}", 1)
    bare = F.regexp_replace(raw, r"""(?s)^(["'])(.*)\1$""", "$2")
    return F.when(raw != "", bare)


def _without_hidden(html: Column, tag: str) -> Column:
    """The page without comments, scripts and styles, in which tags are no tags."""
    html = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    for hidden in ("script", "style"):
        if tag.lower() != hidden:
            html = F.regexp_replace(html, rf"(?is)<{hidden}\b{_REST_OF_TAG}.*?</{hidden}\s*>", "")
    return html


def _elements(html: Column, selector: Selector) -> Column:
    """Array of (opening, inner) of the matching elements of one page, in the order in which they begin.

    The page is split before every opening or closing tag of that name. A fold over the pieces counts how deep they
    lie and keeps a stack of the elements open, so each closing tag ends the element it belongs to.
    """
    tag = selector.tag
    pieces = F.split(_without_hidden(html, tag), rf"(?i)(?=</?{tag}[\s/>])")
    kinds = F.transform(
        pieces,
        lambda p: F.when(p.rlike(rf"(?is)^</{tag}\s*>"), F.lit(-1))
        .when(p.rlike(rf"(?is)^<{tag}(?=[\s/>]){_REST_OF_TAG}"), F.when(selector.matches(p), F.lit(2)).otherwise(F.lit(1)))
        .otherwise(F.lit(0)),
    )
    nothing = "array<struct<first:int,last:int>>"
    state = F.struct(
        F.lit(0).alias("at"), F.lit([]).cast("array<int>").alias("open"), F.lit([]).cast(nothing).alias("found")
    )

    def step(held: Column, kind: Column) -> Column:
        top = F.element_at(held["open"], -1)
        closes = (kind == -1) & (F.size(held["open"]) > 0)
        # An open element that does not match is kept as a negative place, only to find its end.
        opened = F.concat(held["open"], F.array(F.when(kind == 2, held["at"]).otherwise(-1 - held["at"])))
        less = F.slice(held["open"], 1, F.greatest(F.size(held["open"]) - 1, F.lit(0)))
        ended = F.concat(held["found"], F.array(F.struct(top.alias("first"), held["at"].alias("last"))))
        return F.struct(
            (held["at"] + 1).alias("at"),
            F.when(kind > 0, opened).when(closes, less).otherwise(held["open"]).alias("open"),
            F.when(F.when(closes, top >= 0).otherwise(False), ended).otherwise(held["found"]).alias("found"),
        )

    def finish(held: Column) -> Column:
        left = F.filter(held["open"], lambda at: at >= 0)
        return F.array_sort(F.concat(held["found"], F.transform(left, lambda at: F.struct(at.alias("first"), held["at"].alias("last")))))

    spans = F.when(html.isNotNull(), F.aggregate(kinds, state, step, finish))

    def cut(span: Column) -> Column:
        opening = F.regexp_extract(F.get(pieces, span["first"]), f"(?s)^<{_REST_OF_TAG}", 0)
        whole = F.array_join(F.slice(pieces, span["first"] + 1, span["last"] - span["first"]), "")
        return F.struct(opening.alias("opening"), F.substr(whole, F.length(opening) + 1).alias("inner"))

    return F.transform(spans, cut)


def elements(pages: DataFrame, html: str, selector: Selector) -> DataFrame:
    """One row per matching element: the other columns, ``item`` (position in its page, from 0), ``opening`` (its
    opening tag) and ``inner`` (what it holds, elements of its own kind included; those that match are rows too).

    An element that is never closed ends with the page; a closing tag without an opening one is passed over. Tags
    inside comments, scripts and styles do not count. Pages that are null or without a match give no rows.
    """
    keep = [c for c in pages.columns if c != html]
    cut = pages.select(*keep, F.posexplode(_elements(F.col(html), selector)).alias("item", "_element"))
    return cut.select(*keep, "item", "_element.opening", "_element.inner")


@dataclass(frozen=True)
class Part:
    """A value of an element: the text of the first descendant that matches a selector (tried in turn, the first that
    is not blank wins), or an attribute of it. ``suffixes`` reads a number, as ``Cell`` does."""

    selectors: Sequence[Selector]
    attribute: str | None = None
    suffixes: Sequence[str] | None = None

    def read(self, inner: Column) -> Column:
        found = [F.get(_elements(inner, selector), F.lit(0)) for selector in self.selectors]
        values = [attribute(e["opening"], self.attribute) if self.attribute else text_of(e["inner"]) for e in found]
        value = first_non_empty(*values)
        return value if self.suffixes is None else plain_number(value, self.suffixes)


def text_of(inner: Column) -> Column:
    """Text without tags, runs of blanks as one."""
    bare = F.regexp_replace(inner, rf"(?s)</?[a-zA-Z]{_REST_OF_TAG}", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def selected_listing(pages: DataFrame, html: str, row: Selector, parts: Mapping[str, Part]) -> DataFrame:
    """``elements`` that match ``row``, each with the values of its ``parts``."""
    rows = elements(pages, html, row)
    keep = [c for c in rows.columns if c not in ("opening", "inner")]
    return rows.select(*keep, *[part.read(F.col("inner")).alias(name) for name, part in parts.items()])
