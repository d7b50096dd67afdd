"""Text functions whose results follow Unicode rules that Spark's own functions don't: Arrow-batched, one call a column.

Each plain function works on one string and is what its column function applies to a batch.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from html import unescape
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Elements whose content is dropped, and elements that break a line.
DROPPED = ("script", "style")
BREAKING = ("blockquote", "br", "dd", "div", "dt", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "li", "ol", "p", "table", "tr", "ul")

#: What is no text: a comment, a declaration or instruction, an end that names nothing, or a tag with its attributes.
_MARKUP = re.compile(
    r"""<!--.*?--\s*> | (?P<open><!--[^>]*>?) | <(?!!--)[!?][^>]*> | </(?:>|[^A-Za-z>][^>]*>)
      | <(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*) (?:[^>"'=] | =\s*(?:"[^"]*"|'[^']*')? | ["'])*+ >""",
    re.DOTALL | re.VERBOSE,
)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in DROPPED}
#: Where lines end, in any script.
_LINE_END = re.compile(r"\r\n|[\n\r\v\f\x1c-\x1e\x85\u2028\u2029]")
_PART = re.compile(r"[a-z0-9._\-]+")


def strip_markup(text: str) -> str:
    """What markup shows: no tags, scripts, styles or comments; entities decoded; block elements break lines.

    One pass from tag to tag: what lies between two is text. A tag of a dropped element skips to that element's end, or
    to the end of the text; one that closes itself has no content.
    """
    shown: list[str] = []
    at = 0
    while tag := _MARKUP.search(text, at):
        shown.append(unescape(text[at : tag.start()]))
        at, name = tag.end(), (tag["name"] or "").lower()
        if tag["open"]:  # a comment without an end is none, and shown as far as a tag would go
            shown.append(unescape(tag["open"]))
        elif name in BREAKING:
            shown.append("\n")
        elif name in DROPPED and not tag["end"] and not tag[0].endswith("/>"):
            end = _ENDS[name].search(text, at)
            at = end.end() if end else len(text)
    shown.append(unescape(text[at:]))
    return "".join(shown)


def clean_text(text: str, decode: bool = True) -> str:
    """Entities decoded (unless told not to), NUL dropped, line ends made one kind and trimmed, the whole trimmed."""
    lines = _LINE_END.split((unescape(text) if decode else text).replace("\0", ""))
    return "\n".join(map(str.rstrip, lines)).strip()


def shown_text(markup: str) -> str:
    """What markup shows, cleaned; its entities are decoded once."""
    return clean_text(strip_markup(markup), decode=False)


def public_text(plain: str | None, markup: str | None) -> str:
    """The plain projection, cleaned; where that is empty, what the markup shows."""
    return clean_text(plain or "") or shown_text(markup or "")


def fold(text: str) -> str:
    return text.casefold()


def squeeze(text: str) -> str:
    """Runs of white space as one space, none at the ends."""
    return " ".join(text.split())


def search_fold(key: str) -> str:
    """A key as searched for: decomposed, folded, without characters of a combining class. What is no letter, number, low line
    or hyphen parts words, marks of class 0 (vowel signs of Indic scripts) too; the folded key if no word is left.
    """
    bare = "".join(c for c in unicodedata.normalize("NFKD", key) if unicodedata.combining(c) == 0)
    return squeeze("".join(c if c.isalnum() or c in "_-" else " " for c in fold(bare))) or fold(key)


def strip(text: str) -> str:
    return text.strip()


def percent_decode(text: str) -> str:
    """Lenient: a plus sign and a broken escape stand as they are."""
    return unquote(text)


def slug(name: str) -> str:
    """A name as a path part: its runs of plain characters, a hyphen between two; an empty result is an error."""
    found = "-".join(_PART.findall(fold(name))).strip("-.")
    if not found:
        raise ValueError(f"no slug can be made from {name!r}")
    return found


def _column(fn: Callable[[str], str]) -> Callable[[Column], Column]:
    @F.pandas_udf(StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(fn, na_action="ignore")

    return run


def _ascii_first(fn: Callable[[Column], Column], native: Callable[[Column], Column]) -> Callable[[Column | str], Column]:
    """Not a shortcut inside one plan (Spark evaluates both), but for callers who know that a column is ASCII."""

    def run(value: Column | str, ascii_only: bool = False) -> Column:
        column = F.col(value) if isinstance(value, str) else value
        return native(column) if ascii_only else fn(column)

    return run


fold_col = _ascii_first(_column(fold), F.lower)
squeeze_col = _column(squeeze)
strip_col = _column(strip)
search_fold_col = _column(search_fold)
percent_decode_col = _column(percent_decode)
slug_col = _column(slug)
strip_markup_col = _column(strip_markup)
clean_text_col = _column(clean_text)


@F.pandas_udf(StringType())
def public_text_col(plain: pd.Series, markup: pd.Series) -> pd.Series:
    """Only rows whose plain projection is empty have their markup read: Spark would evaluate both sides of a ``coalesce``."""
    found = plain.fillna("").map(clean_text).astype(object)
    empty = found == ""
    found[empty] = markup[empty].fillna("").map(shown_text)
    return found


def license_text(value: Column | str) -> Column:
    """A licence's name as compared: white space squeezed, folded."""
    return fold_col(squeeze_col(value))
