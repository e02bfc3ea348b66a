"""HTML markup -> plain text, as a column expression.

Structure is removed on the JVM side by one regular expression read left to
right, like an HTML tokenizer (so a script's string "</p>" or a "<!--" inside
a script never starts a new construct):

* comments ``<!-- ... -->``,
* ``script`` / ``style`` / ``template`` elements with their content,
* the brackets of a CDATA section, whose text stays as it is written,
* every other tag, declaration or processing instruction
  (``<x ...>``, ``</x>``, ``<!...>``, ``<?...>``); a quoted attribute value may
  hold ``>``, and a quote that never closes is an ordinary character.

A construct cut off by the end of the text runs to the end and is dropped,
as an HTML tokenizer does at end of input.

Character references are then decoded in a single pass (HTML5 rules, so
``&amp;lt;`` becomes ``&lt;`` and not ``<``). Text whose only references
are the five basic named ones is decoded natively; anything else (other
named references, numeric ones, legacy forms without ';') goes, one Arrow
batch at a time, through the standard library decoder. Whitespace is kept.
"""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RAW_TEXT_ELEMENTS = ("script", "style", "template")
# At each '<' the first alternative that matches wins.
# Possessive repeats run as loops in the regex engine: long attributes cost no stack.
_ATTRIBUTES = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+"""
_MARKUP = "(?is)" + "|".join(
    [r"<!--.*?(?:-->|\z)"]
    + [rf"<{t}(?![a-z0-9:_-]){_ATTRIBUTES}(?:>.*?(?:</{t}\s*>|\z)|\z)" for t in _RAW_TEXT_ELEMENTS]
    + [r"<!\[CDATA\[(.*?)\]\]>", r"<!\[CDATA\[.*+", rf"<[a-z/]{_ATTRIBUTES}(?:>|\z)", r"<[!?][^>]*+(?:>|\z)"])
_CDATA = r"(?i)<!\[CDATA\["
# Every '&' of a CDATA section, one after the other.
_CDATA_AMP = r"(?is)(<!\[CDATA\[|\G(?!\A))((?:(?!\]\]>)[^&])*+)&"

# The named references decoded natively, '&amp;' applied last.
_BASIC_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]
# Any reference start other than the five basic ones needs the full decoder.
_NEEDS_FULL_DECODER = r"&(?!(?:amp|lt|gt|quot|apos);)(?:#|[^\t\n\f <&#;])"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_markup(value) -> Column:
    """Markup removed, references still encoded."""
    s = _col(value)
    kept = F.when(s.rlike(_CDATA), F.regexp_replace(s, _CDATA_AMP, "$1$2&amp;")).otherwise(s)
    return F.regexp_replace(kept, _MARKUP, "$1")


def _decode_basic(s: Column) -> Column:
    for ref, char in _BASIC_ENTITIES:
        s = F.replace(s, F.lit(ref), F.lit(char))
    return s


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(_html.unescape, na_action="ignore")


def decode_entities(value) -> Column:
    s = _col(value)
    full = F.when(s.rlike(_NEEDS_FULL_DECODER), s)
    return F.coalesce(_unescape(full), _decode_basic(s))


def html_text(value) -> Column:
    """Visible text of an HTML fragment or page."""
    return decode_entities(strip_markup(value))


def with_html_text(df, column: str, out: str):
    """``df`` plus ``out`` = visible text of ``column``. The markup pass runs
    once per row: its result is a column that both the native decoder and
    the Arrow batch decoder read (a single expression would evaluate the
    regex on each side of the Python boundary)."""
    tmp = f"_{out}_stripped"
    return (df.withColumn(tmp, strip_markup(column))
            .withColumn(out, decode_entities(tmp))
            .drop(tmp))
