"""Cleaning of code and text, line by line, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import SPACE, _c, is_blank, lines, trimmed

#: Drawing calls whose lines are dropped from strategies (fixed values).
DRAWING = ("plot", "plotshape", "plotchar", "plotcandle", "plotbar", "hline", "fill", "bgcolor", r"label\.new", r"label\.set_[a-z_]+", r"table\.new", r"table\.cell", r"box\.new", r"line\.new")
_S = f"{SPACE}*"
DRAWING_LINE = rf"(?i)^{_S}(?:(?:(?:{'|'.join(DRAWING)})|p_[A-Za-z0-9_]+{_S}={_S}plot){_S}\(|//{_S}===[^\n]*(?:plot|visual|label|draw))"
#: Calls that plot anywhere in a line.
PLOT_CALL = r"(?:^|[^A-Za-z0-9_])(?:plot|hline|plotshape|plotchar|plotarrow|bgcolor|barcolor|fill)" + _S + r"\("


def without_lines(c: Column | str, pattern: str) -> Column:
    return F.array_join(F.filter(lines(c), lambda x: ~x.rlike(pattern)), "\n")


def removed_lines(c: Column | str, pattern: str) -> Column:
    """The lines that ``without_lines`` drops."""
    return F.filter(lines(F.coalesce(_c(c), F.lit(""))), lambda x: x.rlike(pattern))


def drawing_removed(c: Column | str, samples: int = 10) -> dict[str, Column]:
    """The cleaned code, the number of lines dropped, whether there were any, and the first of them."""
    gone = removed_lines(c, DRAWING_LINE)
    return {"cleaned": without_lines(c, DRAWING_LINE), "removed": F.size(gone).cast("long"), "detected": F.size(gone) > 0, "samples": F.slice(gone, 1, samples)}


def plots_stripped(c: Column | str) -> Column:
    return trimmed(without_lines(c, PLOT_CALL))


def comments_stripped(c: Column | str) -> Column:
    """Cut at ``//``, wherever it stands; block comments and blank lines dropped."""
    cut = F.transform(lines(c), lambda x: F.regexp_replace(F.regexp_replace(x, r"//[^\n]*", ""), r"/\*[^\n]*?\*/", ""))
    kept = F.array_join(F.filter(cut, lambda x: ~is_blank(x)), "\n")
    return F.regexp_replace(kept, r"(?s)/\*.*?\*/", "")


def spaces_collapsed(c: Column | str) -> Column:
    return trimmed(F.regexp_replace(_c(c), f"{SPACE}+", " "))


def comparable_code(c: Column | str) -> Column:
    """Without comments, white space collapsed: what similarity is measured on."""
    bare = F.regexp_replace(F.regexp_replace(_c(c), r"//[^\n]*", ""), r"(?s)/\*.*?\*/", "")
    return spaces_collapsed(bare)


def dedup_key(c: Column | str) -> Column:
    """White space collapsed, lower case; comments stay."""
    return F.lower(spaces_collapsed(c))


def comparable_line(c: Column | str) -> Column:
    """White space collapsed, then cut at the first comment mark (the text is one line by then), lower case: what the ratio of
    matching blocks is measured on. Null is empty."""
    return F.lower(F.get(F.split(spaces_collapsed(F.coalesce(_c(c), F.lit(""))), "//|#", -1), F.lit(0)))


def emphasis_removed(c: Column | str) -> Column:
    return F.replace(_c(c), F.lit("*"), F.lit(""))


def escapes_decoded(c: Column | str) -> Column:
    """The text of a JSON string literal without its quotes: all of its escapes are decoded; what isn't one stays as it is."""
    return F.coalesce(F.from_json(F.concat(F.lit('{"s":"'), _c(c), F.lit('"}')), "s string")["s"], _c(c))

