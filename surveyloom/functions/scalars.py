"""Column expressions for answer harmonisation. Everything stays inside Spark's own functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"\d[\d\.]*"
_NUMBER_AFTER_FIRST = r"^[^\d]*\d[\d\.]*[^\d\.][^\d]*(\d[\d\.]*)"
_WHOLE_PART = r"^\s*([+-]?\d+)(\.\d*)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- numbers inside text ------------------------------------------------------

def extract_numbers(c: Column | str) -> Column:
    """Every number of a text, as written (`array<string>`)."""
    return F.regexp_extract_all(_col(c), F.lit(_NUMBER), F.lit(0))


def strip_thousands(c: Column | str) -> Column:
    """`25.001` -> 25001.0; text without digits gives NULL."""
    return F.replace(_col(c), F.lit("."), F.lit("")).try_cast("double")


def repair_ceiling(low: Column, high: Column) -> Column:
    """A ceiling below its floor lost a zero when it was typed."""
    return F.when(high < low, high * 10).otherwise(high)


def once(value: Column, use) -> Column:
    """`use(value)` with `value` computed a single time per row: a lambda variable is not copied into its uses."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def band_midpoint(c: Column | str) -> Column:
    """Pay band text -> midpoint. Open bands: half the ceiling, or the floor plus one eighth."""
    text = _col(c)
    ends = F.struct(
        strip_thousands(F.regexp_extract(text, _NUMBER, 0)).alias("low"),
        strip_thousands(F.regexp_extract(text, _NUMBER_AFTER_FIRST, 1)).alias("high"),
    )

    def middle(band: Column) -> Column:
        low = band["low"]
        return (
            F.when(text.contains("Menos"), low / 2)
            .when(text.contains("Acima"), low * 1.125)
            .otherwise(F.coalesce((low + repair_ceiling(low, band["high"])) / 2, low))
        )

    return once(ends, middle)


def lenient_int(c: Column | str) -> Column:
    """Whole part of a decimal text; anything else, or an overflow, is NULL also under ANSI."""
    return F.regexp_extract(_col(c), _WHOLE_PART, 1).try_cast("int")


# --- rules over text ----------------------------------------------------------

def _first_match(text: Column, tests: Sequence[tuple[Column, str]], default: str) -> Column:
    out = F.when(text.isNull(), F.lit(None).cast("string"))
    for test, label in tests:
        out = out.when(test, F.lit(label))
    return out.otherwise(F.lit(default))


def any_contains(text: Column, parts: Sequence[str]) -> Column:
    test = text.contains(parts[0])
    for part in parts[1:]:
        test = test | text.contains(part)
    return test


def any_prefix(c: Column | str, prefixes: Sequence[str]) -> Column:
    text = _col(c)
    test = text.startswith(prefixes[0])
    for prefix in prefixes[1:]:
        test = test | text.startswith(prefix)
    return test


def label_by_fragment(
    c: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str
) -> Column:
    """First rule with a fragment inside the lower-cased text wins; NULL stays NULL."""
    def label(low: Column) -> Column:
        return _first_match(low, [(any_contains(low, parts), name) for name, parts in rules], default)

    return once(F.lower(_col(c)), label)


def label_by_prefix(c: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """First `(label, prefix)` the text starts with wins; case counts; NULL stays NULL."""
    text = _col(c)
    return _first_match(text, [(text.startswith(prefix), label) for label, prefix in rules], default)


def quoted(name: str) -> str:
    """A header as a column reference: dots, quotes, blanks and backticks are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def flag(name: str) -> Column:
    """The spellings of yes/no flags -> 1/0; any other text is "not asked" (NULL)."""
    text = f"upper({quoted(name)})"
    return F.expr(
        f"CASE WHEN {text} IN ('1', '1.0', 'TRUE') THEN 1 WHEN {text} IN ('0', '0.0', 'FALSE') THEN 0 END"
    )


def prefix_tristate(c: Column | str, yes: str = "Sim", no: str = "Não") -> Column:
    text = _col(c)
    return F.when(text.startswith(yes), 1).when(text.startswith(no), 0)


# --- ratios and deltas --------------------------------------------------------

def percent(part: Column | str, base: Column | str, digits: int = 1) -> Column:
    """`100*part/base`, HALF_UP; an empty base gives NULL instead of an ANSI error."""
    return F.round(F.try_divide(100 * _col(part), _col(base)), digits)


def relative_gap(value: Column | str, against: Column | str, digits: int = 1) -> Column:
    """`100*(value/against - 1)`."""
    return F.round(100 * (F.try_divide(_col(value), _col(against)) - 1), digits)


def point_delta(later: Column | str, earlier: Column | str, digits: int = 1) -> Column:
    return F.round(_col(later) - _col(earlier), digits)


def growth_multiple(later: Column | str, earlier: Column | str, digits: int = 1) -> Column:
    return F.round(F.try_divide(_col(later), _col(earlier)), digits)


# --- display text -------------------------------------------------------------

def pt_number(c: Column | str, digits: int = 0) -> Column:
    """1234.5 -> `1.234,5`: dot for thousands, comma for decimals."""
    return F.translate(F.format_number(_col(c), digits), ",.", ".,")


def pt_percent(c: Column | str, digits: int = 1) -> Column:
    return F.concat(pt_number(c, digits), F.lit("%"))


def pt_signed(c: Column | str, digits: int = 1) -> Column:
    """Signed delta with a decimal comma and no thousands mark."""
    value = _col(c)
    body = F.replace(pt_number(value, digits), F.lit("."), F.lit(""))
    return F.when(value >= 0, F.concat(F.lit("+"), body)).otherwise(body)


def edition_label(c: Column | str, renamed: Mapping[int, str]) -> Column:
    """Display name of an edition; those without a name of their own show the year."""
    edition = _col(c)
    out = None
    for year, name in renamed.items():
        test = edition == F.lit(year)
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    shown = edition.cast("string")
    return shown if out is None else out.otherwise(shown)


def editions_caption(editions: Column | str, renamed: Mapping[int, str]) -> Column:
    """Sorted array of editions -> one name, a list of up to three, or a first-to-last range."""
    years = _col(editions)
    names = F.transform(years, lambda y: edition_label(y, renamed))
    return (
        F.when(F.size(years) == 1, F.concat(F.lit("Edição "), F.get(names, F.lit(0))))
        .when(
            F.size(years) > 3,
            F.concat(F.lit("Edições "), F.element_at(names, 1), F.lit(" a "), F.element_at(names, -1)),
        )
        .otherwise(F.concat(F.lit("Edições "), F.array_join(names, ", ")))
    )


def sizes_caption(sizes: Column, renamed: Mapping[int, str]) -> Column:
    """Array of (ano, n) -> `n (edition) / n (edition)`, by edition."""
    parts = F.transform(
        F.array_sort(sizes),
        lambda e: F.concat(pt_number(e["n"]), F.lit(" ("), edition_label(e["ano"], renamed), F.lit(")")),
    )
    return F.array_join(parts, " / ")


def drop_ordinal(c: Column | str) -> Column:
    """`2. Label` -> `Label`; text without an ordinal is kept."""
    return F.regexp_replace(_col(c), r"(?s)^.*?\. ", "")


def replace_fragments(c: Column | str, swaps: Mapping[str, str]) -> Column:
    out = _col(c)
    for old, new in swaps.items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return out
