"""Display text in Brazilian Portuguese."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, suffixes and month names shown to readers.
MISSING = "—"
NO_ELECTION = "Sem eleição"
SCALE_SUFFIXES = ((1e9, "bi"), (1e6, "mi"), (1e3, "mil"))
MONTH_NAMES = (
    "janeiro", "fevereiro", "março", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
)
NBSP = "\u00a0"
YEAR_SENTENCE = "**%d**: %s, ano %d do mandato federal"
YEAR_SEPARATOR = " · "
NOTE_PART = "Mostrando os %s maiores de %s %s no filtro atual."
NOTE_ALL = "Mostrando %s %s no filtro atual."
TABLE_NOTE_PART = "Mostrando os %s primeiros de %s autores, ordenado pela coluna selecionada."
TABLE_NOTE_ALL = "Mostrando %s autor(es)."


def _br_separators(number_text: Column) -> Column:
    return F.translate(number_text, ",.", ".,")


def format_reais(value: Column) -> Column:
    """Short money text of the dashboard: ``R$ 1,2 bi``, ``R$ 950``, ``—``."""
    number = value.cast("double")
    text = F.when(number.isNull(), MISSING)
    for threshold, suffix in SCALE_SUFFIXES:
        text = text.when(
            F.abs(number) >= threshold,
            F.concat(
                F.lit("R$ "), _br_separators(F.format_number(number / F.lit(threshold), 1)), F.lit(f" {suffix}")
            ),
        )
    return text.otherwise(F.concat(F.lit("R$ "), _br_separators(F.format_number(number, 0))))


def compact_currency(value: Column) -> Column:
    """Short money text of the site: at most one decimal, ``,0`` dropped.

    The scale is chosen after rounding, so 999 950 reads as one million.
    """
    amount = F.coalesce(value.cast("decimal(30,2)"), F.lit(0).cast("decimal(30,2)"))
    size = F.abs(amount)

    def shown(power: int) -> Column:
        # Rounded exactly as a decimal, then scaled: one digit always fits.
        scaled = F.round(size, 1 - power).cast("double") / F.lit(float(10**power))
        return F.replace(
            F.regexp_replace(scaled.cast("decimal(30,1)").cast("string"), r"\.0$", ""), F.lit("."), F.lit(",")
        )

    text = (
        F.when(F.round(size, 1) < 1_000, shown(0))
        .when(F.round(size, -2) < 1_000_000, F.concat(shown(3), F.lit(f"{NBSP}mil")))
        .when(F.round(size, -5) < 1_000_000_000, F.concat(shown(6), F.lit(f"{NBSP}mi")))
        .when(F.round(size, -8) < 1_000_000_000_000, F.concat(shown(9), F.lit(f"{NBSP}bi")))
        .otherwise(F.concat(shown(12), F.lit(f"{NBSP}tri")))
    )
    return F.concat(F.when(amount < 0, "-").otherwise(""), F.lit(f"R${NBSP}"), text)


def full_currency(value: Column) -> Column:
    """Whole-real money text: ``R$ 1.234.568``."""
    amount = F.round(F.coalesce(value.cast("decimal(30,2)"), F.lit(0).cast("decimal(30,2)")), 0)
    digits = _br_separators(F.format_number(F.abs(amount), 0))
    # A negative amount that rounds to zero keeps its sign in the source format.
    negative = F.coalesce(value, F.lit(0)) < 0
    return F.concat(F.when(negative, "-").otherwise(""), F.lit(f"R${NBSP}"), digits)


def integer_text(value: Column) -> Column:
    return _br_separators(F.format_number(F.coalesce(value, F.lit(0)).cast("bigint"), 0))


def percent_text(ratio: Column) -> Column:
    """Whole percent, ``—`` when the ratio is undefined."""
    # Rounded before scaling: 0.285 * 100 is a little below 28.5 as a double.
    whole = F.round(F.round(ratio.cast("double"), 2) * 100, 0).cast("bigint")
    return F.when(ratio.isNull(), MISSING).otherwise(F.concat(_br_separators(F.format_number(whole, 0)), F.lit("%")))


def month_name(day: Column) -> Column:
    """``abril de 2024``."""
    names = F.array(*[F.lit(name) for name in MONTH_NAMES])
    return F.concat(F.element_at(names, F.month(day)), F.lit(" de "), F.date_format(day, "yyyy"))


def month_text(label: Column) -> Column:
    """The month name of a ``YYYY-MM`` label."""
    return month_name(F.to_date(label, "yyyy-MM"))


def short_label(acronym: Column, name: Column) -> Column:
    """The acronym, or the name where the acronym is null or empty."""
    return F.coalesce(F.nullif(acronym, F.lit("")), name)


def place_label(name: Column, acronym: Column) -> Column:
    return F.concat(name, F.lit(" ("), acronym, F.lit(")"))


def released_share(released: Column, total: Column) -> Column:
    """Released percentage of the total, 0 when there is no total."""
    share = F.coalesce(released.cast("double"), F.lit(0.0)) / F.nullif(total.cast("double"), F.lit(0.0)) * 100
    return F.coalesce(share, F.lit(0.0))


def election_label(election: Column) -> Column:
    return F.coalesce(election, F.lit(NO_ELECTION))


def showing_note(shown: Column, found: Column, noun: str, noun_plural: str) -> Column:
    """Which part of the filtered rows a chart shows."""
    part = F.format_string(NOTE_PART, integer_text(shown), integer_text(found), F.lit(noun_plural))
    return F.when(found > shown, part).otherwise(F.format_string(NOTE_ALL, integer_text(found), F.lit(noun)))


def table_note(shown: Column, found: Column) -> Column:
    """Which part of the authors the table lists."""
    part = F.format_string(TABLE_NOTE_PART, integer_text(shown), integer_text(found))
    return F.when(found > shown, part).otherwise(F.format_string(TABLE_NOTE_ALL, integer_text(found)))
