"""Text to typed values. Every parser is total: unreadable text becomes NULL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelloom.functions.text import strip

# Fixed word lists for booleans.
TRUE_WORDS = ("true", "t", "yes", "y", "1", "x", "checked", "selected", "on")
FALSE_WORDS = ("false", "f", "no", "n", "0", "", "unchecked", "unselected", "off")

SERIAL_ORIGIN = "1899-12-30"


def number(column: Column) -> Column:
    """Messy amount to DOUBLE.

    Currency signs and names, blanks and other characters go; ``12,34`` is a decimal comma,
    ``1,234`` a thousands comma, and ``1.234,56`` has both the other way round; brackets mean a
    negative amount; a percentage is divided by 100.
    """
    bare = F.regexp_replace(column, "[^0-9.,()-]", "")
    negative = bare.rlike(r"^\(.*\)$")
    bare = F.translate(bare, "()", "")
    swapped = bare.rlike(r"^-?[0-9]{1,3}(?:\.[0-9]{3})+,[0-9]+$")
    bare = F.when(swapped, F.translate(bare, ",.", ".")).otherwise(
        F.regexp_replace(F.regexp_replace(bare, r",([0-9]{1,2})$", ".$1"), ",", "")
    )
    sign = F.when(negative, -1.0).otherwise(1.0)
    return sign * bare.try_cast("double") / F.when(column.contains("%"), 100.0).otherwise(1.0)


def percent_points(column: Column) -> Column:
    """``40 %`` as 40, for columns that store probabilities in points."""
    return number(F.regexp_replace(column, "%", ""))


def boolean(column: Column) -> Column:
    meaning = [(word, True) for word in TRUE_WORDS] + [(word, False) for word in FALSE_WORDS]
    lookup = F.create_map(*[F.lit(x) for pair in meaning for x in pair])
    return F.try_element_at(lookup, F.lower(strip(column)))


def _serial(column: Column) -> Column:
    """Day number as DOUBLE, NULL outside the range a calendar can express."""
    serial = column.try_cast("double")
    return F.when(serial.between(-657_434, 2_958_465), serial)


def serial_date(column: Column) -> Column:
    """Spreadsheet day number to DATE; any time fraction is cut off."""
    return F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), F.floor(_serial(column)).cast("int"))


def serial_timestamp(column: Column) -> Column:
    """Spreadsheet day number with a time fraction to a zone-free TIMESTAMP."""
    serial = _serial(column)
    hours = F.round((serial - F.floor(serial)) * 24, 6)
    seconds = F.floor(serial) * 86400 + hours * 3600
    # Clock arithmetic on a zone-free origin, so the session time zone has no say.
    micros = F.round(seconds * 1_000_000).cast("long")
    return F.timestamp_add("MICROSECOND", micros, F.lit(SERIAL_ORIGIN).cast("timestamp_ntz"))


def calendar_week(column: Column) -> dict[str, Column]:
    """``2020/7`` -> year 2020, week 7 (leading four digits, trailing one or two)."""
    return {
        "year": F.regexp_extract(column, "^[0-9]{4}", 0).try_cast("long"),
        "week": F.regexp_extract(column, "[0-9]{1,2}$", 0).try_cast("long"),
    }


_DIGITS = "0123456789"


def date_fields(column: Column) -> Column:
    """The parts of a date text, and the separators between the first three.

    Characters other than digits and separators are dropped. Splitting once per value
    keeps the candidate layouts cheap: they only rearrange the parts.
    """
    text = F.trim(F.regexp_replace(column, "[^0-9./: -]", ""))
    return _fields(text)


def timestamp_fields(column: Column) -> Column:
    return _fields(F.trim(column))


def _fields(text: Column) -> Column:
    return F.struct(
        F.split(text, "[-./]| +").alias("parts"),
        F.translate(F.substring_index(text, " ", 1), _DIGITS, "").alias("marks"),
    )


@dataclass(frozen=True)
class Layout:
    """A way of writing a date or timestamp: order of the parts and what must be present.

    Parts are put into ISO order and cast, which needs no session time zone and no format
    parser. ``clock`` is the punctuation of the time of day (``::``, ``:`` or nothing) and
    ``marks`` the separators of the date, if they matter.
    """

    name: str
    order: str
    clock: str = ""
    marks: str | None = None
    short_year: bool = False

    def _iso(self, fields: Column) -> Column:
        parts = fields["parts"]
        year, month, day = (F.get(parts, self.order.index(part)) for part in "ymd")
        fits = (F.size(parts) == (4 if self.clock else 3)) & (F.length(year) == (2 if self.short_year else 4))
        if self.marks is not None:
            fits = fits & (fields["marks"] == self.marks)
        if self.short_year:
            # Two-digit years: 00-68 belong to 20xx, 69-99 to 19xx.
            year = F.concat(F.when(year <= "68", "20").otherwise("19"), year)
        iso = F.concat_ws("-", year, month, day)
        if self.clock:
            time = F.get(parts, 3)
            fits = fits & (F.translate(time, _DIGITS, "") == self.clock)
            iso = F.concat_ws(" ", iso, time)
        return F.when(fits, iso)

    def _compact(self, fields: Column) -> Column:
        """Eight digits without separators."""
        text = F.get(fields["parts"], 0)
        widths = [4 if part == "y" else 2 for part in self.order]
        cuts = {part: F.substring(text, 1 + sum(widths[:i]), widths[i]) for i, part in enumerate(self.order)}
        whole = (F.size(fields["parts"]) == 1) & (F.length(text) == 8)
        return F.when(whole, F.concat_ws("-", cuts["y"], cuts["m"], cuts["d"]))

    def date(self, fields: Column) -> Column:
        if self.clock:
            return self.timestamp(fields).cast("date")
        return F.coalesce(self._iso(fields), self._compact(fields)).try_cast("date")

    def timestamp(self, fields: Column) -> Column:
        return self._iso(fields).try_cast("timestamp_ntz")


# Candidate layouts in the order in which they are tried.
DATE_LAYOUTS = (
    Layout("ymd", "ymd"),
    Layout("dmy", "dmy"),
    Layout("mdy", "mdy"),
    Layout("ydm", "ydm"),
    Layout("ymd_hms", "ymd", "::"),
    Layout("dmy_hms", "dmy", "::"),
    Layout("mdy_hms", "mdy", "::"),
    Layout("mdy2_hms", "mdy", "::", short_year=True),
    Layout("dmy2_hms", "dmy", "::", short_year=True),
)

TIMESTAMP_LAYOUTS = (
    Layout("ymd_hms_dash", "ymd", "::", "--"),
    Layout("dmy_hms_dash", "dmy", "::", "--"),
    Layout("mdy_hms_dash", "mdy", "::", "--"),
    Layout("ymd_hms_slash", "ymd", "::", "//"),
    Layout("dmy_hms_slash", "dmy", "::", "//"),
    Layout("mdy_hms_slash", "mdy", "::", "//"),
    # Looser reading: any separator, seconds optional.
    Layout("ymd_hms_any", "ymd", "::"),
    Layout("dmy_hms_any", "dmy", "::"),
    Layout("mdy_hms_any", "mdy", "::"),
    Layout("ymd_hm", "ymd", ":"),
    Layout("dmy_hm", "dmy", ":"),
    Layout("mdy_hm", "mdy", ":"),
)
