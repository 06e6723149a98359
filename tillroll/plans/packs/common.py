"""Date shapes shared by the rule modules."""

from __future__ import annotations

# Date shapes, day first unless the name says otherwise. Months are three letters here:
# longer and Indonesian names are shortened before. Brackets mark what may be missing.
SECONDS = ("d MMM yyyy H:mm:ss",)
MINUTES = ("d MMM yyyy H:mm",)
COMMA_MINUTES = ("d MMM yyyy, H:mm",)
SHORT_YEAR = ("d MMM yy H:mm",)
DAY = ("d MMM yyyy",)
DAY_OR_MINUTES = ("d MMM yyyy[ H:mm]",)
ANY_YEAR = ("d MMM yy[, H:mm[:ss]]", "d MMM yyyy[, H:mm[:ss]]")
MONTH_DAY = ("MMM d, yyyy",)
MONTH_DAY_SECONDS = ("MMM d, yyyy H:mm:ss",)
SLASH_DAY = ("dd/MM/yyyy",)
SLASH_MONTH = ("MM/dd/yyyy",)
ISO = ("yyyy-MM-dd H:mm:ss",)
CLOCK_12 = ("d MMM, yyyy h:mma",)

NO_TEXT = frozenset({"description"})
