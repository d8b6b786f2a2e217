"""Text repair and text for KPI cards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cp1252_specials() -> tuple[str, str]:
    """The 27 characters that Windows-1252 puts at 0x80-0x9F, and the control codes there."""
    specials, controls = "", ""
    for code in range(0x80, 0xA0):
        try:
            specials += bytes([code]).decode("cp1252")
        except UnicodeDecodeError:  # five positions are not assigned
            continue
        controls += chr(code)
    return specials, controls


_SPECIALS, _CONTROLS = _cp1252_specials()


def repair_encoding(column: str | Column) -> Column:
    """Undo UTF-8 that was once read as Windows-1252.

    The characters are turned back into the bytes they came from, and those bytes are
    read as UTF-8. A value that has no Windows-1252 bytes, or whose bytes are not valid
    UTF-8, comes back unchanged.
    """
    value = F.col(column) if isinstance(column, str) else column
    latin = F.translate(value, _SPECIALS, _CONTROLS)
    # as many bytes as characters: plain ASCII, which has nothing to repair
    plain = F.octet_length(value) == F.char_length(value)
    encodable = ~value.rlike("[\\x{80}-\\x{9F}]") & ~latin.rlike("[^\\x{00}-\\x{FF}]")
    # the bytes are taken only where every character fits, as encode() raises otherwise
    octets = F.encode(F.when(encodable, latin), "ISO-8859-1")
    return F.when(plain, value).otherwise(F.coalesce(F.try_validate_utf8(octets.cast("string")), value))


def misread_as_cp1252(column: str | Column) -> Column:
    """The damage that `repair_encoding` undoes; NULL where Windows-1252 cannot hold it."""
    value = F.col(column) if isinstance(column, str) else column
    latin = F.decode(F.encode(value, "UTF-8"), "ISO-8859-1")
    unassigned = latin.rlike("[\\x{81}\\x{8D}\\x{8F}\\x{90}\\x{9D}]")
    plain = F.octet_length(value) == F.char_length(value)
    return F.when(plain, value).when(~unassigned, F.translate(latin, _CONTROLS, _SPECIALS))


def kpi_card(amount: str | Column, change: str | Column, currency: str = "R$") -> Column:
    """Money, an arrow and the change in percent; a missing change counts as not negative."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    change = F.col(change) if isinstance(change, str) else change
    money = F.concat(F.lit(f"{currency} "), F.format_number(F.round(amount, 2), 2))
    arrow = F.when(change < 0, F.lit("▼")).otherwise(F.lit("▲"))
    percent = F.concat(F.round((change * 100).cast("decimal(18,6)"), 1).cast("string"), F.lit("%"))
    return F.concat(F.coalesce(money, F.lit("")), F.lit("  "), arrow, F.lit(" "), F.coalesce(percent, F.lit("")))
