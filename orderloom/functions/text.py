"""Text scalars: Column in, Column out, all evaluated in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the message rules mean it: the Unicode property plus the four ASCII separators.
_WS = r"[\s\x1c-\x1f]"
_NOT_WS = r"[^\s\x1c-\x1f]"

# Fixed phrases of the remote system's replies. The code group is written without a nested
# repetition so that java.util.regex needs no recursion on very long messages.
MISSING_CODE = rf"(?U)Mã hàng{_WS}+({_NOT_WS}[\s\S]*?){_WS}+không tồn tại trong hệ thống"
DUPLICATE_DOCUMENT = rf"(?Ud)Chứng từ{_WS}+.+?{_WS}+đã nhập\."


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- repair of escaped text -------------------------------------------------------------------

_HEX_ESCAPE = r"\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}"
_NAME_ESCAPE = r"\\N\{[^}]+\}"
_OCTAL_ESCAPE = r"\\[0-7]{1,3}"
_ANY_ESCAPE = r"\\[\s\S]"
_TOKEN = rf"(?:{_HEX_ESCAPE}|{_NAME_ESCAPE}|{_OCTAL_ESCAPE}|{_ANY_ESCAPE}|[^\\]+|\\)"

# One-letter escapes and the byte they stand for (fixed values of the escape notation).
_LETTER_BYTES = {
    "\\\\": "5C", "\\'": "27", '\\"': "22", "\\a": "07", "\\b": "08", "\\f": "0C",
    "\\n": "0A", "\\r": "0D", "\\t": "09", "\\v": "0B", "\\\n": "",
}


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def _latin1_names() -> dict[str, str]:
    names = {}
    for cp in range(256):
        name = unicodedata.name(chr(cp), None)
        if name:
            names[name] = f"{cp:02X}"
    return names


def _token_hex(tok: Column) -> Column:
    """Bytes of one token as hex digits; NULL when the token cannot be one latin-1 byte."""
    kind = F.substring(tok, 1, 2)
    code_point = F.ltrim(F.substring(tok, 3, 8), F.lit("0"))
    octal = F.conv(F.substring(tok, 2, 3), 8, 10).cast("int")
    return (
        F.when(~tok.startswith("\\"), F.hex(F.encode(tok, "UTF-8")))
        .when(tok == "\\", F.lit(None))
        .when(tok.rlike(rf"^(?:{_HEX_ESCAPE})$"),
              F.when(F.length(code_point) <= 2, F.lpad(F.upper(code_point), 2, "0")))
        .when(tok.rlike(rf"^(?:{_NAME_ESCAPE})$"),
              F.try_element_at(_literal_map(_latin1_names()),
                               F.upper(F.regexp_extract(tok, r"^\\N\{([^}]+)\}$", 1))))
        .when(tok.rlike(rf"^(?:{_OCTAL_ESCAPE})$"),
              F.when(octal < 256, F.lpad(F.hex(octal), 2, "0")))
        .when(kind.isin("\\x", "\\u", "\\U", "\\N"), F.lit(None))
        .otherwise(F.coalesce(F.try_element_at(_literal_map(_LETTER_BYTES), tok),
                              F.hex(F.encode(tok, "UTF-8"))))
    )


def repair_escapes(text) -> Column:
    r"""Undo one layer of backslash escapes over UTF-8 bytes (``\xc3\xa3`` -> ``ã``).

    Every escape must name one byte and the bytes must form UTF-8, else the input comes back
    unchanged. Text without a backslash is its own result and skips the work.
    """
    text = _col(text)
    parts = F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), _token_hex)
    whole = F.when(~F.exists(parts, lambda p: p.isNull()), F.array_join(parts, ""))
    decoded = F.try_validate_utf8(F.unhex(whole).cast("string"))
    return F.when(~F.contains(text, F.lit("\\")), text).otherwise(F.coalesce(decoded, text))


# --- patterns ---------------------------------------------------------------------------------

def extract_missing_codes(text) -> Column:
    """Sorted distinct product codes that the text reports as unknown."""
    return F.array_sort(F.array_distinct(codes_in_order(text)))


def codes_in_order(text) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(MISSING_CODE), F.lit(1))


def is_duplicate_document(text) -> Column:
    return _col(text).rlike(DUPLICATE_DOCUMENT)


# --- headers ----------------------------------------------------------------------------------

_TONES = ["", "\u0301", "\u0300", "\u0309", "\u0303", "\u0323"]
_VOWELS = {"a": "aâă", "e": "eê", "i": "i", "o": "oôơ", "u": "uư", "y": "y"}


def _accent_table() -> tuple[str, str]:
    source, target = "đ", "d"
    for plain, shapes in _VOWELS.items():
        for shape in shapes:
            for tone in _TONES:
                letter = unicodedata.normalize("NFC", shape + tone)
                if letter != plain:
                    source += letter
                    target += plain
    return source, target


ACCENTED, PLAIN = _accent_table()


def normalize_header(name) -> Column:
    plain = F.translate(F.lower(_col(name)), ACCENTED, PLAIN)
    return F.regexp_replace(plain, "[^a-z0-9]", "")


# --- similarity -------------------------------------------------------------------------------

def edit_distance(a, b) -> Column:
    return F.levenshtein(F.coalesce(_col(a), F.lit("")), F.coalesce(_col(b), F.lit("")))


def similarity(a, b) -> Column:
    a, b = F.coalesce(_col(a), F.lit("")), F.coalesce(_col(b), F.lit(""))
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(a, b) / longest).otherwise(F.lit(0.0))
