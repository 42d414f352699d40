"""Identifier and code-system rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- F1: zero-padded numeric ids -------------------------------------------------

def pad_id(x, width: int) -> Column:
    """Lenient pad: digits of length <= width are left-padded, anything else passes
    through trimmed so a later format check can flag it (``lpad`` alone would truncate)."""
    s = F.trim(_c(x).cast("string"))
    return F.when(s.rlike(rf"^[0-9]{{1,{width}}}$"), F.lpad(s, width, "0")).otherwise(s)


def pad_id_strict(x, width: int) -> Column:
    """Strict pad: NULL when the input is non-numeric or longer than ``width``."""
    s = F.trim(_c(x).cast("string"))
    return F.when(s.rlike(rf"^[0-9]{{1,{width}}}$"), F.lpad(s, width, "0"))


def digits_only(x) -> Column:
    """Strip every non-digit character."""
    return F.regexp_replace(_c(x).cast("string"), r"[^0-9]", "")


# --- F2 / F8: parents by prefix ----------------------------------------------------

def prefix(x, n: int) -> Column:
    return F.substring(_c(x), 1, n)


# --- F3: positional key decode ------------------------------------------------------

# Body length after the leading "G" and the kept character spans
# (1-based start, length) per level, separators dropped.
POSITIONAL_LEVELS = {
    "state": (3, [(1, 2)]),
    "county": (7, [(1, 2), (4, 3)]),
    "tract": (13, [(1, 2), (4, 3), (8, 6)]),
    "zcta": (5, [(1, 5)]),
    "bg": (14, [(1, 2), (4, 3), (8, 6), (14, 1)]),
    "block": (17, [(1, 2), (4, 3), (8, 6), (14, 4)]),
}


def positional_decode(key, level) -> Column:
    """Decode a ``G``-prefixed positional key into the plain id for its level.
    NULL when the key is malformed for the level or the level is unknown."""
    g = F.upper(F.trim(_c(key)))
    body = F.substr(g, F.lit(2))
    lvl = _c(level)
    out = None
    for name, (blen, spans) in POSITIONAL_LEVELS.items():
        ok = (lvl == name) & g.startswith("G") & (F.length(body) == blen) & body.rlike(r"^[0-9]+$")
        val = F.concat(*[F.substring(body, s, n) for s, n in spans])
        out = F.when(ok, val) if out is None else out.when(ok, val)
    return out


# --- F5: segment-padded codes -------------------------------------------------------

def segment_pad(x, widths: tuple[int, ...]) -> Column:
    """Split on '-', left-pad each segment to its width, concatenate.
    NULL on wrong segment count, a non-digit segment or an over-long segment."""
    parts = F.split(F.trim(_c(x)), "-")
    ok = F.size(parts) == len(widths)
    for i, w in enumerate(widths):
        ok = ok & F.get(parts, i).rlike(rf"^[0-9]{{1,{w}}}$")
    padded = F.concat(*[F.lpad(F.get(parts, i), w, "0") for i, w in enumerate(widths)])
    return F.when(ok, padded)


# --- F6: dotted codes ---------------------------------------------------------------

def dotted(x, category_len: int = 3, e_category_len: int | None = None, upper: bool = True) -> Column:
    """Strip, (upper-case), drop dots, re-insert one dot after the category.
    ``e_category_len`` gives the category length for codes starting with 'E'."""
    s = F.trim(_c(x))
    if upper:
        s = F.upper(s)
    s = F.replace(s, F.lit("."), F.lit(""))
    cat = F.lit(category_len)
    if e_category_len is not None:
        cat = F.when(s.startswith("E"), F.lit(e_category_len)).otherwise(cat)
    return F.when(F.length(s) <= cat, s).otherwise(
        F.concat(s.substr(F.lit(1), cat), F.lit("."), F.substr(s, cat + 1)))


# --- F7: format validators (fixed values: the published code shapes) ----------------

CODE_PATTERNS = {
    "icd10cm": r"^[A-Z][0-9A-Z]{2}(\.[0-9A-Z]{1,4})?$",
    "icd9cm": r"^(\d{3}(\.\d{1,2})?|V\d{2}(\.\d{1,2})?|E\d{3}(\.\d)?)$",
    "icd9_procedure": r"^\d{2}(\.\d{1,2})?$",
    "icd10pcs": r"^[0-9A-HJ-NP-Z]{7}$",
}


def matches(x, system: str) -> Column:
    return _c(x).rlike(CODE_PATTERNS[system])


# --- F9: Verhoeff check digit -------------------------------------------------------

def _verhoeff_tables() -> tuple[list[int], list[int]]:
    """Dihedral group D5 multiplication table and the position permutation table,
    built from their defining rules (flattened row-major, 10 columns)."""
    d = []
    for j in range(10):
        for k in range(10):
            if j < 5 and k < 5:
                d.append((j + k) % 5)
            elif j < 5:
                d.append(5 + (j + k) % 5)
            elif k < 5:
                d.append(5 + (j - k) % 5)
            else:
                d.append((j - k) % 5)
    sigma = [1, 5, 7, 6, 2, 8, 3, 0, 9, 4]  # fixed value: the Verhoeff base permutation
    rows = [list(range(10))]
    for _ in range(7):
        rows.append([sigma[v] for v in rows[-1]])
    p = [v for row in rows for v in row]
    return d, p


def verhoeff_valid(x) -> Column:
    """All digits, length 6-18, no leading zero, Verhoeff checksum 0."""
    d, p = _verhoeff_tables()
    s = _c(x)
    dlit = F.array(*[F.lit(v) for v in d])
    plit = F.array(*[F.lit(v) for v in p])
    rev = F.reverse(s)
    n = F.length(s)

    def step(c, i):
        digit = F.substring(rev, i + 1, 1).cast("int")
        pv = F.element_at(plit, (i % 8) * 10 + digit + 1)
        return F.element_at(dlit, c * 10 + pv + 1)

    checksum = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step)
    shape = s.rlike(r"^[1-9][0-9]{5,17}$")
    return F.when(shape, checksum == 0).otherwise(F.lit(False))


# --- F10: trailing tag ----------------------------------------------------------------

def trailing_tag(x) -> Column:
    """Text inside the last ``(...)`` at the end of the string, trimmed; '' if none."""
    return F.trim(F.regexp_extract(_c(x), r"\(([^()]+)\)\s*$", 1))


# --- F11: label normaliser ----------------------------------------------------------

def snake_label(x) -> Column:
    """Trim, collapse runs of whitespace/hyphens to '_', lower-case."""
    return F.lower(F.regexp_replace(F.trim(_c(x)), r"[\s\-]+", "_"))


# --- F12: accent-insensitive name key ---------------------------------------------

def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def name_key(x) -> Column:
    """Compatibility decomposition without combining marks, lower-cased; runs of anything
    but a-z and 0-9 become one space; empty -> NULL.

    No built-in decomposes, so the two tables below state its outcome for every character
    that yields an ASCII letter or digit. ASCII texts skip both. ``translate``, a hashed lookup, handles
    one-to-one forms and drops marks, and also tells which texts hold a form of several characters (ligature,
    fraction); in those, each character beyond ASCII is looked up by its place in the table."""
    many = "".join(MULTI_FORMS)
    outcomes = F.array(*[F.lit(v) for v in MULTI_FORMS.values()])

    def spelled(s: Column) -> Column:
        one = lambda ch: F.when(ch < "\x80", ch).otherwise(
            _bind(F.instr(F.lit(many), ch), lambda at: F.when(at > 0, F.element_at(outcomes, at)).otherwise(ch)))
        return F.array_join(F.transform(F.split(s, ""), one), "")

    def plain(s: Column) -> Column:
        whole = F.when(F.translate(s, many, "") != s, spelled(s)).otherwise(s)
        return F.when(F.octet_length(s) == F.char_length(s), s).otherwise(F.translate(whole, SINGLE_FORMS + MARKS, SINGLE_BASES))

    key = F.trim(F.regexp_replace(F.lower(plain(_c(x))), r"[^a-z0-9]+", " "))
    return _bind(key, lambda k: F.when(k != "", k))


def _decomposed_forms() -> tuple[str, str, str, dict[str, str]]:
    """From the Unicode database: characters with a one-character ASCII outcome, these outcomes,
    all combining marks, and characters whose outcome is longer."""
    import sys
    import unicodedata
    one, base, marks, many = [], [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.combining(ch):
            marks.append(ch)
            continue
        if not unicodedata.decomposition(ch):
            continue
        out = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if not out:  # made of marks alone
            marks.append(ch)
            continue
        ascii_only = "".join(c if c.isascii() and c.isalnum() else " " for c in out)
        if not ascii_only.strip():
            continue
        if len(out) == 1:
            one.append(ch)
            base.append(out)
        else:
            many[ch] = ascii_only
    return "".join(one), "".join(base), "".join(marks), many


SINGLE_FORMS, SINGLE_BASES, MARKS, MULTI_FORMS = _decomposed_forms()


# --- F13 / F14: ISO code checks -------------------------------------------------------

# Territory codes that are not real ISO 3166-1 entries.
NON_ISO_GID0 = ("XKO", "XNC", "XAD", "XCA", "XCL", "XPI", "XSP")


def alpha_code(x, n: int) -> Column:
    """Upper-cased, trimmed n-letter code, NULL when not exactly n letters."""
    s = F.upper(F.trim(_c(x)))
    return F.when(s.rlike(rf"^[A-Z]{{{n}}}$"), s)


def numeric3(x) -> Column:
    return pad_id_strict(x, 3)


def is_iso_gid0(x) -> Column:
    s = _c(x)
    return (F.coalesce(s.rlike(r"^[A-Z]{3}$"), F.lit(False))
            & ~s.isin(*NON_ISO_GID0) & ~s.startswith("X"))


def subdivision_parts(x) -> tuple[Column, Column]:
    """``AA-LLL`` -> (alpha2, local); both NULL when malformed."""
    s = F.upper(F.trim(_c(x)))
    ok = s.rlike(r"^[A-Z]{2}-[A-Z0-9]{1,3}$")
    return F.when(ok, F.substring_index(s, "-", 1)), F.when(ok, F.substring_index(s, "-", -1))


def dashed_subdivision(x) -> Column:
    """``AA.LLL`` (dots) as ``AA-LLL``; NULL unless two letters and one to three letters or digits."""
    s = F.upper(F.trim(_c(x)))
    return F.when(s.rlike(r"^[A-Z]{2}\.[A-Z0-9]{1,3}$"), F.translate(s, ".", "-"))


def subdivision_code(dotted_col, dashed_col) -> Column:
    """One code of a subdivision: its dotted spelling if well formed, else its dashed one."""
    s = F.upper(F.trim(_c(dashed_col)))
    return F.coalesce(dashed_subdivision(dotted_col), F.when(s.rlike(r"^[A-Z]{2}-[A-Z0-9]{1,3}$"), s))


# --- F15: level implied by dot count ------------------------------------------------

def dot_level(x) -> Column:
    s = F.trim(_c(x))
    return (F.length(s) - F.length(F.replace(s, F.lit("."), F.lit("")))).cast("int")


# --- F16: combined codes without rounding ------------------------------------------

def primary_code(x) -> Column:
    """Integer part of a (possibly dotted) code."""
    s = F.trim(_c(x).cast("string"))
    return F.substring_index(s, ".", 1).try_cast("int")


def secondary_code(x) -> Column:
    """Dotted secondary code: ``10`` -> ``10.0``; ``99``/``99.x`` -> ``99``; no rounding."""
    s = F.trim(_c(x).cast("string"))
    whole = F.substring_index(s, ".", 1).try_cast("int")
    frac = F.when(F.instr(s, ".") > 0, F.substr(s, F.instr(s, ".") + 1)).otherwise(F.lit("0"))
    return F.when(s == "", None).when(whole == 99, F.lit("99")).otherwise(
        F.concat(whole.cast("string"), F.lit("."), frac))


# --- F17: Y/N flag ---------------------------------------------------------------------

def yn_bool(x) -> Column:
    return F.coalesce(F.upper(F.trim(_c(x))) == "Y", F.lit(False))


# --- P6 / M2: nullish tokens and lenient numbers ----------------------------------------

# Tokens that mean "no value".
NULLISH_TOKENS = ("", "na", "n/a", "null", "none", ".")


def is_nullish(x) -> Column:
    return F.coalesce(F.lower(F.trim(_c(x))).isin(*NULLISH_TOKENS), F.lit(True))


def clean_text(x) -> Column:
    """Trimmed text, NULL when nullish."""
    return F.when(~is_nullish(x), F.trim(_c(x)))


def lenient_double(x) -> Column:
    """Thousands separators dropped; nullish, non-numeric and NaN -> NULL."""
    s = F.regexp_replace(F.trim(_c(x).cast("string")), ",", "")
    v = s.try_cast("double")
    return F.when(~is_nullish(x) & ~F.isnan(F.coalesce(v, F.lit(0.0))), v)


# --- F19: range suffix ---------------------------------------------------------------

def strip_range_suffix(x) -> Column:
    return F.trim(F.regexp_replace(_c(x), r"\s*\([A-Z0-9][A-Z0-9.\-]*\)\s*$", ""))


# --- G2: namespace:value tags ---------------------------------------------------------

def tag_namespace(x) -> Column:
    s = _c(x)
    ok = (F.instr(s, ":") > 1) & (F.instr(s, ":") < F.length(s))
    return F.when(ok, F.substring_index(s, ":", 1))


def tag_value(x) -> Column:
    s = _c(x)
    ok = (F.instr(s, ":") > 1) & (F.instr(s, ":") < F.length(s))
    return F.when(ok, F.substr(s, F.instr(s, ":") + 1))
