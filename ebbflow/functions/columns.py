"""Column expressions: cleaning, calendars and small numerics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented letters and their plain ones.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"

#: Segments in order of precedence; a label belongs to the first of whose groups it holds every keyword.
SEGMENTS = [
    ("epargne", [["EPARGNE"], ["LIVRET"]]),
    ("decouverts", [["DECOUVERT"], ["DEBITEUR"], ["VUE", "DEBIT"]]),
    ("hb_engagement", [["ENGAGEMENT"], ["FINANCEMENT"]]),
    ("vue_dinars", [["VUE", "DINAR"]]),
    ("vue_devises", [["VUE", "DEVISE"], ["VUE", "BU"]]),
    ("vue_other", [["VUE"]]),
    ("garantie", [["GARANTIE"]]),
]

#: French month names without accents.
FRENCH_MONTHS = ["janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre"]


def plain_upper(c: Column) -> Column:
    return F.upper(F.trim(F.translate(c, ACCENTED, PLAIN)))


def header_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.translate(c, ACCENTED, PLAIN)), "[^a-z0-9]", "")


def number(c: Column) -> Column:
    """A double out of `1 234,5`-like cells: spaces and commas go; blank, - and . are null."""
    return F.regexp_replace(c, "[  ,]", "").try_cast("double")


def month_int(year: Column, month: Column) -> Column:
    return (year * 12 + month - 1).cast("int")


def month_of(ts: Column) -> Column:
    return month_int(F.year(ts), F.month(ts))


def month_label(m: Column) -> Column:
    return F.format_string("%04d-%02d", (m / 12).cast("int"), (m % 12 + 1).cast("int"))


def opening_month(c: Column) -> Column:
    """Month number of a M/D/Y date: parts by / - or .; M and D change places if M > 12 >= D; years of two digits are 1950 to 2049."""
    part = F.split(F.trim(c), r"[/\-.]")
    m, d, y = (F.get(part, F.lit(i)).try_cast("int") for i in range(3))
    year = F.when(y < 50, y + 2000).when(y < 100, y + 1900).otherwise(y)
    month = F.when((m > 12) & (d <= 12), d).otherwise(m)
    ok = (F.size(part) == 3) & d.isNotNull() & year.isNotNull() & month.between(1, 12)
    return F.when(ok, month_int(year, month))


def file_month(name: Column) -> Column:
    """Month number from MMYYYY in a file's name."""
    m, y = (F.regexp_extract(name, r"(0[1-9]|1[0-2])(\d{4})", k).try_cast("int") for k in (1, 2))
    return month_int(y, m)


def path_month(path: Column) -> Column:
    """Month number from `EFM MM YYYY` in a path, else from a `...esultat... YYYY` folder and a folder named as a French month."""
    m, y = (F.regexp_extract(path, r"(?i)EFM[ _-]*(0[1-9]|1[0-2])[ _-]*(\d{4})", k).try_cast("int") for k in (1, 2))
    year = F.regexp_extract(path, r"(?i)esultat\S*[ _-]*(\d{4})", 1).try_cast("int")
    name = F.regexp_extract(F.lower(F.translate(path, ACCENTED, PLAIN)), r"/(?:\d+[ ._-]*)?(" + "|".join(FRENCH_MONTHS) + r")(?=/|$)", 1)
    month = F.array_position(F.array(*map(F.lit, FRENCH_MONTHS)), name).cast("int")
    return F.coalesce(month_int(y, m), F.when(month > 0, month_int(year, month)))


def segment_of(label: Column) -> Column:
    label, out = plain_upper(label), F
    for name, groups in SEGMENTS:
        hit = F.lit(False)
        for words in groups:
            own = F.lit(True)
            for w in words:
                own = own & label.contains(w)
            hit = hit | own
        out = out.when(hit, name)
    return out.otherwise("other")


#: Fixed values of the tabular calendar: days from its first day to 1970-01-01, days of 30 years.
ISLAMIC_EPOCH, ISLAMIC_CYCLE = 492148, 10631


def islamic(day: Column) -> tuple[Column, Column, Column]:
    """Year, month and day of a date in the tabular Islamic calendar (civil epoch): 11 of 30 years have a leap day.

    Year y begins 354 (y - 1) + floor((3 + 11 y) / 30) days after the epoch, its month m 29 (m - 1) + floor((6 m - 1) / 11)
    days later.
    """
    n = F.unix_date(day).cast("long") + ISLAMIC_EPOCH
    whole = lambda a, b: F.floor(a / b).cast("long")
    year = whole(30 * n + 10646, ISLAMIC_CYCLE)
    n = n - 354 * (year - 1) - whole(3 + 11 * year, 30)
    month = whole(11 * n + 330, 325)
    return year.cast("int"), month.cast("int"), (n - 29 * (month - 1) - whole(6 * month - 1, 11) + 1).cast("int")


def draw(n: Column | int, *key: Column) -> Column:
    """Uniform on 0..n-1, by integer arithmetic that any engine can repeat."""
    mixed = F.lit(0).cast("long")
    for k in key:
        mixed = (mixed * 1103515245 + k.cast("long") * 12345 + 1013904223) % 2147483647
    mixed = (mixed * 48271) % 2147483647
    mixed = (mixed * 48271) % 2147483647
    return mixed % n


def sigmoid(z: Column) -> Column:
    """Stable for large arguments of either sign."""
    return F.when(z >= 0, 1 / (1 + F.exp(-z))).otherwise(F.exp(z) / (1 + F.exp(z)))


def dot(values: Column, weights: Column) -> Column:
    return F.aggregate(F.zip_with(values, weights, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


#: Coefficients of Acklam's rational approximation of the normal inverse.
_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)


def _poly(x: Column, c: tuple) -> Column:
    out = F.lit(c[0])
    for k in c[1:]:
        out = out * x + k
    return out


def normal_quantile(p: Column) -> Column:
    tail = lambda q: _poly(q, _C) / (_poly(q, _D) * q + 1)
    low, high = F.sqrt(-2 * F.log(p)), F.sqrt(-2 * F.log(1 - p))
    q = p - 0.5
    mid = _poly(q * q, _A) * q / (_poly(q * q, _B) * (q * q) + 1)
    return F.when(p < 0.02425, tail(low)).when(p > 1 - 0.02425, -tail(high)).otherwise(mid)


def normal_cdf(x: Column) -> Column:
    """By a polynomial (7.1.26 of Abramowitz and Stegun), to 1.5e-7."""
    z = F.abs(x) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * z)
    erf = 1 - _poly(t, (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592)) * t * F.exp(-z * z)
    return F.when(x >= 0, (1 + erf) / 2).otherwise((1 - erf) / 2)
