"""Column functions: identifiers, hosts, names, claims, intervals."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Public suffixes of two labels that count as one.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.in", "co.jp", "co.nz", "co.uk", "com.au", "com.bh", "com.cn", "com.kw",
    "com.om", "com.qa", "com.sa", "com.tr", "edu.kw", "gov.kw", "net.kw", "org.kw", "org.uk",
)
#: Words of a company name that mean the same, and those that say nothing.
NAME_ALIASES = {"CO": "COMPANY", "CORP": "COMPANY", "CORPORATION": "COMPANY", "TELECOM": "TELECOMMUNICATIONS"}
NAME_IGNORED = ("THE", "KSC", "KSCP", "KPSC", "PUBLIC", "SHAREHOLDING", "CLOSED")
#: Query keys that carry a credential.
CREDENTIAL_KEYS = (
    "access_token", "apikey", "api_key", "auth", "authorization", "awsaccesskeyid", "bearer", "client_secret", "code", "cookie",
    "googleaccessid", "jwt", "oauth_token", "password", "passwd", "session", "sessionid", "sig", "signature", "token",
)
#: Parts of feature names that tell the future or the label.
FUTURE_TOKENS = ("future_", "forward_", "outcome", "target_hit", "realized_", "label_", "t_plus_")


def isin_is_valid(isin: Column) -> Column:
    """ISO 6166 shape and Luhn check over letters written as numbers; null stays null."""
    digits = F.regexp_replace(F.concat_ws("", F.transform(F.split(isin, ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c))), "[^0-9]", "")
    backwards = F.split(F.reverse(digits), "")
    doubled = F.transform(backwards, lambda d, i: F.when(i % 2 == 1, d.try_cast("int") * 2).otherwise(d.try_cast("int")))
    total = F.aggregate(doubled, F.lit(0).cast("long"), lambda a, d: a + F.when(d > 9, d - 9).otherwise(F.coalesce(d, F.lit(0))).cast("long"))
    return isin.rlike("^[A-Z]{2}[A-Z0-9]{9}[0-9]$") & (total % 10 == 0)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/:?#]+)", 1))


def registrable_domain(name: Column) -> Column:
    """Last two labels of a host, or three where the last two are a known suffix; dots around the host don't count.

    An address stays whole. A single label, an empty one, and null give null.
    Names with letters beyond ASCII are kept as they are written.
    """
    plain = F.regexp_replace(F.lower(F.trim(name)), r"^\.+|\.+$", "")
    address = plain.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") | F.contains(plain, F.lit(":"))
    labels = F.split(plain, "\\.")
    last = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), F.lit(n)), ".")
    short = (F.size(labels) < 2) | F.array_contains(labels, "")
    return F.when(address, F.regexp_replace(plain, r"[\[\]]", "")).when(short, None).when(last(2).isin(*TWO_LABEL_SUFFIXES), last(3)).otherwise(last(2))


def name_tokens(name: Column) -> Column:
    """Distinct upper-case words of a company name, aliases resolved, without those that say nothing."""
    words = F.split(F.trim(F.regexp_replace(F.upper(name), "[^A-Z0-9]+", " ")), " +")
    alias = F.create_map(*[F.lit(x) for p in NAME_ALIASES.items() for x in p])
    return F.array_distinct(F.transform(F.filter(words, lambda w: ~w.isin("", *NAME_IGNORED)), lambda w: F.coalesce(F.try_element_at(alias, w), w)))


def credential_keys(url: Column) -> Column:
    """True if a query key of the address can carry a credential.

    Hyphens count as underscores. The listed names hold with and without
    underscores; endings such as ``_token`` need theirs: ``mytoken`` is none.
    """
    pairs = F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&")
    name = lambda p: F.regexp_extract(p, "^[^=]*", 0)
    keys = F.transform(pairs, lambda p: F.translate(F.lower(F.trim(F.coalesce(F.try_url_decode(name(p)), name(p)))), "-", "_"))
    bare = lambda k: F.translate(k, "_", "")
    known = sorted({k.replace("_", "") for k in CREDENTIAL_KEYS})
    return F.exists(keys, lambda k: bare(k).isin(*known) | bare(k).rlike("^x(amz|goog)") | k.rlike("access_token|client_secret|_(token|secret|credential|signature)$"))


def names_compatible(a: Column, b: Column) -> Column:
    """Equal tokens, also none on both sides, or an overlap of at least 0.8 of the smaller set."""
    x, y = name_tokens(a), name_tokens(b)
    smaller = F.least(F.size(x), F.size(y))
    return F.when(x == y, True).when(smaller == 0, False).otherwise(F.size(F.array_intersect(x, y)) >= 0.8 * smaller)


def _ranges(points: Iterable[int], gap: int = 16) -> str:
    """A character class of the ranges these lie in; neighbours within the gap share one."""
    out: list[list[int]] = []
    for i in sorted(points):
        if out and i - out[-1][1] <= gap:
            out[-1][1] = i
        else:
            out.append([i, i])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in out) + "]"


@lru_cache(maxsize=1)
def _may_change() -> str:
    """A pattern that finds any character that NFKC may change: forms of others, marks that are ordered, and what joins with the character before it."""
    found = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}  # vowels and finals of Hangul syllables
    for i in (*range(0xA0, 0xD800), *range(0xE000, 0x110000)):
        c = chr(i)
        if unicodedata.combining(c) or unicodedata.normalize("NFKC", c) != c:
            found.add(i)
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(int(parts[1], 16))
    # hundreds of ranges are tried one after the other, so only where the one before them holds: all found are U+00A0 or above
    return r"(?=[^\x00-\x9f])" + _ranges(found)


@lru_cache(maxsize=1)
def _nfkc():
    # the function travels with the plan, so workers need nothing of this library
    def normalised(texts: pd.Series) -> pd.Series:
        import unicodedata

        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return F.pandas_udf(normalised, T.StringType())


def compatible(text: Column) -> Column:
    """The text in Unicode's form NFKC: compatibility forms replaced, marks in order, and composed.

    Spark has no such function, so texts that may change go through Arrow to
    Python's Unicode tables; all others, most of them, are nulls on that way and stay as they are.
    """
    return F.coalesce(_nfkc()(F.when(text.rlike(_may_change()), text)), text)


def claim_tokens(text: Column) -> Column:
    """Distinct words of three characters or more, without addresses and Arabic marks, with letter forms folded."""
    t = F.regexp_replace(F.lower(compatible(text)), r"https?://\S+", " ")
    # one pass for each form: translate() looks up every character as a string of its own
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "[ً-ٰٟـ]", ""), "[أإآ]", "ا"), "ى", "ي")
    # \w holds a-z0-9_ too, but asks for them last
    return F.array_distinct(F.regexp_extract_all(t, F.lit(r"(?U)[a-z0-9_\w؀-ۿ]{3,}"), F.lit(0)))


def folded(text: Column) -> Column:
    """Lower case, no-break and repeated white space as one space."""
    return F.trim(F.regexp_replace(F.lower(F.translate(text, " ", " ")), r"\s+", " "))


def wilson(hits: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Bounds of the 95 % Wilson interval within [0, 1]; null without trials."""
    p = hits / n
    centre = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z / (1 + z * z / n) * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.when(n > 0, F.greatest(F.lit(0.0), centre - half)), F.when(n > 0, F.least(F.lit(1.0), centre + half))


def direction(value: Column, band: float) -> Column:
    return F.when(value > band, "POSITIVE").when(value < -band, "NEGATIVE").otherwise("NEUTRAL")


def scaled_round(value: Column, places: int) -> Column:
    """A double rounded as SQL engines round it: scaled up, to the nearest whole number, scaled down.

    ``F.round`` rounds the decimal text of a double: 200.00005 is 200.0001 there
    at four places and 200.0 here, as the double times 10,000 is 2000000.4999999998.
    """
    scale = float(10**places)
    return F.round(value * scale) / scale


def signed(direction_: Column) -> Column:
    return F.when(direction_ == "POSITIVE", 1.0).when(direction_ == "NEGATIVE", -1.0).otherwise(0.0)


def codes(*rules: tuple[Column, str]) -> Column:
    """The codes of the rules that hold, in order; a rule on null does not hold."""
    return F.array_compact(F.array(*[F.when(test, code) for test, code in rules]))
