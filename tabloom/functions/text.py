"""Text expressions: cleaning, tokens, shingles, similarity, search predicates."""

from __future__ import annotations

import html
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that carry no information in a record's title.
TITLE_STOP_WORDS = (
    "a an and as at by for from in into of on or the to with under using act acts agency agencies federal rule "
    "rulemaking regulation regulations regulatory program programs notice notices request requests proposed proposal "
    "proposals final standards requirements implementation"
).split()

#: Frequent English words left out of word counts.
ENGLISH_STOP_WORDS = (
    "the a an and or but in on at to for of with by from is are was were be been this that these those i we you it they "
    "my our your as not have has will would should could can all any if so do does"
).split()

#: Pairs of words left out of bigram counts.
STOP_BIGRAMS = ("the the", "of the", "in the", "to the", "and the", "for the", "this is", "that the")

#: Normalised titles that say nothing of their record.
BOILERPLATE_TITLES = (
    r"^agency information collection",
    r"^submission for omb review",
    r"^proposed collection comment request$",
    r"^notice of request for (extension|revision)",
    r"^notice and request for comments$",
    r"^notice request for comments$",
    r"^semiannual regulatory agenda",
    r"^unified agenda",
    r"^privacy act",
    r"^meetings sunshine act",
    r"^ses performance review board",
    r"^senior executive service performance review board membership$",
    r"^civil monetary penalty inflation adjustment$",
    r"^civil monetary penalty adjustments for inflation$",
    r"^civil penalties inflation adjustments$",
    r"^freedom of information act$",
    r"^freedom of information act regulations$",
    r"^notice of proposed rulemaking$",
    r"^notice of proposed rulemaking .*request for comments$",
    r"^advance notice of proposed rulemaking.*request for comments$",
    r"^.*petition for rulemaking$",
    r"^.*request for comments$",
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(c: Column | str) -> Column:
    """An id without double quotes around it; other white space stays."""
    return F.btrim(col(c), F.lit('"'))


#: Frequent character references, which are decoded without leaving the JVM.
FREQUENT_REFERENCES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&#x27;": "'", "&#34;": '"', "&nbsp;": "\xa0", "&#160;": "\xa0", "&middot;": "\xb7", "&copy;": "\xa9", "&reg;": "\xae", "&sect;": "\xa7",
    "&ndash;": "\u2013", "&mdash;": "\u2014", "&lsquo;": "\u2018", "&rsquo;": "\u2019", "&ldquo;": "\u201c", "&rdquo;": "\u201d", "&hellip;": "\u2026", "&bull;": "\u2022", "&#8217;": "\u2019", "&#8220;": "\u201c", "&#8221;": "\u201d",
}

#: A character reference with its semicolon.
REFERENCE = "&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def unescape_html(c: Column | str, terminated: bool = False) -> Column:
    """Character references decoded, named ones by the full HTML table and numeric ones.

    With terminated, only those that end with a semicolon: what a text that was cut within
    a reference has left of it ("&amp" at its end) stays as it is.
    Frequent ones are replaced by expressions; only texts with others go to Python, in
    Arrow batches. An ampersand comes last, so that what it gives isn't decoded again.
    """
    @F.pandas_udf("string")
    def unescaped(texts: pd.Series) -> pd.Series:
        import re
        from html.entities import html5

        whole = lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0]
        return texts.map((lambda t: re.sub(REFERENCE, whole, t)) if terminated else html.unescape, na_action="ignore")

    has = col(c).contains("&")
    plain = reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), FREQUENT_REFERENCES.items(), col(c))
    # after an ampersand that is none of these, whatever follows "&amp;" counts too: texts may be sent in vain, never missed
    left = F.replace(plain, F.lit("&amp;"), F.lit(" "))
    other = left.rlike(REFERENCE) if terminated else left.rlike("&[#A-Za-z0-9]") | col(c).rlike("&#[xX0-9]+[^;xX0-9a-fA-F]|&#[xX0-9a-fA-F]+$")
    rare = has & other
    return F.when(~has, col(c)).when(rare, unescaped(F.when(rare, col(c)))).otherwise(F.replace(plain, F.lit("&amp;"), F.lit("&")))


def clean_html(c: Column | str, terminated: bool = False) -> Column:
    """Decode references, turn tags into spaces, collapse white space; null and empty give ''."""
    return collapse(F.regexp_replace(unescape_html(F.coalesce(col(c), F.lit("")), terminated), "<[^>]+>", " "))


def collapse(c: Column | str) -> Column:
    return F.btrim(F.regexp_replace(col(c), r"[\s ]+", " "))


def blank_to_null(c: Column | str) -> Column:
    return F.when(F.btrim(col(c)) != "", col(c))


def joined_text(*cs: Column | str, sep: str = " ") -> Column:
    """The parts that aren't blank, joined; for embeddings and full-text indexes."""
    return F.concat_ws(sep, *(F.when(F.btrim(col(c)) != "", F.btrim(col(c))) for c in cs))


def normalised(c: Column | str) -> Column:
    """Lower case, with runs of other characters than a-z and 0-9 as single spaces."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9]+", " "))


def tokens(c: Column | str) -> Column:
    """The words of a normalised text."""
    return F.filter(F.split(normalised(c), " "), lambda w: w != "")


def informative_tokens(c: Column | str, stop: list[str] = TITLE_STOP_WORDS, min_length: int = 3) -> Column:
    return F.filter(tokens(c), lambda w: (F.length(w) >= min_length) & ~w.isin(*stop))


def shingles(words: Column | str, k: int) -> Column:
    """The distinct k-word shingles of an array, sorted; none if it is shorter."""
    w = col(words)
    at = F.when(F.size(w) >= k, F.sequence(F.lit(1), F.size(w) - (k - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_sort(F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice(w, i, k), " "))))


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Of two sets as arrays; zero if either is empty."""
    a, b = col(a), col(b)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def contains_any(c: Column | str, needles, ignore_case: bool = True) -> Column:
    """Whether any of the needles stands in the text; false for null."""
    x = F.lower(col(c)) if ignore_case else col(c)
    hits = [x.contains(n.lower() if ignore_case else n) for n in needles]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False)) if hits else F.lit(False)


def search_any(columns, needle: str) -> Column:
    """Whether the needle stands, as it is but for case, in any of the columns."""
    return reduce(lambda a, b: a | b, (contains_any(c, [needle]) for c in columns))


def is_boilerplate(normal_title: Column | str, patterns=BOILERPLATE_TITLES) -> Column:
    return col(normal_title).rlike("|".join(f"(?:{p})" for p in patterns))


def preview(c: Column | str, n: int) -> Column:
    return F.left(col(c), F.lit(n))


def letters(c: Column | str, least: int) -> Column:
    """All runs of at least so many letters a-z between word boundaries, lower case; letters and digits of any script are parts of words."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(rf"(?U)\b([a-z]{{{least},}})\b"), 1)


def as_text(c: Column, kind: str) -> Column:
    """A scalar as Python's str would write it, null staying null: True, 1.0."""
    if kind == "boolean":
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if kind in ("float", "double"):
        return _float_text(c.cast("double"))
    return c.cast("string")


def _float_text(x: Column) -> Column:
    """A double as Python writes it: digits and an exponent from 1e16 on and below 1e-4, else plain. The digits
    are the JVM's, which before version 19 writes one too many for a few numbers."""
    own = F.abs(x).cast("string")  # the same digits, with an exponent from 1e7 on and below 1e-3
    digits = F.regexp_replace(F.replace(F.substring_index(own, "E", 1), F.lit("."), F.lit("")), "0+$", "")
    n = F.substring_index(own, "E", -1).cast("int")
    sign = F.when((x < 0) | ((x == 0) & (x.cast("string") == "-0.0")), F.lit("-")).otherwise(F.lit(""))
    many = F.length(digits)
    whole = F.when(many <= n + 1, F.concat(F.rpad(digits, n + 1, F.lit("0")), F.lit(".0"))).otherwise(F.concat(F.left(digits, n + 1), F.lit("."), F.substr(digits, n + 2, many)))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -n - 1), digits)
    exponent = F.concat(F.when(n < 0, F.lit("-")).otherwise(F.lit("+")), F.lpad(F.abs(n).cast("string"), F.greatest(F.lit(2), F.length(F.abs(n).cast("string"))), F.lit("0")))
    scientific = F.concat(F.left(digits, F.lit(1)), F.when(many > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2), many))).otherwise(F.lit("")), F.lit("e"), exponent)
    text = F.when(~own.contains("E"), own).when((n >= 0) & (n < 16), whole).when((n < 0) & (n >= -4), small).otherwise(scientific)
    odd = F.when(F.isnan(x), F.lit("nan")).when(x == float("inf"), F.lit("inf")).when(x == float("-inf"), F.lit("-inf"))
    return F.when(x.isNull(), F.lit(None)).otherwise(F.coalesce(odd, F.concat(sign, text)))
