"""Text cleaning as column steps.

Every step is a guarded ``regexp_replace``: the guard is a plain byte search, so
a mail without, say, an ``@`` never pays for the address pattern.  A guard names
its input three times, so each step binds it to a lambda variable first; nested
plainly, the steps would grow threefold each.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from string import ascii_letters, digits

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode white space, and what counts as a letter of a word.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"


@dataclass(frozen=True)
class Step:
    name: str
    pattern: str
    replacement: str
    triggers: tuple[str, ...] = ()

    def __call__(self, text: Column) -> Column:
        if not self.triggers:
            return F.regexp_replace(text, self.pattern, self.replacement)
        return F.get(F.transform(F.array(text), self._guarded), F.lit(0))

    def _guarded(self, text: Column) -> Column:
        hit = F.contains(text, F.lit(self.triggers[0]))
        for mark in self.triggers[1:]:
            hit = hit | F.contains(text, F.lit(mark))
        return F.when(
            hit, F.regexp_replace(text, self.pattern, self.replacement)
        ).otherwise(text)


# The masks and what replaces them.
NEWLINES = Step("newlines", r"\r\n?", "\n", ("\r",))
HEADER_LINES = Step(
    "header_lines", r"(?imdu)^(?:from|to|subject|cc|bcc|date):.*$", " ", (":",)
)
URLS = Step(
    "urls",
    rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+",
    " urltoken ",
    ("http://", "https://", "www."),
)
ADDRESSES = Step(
    "addresses",
    rf"{EDGE}[{WORD}.\-]+@[{WORD}.\-]+\.[{WORD}]+{EDGE}",
    " emailtoken ",
    ("@",),
)
MONEY = Step(
    "money", rf"[$€£][{SPACE}]?\p{{Nd}}+(?:[.,]\p{{Nd}}+)?", " moneytoken ", ("$", "€", "£")
)
NUMBERS = Step(
    "numbers",
    rf"(?=[^ a-z])(?=\p{{Nd}})(?<![{WORD}])\p{{Nd}}+(?:[.,]\p{{Nd}}+)?(?![{WORD}])",
    " numtoken ",
)
# Spelt out, the class is one table look-up per character instead of a chain of ranges.
BASE64 = f"[{ascii_letters}{digits}+/]"
BASE64_RUNS = Step("base64_runs", rf"(?<!{BASE64}){BASE64}{{40,}}+={{0,2}}", " ")
TAGS = Step("tags", r"<[^>]+>", " ", ("<",))
PUNCTUATION = Step(
    "punctuation", r"([!$?])\1{2,}", "$1$1$1", ("!!!!", "$$$$", "????")
)
LONG_BLANKS = Step("long_blanks", " {2,}", " ", ("  ",))
RARE_SPACES = rf"(?=[^\x00-\x7f])[{SPACE}]"
ASCII_SPACES = "\n\t\r\x0b\x0c\x1c\x1d\x1e\x1f"


def collapse_spaces(text: Column) -> Column:
    """Every run of white space becomes one blank.

    ASCII white space is swapped for blanks by plain replacement, other kinds are
    looked for only in text that is not all ASCII, and only runs of blanks are
    left to a pattern.
    """
    for ch in ASCII_SPACES:
        text = F.replace(text, F.lit(ch), F.lit(" "))
    rare = F.get(
        F.transform(
            F.array(text),
            lambda t: F.when(
                F.octet_length(t) != F.length(t), F.regexp_replace(t, RARE_SPACES, " ")
            ).otherwise(t),
        ),
        F.lit(0),
    )
    return LONG_BLANKS(rare)


def strip_space(text: Column) -> Column:
    """Drop white space, line ends included, from both ends."""
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def _ranges(*bounds: tuple[int, int]) -> str:
    return "".join(f"\\u{low:04x}-\\u{high:04x}" for low, high in bounds)


# Characters that NFKC leaves alone, alone and next to each other.
# ASCII, Latin-1 and Latin Extended-A letters, Vietnamese letters, usual quotes.
NFKC_STABLE = (
    (0x0000, 0x007F),
    (0x00A1, 0x00A7),
    (0x00A9, 0x00A9),
    (0x00AB, 0x00AE),
    (0x00B0, 0x00B1),
    (0x00B6, 0x00B7),
    (0x00BB, 0x00BB),
    (0x00BF, 0x0131),
    (0x0134, 0x013E),
    (0x0141, 0x0148),
    (0x014A, 0x017E),
    (0x01A0, 0x01A1),
    (0x01AF, 0x01B0),
    (0x1EA0, 0x1EF9),
    (0x2010, 0x2010),
    (0x2012, 0x2016),
    (0x2018, 0x2023),
    (0x20AB, 0x20AC),
)
# The second class is only tried on what the first, cheap one lets through.
MAY_CHANGE = rf"[^\x00-\x7f](?<![{_ranges(*NFKC_STABLE)}])"


@F.pandas_udf(T.StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def nfkc(df: DataFrame, column: str) -> DataFrame:
    """NFKC form.  Only text holding a character that may change leaves the JVM."""
    ascii_only = F.octet_length(column) == F.length(column)
    todo = F.when(~ascii_only & F.col(column).rlike(MAY_CHANGE), F.col(column))
    return df.withColumn("_nfkc", _nfkc(todo)).withColumn(
        column, F.coalesce("_nfkc", column)
    ).drop("_nfkc")


STEPS: tuple[Callable[[Column], Column], ...] = (
    NEWLINES,
    HEADER_LINES,
    F.lower,
    URLS,
    ADDRESSES,
    MONEY,
    NUMBERS,
    BASE64_RUNS,
    TAGS,
    PUNCTUATION,
    collapse_spaces,
    F.trim,
)


def clean_text(df: DataFrame, source: str = "text", target: str = "clean") -> DataFrame:
    """Add ``target``: ``source`` after all cleaning steps; null becomes empty."""
    df = nfkc(df.withColumn(target, F.coalesce(F.col(source), F.lit(""))), target)
    cleaned = F.col(target)
    for step in STEPS:
        cleaned = step(cleaned)
    return df.withColumn(target, cleaned)


def is_nfkc_stable(ch: str) -> bool:
    return re.search(MAY_CHANGE, ch) is None
