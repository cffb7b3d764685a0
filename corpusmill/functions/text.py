"""Scalar text functions as Column builders: all stay in the JVM."""

from __future__ import annotations

import string
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

PUNCTUATION = string.punctuation
DOMAIN = r"https?://(?:www\.)?([^/:?]+)"
IMAGE = r"!\[(.*?)\]\((.*?)\)"


@F.pandas_udf(StringType())
def to_nfd(texts: pd.Series) -> pd.Series:
    """Canonical decomposition; Spark has no such function."""
    return texts.map(lambda t: unicodedata.normalize("NFD", t), na_action="ignore")


def normalize_text(text: Column, punctuation=True, lower=True, nfd=True, spaces=True) -> Column:
    """Without ASCII punctuation, lowered, spaces collapsed and trimmed, decomposed; each step can be left out."""
    if punctuation:
        text = F.translate(text, PUNCTUATION, "")
    if lower:
        text = F.lower(text)
    if spaces:
        text = F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " ")
    return to_nfd(text) if nfd else text


def words(text: Column) -> Column:
    """Words of the normalised text. Decomposition splits no word and merges none, so it is left out."""
    return F.filter(F.split(normalize_text(text, nfd=False), " "), lambda w: w != "")


def content_length(text: Column) -> Column:
    return F.length(text).cast("long")


def ratio_alphanumeric(text: Column) -> Column:
    n = F.length(text)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", "")) / n)


def heading_ratio(text: Column) -> Column:
    """Lines that start with # per word of the other lines; 0 without such words."""
    lines = F.split(text, "\n")
    headings = F.size(F.filter(lines, lambda x: x.startswith("#")))
    rest = F.array_join(F.filter(lines, lambda x: ~x.startswith("#")), "\n")
    # the words are written once, as what is written twice in a condition and its outcome is computed twice
    return F.when(text.isNull(), None).otherwise(F.coalesce(F.try_divide(headings, F.size(words(rest))), F.lit(0.0)))


def unigram_entropy(text: Column) -> Column:
    """Shannon entropy (natural log) of the words' frequencies, from run lengths of the sorted words."""
    w = F.sort_array(words(text))
    n = F.size(w)
    start = F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))
    xlogx = lambda x: F.when(x > 1, x * F.ln(x.cast("double"))).otherwise(F.lit(0.0))

    def step(a, x):
        same = a["word"] == x
        return F.struct(
            x.alias("word"),
            F.when(same, a["run"] + 1).otherwise(1).alias("run"),
            F.when(same, a["sum"]).otherwise(a["sum"] + xlogx(a["run"])).alias("sum"),
        )

    total = F.aggregate(w, start, step, lambda a: a["sum"] + xlogx(a["run"]))
    return F.when(text.isNull(), None).when(n == 0, F.lit(0.0)).otherwise(F.ln(n.cast("double")) - total / n)


def url_domain(url: Column) -> Column:
    """Host after the first http(s) scheme, without ``www.``; empty if there is none."""
    return F.regexp_extract(url, DOMAIN, 1)


def is_domain_blacklisted(url: Column, domains: tuple[str, ...], strategy: str = "keep") -> Column:
    listed = url_domain(url).isin(*domains) if domains else F.lit(False)
    return F.when(url.rlike(DOMAIN), listed).otherwise(F.lit(strategy == "keep"))


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def newline_count(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).cast("long")


def split_lines(text: Column, compat: bool = False) -> Column:
    """Lines with their ends kept. The last one has none, and is left out if empty."""
    ends = "(?<=\\r)(?!\\n)|(?<=[\\n\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029])" if compat else "(?<=\\n)"
    return F.filter(F.split(text, ends), lambda x: x != "")


def encode_separators(text: Column, token: str) -> Column:
    """A final newline is ensured, the literal token deleted, and newlines become the token."""
    full = F.when(text.endswith("\n"), text).otherwise(F.concat(text, F.lit("\n")))
    return F.replace(F.replace(full, F.lit(token), F.lit("")), F.lit("\n"), F.lit(token))


def strip_images(text: Column) -> Column:
    return F.regexp_replace(text, IMAGE, "")


def image_urls(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(IMAGE), 2)


def warc_suffix(path: Column) -> Column:
    found = F.regexp_extract(path, r"(crawl-data/.*)", 1)
    return F.when(found != "", found).otherwise(path)


def token_length(text: Column) -> Column:
    """Tokens of the default tokenizer: runs between white space."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")).cast("long")


# ---- personal data ---------------------------------------------------------------------------------------------

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9.]*[0-9])"
#: Address ranges that are not public (as patterns of the dotted form).
NOT_PUBLIC = (
    r"0\.|10\.|127\.|169\.254\.|192\.168\.|192\.0\.2\.|192\.0\.0\.(?!9(?![0-9])|10(?![0-9]))|198\.1[89]\.|198\.51\.100\.|203\.0\.113\.|"
    r"172\.(?:1[6-9]|2[0-9]|3[01])\.|100\.(?:6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])\.|(?:24[0-9]|25[0-5])\."
)
PUBLIC_IPV4 = rf"(?<![0-9.])(?!{NOT_PUBLIC}){OCTET}(?:\.{OCTET}){{3}}(?![0-9.]*[0-9])"


def email_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(EMAIL)).cast("long")


def ip_count(text: Column, public_only: bool = True) -> Column:
    return F.regexp_count(text, F.lit(PUBLIC_IPV4 if public_only else IPV4)).cast("long")


def mask_emails(text: Column, mark: str = "<email>") -> Column:
    return F.when(text.contains("@"), F.regexp_replace(text, EMAIL, mark)).otherwise(text)  # a plain search first


def mask_ips(text: Column, public_only: bool = True, mark: str = "<ip>") -> Column:
    return F.regexp_replace(text, PUBLIC_IPV4 if public_only else IPV4, mark)


def mask_pii(text: Column, emails: bool = True, ips: bool = True, public_only: bool = True) -> Column:
    """E-mail and (public) IPv4 addresses replaced; the marks match neither pattern, so masking twice is masking once."""
    masked = mask_emails(text) if emails else text
    # the marks join no digits, so that a text without such a pair has no address after masking either
    return F.when(text.rlike(r"[0-9]\.[0-9]"), mask_ips(masked, public_only)).otherwise(masked) if ips else masked


# ---- language --------------------------------------------------------------------------------------------------

# Frequent words of each language, for the default rule.
STOP_WORDS = {
    "de": ("der", "die", "und", "das", "ist", "nicht", "ein", "den", "von", "mit"),
    "en": ("the", "of", "and", "to", "is", "that", "for", "was", "with", "this"),
    "es": ("el", "los", "que", "una", "por", "con", "para", "del", "las", "esta"),
    "fr": ("le", "les", "et", "des", "une", "dans", "qui", "pour", "est", "avec"),
}


def language(text: Column) -> Column:
    """Default rule: the language with most stop words (alphabetical order breaks ties), else ``und``.

    Newlines are deleted first without a blank, as the established behaviour has it. A trained model can be put in its
    place through ``operators.features.Feature``.
    """
    padded = F.concat(F.lit(" "), F.replace(F.lower(F.replace(text, F.lit("\n"), F.lit(""))), F.lit(" "), F.lit("  ")), F.lit(" "))

    def best(t: Column) -> Column:
        counts = [F.struct(F.regexp_count(t, F.lit(" (" + "|".join(w) + ") ")).alias("n"), F.lit(-k).alias("k"), F.lit(name).alias("l")) for k, (name, w) in enumerate(STOP_WORDS.items())]
        return F.array_max(F.array(F.struct(F.lit(0).alias("n"), F.lit(1).alias("k"), F.lit("und").alias("l")), *counts))["l"]

    # a variable of a function over one element: the padded text is made once for all languages
    return F.when(text.isNull(), None).otherwise(F.transform(F.array(padded), best)[0])
