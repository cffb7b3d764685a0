"""HTML to Markdown, charset decoding and text repair, as pandas UDFs around plain functions."""

from __future__ import annotations

import html
import re
import signal
import threading
import unicodedata
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Elements by what they do to the flow.
SKIPPED = {"script", "style", "head", "template", "noscript", "svg"}
BLOCKS = {
    "address", "article", "aside", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "header", "html", "main", "nav", "p", "section", "summary", "table", "tbody", "tfoot", "thead",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}
#: Inside these a skipped element may stay unclosed; the closing tag of an outer one ends it.
SPACE = re.compile(r"\s+")


class MarkdownWriter(HTMLParser):
    """Streams events into blocks. Unclosed and stray tags never fail: each block start flushes what stands open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.line: list[str] = []
        self.skip: list[str] = []
        self.lists: list[list] = []  # [ordered, next number]
        self.quotes = 0
        self.prefix = ""
        self.pre = 0
        self.rows: list[list[str]] | None = None
        self.link_images: list[bool] = []

    # text of the block so far
    def flush(self) -> None:
        text = "".join(self.line)
        self.line = []
        if self.pre:
            body = text.strip("\n")
            if body:
                self.put("```\n" + body + "\n```")
            return
        for mark in ("**", "*", "`"):
            if mark == "*":
                continue
            if text.count(mark) % 2:
                text += mark
        text = re.sub(r"\*\*\s*\*\*", "", text)
        text = "\n".join(SPACE.sub(" ", t).strip() for t in text.split("\x00")).strip()
        if text:
            self.put(self.prefix + text.replace("\n", "  \n"))
            if self.prefix.strip():
                self.prefix = " " * len(self.prefix) if self.lists else ""

    def put(self, text: str) -> None:
        if self.quotes:
            text = "\n".join("> " * self.quotes + t for t in text.split("\n"))
        self.blocks.append(text)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        told = {k: v or "" for k, v in attrs}
        if self.skip:
            if tag in SKIPPED and tag not in VOID:
                self.skip.append(tag)
            elif tag == "body":
                self.skip.clear()
            return
        if tag in SKIPPED:
            self.skip.append(tag)
        elif tag == "br":
            self.line.append("\x00")
        elif tag == "hr":
            self.flush()
            self.put("---")
        elif tag == "img":
            self.line.append(f"![{SPACE.sub(' ', told.get('alt', ''))}]({told.get('src', '')})")
        elif re.fullmatch("h[1-6]", tag):
            self.flush()
            self.prefix = "#" * int(tag[1]) + " "
        elif tag in ("ul", "ol"):
            self.flush()
            self.lists.append([tag == "ol", 1])
        elif tag == "li":
            self.flush()
            if not self.lists:
                self.lists.append([False, 1])
            top = self.lists[-1]
            indent = "    " * (len(self.lists) - 1)
            self.prefix = indent + (f"{top[1]}. " if top[0] else "- ")
            top[1] += 1
        elif tag == "blockquote":
            self.flush()
            self.quotes += 1
        elif tag == "pre":
            self.flush()
            self.pre += 1
        elif tag == "table":
            self.flush()
            self.rows = []
        elif tag == "tr" and self.rows is not None:
            self.rows.append([])
            self.line = []
        elif tag in ("td", "th") and self.rows is not None:
            self.line = []
        elif tag in BLOCKS:
            if self.rows is None:
                self.flush()
        elif tag in MARKS and not self.pre and self.rows is None:
            self.line.append(MARKS[tag])

    def handle_endtag(self, tag: str) -> None:
        if self.skip:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            return
        if re.fullmatch("h[1-6]", tag):
            self.flush()
            self.prefix = ""
        elif tag in ("ul", "ol"):
            self.flush()
            if self.lists:
                self.lists.pop()
            self.prefix = ""
        elif tag == "li":
            self.flush()
            self.prefix = ""
        elif tag == "blockquote":
            self.flush()
            self.quotes = max(0, self.quotes - 1)
        elif tag == "pre":
            self.flush()
            self.pre = max(0, self.pre - 1)
        elif tag in ("td", "th") and self.rows:
            self.rows[-1].append(SPACE.sub(" ", "".join(self.line)).strip().replace("|", "\\|"))
            self.line = []
        elif tag == "table" and self.rows is not None:
            self.table()
        elif tag in BLOCKS:
            if self.rows is None:
                self.flush()
        elif tag in MARKS and not self.pre and self.rows is None:
            self.line.append(MARKS[tag])

    def table(self) -> None:
        rows = [r for r in self.rows or [] if r]
        self.rows, self.line = None, []
        if rows:
            width = max(map(len, rows))
            rows = [r + [""] * (width - len(r)) for r in rows]
            out = ["| " + " | ".join(r) + " |" for r in rows]
            out.insert(1, "|" + " --- |" * width)
            self.put("\n".join(out))

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.line.append(data)

    def markdown(self) -> str:
        if self.rows is not None:
            self.table()
        self.flush()
        out, tight = [], re.compile(r"\s*(?:- |\d+\. )")
        for i, b in enumerate(self.blocks):
            if i:
                out.append("\n" if tight.match(b) and tight.match(self.blocks[i - 1]) else "\n\n")
            out.append(b)
        return "".join(out) + "\n"


def markdown_of(page: str | None) -> str | None:
    """Markdown of an HTML page: one final newline, links as their text, image-only links as the images.

    None for None, and for a page that cannot be parsed, so that it can be dropped with the bad rows.
    """
    if page is None:
        return None
    writer = MarkdownWriter()
    try:
        writer.feed(page)
        writer.close()
        return writer.markdown()
    except (AssertionError, ValueError):
        return None


#: Fixed value: seconds that one page may take.
PAGE_SECONDS = 60


class TooSlow(Exception):
    pass


@contextmanager
def time_limit(seconds: float) -> Iterator[None]:
    """Raises TooSlow in the main thread (a Python worker's tasks run there) after so many seconds; elsewhere no limit."""
    if threading.current_thread() is not threading.main_thread():
        yield
        return

    def stop(*_):
        raise TooSlow

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def limited(convert: Callable[[str | None], str | None], seconds: float = PAGE_SECONDS) -> Callable[[str | None], str | None]:
    """``convert`` that gives None, as for a bad page, where one page takes too long."""

    def run(page: str | None) -> str | None:
        try:
            with time_limit(seconds):
                return convert(page)
        except TooSlow:
            return None

    return run


#: Texts that a function holds as Python strings at a time.
SLICE = 256


def converted(texts: pa.Array, convert: Callable[[str | None], str | None]) -> pa.Array:
    """``convert`` of every text, by slices: of a batch only the Arrow form is held as a whole."""
    parts = [pa.array([convert(t) for t in texts.slice(i, SLICE).to_pylist()], pa.string()) for i in range(0, len(texts), SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


@F.arrow_udf(StringType())
def html_to_markdown(pages: pa.Array) -> pa.Array:
    return converted(pages, limited(markdown_of))


def strip_scripts(page: Column) -> Column:
    return F.regexp_replace(page, r"(?is)<script\b[^>]*>.*?</script\s*>", "")


def links_to_text(page: Column) -> Column:
    """Links replaced by their content, which for image-only links is the images."""
    return F.regexp_replace(page, r"(?is)<a\b[^>]*>(.*?)</a\s*>", "$1")


def decode_bytes(raw: bytes | None) -> str | None:
    """Charset from the byte order mark, a declaration in the head, or the bytes; malformed parts are ignored."""
    if raw is None:
        return None
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if raw.startswith(mark):
            return raw.decode(name, "ignore")
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        pass
    told = re.search(rb"charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", raw[:4096])
    for name in (told[1].decode("ascii") if told else "", "cp1252"):
        try:
            return raw.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return raw.decode("utf-8", "ignore")


@F.pandas_udf(StringType())
def decode_html(payload: pd.Series) -> pd.Series:
    return payload.map(lambda b: decode_bytes(None if b is None else bytes(b)))


# Typographic quotes and ligatures with their plain forms.
PLAIN = {
    "‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"',
    "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl",
}
CONTROL = {c: None for c in [*range(0, 9), 11, *range(14, 32), 127, 0xFEFF]}


def _unmangled(run: re.Match) -> str:
    """A run of UTF-8 that was once read as cp1252 or latin-1, read right; other runs as they are."""
    for name in ("cp1252", "latin-1"):
        try:
            return run[0].encode(name).decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
    return run[0]


def fixed_text(text: str | None) -> str | None:
    """Entities, mojibake, typographic quotes and ligatures, line breaks, control characters; then composed (NFC)."""
    if text is None:
        return None
    if "<" not in text:
        text = html.unescape(text)
    text = re.sub("[\u0080-\u00ff\u0152-\u2122]{2,}", _unmangled, text)
    text = text.replace("\r\n", "\n").replace("\r", "\n").replace(" ", "\n").replace(" ", "\n").replace("\x85", "\n")
    for k, v in PLAIN.items():
        text = text.replace(k, v)
    return unicodedata.normalize("NFC", text.translate(CONTROL))


@F.arrow_udf(StringType())
def fix_text(texts: pa.Array) -> pa.Array:
    return converted(texts, fixed_text)
