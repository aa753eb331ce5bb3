"""Text expressions shared by the document operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["let", "strip", "escape", "link", "doc_escape_link", "short_hash", "has_text", "SPACE"]

# every white-space character, line ends included, as inside a regex character class
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# the same characters one by one, for trimming without a regex
SPACES = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
              *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside one expression.

    Inside a higher-order function a repeated sub-expression is evaluated on every use;
    binding it as the lambda variable of a one-element array keeps the work linear.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Trim all white space, full-width spaces included."""
    return F.btrim(text, F.lit(SPACES))


def has_text(text: Column) -> Column:
    """Whether anything but white space occurs; stops at the first such character."""
    return text.rlike(f"[^{SPACE}]")


def escape(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def link(text: Column) -> Column:
    return F.regexp_replace(
        text, rf"(https?://[^{SPACE}]+)", '<a class="ext" href="$1" target="_blank">$1</a>'
    )


def doc_escape_link(text: Column) -> Column:
    """HTML-escape, then turn URLs into anchors."""
    return link(escape(text))


def short_hash(text: Column) -> Column:
    """First sixteen hex digits of the SHA-256 of the UTF-8 bytes."""
    return F.substring(F.sha2(text, 256), 1, 16)
