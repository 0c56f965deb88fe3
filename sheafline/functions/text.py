"""Text measurements and normal forms as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.plans import schema as S

#: Unicode white space as Python's split and strip take it; Java's \\s is ASCII only.
_SPACE_POINTS = (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
SPACES = "".join(map(chr, _SPACE_POINTS))


def _all_but_spaces() -> str:
    """A character class of all other characters as ranges, those of plain text first: Java tries the
    ranges in order, so a letter costs one comparison where a negated class would cost all of them."""
    bounds = [-1, *_SPACE_POINTS, 0x110000]
    ranges = [(a + 1, b - 1) for a, b in zip(bounds, bounds[1:]) if b - a > 1]
    ranges.sort(key=lambda r: {0x21: 0, 0xA1: 1}.get(r[0], 2))
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


NOT_SPACE = _all_but_spaces()


def word_count(text: Column) -> Column:
    """Words between Unicode white space; null for null."""
    return F.regexp_count(text, F.lit(f"{NOT_SPACE}++")).cast("long")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def is_blank(text: Column) -> Column:
    """No character but white space; null for null."""
    return F.ltrim(text, F.lit(SPACES)) == ""


def page_characters(text: Column) -> Column:
    """Characters of a page's native text, line breaks apart."""
    return F.length(F.translate(text, "\r\n", "")).cast("long")


def unify_lines(text: Column) -> Column:
    """CR LF and CR become LF."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def sanitize(text: Column) -> Column:
    """CR LF and CR become LF; NUL goes."""
    return F.replace(unify_lines(text), F.lit("\x00"), F.lit(""))


def normalize_ocr_text(text: Column) -> Column:
    """LF line ends, no white space at line ends, no blank lines at the end; leading ones stay."""
    lines = F.split(unify_lines(text), "\n", -1)
    return F.rtrim(F.array_join(F.transform(lines, lambda x: F.rtrim(x, F.lit(SPACES))), "\n"), F.lit("\n"))


def normalize_markdown(text: Column) -> Column:
    """As OCR text, with one line break at the end of what isn't empty."""
    return ended(normalize_ocr_text(text))


def ended(text: Column) -> Column:
    """One line break at the end of what isn't empty."""
    return F.when(F.length(text) > 0, F.concat(text, F.lit("\n"))).otherwise(text)


def tokens(text: Column) -> Column:
    """Estimate: a token for every CHARS_PER_TOKEN characters of the sanitized text, rounded up."""
    return F.ceil(F.length(sanitize(text)) / F.lit(float(S.CHARS_PER_TOKEN))).cast("long")


def truncate_to_tokens(text: Column, limit: Column) -> Column:
    """The text if its estimate is within the limit, else its first limit * CHARS_PER_TOKEN characters."""
    room = (F.greatest(limit, F.lit(0)) * S.CHARS_PER_TOKEN).cast("int")
    return F.when(tokens(text) <= limit, sanitize(text)).otherwise(F.substring(sanitize(text), F.lit(1), room))


def context_verdict(prompt: Column, window: Column, images: Column, image_tokens: Column) -> Column:
    """fits, exceeds or unmeasured: images of no stated cost never fit, and no window measures nothing."""
    text_over = F.coalesce(prompt > window, F.lit(False))
    total = prompt + images * F.greatest(F.coalesce(image_tokens, F.lit(0)), F.lit(0))
    unpriced = (images > 0) & image_tokens.isNull()
    return (
        F.when(unpriced & text_over, "exceeds")
        .when(unpriced | window.isNull(), "unmeasured")
        .when(total > window, "exceeds")
        .otherwise("fits")
    )


def overflow_message(prompt: Column, window: Column, images: Column, image_tokens: Column) -> Column:
    """The refusal of a prompt that exceeds its window, with every number that was compared."""
    cost = F.when(image_tokens.isNull(), "unstated cost").otherwise(F.format_string("about %d tokens each", image_tokens))
    more = F.when(images > 0, F.format_string(" plus %d image(s) at %s", images, cost)).otherwise("")
    shown = F.coalesce(window.cast("string"), F.lit("None"))
    return F.format_string("the prompt needs about %d text tokens%s, and the stated window is %s", prompt, more, shown)


def numbered(prefix: str, position: Column) -> Column:
    return F.format_string(f"{prefix}_%03d", position.cast("int"))


def trailing_number(path: Column) -> Column:
    """The number at the end of a file's stem, so that 10 sorts after 9; null if there is none, or one over 64 bits."""
    return F.regexp_extract(path, r"([0-9]+)(?:\.[^./]*)?$", 1).try_cast("long")
