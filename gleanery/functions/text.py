"""Cleaning, keys and extraction, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, spelled out: Java's \s is ASCII only.
SPACE = r"[\t-\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ZERO_WIDTH = r"[\x{200B}-\x{200D}\x{FEFF}]"
# How answers, numbers and the interface's words stand in lines.
ANSWER = r"(?i)(?:Correct\s*Answer|Ans(?:wer)?)[.:\s-]+[\s(]*([a-d])"
QUESTION_NUMBER = r"(?i)^Q(\d+)[:\s.]"
UI_LEAK = r"(?i)Type\s*Your\s*Answer|View\s*Answer|Solution:?"


def matches(c: Column, first: str, pattern: str) -> Column:
    """Whether a pattern that begins with ^ and one of the characters `first` matches; others are settled without it."""
    return F.left(c, F.lit(1)).isin(*first) & F.rlike(c, F.lit(pattern))


def truthy(c: Column) -> Column:
    """Whether a string is neither null nor empty."""
    return F.coalesce(c, F.lit("")) != ""


def collapsed(c: Column) -> Column:
    # Most characters are settled by one range, not by all that SPACE has, and a single blank stays where it is.
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), f"(?![!-~])(?: {SPACE}+|(?! ){SPACE}+)", " "))


def normal(c: Column) -> Column:
    """The form in which texts are compared."""
    return F.lower(collapsed(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit(" and "))))


def without_zero_width(c: Column) -> Column:
    return F.translate(F.regexp_replace(F.coalesce(c, F.lit("")), ZERO_WIDTH, ""), "\u00a0", " ")


def truncated(c: Column, limit: int = 160) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit("…"))).otherwise(c)


def slug(c: Column, trim: bool = True) -> Column:
    """Lower case, & as "and", words joined by single hyphens; outer hyphens go if `trim`."""
    words = F.lower(collapsed(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit(" and "))))
    hyphened = F.regexp_replace(F.regexp_replace(F.regexp_replace(words, " +", "-"), r"[^a-z0-9-]", ""), "-+", "-")
    return F.regexp_replace(hyphened, "^-+|-+$", "") if trim else hyphened


def title_key(c: Column) -> Column:
    return F.lower(F.replace(F.replace(collapsed(c), F.lit("&"), F.lit(" and ")), F.lit("-"), F.lit(" ")))


def title_from_slug(c: Column) -> Column:
    return F.array_join(F.transform(F.split(c, "-"), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), w.substr(F.lit(2), F.length(w)))), " ")


def stem_of_path(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def first_number(lines: Column) -> Column:
    """The number of the first line that begins like a question; null if none does."""
    found = F.transform(F.filter(lines, lambda x: matches(x, "Qq", QUESTION_NUMBER)), lambda x: F.regexp_extract(x, QUESTION_NUMBER, 1))
    return F.try_element_at(found, F.lit(1)).cast("int")


def answer_letter(c: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(c, F.lit("")), ANSWER, 1))


def first_replaced(c: Column, pattern: str, by: str = "") -> Column:
    """The first match only; regexp_replace takes all."""
    return F.regexp_replace(c, f"(?is)^(.*?)(?:{pattern})", f"$1{by}")


def stated_explanation(lines: Column) -> Column:
    """What stands after the first answer marker, without the answer's letter."""
    text = without_zero_width(F.array_join(F.filter(lines, lambda x: x != ""), " "))
    after = F.regexp_extract(text, r"(?is)\bA\s*n\s*s\b\s*[:.-]?\s*(.*)$", 1)
    bare = F.regexp_replace(after, r"(?i)^(?:Ans[:\s-]+)?[\s(]*[a-d](?:[)\s.:,-]|$)\s*", "")
    return collapsed(first_replaced(bare, r"\bAns\b\s*[:.-]?\s*[\s(]*[a-d][)\s.:,-]*"))


def told_explanation(value: Column) -> Column:
    """An explanation that may be an object {correct, others}, in JSON or with single quotes, or text; what looks
    like such an object and is none stays as it is."""
    text = F.trim(without_zero_width(value))
    begins = text.startswith('{"correct":') | text.startswith("{'correct':")
    object_ = F.when(begins, text)  # other texts are not parsed, to fail
    v = F.coalesce(F.try_parse_json(object_), F.try_parse_json(F.replace(object_, F.lit("'"), F.lit('"'))))
    said = [F.nullif(F.try_variant_get(v, f"$.{k}", "string"), F.lit("")) for k in ("correct", "others")]
    return collapsed(F.when(begins, F.coalesce(*said, text)).otherwise(text))


# What the pages' interface leaves in the text of questions and options.
INTERFACE = r"(?i)Type\s*Your\s*Answer|View\s*Answer|View\s*Solution|View\s*Correct|Hide\s*Explanation|Solution:?"
FOLLOW_UPS = r"(?i)MULTIPLE\s+CHOICE\s+QUESTION|Try\s*yourself|View\s*Solution|View\s*Correct|Hide\s*Explanation|Report\s+a\s*problem|Cancel\s*Report|CancelReport"
CHOOSER = r"Choose the (?:correct|most appropriate) answer from the options given below\s*:?|In the light of the above statements,?\s*choose the correct answer from the options given below\s*:?"


def without_follow_ups(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, FOLLOW_UPS, " "), r"(?is)Report.*$", " ")


def question_text(c: Column) -> Column:
    """A question's stem without pictures, interface words, its number, answer and chooser line."""
    for pattern, by in (
        (r"(?i)\[IMG(?::[^\]]+)?\]", ""),
        (INTERFACE, " "),
        (r"(?is)Correct\s*Answer\s*:.*$", " "),
        (r"(?i)^Q\s*\d+[:\s.]*", ""),
        (r"(?i)\s*\(NEET[^)]*\)", ""),
        (r"(?i)(?:\(\s*[a-d]\s*\)\s*){2,}", " "),
        (rf"(?i)\s*(?:{CHOOSER})\s*$", ""),
        (r"(?i)\s*In the light of the above statements,?\s*$", ""),
        (r"[\s,;:.-]+$", ""),
    ):
        c = F.regexp_replace(c, pattern, by)
    return collapsed(without_follow_ups(c))


def option_value(c: Column) -> Column:
    """An option's text; a picture counts as [diagram]."""
    for pattern, by in ((r"(?i)\[IMG:[^\]]+\]", "[diagram]"), (INTERFACE, " "), (r"(?is)Correct\s*Answer\s*:.*$", " "), (r"(?i)\bCorrect\b\s*$", ""), (r"(?i)\s*\(NEET[^)]*\)", ""), (r"^[\s:.-]+", "")):
        c = F.regexp_replace(c, pattern, by)
    return collapsed(without_follow_ups(c))


def answer_parts(line: Column) -> Column:
    """struct<before, after> of a line with an answer marker, else null."""
    out = []
    for marker in (r"\bAns\b[.:\s-]+", r"\bAnswer\b\s*[:\-]\s*", r"\bCorrect\s*Answer\b\s*[:\-]?\s*"):
        pattern = f"(?is)^(.*?){marker}(.*)$"
        parts = F.struct(*(collapsed(F.regexp_extract(line, pattern, i)).alias(n) for i, n in ((1, "before"), (2, "after"))))
        out.append(F.when(F.rlike(line, F.lit(pattern)), parts))
    return F.coalesce(*out)


def number_of(field: Column) -> Column:
    """A question's number from a field of any type; null where it is none."""
    return field.cast("string").try_cast("int")


def shown_score(x: Column) -> Column:
    """Four decimals, or a dash."""
    return F.when(x.isNull(), "—").otherwise(F.format_string("%.4f", x))


def badge(risk: Column) -> Column:
    """The style of a risk: its own, or neutral."""
    r = F.lower(F.coalesce(F.nullif(risk, F.lit("")), F.lit("unknown")))
    return F.when(r.isin("high", "medium", "low"), r).otherwise("neutral")


def asset_extension(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"(?i)\.(svg|png|jpe?g|webp|gif)(?:[?#]|$)", 1))
    return F.concat(F.lit("."), F.coalesce(F.nullif(found, F.lit("")), F.lit("png")))


# Chapters whose pictures have a short prefix.
ASSET_PREFIXES = {
    "biodiversity-and-its-conservation": "biodiversity-",
    "human-health-and-diseases": "human-health-",
    "human-reproduction": "reproduction-",
    "microbes-in-human-welfare": "microbes-",
    "molecular-basis-of-inheritance": "mbi-",
    "principles-of-inheritance-and-variation": "piv-",
}


def asset_prefix(chapter_slug: Column) -> Column:
    """A chapter's prefix of picture names: its own, or the slug in upper case."""
    own = F.coalesce(*(F.when(chapter_slug == k, v) for k, v in ASSET_PREFIXES.items()))
    return F.coalesce(own, F.concat(F.upper(F.replace(chapter_slug, F.lit("-"), F.lit("_"))), F.lit("-")))


def has_any_prefix(c: Column, prefixes: Column) -> Column:
    return F.exists(prefixes, lambda p: c.startswith(p))


def attribute(attrs: Column, name: str) -> Column:
    """An attribute's value in a start tag's text; '' if it has none."""
    pattern = rf"""(?i)(?:^|\s){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*(F.regexp_extract(attrs, pattern, i) for i in (1, 2, 3)))  # one of them at most is not empty
