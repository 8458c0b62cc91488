"""Text normalisation and assembly as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that do not tell entity names apart.
STOPWORDS = ("the", "ltd", "inc", "co", "company", "corp", "corporation", "limited")
#: American and Canadian spellings.
SPELLINGS = {
    "center": "centre", "theater": "theatre", "meter": "metre", "liter": "litre", "color": "colour", "honor": "honour", "favor": "favour",
    "labor": "labour", "harbor": "harbour", "neighbor": "neighbour", "defense": "defence", "offense": "offence", "gray": "grey",
}


def key_of(name: Column) -> Column:
    """Lower case without anything but a-z and 0-9."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]+", "")


def dedup_key(name: Column, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """Lower case without ``. , ' " ( )``, stop words dropped, words joined by one space."""
    words = F.split(F.btrim(F.regexp_replace(F.lower(name), "[.,'\"()]", "")), "\\s+")
    return F.array_join(F.filter(words, lambda w: ~w.isin(*stopwords)), " ")


def pair_key(a: Column, b: Column) -> Column:
    """The same for either order of a pair; NULL counts as nothing."""
    return F.array_join(F.array_sort(F.array_compact(F.array(a, b))), "|")


def expand_street(name: Column) -> Column:
    """A trailing ``st`` after another word is a street."""
    return F.regexp_replace(name, "(\\S)\\s+st$", "$1 street")


def snake(label: Column) -> Column:
    spaced = F.regexp_replace(label, "([a-z0-9])([A-Z])", "$1_$2")
    return F.trim(F.regexp_replace(F.lower(spaced), "[^a-z0-9]+", "_"), F.lit("_"))


def humanise(label: Column) -> Column:
    return F.initcap(F.replace(label, F.lit("_"), F.lit(" ")))


def slug(label: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(label), "[^a-z0-9]+", "-"), F.lit("-"))


def respell(name: Column, spellings: dict[str, str] = SPELLINGS) -> Column:
    """Lower case with whole runs of letters replaced by the map."""
    out = F.lower(name)
    for old, new in spellings.items():
        out = F.regexp_replace(out, f"(?<![a-z]){old}(?![a-z])", new)
    return out


def excerpt(text: Column, needle: Column, reach: int = 200) -> Column:
    """``reach`` characters on both sides of the first hit in either case, with ellipses where text is cut off; NULL without a hit."""
    at = F.locate_in(text, needle) if hasattr(F, "locate_in") else F.call_function("locate", F.lower(needle), F.lower(text))
    start = F.greatest(F.lit(1), at - reach)
    length = at - start + F.char_length(needle) + reach
    body = F.substr(text, start, length)
    head = F.when(start > 1, F.lit("...")).otherwise(F.lit(""))
    tail = F.when(start + length - 1 < F.char_length(text), F.lit("...")).otherwise(F.lit(""))
    return F.when(at > 0, F.concat(head, body, tail))


def strip_fence(text: Column) -> Column:
    """Text without a surrounding Markdown code fence."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), "^```[a-zA-Z]*\\s*", ""), "\\s*```$", ""))


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def last_line(text: Column) -> Column:
    return F.substring_index(text, "\n", -1)


def clamp_slice(text: Column, start: Column, end: Column) -> Column:
    """Characters from ``start`` up to ``end``, both clamped to the text."""
    n = F.char_length(text)
    a = F.greatest(F.lit(0), F.least(start, n))
    return F.substr(text, (a + 1).cast("int"), F.greatest(F.lit(0), F.least(end, n) - a).cast("int"))


def enough_letters(text: Column, least: int = 3) -> Column:
    return F.char_length(F.regexp_replace(text, "[^\\p{L}]", "")) >= least


def strip_maker(name: Column, maker: Column) -> Column:
    """Drop a maker's name from the start or the end of a product's, on a word boundary."""
    low, other = F.lower(name), F.lower(maker)
    cut = F.char_length(maker)
    return (
        F.when(low.startswith(F.concat(other, F.lit(" "))), F.substr(name, cut + 2, F.char_length(name)))
        .when(low.endswith(F.concat(F.lit(" "), other)), F.substr(name, F.lit(1), F.char_length(name) - cut - 1)).otherwise(name)
    )


def alias_of(mention: Column, name: Column) -> Column:
    """The mention if it normalises differently from the name."""
    return F.when(key_of(mention) != key_of(name), mention)


def stitch(previous: Column, current: Column, least: int = 20) -> Column:
    """Merge the last line of one slice with the first of the next, or NULL if they do not overlap.

    Equal lines, a prefix or a suffix give the longer one; else the longest overlap of ``least`` characters
    or more that starts at a word boundary joins both.
    """
    a, b = F.trim(previous), F.trim(current)
    most = F.least(F.char_length(a), F.char_length(b)) - 1
    sizes = F.when(most >= least, F.sequence(most, F.lit(least), F.lit(-1))).otherwise(F.array().cast("array<int>"))

    def fits(n: Column) -> Column:
        before = F.substr(a, F.char_length(a) - n, F.lit(1))
        return (F.right(a, n) == F.left(b, n)) & (before == " ")

    n = F.get(F.filter(sizes, fits), 0)
    return (
        F.when((a == "") | (b == ""), F.lit(None)).when(a == b, a)
        .when(b.startswith(a), b).when(a.endswith(b), a)
        .when(n.isNotNull(), F.concat(a, F.substr(b, n + 1, F.char_length(b))))
    )


def content_hash(values: Column, tag: str) -> Column:
    """SHA-256 of sorted values, one tagged line each."""
    return F.sha2(F.array_join(F.transform(F.array_sort(values), lambda v: F.concat(F.lit(tag + ":"), v)), "\n"), 256)


def prompt_hash(template: Column, context: Column) -> Column:
    """SHA-256 of a template and a context whose JSON has a fixed field order."""
    return F.sha2(F.concat(template, F.lit("\n"), F.to_json(context)), 256)
