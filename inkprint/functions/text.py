"""Text expressions: every function maps Columns to a Column and stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from inkprint.constants import INPUT_PREFIX, MAX_CODE_CHARS

# Whitespace as Unicode defines it, spelled out because the
# shorthand class is ASCII-only in Java.
WHITESPACE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"

# The kinds of C source pieces that decide what a comment is.
# One alternative per kind of piece: string, character literal, line comment,
# block comment, plain run, any single character. Possessive quantifiers keep
# Java's matcher from recursing on long literals.
_CODE_PIECES = (
    r'(?s)"(?:\\.|[^"\\])*+"'
    r"|'(?:\\.|[^'\\])*+'"
    r"|//[^\n]*+(?:\n|\z)"
    r"|/\*.*?\*/"
    r"""|[^"'/]++"""
    r"|."
)


def _is_comment(piece: Column) -> Column:
    return piece.startswith("//") | piece.startswith("/*")


def strip_comments(code: Column) -> Column:
    """Replace each C comment by one space and the newlines it held.

    Line splices are deleted first. String and character literals are kept, and
    unterminated quotes or comments are left alone.
    """
    spliced = F.replace(F.replace(code, F.lit("\\\r\n"), F.lit("")), F.lit("\\\n"), F.lit(""))
    pieces = F.regexp_extract_all(spliced, F.lit(_CODE_PIECES), F.lit(0))
    blanked = F.transform(
        pieces,
        lambda p: F.when(
            _is_comment(p),
            F.concat(
                F.lit(" "),
                F.repeat(F.lit("\n"), F.length(p) - F.length(F.replace(p, F.lit("\n"), F.lit("")))),
            ),
        ).otherwise(p),
    )
    # Texts without a comment opener skip the regex altogether.
    return F.when(
        spliced.contains("//") | spliced.contains("/*"), F.array_join(blanked, "")
    ).otherwise(spliced)


def is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{WHITESPACE}]")


def strip_ends(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A[{WHITESPACE}]+|[{WHITESPACE}]+\z", "")


def source_hash(code: Column) -> Column:
    return F.sha2(code, 256)


def unix_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def unwrap_fence(text: Column) -> Column:
    """Inner code when the whole text is one ``` block, else the trimmed text."""
    return F.regexp_replace(
        strip_ends(text), rf"\A```(?:c|C)?[{WHITESPACE}]*\n([\s\S]*?)\n```\z", "$1"
    )


def model_input(text: Column) -> Column:
    return F.concat(F.lit(INPUT_PREFIX), text)


def collapse_spaces(text: Column) -> Column:
    """Runs of two or more whitespace characters become one space."""
    return F.regexp_replace(text, f"[{WHITESPACE}]{{2,}}", " ")


def words(text: Column) -> Column:
    """Lower-cased word tokens; one-letter words are kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]+"), F.lit(0))


def pieces(text: Column) -> Column:
    """Word and punctuation pieces, the default tokens of the window operators."""
    return F.regexp_extract_all(text, F.lit(f"[{WORD}]+|[^{WORD}{WHITESPACE}]"), F.lit(0))


def input_problem(code: Column, model: Column, mode: Column,
                  models: list[str], modes: list[str],
                  max_chars: int = MAX_CODE_CHARS) -> Column:
    """First failed validation rule as text, null when the row is valid."""
    return (
        F.when(code.isNull() | is_blank(code), F.lit("blank code"))
        .when(F.length(code) > max_chars, F.lit("too many characters"))
        .when(model.isNull() | ~model.isin(models), F.lit("unsupported model"))
        .when(mode.isNull() | ~mode.isin(modes), F.lit("unsupported mode"))
    )


def id_suffix(model_id: Column) -> Column:
    return F.element_at(F.split(model_id, "/"), -1)


def display_name(label: Column, names: dict[str, str]) -> Column:
    """Short name of a label; unknown labels show as themselves."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), label), label)


def percent(value: Column, digits: int = 2) -> Column:
    """``97.53%``; a missing value shows as an em dash."""
    return F.coalesce(F.concat(F.format_number(value * 100, digits), F.lit("%")), F.lit("—"))
