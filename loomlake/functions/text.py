"""Text expressions: stripping, script shares, token estimates, seeds and the small character tokenizer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The code points that count as Chinese, and the rates of the token estimate.
CHINESE = r"[\x{4E00}-\x{9FFF}]"
CHINESE_SHARE, CHINESE_CHARS, OTHER_CHARS = 0.30, 1.5, 3.2
#: Ids of the character tokenizer.
PAD, EOS, START, END = 0, 1, 2, 3
IGNORED = -100


def strip(text: Column) -> Column:
    """text without white space at both ends, by the Unicode rule and U+001C to U+001F."""
    return F.regexp_replace(text, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def first_filled(*columns: Column) -> Column:
    """The first of the columns that is neither null nor empty, else the empty text."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in columns], F.lit(""))


def joined(*columns: Column) -> Column:
    """The stripped columns that are not empty, joined by newlines."""
    parts = F.transform(F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), strip)
    return F.array_join(F.filter(parts, lambda x: x != ""), "\n")


def query_and_answer(query: Column, answer: Column) -> Column:
    return F.concat(F.coalesce(query, F.lit("")), F.lit("\n"), F.coalesce(answer, F.lit("")))


def script_share(text: Column, script: str = CHINESE) -> Column:
    """The share of code points that match a regular expression; 0 for empty texts."""
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(script)) / F.length(text)).otherwise(F.lit(0.0))


def token_estimate(text: Column) -> Column:
    rate = F.when(script_share(text) >= CHINESE_SHARE, F.lit(CHINESE_CHARS)).otherwise(F.lit(OTHER_CHARS))
    return F.when(F.length(text) > 0, F.greatest(F.lit(1), F.floor(F.length(text) / rate))).otherwise(F.lit(0)).cast("long")


def stable_seed(*parts: Column) -> Column:
    """The first 32 bits of the SHA-256 of the parts joined by two colons."""
    return F.conv(F.substring(F.sha2(F.concat_ws("::", *parts), 256), 1, 8), 16, 10).cast("long")


def character_ids(text: Column, vocabulary: int = 256) -> Column:
    """Ids of the character tokenizer: chat marks have their own, other code points share the rest."""
    if vocabulary < 32:
        raise ValueError("the vocabulary needs at least 32 ids")
    marked = F.regexp_extract_all(text, F.lit(r"(?s)<\|im_start\|>|<\|im_end\|>|."), F.lit(0))
    # splitting at the empty text gives code points and is far cheaper than a match for each
    plain = F.when(F.length(text) > 0, F.split(text, "")).otherwise(F.when(text.isNotNull(), F.array().cast("array<string>")))
    other = lambda c: (F.lit(4) + F.ascii(c) % (vocabulary - 4)).cast("int")
    special = F.transform(marked, lambda c: F.when(c == "<|im_start|>", START).when(c == "<|im_end|>", END).otherwise(other(c)).cast("int"))
    return F.when(F.contains(text, F.lit("<|im_")), special).otherwise(F.transform(plain, other))


def number(text: Column) -> Column:
    """A text as a double by the usual rule of scripting languages: white space around, underscores between digits; else null."""
    bare = strip(text)
    plain = F.when(bare.rlike(r"\d_\d"), F.regexp_replace(bare, r"(?<=\d)_(?=\d)", "")).otherwise(bare)
    # a suffix that only names a type makes no number
    return F.when(plain.rlike(r"(?i)^[+-]?(?:\d+\.?\d*(?:e[+-]?\d+)?|\.\d+(?:e[+-]?\d+)?|inf|infinity|nan)$"), F.regexp_replace(plain, r"(?i)^([+-]?)inf$", "$1Infinity").try_cast("double"))


def score(*columns: Column) -> Column:
    """The first column that is neither null nor empty, as a double; null where it is no number."""
    return number(F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in columns]))


def character_count(text: Column) -> Column:
    """How many ids `character_ids` gives, without building them: a chat mark counts once."""
    marks = F.regexp_count(text, F.lit(r"<\|im_start\|>")) * 11 + F.regexp_count(text, F.lit(r"<\|im_end\|>")) * 9
    return F.coalesce(F.length(text) - F.when(F.contains(text, F.lit("<|im_")), marks).otherwise(F.lit(0)), F.lit(0))


#: Named text functions: of the row's column names, the text.
TEXTS: dict[str, Callable[[list[str]], Column]] = {}


def text_function(name: str):
    """Decorator that adds a named text function."""

    def add(f: Callable[[list[str]], Column]):
        TEXTS[name] = f
        return f

    return add


@text_function("query_and_answer")
def _query_and_answer(columns: list[str]) -> Column:
    return query_and_answer(*[F.col(c) if c in columns else F.lit("") for c in ("query", "answer")])


def extracted(columns: list[str], of: str | list[str], join: bool = False, named: str | None = None) -> Column:
    """The text of a row: by a named function, or of the columns `of`, joined or the first that has any."""
    if named:
        if named not in TEXTS:
            raise ValueError(f"unknown text function {named!r}")
        return TEXTS[named](columns)
    have = [F.col(c) for c in ([of] if isinstance(of, str) else of) if c in columns]
    return F.lit("") if not have else joined(*have) if join else first_filled(*have)
