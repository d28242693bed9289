"""Text hygiene. Everything but NFKC is a built-in expression; NFKC runs on Arrow batches."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A cased letter: lower, upper or title case.
_CASED = r"[\p{IsLowercase}\p{IsUppercase}\p{Lt}]"


@F.arrow_udf(T.StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    if texts.null_count == len(texts):
        return texts
    folded = [t and unicodedata.normalize("NFKC", t) for t in texts.to_pylist()]
    return pa.array(folded, pa.string())


# Without this mark, a filter on cleaned text is pushed below the call and runs Python twice.
_nfkc = _nfkc.asNondeterministic()


def with_folded(df: DataFrame, columns: list[str]) -> DataFrame:
    """Compatibility-fold (NFKC) text columns.

    Pure ASCII, which has a byte for each character, is already folded, so only other texts are sent
    to Python, as Arrow batches.
    """
    return df.withColumns(
        {
            c: F.coalesce(_nfkc(F.when(F.octet_length(c) > F.length(c), F.col(c))), F.col(c))
            for c in columns
        }
    )


def collapse(c: Column) -> Column:
    """Every run of whitespace, Unicode ones included, becomes one blank; no outer blanks.

    Most text needs nothing, which a plain look at it tells sooner than a replacement does.
    """
    blanks = c.contains("  ") | c.startswith(" ") | c.endswith(" ")
    collapsed = F.trim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))
    return F.when(blanks | c.rlike(r"[^\x20-\x7E]"), collapsed).otherwise(c)


def with_clean_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Folded text with single inner blanks; NULL becomes empty."""
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in columns})
    return with_folded(filled, columns).withColumns({c: collapse(F.col(c)) for c in columns})


def title_case(c: Column) -> Column:
    """Upper-case each letter that does not follow a letter ("sun-dried" -> "Sun-Dried").

    ``initcap`` only looks at blanks, which is enough for plain words.
    """
    words = F.split(F.lower(c), f"(?<!{_CASED})(?={_CASED})")
    pieced = F.array_join(
        F.transform(
            words,
            lambda w: F.concat(
                F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w))
            ),
        ),
        "",
    )
    return F.when(c.rlike("^[A-Za-z ]*$"), F.initcap(c)).otherwise(pieced)


def filled_parts(c: Column, separator: str = ",") -> Column:
    """The non-blank parts of a separated list."""
    return F.filter(F.split(c, separator), lambda p: F.trim(p) != "")


def contains_any(c: Column, words: tuple[str, ...]) -> Column:
    return c.rlike("(?i)" + "|".join(words))


def drop_suffix(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")
