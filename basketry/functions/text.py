"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The 25 characters Unicode calls white space.
WHITE_SPACE = (
    "\t\n\u000b\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Besides white space, a new word starts after any of these.
WORD_BREAKS = "[](){}/|<>!?@\"^#$&~_,.:;*%+-"

_JOINT = "\u0001 "


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip_space(text: Column | str) -> Column:
    """Trim Unicode white space at both ends (Spark's ``trim`` knows the blank only).

    A text whose ends are both visible ASCII stays as it is: comparing two characters is
    much cheaper than a trim, which looks for each character in the set.
    """
    column = as_column(text)
    visible = [F.substring(column, at, 1).between("!", "~") for at in (1, -1)]
    return F.when(visible[0] & visible[1], column).otherwise(F.trim(column, F.lit(WHITE_SPACE)))


def blank_to_null(text: Column | str) -> Column:
    return F.nullif(strip_space(text), F.lit(""))


def capitalize_words(text: Column | str) -> Column:
    """Upper-case the first letter of each word, where punctuation also ends a word.

    Spark's ``initcap`` starts words after a blank only, so a marked blank is put
    behind every other break, and taken out again afterwards.
    """
    breaks = "".join(f"\\{c}" for c in WORD_BREAKS)
    spaced = F.regexp_replace(as_column(text), f"(?U)([{breaks}]|[\\s&&[^ ]])", "$1" + _JOINT)
    return F.replace(F.initcap(spaced), F.lit(_JOINT), F.lit(""))


def last_position(text: Column | str, mark: str) -> Column:
    """1-based position of the last occurrence of a one-character mark, 0 when absent."""
    if len(mark) != 1:
        raise ValueError("mark must be a single character")
    column = as_column(text)
    from_end = F.locate(mark, F.reverse(column))
    return F.when(from_end == 0, F.lit(0)).otherwise(F.length(column) - from_end + 1)


def url_host(url: Column | str) -> Column:
    """Host of a URL without user and port; scheme-less text counts as a host.

    What stands between ``https://`` and the next slash is the host if no mark that ends or
    precedes one is in it, which costs less to find out than the pattern does.
    """
    text = strip_space(url)
    plain = F.substring_index(F.substr(text, F.lit(len("https://") + 1)), "/", 1)
    marked = plain.contains("@") | plain.contains(":") | plain.contains("?") | plain.contains("#")
    host = F.regexp_extract(
        text,
        r"^(?:(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//)?(?:[^/?#@]*@)?([^/?#:]+)",
        1,
    )
    return F.nullif(F.when(text.startswith("https://") & (plain != "") & ~marked, plain).otherwise(host), F.lit(""))


def url_authority(url: Column | str) -> Column:
    """Everything between ``//`` and the path, user and port included; '' without one."""
    return F.regexp_extract(as_column(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def contains_any(text: Column | str, words: list[str]) -> Column:
    upper = F.upper(as_column(text))
    found = upper.contains(words[0])
    for word in words[1:]:
        found = found | upper.contains(word)
    return found


def catalog_url(domain: Column | str, product_id: Column | str) -> Column:
    return F.concat(
        F.lit("https://"), as_column(domain),
        F.lit("/catalog/product/view/id/"), as_column(product_id),
    )


def meta_content(html: Column | str, name: str, attribute: str = "property") -> Column:
    """Trimmed ``content`` of the first ``<meta>`` tag with the given property; null if none."""
    tag = F.regexp_extract(
        as_column(html),
        rf"""(?is)(<meta\b[^>]*\b{attribute}\s*=\s*["']{name}["'][^>]*>)""",
        1,
    )
    double_quoted = F.regexp_extract(tag, r'(?is)\bcontent\s*=\s*"([^"]*)"', 1)
    single_quoted = F.regexp_extract(tag, r"(?is)\bcontent\s*=\s*'([^']*)'", 1)
    raw = F.when(double_quoted != "", double_quoted).when(single_quoted != "", single_quoted)
    return strip_space(raw)


def is_filled(text: Column | str) -> Column:
    """Neither null nor the empty string."""
    column = as_column(text)
    return column.isNotNull() & (column != "")
