"""Licence scans: texts in canonical form, looked up by digest among known licences.

A text is lower-cased, its copyright lines are dropped, equivalent spellings are made one,
punctuation and white space become single blanks; the SHA-256 of what is left is its digest.
Licences are looked up by the digest of a form that does not depend on line breaks: only real
copyright notices are dropped, and spellings are made one after white space.  Known are the
bundled texts with their usual titles, list marks and appendices, and one-line notices.
Looked up are the whole text of a document and each of its lines.

Null and empty texts have the digest of the empty text, which is no licence; other columns
are not read; repeated rows are looked up one by one and appear as often.  Texts known under
two names give a row for each.
"""

from __future__ import annotations

import re
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import whole

COPYRIGHT_LINE = r"(?md)^[ \t]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"
# Spellings that make no difference.
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"),
    ("copyright holder", "copyright owner"), ("acknowledgement", "acknowledgment"), ("favour", "favor"),
    ("organisation", "organization"), ("merchantibility", "merchantability"), ("http://", "https://"),
    ("©", "(c)"), ("per cent", "percent"), ("whilst", "while"), ("fulfil ", "fulfill "),
)
# One-line notices.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)
# A line with a copyright mark, a year or a place for one; a sentence may begin a line with the word.
NOTICE_LINE = (r"(?md)^[^\p{L}\p{N}\n(©\[<]*(copyright\b[^\p{L}\p{N}\n]*((\(c\)|©|[0-9]{4}|[<\[{](year|yyyy))[^\n]*)"
               r"|(\(c\)|©)[ \t]*([0-9]{4}|[<\[{](year|yyyy)|copyright)[^\n]*|all rights reserved[^\p{L}\p{N}\n]*)$")
NAMED = " neither the names? of .{1,200}? nor the names of (its|their|any|other|the)( of its)? contributors "
# Titles that stand above a text or are left out.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "BSD License"),
    "Zlib": ("zlib License", "The zlib License", "The zlib/libpng License"),
}
LAST_LINE = "END OF TERMS AND CONDITIONS"


def known() -> list[tuple[str, str]]:
    """(licence, text) of the bundled licences and the notices."""
    folder = resources.files("basketry.llm") / "licences"
    full = [(f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in folder.iterdir() if f.name.endswith(".txt")]
    return sorted(full) + list(NOTICES)


def variants(name: str, text: str) -> list[str]:
    """A full text as it is, without its appendix, and with other titles and list marks."""
    made = [text]
    if LAST_LINE in text:
        terms = text[:text.index(LAST_LINE)]
        made += [terms, terms + LAST_LINE]
    titles = TITLES.get(name, ())
    if titles:
        first, _, rest = text.partition("\n")
        plain = lambda t: re.sub(r"\W+", " ", t.lower()).strip()
        body = rest if plain(first) in map(plain, titles) else text
        bodies = [body, re.sub(r"(?m)^[ \t]*[0-9][.)][ \t]+", "", body)]
        made += [title + "\n" + b for title in ("", *titles) for b in bodies]
    return list(dict.fromkeys(made))


def all_known() -> list[tuple[str, str]]:
    """(licence, text) of the known texts and notices and of more full texts."""
    folder = resources.files("basketry.llm") / "licences" / "more"
    more = [(f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in folder.iterdir() if f.name.endswith(".txt")]
    return known() + sorted(more)


def canonical(text: Column) -> Column:
    text = F.regexp_replace(F.lower(whole(text)), COPYRIGHT_LINE, "")
    text = reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, text)
    return F.trim(F.regexp_replace(text, BETWEEN_WORDS, " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def lookup_digest(text: Column) -> Column:
    """Digest of a form that is the same however the lines are broken."""
    text = F.regexp_replace(F.lower(whole(text)), NOTICE_LINE, "")
    text = F.concat(F.lit(" "), F.trim(F.regexp_replace(text, BETWEEN_WORDS, " ")), F.lit(" "))
    for old, new in SPELLINGS:
        plain, other = (" ".join(re.findall(r"\w+", t)) for t in (old, new))
        if old[-1] in " /":  # a whole word
            plain, other = f" {plain} ", f" {other} "
        if plain:
            text = F.replace(text, F.lit(plain), F.lit(other))
    text = F.regexp_replace(text, NAMED, " neither the name of the copyright owner nor the names of its contributors ")
    return F.sha2(F.trim(text).cast("binary"), 256)


def known_digests(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """(license_digest, license_id) of a fixed, short list of texts."""
    spelled = [(name, text) for name, full in texts for text in variants(name, full)]
    rows = F.array(*[F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("license_text")) for name, text in spelled])
    made = spark.range(1).select(F.inline(rows)).select(lookup_digest(F.col("license_text")).alias("d"), "license_id").distinct()
    digests = F.array(*[F.struct(F.lit(r["d"]).alias("license_digest"), F.lit(r["license_id"]).alias("license_id")) for r in made.collect()])
    return spark.range(1).select(F.inline(digests))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """A row for the whole text of each document (line_no 0) and one for each line that is a known notice.

    Columns: doc_id, line_no, digest, license_id (null where the whole text is no known licence).
    """
    units = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.posexplode(F.concat(F.array(whole(F.col(text))), F.split(whole(F.col(text)), "\n"))).alias("line_no", "unit"))
    hashed = units.where((F.col("line_no") == 0) | (F.col("unit") != "")).select(
        "doc_id", F.col("line_no").cast("long").alias("line_no"), digest(F.col("unit")).alias("digest"),
        lookup_digest(F.col("unit")).alias("looked_up"))
    listed = known_digests(docs.sparkSession, texts or all_known())
    return (hashed.join(listed, F.col("looked_up") == F.col("license_digest"), "left").drop("license_digest", "looked_up")
            .where((F.col("line_no") == 0) | F.col("license_id").isNotNull()))
