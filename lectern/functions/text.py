"""Scalar functions over columns. All are built-in expressions, so plans stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHINESE, ENGLISH = "chinese", "english"
LANGUAGES = (CHINESE, ENGLISH)
#: Byte limits of the written fields.
MAX_TITLE, MAX_CONTENT, MAX_SUB_TITLE = 512, 64 * 1024, 1024
#: Sentinels of results.
MISSING, NO_NAME, EMPTY, MERGED = "⚠ MISSING", "⚠ 缺書名", "⚠ EMPTY", "併於上節。"
MAX_VERSE, MAX_CHAPTER = 300, 200


def trim_u(s: Column) -> Column:
    """Without leading and trailing Unicode white space."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def collapse(s: Column) -> Column:
    """Runs of Unicode white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def is_blank(s: Column) -> Column:
    """Null, empty or spaces only (ASCII, as SQL's TRIM has it)."""
    return F.trim(F.coalesce(s, F.lit(""))) == ""


def language(s: Column) -> Column:
    """The normalised language, or null where it is not supported."""
    name = F.lower(trim_u(s))
    return F.when(name.isin(*LANGUAGES), name)


def chapter_title(lang: Column, n: Column) -> Column:
    return F.when(lang == CHINESE, F.format_string("第 %d 章", n)).otherwise(F.format_string("Chapter %d", n))


def section_title(lang: Column, n: Column) -> Column:
    return F.when(lang == CHINESE, F.format_string("第%d節", n)).otherwise(F.format_string("verse %d", n))


def ref_key(usfm: Column, chapter: Column, verse: Column) -> Column:
    return F.format_string("%s.%d.%d", usfm, chapter, verse)


def split_refs(s: Column) -> Column:
    """References of one attribute, separated by plus signs or white space."""
    return F.filter(F.split(collapse(F.translate(s, "+", " ")), " "), lambda x: x != "")


def _whole(s: Column) -> Column:
    """An integer as strict as a decimal parser: optional sign and digits, nothing around them."""
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("int"))


def verse_numbers(refs: Column, usfm: Column, chapter: Column) -> Column:
    """Numbers of the references that lie in the given chapter, from 1 to ``MAX_VERSE``."""
    part = lambda r, i: F.get(F.split(r, r"\.", 3), i)
    number = lambda r: F.when((F.size(F.split(r, r"\.", 3)) == 3) & (part(r, 0) == usfm) & (_whole(part(r, 1)) == chapter), _whole(part(r, 2)))
    return F.filter(F.transform(refs, number), lambda n: n.isNotNull() & (n > 0) & (n <= MAX_VERSE))


def spec_key(chapter: Column, verses: Column) -> Column:
    return F.format_string("%02d-[%d]", chapter, verses)


def spec_chapter(key: Column) -> Column:
    """The chapter of a key; null where there is no dash or no number before it."""
    return F.when(F.instr(key, "-") > 0, _whole(F.substring_index(key, "-", 1)))


def int_list(s: Column, low: int = 1, high: int = 66) -> Column:
    """Comma-separated integers within bounds; bad elements are left out."""
    return F.filter(F.transform(F.split(s, ","), lambda x: _whole(trim_u(x))), lambda n: n.isNotNull() & n.between(low, high))


def version_url(base: Column | str, usfm: Column, chapter: Column, suffix: Column | str) -> Column:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.format_string("%s/%s.%d.%s", as_column(base), usfm, chapter, as_column(suffix))


def page_url(template: str, number: Column) -> Column:
    """A template with one %d."""
    return F.format_string(template, number)


def query_escape(s: Column) -> Column:
    """Form style: a space becomes a plus sign."""
    return F.url_encode(s)


def path_escape(s: Column) -> Column:
    return F.replace(F.url_encode(s), F.lit("+"), F.lit("%20"))


def see(key: Column) -> Column:
    return F.concat(F.lit("[See "), key, F.lit("]"))


def minutes(items: Column, per_second: Column) -> Column:
    """How long ``items`` requests take at a rate."""
    return items / per_second / 60
