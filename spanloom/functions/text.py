"""Column functions over text: blanks, headings, ids, titles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed value: the characters that count as blanks (the Unicode blanks and the four separators of the C0 set).
BLANKS = "\t\n\x0b\x0c\r \x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Heading patterns. The first two may both apply; of the others the first that does, and only without those.
DATA_HEADING = r"(?i)(\bdata\b[^.]{0,40}\bavailab|\bavailab[^.]{0,40}\bdata\b|\bdata\s+(access|sharing|deposition)|\baccession\s+(number|code)s?\b)"
CODE_HEADING = r"(?i)(\b(code|software)\b[^.]{0,40}\bavailab|\bavailab[^.]{0,40}\b(code|software)\b)"
HEADINGS = [
    ("methods", r"(?i)(\bmethods?\b|\bexperimental\s+procedures\b|\bmaterials\b|\bstar\W*methods\b|\bonline\s+methods\b)"),
    ("results", r"(?i)(\bresults?\b|\bfindings\b)"),
    ("discussion", r"(?i)(\bdiscussion\b|\bconclusions?\b)"),
    ("introduction", r"(?i)(\bintroduction\b|\bbackground\b)"),
    ("abstract", r"(?i)\babstract\b"),
]
#: Labels told by a section's type attribute.
SECTION_TYPES = {
    "data-availability": "data_availability", "code-availability": "code_availability", "materials|methods": "methods", "methods": "methods",
    "results": "results", "discussion": "discussion", "intro": "introduction", "conclusions": "discussion",
}


def squeeze(c: Column) -> Column:
    """Runs of blanks as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"[{BLANKS}]+", " "))


def heading_labels(title: Column, section_type: Column | None = None) -> Column:
    """The labels of a heading, in order; empty where it is of no known kind."""
    kind = F.lower(section_type) if section_type is not None else F.lit(None).cast("string")
    typed = F.lit(None).cast("string")
    for name, label in SECTION_TYPES.items():
        typed = F.when(kind == name, label).otherwise(typed)
    title = F.coalesce(title, F.lit(""))
    first = F.array_distinct(F.array_compact(F.array(typed, F.when(title.rlike(DATA_HEADING), "data_availability"), F.when(title.rlike(CODE_HEADING), "code_availability"))))
    other = F.lit(None).cast("string")
    for label, pattern in reversed(HEADINGS):
        other = F.when(title.rlike(pattern), label).otherwise(other)
    return F.when(F.size(first) > 0, first).otherwise(F.array_compact(F.array(other)))


def title_form(c: Column) -> Column:
    """Lower-case letters and digits of a title, at most 90; empty for null."""
    return F.coalesce(F.substring(F.regexp_replace(F.lower(c), "[^a-z0-9]", ""), 1, 90), F.lit(""))


def doi_prefix(c: Column) -> Column:
    """What stands before the first slash; null for null or empty."""
    return F.when(F.coalesce(c, F.lit("")) != "", F.split_part(c, F.lit("/"), F.lit(1)))


def last_segment(c: Column) -> Column:
    """The last part of a path or address."""
    return F.element_at(F.split(F.rtrim(c, F.lit("/")), "/"), -1)


def short_doi(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "^https?://(dx\\.)?doi\\.org/", "")


def short_pmcid(c: Column) -> Column:
    short = last_segment(c)
    return F.when(short.startswith("PMC"), short).otherwise(F.concat(F.lit("PMC"), short))


def surname(c: Column) -> Column:
    """The last word of a name in lower case."""
    return F.nullif(F.lower(F.element_at(F.split(squeeze(c), " "), -1)), F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


#: Fixed value: where a date has its year, in any delivered spelling (ISO, slashes, digits alone, month names).
YEAR = "(^|[^0-9])([12][0-9][0-9][0-9])([0-9][0-9][0-9][0-9])?([^0-9]|$)"
#: Availability of a text.
STATUSES = ["fulltext", "abstract_only", "preprint_requester_pays_pending", "unavailable", "unresolved"]


def year_of(c: Column) -> Column:
    """The year of a date in any delivered spelling; null where there is none."""
    return F.nullif(F.regexp_extract(c, YEAR, 2), F.lit("")).cast("int")


def status_form(c: Column) -> Column:
    """The availability in its stored spelling, whatever case, blanks and separators it came with; other values as they are."""
    letters = F.regexp_replace(F.lower(c), "[^a-z]", "")
    at = F.array_position(F.array(*[F.lit(x.replace("_", "")) for x in STATUSES]), letters)
    return F.when(at > 0, F.element_at(F.array(*map(F.lit, STATUSES)), F.nullif(at, F.lit(0)).cast("int"))).otherwise(c)


def listed(c: Column) -> Column:
    """A value that may hold several, separated by ``;``, as an array without blanks and empty parts; null for null."""
    return F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x)), lambda x: x != "")


def month_prefix(day: Column) -> Column:
    """``January_2024`` for a day."""
    return F.date_format(day, "MMMM_yyyy")


def article_id(doi: Column) -> Column:
    """The last dotted part of a DOI's last segment."""
    return F.element_at(F.split(last_segment(doi), "[.]"), -1)


def file_version(name: Column) -> Column:
    """The version in ``PMC<id>.<version>.xml``; null without one."""
    return F.nullif(F.regexp_extract(name, r"PMC\d+\.(\d+)\.xml$", 1), F.lit(""))


def stated(c: Column) -> Column:
    """Is a value stated: not null, empty or the sentinel?"""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("not_stated")) != "not_stated"


def bare_name(c: Column) -> Column:
    """A name without case, blanks and separators, for counting spellings as one."""
    return F.lower(F.regexp_replace(c, "[ _.-]", ""))


def abstract_from_index(index: Column) -> Column:
    """The text of an inverted index (token -> positions)."""
    pairs = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("t")))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda x: x["t"]), " ")


def flat_value(values: Column) -> Column:
    """A list as one CSV cell; empty for null."""
    return F.coalesce(F.array_join(values, ";"), F.lit(""))
