"""Cleaning, normalising and hashing of plan texts, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rx
from .rules import BY_INSTITUTION, GENERAL, NO_PLAN, NORMAL


def general_rules(text: Column) -> Column:
    """The rules for every institution, then trimmed."""
    return rx.trim(rx.apply(text, GENERAL))


def institution_rules(institution: Column, text: Column) -> Column:
    """The rules of the row's institution; null for a page that is no plan; other institutions pass through."""
    out: Column | None = None
    for name, rules in BY_INSTITUTION.items():
        done = rx.apply(text, rules)
        if name in NO_PLAN:
            done = F.when(~text.contains(NO_PLAN[name]), done)
        out = (F.when if out is None else out.when)(institution == name, done)
    return out.otherwise(text)


def anonymize(institution: Column, text: Column) -> Column:
    """The readable plan: institution rules, general rules; null or blank gives null."""
    return rx.blank_to_null(general_rules(institution_rules(institution, rx.blank_to_null(text))))


def normalize_plan(plan: Column) -> Column:
    """A lossy form for comparison: lower case, without headings, seasons and years."""
    return F.when(F.length(plan) > 0, rx.squish(rx.apply(F.lower(plan), NORMAL)))


def plan_id(normalized: Column) -> Column:
    """SHA-256 of the text, lower-case hex; null or empty gives null."""
    return F.when(F.length(normalized) > 0, F.sha2(normalized, 256))


def break_cells(html: Column) -> Column:
    """A line feed before the end of every table cell, so that cells don't run together."""
    return F.replace(F.replace(html, F.lit("</td>"), F.lit("\n</td>")), F.lit("</th>"), F.lit("\n</th>"))


def cut_timetable(text: Column) -> Column:
    return rx.trim(rx.replace_all(text, r"(?s)Vis detaljert timeplan.*$"))


def cut_render_error(text: Column) -> Column:
    return rx.trim(rx.replace_all(text, r"(?s)Error rendering component.*$"))


def tidy_lines(text: Column, drop: str) -> Column:
    """Without ``drop`` and blanks at line ends, with at most one empty line in a row."""
    text = rx.replace_all(rx.replace_all(text, drop), r"(?m)^[ \t]+|[ \t]+$")
    return rx.trim(rx.replace_all(text, r"\n{3,}", "\n\n"))


def shadow_text(text: Column) -> Column:
    """Text of a page that a browser rendered."""
    return tidy_lines(text, "keyboard_backspace")


def page_texts(pages: Column) -> Column:
    """The pages of a PDF as one text; null where nothing is left."""
    return rx.blank_to_null(rx.trim(rx.replace_all(F.array_join(pages, "\n"), r"\n{3,}", "\n\n")))


def module_name(name: Column) -> Column:
    """A module's name as join key: squished, lower case, its number joined to the subject."""
    return rx.replace_first(F.lower(rx.squish(name)), r"^(.+?)\s+(\d+)\s*,", "$1$2,")


#: Modules that the plans number otherwise than the registry.
RENUMBERED = {"pedagogikk og elevkunnskap1, emne 4": "pedagogikk og elevkunnskap2, emne 1", "pedagogikk og elevkunnskap1, emne 5": "pedagogikk og elevkunnskap2, emne 2"}


def renumber_module(name: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in RENUMBERED.items() for x in pair]), name), name)


def same_text(a: Column, b: Column) -> Column:
    """Equal but for blanks, tabs and line ends around them; two nulls are equal."""
    cut = lambda c: F.regexp_replace(c, r"\A[ \t\r\n]+|[ \t\r\n]+\z", "")
    return cut(a).eqNullSafe(cut(b))


def sentences(text: Column) -> Column:
    """Non-empty lines: split after full stops and at line feeds."""
    return F.filter(F.transform(F.split(rx.trim(text), r"(?U)(?<=\.)\s+|\n+"), rx.trim), lambda x: F.length(x) > 0)


def mentions(text: Column, code: Column) -> Column:
    return F.coalesce(F.lower(text).contains(F.lower(code)), F.lit(False))


#: What pages say instead of "not found".
SOFT_404 = {
    "ntnu": ("ntnu_no_info_error", "Det finnes ingen informasjon for dette studieåret|There is no information available for the given academic year"),
    "hvl": ("hvl_not_found_error", "Vi kunne ikkje finne emnet du ser etter"),
}


def soft_404(institution: Column, html: Column) -> Column:
    """The error class of a page that says, with status 200, that there is nothing; else null."""
    out = F.when(F.lit(False), F.lit(""))
    for name, (kind, says) in SOFT_404.items():
        out = out.when((institution == name) & html.rlike(says), F.lit(kind))
    return out


def has_text(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))


#: A heading that says "not found", and the least bytes of a page that stands without its code.
LOST_HEADING, LEAST_BYTES = r"(?i)siden ble ikke funnet|page not found|404", 120


def lost(h1: Column) -> Column:
    return F.coalesce(h1.rlike(LOST_HEADING), F.lit(False))


def page_ok(status: Column, content_type: Column, h1: Column, body: Column, code: Column) -> Column:
    """Whether an answer is a usable page: an HTML success whose heading isn't an error and which is long enough or names the code."""
    answered = (status >= 200) & (status < 400) & content_type.contains("text/html")
    return F.coalesce(answered & ~lost(h1) & ((F.octet_length(body) >= LEAST_BYTES) | mentions(body, code)), F.lit(False))
