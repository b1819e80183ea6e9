"""Course keys, seasons and the page address of a course at each institution."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import CODE, RAW, SEASON, YEAR
from . import rx

#: Fixed values.
SPRING, AUTUMN, SUMMER = "Vår", "Høst", "Sommer"


def or_na(c: Column) -> Column:
    """A null as the two letters that pasting gives it."""
    return F.coalesce(c.cast("string"), F.lit("NA"))


def strip_version(code: Column) -> Column:
    """A course code without one trailing number after ``-``, ``_`` or ``.``."""
    return F.regexp_replace(code, r"[-_.][0-9]+$", "")


def season_english(season: Column) -> Column:
    return F.when(season == SPRING, "spring").when(season == AUTUMN, "autumn").when(season == SUMMER, "summer").otherwise(season)


def season_slug(season: Column) -> Column:
    return F.when(season == SPRING, "var").when(season == AUTUMN, "host").otherwise(F.lower(season))


def academic_year(year: Column, season: Column) -> Column:
    """``2023-2024`` for autumn 2023 and spring 2024; null for other seasons."""
    first = F.when(season == AUTUMN, year).when(season == SPRING, year - 1)
    return F.concat(first.cast("string"), F.lit("-"), (first + 1).cast("string"))


def season_norwegian(raw: Column) -> Column:
    """Seasons as link texts and menus write them."""
    low = F.lower(raw)
    return F.when(low.isin("haust", "h"), AUTUMN).when(low.isin("vår", "v"), SPRING).otherwise(raw)


def course_id() -> Column:
    return F.concat_ws("_", *[or_na(c) for c in (F.col("institution_short"), F.col(RAW), F.col(YEAR), season_english(F.col(SEASON)), F.col("Status"))])


#: Address templates.  {CODE} and {code} are the code in upper and lower case, {Code} as it is.
TEMPLATES = {
    "oslomet": "https://student.oslomet.no/studier/-/studieinfo/emne/{CODE}/{year}/HØST",
    "uia": "https://www.uia.no/studier/emner/{year}/{slug}/{code}.html",
    "ntnu": "https://www.ntnu.no/studier/emner/{CODE}/{year}",
    "inn": "https://studiekatalog.edutorium.no/inn/nb/emne/{Code}/{year}-{slug}",
    "hiof": "https://www.hiof.no/studier/emner/{branch}/{year}/{slug}/{code}.html",
    "hvl": "https://www.hvl.no/studier/studieprogram/emne/{year}/{Code}",
    "mf": "https://mf.no/studier/emner/{code}",
    "nla": "https://www.nla.no/for-studenter/Studie-%20og%20emneplaner/emneplan/{Code}/{from}-{to}",
    "nord": "https://www.nord.no/studier/emner/{code}?year={year}&semester={encoded}",
    "nih": "https://www.nih.no/studier/emner/{year}/{slug}/{code}.html",
    "uib": "https://www4.uib.no/studier/emner/{code}?start_semester={year}{letter}",
    "uio": "https://www.uio.no/studier/emner/{faculty}/{CODE}/",
    "uis": "https://www.uis.no/nb/student/course/{UNDERSCORED}",
    "nmbu": "https://www.nmbu.no/emne/{CODE}",
}
#: Paths of departments.
FACULTIES = {
    "Biologisk institutt": "matnat/ibv",
    "Det utdanningsvitenskapelige fakultet": "uv/uv",
    "Fysisk institutt": "matnat/fys",
    "Institutt for arkeologi, konservering og historiske studier": "hf/iakh",
    "Institutt for biovitenskap": "matnat/ibv",
    "Institutt for geofag": "matnat/geofag",
    "Institutt for informatikk": "matnat/ifi",
    "Institutt for lingvistiske og nordiske studier": "hf/iln",
    "Institutt for litteratur, områdestudier og europeiske språk": "hf/ilos",
    "Institutt for lærerutdanning og skoleforskning": "uv/ils",
    "Institutt for medier og kommunikasjon": "hf/imk",
    "Institutt for molekylær biovitenskap": "matnat/ibv",
    "Institutt for nordistikk og litteraturvitenskap": "hf/iln",
    "Institutt for sosiologi og samfunnsgeografi": "sv/sv",
    "Kjemisk institutt": "matnat/kjemi",
    "Klassisk og romansk institutt": "hf/ifikk",
    "Matematisk institutt": "matnat/math",
    "Naturfagsenteret": "matnat/naturfagsenteret",
}
#: From this year on the catalogue has pages.
INN_FROM = 2022


def _fields() -> dict[str, Column]:
    code, year, season = F.col(CODE), F.col(YEAR), F.col(SEASON)
    spring = season == SPRING
    start = F.when(spring, year - 1).when(~spring, year)
    old = (year < 2021) | ((year == 2021) & spring)
    return {
        "Code": code,
        "CODE": F.upper(code),
        "code": F.lower(code),
        "UNDERSCORED": F.upper(F.replace(F.col(RAW), F.lit("-"), F.lit("_"))),
        "year": year,
        "slug": season_slug(season),
        "letter": F.when(spring, "V").otherwise("H"),
        "encoded": F.when(spring, "V%C3%85R").otherwise("H%C3%98ST"),
        "branch": F.when(old, "historiske-emner/lu").otherwise("lusp/lusp"),
        "from": start,
        "to": start + 1,
    }


def course_url(has_faculty: bool = True) -> Column:
    """The page of a course; null where it must be discovered, and for institutions without pages.

    An unknown department gives null rather than an address that can't exist.
    """
    fields, institution = _fields(), F.col("institution_short")
    out = F.when(F.lit(False), F.lit(""))
    for name, template in TEMPLATES.items():
        parts = []
        for fixed, field in re.findall(r"([^{]+)|\{(\w+)\}", template):
            if fixed:
                parts.append(F.lit(fixed))
            elif field == "faculty":
                known = F.create_map(*[F.lit(x) for pair in FACULTIES.items() for x in pair])
                parts.append(F.element_at(known, F.col("Avdelingsnavn")) if has_faculty else F.lit(None).cast("string"))
            else:
                parts.append(or_na(fields[field]))
        url = F.concat(*parts)
        if name == "inn":
            url = F.when(F.col(YEAR) >= INN_FROM, url)
        if name == "hiof":
            url = F.when(F.col(YEAR).isNotNull() & (F.col(SEASON).isNotNull() | (F.col(YEAR) != 2021)), url)
        out = out.when(institution == name, url)
    return out


def link_term(text: Column) -> tuple[Column, Column]:
    """(year, season) of a link text such as ``2024 Haust``."""
    return rx.extract(text, r"(\d{4})\s+(\S+)", 1).try_cast("int"), season_norwegian(rx.extract(text, r"(\d{4})\s+(\S+)", 2))


def option_term(text: Column) -> tuple[Column, Column]:
    """(year, season) of a menu entry such as ``ABC-100: H 2023``."""
    pattern = r":\s+([HV])\s+(\d{4})"
    return rx.extract(text, pattern, 2).try_cast("int"), season_norwegian(rx.extract(text, pattern, 1))


def leading_year(label: Column) -> Column:
    return rx.extract(label, r"^\d{4}", 0).try_cast("int")
