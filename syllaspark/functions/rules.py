"""The ordered rules that take personal and administrative detail out of plans.

Order matters within each list: a rule may rely on what an earlier one removed.
"""

from __future__ import annotations

from .rx import Rule

#: Rules of single institutions, which run before the general ones.
BY_INSTITUTION: dict[str, list[Rule]] = {
    "ntnu": [
        Rule(r"Kontaktinformasjon[\s\S]*$", once=True),
        Rule(r"course-details-portlet\s*"),
        Rule(r"moment\.locale\([^)]+\);?\s*"),
        Rule(r"Velg studieår\s*"),
        Rule(r"Studieår \d{4}/\d{4}\s*"),
        Rule(r"Undervisningsstart[^\n]+"),
        Rule(r"Blackboard\s*-\s*\S+"),
        Rule(r"Andre sider om emnet\s*"),
        Rule(r"Alt om eksamen ved NTNU\s*"),
    ],
    "uit": [
        Rule(r"Startsida\s*\n\s*Emnekatalog\s*"),
        Rule(r"Error rendering component\s*"),
        Rule(r"Se timeplan\s*"),
        Rule(r"(?m)^Kontaktperson:?\s*\n[^\n]*"),
        Rule(r"(?m)^Foreleser:?\s*\n[^\n]*"),
    ],
    "uia": [
        Rule(r"Forside\s*>\s*Studier\s*>\s*Emner\s*>\s*\d{4}\s*>\s*(?:Høst|Vår|Haust)\s+\d{4}\s*>\s*", once=True),
        Rule(r"\((?:Høst|Vår|Haust)\s+\d{4}\)"),
        Rule(r"(?m)^Emneansvarlig:\s*\n[^\n]+(?=\n)"),
    ],
    "hiof": [
        Rule(r"Sist hentet fra FS[^\n]*"),
        Rule(r"Litteraturlista er sist oppdatert[^\n]*"),
        Rule(r"(?m)^Emneansvarlige?:\s*\n(?:(?![A-ZÆØÅ][\w ]+:)[^\n]*\n?)*", once=True),
        Rule(r"(Kunnskap|Ferdigheter|Generell kompetanse|Kompetanse)(?=[A-ZÆØÅ])", "$1 "),
    ],
    "inn": [
        Rule(r"NameCreditsDateComment"),
        Rule(r"(?m)^Name\s*$"),
        Rule(r"(?m)^Credits\s*$"),
        Rule(r"(?m)^Date\s*$"),
        Rule(r"(?m)^Comment\s*$"),
        Rule(r"Statusmelding\s*\n?Emnebeskrivelsen for valgt semester er ikke publisert enda\.[^\n]*"),
        Rule(r"(?m)^\d{4}\s+(?:Høst|Vår|Autumn|Spring)(?:,\s*\d{4}\s+(?:Høst|Vår|Autumn|Spring))*\s*$"),
        Rule(r"\bEngelsk\b", "English"),
    ],
    "oslomet": [
        Rule(r"(?m)^\s*;\s*$"),
        Rule(r"(?<=\s);(?=\s)"),
        Rule(r"(?m)^Emneansvarlig[ \t]*\n+\p{Lu}[\p{L} .,-]+(?=\n|$)", once=True),
    ],
    "mf": [
        Rule(r"Emneansvarlig\s*\n[\s\S]*$", once=True),
        Rule(r"Kontakt studieveileder\s*"),
        Rule(r"Vis flere\s*"),
    ],
    "hivolda": [
        Rule(r"(?m)^Emneansvarleg:\s*\n[^\n]*", once=True),
        Rule(r"(?m)^Godkjent av:\s*\n[^\n]*", once=True),
    ],
    "uis": [
        Rule(r"(?m)^Kontakt\s*\n[\s\S]*\z", once=True),
        Rule(r"Emnebeskrivelsen er hentet fra[^\n]*"),
        Rule(r"(?m)^\s*EMNE\s+\S+\s+\S+\s+Versjon[^\n]*"),
        Rule(r"(?s)Fagpersoner\s*\n.*?(?=\n\n|$)", once=True),
        Rule(r"Powered by TCPDF[^\n]*"),
        Rule(r"(?m)^\s*side\s+\d+\s*$"),
    ],
    "steiner": [Rule(r"(?m)^\s*Side\s+\d+\s+av\s+\d+\s*$")],
    "usn": [
        Rule(r"(?m)^Godkjent emneplan\s*$"),
        Rule(r"(?m)^Godkjent\s+\d{1,2}\.\d{1,2}\.\d{4}[^\n]*"),
    ],
    "uib": [
        Rule(r"(?m)^Studierettleiar:?\s*[^\n]*"),
        Rule(r"(?m)^Studieveileder:?\s*[^\n]*"),
        Rule(r"(?m)^Eksamensadministrasjon:?\s*[^\n]*"),
        Rule(r"Studierettleiar kan kontaktast her:\s*"),
        Rule(r"(?m)^Kontakt:?\s*[^\n]*"),
    ],
    "nmbu": [Rule(r"Emneansvarlig:?\s*\p{Lu}[\p{L} .,-]+(?=\n|$)")],
    "uio": [Rule(r"\p{Lu}\p{Ll}+(?:\s+\p{Lu}\p{Ll}+)+\s*(?=\([\w.+-]+@)")],
}

#: A page that holds this is no plan at all.
NO_PLAN: dict[str, str] = {"inn": "Emnesøket gjelder kun fra", "oslomet": "Siden du leter etter finnes ikke"}

#: Rules for every institution.
GENERAL: list[Rule] = [
    Rule(r"Sist hent(?:et|a) fr(?:a|å) FS \(Felles studentsystem\)[^\n]*"),
    Rule(r"\b[\w.+-]+@[\w.-]+\.[a-zA-Z]{2,}\b"),
    Rule(r"(?i)(?:tlf|telefon)\s*:?\s*(?:\+47\s*)?\d[\d ]{6,}"),
    Rule(r"\+47\s*\d[\d ]{6,}"),
    Rule(r"\d{1,2}\.\s*(?:jan|feb|mar|apr|mai|jun|jul|aug|sep|okt|nov|des)\.?\s*\d{4}\s*\d{2}:\d{2}(?::\d{2})?"),
    Rule(r"(?i)(?:høst|vår|haust|autumn|spring)\s*\d{2}\b"),
    Rule(r"(?i)(?:høst|vår|haust|autumn|spring|sommer|summer)\s+\d{4}"),
    Rule(r"(?i)\d{4}\s+(?:høst|vår|haust|autumn|spring|sommer|summer)"),
    # a season after one of these words; looking back only once a season is found is fifteen times faster
    Rule(r"(?i)(?:høst|vår|haust|autumn|spring|sommer|summer)(?<=(?:semester|undervisning|oppstart|startsemester|eksamen)[:\s]{0,3}(?:høst|vår|haust|autumn|spring|sommer|summer))"),
    Rule(r"\d{1,2}\.\d{1,2}\.\d{4}"),
    Rule(r"(?i)(opprettet|oppdatert|revidert|vedtatt|godkjent|gjeldende(?: fra)?|gyldig(?: fra)?|sist (?:endret|revidert|oppdatert))\s+\d{4}\b", "$1"),
    Rule(r"\b\d{4}/\d{2,4}\b"),
    Rule(r"\b\d{1,2}:\d{2}(?::\d{2})?\b"),
    Rule(r"function\s*\([^)]*\)\s*\{[^}]*\}"),
    Rule(r"\$\([^)]+\)\.[^;]+;"),
    Rule(r"(?m)[ \t]+$"),
    Rule(r"\n{3,}", "\n\n"),
]

#: Section headings that normalisation drops, first alternative first.
HEADINGS = [
    "startsemestre", "startsemester", "emnekode", "studiepoeng",
    "undervisningssemestre", "undervisnings- og eksamensspråk",
    "undervisningssted", "forkunnskapskrav", "anbefalte forkunnskaper",
    "krav til forkunnskaper",
    "emnets innhold", "læringsutbytte", "kunnskap", "ferdigheter",
    "generell kompetanse", "arbeids- og undervisningsformer",
    "eksamen", "vurderingsordning", "vurderingsformer",
    "pensum", "arbeidskrav", "emneansvarlig", "sist revidert",
    "obligatoriske aktiviteter",
    "course code", "number of credits", "teaching semester",
    "language of instruction and examination",
    "campus", "required prerequisite knowledge",
    "course content", "learning outcomes?", "knowledge", "skills",
    "general competence", "teaching and working methods",
    "examination", "reading list", "course coordinator",
    "compulsory activities", "work requirements",
    "assessment methods", "teaching and learning activities",
]

#: What normalisation drops and rewrites, on lower-case text.
NORMAL: list[Rule] = [
    Rule(r"\b(?:" + "|".join(HEADINGS) + r")\b"),
    Rule(r"\b(?:høst|vår|haust|autumn|spring|sommer|summer)\b"),
    Rule(r"\b(?:19|20)\d{2}\b"),
    Rule(r"\beksamensformer\b", "vurderingsformer"),
]
