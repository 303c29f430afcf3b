"""Fixed values the results depend on, as small literal maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Job types and the spellings that mean them. The first spelling
# of each type is the one written to results.
JOB_TYPES: dict[str, tuple[str, ...]] = {
    "FULL_TIME": (
        "fulltime",
        "períodointegral",
        "estágio/trainee",
        "cunormăîntreagă",
        "tiempocompleto",
        "vollzeit",
        "voltijds",
        "tempointegral",
        "全职",
        "plnýúvazek",
        "fuldtid",
        "دوامكامل",
        "kokopäivätyö",
        "tempsplein",
        "πλήρηςαπασχόληση",
        "teljesmunkaidő",
        "tempopieno",
        "heltid",
        "jornadacompleta",
        "pełnyetat",
        "정규직",
        "100%",
        "全職",
        "งานประจำ",
        "tamzamanlı",
        "повназайнятість",
        "toànthờigian",
    ),
    "PART_TIME": ("parttime", "teilzeit", "částečnýúvazek", "deltid"),
    "CONTRACT": ("contract", "contractor"),
    "TEMPORARY": ("temporary",),
    "INTERNSHIP": ("internship", "prácticas", "ojt(onthejobtraining)", "praktikum", "praktik"),
    "PER_DIEM": ("perdiem",),
    "NIGHTS": ("nights",),
    "OTHER": ("other",),
    "SUMMER": ("summer",),
    "VOLUNTEER": ("volunteer",),
}

# Country key -> (names, board site code, review site domain).
COUNTRIES: dict[str, tuple[str, str, str | None]] = {
    "ARGENTINA": ("argentina", "ar", "com.ar"),
    "AUSTRALIA": ("australia", "au", "com.au"),
    "AUSTRIA": ("austria", "at", "at"),
    "BAHRAIN": ("bahrain", "bh", None),
    "BANGLADESH": ("bangladesh", "bd", None),
    "BELGIUM": ("belgium", "be", "fr:be"),
    "BULGARIA": ("bulgaria", "bg", None),
    "BRAZIL": ("brazil", "br", "com.br"),
    "CANADA": ("canada", "ca", "ca"),
    "CHILE": ("chile", "cl", None),
    "CHINA": ("china", "cn", None),
    "COLOMBIA": ("colombia", "co", None),
    "COSTARICA": ("costa rica", "cr", None),
    "CROATIA": ("croatia", "hr", None),
    "CYPRUS": ("cyprus", "cy", None),
    "CZECHREPUBLIC": ("czech republic,czechia", "cz", None),
    "DENMARK": ("denmark", "dk", None),
    "ECUADOR": ("ecuador", "ec", None),
    "EGYPT": ("egypt", "eg", None),
    "ESTONIA": ("estonia", "ee", None),
    "FINLAND": ("finland", "fi", None),
    "FRANCE": ("france", "fr", "fr"),
    "GERMANY": ("germany", "de", "de"),
    "GREECE": ("greece", "gr", None),
    "HONGKONG": ("hong kong", "hk", "com.hk"),
    "HUNGARY": ("hungary", "hu", None),
    "INDIA": ("india", "in", "co.in"),
    "INDONESIA": ("indonesia", "id", None),
    "IRELAND": ("ireland", "ie", "ie"),
    "ISRAEL": ("israel", "il", "com"),
    "ITALY": ("italy", "it", "it"),
    "JAPAN": ("japan", "jp", None),
    "KUWAIT": ("kuwait", "kw", None),
    "LATVIA": ("latvia", "lv", None),
    "LITHUANIA": ("lithuania", "lt", None),
    "LUXEMBOURG": ("luxembourg", "lu", None),
    "MALAYSIA": ("malaysia", "malaysia:my", "com"),
    "MALTA": ("malta", "malta:mt", "mt"),
    "MEXICO": ("mexico", "mx", "com.mx"),
    "MOROCCO": ("morocco", "ma", None),
    "NETHERLANDS": ("netherlands", "nl", "nl"),
    "NEWZEALAND": ("new zealand", "nz", "co.nz"),
    "NIGERIA": ("nigeria", "ng", None),
    "NORWAY": ("norway", "no", None),
    "OMAN": ("oman", "om", None),
    "PAKISTAN": ("pakistan", "pk", None),
    "PANAMA": ("panama", "pa", None),
    "PERU": ("peru", "pe", None),
    "PHILIPPINES": ("philippines", "ph", None),
    "POLAND": ("poland", "pl", None),
    "PORTUGAL": ("portugal", "pt", None),
    "QATAR": ("qatar", "qa", None),
    "ROMANIA": ("romania", "ro", None),
    "SAUDIARABIA": ("saudi arabia", "sa", None),
    "SINGAPORE": ("singapore", "sg", "sg"),
    "SLOVAKIA": ("slovakia", "sk", None),
    "SLOVENIA": ("slovenia", "sl", None),
    "SOUTHAFRICA": ("south africa", "za", None),
    "SOUTHKOREA": ("south korea", "kr", None),
    "SPAIN": ("spain", "es", "es"),
    "SWEDEN": ("sweden", "se", None),
    "SWITZERLAND": ("switzerland", "ch", "de:ch"),
    "TAIWAN": ("taiwan", "tw", None),
    "THAILAND": ("thailand", "th", None),
    "TURKEY": ("türkiye,turkey", "tr", None),
    "UKRAINE": ("ukraine", "ua", None),
    "UNITEDARABEMIRATES": ("united arab emirates", "ae", None),
    "UK": ("uk,united kingdom", "uk:gb", "co.uk"),
    "USA": ("usa,us,united states", "www:us", "com"),
    "URUGUAY": ("uruguay", "uy", None),
    "VENEZUELA": ("venezuela", "ve", None),
    "VIETNAM": ("vietnam", "vn", "com"),
    "US_CANADA": ("usa/ca", "www", None),
    "WORLDWIDE": ("worldwide", "www", None),
}

# Pay units and what they multiply by to make a year.
PAY_UNITS = {
    "DAY": "daily",
    "YEAR": "yearly",
    "ANNUAL": "yearly",
    "HOUR": "hourly",
    "WEEK": "weekly",
    "MONTH": "monthly",
}
PERIODS_PER_YEAR = {"hourly": 2080, "daily": 260, "weekly": 52, "monthly": 12}

# Sources whose rows may repeat what a company publishes itself.
BOARD_SOURCES = (
    "linkedin",
    "indeed",
    "glassdoor",
    "greenhouse",
    "comeet",
    "google",
    "zip_recruiter",
    "bayt",
    "naukri",
    "bdjobs",
)

# All sources, and the company sites left out of a default run.
SOURCES = (
    "linkedin",
    "indeed",
    "zip_recruiter",
    "glassdoor",
    "google",
    "google_careers",
    "comeet",
    "greenhouse",
    "eightfold",
    "workday",
    "redhat",
    "varonis",
    "apple",
    "microsoft",
    "meta",
    "json_feed",
    "bayt",
    "naukri",
    "bdjobs",
)
COMPANY_SOURCES = (
    "comeet",
    "greenhouse",
    "eightfold",
    "workday",
    "redhat",
    "varonis",
    "apple",
    "microsoft",
    "meta",
    "google_careers",
    "json_feed",
)


def literal_map(pairs: dict) -> Column:
    """A constant map column; the plan folds it, so no join is needed."""
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def look_up(pairs: dict, key: Column) -> Column:
    return F.try_element_at(literal_map(pairs), key)


def job_type_spellings() -> dict[str, str]:
    return {s: names[0] for names in JOB_TYPES.values() for s in names}


def country_names() -> dict[str, str]:
    """Every accepted name -> country key."""
    return {n: key for key, (names, _, _) in COUNTRIES.items() for n in names.split(",")}


def country_display() -> dict[str, str]:
    """Country key -> shown name; the two pseudo countries show nothing."""
    shown = {}
    for key, (names, _, _) in COUNTRIES.items():
        first = names.split(",")[0]
        if key in ("US_CANADA", "WORLDWIDE"):
            continue
        shown[key] = first.upper() if first in ("usa", "uk") else first.title()
    return shown


def country_codes() -> dict[str, str]:
    """Country key -> two-letter code used by the board site's service."""
    return {key: code.split(":")[-1].upper() for key, (_, code, _) in COUNTRIES.items()}


def review_domains() -> dict[str, str]:
    """Country key -> review site host, where that site has one."""
    hosts = {}
    for key, (_, _, domain) in COUNTRIES.items():
        if domain is None:
            continue
        sub, _, top = domain.rpartition(":")
        hosts[key] = f"{sub or 'www'}.glassdoor.{top}"
    return hosts
