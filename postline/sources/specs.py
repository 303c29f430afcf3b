"""Declarative source specs: what each source's links and records look like.

A spec is data. `operators.records` compiles the specs of all sources into
one projection, so a mixed table of sources is mapped in a single pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any


WEB_PAGE = r"^(?i:https?)://[^/?#]+"
KEY_VALUE = r"=(?:\+|%20)*(?!%20)[^&#+]"


@dataclass(frozen=True)
class SourceSpec:
    """Rules of one source.

    valid                 pattern of a link this source accepts; it decides alone, on
                          the raw text, so that bad rows go before anything is computed
    path_id, query_id     where the posting id is found in the link
    canonical             how the kept link is rebuilt:
                          fixed | path_and_id | page | page_query | board | hosted
    fixed_url             text around the id for `fixed`
    id_first              a stated id wins over the one in the link
    company               pattern | host | page | hosted: how the company link is read
    company_id            pattern of the id in the company link
    company_fallback      text used when no company id is found
    company_default       company link assumed when none is given
    name_columns          where the company name comes from
    company_from_link     without a company link, the posting's own site is taken
    company_name_as_id    the company name may stand in for its id
    apply                 outside | direct_or_apply | apply | page | page_query | own_page
    sector_columns        where the sector comes from
    dash                  characters of the listing type that become a hyphen
    """

    name: str
    valid: str = WEB_PAGE
    record_source: str | None = None
    path_id: str | None = None
    query_id: str | None = None
    canonical: str = "page"
    fixed_url: tuple[str, str] = ("", "")
    id_first: bool = False
    company: str = "host"
    company_id: str | None = None
    company_fallback: str | None = None
    company_default: str | None = None
    company_from_link: bool = False
    company_name_as_id: bool = True
    name_fallback: bool = True
    apply: str = "apply"
    sector_columns: tuple[str, ...] = ("company_industry",)
    listing_as_is: bool = False
    remote_only: bool = False
    dash: str = "_ "

    @property
    def source(self) -> str:
        return self.record_source or self.name


BOARD = dict(company="pattern", name_fallback=False, remote_only=True)
CAREERS = dict(id_first=True)

# Hosts, id patterns and defaults of each source.
SPECS: tuple[SourceSpec, ...] = (
    SourceSpec(
        "linkedin",
        valid=r"^(?i:https?://[^/?#]*linkedin\.com)[^?#]*/jobs/view/(?:[^/?#]+-)?\d",
        path_id=r"/jobs/view/(?:[^/?#]+-)?(\d+)",
        canonical="fixed",
        fixed_url=("https://www.linkedin.com/jobs/view/", ""),
        company_id=r"/company/([^/?#]+)",
        apply="outside",
        **BOARD,
    ),
    SourceSpec(
        "indeed",
        valid=r"^(?i:https?://[^/?#]*indeed\.)[^?#]*\?(?:[^#]*&)?jk" + KEY_VALUE,
        query_id="jk",
        canonical="path_and_id",
        company_id=r"/cmp/([^/?#]+)",
        apply="direct_or_apply",
        **BOARD,
    ),
    SourceSpec(
        "glassdoor",
        valid=r"^(?i:https?://[^/?#]*glassdoor\.)[^?#]*\?(?:[^#]*&)?jl" + KEY_VALUE,
        query_id="jl",
        canonical="path_and_id",
        company_id=r"/W-EI_IE(\d+)\.htm",
        apply="direct_or_apply",
        **BOARD,
    ),
    SourceSpec(
        "greenhouse",
        valid=r"^(?i:https?)://[^?#]*(?:/\d+/*(?:[?#].*)?$|\?(?:[^#]*&)?gh_jid" + KEY_VALUE + ")",
        query_id="gh_jid",
        path_id=r"/(\d+)/*$",
        canonical="board",
        company_from_link=True,
    ),
    SourceSpec(
        "comeet",
        valid=r"^https://www\.comeet\.com/jobs(?:/+[^/?#]+){4}",
        canonical="hosted",
        company="hosted",
        dash=" ",
    ),
    SourceSpec("eightfold", **CAREERS),
    SourceSpec("microsoft", company_fallback="microsoft", **CAREERS),
    SourceSpec("workday", path_id=r"_([^/?#]+)/*$", company="page", apply="page", **CAREERS),
    SourceSpec(
        "redhat", record_source="workday", path_id=r"_([^/?#]+)/*$", company="page", apply="page", **CAREERS
    ),
    SourceSpec(
        "varonis",
        path_id=r"/job/([^/?#]+)",
        company_fallback="varonis",
        sector_columns=("job_function", "company_industry"),
        **CAREERS,
    ),
    SourceSpec(
        "apple",
        valid=r"^(?i:https?://[^/?#]*jobs\.apple\.com)[^?#]*/details/[^/?#]",
        path_id=r"/details/([^/?#]+)",
        company_default="https://jobs.apple.com",
        company_fallback="jobs.apple.com",
        company_name_as_id=False,
        apply="own_page",
        sector_columns=("job_function", "company_industry"),
        **CAREERS,
    ),
    SourceSpec(
        "meta",
        valid=r"^(?i:https?://www\.metacareers\.com)(?:/[^?#]*)?/jobs/\d",
        path_id=r"/jobs/(\d+)",
        canonical="fixed",
        fixed_url=("https://www.metacareers.com/jobs/", "/"),
        company_from_link=True,
        company_fallback="www.metacareers.com",
        company_name_as_id=False,
        sector_columns=("job_function",),
        listing_as_is=True,
    ),
    SourceSpec(
        "json_feed",
        canonical="page_query",
        company_fallback="json_feed",
        apply="page_query",
        sector_columns=("job_function", "company_industry"),
        **CAREERS,
    ),
)
BY_NAME = {s.name: s for s in SPECS}


@dataclass(frozen=True)
class FeedConfig:
    """Mapping of one feed: paths, templates, constants, filters, value maps."""

    name: str
    field_paths: dict[str, Any] = field(default_factory=dict)
    templates: dict[str, str] = field(default_factory=dict)
    constants: dict[str, str] = field(default_factory=dict)
    value_maps: dict[str, dict[str, str]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    filters: tuple[dict[str, Any], ...] = ()
    location_paths: tuple[str, ...] = ()
    rows_path: str | None = None
    description_sections: tuple[tuple[str | None, str], ...] = ()
    description_paths: tuple[str, ...] = ()
