"""URL rules on the generic split of RFC 3986, appendix B.

Built on substring steps and not on parse_url: posted links often hold spaces
or stray characters, which parse_url answers with null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.functions.text import clean_text, slug

@dataclass(frozen=True)
class Parts:
    """The pieces of one URL column."""

    scheme: Column
    host: Column
    path: Column
    query: Column

    @property
    def is_web(self) -> Column:
        return self.scheme.isin("http", "https")

    @property
    def has_host(self) -> Column:
        return self.is_web & (self.host != "")

    @property
    def root(self) -> Column:
        return F.concat(self.scheme, F.lit("://"), self.host)

    @property
    def bare_path(self) -> Column:
        """Path without trailing slashes; a path of slashes only stays as it is."""
        cut = F.rtrim(self.path, F.lit("/"))
        return F.when(cut != "", cut).when(self.path != "", self.path).otherwise(F.lit("/"))

    def param(self, key: str) -> Column:
        """First non-blank value of a query key, decoded; null if none."""
        raw = F.regexp_extract(self.query, rf"(?:^|&){key}=([^&]+)", 1)
        return clean_text(F.try_url_decode(raw))


HEAD = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def split_url(url: Column) -> Parts:
    """The pieces as expressions; for several links of a table see cut_urls."""
    text = clean_text(url)
    return Parts(
        scheme=F.lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)),
        host=F.regexp_extract(text, HEAD + r"([^/?#]*)", 1),
        path=F.regexp_extract(text, HEAD + r"[^/?#]*([^?#]*)", 1),
        query=F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1),
    )


def cut_urls(df: DataFrame, links: dict[str, str]) -> DataFrame:
    """Add `_<prefix>_scheme`, `_host`, `_path` and `_query` of clean link columns.

    Cuts at the first `#`, `?`, `://` and `/` in turn, with plain substring
    steps. Each step is a projection of its own, so nothing is computed twice;
    Spark runs them as one generated loop.
    """
    def step(df: DataFrame, make) -> DataFrame:
        made = {}
        for column, prefix in links.items():
            made |= {f"_{prefix}_{k}": v for k, v in make(F.col(column), lambda k: F.col(f"_{prefix}_{k}")).items()}
        return df.withColumns(made)

    df = step(df, lambda c, at: {"whole": F.substring_index(c, "#", 1)})
    df = step(df, lambda c, at: {"page": F.substring_index(at("whole"), "?", 1)})
    df = step(df, lambda c, at: {"colon": F.locate("://", at("page"))})
    df = step(
        df,
        lambda c, at: {
            "rest": F.when(at("colon") > 0, F.substring(at("page"), at("colon") + 3, F.length(at("page")))).when(
                at("page").isNotNull(), F.lit("")
            ),
            "scheme": F.lower(F.left(at("page"), F.greatest(at("colon") - 1, F.lit(0)))),
            "query": F.substring(at("whole"), F.length(at("page")) + 2, F.length(at("whole"))),
        },
    )
    df = step(df, lambda c, at: {"host": F.substring_index(at("rest"), "/", 1)})
    df = step(df, lambda c, at: {"path": F.substring(at("rest"), F.length(at("host")) + 1, F.length(at("rest")))})
    return df.drop(*[f"_{p}_{k}" for p in links.values() for k in ("whole", "page", "colon", "rest")])


def cut_parts(prefix: str) -> Parts:
    return Parts(*[F.col(f"_{prefix}_{x}") for x in ("scheme", "host", "path", "query")])


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, null when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def page_url(p: Parts) -> Column:
    """Scheme, host and path of a web address; the query is dropped."""
    return F.when(p.has_host, F.concat(p.root, p.bare_path))


def page_url_with_query(p: Parts) -> Column:
    tail = F.when(p.query != "", F.concat(F.lit("?"), p.query)).otherwise(F.lit(""))
    return F.concat(page_url(p), tail)


def profile_url(text: Column, p: Parts) -> Column:
    """Company address: right slashes off; text that is no web address stays."""
    trimmed = F.rtrim(F.concat(p.root, p.path), F.lit("/"))
    return F.when(p.is_web, trimmed).otherwise(text)


def drop_query(url: Column) -> Column:
    return F.regexp_replace(clean_text(url), r"[?#].*$", "")


def _pairs(query: Column) -> Column:
    return F.filter(F.split(query, "&"), lambda kv: kv != "")


def _key(pair: Column) -> Column:
    return F.substring_index(pair, "=", 1)


def drop_query_key(url: Column, key: str) -> Column:
    """Remove one tracking key and the fragment; other keys keep their order."""
    text = clean_text(url)
    base = F.regexp_replace(text, r"[?#].*$", "")
    kept = F.filter(_pairs(split_url(url).query), lambda kv: F.lower(_key(kv)) != key.lower())
    query = F.array_join(kept, "&")
    return F.when(query != "", F.concat(base, F.lit("?"), query)).otherwise(base)


def set_query_key(url: Column, key: str, value: Column) -> Column:
    """Replace the key's first place (other places go), or append it."""
    text = clean_text(url)
    base = F.regexp_extract(text, r"^[^?#]*", 0)
    fragment = F.regexp_extract(text, r"#.*$", 0)
    pairs = _pairs(split_url(url).query)
    new = F.concat(F.lit(f"{key}="), value.cast("string"))
    at = F.array_position(F.transform(pairs, _key), key)
    placed = F.filter(
        F.transform(pairs, lambda kv, i: F.when(_key(kv) != key, kv).when(i + 1 == at, new)),
        lambda kv: kv.isNotNull(),
    )
    query = F.array_join(F.when(at > 0, placed).otherwise(F.concat(pairs, F.array(new))), "&")
    return F.concat(base, F.lit("?"), query, fragment)


def path_parts(p: Parts) -> Column:
    return F.filter(F.split(p.path, "/"), lambda x: x != "")


def hosted_board_fields(url: Column) -> tuple[Column, Column, Column]:
    """Base URL, company slug and company code of a hosted careers address."""
    p = split_url(url)
    parts = path_parts(p)
    ok = (
        F.startswith(clean_text(url), F.lit("https://www.comeet.com/jobs"))
        & (p.host == "www.comeet.com")
        & (F.size(parts) >= 3)
        & (F.try_element_at(parts, F.lit(1)) == "jobs")
    )
    base = F.concat(p.root, F.lit("/"), F.array_join(F.slice(parts, 1, 3), "/"))
    return (
        F.when(ok, base),
        F.when(ok, F.try_element_at(parts, F.lit(2))),
        F.when(ok, F.try_element_at(parts, F.lit(3))),
    )


def join_url(base: Column, link: Column) -> Column:
    """Absolute form of a link found on a page, dot segments included."""
    text = clean_text(link)
    b = split_url(base)
    folder = F.regexp_replace(b.path, r"[^/]*$", "")
    merged = (
        F.when(F.startswith(text, F.lit("/")), text)
        .when(text.rlike(r"^\?"), F.concat(F.when(b.path == "", F.lit("/")).otherwise(b.path), text))
        .when(folder == "", F.concat(F.lit("/"), text))
        .otherwise(F.concat(folder, text))
    )
    return (
        F.when(text.isNull(), base)
        .when(text.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), text)
        .when(F.startswith(text, F.lit("//")), F.concat(b.scheme, F.lit(":"), text))
        .when(F.startswith(text, F.lit("#")), F.concat(F.regexp_replace(base, "#.*$", ""), text))
        .otherwise(F.concat(b.root, _flatten_dots(merged)))
    )


def with_joined_url(df: DataFrame, name: str, base: str, link: str) -> DataFrame:
    """df with join_url of two text columns. Its parts are made in projections of their own;
    in one expression each branch would cut the base and the link again.
    """
    b = split_url(F.col("_whole"))
    made = df.withColumns({"_whole": clean_text(F.col(base)), "_text": clean_text(F.col(link))})
    made = made.withColumns({"_scheme": b.scheme, "_host": b.host, "_path": b.path})
    path, text = F.col("_path"), F.col("_text")
    folder = F.regexp_replace(path, r"[^/]*$", "")
    merged = (
        F.when(F.startswith(text, F.lit("/")), text)
        .when(text.rlike(r"^\?"), F.concat(F.when(path == "", F.lit("/")).otherwise(path), text))
        .otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), text))
    )
    made = made.withColumn("_merged", merged)
    made = made.withColumns({"_route": F.regexp_replace("_merged", r"[?#].*$", ""), "_tail": F.regexp_extract("_merged", r"[?#].*$", 0)})
    root = Parts(F.col("_scheme"), F.col("_host"), path, F.lit("")).root
    joined = (
        F.when(text.isNull(), F.col(base))
        .when(text.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), text)
        .when(F.startswith(text, F.lit("//")), F.concat(F.col("_scheme"), F.lit(":"), text))
        .when(F.startswith(text, F.lit("#")), F.concat(F.regexp_replace(F.col(base), "#.*$", ""), text))
        .otherwise(F.concat(root, F.concat(_solved(F.col("_route")), F.col("_tail"))))
    )
    return made.select(*[F.col(f"`{c}`") for c in df.columns if c != name], joined.alias(name))


def _flatten_dots(path: Column) -> Column:
    """Resolve `.` and `..`; the query part is left alone."""
    tail = F.regexp_extract(path, r"[?#].*$", 0)
    return F.concat(_solved(F.regexp_replace(path, r"[?#].*$", "")), tail)


def _solved(route: Column) -> Column:
    """A path without query, its `.` and `..` resolved."""
    steps = F.split(route, "/")
    kept = F.reduce(
        steps,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when((s == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.size(acc) - 1))
        .when(s == "..", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    slash = F.when(route.rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    solved = F.when(route.rlike(r"(?:^|/)\.{1,2}(?:/|$)"), F.concat(F.array_join(kept, "/"), slash))
    return F.coalesce(solved, route)


def with_scheme(url: Column) -> Column:
    """Site address with https added when no scheme was given."""
    text = clean_text(url)
    return F.when(text.rlike(r"(?i)^https?://"), text).otherwise(F.concat(F.lit("https://"), text))


def company_website(url: Column) -> Column:
    """As with_scheme, but null for addresses of the hosting service itself."""
    full = with_scheme(url)
    hosted = split_url(full).host.isin("app.comeet.co", "app.comeet.com")
    return F.when(~hosted, full)


def direct_url(text: Column) -> Column:
    """Target of a redirect link, percent-decoded."""
    return F.try_url_decode(F.replace(found(text, r'\?url=([^"]+)'), F.lit("+"), F.lit("%2B")))


def unescape_stream(c: Column) -> Column:
    r"""Undo the escapes of text cut from a script: &, \/ and \"."""
    step = F.replace(c, F.lit("\\u0026"), F.lit("&"))
    step = F.replace(step, F.lit("\\/"), F.lit("/"))
    return F.replace(step, F.lit('\\"'), F.lit('"'))


# Keys of a page's data stream, and the address of the site's own form.
OUTSIDE_KEY, OWN_KEY = "offsiteApplyUrl", "url"
OWN_FORM = r"^\Qhttps://www.linkedin.com/jobs/view/\E[0-9]+\Q/apply/?openSDUIApplyFlow=true\E."


def streamed_all(html: Column, key: str) -> Column:
    r"""All values of a key in JSON text that itself stands in a JSON string (\\"key\\":\\"value\\")."""
    quote = r'\\"'
    values = F.regexp_extract_all(html, F.lit(rf'(?<![\w]){key}{quote}\s*:\s*{quote}((?:[^"\\]|\\(?!"))*){quote}'), F.lit(1))
    return F.transform(values, unescape_stream)


def streamed(html: Column, key: str, prefix: str) -> Column:
    """The first of them that begins with prefix."""
    return F.try_element_at(F.filter(streamed_all(html, key), lambda u: F.startswith(u, F.lit(prefix))), F.lit(1))


def apply_url(html: Column, canonical: Column, offsite: Column) -> Column:
    """Outside link, else the site's own form, else nothing if off-site, else the page."""
    outside = F.coalesce(
        direct_url(found(html, r'(?s)<code[^>]*id="applyUrl"[^>]*>(.*?)</code>')),
        streamed(html, OUTSIDE_KEY, "http"),
    )
    own = F.filter(streamed_all(html, OWN_KEY), lambda u: u.rlike(OWN_FORM))
    own = F.try_element_at(own, F.lit(1))
    return F.coalesce(outside, own, F.when(~offsite, canonical))


def linkedin_page(url: Column) -> tuple[Column, Column]:
    """Posting address without query, and the id it carries; both null for other addresses."""
    pattern = r"^(?i:https?://[^/?#]*linkedin\.com[^/?#]*)(?:/[^?#]*)?/jobs/view/(?:[^/?#]+-)?\d+(?:/[^?#]*)?(?=[?#]|$)"
    page = found(clean_text(url), pattern, 0)
    return page, found(page, r"/jobs/view/(?:[^/?#]+-)?(\d+)(?:/|$)")


def detail_url(root: Column, locale: Column, job_id: Column, title_slug: Column, team: Column) -> Column:
    """Detail address from locale, id, slug and optional team code."""
    page = F.concat(root, F.lit("/"), locale, F.lit("/details/"), clean_text(job_id), F.lit("/"), clean_text(title_slug))
    code = clean_text(team)
    return F.when(code.isNotNull(), F.concat(page, F.lit("?team="), code)).otherwise(page)


def detail_url_under(search_url: Column, job_id: Column, title: Column) -> Column:
    """Detail address under a search page: `<path>/<id>-<slug>`, page key dropped."""
    p = split_url(search_url)
    kept = F.array_join(F.filter(_pairs(p.query), lambda kv: _key(kv) != "page"), "&")
    tail = F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))
    return F.concat(
        p.root, F.rtrim(p.path, F.lit("/")), F.lit("/"), clean_text(job_id), F.lit("-"), slug(title, ""), tail
    )


def site_root(url: Column) -> Column:
    p = split_url(url)
    return F.when((p.scheme != "") & (p.host != ""), p.root)


def board_id(url: Column) -> Column:
    """`gh-<digits>` from the board key or the jobs path."""
    return F.concat(F.lit("gh-"), found(url, r"(?:gh_jid=|/jobs/)(\d+)"))


# Hosts of public boards; the API path that stands before a board's name.
BOARD_APIS = ("boards-api.greenhouse.io/v1/boards",)
BOARD_HOSTS = ("job-boards.greenhouse.io", "boards.greenhouse.io", "boards.eu.greenhouse.io")
LEVER_HOST = "jobs.lever.co"
#: A board's name in an address.
TOKEN = r"([\w.~%+-]+)"


def platform(url: Column, html: Column) -> Column:
    """Which hosting platform a careers page runs on: struct(platform, token)."""
    p = split_url(url)
    host = F.lower(p.host)
    body = F.coalesce(html, F.lit(""))
    first = F.try_element_at(path_parts(p), F.lit(1))
    token_rules = [rf"(?i)\Q{api}\E/{TOKEN}/jobs" for api in BOARD_APIS] + [rf"(?i)\Q{h}\E/{TOKEN}" for h in BOARD_HOSTS]
    token_url = F.coalesce(*[found(url, r) for r in token_rules], F.when(host.isin(*BOARD_HOSTS), first))
    lever_url = F.coalesce(
        F.when(host == LEVER_HOST, first),
        F.when(F.contains(host, F.lit("api.lever.co")), found(p.path, r"/postings/([^/]+)")),
    )
    token_body = F.coalesce(*[found(body, r) for r in token_rules])
    lever_body = found(body, rf"(?i)\Q{LEVER_HOST}\E/{TOKEN}")
    none = F.lit(None).cast("string")
    rules = [
        (F.contains(host, F.lit("myworkdayjobs.com")), "workday", none),
        ((host == "www.comeet.com") & F.startswith(p.path, F.lit("/jobs/")), "comeet", none),
        (lever_url.isNotNull(), "lever", lever_url),
        (token_url.isNotNull(), "greenhouse_public_board", token_url),
        (token_body.isNotNull(), "greenhouse_public_board", token_body),
        (lever_body.isNotNull(), "lever", lever_body),
    ]
    name = F.lit("unknown")
    token = none
    for test, label, value in reversed(rules):
        name = F.when(test, F.lit(label)).otherwise(name)
        token = F.when(test, value).otherwise(token)
    return F.struct(name.alias("platform"), token.alias("token"))
