"""Job type, remote and work-place rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postline.functions.lookups import job_type_spellings, look_up
from postline.functions.text import clean_text

REMOTE_WORDS = ("remote", "work from home", "wfh")
# Patterns that show a job type in running text.
TYPE_PATTERNS = {
    "fulltime": r"(?i)full\s?time",
    "parttime": r"(?i)part\s?time",
    "internship": r"(?i)internship",
    "contract": r"(?i)contract",
}


def squeeze(c: Column) -> Column:
    """Lower case without spaces and hyphens, as the spellings are stored."""
    return F.regexp_replace(F.lower(clean_text(c)), "[ -]", "")


def job_type(c: Column) -> Column:
    """Main spelling of the type a normalised text stands for."""
    return look_up(job_type_spellings(), c)


def job_types_in_text(c: Column) -> Column:
    """Types whose pattern occurs in the text; null when none does."""
    hits = F.filter(
        F.array(*[F.when(c.rlike(p), F.lit(name)) for name, p in TYPE_PATTERNS.items()]),
        lambda x: x.isNotNull(),
    )
    return F.when(F.size(hits) > 0, hits)


def job_type_list(items: Column) -> Column:
    """Known types of a list of texts, in order, once each; null when none is known."""
    known = F.filter(F.transform(items, lambda x: job_type(squeeze(x))), lambda x: x.isNotNull())
    return F.when(F.size(known) > 0, F.array_distinct(known))


def job_types_by_schedule(time_type: Column, title: Column) -> Column:
    """Type from a schedule text, plus internship when the title says so."""
    low = F.lower(clean_text(time_type))
    first = F.when(low == "full time", F.lit("fulltime")).when(low == "part time", F.lit("parttime"))
    second = F.when(F.contains(F.lower(title), F.lit("intern")), F.lit("internship"))
    hits = F.filter(F.array(first, second), lambda x: x.isNotNull())
    return F.when(F.size(hits) > 0, hits)


def is_remote(*texts: Column, extra: tuple[str, ...] = ()) -> Column:
    """True when a remote word is in any of the texts."""
    words = "|".join((*REMOTE_WORDS, *extra))
    return F.lower(F.concat_ws(" ", *texts)).rlike(words)


def remote_by_workplace(flag: Column, workplace: Column) -> Column:
    """A true flag wins, then the workplace word; unknown words give null."""
    word = F.regexp_replace(F.lower(clean_text(workplace)), "[ _-]", "")
    return F.when(flag, True).when(word == "remote", True).when(
        word.isin("onsite", "hybrid", "inperson"), False
    )


def work_from_home_type(location: Column, title: Column, description: Column) -> Column:
    """Hybrid before Remote before Work from office."""
    text = F.lower(F.concat_ws(" ", location, title, description))
    body = F.lower(F.coalesce(description, F.lit("")))
    office = F.contains(body, F.lit("work from office")) | ~body.rlike("remote|hybrid")
    return (
        F.when(F.contains(text, F.lit("hybrid")), F.lit("Hybrid"))
        .when(F.contains(text, F.lit("remote")), F.lit("Remote"))
        .when(office, F.lit("Work from office"))
    )
