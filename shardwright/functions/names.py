"""Rules on dataset ids, names, purposes and versions, as the first rule that a value breaks (null: none)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Families, and words that a name must not hold.
FAMILIES = ("pretrain", "curriculum", "sft", "eval", "probe", "vendor", "tokenizer")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
VERSION_WORDS = ("final", "new", "latest", "fixed", "old", "current")
GENERIC_WORDS = ("test", "tmp", "temp", "scratch", "data", "results", "misc", "stuff")
RELATIVE_WORDS = ("big", "small", "improved", "better", "best", "good", "bad", "fast", "slow")
PLACEHOLDERS = ("", "todo", "tbd", "data", "training data", "the dataset", "dataset", "experiments", "see readme", "data from the run", "corpus for the project")
RELATIONS = ("supersedes", "extends", "sibling")
#: White space as Python's strip() has it, as a class that Java's and RE2's engines share.
SPACE = r"[\t-\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_SPACE = SPACE.replace("[", "[^", 1)
_ABBREVIATED = "|".join(m[:3] for m in MONTHS)
#: Word rules in the order in which they are applied: (problem, pattern of an offending word).
WORD_RULES = (
    ("date", r"(?<![0-9])(19|20)[0-9]{6}(?![0-9])"),
    ("year", r"(?<![0-9])(19|20)[0-9]{2}(?![0-9])"),
    ("month", rf"({_ABBREVIATED})[0-9]|^({'|'.join(sorted({*MONTHS, *(m[:3] for m in MONTHS)}))})$"),
    ("version-word", rf"^v[0-9]{{1,2}}$|^({'|'.join(VERSION_WORDS)})$"),
    ("generic-word", rf"^({'|'.join(GENERIC_WORDS)})$"),
    ("relative-word", rf"^({'|'.join(RELATIVE_WORDS)})$"),
    ("ordinal", r"^([0-9]{1,3}|[0-9]{5,})$"),
)
VERSION = r"^v[1-9][0-9]*\z"


def strip(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, rf"^{SPACE}+", ""), rf"{SPACE}+\z", "")


def name_problem(name: Column) -> Column:
    """The words are judged in turn, each by all rules, before the next."""
    words = F.split(name, "-")
    verdict = lambda w: F.coalesce(*[F.when(w.rlike(p), F.lit(k)) for k, p in WORD_RULES])
    first = F.element_at(F.filter(F.transform(words, verdict), lambda v: v.isNotNull()), 1)
    return (
        F.when(F.coalesce(name, F.lit("")) == "", "empty")
        .when(~name.rlike(r"^[a-z0-9]+(-[a-z0-9]+)*\z"), "not-kebab-case")
        .when((F.size(words) < 2) | (F.size(words) > 5), "word-count")
        .otherwise(F.when(F.size(F.filter(F.transform(words, verdict), lambda v: v.isNotNull())) > 0, first))
    )


def id_problem(dataset_id: Column) -> Column:
    parts = F.split(dataset_id, "/")
    return (
        F.when(F.coalesce(dataset_id, F.lit("")) == "", "empty")
        .when(F.size(parts) != 2, "shape")
        .when(~parts[0].isin(*FAMILIES), "family")
        .otherwise(name_problem(F.get(parts, 1)))
    )


def squeezed(purpose: Column) -> Column:
    return F.regexp_replace(F.lower(purpose), "[^a-z0-9]+", "")


def purpose_problem(purpose: Column) -> Column:
    text = strip(purpose)
    banned = sorted({re.sub("[^a-z0-9]+", "", p) for p in PLACEHOLDERS})
    return (
        F.when(purpose.isNull(), "not-text").when(squeezed(text).isin(banned), "placeholder").when(F.char_length(text) < 20, "short")
        .when(F.char_length(text) > 300, "long").when(~text.contains(" "), "one-word")
    )


def version_problem(version: Column, relation: Column, of: Column) -> Column:
    return (
        F.when(~F.coalesce(version.rlike(VERSION), F.lit(False)), "version")
        .when(~F.coalesce(relation.isin(*RELATIONS), F.lit(False)), "relation")
        .when((version == "v1") & of.isNotNull(), "first-with-parent")
        .when((version != "v1") & ~F.coalesce(of.rlike(VERSION), F.lit(False)), "parent")
        .when(version == of, "own-parent")
    )


def version_number(version: Column) -> Column:
    return F.when(version.rlike(VERSION), F.substring(version, 2, 18).cast("long"))


def previous_version(version: Column) -> Column:
    n = version_number(version)
    return F.when(n > 1, F.concat(F.lit("v"), (n - 1).cast("string")))


def is_tokenizer_dependency(role: Column, parent: Column) -> Column:
    own = F.coalesce(parent, F.lit(""))
    return (F.coalesce(role, F.lit("")) == "tokenizer") | own.startswith("tokenizer/") | (own.startswith("vendor/") & own.contains("tokenizer"))
