"""URL filter: host and path rules, and a weighted vocabulary searched by an Aho-Corasick automaton."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One hit of these is enough to reject a url.
STRICT_TERMS = """
adult anal bdsm blowjob camgirl camgirls camsex casino casinos cialis cumshot erotic erotica erotik escorts fetish
gangbang hentai jackpots keygen kamagra levitra milf milfs nudes onlyfans poker porn porno pornos pornstar pornstars
roulette sexcam sexcams sexchat sexo sexshop sexvideo sexvideos slutty spam strippers striptease swingers tramadol
viagra warez xanax xxx
""".split()
# These occur in clean urls too; several distinct ones reject.
SOFT_TERMS = """
ads affiliate bet bets betting bingo bitcoin bonus bonuses cams cash cheap cheats click clicks coupon coupons crack
cracked credit dating deal deals desnudas diet download earn escort fake farm followers forex free freebies gamble
gambling girls gratis hacked hacks hardcore hot hotties jackpot kostenlos lesbian likes loan loans lottery lotto
mature meds mp3 nackt naked nude offers payday pharmacy pills popup prescription proxy profit prize promo replica rich
rx sale sex sexy serials single singles slot slots streaming taboo teen teens torrent torrents track traffic video
videos virgin voucher weightloss win winner
""".split()
#: Distinct soft terms that reject.
SOFT_LIMIT = 2
#: Most terms of a vocabulary that is read from a file.
MOST_TERMS = 1_000_000
# The rules as (verdict, host and path).
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))

_WORD = frozenset(string.ascii_lowercase + string.digits)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; of equal lengths the first in the alphabet. Null if none does."""
    name = verdict = None
    for decides, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at, below, under = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(below + under)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        verdict = F.when(fits, decides) if verdict is None else verdict.when(fits, decides)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def read_terms(spark: SparkSession, path: str, most: int = MOST_TERMS) -> tuple[list[str], list[str]]:
    """(strict, soft) terms of a text file of lines such as "casino strict" or "bonus soft"; blank lines and # comments are left out.

    A vocabulary is sent to every task, so one of over `most` terms is an error, as is a line of another form.
    """
    line = F.trim(F.regexp_replace("value", r"\s+", " "))
    rows = spark.read.text(path).select(line.alias("line")).where("line <> '' and not startswith(line, '#')").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} terms in {path}")
    found: dict[str, list[str]] = {"strict": [], "soft": []}
    for r in rows:
        term, _, weight = r["line"].rpartition(" ")
        if not term or " " in term or weight not in found:
            raise ValueError(f"not a term and its weight: {r['line']}")
        found[weight].append(term.lower())
    return found["strict"], found["soft"]


def automaton(weights: Mapping[str, bool]) -> ahocorasick.Automaton:
    """weights: term to whether it is strict."""
    found = ahocorasick.Automaton()
    for term, strict in weights.items():
        found.add_word(term, (term, strict))
    if weights:
        found.make_automaton()
    return found


def hits(terms: ahocorasick.Automaton, url: str) -> tuple[int, int]:
    """Distinct strict and soft terms of a lower-cased url that have no letter or digit right before or after."""
    seen = set()
    if len(terms):
        for last, (term, strict) in terms.iter(url):
            first = last - len(term) + 1
            if (first == 0 or url[first - 1] not in _WORD) and (last + 1 == len(url) or url[last + 1] not in _WORD):
                seen.add((term, strict))
    strict = sum(s for _, s in seen)
    return strict, len(seen) - strict


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, strict: Sequence[str] = STRICT_TERMS, soft: Sequence[str] = SOFT_TERMS, soft_limit: int = SOFT_LIMIT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each page: id, host, path, rule, verdict, strict_hits, soft_hits.

    The longest rule that fits decides; without one a url is blocked if it holds a strict term or at least
    `soft_limit` distinct soft ones. A term that is in both lists is strict. A null url, or one without ://,
    has an empty host and path; a null one has no hits and is allowed. Rows, repeated ones too, stay as many
    as they are; an empty table returns none; other columns are not looked at.
    """
    vocabulary = {t: False for t in soft} | {t: True for t in strict}

    def run(batches):
        terms = automaton(vocabulary)
        for batch in batches:
            counts = [hits(terms, url) for url in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array([c[k] for c in counts], pa.int32()) for k in (0, 1))], names=["id", "url", "strict_hits", "soft_hits"])

    kind, url = dict(pages.dtypes)[id_col], F.col(url_col)
    counted = pages.select(F.col(id_col).alias("id"), F.coalesce(ascii_lower(url), F.lit("")).alias("low"), url.alias("url")).mapInArrow(run, f"id {kind}, url string, strict_hits int, soft_hits int")
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("strict_hits") > 0) | (F.col("soft_hits") >= soft_limit), "block").otherwise("allow")
    return counted.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "strict_hits", "soft_hits")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def judge_sql(rules: Sequence[tuple[str, str]] = RULES, strict: Sequence[str] = STRICT_TERMS, soft: Sequence[str] = SOFT_TERMS, soft_limit: int = SOFT_LIMIT) -> str:
    """The same in SQL, with one regular expression for each term."""
    low = f"translate(coalesce(url, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    count = lambda terms: " + ".join(f"cast(regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') as int)" for t in terms) or "0"
    cases, decided = [], []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at, below, under = rule.partition("/")
        fits = f"(host = {_quoted(at)} or ends_with(host, {_quoted('.' + at)})) and starts_with(path, {_quoted(below + under)})"
        cases.append(f"when {fits} then {_quoted(rule)}")
        decided.append(f"when {fits} then {_quoted(verdict)}")
    return f"""
with u as (select page_id, {low} as low,
  translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') as host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
h as (select page_id, host, path, cast({count(strict)} as int) as strict_hits, cast({count(soft)} as int) as soft_hits from u)
select page_id, host, path, case {' '.join(cases)} else null end as rule,
  case {' '.join(decided)} when strict_hits > 0 or soft_hits >= {soft_limit} then 'block' else 'allow' end as verdict, strict_hits, soft_hits
from h"""
