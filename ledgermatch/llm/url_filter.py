"""URL filters: longest host-and-path rules first, then a weighted vocabulary counted by an Aho-Corasick automaton.

A rule fits its host and all subdomains if the path starts with the rule's; the longest fitting rule decides.
Without one, the vocabulary decides: strict and soft terms are found in host and path (A-Z lower-cased), each hit must
stand between boundaries (no ASCII letter or digit on either side), and a URL is blocked on one strict term or on
``min_soft`` distinct soft ones.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed.
Repeated rows are judged row by row; an empty table gives an empty result.  Rules and vocabulary go to every task, so they
are parameters of a checked size (``MOST_TERMS``); ``read_vocabulary`` takes a vocabulary of one's own from a table of terms.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)


#: Terms at most: an automaton of so many, of 20 bytes, takes about 2 GB at worst in a worker.
MOST_TERMS = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """Terms of lower-case ASCII letters, digits and inner hyphens."""

    strict: tuple[str, ...] = ("adult-x", "casino-win", "cheap-pills", "free-bets", "porn", "spam-farm", "warez", "xxx")
    soft: tuple[str, ...] = ("ads", "adult", "bets", "bonus", "casino", "cheap", "deal", "farm", "free", "loan", "pills", "poker", "sex", "spam", "torrent", "track", "viagra", "win")
    min_soft: int = 2

    def __post_init__(self) -> None:
        if len(self.strict) + len(self.soft) > MOST_TERMS:
            raise ValueError(f"a vocabulary of {len(self.strict) + len(self.soft)} terms is more than the {MOST_TERMS} that go to every task")

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term in self.soft:
            found.add_word(term, (term, False))
        for term in self.strict:
            found.add_word(term, (term, True))
        if len(found):
            found.make_automaton()
        return found


def read_vocabulary(terms: DataFrame, min_soft: int = 2, term: str = "term", strict: str = "strict") -> Vocabulary:
    """A vocabulary from rows (term, strict), read by Spark from whatever holds them.

    Terms are trimmed and A-Z lower-cased; blank and null ones are none, and of one that comes several times the strict row counts.  More than MOST_TERMS are an error
    before any reach the driver.
    """
    plain = F.translate(F.trim(F.col(term).cast("string")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = terms.select(plain.alias("t"), F.coalesce(F.col(strict).cast("boolean"), F.lit(False)).alias("s")).where("t <> ''").groupBy("t").agg(F.max("s").alias("s"))
    kept = rows.orderBy("t").limit(MOST_TERMS + 1).collect()
    return Vocabulary(tuple(r.t for r in kept if r.s), tuple(r.t for r in kept if not r.s), min_soft)


_PLAIN = re.compile("[a-z0-9]")
_LOWER = {c: c + 32 for c in range(65, 91)}


def host_and_path(url: str | None) -> tuple[str, str]:
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = re.split("[?#]", url[at + 3 :], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


@dataclass
class Judge:
    """The rules indexed by host, and the automaton; built once in each worker."""

    rules: tuple[UrlRule, ...] = RULES
    vocabulary: Vocabulary = field(default_factory=Vocabulary)

    def __post_init__(self) -> None:
        self.by_host: dict[str, list[UrlRule]] = {}
        for r in sorted(self.rules, key=lambda r: (-len(r.name), r.name)):
            self.by_host.setdefault(r.host, []).append(r)
        self.found = self.vocabulary.automaton()

    def rule(self, host: str, path: str) -> UrlRule | None:
        best = None
        parent = host
        while parent:
            for r in self.by_host.get(parent, ()):
                if path.startswith(r.path):
                    if best is None or (-len(r.name), r.name) < (-len(best.name), best.name):
                        best = r
                    break
            parent = parent.partition(".")[2]
        return best

    def hits(self, host: str, path: str) -> tuple[int, int]:
        """Distinct strict and soft terms between boundaries."""
        s = (host + path).translate(_LOWER)
        strict, soft = set(), set()
        if len(self.found):
            for last, (term, is_strict) in self.found.iter(s):
                first = last - len(term) + 1
                if (not first or not _PLAIN.match(s[first - 1])) and (last + 1 == len(s) or not _PLAIN.match(s[last + 1])):
                    (strict if is_strict else soft).add(term)
        return len(strict), len(soft)

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, int, int]:
        host, path = host_and_path(url)
        n_strict, n_soft = self.hits(host, path)
        if r := self.rule(host, path):
            return host, path, r.name, r.verdict, n_strict, n_soft
        blocked = n_strict > 0 or n_soft >= self.vocabulary.min_soft
        return host, path, None, "block" if blocked else "allow", n_strict, n_soft


def judge_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules: tuple[UrlRule, ...] = RULES, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:  # noqa: B008
    """Per row: the key, host, path, rule, verdict, n_strict and n_soft (distinct terms).  No shuffle; rows stay where they are."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(rules, vocabulary)
        for batch in batches:
            made = [judge.judge(u) for u in batch.column(1).to_pylist()]
            columns = list(zip(*made, strict=True)) or [()] * 6
            kinds = [pa.string()] * 4 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["__key", "host", "path", "rule", "verdict", "n_strict", "n_soft"])

    rows = pages.select(F.col(key).alias("__key"), F.col(url).alias("__url"))
    schema = f"__key {kind}, host string, path string, rule string, verdict string, n_strict long, n_soft long"
    return rows.mapInArrow(run, schema).withColumnRenamed("__key", key)


def oracle(rules: tuple[UrlRule, ...] = RULES, vocabulary: Vocabulary = Vocabulary(), pages: str = "pages") -> str:  # noqa: B008
    """The same judgement in SQL."""
    hit = lambda t: f"CAST(regexp_matches(s, '(^|[^a-z0-9]){re.escape(t).replace(chr(92) + '-', '-')}($|[^a-z0-9])') AS BIGINT)"
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    return f"""
    WITH parts AS (
      SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM {pages}
    ), cut AS (
      SELECT page_id,
        translate(CASE WHEN instr(rest, '/') > 0 THEN substr(rest, 1, instr(rest, '/') - 1) ELSE COALESCE(rest, '') END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        CASE WHEN instr(rest, '/') > 0 THEN substr(rest, instr(rest, '/')) ELSE '' END AS path
      FROM parts
    ), counted AS (
      SELECT *, {' + '.join(map(hit, vocabulary.strict))} AS n_strict, {' + '.join(map(hit, vocabulary.soft))} AS n_soft
      FROM (SELECT *, translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s FROM cut)
    )
    SELECT page_id, host, path,
      CASE {' '.join(f"WHEN {fits(r)} THEN '{r.name}'" for r in ordered)} END AS rule,
      CASE {' '.join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in ordered)}
        WHEN n_strict > 0 OR n_soft >= {vocabulary.min_soft} THEN 'block' ELSE 'allow' END AS verdict,
      n_strict, n_soft
    FROM counted"""
