"""Secret scan by a trigram inverted index, with DataFrame functions only.

Each rule is a regular expression. From its syntax tree follow trigrams that
every match must contain, as AND of ORs of ANDs. The documents are indexed by
those trigrams (lower case, so that both cases of a letter share a posting);
the postings of a rule's trigrams are intersected per document, and only
documents that satisfy the whole query are verified with the regular expression.
Rules of which no trigram is mandatory scan every document.

The candidates join the documents by ``doc_id``. They are a superset that is
verified row by row, so repeated ids cost time but never change a result.

Defined cases: a NULL text is empty and has no spans; a NULL ``doc_id`` is an
id like any other; equal rows give equal results; a very long text is searched
whole, its spans are found by splitting it once per rule; an empty table gives no rows;
columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.common import regex_spans

MAX_STRINGS = 64
#: Trigrams of an alternative that the index is asked for; more of one word hardly rule out more documents.
ASKED_TRIGRAMS = 4


@dataclass(frozen=True)
class Rule:
    """``floor`` is the least length, in characters, of group ``group`` of a match that counts."""

    kind: str
    pattern: str
    group: int = 0
    floor: int = 1
    base: bool = False


# Shapes of published credential formats.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("stripe", r"(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]{20,}"),
    Rule("session", r"ASIA[A-Z0-9]{16,}"),
    Rule("github_pat", r"github_pat_[A-Za-z0-9_]{22,}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{32,}"),
    Rule("shopify", r"shp(?:at|ca|pa|ss)_[A-Fa-f0-9]{32,}"),
    Rule("digitalocean", r"do[opr]_v1_[a-f0-9]{64,}"),
    Rule("slack_hook", r"https://hooks\.slack\.com/services/[A-Za-z0-9/]{20,}"),
    Rule("discord_hook", r"https://discord(?:app)?\.com/api/webhooks/[0-9]+/[A-Za-z0-9_-]{20,}"),
    Rule("telegram", r"[0-9]{8,10}:AA[A-Za-z0-9_-]{32,}"),
    Rule("mailgun", r"key-[0-9a-f]{32,}"),
    Rule("square", r"sq0(?:atp|csp)-[A-Za-z0-9_-]{22,}"),
    Rule("pypi", r"pypi-AgEI[A-Za-z0-9_-]{50,}"),
    Rule("huggingface", r"hf_[A-Za-z0-9]{30,}"),
    Rule("azure", r"AccountKey=[A-Za-z0-9+/=]{40,}"),
    Rule("newrelic", r"NRAK-[A-Z0-9]{27,}"),
    Rule("linear", r"lin_api_[A-Za-z0-9]{40,}"),
    Rule("url", r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]+:[^\s:/@]{3,}@[A-Za-z0-9.-]+"),
)


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Mandatory trigrams: all groups hold, a group by one of its alternatives, an alternative by all of its trigrams."""
    groups: list[list[frozenset[str]]] = []

    def asked(s: str) -> frozenset[str]:
        n = len(s) - 2
        return frozenset(s[i * (n - 1) // (ASKED_TRIGRAMS - 1) :][:3] if n > ASKED_TRIGRAMS else s[i : i + 3] for i in range(min(n, ASKED_TRIGRAMS)))

    def close(strings: set[str]) -> None:
        ways = [asked(s) for s in strings]
        if ways and all(ways):
            groups.append(sorted(set(ways), key=sorted))

    def strings_of(item) -> set[str] | None:
        """The strings an item can match if they are few, otherwise None."""
        op, value = item
        if op is C.LITERAL:
            return {chr(value).lower()}
        if op is C.IN:
            chars: set[str] = set()
            for kind, x in value:
                if kind is C.LITERAL:
                    chars.add(chr(x).lower())
                elif kind is C.RANGE and x[1] - x[0] < MAX_STRINGS:
                    chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
                else:
                    return None
            return chars if len(chars) <= 8 else None
        if op is C.SUBPATTERN:
            return all_of(value[-1])
        if op is C.BRANCH:
            ways = [all_of(branch) for branch in value[1]]
            return None if any(w is None for w in ways) else set().union(*ways)
        if op in (C.MAX_REPEAT, C.MIN_REPEAT) and value[1] == 1:
            inner = all_of(value[2])
            return None if inner is None else inner | ({""} if value[0] == 0 else set())
        return None

    def all_of(items) -> set[str] | None:
        out = {""}
        for item in items:
            ways = strings_of(item)
            if ways is None or len(out) * len(ways) > MAX_STRINGS:
                return None
            out = {a + b for a, b in product(out, ways)}
        return out

    open_ = {""}
    for item in parser.parse(pattern):
        ways = strings_of(item)
        if ways is not None and len(open_) * len(ways) <= MAX_STRINGS:
            open_ = {a + b for a, b in product(open_, ways)}
        else:
            close(open_)
            open_ = ways or {""}
    close(open_)
    return groups


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index as rows ``(trigram, doc_id)``, for the trigrams that some rule asks for."""
    low = F.lower("text")
    held = F.filter(F.array(*[F.lit(t) for t in trigrams]), lambda t: F.contains(F.col("low"), t))
    return docs.select("doc_id", low.alias("low")).select("doc_id", F.explode(held).alias("trigram")).distinct()


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, rules)``: the rules with mandatory trigrams whose whole query the document satisfies."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    terms = [
        (kind, g, a, trigram, len(way), len(groups))
        for kind, groups in queries.items()
        for g, ways in enumerate(groups)
        for a, way in enumerate(ways)
        for trigram in sorted(way)
    ]
    if not terms:
        return docs.select("doc_id", F.array().cast("array<string>").alias("rules")).limit(0)
    schema = "rule string, grp int, way int, trigram string, of_way int, of_rule int"
    asked = docs.sparkSession.createDataFrame(terms, schema)  # fixed by the rules, whatever the data
    met = postings(docs, sorted({t[3] for t in terms})).join(F.broadcast(asked), "trigram")
    ways = met.groupBy("doc_id", "rule", "of_rule", "grp", "way").agg(
        F.count(F.lit(1)).alias("n"), F.first("of_way").alias("of_way")
    )
    groups = ways.where("n = of_way").groupBy("doc_id", "rule", "of_rule").agg(F.count_distinct("grp").alias("n"))
    return groups.where("n = of_rule").groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))


def verified(text: Column, rule: Rule, order: int) -> Column:
    """``array<struct<start, place, kind, end>>`` of a rule's matches that are long enough."""
    spans = regex_spans(text, F.lit(rule.pattern))
    if rule.group:
        inner = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
        sized = F.zip_with(spans, inner, lambda s, g: F.struct(s["start"], s["end"], F.char_length(g).alias("n")))
    else:
        sized = F.transform(spans, lambda s: F.struct(s["start"], s["end"], (s["end"] - s["start"]).alias("n")))
    return F.transform(
        F.filter(sized, lambda s: s["n"] >= rule.floor),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("place"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")
        ),
    )


SPANS = "array<struct<start:bigint,place:int,kind:string,end:bigint>>"


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, spans)``: spans in code points, end exclusive, by start and then by the order of the rules."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = candidates(docs, rules).withColumnRenamed("doc_id", "id")
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["id"]), "left")
    parts = []
    for order, rule in enumerate(rules):
        asked = trigram_query(rule.pattern)
        worth = F.array_contains("rules", rule.kind) if asked else F.col("text").rlike(rule.pattern)
        nothing = F.array().cast(SPANS)
        parts.append(F.when(worth, verified(F.col("text"), rule, order)).otherwise(nothing))
    return joined.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def compiled(rules: tuple[Rule, ...] = RULES) -> dict[str, re.Pattern]:
    """The rules for Python's engine, which the tests use as brute force."""
    return {r.kind: re.compile(r.pattern) for r in rules}
