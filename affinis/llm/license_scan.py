"""License scan: ordered signature rules on word sequences, with DataFrame functions only.

A document without any of the words in ``QUICK``, or without any of the phrases
in ``GATES``, of which each match of a rule has one, is passed over. The others
are reduced to words, and each rule whose keywords occur runs its regular
expression over the words. A detection that lies inside another one of the same
or a higher priority is suppressed, so "licensed under the gnu lesser general
public license" is not reported once more as the general public license. The
three base phrases and the operands of SPDX expressions are never suppressed.

The rules are signatures written by hand, of license texts, notices, titles and
SPDX expressions (``license_signatures``), and beside them sentence forms with
license names, all in order of priority.

Defined cases: a very long text is scanned whole, rule by rule, and held once as words; a NULL text has no words, score 0 and empty labels; ties between
equal intervals go to the rule that comes first; equal rows give equal results;
an empty table gives no rows; columns other than ``doc_id`` and ``text`` are not
looked at.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm import license_signatures
from affinis.llm.common import NOT_LOWER_WORD, let, lower_ascii, regex_spans
from affinis.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Signature:
    """``pattern`` runs over words with one blank between; each match has one of ``keywords`` and one of ``also`` in it."""

    label: str
    keywords: tuple[str, ...]
    pattern: str
    priority: int
    confidence: float
    base: bool = False
    also: tuple[str, ...] = ("",)
    operand: bool = False


# The phrases of the base, and the names under which public licenses are known.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
#: Label, the words (separated by |, their beginnings with *) of which each match has one, and the name.
NAMES = (
    ("mit", "mit", "mit"),
    ("mit-0", "mit", "mit 0|mit no attribution"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version)? 2(?: 0)?"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version)? 1 1"),
    ("bsd-2-clause", "bsd|freebsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)"),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)"),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)"),
    ("gpl-2", "gpl*|general public*", "(?:gnu )?(?:gpl|general public license)(?: gpl)?(?: version| v)? ?2(?: 0)?"),
    ("gpl-3", "gpl*|general public*", "(?:gnu )?(?:gpl|general public license)(?: gpl)?(?: version| v)? ?3(?: 0)?"),
    ("gpl", "gnu", "gnu (?:gpl|general public license)"),
    ("lgpl-2.1", "lgpl*|lesser general public*", "(?:gnu )?(?:lgpl|lesser general public license)(?: lgpl)?(?: version| v)? ?2 1"),
    ("lgpl-3", "lgpl*|lesser general public*", "(?:gnu )?(?:lgpl|lesser general public license)(?: lgpl)?(?: version| v)? ?3(?: 0)?"),
    ("lgpl", "gnu", "gnu (?:lgpl|(?:lesser|library) general public license)"),
    ("agpl-3", "agpl*|affero general public*", "(?:gnu )?(?:agpl|affero general public license)(?: agpl)?(?: version| v)? ?3(?: 0)?"),
    ("agpl", "affero", "(?:gnu )?affero general public license"),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version)? 1 1"),
    ("mpl-2", "mozilla", "mozilla public license(?: version)? 2(?: 0)?"),
    ("epl-1", "eclipse", "eclipse public license(?: version)? 1(?: 0)?"),
    ("epl-2", "eclipse", "eclipse public license(?: version)? 2(?: 0)?"),
    ("cddl-1", "cddl", "cddl(?: version)? 1(?: 0)?"),
    ("eupl-1.2", "eupl", "eupl(?: version)? 1 2"),
    ("isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("boost-1", "boost", "boost software license(?: version)?(?: 1 0)?"),
    ("artistic-2", "artistic", "artistic(?: license)?(?: version)? 2(?: 0)?"),
    ("python-2", "python", "python(?: software foundation)?(?: license)?(?: version)? 2(?: 0)?"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("ofl-1.1", "ofl", "(?:sil )?ofl(?: version)? 1 1"),
    ("postgresql", "postgresql", "postgresql"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa"),
    ("openssl", "openssl", "openssl"),
    ("ms-pl", "microsoft", "microsoft public"),
    ("cc0-1", "cc0", "cc0(?: 1 0)?"),
    ("cc-by", "cc", "cc by(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", "cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by", "creative", "creative commons attribution(?: [1-4] [05])?"),
    ("cc-by-sa", "creative", "creative commons attribution sharealike(?: [1-4] [05])?"),
    ("cc-by-nc", "creative", "creative commons attribution noncommercial(?: [1-4] [05])?"),
)
FORMS = (
    (1, 1.0, "spdx license identifier ", "spdx license identifier {}"),
    (2, 0.95, "ed under |available under ", "(?:is |are )?(?:licensed|licenced|released|distributed|published|available) under (?:the )?{}(?: licen[sc]e)?"),
    (2, 0.95, "under the terms of ", "under the terms of (?:the )?{}(?: licen[sc]e)?"),
    (3, 0.85, "under the ", "under the {} licen[sc]e"),
    (3, 0.85, "licen", "licen[sc]e {}"),
    (4, 0.7, " licen", "{} licen[sc]e"),
)


#: Each match of a rule has one of these: the word where its form asks for it, otherwise a phrase of the form itself.
GATES = (
    "licen", "cc by", "released under", "distributed under", "published under", "available under", "under the terms of",
    "permission", "redistribut", "public domain", "free software", "copyright", "without restriction", "notice the name",
    "endorse or promote", "advertising materials", "grants to you", "terms and conditions", "verbatim copies", "not distributed with",
    "held liable", "source versions must", "any source distribution", "reference library is", "package may be copied", "anyone is free",
    "you just do", "a beer in return", "creative commons", "extent possible", "product includes", "neither the names", "for good not evil",
    "unicode data files", "charityware", "confidential and proprietary", "strictly prohibited", "publicdomain", "gpl",
)
#: The longest word of each gate, for a search without expressions.
QUICK = tuple(sorted({max(g.split(), key=len) for g in GATES}))
GATE = "(?i)" + "|".join(g.replace(" ", BETWEEN) for g in GATES)


def signatures() -> tuple[Signature, ...]:
    """Base phrases first, then written signatures, then every form with every name, best form first."""
    whole = "(?<= ){}(?= )".format
    rules = [Signature(label, (phrase,), whole(phrase), 0, 1.0, True) for label, phrase in BASE]
    spdx = ("spdx license identifier ",)
    rules += [Signature(label, spdx, whole(p), 1, 1.0, operand=True) for label, p in license_signatures.spdx_rules()]
    for priority, confidence, table in (
        (1, 0.95, license_signatures.lines(license_signatures.TEXTS)),
        (2, 0.95, license_signatures.identifiers()),
        (3, 0.85, license_signatures.lines(license_signatures.TITLES)),
    ):
        rules += [Signature(label, (keyword,), whole(f"(?:{p})"), priority, confidence) for label, keyword, p in table]
    for priority, confidence, also, form in FORMS:
        for label, keywords, name in NAMES:
            pattern = whole(form.format(f"(?:{name})"))
            literals = tuple(f" {k} ".replace("* ", "") for k in keywords.split("|"))
            rules.append(Signature(label, literals, pattern, priority, confidence, also=tuple(also.split("|"))))
    return tuple(rules)


def words_of(text: Column) -> Column:
    """The words with one blank between and around them."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lower_ascii(text), NOT_LOWER_WORD, " ")), F.lit(" "))


def _blanks(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def detections(words: Column, rules: tuple[Signature, ...]) -> Column:
    """``array<struct<start, end, priority, place, label, confidence, base, operand>>`` in words, ends exclusive."""
    # one literal instead of some thousand columns
    fields = "keywords array<string>, pattern string, label string, priority int, place int, confidence double, base boolean, operand boolean, also array<string>"
    rows = [vars(r) | {"place": place} for place, r in enumerate(rules)]
    table = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>")
    one_of = lambda parts: F.exists(parts, lambda p: F.contains(words, p))
    gated = F.filter(table, lambda r: one_of(r["keywords"]) & one_of(r["also"]) & F.rlike(words, r["pattern"]))
    return F.flatten(
        F.transform(
            gated,
            lambda r: F.transform(
                regex_spans(words, r["pattern"], _blanks),
                lambda s: F.struct(
                    (s["start"] - 1).alias("start"),
                    s["end"].alias("end"),
                    r["priority"].alias("priority"),
                    r["place"].alias("place"),
                    r["label"].alias("label"),
                    r["confidence"].alias("confidence"),
                    r["base"].alias("base"),
                    r["operand"].alias("operand"),
                ),
            ),
        )
    )


def detect(docs: DataFrame, rules: tuple[Signature, ...] | None = None) -> DataFrame:
    """``(doc_id, digest, found)`` of each different document that has detections."""
    some = F.array(*[F.lit(w) for w in QUICK])
    quick = let(F.lower("text"), lambda low: F.exists(some, lambda w: F.contains(low, w)))
    suspects = docs.where(quick & F.col("text").rlike(GATE))
    suspects = suspects.select("doc_id", F.xxhash64("text").alias("digest"), words_of(F.col("text")).alias("words"))
    # written, or the optimizer puts the making of the words into every rule
    suspects = materialize(suspects, "license-words")
    found = suspects.select("doc_id", "digest", detections(F.col("words"), rules or signatures()).alias("found"))
    return found.where(F.size("found") > 0)


def unsuppressed(found: DataFrame) -> DataFrame:
    """One row per detection that no other one of the same or a higher priority contains, and the base phrases.

    In order of start, and longest first, a detection lies inside an earlier one
    of its priority or better exactly if the largest end so far reaches its own
    end; so running maxima per priority decide it without comparing pairs.
    """
    rows = found.dropDuplicates(["doc_id", "digest"]).select("doc_id", "digest", F.explode("found").alias("d"))
    rows = rows.select("doc_id", "digest", "d.*")
    order = Window.partitionBy("doc_id", "digest").orderBy("start", F.desc("end"), "priority", "place")
    order = order.rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted({p for p, *_ in FORMS} | {0})
    covered = F.lit(False)
    for p in levels:
        reach = F.max(F.when(F.col("priority") <= p, F.col("end"))).over(order)
        covered = covered | ((F.col("priority") == p) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    return rows.withColumn("covered", covered).where("base or operand or not covered")


def scan_licenses(docs: DataFrame, rules: tuple[Signature, ...] | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, labels, base_labels, score`` and the places of the base phrases."""
    docs = docs.select("doc_id", "text")
    found = materialize(detect(docs, rules), "licenses")
    base = F.filter("found", lambda d: d["base"])
    places = found.dropDuplicates(["doc_id", "digest"]).select(
        "doc_id",
        "digest",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["start"])).alias("last_word"),
    )
    kept = unsuppressed(found).groupBy("doc_id", "digest")
    labels = kept.agg(
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.max("confidence").alias("score"),
    )
    key = ["doc_id", "digest"]
    null_safe = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["digest"].eqNullSafe(b["digest"])
    both = places.join(labels, null_safe(places, labels)).select(
        places["doc_id"].alias("id"), places["digest"].alias("of"), *[c for c in places.columns + labels.columns if c not in key]
    )
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("digest"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("n_words"),
    )
    joined = rows.join(both, rows["doc_id"].eqNullSafe(both["id"]) & rows["digest"].eqNullSafe(both["of"]), "left")
    nothing = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", nothing).alias("base_labels"),
        F.coalesce("labels", nothing).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
