"""License detection by ordered signature rules.  DataFrame functions only.

A rule is (label, priority, keywords, pattern).  Every match of a pattern holds
one of its rule's keywords, so a document without them skips the rule, and it
skips all rules if it holds no keyword of any.  Patterns run over the
lower-cased words joined by one space.  Of the places found, one is dropped if
it lies inside another of a rule with higher or equal priority (of equal
intervals the first by priority, then rule order, stays).

A text with keywords is scanned in chunks of words that overlap by more than
any match is long; a place belongs to the chunk in which it starts.  So the cost
of a text grows with its length, not with the square of its matches.  No match
of a rule crosses another of it, so it does not matter where a chunk begins."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streamkit.llm.quality_rules import let
from streamkit.llm.registry import query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CHUNK = 512  # words whose matches are looked for together
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases whose places are the base detections, and their labels
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# License families, as (label, SPDX identifiers in words, names as patterns over words).
# Written by hand; the rules below are made of these and of the forms.
FAMILIES = [
    ("mit", ["mit"], [r"mit", r"expat", r"mit x11", r"x11"]),
    ("mit-0", ["mit 0"], [r"mit no attribution"]),
    ("apache-1.0", ["apache 1 0"], [r"apache(?: software)? license version 1 0"]),
    ("apache-1.1", ["apache 1 1"], [r"apache(?: software)? license version 1 1"]),
    ("apache-2.0", ["apache 2 0"], [r"apache(?: software)? license(?: version)? 2(?: 0)?", r"asl 2 0", r"apache 2(?: 0)?"]),
    ("gpl-1.0", ["gpl 1 0", "gpl 1 0 only", "gpl 1 0 or later"], [r"(?:gnu )?(?:gpl|general public license)(?: version| v)? 1(?: 0)?", r"gplv1"]),
    ("gpl-2.0", ["gpl 2 0", "gpl 2 0 only", "gpl 2 0 or later"], [r"(?:gnu )?(?:gpl|general public license)(?: version| v)? 2(?: 0)?", r"gplv2"]),
    ("gpl-3.0", ["gpl 3 0", "gpl 3 0 only", "gpl 3 0 or later"], [r"(?:gnu )?(?:gpl|general public license)(?: version| v)? 3(?: 0)?", r"gplv3"]),
    ("lgpl-2.0", ["lgpl 2 0"], [r"(?:gnu )?library general public license(?: version| v)? 2(?: 0)?", r"lgpl(?: version| v)? 2 0"]),
    ("lgpl-2.1", ["lgpl 2 1", "lgpl 2 1 only", "lgpl 2 1 or later"], [r"(?:gnu )?(?:lgpl|lesser general public license)(?: version| v)? 2 1", r"lgplv2 1"]),
    ("lgpl-3.0", ["lgpl 3 0", "lgpl 3 0 only", "lgpl 3 0 or later"], [r"(?:gnu )?(?:lgpl|lesser general public license)(?: version| v)? 3(?: 0)?", r"lgplv3"]),
    ("agpl-3.0", ["agpl 3 0", "agpl 3 0 only", "agpl 3 0 or later"], [r"(?:gnu )?(?:agpl|affero general public license)(?: version| v)? 3(?: 0)?", r"agplv3"]),
    ("gfdl-1.3", ["gfdl 1 3"], [r"(?:gnu )?free documentation license(?: version)?(?: 1 [123])?", r"gfdl"]),
    ("bsd-2-clause", ["bsd 2 clause"], [r"(?:2|two) clause bsd", r"simplified bsd", r"freebsd license", r"bsd 2 clause"]),
    ("bsd-3-clause", ["bsd 3 clause"], [r"(?:3|three) clause bsd", r"(?:new|modified|revised) bsd", r"bsd 3 clause"]),
    ("bsd-4-clause", ["bsd 4 clause"], [r"(?:4|four) clause bsd", r"original bsd", r"bsd 4 clause"]),
    ("0bsd", ["0bsd"], [r"zero clause bsd", r"bsd zero clause"]),
    ("mpl-1.1", ["mpl 1 1"], [r"mozilla public license(?: version)? 1 1", r"mpl 1 1"]),
    ("mpl-2.0", ["mpl 2 0"], [r"mozilla public license(?: version)?(?: v)? 2 0", r"mpl 2 0"]),
    ("epl-1.0", ["epl 1 0"], [r"eclipse public license(?: version)?(?: v)? 1(?: 0)?"]),
    ("epl-2.0", ["epl 2 0"], [r"eclipse public license(?: version)?(?: v)? 2(?: 0)?"]),
    ("cddl-1.0", ["cddl 1 0"], [r"common development and distribution license(?: version)?(?: 1 0)?", r"cddl"]),
    ("cpl-1.0", ["cpl 1 0"], [r"common public license(?: version)?(?: 1 0)?"]),
    ("isc", ["isc"], [r"isc"]),
    ("zlib", ["zlib"], [r"zlib(?: libpng)?"]),
    ("libpng", ["libpng", "libpng 2 0"], [r"libpng"]),
    ("bsl-1.0", ["bsl 1 0"], [r"boost software license(?: version)?(?: 1 0)?"]),
    ("busl-1.1", ["busl 1 1"], [r"business source license(?: 1 1)?"]),
    ("sspl-1.0", ["sspl 1 0"], [r"server side public license"]),
    ("unlicense", ["unlicense"], [r"the unlicense", r"unlicense"]),
    ("wtfpl", ["wtfpl"], [r"do what the fuck you want to public license", r"wtfpl"]),
    ("cc0-1.0", ["cc0 1 0"], [r"cc0", r"creative commons(?: cc0)? (?:zero|public domain dedication)"]),
    ("cc-by-2.0", ["cc by 2 0"], [r"creative commons attribution 2 0", r"cc by 2 0"]),
    ("cc-by-3.0", ["cc by 3 0"], [r"creative commons attribution 3 0", r"cc by 3 0"]),
    ("cc-by-4.0", ["cc by 4 0"], [r"creative commons attribution 4 0", r"cc by 4 0"]),
    ("cc-by-sa-3.0", ["cc by sa 3 0"], [r"creative commons attribution share ?alike 3 0", r"cc by sa 3 0"]),
    ("cc-by-sa-4.0", ["cc by sa 4 0"], [r"creative commons attribution share ?alike 4 0", r"cc by sa 4 0"]),
    ("cc-by-nc-4.0", ["cc by nc 4 0"], [r"creative commons attribution non ?commercial 4 0", r"cc by nc 4 0"]),
    ("cc-by-nd-4.0", ["cc by nd 4 0"], [r"creative commons attribution no ?deriv(?:atives|s) 4 0", r"cc by nd 4 0"]),
    ("cc-by-nc-sa-4.0", ["cc by nc sa 4 0"], [r"creative commons attribution non ?commercial share ?alike 4 0", r"cc by nc sa 4 0"]),
    ("cc-by-nc-nd-4.0", ["cc by nc nd 4 0"], [r"creative commons attribution non ?commercial no ?deriv(?:atives|s) 4 0", r"cc by nc nd 4 0"]),
    ("artistic-1.0", ["artistic 1 0"], [r"artistic license(?: version)? 1 0"]),
    ("artistic-2.0", ["artistic 2 0"], [r"artistic license(?: version)? 2 0"]),
    ("psf-2.0", ["psf 2 0", "python 2 0"], [r"python software foundation license(?: version)?(?: 2)?", r"psf license"]),
    ("ruby", ["ruby"], [r"ruby license"]),
    ("php-3.01", ["php 3 01"], [r"php license(?: version)?(?: 3 01)?"]),
    ("postgresql", ["postgresql"], [r"postgresql"]),
    ("ncsa", ["ncsa"], [r"(?:university of illinois )?ncsa(?: open source)?"]),
    ("openssl", ["openssl"], [r"openssl"]),
    ("ofl-1.1", ["ofl 1 1"], [r"sil open font license(?: version)?(?: 1 1)?", r"open font license"]),
    ("odbl-1.0", ["odbl 1 0"], [r"open database license", r"odbl"]),
    ("odc-by-1.0", ["odc by 1 0"], [r"open data commons attribution"]),
    ("pddl-1.0", ["pddl 1 0"], [r"public domain dedication and license"]),
    ("eupl-1.2", ["eupl 1 2"], [r"european union public licence(?: version)?(?: v)?(?: 1 [12])?", r"eupl"]),
    ("ms-pl", ["ms pl"], [r"microsoft public license"]),
    ("ms-rl", ["ms rl"], [r"microsoft reciprocal license"]),
    ("afl-3.0", ["afl 3 0"], [r"academic free license(?: version)?(?: 3 0)?"]),
    ("osl-3.0", ["osl 3 0"], [r"open software license(?: version)?(?: 3 0)?"]),
    ("ecl-2.0", ["ecl 2 0"], [r"educational community license(?: version)?(?: 2 0)?"]),
    ("upl-1.0", ["upl 1 0"], [r"universal permissive license"]),
    ("vim", ["vim"], [r"vim license"]),
    ("w3c", ["w3c"], [r"w3c software (?:notice and )?license"]),
    ("beerware", ["beerware"], [r"beer ?ware"]),
    ("llama", ["llama2", "llama3"], [r"llama (?:2|3|3 1) community"]),
    ("openrail", ["openrail"], [r"(?:creativeml )?open ?rail(?: m| plus plus)?"]),
]

GRANTS = ["licensed", "released", "distributed", "available", "published", "provided"]
# (pattern around a name or identifier, priority, score, keywords); {} stands for it.
# Every match holds one of the keywords.
NAME_FORMS = [
    (rf"(?:re)?(?:{'|'.join(GRANTS)}) under (?:the )?(?:terms of )?(?:the )?{{}}(?: licen[sc]e)?", 30, 0.95, [f"{g} under" for g in GRANTS]),
    (r"(?:the )?{} licen[sc]e", 20, 0.8, ["licen"]),
    (r"licen[sc]e(?:d under)?(?: type| name)? {}", 10, 0.7, ["licen"]),
]
ID_FORMS = [(r"spdx licen[sc]e identifier {}", 50, 1.0, ["licen"]), (r"licen[sc]e (?:expression|id) {}", 40, 0.9, ["licen"])]
# Rules outside the families: texts that state terms without a name
TEXT_RULES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", 60, 1.0),
    ("isc", "permission to use copy", r"permission to use copy modify and or distribute this software for any purpose", 60, 1.0),
    ("bsd", "and use in source", r"redistributions? and use in source and binary forms", 60, 0.9),
    ("gpl", "gnu", r"under the terms of the gnu general public license", 25, 0.9),
    ("lgpl", "gnu", r"under the terms of the gnu lesser general public license", 26, 0.9),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in)?to the public domain", 30, 0.8),
    ("proprietary", "all rights reserved", r"all rights reserved", 5, 0.3),
    ("gpl", "general public licen", r"(?:gnu )?general public licen[sc]e", 3, 0.6),
    ("apache", "apache licen", r"apache licen[sc]e", 3, 0.6),
    ("creative-commons", "creative commons", r"creative commons", 2, 0.4),
]

def rules() -> list[dict]:
    """All rules, in order; several hundred, made of the tables above."""
    out = []
    for label, ids, names in FAMILIES:
        for forms, parts in ((NAME_FORMS, names), (ID_FORMS, ids)):
            for part in parts:
                for form, priority, score, keywords in forms:
                    out.append({"label": label, "keywords": keywords, "gate": max(_plain(part).split(" "), key=len, default=""),
                                "pattern": form.replace("{}", f"(?:{part})"), "priority": priority, "score": score})
    for label, keyword, pattern, priority, score in TEXT_RULES:
        out.append({"label": label, "keywords": [keyword], "gate": keyword, "pattern": pattern, "priority": priority, "score": score})
    return [r | {"rule": i} for i, r in enumerate(out)]


def stems() -> list[str]:
    """The keywords that hold no other keyword: a text with any keyword holds one of these."""
    words = sorted({k for r in rules() for k in r["keywords"]})
    return [w for w in words if not any(o != w and o in w for o in words)]


def longest() -> int:
    """The most words that a match of any rule has."""
    def words(parsed) -> int:  # spaces in the longest match
        n = 0
        for op, arg in parsed:
            kind = str(op)
            if kind == "LITERAL":
                n += arg == 32
            elif kind == "BRANCH":
                n += max(words(x) for x in arg[1])
            elif kind == "MAX_REPEAT":
                n += arg[1] * words(arg[2])
            elif kind == "SUBPATTERN":
                n += words(arg[-1])
            elif kind != "IN":
                raise ValueError(f"rules have no {kind}")
        return n
    return 1 + max(words(re._parser.parse(r["pattern"])) for r in rules())


def _plain(pattern: str) -> str:
    """The words that every match of ``pattern`` holds: its text outside groups."""
    depth, text = 0, ""
    for at, c in enumerate(pattern):
        depth += (c == "(") - (c == ")" and depth > 0)
        if not depth and c != ")":
            text += " " if c in "?[]" else c
        elif c == "(":
            text += " "
    return " ".join(w for w in text.split() if w)


RULE_TYPE = "array<struct<label:string,keywords:array<string>,gate:string,pattern:string,priority:int,score:double,rule:int>>"
_FOUND = "struct<a:int,b:int,label:string,priority:int,score:double,rule:int>"


def _places(norm: Column, rule: Column) -> Column:
    """Word intervals [a, b) where ``rule`` matches in `` w1 w2 ... wn ``."""
    # \G: each match goes on where the last one ended, so a text is passed once; (?s): also across U+0085, U+2028 and U+2029, which are in words here
    pattern = F.concat(F.lit(r"(?s)\G(.*?)( (?:"), rule["pattern"], F.lit(")(?= ))"))
    words = lambda s: F.size(F.split(s, " ")) - 1  # noqa: E731  spaces in s

    def located(gaps: Column) -> Column:
        hits = F.regexp_extract_all(norm, pattern, F.lit(2))
        return let(hits, lambda found: F.transform(found, lambda hit, i: let(
            F.aggregate(F.slice(gaps, 1, i + 1), F.lit(0), lambda n, g: n + words(g)) + F.aggregate(F.slice(found, 1, i), F.lit(0), lambda n, g: n + words(g)),
            lambda a: F.struct(a.alias("a"), (a + words(hit)).alias("b"), rule["label"].alias("label"), rule["priority"].alias("priority"),
                               rule["score"].alias("score"), rule["rule"].alias("rule")))))
    return let(F.regexp_extract_all(norm, pattern, F.lit(1)), located)


def _detected(norm: Column, listed: Column) -> Column:
    gated = F.filter(listed, lambda r: F.contains(norm, r["gate"]) & F.exists(r["keywords"], lambda k: F.contains(norm, k)))
    return F.flatten(F.transform(gated, lambda r: _places(norm, r)))


def _kept(found: Column) -> Column:
    """Places not inside another of higher or equal priority."""
    def hidden(x: Column, y: Column) -> Column:
        inside = (y["a"] <= x["a"]) & (x["b"] <= y["b"])
        same = (y["a"] == x["a"]) & (x["b"] == y["b"])
        above = (y["priority"] > x["priority"]) | ((y["priority"] == x["priority"]) & (~same | (y["rule"] < x["rule"])))
        return inside & above
    return F.filter(found, lambda x: ~F.exists(found, lambda y: hidden(x, y)))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: (doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, detections).  ``detections`` are the word intervals kept, with
    label, priority and rule; ``score`` is the best of their scores and of 0.5
    for a base phrase, 0 if there is neither.  Labels are distinct, sorted and
    joined by commas ("" if none); base labels always stay.

    A null text is empty.  Null and repeated ids are passed through, other
    columns ignored; an empty table gives an empty one.  There is no shuffle."""
    margin = longest()
    listed = F.from_json(F.lit(json.dumps(rules())), RULE_TYPE)
    low = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.btrim(F.regexp_replace(low, GAP, " "), F.lit(" ")).alias("text"))
    rows = rows.select("doc_id", "text", F.when(F.col("text") == "", 0).otherwise(
        F.char_length("text") - F.char_length(F.translate("text", " ", "")) + 1).cast("long").alias("n_words"))
    hit = F.when(F.lit(False), F.lit(False))
    for stem in stems():
        hit = hit.when(F.contains("text", F.lit(stem)), F.lit(True))
    none = F.from_json(F.lit("[]"), f"array<{_FOUND}>")

    def in_chunk(words: Column, c: Column) -> Column:
        """What is kept of the places that start in the c-th chunk."""
        begin = F.greatest(c * CHUNK - margin, F.lit(0))

        def kept(norm: Column) -> Column:
            core = F.filter(let(_detected(norm, listed), _kept), lambda x: (x["a"] + begin >= c * CHUNK) & (x["a"] + begin < (c + 1) * CHUNK))
            return F.transform(core, lambda x: x.withField("a", x["a"] + begin).withField("b", x["b"] + begin))
        return let(F.concat(F.lit(" "), F.array_join(F.slice(words, begin + 1, (c + 1) * CHUNK + margin - begin), " "), F.lit(" ")), kept)

    def in_chunks(words: Column) -> Column:
        return F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.size(words) - 1) / CHUNK).cast("int")), lambda c: in_chunk(words, c)))

    def base_places(words: Column) -> Column:
        def at(phrase: str, label: str) -> Column:
            parts = phrase.split(" ")
            starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.forall(
                F.array(*[F.coalesce(F.get(words, i + k) == p, F.lit(False)) for k, p in enumerate(parts)]), lambda ok: ok))
            return F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))
        return F.concat(*[at(p, label) for p, label in BASE])

    places = F.when(F.contains("text", F.lit("license")), let(F.split("text", " "), base_places)) \
        .otherwise(F.from_json(F.lit("[]"), "array<struct<at:int,label:string>>"))
    found = F.when(hit.otherwise(F.lit(False)), let(F.split("text", " "), in_chunks)).otherwise(none)
    rows = rows.select("doc_id", "n_words", places.alias("base"), found.alias("detections"))
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    labels = F.array_sort(F.array_distinct(F.concat(F.transform("base", lambda x: x["label"]), F.transform("detections", lambda x: x["label"]))))
    best = F.greatest(F.coalesce(F.array_max(F.transform("detections", lambda x: x["score"])), F.lit(0.0)), F.when(F.size("base") > 0, 0.5).otherwise(0.0))
    return rows.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                       F.array_min(F.transform("base", lambda x: x["at"])).cast("long").alias("first_word"),
                       F.array_max(F.transform("base", lambda x: x["at"])).cast("long").alias("last_word"),
                       F.array_join(base_labels, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), best.alias("score"), "detections")


@query("op10_license_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("detections")
