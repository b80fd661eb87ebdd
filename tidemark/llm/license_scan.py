"""License scan by ordered signature rules, with DataFrame functions only.

Words are runs of letters, digits and signs beyond ASCII, A-Z lower-cased. Base places are the fixed
phrases of ``BASE``. On top, several hundred signature rules run over the words joined by single spaces:
those of ``SIGNATURES`` (texts of licences, headers, tags, links), then names from ``FAMILIES`` in four
shapes (tag, statement, name with version, bare name). A rule is tried only where its keyword occurs. A detection is dropped when one of at least its priority covers it;
of equal ones the earlier rule stays. Everything happens within the row, so nothing is shuffled.

Null and empty texts have no words, no labels and score 0.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import LOWER, UPPER, documents

# Base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Label, keyword, patterns of the name, versions.
FAMILIES = (
    ("gpl", "gnu", ("gnu general public licen[cs]e", "gnu gpl"), ("1.0", "2.0", "3.0")),
    ("gpl", "gpl", ("gpl",), ("1.0", "2.0", "3.0")),
    ("lgpl", "lesser", ("(?:gnu )?lesser general public licen[cs]e",), ("2.1", "3.0")),
    ("lgpl", "lgpl", ("lgpl",), ("2.0", "2.1", "3.0")),
    ("agpl", "affero", ("(?:gnu )?affero general public licen[cs]e",), ("1.0", "3.0")),
    ("agpl", "agpl", ("agpl",), ("1.0", "3.0")),
    ("gfdl", "documentation", ("(?:gnu )?free documentation licen[cs]e",), ("1.1", "1.2", "1.3")),
    ("apache", "apache", ("apache (?:software )?licen[cs]e", "apache"), ("1.0", "1.1", "2.0")),
    ("mit", "mit", ("mit licen[cs]e", "mit"), ()),
    ("mit", "expat", ("expat licen[cs]e",), ()),
    ("bsd", "bsd", ("bsd licen[cs]e", "(?:2|two|3|three|4|four) clause bsd(?: licen[cs]e)?"), ("2", "3", "4")),
    ("mpl", "mozilla", ("mozilla public licen[cs]e",), ("1.0", "1.1", "2.0")),
    ("epl", "eclipse", ("eclipse public licen[cs]e",), ("1.0", "2.0")),
    ("cddl", "cddl", ("cddl",), ("1.0", "1.1")),
    ("cddl", "distribution", ("common development and distribution licen[cs]e",), ("1.0", "1.1")),
    ("cpl", "common", ("common public licen[cs]e",), ("1.0",)),
    ("eupl", "european", ("european union public licen[cs]e",), ("1.0", "1.1", "1.2")),
    ("artistic", "artistic", ("artistic licen[cs]e",), ("1.0", "2.0")),
    ("bsl", "boost", ("boost software licen[cs]e",), ("1.0",)),
    ("osl", "open", ("open software licen[cs]e",), ("1.0", "2.0", "2.1", "3.0")),
    ("afl", "academic", ("academic free licen[cs]e",), ("1.1", "2.0", "2.1", "3.0")),
    ("ofl", "font", ("(?:sil )?open font licen[cs]e",), ("1.0", "1.1")),
    ("odbl", "database", ("open database licen[cs]e",), ("1.0",)),
    ("isc", "isc", ("isc licen[cs]e",), ()),
    ("zlib", "zlib", ("zlib licen[cs]e",), ()),
    ("unlicense", "unlicense", ("unlicense",), ()),
    ("wtfpl", "wtfpl", ("wtfpl",), ("2.0",)),
    ("psf", "python", ("python software foundation licen[cs]e",), ("2.0",)),
    ("ecl", "educational", ("educational community licen[cs]e",), ("1.0", "2.0")),
    ("ms-pl", "microsoft", ("microsoft public licen[cs]e",), ()),
    ("cc0", "cc0", ("cc0",), ("1.0",)),
    ("public-domain", "domain", ("(?:in|to|into) the public domain",), ()),
)
CC_PARTS = ("", " sa", " nc", " nd", " nc sa", " nc nd")
CC_WORDS = {"sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Labels whose name is a single word and yet counts by itself.
SINGLE_WORDS = ("unlicense", "wtfpl", "cc0")

# Signatures of licence texts, headers, tags and links, as label, words that a text must hold,
# and pattern over lower-cased words. Of two on one place the earlier counts, so the narrower ones come first.
_OR_LATER = "either version {} of the licen[cs]e or at your option any later version"
_PUBLISHED = "licen[cs]e(?: version {0})? as published by the free software foundation"
SIGNATURES = (
    # texts of licences
    ("mit", ("hereby", "granted"), "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit-0", ("hereby", "granted"), "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is"),
    ("bsd-4-clause", ("advertising", "acknowledg"), "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-3-clause", ("neither", "endorse"), "neither the names? of (?:the )?(?:copyright holders?|authors?|company|university|organization|project) nor the names of (?:its|their|any) contributors may be used to endorse or promote products"),
    ("bsd", ("redistribution", "binary"), "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", ("hereby", "granted"), "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", ("hereby", "granted"), "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("0bsd", ("hereby", "granted"), "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("zlib", ("altered", "misrepresented"), "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("bsl-1.0", ("hereby", "granted"), "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", ("unencumbered",), "this is free and unencumbered software released into the public domain"),
    ("wtfpl", ("fuck",), "you just do what the fuck you want to"),
    ("postgresql", ("hereby", "granted"), "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("mpl-2.0", ("mozilla", "licen"), "this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("epl-2.0", ("eclipse", "licen"), "this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e(?: v)? 2 0"),
    ("epl-1.0", ("eclipse", "licen"), "this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1 0"),
    ("artistic-2.0", ("artistic", "licen"), "you (?:can|may) redistribute it and or modify it under the terms of the artistic licen[cs]e 2 0"),
    ("cc0-1.0", ("extent", "copyright"), "to the extent possible under law (?:the authors?|the person who associated cc0 with this work) (?:has|have) (?:dedicated|waived) all copyright"),
    ("psf-2.0", ("psf", "grants"), "psf hereby grants licensee a nonexclusive royalty free world wide licen[cs]e"),
    # headers of the GNU licences
    *[
        (f"{label}-{version}-or-later", ("gnu", "licen"), f"gnu {name} {_PUBLISHED.format(n)} {_OR_LATER.format(n)}")
        for label, name, versions in (
            ("agpl", "affero general public", (("3.0", "3"),)),
            ("lgpl", "lesser general public", (("2.1", "2 1"), ("3.0", "3"))),
            ("gpl", "general public", (("2.0", "2"), ("3.0", "3"))),
        )
        for version, n in versions
    ],
    ("gpl-2.0-only", ("gnu", "licen"), "gnu general public licen[cs]e version 2 as published by the free software foundation"),
    ("gpl-3.0-only", ("gnu", "licen"), "gnu general public licen[cs]e version 3 as published by the free software foundation"),
    # tags
    *[
        (tag.lower(), ("spdx", "licen"), "spdx licen[cs]e identifier " + " ".join(re.split("[^a-z0-9]+", tag.lower())))
        for tag in (
            "BSD-3-Clause-Clear", "BSD-2-Clause-Patent", "BSD-2-Clause", "BSD-3-Clause",
            "BSD-4-Clause", "0BSD", "MIT-0", "ISC", "Zlib", "Unlicense",
            "BSL-1.0", "NCSA", "PostgreSQL", "Python-2.0", "X11", "HPND",
            "OFL-1.1", "UPL-1.0", "BlueOak-1.0.0", "MulanPSL-2.0", "EUPL-1.2",
            "CECILL-2.1", "ODbL-1.0", "MS-PL", "MS-RL", "SSPL-1.0", "BUSL-1.1",
        )
    ],
    # short forms and links
    *[
        (f"{label}-{n}.0", ("gpl",), f"{label}v{n}(?: 0)?")
        for label, versions in (("agpl", "3"), ("lgpl", "23"), ("gpl", "123"))
        for n in versions
    ],
    ("bsd-2-clause", ("bsd",), "(?:bsd (?:2|two) clause|simplified bsd)(?: licen[cs]e)?"),
    ("bsd-3-clause", ("bsd",), "bsd (?:3|three) clause(?: licen[cs]e)?"),
    *[
        (f"cc-{kind}-{version}", (" org ", "licenses"), f"creativecommons org licenses {kind.replace('-', ' ')} {version.replace('.', ' ')}")
        for kind in ("by-nc-sa", "by-nc-nd", "by-sa", "by-nc", "by-nd", "by")
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0")
    ],
    ("cc0-1.0", (" org ", "publicdomain"), "creativecommons org publicdomain zero 1 0"),
    ("apache-2.0", (" org ", "licenses"), "apache org licenses licen[cs]e 2 0"),
    *[
        (f"{label}-{version}", (" org ", "licenses"), f"gnu org licenses (?:old licenses )?{label} {version.replace('.', ' ')}")
        for label, versions in (("agpl", ("3.0",)), ("lgpl", ("2.1", "3.0")), ("gpl", ("1.0", "2.0", "3.0")), ("fdl", ("1.3",)))
        for version in versions
    ],
    *[
        (label, (" org ", "licenses"), f"opensource org licenses {words}")
        for label, words in (
            ("mit", "mit"), ("isc", "isc"), ("bsd-2-clause", "bsd 2 clause"), ("bsd-3-clause", "bsd 3 clause"),
            ("apache-2.0", "apache 2 0"), ("mpl-2.0", "mpl 2 0"), ("zlib", "zlib"), ("ecl-2.0", "ecl 2 0"),
        )
    ],
    ("mpl-2.0", ("mozilla", "mpl"), "mozilla org mpl 2 0"),
    ("unlicense", ("unlicense",), "unlicense org"),
    ("bsl-1.0", ("boost", "txt"), "boost org licen[cs]e 1 0 txt"),
)
TAG, STATEMENT, VERSIONED, BARE = 3, 2, 1, 0
CONFIDENCE = {TAG: 1.0, STATEMENT: 0.95, VERSIONED: 0.8, BARE: 0.5}
_GRANT = "(?:licen[cs]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?(?:an? )?"
_LATER = "(?: or (?:any )?(?:later|newer)(?: version)?)?"


def _families() -> list[tuple[str, str, tuple[str, ...], tuple[str, ...]]]:
    rows = list(FAMILIES)
    for parts in CC_PARTS:
        label = "cc-by" + parts.replace(" ", "-")
        rows.append((label, " cc ", ("cc by" + parts,), CC_VERSIONS))
        spelled = "".join(" " + CC_WORDS[p] for p in parts.split())
        rows.append((label, "commons", ("creative commons attribution" + spelled,), CC_VERSIONS))
    return rows


def signature_rules() -> list[tuple[int, str, str, str, int]]:
    """(order, label, keyword, pattern, priority); patterns start and end at word borders."""
    found: list[tuple[str, str, str, int]] = []
    for label, keyword, names, versions in _families():
        for name in names:
            for version in versions:
                digits = version.removesuffix(".0").replace(".", " ") + ("(?: 0)?" if version.endswith(".0") else "")
                number = f" (?:licen[cs]e )?(?:international )?(?:version |v ?)?{digits}(?! [0-9]){_LATER}"
                found.append((f"{label}-{version}", keyword, f"spdx licen[cs]e identifier {name}{number}", TAG))
                found.append((f"{label}-{version}", keyword, f"{_GRANT}{name}{number}", STATEMENT))
                found.append((f"{label}-{version}", keyword, f"{name}{number}", VERSIONED))
            found.append((label, keyword, f"spdx licen[cs]e identifier {name}", TAG))
            found.append((label, keyword, f"{_GRANT}{name}", STATEMENT))
            if " " in name or label in SINGLE_WORDS:
                found.append((label, keyword, name, BARE))
    # Written signatures come first: of equal detections the earlier rule stays.
    found = [(label, max(needs, key=len), pattern, TAG) for label, needs, pattern in SIGNATURES] + found
    return [(k, label, keyword, f"(?<= ){pattern}(?= )", priority) for k, (label, keyword, pattern, priority) in enumerate(found)]


def text_needs() -> list[frozenset[str]]:
    """Sets of strings, derived from each rule; every text with a match of any rule contains one set whole."""
    needs = set()
    for label, keyword, names, versions in _families():
        for name in names:
            # Optional groups of a name need nothing.
            own = {keyword} | ({"licen"} if "licen" in re.sub(r"\(\?:[^()]*\)\?", "", name) else set())
            needs |= {frozenset(own | {"spdx", "licen"}), frozenset(own | {" under "})}
            if versions or " " in name or label in SINGLE_WORDS:
                needs.add(frozenset(own))
    needs |= {frozenset(own) for _, own, _ in SIGNATURES}
    return sorted((n for n in needs if not any(m < n for m in needs)), key=sorted)


_SEPARATORS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def _spaced(text: Column) -> Column:
    """A-Z lower-cased and every separator a space."""
    return F.trim(F.translate(text, UPPER + _SEPARATORS, LOWER + " " * len(_SEPARATORS)))


def _starts(words: Column, phrase: str) -> Column:
    """Word places at which the phrase's words stand one after another."""
    parts = phrase.split()
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0)))
    return F.filter(
        places, lambda i: reduce(lambda a, b: a & b, [F.get(words, i + k) == p for k, p in enumerate(parts)])
    )


def _detections(flat: Column, rule: Column) -> Column:
    """(start, -end, -priority, order, label) of every match of the rule in ``flat``."""
    hits = F.regexp_extract_all(flat, rule["pattern"], F.lit(0))
    gaps = F.split(flat, rule["pattern"])
    empty = F.array().cast("array<struct<start:int,until:int,rank:int,ord:int,label:string>>")

    def step(acc: Column, hit: Column) -> Column:
        start = acc["at"] + F.length(F.get(gaps, F.size(acc["found"])))
        end = start + F.length(hit)
        one = F.struct(
            start.cast("int").alias("start"),
            (-end).cast("int").alias("until"),
            (-rule["priority"]).cast("int").alias("rank"),
            rule["ord"].alias("ord"),
            rule["label"].alias("label"),
        )
        return F.struct(end.cast("int").alias("at"), F.concat(acc["found"], F.array(one)).alias("found"))

    return F.aggregate(hits, F.struct(F.lit(0).alias("at"), empty.alias("found")), step, lambda acc: acc["found"])


def _survivors(found: Column) -> Column:
    """Labels and best confidence of the detections that no other of at least their priority covers."""
    levels = (BARE, VERSIONED, STATEMENT, TAG)
    start = F.struct(
        *[F.lit(0).alias(f"to{p}") for p in levels],
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("score"),
    )

    def step(acc: Column, x: Column) -> Column:
        end, priority = -x["until"], -x["rank"]
        # Sorted by start, longest first: all that can cover x came before it.
        reach = [F.when(priority == p, F.greatest(*[acc[f"to{q}"] for q in levels if q >= p], F.lit(0))) for p in levels]
        stays = F.coalesce(*reach) < end
        sure = F.coalesce(*[F.when(priority == p, F.lit(CONFIDENCE[p])) for p in levels])
        return F.struct(
            *[F.greatest(acc[f"to{p}"], F.when(priority == p, end).otherwise(F.lit(0))).alias(f"to{p}") for p in levels],
            F.when(stays, F.array_union(acc["labels"], F.array(x["label"]))).otherwise(acc["labels"]).alias("labels"),
            F.when(stays, F.greatest(acc["score"], sure)).otherwise(acc["score"]).alias("score"),
        )

    return F.aggregate(F.array_sort(found), start, step)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row per document."""
    rules = F.array(
        *[
            F.struct(
                F.lit(k).alias("ord"), F.lit(label).alias("label"), F.lit(keyword).alias("keyword"),
                F.lit(pattern).alias("pattern"), F.lit(priority).alias("priority"),
            )
            for k, label, keyword, pattern, priority in signature_rules()
        ]
    )
    rows = documents(docs).select("doc_id", _spaced(F.col("text")).alias("spaced"))
    padded = F.concat(F.lit(" "), F.col("spaced"), F.lit(" "))
    # A text that meets the needs of no rule holds no match, and no base phrase either.
    near = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [padded.contains(w) for w in sorted(needs)]) for needs in text_needs()])
    rows = rows.select(
        "doc_id",
        F.when(F.col("spaced") == "", F.array().cast("array<string>")).otherwise(F.split("spaced", " +")).alias("words"),
        near.alias("near"),
    )
    flat = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    rows = rows.select("doc_id", F.size("words").alias("n_words"), F.when(F.col("near"), F.col("words")).alias("words"), F.when(F.col("near"), flat).alias("flat"))
    tried = F.filter(rules, lambda r: F.col("flat").contains(r["keyword"]))
    found = F.flatten(F.transform(tried, lambda r: _detections(F.col("flat"), r)))
    places = [_starts(F.col("words"), phrase) for phrase, _ in BASE]
    rows = rows.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        *[F.when(F.col("words").isNotNull() & F.col("flat").contains(f" {phrase} "), p).otherwise(F.array().cast("array<int>")).alias(f"at{k}") for k, (p, (phrase, _)) in enumerate(zip(places, BASE, strict=True))],
        F.when(F.col("flat").isNotNull(), _survivors(found)).alias("method"),
    )
    every = F.concat(*[F.col(f"at{k}") for k in range(len(BASE))])
    base = F.array_compact(F.array(*[F.when(F.size(f"at{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]))
    more = F.coalesce(F.col("method.labels"), F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.greatest(F.coalesce("method.score", F.lit(0.0)), F.when(F.size(every) > 0, 0.5).otherwise(0.0)).alias("score"),
    )
