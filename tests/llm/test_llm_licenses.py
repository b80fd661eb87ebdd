import re

import pytest

from llm_fixtures import UPPER, as_rows, empty, messy, plain_texts
from tidemark.llm.license_scan import BASE, scan, signature_rules


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(UPPER))


def base(text):
    words, at, labels = words_of(text), [], set()
    for phrase, label in BASE:
        parts = phrase.split()
        hits = [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
        at += hits
        labels |= {label} if hits else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def method(text):
    """Every rule, then suppression, one by one."""
    flat = " " + " ".join(words_of(text)) + " "
    found = [(m.start(), m.end(), p, k, label) for k, label, gate, pattern, p in signature_rules() if gate in flat for m in re.finditer(pattern, flat)]
    stays = set()
    for x in found:
        covered = any(
            y is not x and y[0] <= x[0] and y[1] >= x[1] and y[2] >= x[2] and ((y[0], -y[1], -y[2], y[3]) < (x[0], -x[1], -x[2], x[3]))
            for y in found
        )
        if not covered:
            stays.add(x[4])
    return stays


TEXTS = [
    "Licensed under the Apache License, Version 2.0 and also the MIT license.",
    "SPDX-License-Identifier: GPL-3.0-or-later",
    "This work is licensed under the GNU General Public License, version 3.",
    "cc by cc by-sa 4.0, CC BY-NC-ND 3.0 creative commons attribution noncommercial 2.5",
    "mit license mit license MIT-license; apache",
    "GNU Lesser General Public License v2.1 or later, the Mozilla Public Licence 2.0",
    "gnu general public", "no licence at all", "x cc", "Public Domain: in the public domain",
]


def test_base_places_equal_plain_search(spark):
    rows = [(d, t) for d, t, _ in plain_texts()] + [(100 + k, t) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = as_rows(scan(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == sorted(((d, *base(t)) for d, t in rows), key=repr)
    assert scan(messy(spark)).count() == len(plain_texts()) and scan(empty(spark)).count() == 0


def test_rules_and_suppression_equal_plain_python(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id BIGINT, text STRING")
    got = {r["doc_id"]: r for r in scan(docs).collect()}
    for k, text in enumerate(TEXTS):
        labels = method(text) | {x for x in base(text)[-1].split(",") if x}
        assert got[k]["labels"] == ",".join(sorted(labels)), text
        assert (got[k]["score"] > 0) == bool(labels) and 0 <= got[k]["score"] <= 1
    assert "gpl-3.0" in got[1]["labels"] and "apache-2.0" in got[0]["labels"]


def test_there_are_hundreds_of_rules_in_order():
    rules = signature_rules()
    assert len(rules) > 200 and [r[0] for r in rules] == list(range(len(rules)))
    for _, _, _, pattern, _ in rules:
        re.compile(pattern)


@pytest.mark.parametrize("banned", ["Python", "Arrow", "Pandas", "Exchange"])
def test_plan_is_native_and_without_shuffle(spark, plan_of, banned):
    docs = spark.createDataFrame([(1, "x")], "doc_id BIGINT, text STRING")
    assert banned not in plan_of(scan(docs), "simple")


def shortest(tokens, pick):
    """A match of a parsed pattern: optional parts left out, of alternatives the first or the last one."""
    out = ""
    for op, arg in tokens:
        match str(op):
            case "LITERAL":
                out += chr(arg)
            case "IN":
                out += chr(arg[pick][1])
            case "BRANCH":
                out += shortest(arg[1][pick], pick)
            case "SUBPATTERN":
                out += shortest(arg[-1], pick)
            case "MAX_REPEAT":
                out += shortest(arg[2], pick) * arg[0]
            case "ASSERT" | "ASSERT_NOT":
                pass
            case _:
                raise AssertionError(op)
    return out


@pytest.mark.parametrize("pick", [0, -1])
def test_every_rule_finds_a_text_of_its_own_match_alone(spark, pick):
    from re import _parser

    texts = {k: shortest(_parser.parse(pattern), pick) for k, _, _, pattern, _ in signature_rules()}
    assert all(re.search(pattern, f" {texts[k]} ") for k, _, _, pattern, _ in signature_rules())
    got = {r["doc_id"]: r for r in scan(spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")).collect()}
    for k, text in texts.items():
        wanted = method(text) | {x for x in base(text)[-1].split(",") if x}
        assert wanted and got[k]["labels"] == ",".join(sorted(wanted)) and got[k]["score"] > 0, text


def test_statements_without_the_word_license(spark):
    texts = ["released under MIT", "Distributed under Apache 2.0", "Apache version 2.0", "3-clause BSD", "CDDL 1.0", "in the public  domain", "submit a commit"]
    got = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")).orderBy("doc_id").collect()
    assert [r["labels"] for r in got] == ["mit", "apache-2.0", "apache-2.0", "bsd", "cddl-1.0", "public-domain", ""]


MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction'
)
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived"
GPL = (
    "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, "
    "either version {} of the License, or (at your option) any later version."
)


SIGNED = [
    (MIT, "mit"),
    (BSD, "bsd"),
    (f"{BSD} {THIRD}", "bsd-3-clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided", "isc"),
    ("Licensed under the Apache License, Version 2.0 (the License); you may not use", "apache-2.0"),
    ("http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    (GPL.format("General Public License", 2), "gpl-2.0-or-later"),
    (GPL.format("Lesser General Public License", "2.1"), "lgpl-2.1-or-later"),
    (GPL.format("Affero General Public License", 3), "agpl-3.0-or-later"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("SPDX-License-Identifier: 0BSD", "0bsd"),
    ("BSD 3-Clause License", "bsd-3-clause"),
    ("see GPLv3 for more", "gpl-3.0"),
    ("https://creativecommons.org/licenses/by/4.0/", "cc-by-4.0"),
    ("https://creativecommons.org/licenses/by-nc-sa/3.0/", "cc-by-nc-sa-3.0"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
]


def test_texts_headers_tags_and_links(spark):
    texts = ["some prose before " + text + " and more prose behind" for text, _ in SIGNED]
    texts.append("hereby we were granted a charge for the neither here nor there")
    got = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING"))
    found = {r["doc_id"]: set(r["labels"].split(",")) for r in got.collect()}
    for k, (text, label) in enumerate(SIGNED):
        assert label in found[k], text
        assert method(texts[k]) | {x for x in base(texts[k])[-1].split(",") if x} == found[k], text
    assert found[len(SIGNED)] == {""}
