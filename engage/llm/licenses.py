"""Licence detection by ordered signature rules, in DataFrame functions only.

A text becomes words, each set between two spaces, so that word-level signatures are plain regular expressions and
neighbouring matches share nothing.  A few literals tell in one pass which texts need this at all; a rule runs on a
text only where it contains the two longest words that the rule's own pattern fixes.  Rules are the names of ``LICENCES``
under each of ``TEMPLATES``, and ``BODIES``: sentences of the licences themselves and of the notices that files carry.  Of the detections, one that lies inside another is suppressed, of equal intervals all but the first by
priority and rule order, and where neighbours then still overlap, the one with the worse priority.

Defined results: null text is empty; a text without words has no detections, null positions, empty labels and score 0;
repeated rows are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

import string
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the contract: what separates words, and the phrases with their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before A-Z are lower-cased
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# label, name and SPDX words.  In names, ? ends an optional word, / separates choices.
LICENCES = """
gpl-1.0        | gnu general public license/licence version/v/v1? 1            | gpl 1 0
gpl-2.0        | gnu general public license/licence version/v/v2? 2            | gpl 2 0
gpl-3.0        | gnu general public license/licence version/v/v3? 3            | gpl 3 0
gpl            | gnu? gpl/gplv1/gplv2/gplv3                                    | gpl
lgpl-2.0       | gnu library general public license/licence version/v? 2       | lgpl 2 0
lgpl-2.1       | gnu lesser general public license/licence version/v? 2 1      | lgpl 2 1
lgpl-3.0       | gnu lesser general public license/licence version/v? 3        | lgpl 3 0
lgpl           | gnu? lgpl/lgplv2/lgplv3                                       | lgpl
agpl-3.0       | gnu affero general public license/licence version/v? 3?       | agpl 3 0
agpl           | gnu? agpl/agplv3                                              | agpl
gfdl           | gnu free documentation license/licence version? 1? 1/2/3?     | gfdl 1 3
apache-1.0     | apache software? license/licence version/v? 1 0               | apache 1 0
apache-1.1     | apache software? license/licence version/v? 1 1               | apache 1 1
apache-2.0     | apache software? license/licence version/v? 2 0               | apache 2 0
mit            | mit expat? license/licence                                    | mit
mit-0          | mit no attribution license/licence?                           | mit 0
x11            | x11 license/licence                                           | x11
bsd-2-clause   | simplified/freebsd bsd? license/licence                       | bsd 2 clause
bsd-2-clause   | 2/two clause bsd license/licence?                             | bsd 2 clause freebsd
bsd-3-clause   | 3/three clause bsd license/licence?                           | bsd 3 clause
bsd-3-clause   | new/modified/revised bsd license/licence                      | bsd 3 clause clear
bsd-4-clause   | 4/four clause bsd license/licence?                            | bsd 4 clause
bsd            | bsd style? license/licence                                    | bsd
0bsd           | zero clause bsd license/licence?                              | 0bsd
isc            | isc license/licence                                           | isc
mpl-1.0        | mozilla public license/licence version/v? 1 0                 | mpl 1 0
mpl-1.1        | mozilla public license/licence version/v? 1 1                 | mpl 1 1
mpl-2.0        | mozilla public license/licence version/v? 2 0                 | mpl 2 0
epl-1.0        | eclipse public license/licence version/v? 1 0                 | epl 1 0
epl-2.0        | eclipse public license/licence version/v? 2 0                 | epl 2 0
cddl-1.0       | common development and distribution license/licence           | cddl 1 0
cpl-1.0        | common public license/licence version? 1? 0?                  | cpl 1 0
cc-by-3.0      | cc by 3 0                                                     | cc by 3 0
cc-by-4.0      | cc by 4 0                                                     | cc by 4 0
cc-by-sa       | cc by sa 2/3/4? 0/5?                                          | cc by sa 4 0
cc-by-nc       | cc by nc 2/3/4? 0/5?                                          | cc by nc 4 0
cc-by-nd       | cc by nd 2/3/4? 0/5?                                          | cc by nd 4 0
cc-by-nc-sa    | cc by nc sa 2/3/4? 0/5?                                       | cc by nc sa 4 0
cc-by-nc-nd    | cc by nc nd 2/3/4? 0/5?                                       | cc by nc nd 4 0
cc-by          | creative commons attribution 2/3/4? 0/5? international?       | cc by
cc-by-sa       | creative commons attribution share alike/sharealike           | cc by sa 3 0
cc-by-nc       | creative commons attribution non commercial/noncommercial     | cc by nc 3 0
cc-by-nd       | creative commons attribution no derivatives/noderivatives     | cc by nd 3 0
cc0-1.0        | creative commons zero/cc0 1? 0?                               | cc0 1 0
unlicense      | the? unlicense                                                | unlicense
wtfpl          | do what the fuck you want to public license/licence           | wtfpl
zlib           | zlib libpng? license/licence                                  | zlib
bsl-1.0        | boost software license/licence version? 1? 0?                 | bsl 1 0
artistic-1.0   | artistic license/licence version? 1 0                         | artistic 1 0
artistic-2.0   | artistic license/licence version? 2 0                         | artistic 2 0
eupl-1.2       | european union public license/licence version? 1? 1/2?        | eupl 1 2
osl-3.0        | open software license/licence version? 3? 0?                  | osl 3 0
afl-3.0        | academic free license/licence version? 3? 0?                  | afl 3 0
ms-pl          | microsoft public license/licence                              | ms pl
ms-rl          | microsoft reciprocal license/licence                          | ms rl
ofl-1.1        | sil? open font license/licence version? 1? 1?                 | ofl 1 1
psf-2.0        | python software foundation license/licence version? 2?        | psf 2 0
ruby           | ruby license/licence                                          | ruby
php-3.01       | php license/licence version? 3? 0/01?                         | php 3 01
postgresql     | postgresql license/licence                                    | postgresql
ncsa           | university of illinois ncsa? open source license/licence      | ncsa
openssl        | openssl license/licence                                       | openssl
odbl-1.0       | open database license/licence version? 1? 0?                  | odbl 1 0
pddl-1.0       | public domain dedication and license/licence                  | pddl 1 0
lppl-1.3       | latex project public license/licence version? 1? 3/3c?        | lppl 1 3c
w3c            | w3c software notice? and? license/licence                     | w3c
"""

# kind, words before the name (or before the SPDX words), priority (0 best), confidence
TEMPLATES = """
spdx        | spdx license identifier                                             | 0 | 1.0
licensed    | licensed under the? terms? of? the?                                 | 1 | 0.95
subject     | subject to the? terms? and? conditions? of? the?                    | 1 | 0.9
distributed | distributed/released/published/available/provided under the? terms? of? the? | 2 | 0.9
name        |                                                                     | 3 | 0.7
"""

# label, confidence and words of sentences that stand in a licence's own text or in the notice that it asks files to carry;
# their priority is 1
BODIES = """
mit            | 0.9  | permission is hereby granted free of charge to any person obtaining a copy
mit            | 0.8  | the above copyright notice and this permission notice shall be included in all copies
mit            | 0.9  | to deal in the software without restriction
ncsa           | 0.9  | to deal with the software without restriction
x11            | 0.8  | except as contained in this notice the name/names of
isc            | 0.9  | permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
0bsd           | 0.9  | permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted the software is provided as is
postgresql     | 0.9  | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
bsd            | 0.9  | redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause   | 0.8  | the views and conclusions contained in the software and documentation are those of the authors
bsd-3-clause   | 0.9  | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause   | 0.95 | all advertising materials mentioning features or use of this software must display the following acknowledgement/acknowledgment
apache-2.0     | 0.9  | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-1.1     | 0.8  | this product includes software developed by the apache software foundation
eupl-1.2       | 0.8  | unless required by applicable law or agreed to in writing software distributed under the licence is distributed on an as is basis
eupl-1.2       | 0.8  | licensed under the eupl
gpl-2.0        | 0.95 | redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either? version 2
gpl-3.0        | 0.95 | redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either? version 3
lgpl-2.0       | 0.95 | redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either? version 2
lgpl-2.1       | 0.95 | redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either? version 2 1
lgpl-3.0       | 0.95 | redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either? version 3
lgpl           | 0.8  | this library is distributed in the hope that it will be useful but without any warranty
lgpl-2.1       | 0.8  | the lesser general public license applies to some specially designated software packages
agpl-3.0       | 0.95 | redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either? version 3
gfdl           | 0.95 | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-1.0        | 0.95 | the contents of this file are subject to the mozilla public license version 1 0
mpl-1.1        | 0.95 | the contents of this file are subject to the mozilla public license version 1 1
mpl-2.0        | 0.95 | this source code form is subject to the terms of the mozilla public license v/version 2 0
epl-1.0        | 0.95 | this program and the accompanying materials are made available under the terms of the eclipse public license v/version 1 0
epl-2.0        | 0.95 | this program and the accompanying materials are made available under the terms of the eclipse public license v/version? 2 0
cpl-1.0        | 0.95 | this program and the accompanying materials are made available under the terms of the common public license v/version 1 0
cddl-1.0       | 0.95 | the contents of this file are subject to the terms of the common development and distribution license
bsl-1.0        | 0.95 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
zlib           | 0.9  | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib           | 0.8  | this software is provided as is without any express or implied warranty in no event will the authors be held liable
unlicense      | 0.95 | this is free and unencumbered software released into the public domain
wtfpl          | 0.95 | you just do what the fuck you want to
artistic-1.0   | 0.9  | the intent of this document is to state the conditions under which a package may be copied
cc0-1.0        | 0.9  | waived all copyright and related or neighboring/neighbouring rights
cc-by          | 0.95 | this work is licensed under a/the creative commons attribution 2/3/4 0/5
cc-by-sa       | 0.95 | this work is licensed under a/the creative commons attribution share alike 2/3/4 0/5
cc-by-sa       | 0.95 | this work is licensed under a/the creative commons attribution sharealike 2/3/4 0/5
ofl-1.1        | 0.95 | this font software is licensed under the sil open font license version 1 1
psf-2.0        | 0.9  | psf is making python available to licensee on an as is basis
openssl        | 0.9  | this product includes software developed by the openssl project for use in the openssl toolkit
php-3.01       | 0.9  | this product includes php software freely available from
lppl-1.3       | 0.95 | this work may be distributed and or modified under the conditions of the latex project public license either? version 1 3/3c
odbl-1.0       | 0.9  | is made available under the open database license/licence
"""


def words_pattern(words: str) -> str:
    """A signature over wrapped words, without the first word's leading space: ' a  b  c ' is 'a  b  c '."""
    parts = []
    for word in words.split():
        choices = word.rstrip("?").split("/")
        one = choices[0] if len(choices) == 1 else f"(?:{'|'.join(choices)})"
        parts.append(f"(?: {one} )?" if word.endswith("?") else f" {one} ")
    return "".join(parts)


def literals(words: str) -> list[str]:
    """What a text wrapped in spaces must hold for ``words`` to match: fixed words and common beginnings of choices, longest first."""
    found = []
    for word in words.split():
        choices = word.split("/")
        start = "" if word.endswith("?") else commonprefix(choices)
        if start:
            found.append(f" {start} " if len(choices) == 1 else f" {start}")
    return sorted(dict.fromkeys(found), key=len, reverse=True)


def rule_table() -> list[tuple[str, str, int, float, str]]:
    """(label, pattern, priority, confidence, words) of every rule, in order.

    A pattern has its first word's leading space cut off where that word is fixed; rules whose first word is optional are
    written out with and without it.
    """
    rules = []

    def add(label: str, words: list[str], priority: str, confidence: str) -> None:
        while words[0].endswith("?"):
            add(label, [words[0].rstrip("?"), *words[1:]], priority, confidence)
            words = words[1:]
        rules.append((label, words_pattern(" ".join(words))[1:], int(priority), float(confidence), " ".join(words)))

    cells = lambda table: [[x.strip() for x in line.split("|")] for line in table.strip().splitlines()]
    for kind, before, priority, confidence in cells(TEMPLATES):
        for label, name, spdx in cells(LICENCES):
            add(label, f"{before} {spdx if kind == 'spdx' else name}".split(), priority, confidence)
    for label, confidence, words in cells(BODIES):
        add(label, words.split(), "1", confidence)
    return rules


RULES = rule_table()


def gate() -> str:
    """What a text must hold for any rule or phrase to match: a common part, else two neighbouring words that the rule fixes."""
    parts = {"licen": "licen", "gpl": "gpl", " cc ": "(?<![a-z0-9])cc(?![a-z0-9])"}
    pairs = {}
    for words in sorted([r[-1] for r in RULES] + [phrase for phrase, _ in BASE], key=len):
        fixed = [None if "/" in w or w.endswith("?") else w for w in words.split()]
        own = [pair for pair in zip(fixed, fixed[1:], strict=False) if all(pair)] or [(literals(words)[0].strip(),)]
        if not any(part in literal for part in parts for literal in literals(words)) and not pairs.keys() & set(own):
            longest = max(own, key=lambda pair: sum(map(len, pair)))
            pairs[longest] = "[^a-z0-9]+".join(longest)
    return "(?i)" + "|".join([*parts.values(), *pairs.values()])


GATE = gate()
MARK = "\x02"


def wrapped(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, each between two spaces."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    plain = F.trim(F.regexp_replace(low, SEPARATORS, "  "))
    return F.when(plain == "", "").otherwise(F.concat(F.lit(" "), plain, F.lit(" ")))


def n_wrapped(words: Column) -> Column:
    return ((F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))) / 2).cast("long")


def places(words: Column, pattern: Column) -> Column:
    """(start, end) word numbers of all matches: a mark set before each shows its word, the match its length."""
    regex = F.concat(F.lit(" ("), pattern, F.lit(")"))
    marked = F.split(F.trim(F.regexp_replace(words, regex, F.lit(" " + MARK + "$1"))), "  ")
    starts = F.filter(
        F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit(MARK)), i.cast("long"))), lambda i: i.isNotNull()
    )
    sizes = F.transform(
        F.regexp_extract_all(words, regex, F.lit(1)), lambda m: n_wrapped(F.concat(F.lit(" "), m)).cast("long")
    )
    return F.zip_with(starts, sizes, lambda s, n: F.struct(s.alias("start"), (s + n).alias("end")))


def base_places(words: Column, phrase: str, label: str) -> Column:
    return F.transform(
        places(words, F.lit(words_pattern(phrase)[1:])),
        lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.lit(label).alias("label")),
    )


def detections(words: Column) -> Column:
    """All matches of all rules whose literals the text holds, in the order in which they are resolved."""
    table = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.lit(literals(rule_words)[0]).alias("a"),
                F.lit(literals(rule_words)[:2][-1]).alias("b"),
                F.lit(pattern).alias("pattern"),
                F.lit(priority).alias("priority"),
                F.lit(confidence).alias("confidence"),
                F.lit(i).alias("rule"),
            )
            for i, (label, pattern, priority, confidence, rule_words) in enumerate(RULES)
        ]
    )
    gated = F.filter(table, lambda r: F.contains(words, r["a"]) & F.contains(words, r["b"]))
    found = F.transform(
        gated,
        lambda r: F.transform(
            places(words, r["pattern"]),
            lambda p: F.struct(
                p["start"].alias("start"),
                (-p["end"]).alias("minus_end"),
                r["priority"].alias("priority"),
                r["rule"].alias("rule"),
                r["label"].alias("label"),
                r["confidence"].alias("confidence"),
            ),
        ),
    )
    return F.array_sort(F.flatten(found))


def resolved(found: Column) -> Column:
    """Detections that no other one suppresses."""
    kind = "array<struct<start:bigint,minus_end:bigint,priority:int,rule:int,label:string,confidence:double>>"
    outer = F.aggregate(
        found,
        F.struct(F.lit(-1).cast("long").alias("reach"), F.array().cast(kind).alias("kept")),
        lambda acc, d: F.when(
            -d["minus_end"] > acc["reach"],
            F.struct((-d["minus_end"]).alias("reach"), F.concat(acc["kept"], F.array(d)).alias("kept")),
        ).otherwise(acc),
        lambda acc: acc["kept"],
    )
    return outer


def undisputed(kept: Column) -> Column:
    """Without those that overlap a neighbour of better priority."""
    numbered = F.transform(
        kept,
        lambda d, i: F.struct(
            d.alias("d"),
            F.get(kept, i - 1).alias("left"),
            F.get(kept, i + 1).alias("right"),
        ),
    )
    beaten = lambda x: F.coalesce(
        (-x["left"]["minus_end"] > x["d"]["start"]) & (x["left"]["priority"] < x["d"]["priority"]), F.lit(False)
    ) | F.coalesce(
        (x["right"]["start"] < -x["d"]["minus_end"]) & (x["right"]["priority"] < x["d"]["priority"]), F.lit(False)
    )
    return F.transform(F.filter(numbered, lambda x: ~beaten(x)), lambda x: x["d"])


def scan(docs: DataFrame) -> DataFrame:
    """Per document its detections: doc_id, n_words, base (start, end, label) and kept (label, start, end, confidence)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
        F.when(text.rlike(GATE), text).alias("gated"),
    )
    rows = rows.withColumn("words", F.when(F.col("gated").isNotNull(), wrapped(F.col("gated")))).drop("gated")
    rows = rows.withColumn("base", F.concat(*[base_places(F.col("words"), *b) for b in BASE])).withColumn("found", detections(F.col("words"))).drop("words")
    rows = rows.withColumn("found", resolved(F.col("found")))
    return rows.withColumn("kept", undisputed(F.col("found"))).drop("found")


def licence_scan(docs: DataFrame) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = scan(docs)
    none = F.array().cast("array<string>")
    base_labels = F.coalesce(F.transform("base", lambda b: b["label"]), none)
    labels = F.concat(base_labels, F.coalesce(F.transform("kept", lambda d: d["label"]), none))
    starts = F.transform("base", lambda b: b["start"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    best = F.coalesce(F.array_max(F.transform("kept", lambda d: d["confidence"])), F.lit(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(labels).alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, F.lit(0.5)).otherwise(0.0)).alias("score"),
    )


def oracle() -> str:
    """The same result in DuckDB's SQL, from the same rules; it knows no literals, only whether any rule's pattern matches."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rules = ", ".join(f"({i}, {quote(r[0])}, {quote(r[1])}, {r[2]}, {r[3]})" for i, r in enumerate(RULES))
    any_rule = "|".join(dict.fromkeys(r[1] for r in RULES))
    base = ", ".join(f"({quote(label)}, {quote(words_pattern(phrase)[1:])})" for phrase, label in BASE)
    matched = lambda p: (
        f"list_zip(list_filter(list_transform(string_split(trim(regexp_replace(words, ' (' || {p} || ')', ' ' || chr(2) || '\\1', 'g')), '  '), "
        f"lambda w, i: CASE WHEN starts_with(w, chr(2)) THEN i - 1 END), lambda i: i IS NOT NULL), "
        f"list_transform(regexp_extract_all(words, ' (' || {p} || ')'), lambda m: (length(m) - length(replace(m, ' ', ''))) // 2))"
    )
    return f"""
WITH r(rule, label, pattern, priority, confidence) AS (VALUES {rules}),
q(label, pattern) AS (VALUES {base}),
t AS (SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SEPARATORS}', '  ', 'g')) AS plain FROM documents),
w AS (SELECT doc_id, CASE WHEN plain = '' THEN '' ELSE ' ' || plain || ' ' END AS words FROM t),
n AS (SELECT doc_id, words, (length(words) - length(replace(words, ' ', ''))) // 2 AS n_words FROM w),
m AS (SELECT doc_id, words FROM n WHERE regexp_matches(words, ' (?:{any_rule})')),
bh AS (SELECT doc_id, label, unnest({matched('pattern')}) AS h FROM n, q WHERE regexp_matches(words, ' ' || pattern)),
b AS (SELECT doc_id, count(*) AS n_base, min(h[1]) AS first_word, max(h[1]) AS last_word FROM bh GROUP BY doc_id),
dh AS (SELECT doc_id, rule, label, priority, confidence, unnest({matched('pattern')}) AS h FROM m, r WHERE regexp_matches(words, ' ' || pattern)),
d AS (SELECT doc_id, rule, label, priority, confidence, h[1] AS s, h[1] + h[2] AS e FROM dh),
o AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s, e DESC, priority, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM d),
k AS (SELECT *, lag(e) OVER z AS le, lag(priority) OVER z AS lp, lead(s) OVER z AS rs, lead(priority) OVER z AS rp FROM o WHERE reach IS NULL OR e > reach WINDOW z AS (PARTITION BY doc_id ORDER BY s, e DESC, priority, rule)),
f AS (SELECT doc_id, label, confidence FROM k WHERE NOT coalesce(le > s AND lp < priority, false) AND NOT coalesce(rs < e AND rp < priority, false)),
bl AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT doc_id, label FROM bh) GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM bh UNION SELECT doc_id, label FROM f) GROUP BY doc_id),
sc AS (SELECT doc_id, max(confidence) AS best FROM f GROUP BY doc_id)
SELECT n.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(greatest(coalesce(best, 0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END) AS DOUBLE) AS score
FROM n LEFT JOIN b USING (doc_id) LEFT JOIN bl USING (doc_id) LEFT JOIN al USING (doc_id) LEFT JOIN sc USING (doc_id)
"""


ORACLE = oracle()
