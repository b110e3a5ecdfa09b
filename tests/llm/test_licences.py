"""Licence scans: positions, gating and suppression."""

import re

from engage.llm import licenses as op


def scan(documents, *texts):
    rows = op.licence_scan(documents(list(enumerate(texts)))).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_phrases_and_places(documents):
    got = scan(
        documents,
        "MIT License. mit-license mit  license",
        "commit license",
        None,
        "",
        "the GNU General, public LICENSE and the Apache license; CC-BY",
        "mité license",
        "apache" + " x" * 200_000 + " apache license",
    )
    assert got[0][:5] == (6, 3, 0, 4, "mit")
    assert got[1] == (2, 0, None, None, "", "", 0.0)
    assert got[2] == got[3] == (0, 0, None, None, "", "", 0.0)
    assert got[4][:5] == (11, 3, 1, 9, "apache,cc-by,gpl")
    assert got[5][1] == 0
    assert got[6][:5] == (200_003, 1, 200_001, 200_001, "apache")


def test_contained_and_worse_detections_go(documents):
    got = scan(
        documents,
        "licensed under the Apache License, Version 2.0",
        "SPDX-License-Identifier: BSD-3-Clause",
        "under the Mozilla Public License 2.0 licensed",
    )
    assert got[0][5] == "apache,apache-2.0" and got[0][6] == 0.95
    assert got[1][5] == "bsd-3-clause" and got[1][6] == 1.0
    assert got[2][5] == "mpl-2.0" and got[2][6] == 0.7


def sample(words):
    """The plainest text that a rule matches."""
    return " ".join(w.split("/")[0] for w in words.split() if not w.endswith("?"))


def test_rules_are_many_and_gated():
    assert len(op.RULES) > 200
    for *_, words in op.RULES:
        assert re.search(op.GATE, sample(words))
        assert op.literals(words) and all(literal in " " + sample(words).replace(" ", "  ") + " " for literal in op.literals(words))


def test_sentences_of_the_licences_themselves(documents):
    got = scan(
        documents,
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
        "# the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that. Neither the name of the X nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED "AS IS"',
        "permission to copy this story was granted free of charge to the person who wrote it; redistribution of wealth",
        "software distributed under the Licence is distributed on an as is basis",
    )
    assert [g[5] for g in got] == ["mit", "gpl,gpl-3.0", "mpl-2.0", "bsd,bsd-3-clause", "0bsd", "", ""]
    assert got[1][6] == 0.95


def test_texts_without_the_longest_words_match_in_sql(spark, documents):
    """The SQL has no literals: rows that the scan's gate would lose by mistake show as a difference."""
    import duckdb

    texts = [sample(r[-1]) for r in op.RULES] + ["nothing here", "", None, "the mit licence and gplv2, cc0"]
    docs = documents([(i, None if t is None else f"Intro. {t}; end of it") for i, t in enumerate(texts)])
    db = duckdb.connect()
    db.register("documents", docs.toPandas())
    want = sorted(db.execute(op.ORACLE).fetchall())
    assert sorted(tuple(r) for r in op.licence_scan(docs).collect()) == want


def test_rules_match_without_the_word_license(documents):
    got = scan(
        documents,
        "distributed under the Creative Commons Attribution 4.0 International",
        "released under the two clause BSD",
        "provided under zero-clause BSD",
        "subject to the terms of the MIT no attribution",
    )
    assert [g[5] for g in got] == ["cc-by", "bsd-2-clause", "0bsd", "mit-0"]


def test_every_rule_finds_its_own_words(documents):
    samples = [sample(r[-1]) for r in op.RULES]
    rows = op.scan(documents(list(enumerate(samples)))).select("doc_id", "kept").collect()
    assert all(r["kept"] and r["kept"][0]["label"] for r in rows) and len(rows) == len(samples)


def test_repeated_rows_and_empty_table(documents):
    rows = op.licence_scan(documents([(1, "mit license"), (1, "mit license"), (None, "mit license")])).collect()
    assert len(rows) == 3 and {r["n_base"] for r in rows} == {1}
    assert op.licence_scan(documents([])).collect() == []
