"""License scans against lists of lines of their own, written apart from the module."""

import re

import numpy as np

from stayline.llm import license_scan, licenses, queries
from stayline.llm.common import documents
from stayline.llm.jaccard_forest import shingles

#: The license lines of the test tables.
PLANTED = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Released under the MIT License.": "MIT",
    "All rights reserved.": "Proprietary",
}


def test_every_planted_line_is_reported(spark, sf):
    want = {(r.doc_id, PLANTED[line]) for r in documents(spark, sf).collect()
            for line in (r.text or "").splitlines() if line in PLANTED}
    assert {name for _, name in want} == set(PLANTED.values())
    got = {(r.doc_id, r.license): r.containment for r in queries.op6_license_scan(spark, sf).collect()}
    assert want <= set(got)
    assert all(got[x] == 1.0 for x in want)


def test_short_templates_inside_texts(spark, rng):
    templates = [("one", "Proprietary"), ("two", "MIT License"), ("three", "All rights reserved."),
                 ("four", "Apache License 2.0"), ("five", "Licensed under CC BY NC")]
    vocabulary = [w for _, t in templates for w in re.findall(r"\w+", t)] + ["and", "or", "of"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {(r.doc_id, r.license) for r in license_scan.scan(docs, templates).collect()}
    plain = lambda t: f" {' '.join(re.findall(r'[a-z0-9]+', t.lower()))} "
    assert got == {(i, n) for i, t in enumerate(texts) for n, line in templates if plain(line) in plain(t)}


def names(texts):
    found = license_scan.scanner(licenses.LICENSES)
    return [set(found.scan(t)) for t in texts]


def test_common_wordings_and_bodies():
    lines = {
        "Licensed under the MIT License": {"MIT"},
        "This project is distributed under the terms of the Apache License 2.0, see LICENSE.": {"Apache-2.0"},
        "SPDX-License-Identifier: LGPL-2.1": {"LGPL-2.1"},
        "Text is available under CC BY-SA 4.0.": {"CC-BY-SA-4.0"},
        "https://creativecommons.org/licenses/by/4.0/": {"CC-BY-4.0"},
        "released under the Creative Commons Attribution 4.0 International License": {"CC-BY-4.0"},
        "This work is distributed under the GNU General Public License, version 3": {"GPL-3.0"},
        "GNU Lesser General Public License, version 3": {"LGPL-3.0"},
        "under the BSD 3-Clause license": {"BSD-3-Clause"},
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this program and associated "
        "documentation files (the 'Software'), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:": {"MIT"},
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.": {"ISC"},
        "Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that\n"
        " * the following conditions are met:": {"BSD"},
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.": {"GPL", "GPL-3.0"},
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation; either version 2 of the License, or any later version.": {"GPL", "GPL-2.0"},
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or any later version": {"LGPL", "LGPL-2.1"},
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License": {"AGPL-3.0"},
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": {"MPL-2.0"},
        "It was permitted to walk along the river with or without a dog.": set(),
    }
    got = names(f"some words before it {t} and some words after it" for t in lines)
    assert dict(zip(lines, got)) == lines


def test_every_template_in_long_texts(rng):
    noise = lambda n: " ".join(f"n{rng.randint(0, 9999)}" for _ in range(n))
    for name, text in licenses.LICENSES:
        at = rng.choice([0, 3, 50, 32_700, 32_768, 40_000])
        assert name in names([f"{noise(at)} {text} {noise(rng.randint(0, 300))}"])[0], text


def test_same_windows_as_hashing_all(rng):
    """Only windows with a shingle of a template are hashed; the others cannot agree in a band."""
    body = max((t for _, t in licenses.LICENSES), key=len).split()
    made, hits = license_scan.scanner(licenses.LICENSES), 0
    for _ in range(40):
        words = body * rng.randint(1, 4) + [f"n{rng.randint(0, 99)}" for _ in range(200)]
        for _ in range(rng.randint(0, 30)):
            words[rng.randrange(len(words))] = "other"
        cut = rng.randrange(200)
        text = " ".join(words[cut:] + words[:cut])
        run, want = shingles(text), {}
        hashed = made.hashed(run)
        for step, members in made.by_words[5].items():
            block = np.minimum.reduceat(hashed, np.arange(0, len(run), step), axis=1)
            window = np.minimum(block, np.concatenate([block[:, 1:], block[:, -1:]], axis=1))
            for i in members:
                for a in np.flatnonzero((window == made.values[i][:, None]).any(0)) * step:
                    held = float(np.isin(made.sets[i], run[a : a + 2 * step]).mean())
                    if held >= 0.8:
                        best, first, n = want.get(made.names[i], (0.0, a, 0))
                        want[made.names[i]] = (max(best, held), min(first, int(a)), n + 1)
        got = {}
        made._scan(run, 5, got)
        assert got == want
        hits += len(want)
    assert hits
